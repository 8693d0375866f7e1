"""Web archives: one gzip member per WARC record, and a splittable reader of them.

**Writing** (:func:`write_archives`). Every page becomes a ``response`` record, its payload
the html in UTF-8, or a ``revisit`` of the page of largest id with an equal payload. Equal
payloads are found by length and SHA-256 in one aggregate over keys; only groups of several
pages go on, so the pages themselves stay where they were read, unless the groups are too
many to broadcast. Tasks write files of their own below the shared folder, under names that
no other attempt has, and report them; the list of files is saved by Spark's committer, so
what a lost or repeated attempt left behind is never read.

**Reading** (:func:`read_archives`). Files are cut into byte ranges, and each task scans its
ranges for the gzip magic. A hit is only a candidate: it counts when its first bytes inflate
to a WARC version line and the member then has whole headers, a right checksum and the
length that its header names. A range owns the records that start inside it and reads past
its end to finish the last one, so every record is read once, wherever the cuts fall. Other
hits, such as magic bytes within compressed data, are skipped. A member that would hold a
valid record inside its compressed bytes is never written (:func:`_member`).

Archives are opened through ``pyarrow.fs`` at the URI of the folder; it has to be a
file system that the executors share.

Defined cases: null html is an empty payload; a null url has no target header; control
characters, per cent signs beside them and outer blanks of a url are escaped and restored; a
null page id comes after all others; repeated rows that share the largest id of their group
are all responses; an empty table writes no file. Further columns are not read, whatever
their names.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martflow.session import work_dir

from .common import bounded_batches, broadcast_if_small, read_table, save

ARCHIVE_BYTES = 512 << 20   # a task begins a new file beyond this
SPLIT_BYTES = 4 << 20       # byte range of a read
BLOCK_BYTES = 1 << 18
LEVEL = 6
MIN_REVISIT_BYTES = 0       # smaller payloads are all responses
DATE = "2024-01-01T00:00:00Z"   # the pages carry no time; a fixed one keeps reruns equal

MAGIC = b"\x1f\x8b\x08"
_VERSION = b"WARC/1.0\r\n"
_END = b"\r\n\r\n"
_ID = "urn:page:"
_REVISIT = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"

FILES = "path string, bytes long, records long"
RECORDS = ("page_id long, url string, record_type string, refers_to long, payload_bytes long, "
           "payload_digest string, payload binary, path string, at long")


# ---------------------------------------------------------------- records

def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


_UNSAFE = re.compile(r"[\x00-\x1f\x7f]|%(?=[01][0-9A-F]|20|25|7F)|^ | $")


def _escaped(url: str) -> str:
    """A url without line ends or other control characters, restored by :func:`_restored`."""
    return _UNSAFE.sub(lambda m: f"%{ord(m[0]):02X}", url)


def _restored(url: str) -> str:
    return re.sub("%([01][0-9A-F]|20|25|7F)", lambda m: chr(int(m[1], 16)), url)


def _urn(page_id: int | None) -> str:
    return f"<{_ID}{'none' if page_id is None else page_id}>"


def _of_urn(text: str | None) -> int | None:
    value = (text or "").strip("<>").removeprefix(_ID)
    return int(value) if re.fullmatch(r"-?\d+", value) else None


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None = None,
           revisit: bool = False) -> bytes:
    """One WARC record; a revisit has the payload's HTTP header but not the payload."""
    http = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            + f"Content-Length: {len(payload)}".encode() + _END)
    block = http if revisit else http + payload
    head = ["WARC-Type: " + ("revisit" if revisit else "response"), f"WARC-Record-ID: {_urn(page_id)}",
            f"WARC-Date: {DATE}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {_escaped(url)}")
    if revisit:
        head += [f"WARC-Profile: {_REVISIT}", f"WARC-Refers-To: {_urn(refers_to)}"]
    head += ["Content-Type: application/http; msgtype=response",
             f"WARC-Payload-Digest: sha1:{sha1_base32(payload)}", f"Content-Length: {len(block)}"]
    return _VERSION + "\r\n".join(head).encode() + _END + block + _END


def parse(data: bytes) -> tuple[dict[str, str], bytes] | None:
    """Headers (names in lower case) and block of a whole record, or None."""
    end = data.find(_END)
    if end < 0 or not data.startswith(b"WARC/1."):
        return None
    try:
        lines = data[:end].decode().split("\r\n")[1:]
    except UnicodeDecodeError:
        return None
    head = {name.strip().lower(): value.removeprefix(" ") for name, _, value in (x.partition(":") for x in lines)}
    length = head.get("content-length", "")
    if "warc-type" not in head or "warc-record-id" not in head or not length.isdigit():
        return None
    block = data[end + 4:end + 4 + int(length)]
    return (head, block) if len(data) == end + 8 + int(length) and data.endswith(_END) else None


# ---------------------------------------------------------------- members

class Bytes:
    """Random access to a byte string, as to a file."""

    def __init__(self, data: bytes):
        self.data = data

    def read_at(self, n: int, at: int) -> bytes:
        return self.data[at:at + n]


def member_at(source, at: int) -> tuple[bytes, int] | None:
    """The inflated gzip member that starts at ``at`` and the place after it, or None when no
    whole member with a WARC record starts there."""
    inflate, parts, place = zlib.decompressobj(31), [], at
    while not inflate.eof:
        block = source.read_at(BLOCK_BYTES if parts else 1 << 12, place)
        if not block:
            return None
        try:
            parts.append(inflate.decompress(block))
        except zlib.error:
            return None
        if len(parts) == 1 and not parts[0].startswith(b"WARC/1."[:max(1, len(parts[0]))]):
            return None
        place += len(block)
    return b"".join(parts), place - len(inflate.unused_data)


def _member(data: bytes) -> bytes:
    """``data`` as a gzip member within which no other record can be found: bytes that were
    stored as they are could hold an archive, so such a record is Huffman-coded instead."""
    for strategy in (zlib.Z_DEFAULT_STRATEGY, zlib.Z_HUFFMAN_ONLY):
        deflate = zlib.compressobj(LEVEL, zlib.DEFLATED, 31, 9, strategy)
        out = deflate.compress(data) + deflate.flush()
        inside = out.find(MAGIC, 1)
        while inside >= 0 and member_at(Bytes(out), inside) is None:
            inside = out.find(MAGIC, inside + 1)
        if inside < 0:
            return out
    raise ValueError("a payload holds an archive that compression leaves as it is")


def scan(source, start: int, end: int) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(place, headers, block) of the records that start in the bytes [start, end)."""
    at = start
    while at < end:
        # two bytes more: a magic may begin on the range's last byte
        block = source.read_at(min(BLOCK_BYTES, end - at) + 2, at)
        hit = block.find(MAGIC)
        if hit < 0:
            at += max(1, len(block) - 2) if len(block) > 2 else end
            continue
        at += hit
        found = member_at(source, at)
        parsed = parse(found[0]) if found else None
        if parsed is None:
            at += 1
            continue
        yield at, *parsed
        at = found[1]


def _row(path: str, at: int, head: dict[str, str], block: bytes, payloads: bool) -> tuple | None:
    """A response or revisit as a row; None for other records."""
    kind = head["warc-type"]
    if kind not in ("response", "revisit"):
        return None
    top, _, payload = block.partition(_END)
    digest = head.get("warc-payload-digest", "").removeprefix("sha1:")
    size = re.search(rb"(?i)\r\ncontent-length:\s*(\d+)", top)
    if kind == "response":
        if digest and digest != sha1_base32(payload):
            raise ValueError(f"{path} at {at}: the payload's digest is not {digest}")
        digest, length = digest or sha1_base32(payload), len(payload)
    else:
        length = int(size[1]) if size else None
    url = head.get("warc-target-uri")
    return (_of_urn(head["warc-record-id"]), None if url is None else _restored(url), kind,
            _of_urn(head.get("warc-refers-to")), length, digest, payload if payloads and kind == "response" else None,
            path, at)


# ---------------------------------------------------------------- files

def _open(uri: str):
    fs, path = pa.fs.FileSystem.from_uri(uri)
    return fs, path


def _writer(folder: str, archive_bytes: int):
    """Task body: pages in, files out; yields a row per file that is complete."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _open(folder)
        out, name, size, n = None, "", 0, 0

        def finished():
            out.close()
            return pa.RecordBatch.from_pylist([{"path": f"{folder}/{name}", "bytes": size, "records": n}],
                                              pa.schema([("path", pa.string()), ("bytes", pa.int64()),
                                                         ("records", pa.int64())]))
        for batch in batches:
            for page_id, url, payload, revisit, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    name, size, n = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = fs.open_output_stream(f"{base}/{name}", compression=None)
                data = _member(record(page_id, url, payload, refers_to, revisit))
                out.write(data)
                size, n = size + len(data), n + 1
                if size >= archive_bytes:
                    yield finished()
                    out = None
        if out is not None:
            yield finished()
    return run


def _reader(payloads: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()),
                            ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                            ("payload", pa.binary()), ("path", pa.string()), ("at", pa.int64())])
        for batch in batches:
            for path, start, end in zip(*(batch.column(k).to_pylist() for k in range(3))):
                fs, name = _open(path)
                rows, held = [], 0
                with fs.open_input_file(name) as source:
                    for at, head, block in scan(source, start, end):
                        row = _row(path, at, head, block, payloads)
                        if row is None:
                            continue
                        rows.append(dict(zip(schema.names, row)))
                        held += len(row[6] or b"")
                        if len(rows) == 4096 or held > BLOCK_BYTES * 16:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)
    return run


def _groups(pages: DataFrame, min_bytes: int) -> DataFrame:
    """``g_bytes, g_hash, top``: payloads that several pages have, and the largest page id."""
    keys = pages.select("bytes", "hash", "page_id").where(F.col("bytes") >= min_bytes)
    return (keys.groupBy(F.col("bytes").alias("g_bytes"), F.col("hash").alias("g_hash"))
            .agg(F.max("page_id").alias("top"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"))


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url",
                   html_col: str = "html", min_bytes: int = MIN_REVISIT_BYTES,
                   archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write a record per page below ``folder`` (a URI or absolute path that all executors
    share) and return the saved list of files, ``path, bytes, records``."""
    payload = F.coalesce(F.col(html_col).cast("binary"), F.lit(b""))
    keyed = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                         payload.alias("payload"), F.octet_length(payload).cast("long").alias("bytes"),
                         F.sha2(payload, 256).alias("hash"))
    groups = broadcast_if_small(save(_groups(keyed, min_bytes), "warc-groups"))
    marked = keyed.join(groups, (F.col("bytes") == F.col("g_bytes")) & (F.col("hash") == F.col("g_hash")), "left")
    revisit = F.col("g_hash").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("top"))
    rows = marked.select("page_id", "url", "payload", revisit.alias("revisit"),
                         F.when(revisit, F.col("top")).alias("refers_to"))
    return save(bounded_batches(rows).mapInArrow(_writer(folder, archive_bytes), FILES), "warc-files")


def read_archives(files: DataFrame, payloads: bool = True, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """The response and revisit records of archives (``path, bytes``), by byte ranges."""
    size = F.col("bytes")
    splits = files.where(size > 0).select(
        "path", F.explode(F.sequence(F.lit(0).cast("long"), size - 1, F.lit(split_bytes).cast("long"))).alias("start"),
        size.alias("size")).select("path", "start", F.least(F.col("start") + split_bytes, F.col("size")).alias("end"))
    # a range per task while they are few, and then several
    tasks = files.agg(F.sum(F.ceil(size / split_bytes))).first()[0] or 1
    spread = splits.repartition(int(min(tasks, 100_000)), "path", "start")
    return spread.mapInArrow(_reader(payloads), RECORDS)


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = write_archives(read_table(spark, sf_dir, "pages"), f"{work_dir(spark, 'llm-warc')}")
    return read_archives(files, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP12_SQL = r"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS payload_bytes,
         sha1(coalesce(html, '')) AS hex FROM pages),
t AS (SELECT *, max(page_id) OVER (PARTITION BY html) AS top FROM p)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         1 + ((('0x' || substr(hex, 1 + 5 * (i // 4), 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)::INT, 1)), '') AS payload_digest,
       CASE WHEN page_id IS NOT DISTINCT FROM top THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM top THEN top END AS refers_to
FROM t
"""
