"""Removal of repeated word passages, with fixed-block anchors.

A window is 35 consecutive words (unchanged) of one text. A word goes when it lies in a
window whose word sequence also starts anywhere else, in the same text or another.

1. Texts are put into blobs: rows of a few MB of compressed text, in shared storage.
2. Anchors. Each text's non-overlapping blocks of 18 words are the index; every rolling
   18-word window of all texts probes it. A repeated 35-word window always holds one
   whole block of its own text (35 = 2 * 18 - 1), so only blocks that a second rolling
   window hits can lie in a repeat. Hashes travel as sorted, delta-coded runs per (blob,
   bucket); each blob sends a value once, marked when it has it twice, so frequent
   passages don't pile up in a bucket. The answer is one bit per distinct block.
3. Extension. Each hit block is extended to all 35-word windows around it; those that
   start in two places, by their full 64-bit hash, are repeats. The same exchange
   answers with one bit per distinct window. Overlapping windows join to the maximal
   repeats of each text.

Probes in step 2 use 32 bits and the bucket; a chance hit there only adds a window to
step 3, which decides. With n windows around hits, a window is taken for a repeat by
chance with probability n / 2^64.

Defined cases: a null or empty text, or one of under 35 words, has no window and keeps
all its words; the digest of no words is that of the empty string; a repeated row is
another text, so its windows repeat; a null id is kept as it is; an empty table gives no
rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Words, bounded_batches, chunks, distinct, read_table, save, window_hashes

WINDOW = 35
BLOCK = (WINDOW + 1) // 2
BLOB_BYTES = 2 << 20
BUCKET_VALUES = 2_000_000      # probes a bucket should hold
MAX_BUCKET_BITS = 20
BROADCAST_BYTES = 32 << 20     # of answers, checked before they are broadcast


# ---------------------------------------------------------------------------
# Sorted integers as delta-coded, byte-planed, compressed runs

def pack(values: np.ndarray) -> bytes:
    deltas = np.diff(values, prepend=values.dtype.type(0))
    planes = deltas.view(np.uint8).reshape(len(deltas), values.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unpack(data: bytes, dtype) -> np.ndarray:
    width = np.dtype(dtype).itemsize
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(width, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(dtype).reshape(-1), dtype=dtype)


# ---------------------------------------------------------------------------
# Blobs

def _blobs(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(blob, ids, sizes, n_words, data): the texts of a few MB as one compressed row."""
    from pyspark import TaskContext
    schema = "blob long, ids array<long>, sizes array<long>, n_words long, data binary"

    def run(batches):
        task, k = TaskContext.get().partitionId(), 0
        pack_text = zstandard.ZstdCompressor(level=1)
        for batch, texts in chunks(batches, "text", BLOB_BYTES):
            yield pa.RecordBatch.from_pydict(
                {"blob": [(task << 32) + k], "ids": [batch.column(0).to_pylist()], "sizes": [[len(t) for t in texts]],
                 "n_words": [sum(len(t.split()) for t in texts)], "data": [pack_text.compress(b"".join(texts))]},
                schema=pa.schema([("blob", pa.int64()), ("ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())),
                                  ("n_words", pa.int64()), ("data", pa.binary())]))
            k += 1
    rows = bounded_batches(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, schema)


def _texts(sizes: list[int], data: bytes) -> list[bytes]:
    whole, at, out = zstandard.ZstdDecompressor().decompress(data), 0, []
    for n in sizes:
        out.append(whole[at:at + n])
        at += n
    return out


class Blob:
    """The hashes of one blob's texts."""

    def __init__(self, sizes, data):
        self.texts = _texts(sizes, data)
        self.words = Words(self.texts)
        self.h = self.words.hashes()
        left = self.words.left()
        long = np.repeat(self.words.counts >= WINDOW, self.words.counts)
        self.probe = np.flatnonzero(long & (left >= BLOCK))
        self.starts = np.flatnonzero(left >= WINDOW)
        place = np.arange(len(self.h)) - np.repeat(self.words.first[:-1], self.words.counts)
        self.probe_hash = window_hashes(self.h, BLOCK)[self.probe]
        self.anchored = place[self.probe] % BLOCK == 0

    def anchors(self, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct probes (bucket and 32 bits), which occur twice here, which are blocks."""
        value = self.probe_hash >> np.uint64(32 - bits)
        distinct, first, times = np.unique(value, return_index=True, return_counts=True)
        block = np.isin(distinct, value[self.anchored])
        return distinct, times > 1, block

    def candidates(self, bits: int, hot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts of the 35-word windows that hold a hit block, and their hashes. ``hot``:
        sorted values of the hit blocks."""
        value = self.probe_hash >> np.uint64(32 - bits)
        hit = self.anchored & np.isin(value, hot)
        mark = np.zeros(len(self.h) + 1, dtype=np.int32)
        at = self.probe[hit]
        # a window starting in (block - 17 .. block) of the same text holds the block
        low = np.maximum(at - (WINDOW - BLOCK), np.repeat(self.words.first[:-1], self.words.counts)[at])
        np.add.at(mark, low, 1)
        np.add.at(mark, at + 1, -1)
        near = np.cumsum(mark[:-1]) > 0
        starts = self.starts[near[self.starts]]
        return starts, window_hashes(self.h, WINDOW)[starts]


# ---------------------------------------------------------------------------
# The exchange: values by bucket, answers by blob

_RUNS = "bucket int, blob long, n long, values binary, twice binary, asked binary"


def _runs(blob: int, values: np.ndarray, twice: np.ndarray, asked: np.ndarray, bits: int, low_bits: int, dtype):
    """Rows of one blob: its sorted values cut by bucket (the bits above ``low_bits``)."""
    bucket = (values >> np.uint64(low_bits)).astype(np.int64)
    cuts = np.searchsorted(bucket, np.arange((1 << bits) + 1))
    used = np.flatnonzero(np.diff(cuts))
    low = (values & np.uint64((1 << low_bits) - 1)).astype(dtype)
    rows = [(int(b), blob, int(cuts[b + 1] - cuts[b]), pack(low[cuts[b]:cuts[b + 1]]),
             np.packbits(twice[cuts[b]:cuts[b + 1]]).tobytes(), np.packbits(asked[cuts[b]:cuts[b + 1]]).tobytes())
            for b in used]
    columns = list(zip(*rows)) or [[]] * 6
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                      [f.split()[0] for f in _RUNS.split(", ")])


def _answers(runs: DataFrame, dtype) -> DataFrame:
    """(blob, bucket, n, yes): for the asked values of each run, in order, whether the value
    occurs a second time anywhere."""
    def answer(table: pa.Table) -> pa.Table:
        n = table.column("n").to_pylist()
        values = [unpack(v, dtype) for v in table.column("values").to_pylist()]
        twice = [np.unpackbits(np.frombuffer(t, np.uint8), count=k).astype(bool)
                 for t, k in zip(table.column("twice").to_pylist(), n)]
        asked = [np.unpackbits(np.frombuffer(t, np.uint8), count=k).astype(bool)
                 for t, k in zip(table.column("asked").to_pylist(), n)]
        ranked = np.sort(np.concatenate([*values, *(v[t] for v, t in zip(values, twice))]))
        again = ranked[1:][ranked[1:] == ranked[:-1]]
        yes = []
        for v, a in zip(values, asked):
            mine = v[a]
            at = np.searchsorted(again, mine)
            found = np.zeros(len(mine), dtype=bool)
            inside = at < len(again)
            found[inside] = again[at[inside]] == mine[inside]
            yes.append(np.packbits(found).tobytes())
        return pa.table({"blob": table.column("blob"), "bucket": table.column("bucket"),
                         "n": pa.array([int(a.sum()) for a in asked], pa.int64()), "yes": pa.array(yes, pa.binary())})
    return runs.groupBy("bucket").applyInArrow(answer, "blob long, bucket int, n long, yes binary")


def _by_blob(answers: DataFrame, name: str) -> DataFrame:
    """One row per blob: its answers in bucket order."""
    rows = answers.groupBy("blob").agg(F.sort_array(F.collect_list(F.struct("bucket", "n", "yes"))).alias("answers"))
    return save(rows, name)


def _bits_of(answers) -> np.ndarray:
    return np.concatenate([np.zeros(0, bool)] + [np.unpackbits(np.frombuffer(a["yes"], np.uint8), count=a["n"]).astype(bool)
                                                 for a in answers or []])


def _with_answers(blobs: DataFrame, answers: DataFrame) -> DataFrame:
    """Blobs joined with their answers; the answers are broadcast only when measured small."""
    measured = answers.select(F.sum(F.aggregate("answers", F.lit(0).cast("long"),
                                                lambda s, a: s + 40 + F.octet_length(a["yes"])))).first()[0] or 0
    side = F.broadcast(answers) if measured <= BROADCAST_BYTES else answers
    return blobs.join(side, "blob", "left")


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = True) -> DataFrame:
    """Rows (doc_id, n_words, n_removed, kept_sha256, repeats, kept_text), one per input row;
    ``repeats`` has the maximal repeats as (start, end) word positions; ``with_text=False``
    leaves ``kept_text`` null."""
    blobs = save(_blobs(docs, id_col, text_col), "passage-blobs")
    total = blobs.agg(F.sum("n_words")).first()[0] or 0
    bits = min(MAX_BUCKET_BITS, max(4, int(np.ceil(np.log2(max(1, total / BUCKET_VALUES))))))

    def probe(batches):
        for batch in batches:
            for row in batch.to_pylist():
                values, twice, block = Blob(row["sizes"], row["data"]).anchors(bits)
                yield _runs(row["blob"], values, twice, block, bits, 32, np.uint32)
    hits = _by_blob(_answers(blobs.mapInArrow(probe, _RUNS), np.uint32), "passage-hits")

    def extend(batches):
        for batch in batches:
            for row in batch.to_pylist():
                blob = Blob(row["sizes"], row["data"])
                values, _, block = blob.anchors(bits)
                _, h = blob.candidates(bits, values[block][_bits_of(row["answers"])])
                distinct, times = np.unique(h, return_counts=True)
                yield _runs(row["blob"], distinct, times > 1, np.ones(len(distinct), bool), bits, 64 - bits, np.uint64)
    found = _by_blob(_answers(_with_answers(blobs, hits).mapInArrow(extend, _RUNS), np.uint64), "passage-windows")

    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string, " \
        "repeats array<struct<start:long,end:long>>, kept_text string"
    kind = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
                      ("kept_sha256", pa.string()),
                      ("repeats", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                      ("kept_text", pa.string())])

    def remove(batches):
        for batch in batches:
            for row in batch.to_pylist():
                blob = Blob(row["sizes"], row["data"])
                values, _, block = blob.anchors(bits)
                starts, h = blob.candidates(bits, values[block][_bits_of(row["hits"])])
                again = distinct(h)[_bits_of(row["answers"])]
                yield pa.RecordBatch.from_pydict(_without(blob, row["ids"], starts[np.isin(h, again)], with_text), schema=kind)
    both = _with_answers(_with_answers(blobs, hits).withColumnRenamed("answers", "hits"), found)
    return both.mapInArrow(remove, schema)


def _without(blob: Blob, ids, starts: np.ndarray, with_text: bool) -> dict:
    """The output rows of a blob's texts without the windows that begin at ``starts``."""
    mark = np.zeros(len(blob.h) + 1, dtype=np.int32)
    np.add.at(mark, starts, 1)
    np.add.at(mark, starts + WINDOW, -1)
    gone = np.cumsum(mark[:-1]) > 0
    first = blob.words.first
    out: dict = {"doc_id": ids, "n_words": blob.words.counts, "n_removed": [], "kept_sha256": [], "repeats": [],
                 "kept_text": []}
    for d, text in enumerate(blob.texts):
        own = gone[first[d]:first[d + 1]]
        words, spans, removed = text.split(), [], int(own.sum())
        if removed:
            edges = np.flatnonzero(np.diff(np.concatenate([[0], own.view(np.int8), [0]])))
            spans = [{"start": int(a), "end": int(b)} for a, b in edges.reshape(-1, 2)]
            at, kept = 0, []
            for span in spans:
                kept += words[at:span["start"]]
                at = span["end"]
            words = kept + words[at:]
        kept_text = b" ".join(words)
        out["n_removed"].append(removed)
        out["kept_sha256"].append(hashlib.sha256(kept_text).hexdigest())
        out["repeats"].append(spans)
        out["kept_text"].append(kept_text.decode() if with_text else None)
    out["n_words"] = pa.array(out["n_words"], pa.int64())
    return out


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(read_table(spark, sf_dir, "documents"), with_text=False) \
        .select("doc_id", "n_words", "n_removed", "kept_sha256")


OP7_SQL = r"""
WITH texts AS (
  SELECT doc_id, row_number() OVER () AS row, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
starts AS (
  SELECT row, i, array_to_string(w[i:i + 34], ' ') AS win
  FROM (SELECT row, w, unnest(generate_series(1, len(w) - 34)) AS i FROM texts WHERE len(w) >= 35) t),
again AS (
  SELECT row, i FROM (SELECT row, i, count(*) OVER (PARTITION BY win) AS n FROM starts) s WHERE n > 1),
marked AS (
  SELECT p.row, p.i, p.word,
         max(CASE WHEN a.i IS NOT NULL THEN p.i END)
           OVER (PARTITION BY p.row ORDER BY p.i ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) IS NOT NULL AS gone
  FROM (SELECT row, unnest(generate_series(1, len(w))) AS i, unnest(w) AS word FROM texts) p
  LEFT JOIN again a ON a.row = p.row AND a.i = p.i)
SELECT any_value(t.doc_id) AS doc_id, any_value(len(t.w)) AS n_words, count(CASE WHEN m.gone THEN 1 END) AS n_removed,
       sha256(coalesce(string_agg(CASE WHEN NOT m.gone THEN m.word END, ' ' ORDER BY m.i), '')) AS kept_sha256
FROM texts t LEFT JOIN marked m ON m.row = t.row GROUP BY t.row
"""
