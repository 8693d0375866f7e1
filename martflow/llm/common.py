"""Helpers shared by the operators of this package.

Text rule used throughout: a word is a run of bytes outside space and
0x09-0x0D (``[^\\x20\\x09-\\x0D]+``); null text counts as empty.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martflow.session import work_dir

WORD_PATTERN = r"[^\x20\x09-\x0D]+"

# Text handed to numpy at a time: bounds a Python worker's memory whatever the
# size of an Arrow batch (one document longer than this is a chunk of its own).
CHUNK_BYTES = 1 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def save(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below ``spark.checkpoint.dir`` and read it back.

    Cuts lineage on storage that every executor sees, so a lost executor costs
    a re-read, not a recomputation."""
    path = f"{work_dir(df.sparkSession, 'llm')}/{name}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_names(df: DataFrame, *names: str) -> list[str]:
    """``names``, each with as many further underscores as it takes not to be a column of
    ``df`` (names are compared without case, as Spark does)."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


BROADCAST_ROWS = 500_000  # narrow rows (a few longs): tens of MB as a hash table


def broadcast_if_small(saved: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast of a narrow saved table only when its row count, read from the
    files, is within ``max_rows``; beyond it the planner's shuffle join is used."""
    return F.broadcast(saved) if saved.limit(max_rows + 1).count() <= max_rows else saved


ARROW_BATCH_BYTES = 4 << 20


def bounded_batches(df: DataFrame) -> DataFrame:
    """``df``, in a session whose Arrow batches hold at most a few MB: long texts would
    otherwise come to a Python worker 64 MB at a time. A smaller setting is left alone."""
    key, conf = "spark.sql.execution.arrow.maxBytesPerBatch", df.sparkSession.conf
    if int(str(conf.get(key)).rstrip("b")) > ARROW_BATCH_BYTES:
        conf.set(key, str(ARROW_BATCH_BYTES))
    return df


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def as_bytes(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of each text, null as empty."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def chunks(batches: Iterator[pa.RecordBatch], text: str,
           max_bytes: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Cut Arrow batches into row runs of at most ``max_bytes`` of text."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text))
        ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < batch.num_rows:
            done = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, done + max_bytes, side="right")))
            yield batch.slice(at, to - at), as_bytes(column.slice(at, to - at))
            at = to


def map_texts(df: DataFrame, text: str, make: Callable[[], Callable], schema: str) -> DataFrame:
    """``mapInArrow`` with bounded chunks: ``make()`` runs once per task and returns
    ``f(batch, texts) -> RecordBatch``; rows without texts never reach it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = make()
        for batch, texts in chunks(batches, text):
            yield f(batch, texts)
    return bounded_batches(df).mapInArrow(run, schema)


# ---------------------------------------------------------------------------
# Flat word arrays: the words of many texts as numpy arrays, with 64-bit hashes.

def _is_space() -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
    return table


SPACE = _is_space()
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit finaliser (xor-shift-multiply), seeded."""
    x = x ^ np.uint64((seed * 0xD1B54A32D192ED03 + 0x2545F4914F6CDD1D) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


HASH_BYTES = 1 << 16        # bytes hashed at a time: the arrays stay in a core's cache
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        for k, base in enumerate((_BASE, _BASE_INVERSE)):
            steps = np.full(max(n, 2 * HASH_BYTES), base, dtype=np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps)
    return _powers[0], _powers[1]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte spans [starts, ends) of ``data``; spans are in order
    and don't overlap. Prefix sums of bytes times powers of an odd base give each span's
    polynomial; a finaliser mixes it with the span's length."""
    out = np.zeros(len(starts), dtype=np.uint64)
    at = 0
    while at < len(starts):
        first = int(starts[at])
        to = max(at + 1, int(np.searchsorted(ends, first + HASH_BYTES, side="right")))
        n = int(ends[to - 1]) - first
        power, inverse = _power_tables(n + 1)
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(np.multiply(data[first:first + n], power[:n], dtype=np.uint64), out=sums[1:])
        s, e = starts[at:to] - first, ends[at:to] - first
        out[at:to] = (sums[e] - sums[s]) * inverse[s]
        at = to
    return mix(out, 1) ^ mix((ends - starts).astype(np.uint64), 2)


class Words:
    """The words of ``texts`` in order: byte ``starts`` and ``ends`` in ``data`` and
    ``first[d]:first[d + 1]``, the words of text d. ``offsets`` has the texts' bytes."""

    def __init__(self, texts: list[bytes]):
        joined = b"\n".join(texts) + b"\n"
        self.data = np.frombuffer(joined, dtype=np.uint8)
        self.offsets = np.zeros(len(texts) + 1, dtype=np.int64)
        np.cumsum([len(t) + 1 for t in texts], out=self.offsets[1:])
        space = np.ones(len(joined) + 1, dtype=np.int8)
        space[1:] = SPACE[self.data]
        change = np.diff(space)
        self.starts = np.flatnonzero(change == -1)
        self.ends = np.flatnonzero(change == 1)
        self.first = np.searchsorted(self.starts, self.offsets)
        self.counts = np.diff(self.first)

    def hashes(self, lower: bool = False) -> np.ndarray:
        """Of the words as they are, or lower-cased A-Z."""
        data = np.frombuffer(self.data.tobytes().lower(), dtype=np.uint8) if lower else self.data
        return span_hashes(data, self.starts, self.ends)

    def doc_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def left(self) -> np.ndarray:
        """Words from each word to its text's end, itself included."""
        return np.repeat(self.first[1:], self.counts) - np.arange(len(self.starts))


def distinct(x: np.ndarray) -> np.ndarray:
    """Sorted distinct values, by sorting."""
    x = np.sort(x)
    new = np.ones(len(x), dtype=bool)
    new[1:] = x[1:] != x[:-1]
    return x[new]


_STEP = 0xA0761D6478BD642F | 1


def window_hashes(h: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` consecutive items, by doubling; positions within
    ``width - 1`` of the end are meaningless (callers mask by text ends anyway)."""
    n = len(h)
    out, have, block, size = np.zeros(n, np.uint64), 0, h.copy(), 1
    rest = width
    while rest:
        if rest & 1:
            factor = np.uint64(pow(_STEP, have, 1 << 64))
            if have < n:
                out[:n - have] += block[have:] * factor
            have += size
        rest >>= 1
        if rest:
            factor = np.uint64(pow(_STEP, size, 1 << 64))
            if size < n:
                block[:n - size] = block[:n - size] + block[size:] * factor
            size *= 2
    return mix(out, width)
