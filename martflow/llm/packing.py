"""Best-fit-decreasing packing of documents into sequences of ``max_tokens``.

A document is its token ids and the end id. Longer documents are cut into pieces of
``max_tokens``; the first piece takes what is left over. Pieces are packed longest
first, each into the open sequence with the tightest room.

Best-fit decreasing depends on lengths only, so the plan is made from the histogram of
lengths, which has at most ``max_tokens`` entries whatever the corpus: a segment tree
over the remaining capacities finds the tightest one with an open sequence in
logarithmic time, and equal pieces that would land in equal sequences are placed as one
run. The runs say, for the k-th piece of a length, its sequence and place. Ranks within
a length are a per-task count plus an offset per (length, task), so no length's pieces
meet in one task. The result is the same as placing every document on its own.

Defined cases: a null or empty text is the end id alone (one piece of length 1); an
empty table gives no rows; repeated rows are packed each; a null id is kept; extra
columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import bounded_batches, chunks, read_table, save
from .tokens import default_path, encoder

MAX_TOKENS = 1024
END_ID = 2

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, task int, local_rank long"


def cut(n: int, max_tokens: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``n`` tokens, the shorter one first."""
    first = n % max_tokens or max_tokens
    return [(0, first)] + [(at, max_tokens) for at in range(first, n, max_tokens)]


def pieces(docs: DataFrame, id_col: str, text_col: str, path: str, max_tokens: int, end_id: int) -> DataFrame:
    def run(batches):
        codec = encoder(path)
        task = TaskContext.get().partitionId()
        seen = np.zeros(max_tokens + 1, dtype=np.int64)
        for batch, texts in chunks(batches, "text"):
            out = []
            for doc_id, text in zip(batch.column(0).to_pylist(), texts):
                ids = np.append(codec.ids(text.decode()), np.uint32(end_id)).astype("<u4")
                raw = ids.tobytes()
                for k, (at, n) in enumerate(cut(len(ids), max_tokens)):
                    out.append((doc_id, k, at, n, zlib.crc32(raw[4 * at:4 * (at + n)]), task, int(seen[n])))
                    seen[n] += 1
            columns = list(zip(*out))
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                             [f.split()[0] for f in PIECES.split(", ")])
    return bounded_batches(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")) \
        .mapInArrow(run, PIECES)


class RoomTree:
    """Segment tree over capacities 0..size: which of them have an open sequence."""

    def __init__(self, size: int):
        self.leaves = 1 << (size + 1).bit_length()
        self.open = [0] * (2 * self.leaves)

    def set(self, room: int, count: int) -> None:
        at = self.leaves + room
        self.open[at] = count
        while at > 1:
            at //= 2
            self.open[at] = self.open[2 * at] + self.open[2 * at + 1]

    def tightest(self, need: int) -> int:
        """The smallest capacity >= ``need`` with an open sequence, or -1."""
        at = self.leaves + need
        if self.open[at]:
            return need
        while at > 1:
            if at % 2 == 0 and self.open[at + 1]:
                at += 1
                while at < self.leaves:
                    at = 2 * at if self.open[2 * at] else 2 * at + 1
                return at - self.leaves
            at //= 2
        return -1


def plan_runs(counts: dict[int, int], max_tokens: int) -> dict[int, np.ndarray]:
    """{length: rows (first rank, first sequence, pieces per sequence, offset)}: piece k of
    that length, in the run with the last first rank <= k, goes to sequence ``first
    sequence + (k - first rank) // pieces``, at ``offset + (k - first rank) % pieces *
    length``."""
    tree, ranges = RoomTree(max_tokens), {}
    n_open, runs = {}, {}
    sequences = 0

    def put(room: int, lo: int, hi: int) -> None:
        if hi > lo:
            ranges.setdefault(room, []).append((lo, hi))
            n_open[room] = n_open.get(room, 0) + hi - lo
            tree.set(room, n_open[room])

    for length in sorted((n for n, c in counts.items() if c), reverse=True):
        left, rank, rows = counts[length], 0, []
        while left:
            room = tree.tightest(length)
            if room < 0:
                room = max_tokens
                fresh = -(-left // (room // length))
                lo, hi = sequences, sequences + fresh
                sequences = hi
            else:
                lo, hi = ranges[room].pop(0)
                n_open[room] -= hi - lo
                tree.set(room, n_open[room])
            per = room // length
            rows.append((rank, lo, per, max_tokens - room))
            used = min(left, (hi - lo) * per)
            full, over = divmod(used, per)
            put(room - per * length, lo, lo + full)
            if over:
                put(room - over * length, lo + full, lo + full + 1)
            rest = lo + full + bool(over)
            if rest < hi:
                ranges.setdefault(room, []).insert(0, (rest, hi))
                n_open[room] = n_open.get(room, 0) + hi - rest
                tree.set(room, n_open[room])
            left -= used
            rank += used
        runs[length] = np.array(rows, dtype=np.int64)
    return runs


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None,
         max_tokens: int = MAX_TOKENS, end_id: int = END_ID) -> DataFrame:
    """Rows (doc_id, piece, start, length, ids_crc32, sequence_id, offset), one per piece."""
    cut_up = save(pieces(docs, id_col, text_col, path or default_path(), max_tokens, end_id), "pack-pieces")
    by_task = cut_up.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n"))
    counts = {r["length"]: r["n"] for r in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs = plan_runs(counts, max_tokens)
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    base = by_task.select("length", "task", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    ranked = cut_up.join(base, ["length", "task"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("local_rank")).alias("rank"))

    def place(batches):
        for batch in batches:
            n, rank = (batch.column(k).to_numpy() for k in (3, 5))
            sequence, offset = np.zeros(len(n), np.int64), np.zeros(len(n), np.int64)
            order = np.argsort(n, kind="stable")
            cuts = np.flatnonzero(np.diff(n[order])) + 1
            for own in np.split(order, cuts) if len(n) else []:
                length = int(n[own[0]])
                table = runs[length]
                at = table[np.searchsorted(table[:, 0], rank[own], side="right") - 1]
                k = rank[own] - at[:, 0]
                sequence[own] = at[:, 1] + k // at[:, 2]
                offset[own] = at[:, 3] + k % at[:, 2] * length
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(sequence), pa.array(offset)],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])
    return ranked.mapInArrow(
        place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read_table(spark, sf_dir, "documents"))
