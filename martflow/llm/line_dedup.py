"""Line dedup by an exact set-similarity join.

A line (cut at line feeds) is the set of its distinct words, lower-cased A-Z. A line is
removed when an earlier line, in order of document id and position, has a Jaccard
similarity of at least ``PERCENT`` / 100 with it, whether or not that one stays.

1. Texts go into blobs of a few MB, with a hash of each line's word sequence and the
   blob's word counts in a table of fixed size. Lines of the same sequence are one class;
   its first line leads it and all others are removed. Only leaders go on, so a frequent
   line is compared once.
2. Words are ordered by their count (summed over all blobs, by hash) and then by hash:
   one fixed order for all lines, rare words first, which is all that the filters need.
3. Prefix filter: two lines can only match when they share one of their first
   s - ceil(t s) + 1 words. Leaders meet in the buckets of these words, where the length
   filter, the positional filter (words left behind the shared one) and a bound from
   128-bit signatures (a bit that only one line has is a word that only it has; common
   words, which long lines share anyway, have few of the bits) leave few pairs.
4. Remaining pairs are verified on the full word sets. A line needs one earlier match, so
   at first only its ``FIRST_TRIES`` closest candidates of a word go on, the closest of all
   its words before the others. Lines without a match that had more are tried against all
   their candidates in a second pass, inside the bucket's task, which gets the texts of the
   lines whose size lets them match, and stops at a line's first match. Where a word has very many lines, each meets ``NEIGHBOURS`` of them at
   first, and those without a match meet the rest in the second pass. Nothing is lost;
   both passes hold a bounded number of pairs, and a group of variants isn't expanded into
   its pairs. A word's postings meet in one task, which is linear in their number.

Defined cases: a null text has no line; lines without words are never removed and match
nothing; a repeated row is a later document, ties of ids go by the rows' place in the
input; null ids come first; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Words, bounded_batches, chunks, distinct, mix, read_table, save
from .substring_dedup import BLOB_BYTES, BROADCAST_BYTES, pack, unpack

PERCENT = 80
COUNTERS_LOG2 = 18
FIRST_TRIES = 5
NEIGHBOURS = 1 << 13           # lines of a word that a line meets at first
ID_BITS = 44                   # of a word: 14 of frequency, 30 of hash
BUCKET_WORDS = 3_000_000       # words of text whose prefixes a bucket should hold
MAX_BUCKET_BITS = 16
PAIR_BLOCK = 1 << 18           # pairs compared at a time in a bucket
SETS_KEPT = 100_000            # word sets of lines that a bucket of the second pass keeps
FEWER_BITS = 2                 # a bucket of the second pass holds so many (log 2) of the first
SLOTS_LOG2 = 20                # of the table of words that the second pass looks at
COMMON_SHARE, COMMON_BITS = 0.6, 16     # of occurrences that common words have, and of a signature's bits
FIRST_ID = -(1 << 63)          # where null ids are ordered


def _order_ids(ids) -> np.ndarray:
    return np.array([FIRST_ID if i is None else i for i in ids], np.int64)


# ---------------------------------------------------------------------------
# Blobs

class Lines:
    """The lines with words of a blob's texts: ``doc`` (index of the text), ``number`` in
    it, byte ``begin`` and ``end``, and their words ``first:last``."""

    def __init__(self, texts: list[bytes]):
        self.words = Words(texts)
        ends = np.flatnonzero(self.words.data == 0x0A)
        starts = np.concatenate([[0], ends[:-1] + 1]) if len(ends) else ends
        first, last = np.searchsorted(self.words.starts, starts), np.searchsorted(self.words.starts, ends)
        doc = np.searchsorted(self.words.offsets, starts, side="right") - 1
        number = np.arange(len(starts)) - np.searchsorted(starts, self.words.offsets)[doc]
        full = last > first
        self.doc, self.number, self.begin, self.end = doc[full], number[full], starts[full], ends[full]
        self.first, self.last = first[full], last[full]

    @functools.cached_property
    def h(self) -> np.ndarray:
        """Hashes of the words."""
        return self.words.hashes(lower=True)

    def sequences(self) -> np.ndarray:
        """A hash of each line's words in order."""
        place = np.arange(len(self.h)) - np.repeat(self.first, self.last - self.first)
        sums = np.concatenate([[np.uint64(0)], np.cumsum(mix(self.h ^ mix(place.astype(np.uint64), 56), 57))])
        return mix(sums[self.last] - sums[self.first], 58) ^ mix((self.last - self.first).astype(np.uint64), 59)


_BLOB = "blob long, ids array<long>, sizes array<long>, n_words long, data binary, docs binary, numbers binary, " \
    "sequences binary, slots binary, slot_counts binary"
_BLOB_KINDS = pa.schema([("blob", pa.int64()), ("ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())),
                         ("n_words", pa.int64()), *((c, pa.binary()) for c in
                                                    ("data", "docs", "numbers", "sequences", "slots", "slot_counts"))])


def _blobs(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    def run(batches):
        task, k = TaskContext.get().partitionId(), 0
        squeeze = zstandard.ZstdCompressor(level=1)
        for batch, texts in chunks(batches, "text", BLOB_BYTES):
            lines = Lines(texts)
            counts = np.bincount((lines.h >> np.uint64(64 - COUNTERS_LOG2)).astype(np.int64), minlength=1 << COUNTERS_LOG2)
            slots = np.flatnonzero(counts)
            yield pa.RecordBatch.from_pydict(
                {"blob": [(task << 32) + k], "ids": [batch.column(0).to_pylist()], "sizes": [[len(t) for t in texts]],
                 "n_words": [len(lines.h)], "data": [squeeze.compress(b"".join(texts))],
                 "docs": [pack(lines.doc.astype(np.uint32))], "numbers": [pack(lines.number.astype(np.uint32))],
                 "sequences": [pack(lines.sequences())], "slots": [pack(slots.astype(np.uint32))],
                 "slot_counts": [pack(counts[slots].astype(np.uint32))]}, schema=_BLOB_KINDS)
            k += 1
    rows = bounded_batches(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, _BLOB)


def _texts(row) -> list[bytes]:
    whole, at, out = zstandard.ZstdDecompressor().decompress(row["data"]), 0, []
    for n in row["sizes"]:
        out.append(whole[at:at + n])
        at += n
    return out


def word_counts(blobs: DataFrame) -> np.ndarray:
    """Occurrences of all words by hash, in a table of fixed size, summed by Spark."""
    def run(batches):
        total = np.zeros(1 << COUNTERS_LOG2, np.int64)
        for batch in batches:
            for row in batch.to_pylist():
                np.add.at(total, unpack(row["slots"], np.uint32), unpack(row["slot_counts"], np.uint32).astype(np.int64))
        slots = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(slots, pa.int32()), pa.array(total[slots])], ["slot", "n"])
    table = blobs.select("slots", "slot_counts").mapInArrow(run, "slot int, n long") \
        .groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(1 << COUNTERS_LOG2, np.int64)
    out[table.column("slot").to_numpy()] = table.column("n").to_numpy()
    return out


def _leaders(blobs: DataFrame) -> DataFrame:
    """(blob, leaders): the places of the lines of each blob that lead their class."""
    schema = "sequence long, doc long, line int, blob long, place int"

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                sequence, doc = unpack(row["sequences"], np.uint64), unpack(row["docs"], np.uint32)
                number, ids = unpack(row["numbers"], np.uint32).astype(np.int64), _order_ids(row["ids"])
                # the blob's first line of each class stands for the others
                order = np.lexsort((np.arange(len(doc)), number, ids[doc], sequence))
                new = np.ones(len(order), bool)
                new[1:] = sequence[order[1:]] != sequence[order[:-1]]
                own = order[new]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(sequence[own].view(np.int64)), pa.array(ids[doc[own]]), pa.array(number[own], pa.int32()),
                     pa.array(np.full(len(own), row["blob"]), pa.int64()), pa.array(own, pa.int32())],
                    [f.split()[0] for f in schema.split(", ")])
    firsts = blobs.select("blob", "ids", "docs", "numbers", "sequences").mapInArrow(run, schema)
    tops = firsts.groupBy("sequence").agg(F.min(F.struct("doc", "line", "blob", "place")).alias("top"))
    return tops.groupBy("top.blob").agg(F.collect_list("top.place").alias("leaders"))


def _beside(blobs: DataFrame, lists: DataFrame) -> DataFrame:
    """Blobs joined with a saved (blob, array<int>) table, broadcast only when measured small."""
    name = next(c for c in lists.columns if c != "blob")
    measured = lists.agg(F.sum(40 + 4 * F.size(name))).first()[0] or 0
    return blobs.join(F.broadcast(lists) if measured <= BROADCAST_BYTES else lists, "blob", "left")


# ---------------------------------------------------------------------------
# Candidates

class WordSets:
    """Distinct words of the leading lines, in rarity order; ``order`` is that of :func:`_word_order`."""

    def __init__(self, lines: Lines, leaders: np.ndarray, order: tuple[np.ndarray, int]):
        ranks, self.common = order
        n = (lines.last - lines.first)[leaders]
        owner = np.repeat(np.arange(len(leaders)), n)
        at = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lines.first[leaders], n)
        h = lines.h[at]
        # ids by rarity: the count's magnitude, then the hash
        rank = ranks[(h >> np.uint64(64 - COUNTERS_LOG2)).astype(np.int64)]
        word = (rank << np.uint64(30)) | (h & np.uint64((1 << 30) - 1))
        self.owner, self.word = _distinct_by_line(owner, word)
        self.size = np.bincount(self.owner, minlength=len(leaders))
        self.begin = np.concatenate([[0], np.cumsum(self.size)])
        self.place = np.arange(len(self.word)) - self.begin[self.owner]

    def prefix(self) -> np.ndarray:
        keep = self.size - -(-PERCENT * self.size // 100) + 1
        return np.flatnonzero(self.place < keep[self.owner])

    def signatures(self) -> tuple[np.ndarray, np.ndarray]:
        h, rare = mix(self.word, 54) >> np.uint64(32), np.uint64(128 - COMMON_BITS)
        bit = np.where((self.word >> np.uint64(30)) < np.uint64(self.common), (h * rare) >> np.uint64(32),
                       rare + ((h * np.uint64(COMMON_BITS)) >> np.uint64(32)))
        one, upper = np.uint64(1) << (bit & np.uint64(63)), (bit & np.uint64(64)) != 0
        zero = np.uint64(0)
        if not len(self.size):
            return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        return (np.bitwise_or.reduceat(np.where(upper, zero, one), self.begin[:-1]),
                np.bitwise_or.reduceat(np.where(upper, one, zero), self.begin[:-1]))


def _ranks(counts: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(counts + 1.0) * 400, 16383).astype(np.uint64)


def _word_order(counts: np.ndarray) -> tuple[np.ndarray, int]:
    """The rank of each slot of words, and the one from which words are common."""
    down = np.sort(counts)[::-1]
    sums = np.cumsum(down)
    at = min(int(np.searchsorted(sums, COMMON_SHARE * sums[-1])), len(down) - 1)
    return _ranks(counts), int(_ranks(down[at:at + 1])[0]) + 1


def _distinct_by_line(owner: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct words of each line in order; lines in slices so that one sort key holds both."""
    owners, words, at = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)], 0
    step = 1 << (64 - ID_BITS)
    n = int(owner[-1]) + 1 if len(owner) else 0
    for low in range(0, n, step):
        to = np.searchsorted(owner, low + step)
        key = distinct(((owner[at:to] - low).astype(np.uint64) << np.uint64(ID_BITS)) | word[at:to])
        owners.append((key >> np.uint64(ID_BITS)).astype(np.int64) + low)
        words.append(key & np.uint64((1 << ID_BITS) - 1))
        at = to
    return np.concatenate(owners), np.concatenate(words)


_POSTING = [("token", np.uint32), ("doc", np.uint64), ("line", np.uint32), ("leader", np.uint32), ("size", np.uint32),
            ("place", np.uint32), ("low", np.uint64), ("high", np.uint64)]


def _ones(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x).astype(np.int64)


def _only(c: dict, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many words only the left lines have, and only the right ones, at least."""
    low_l, low_r, high_l, high_r = c["low"][left], c["low"][right], c["high"][left], c["high"][right]
    return _ones(low_l & ~low_r) + _ones(high_l & ~high_r), _ones(low_r & ~low_l) + _ones(high_r & ~high_l)


def _reach(c: dict) -> np.ndarray:
    """Each line meets the following ones of the same word that are at most 1/t times as long:
    the place where these end. ``c`` has the postings sorted by word and size."""
    key, size = c["token"].astype(np.uint64) << np.uint64(32), c["size"].astype(np.int64)
    return np.searchsorted(key | size.astype(np.uint64), key | (size * 100 // PERCENT).astype(np.uint64), side="right")


def _candidates(c: dict, reach: np.ndarray, neighbours: int = 0, wanted: np.ndarray | None = None) \
        -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Candidate pairs of one bucket, of about ``PAIR_BLOCK`` compared at a time: rows of the
    later and the earlier line, and how far apart their signatures are at least. A line meets
    at most ``neighbours`` following ones. With ``wanted``, read anew for every block, the
    lines that it marks are the later ones, and meet all others."""
    n = len(c["token"])
    size, place, doc, line = c["size"].astype(np.int64), c["place"].astype(np.int64), c["doc"].view(np.int64), c["line"]
    if wanted is None:
        rows, begin = np.arange(n), np.arange(1, n + 1)
        finish = np.minimum(reach, begin + neighbours)
    else:
        rows = np.flatnonzero(wanted)
        begin, finish = np.searchsorted(reach, rows, side="right"), reach[rows]
    ends = np.cumsum(finish - begin)
    at = 0
    while at < len(rows):
        # lines with a bounded number of pairs together
        done = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, done + PAIR_BLOCK, side="right")))
        some = np.arange(at, to)
        if wanted is not None:
            some = some[wanted[rows[some]]]
        at, width = to, finish[some] - begin[some]
        left = np.repeat(rows[some], width)
        right = np.repeat(begin[some] - np.cumsum(width) + width, width) + np.arange(len(left))
        own = left
        if wanted is not None:
            left, right = np.minimum(left, right), np.maximum(left, right)
        need = -(-PERCENT * (size[left] + size[right]) // (100 + PERCENT))     # common words a match must have
        a, b = place[left], place[right]
        ok = np.minimum(a, b) + np.minimum(size[left] - a, size[right] - b) >= need
        left, right, need, own = left[ok], right[ok], need[ok], own[ok]
        only_left, only_right = _only(c, left, right)
        ok = (size[left] - only_left >= need) & (size[right] - only_right >= need)
        left, right, own, apart = left[ok], right[ok], own[ok], (only_left + only_right)[ok]
        swap = (doc[left] > doc[right]) | ((doc[left] == doc[right]) & (line[left] > line[right])) \
            | ((doc[left] == doc[right]) & (line[left] == line[right])
               & ((c["blob"][left] > c["blob"][right])
                  | ((c["blob"][left] == c["blob"][right]) & (c["leader"][left] > c["leader"][right]))))
        later, earlier = np.where(swap, left, right), np.where(swap, right, left)
        apart = apart / (size[left] + size[right])
        if wanted is not None:
            ok = (later == own) & (earlier != own)
            later, earlier, apart = later[ok], earlier[ok], apart[ok]
        yield later, earlier, apart


def _closest(blocks: Iterable[tuple], tries: int, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``tries`` closest candidates of each line, and whether it had more. Pairs are cut to
    these as they come, so no more than ``tries`` a line and a few blocks are held."""
    kept = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
    met, waiting, held = np.zeros(n, np.int64), [], 0

    def cut():
        later, earlier, apart = (np.concatenate(x) for x in zip(kept, *waiting))
        order = np.lexsort((apart, later))
        later = later[order]
        start = np.ones(len(later), bool)
        start[1:] = later[1:] != later[:-1]
        rank = np.arange(len(later)) - np.maximum.accumulate(np.where(start, np.arange(len(later)), 0))
        take = order[rank < tries]
        kept[:] = later[rank < tries], earlier[take], apart[take]
        waiting.clear()
    for block in blocks:
        np.add.at(met, block[0], 1)
        waiting.append(block)
        held += len(block[0])
        if held > max(PAIR_BLOCK, len(kept[0])):
            cut()
            held = 0
    cut()
    return kept[0], kept[1], (met > tries)[kept[0]]


def _posting_rows(row, lines: Lines, sets: WordSets, leaders, bits: int,
                  slots: tuple[np.ndarray, np.ndarray] | None = None, fewer_bits: int = 0) -> tuple:
    """(buckets, arrays by column) of a blob's postings; ``slots`` has the smallest and the
    largest line that is looked at by slot, and keeps only the lines that can match one of
    such sizes, ``fewer_bits`` joins buckets."""
    at = sets.prefix()
    value = mix(sets.word[at], 55) >> np.uint64(32 - bits)
    if slots is not None:
        slot, size = _slot(value), sets.size[sets.owner[at]]
        ok = (100 * size >= PERCENT * slots[0][slot]) & (PERCENT * size <= 100 * slots[1][slot])
        at, value = at[ok], value[ok]
    own = sets.owner[at]
    low, high = sets.signatures()
    doc = _order_ids(row["ids"])[lines.doc[leaders]]
    column = {"token": value & np.uint64((1 << 32) - 1), "doc": doc.view(np.uint64)[own], "line": lines.number[leaders][own],
              "leader": leaders[own], "size": sets.size[own], "place": sets.place[at], "low": low[own], "high": high[own]}
    bucket = (value >> np.uint64(32 + fewer_bits)).astype(np.int32)
    order = np.argsort(bucket, kind="stable")           # by line within a bucket, so ids pack well
    cuts = np.searchsorted(bucket[order], np.arange((1 << (bits - fewer_bits)) + 1))
    used = np.flatnonzero(np.diff(cuts))
    return used, {n: [column[n][order][cuts[b]:cuts[b + 1]].astype(k) for b in used] for n, k in _POSTING}


def _slot(value: np.ndarray) -> np.ndarray:
    return (mix(value, 60) >> np.uint64(64 - SLOTS_LOG2)).astype(np.int64)


def _joined(table: pa.Table) -> dict:
    """A bucket's postings, sorted by word and size."""
    runs = {name: [unpack(v, kind) for v in table.column(name).to_pylist()] for name, kind in _POSTING}
    c = {name: np.concatenate(v) for name, v in runs.items()}
    c["blob"] = np.repeat(table.column("blob").to_numpy(), [len(v) for v in runs["token"]])
    del runs
    order = np.argsort((c["token"].astype(np.uint64) << np.uint64(32)) | c["size"], kind="stable")
    return {k: v[order] for k, v in c.items()}


_SIDES = ["x_blob", "x_place", "y_blob", "y_place"]
_PAIR = "x_blob long, x_place int, y_blob long, y_place int, slot int, x_size int, apart int"
_POSTED = "bucket int, blob long, " + ", ".join(f"{n} binary" for n, _ in _POSTING)


def _pairs(blobs: DataFrame, counts, bits: int) -> DataFrame:
    """(x_blob, x_place, y_blob, y_place, slot, x_size, apart): the closest candidate pairs of
    leaders, x the later line; ``slot`` is that of a word for which x had more, else -1. A row
    with y -1 only says that x may have more."""
    context = blobs.sparkSession.sparkContext.broadcast(_word_order(counts))   # fixed size

    def post(batches):
        for batch in batches:
            for row in batch.to_pylist():
                lines, leaders = Lines(_texts(row)), np.array(sorted(row["leaders"] or []), np.int64)
                used, columns = _posting_rows(row, lines, WordSets(lines, leaders, context.value), leaders, bits)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(used, pa.int32()), pa.array(np.full(len(used), row["blob"]), pa.int64()),
                     *(pa.array([pack(v) for v in columns[n]], pa.binary()) for n, _ in _POSTING)],
                    ["bucket", "blob", *(n for n, _ in _POSTING)])

    def meet(table: pa.Table) -> pa.Table:
        c, bucket = _joined(table), table.column("bucket")[0].as_py()
        reach, n = _reach(c), len(c["token"])
        later, earlier, more = _closest(_candidates(c, reach, NEIGHBOURS), FIRST_TRIES, n)
        # of a word where a line has more than NEIGHBOURS to meet, any line may have more
        first = np.searchsorted(c["token"], c["token"])
        over = np.flatnonzero(np.bincount(first[reach - np.arange(n) - 1 > NEIGHBOURS], minlength=n)[first])
        x = [c[k][np.concatenate([later, over])].astype(kind) for k, kind in (("blob", np.int64), ("leader", np.int32))]
        y = [np.concatenate([c[k][earlier].astype(kind), np.full(len(over), -1, kind)])
             for k, kind in (("blob", np.int64), ("leader", np.int32))]
        slot = _slot((np.uint64(bucket) << np.uint64(32)) | c["token"].astype(np.uint64))
        slot = np.concatenate([np.where(more, slot[later], -1), slot[over]])
        size = c["size"][np.concatenate([later, over])].astype(np.int32)
        apart = np.concatenate([sum(_only(c, later, earlier)) * 10_000 // (c["size"][later] + c["size"][earlier]),
                                np.zeros(len(over), np.int64)])
        return pa.table([*map(pa.array, x + y), *(pa.array(v.astype(np.int32)) for v in (slot, size, apart))],
                        [f.split()[0] for f in _PAIR.split(", ")])
    posted = blobs.select("blob", "ids", "sizes", "data", "leaders").mapInArrow(post, _POSTED)
    return posted.groupBy("bucket").applyInArrow(meet, _PAIR).distinct()


def _later_matches(blobs: DataFrame, undecided: DataFrame, counts, bits: int) -> DataFrame:
    """(blob, place) of the undecided lines (blob, place, slot, size) that match any earlier
    line. Only lines with a word of the undecided ones' slots, and of a size that can match
    theirs, are posted, with their texts."""
    slots = np.full(1 << SLOTS_LOG2, 1 << 40), np.zeros(1 << SLOTS_LOG2, np.int64)
    found = undecided.groupBy("slot").agg(F.min("size").alias("low"), F.max("size").alias("high")).toArrow()   # at most 2^20 rows
    for of_slot, name in zip(slots, ("low", "high")):
        of_slot[found.column("slot").to_numpy()] = found.column(name).to_numpy()
    spark = blobs.sparkSession      # both of fixed sizes
    context, looked_at = spark.sparkContext.broadcast(_word_order(counts)), spark.sparkContext.broadcast(slots)
    lists = save(undecided.groupBy("blob").agg(F.collect_set("place").alias("undecided")), "line-undecided-lists")

    def post(batches):
        squeeze = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            for row in batch.to_pylist():
                lines, leaders = Lines(_texts(row)), np.array(sorted(row["leaders"] or []), np.int64)
                used, columns = _posting_rows(row, lines, WordSets(lines, leaders, context.value), leaders, bits,
                                              looked_at.value, FEWER_BITS)
                open_lines = np.array(row["undecided"] or [], np.int64)
                raw = lines.words.data.tobytes()
                named = [distinct(v) for v in columns["leader"]]
                texts = [squeeze.compress(b"\n".join(raw[lines.begin[p]:lines.end[p]] for p in v)) for v in named]
                marks = [np.packbits(np.isin(v, open_lines)).tobytes() for v in named]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(used, pa.int32()), pa.array(np.full(len(used), row["blob"]), pa.int64()),
                     *(pa.array([pack(v) for v in columns[n]], pa.binary()) for n, _ in _POSTING),
                     pa.array(texts, pa.binary()), pa.array(marks, pa.binary())],
                    ["bucket", "blob", *(n for n, _ in _POSTING), "texts", "marks"])

    def meet(table: pa.Table) -> pa.Table:
        text, marked, unpress = {}, set(), zstandard.ZstdDecompressor()
        for blob, leader, texts, marks in zip(*(table.column(k).to_pylist() for k in ("blob", "leader", "texts", "marks"))):
            named = distinct(unpack(leader, np.uint32)).tolist()
            text.update(zip(((blob, p) for p in named), unpress.decompress(texts).split(b"\n")))
            bits_of = np.unpackbits(np.frombuffer(marks, np.uint8), count=len(named))
            marked.update((blob, p) for p, m in zip(named, bits_of) if m)
        c = _joined(table)
        names = list(zip(c["blob"].tolist(), c["leader"].tolist()))
        wanted, words, done = np.array([name in marked for name in names], bool), {}, set()
        rows_of = {}
        for k in np.flatnonzero(wanted).tolist():
            rows_of.setdefault(names[k], []).append(k)

        def of(name):
            if name not in words:
                if len(words) >= SETS_KEPT:
                    words.clear()
                words[name] = frozenset(text[name].lower().split())
            return words[name]
        for later, earlier, apart in _candidates(c, _reach(c), wanted=wanted):
            # a line that has its match is looked at no more, in this block or the next ones
            for k in np.lexsort((apart, later)):
                x = names[later[k]]
                if x not in done:
                    a, b = of(x), of(names[earlier[k]])
                    common = len(a & b)
                    if 100 * common >= PERCENT * (len(a) + len(b) - common):
                        done.add(x)
                        wanted[rows_of[x]] = False
        return pa.table({"blob": pa.array([x[0] for x in done], pa.int64()), "place": pa.array([x[1] for x in done], pa.int32())})
    source = _beside(blobs, lists).select("blob", "ids", "sizes", "data", "leaders", "undecided")
    return source.mapInArrow(post, _POSTED + ", texts binary, marks binary") \
        .groupBy("bucket").applyInArrow(meet, "blob long, place int").distinct()


def _line_texts(pairs: DataFrame, blobs: DataFrame) -> DataFrame:
    """(blob, place, line): the texts of the lines of the pairs."""
    sides = F.explode(F.array(*[F.struct(F.col(f"{s}_blob").alias("blob"), F.col(f"{s}_place").alias("place")) for s in "xy"]))
    wanted = save(pairs.select(sides.alias("s")).select("s.*").distinct().groupBy("blob")
                  .agg(F.collect_list("place").alias("places")), "line-wanted")

    def emit(batches):
        for batch in batches:
            for row in batch.to_pylist():
                lines, places = Lines(_texts(row)), np.array(row["places"], np.int64)
                raw = lines.words.data.tobytes()
                for at in range(0, len(places), 20_000):
                    some = places[at:at + 20_000]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(some), row["blob"]), pa.int64()), pa.array(some, pa.int32()),
                         pa.array([raw[lines.begin[p]:lines.end[p]] for p in some], pa.binary())], ["blob", "place", "line"])
    source = _beside(blobs.select("blob", "sizes", "data"), wanted).where("places IS NOT NULL")
    return save(source.mapInArrow(emit, "blob long, place int, line binary"), "line-texts")


def _matches(pairs: DataFrame, lines: DataFrame) -> DataFrame:
    """(blob, place) of the later lines of the pairs whose full word sets reach the similarity."""
    joined = pairs
    for s in "xy":
        joined = joined.join(lines.select(F.col("blob").alias(f"{s}_blob"), F.col("place").alias(f"{s}_place"),
                                          F.col("line").alias(f"{s}_line")), [f"{s}_blob", f"{s}_place"])

    def verify(batches):
        for batch in batches:
            keep = []
            for a, b in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                a, b = set(a.lower().split()), set(b.lower().split())
                common = len(a & b)
                keep.append(100 * common >= PERCENT * (len(a) + len(b) - common))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["blob", "place"]) \
                .filter(pa.array(keep, pa.bool_()))
    return joined.select("x_blob", "x_place", "x_line", "y_line").mapInArrow(verify, "blob long, place int").distinct()


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = True) -> DataFrame:
    """Rows (doc_id, n_lines, n_removed, kept_sha256, kept_text), one per input row;
    ``with_text=False`` leaves ``kept_text`` null."""
    plain = save(_blobs(docs, id_col, text_col), "line-blobs")
    counts = word_counts(plain)
    bits = min(MAX_BUCKET_BITS, max(3, int(np.ceil(np.log2(max(1, int(counts.sum()) / BUCKET_WORDS))))))
    leaders = save(_leaders(plain), "line-leaders")
    blobs = _beside(plain, leaders)

    pairs = save(_pairs(blobs, counts, bits), "line-pairs")
    tried = save(pairs.where("y_place >= 0").select(*_SIDES, "apart").distinct(), "line-tried")
    lines, x = _line_texts(tried, plain), ["x_blob", "x_place"]
    # one match is enough: the closest of all words first, the others of lines that it doesn't match then
    closest = save(tried.groupBy(*x).agg(F.min(F.struct("apart", "y_blob", "y_place")).alias("y")).select(*x, "y.y_blob", "y.y_place"),
                   "line-closest")
    matched = save(_matches(closest, lines), "line-matched")
    others = tried.select(*_SIDES).join(matched.toDF(*x), x, "left_anti").join(closest, _SIDES, "left_anti")
    matched = save(matched.union(_matches(others, lines)).distinct(), "line-matched-all")
    # lines that had more candidates and no match: all their candidates
    undecided = save(pairs.where("slot >= 0").select(F.col("x_blob").alias("blob"), F.col("x_place").alias("place"), "slot",
                                                          F.col("x_size").alias("size"))
                     .distinct().join(matched, ["blob", "place"], "left_anti"), "line-undecided")
    if not undecided.isEmpty():
        matched = matched.union(_later_matches(blobs, undecided, counts, bits)).distinct()
    gone = save(matched.groupBy("blob").agg(F.collect_list("place").alias("matched")), "line-gone")

    schema = "doc_id long, n_lines long, n_removed long, kept_sha256 string, kept_text string"

    def remove(batches):
        for batch in batches:
            for row in batch.to_pylist():
                doc, number = unpack(row["docs"], np.uint32), unpack(row["numbers"], np.uint32)
                stays = np.zeros(len(doc), bool)
                stays[np.array(row["leaders"] or [], np.int64)] = True
                stays[np.array(row["matched"] or [], np.int64)] = False
                cuts = np.searchsorted(doc, np.arange(len(row["ids"]) + 1))
                kept_texts, n_lines, n_removed = [], [], []
                for d, text in enumerate(_texts(row)):
                    own = slice(cuts[d], cuts[d + 1])
                    drop = set(number[own][~stays[own]].tolist())
                    split = text.split(b"\n")
                    kept_texts.append(b"\n".join(s for k, s in enumerate(split) if k not in drop) if drop else text)
                    n_lines.append(len(split) if text else 0)
                    n_removed.append(len(drop))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["ids"], pa.int64()), pa.array(n_lines, pa.int64()), pa.array(n_removed, pa.int64()),
                     pa.array([hashlib.sha256(t).hexdigest() for t in kept_texts]),
                     pa.array([t.decode() if with_text else None for t in kept_texts], pa.string())],
                    [f.split()[0] for f in schema.split(", ")])
    source = plain.select("blob", "ids", "sizes", "data", "docs", "numbers")
    return _beside(_beside(source, leaders), gone).mapInArrow(remove, schema)


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(read_table(spark, sf_dir, "documents"), with_text=False).select("doc_id", "n_lines", "n_removed", "kept_sha256")
