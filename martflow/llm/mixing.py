"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

1. Every text falls into a block of its source by a seeded hash of its id. A source gets
   blocks in proportion to its size, at most ``MAX_BLOCKS`` over all sources together
   (a bound on the plan, not on the data: blocks grow with the corpus).
2. Targets: sources weigh ``WEIGHTS`` in turn by code point of their name (null last)
   and share the total size; a target stops at ``MAX_REPEATS`` times its source's size
   and the excess is shared again by weight until none is above.
3. A source's quota in blocks: whole passes over its blocks, then the first blocks of a
   seeded permutation, the last of them only up to the target.
4. The quotas are split among the output shards by a binary tree. Each node draws from a
   multivariate hypergeometric distribution how many blocks of each source go left, so
   every shard gets an exact number of blocks of every source, and a source's permuted
   blocks are dealt to the shards without overlap.
5. The rows of a shard are shuffled locally, by a seeded hash.

Only block totals meet the driver. Everything is a function of ids and ``seed``, so
reruns agree.

Defined cases: null text has size 0 and is never taken; a source of total size 0 has
target 0; an empty table gives no rows; rows that repeat an id share its block and are
taken alike; null ids form blocks like others; extra columns are ignored by
:func:`mix_plan` and kept by :func:`mixed_rows`.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import WORD_PATTERN, free_names, n_words, read_table, save

WEIGHTS = (1.0, 2.0, 3.0)
MAX_REPEATS = 3
MAX_BLOCKS = 16_384
MIN_BLOCK_WORDS = 4_096
MAX_SOURCES = 100_000
SHARD_BLOCKS = 64


def targets(sizes: np.ndarray, weights: np.ndarray, max_repeats: float = MAX_REPEATS) -> np.ndarray:
    """Water-filling: shares by weight, none above ``max_repeats`` times its size."""
    caps = max_repeats * sizes.astype(float)
    out, open_ = np.zeros(len(sizes)), np.ones(len(sizes), dtype=bool)
    rest = float(sizes.sum())
    while open_.any():
        share = rest * weights / weights[open_].sum()
        over = open_ & (share >= caps)
        if not over.any():
            out[open_] = share[open_]
            break
        out[over] = caps[over]
        rest -= caps[over].sum()
        open_ &= ~over
    return out


def split_tree(quotas: np.ndarray, shards: int, rng: np.random.Generator) -> np.ndarray:
    """(shards, sources) block counts; columns add up to ``quotas``, rows differ by at
    most a rounding of the even share."""
    out = np.zeros((shards, len(quotas)), dtype=np.int64)
    todo = [(0, shards, quotas.astype(np.int64))]
    while todo:
        lo, hi, left = todo.pop()
        if hi - lo == 1:
            out[lo] = left
            continue
        mid = (lo + hi) // 2
        draw = int(left.sum()) * (mid - lo) // (hi - lo)
        mine = rng.multivariate_hypergeometric(left, draw, method="marginals") if draw else np.zeros_like(left)
        todo += [(mid, hi, left - mine), (lo, mid, mine)]
    return out


def _sized(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: int) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"),
                       n_words(F.col(text_col)).alias("size"),
                       F.xxhash64(F.col(id_col).cast("long"), F.lit(seed)).alias("h"))


def _block(n_blocks) -> F.Column:
    return F.pmod(F.col("h"), n_blocks).cast("int")


def mix_plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             source_col: str = "source", seed: int = 17) -> DataFrame:
    """Rows (doc_id, source, size, source_size, target, taken, passes, shards, h): one per
    input row. ``passes`` counts whole uses, ``taken - passes * size`` words come from the
    start of the text once more; ``shards`` has a shard for each use, in that order."""
    spark = docs.sparkSession
    sized = save(_sized(docs, id_col, text_col, source_col, seed), "mix-sizes")
    # the source catalogue is metadata; its bound is checked before it meets the driver
    per_source = sized.groupBy("source").agg(F.sum("size").alias("size"))
    catalogue = per_source.limit(MAX_SOURCES + 1).collect()
    if len(catalogue) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    catalogue.sort(key=lambda r: (r["source"] is None, r["source"] or ""))
    source_sizes = np.array([r["size"] for r in catalogue], dtype=np.int64)
    goal = targets(source_sizes, np.array([WEIGHTS[i % len(WEIGHTS)] for i in range(len(catalogue))]))
    total = int(source_sizes.sum())
    words = max(MIN_BLOCK_WORDS, -(-total // MAX_BLOCKS))
    n_blocks = np.maximum(1, source_sizes // words)

    sources = pd.DataFrame({"source": [r["source"] for r in catalogue], "source_no": np.arange(len(catalogue)),
                            "source_size": source_sizes, "target": goal, "n_blocks": n_blocks})
    schema = "source string, source_no int, source_size long, target double, n_blocks long"
    known = F.broadcast(spark.createDataFrame(sources.to_dict("records"), schema))  # within MAX_SOURCES
    rows = sized.join(known, sized["source"].eqNullSafe(known["source"])).drop(known["source"]) \
        .withColumn("block", _block(F.col("n_blocks")))
    block_sizes = rows.groupBy("source_no", "block").agg(F.sum("size").alias("words")).collect()  # <= MAX_BLOCKS + sources
    plan = _plan(block_sizes, goal, seed)
    planned = F.broadcast(spark.createDataFrame(
        plan, "source_no int, block int, passes int, part long, shards array<int>"))
    rows = rows.join(planned, ["source_no", "block"])
    # the one block of a source that the target cuts: its texts in hash order up to the part
    order = Window.partitionBy("source_no", "block").orderBy("h", "doc_id", "size") \
        .rowsBetween(Window.unboundedPreceding, -1)
    cut = rows.where("part > 0").withColumn("before", F.coalesce(F.sum("size").over(order), F.lit(0)))
    cut = cut.withColumn("extra", F.greatest(F.lit(0), F.least(F.col("size"), F.col("part") - F.col("before"))))
    cut = cut.drop("before")
    rows = rows.where("part = 0").withColumn("extra", F.lit(0).cast("long")).unionByName(cut)
    whole = (F.col("extra") == F.col("size")) & (F.col("size") > 0)
    return rows.select(
        "doc_id", "source", "size", "source_size", "target",
        (F.col("passes") * F.col("size") + F.col("extra")).cast("long").alias("taken"),
        (F.col("passes") + whole.cast("int")).alias("passes"), "shards", "h")


def _plan(block_sizes, goal: np.ndarray, seed: int) -> list[tuple]:
    """One row per block: (source_no, block, passes, words of a further cut pass, shards)."""
    rng = np.random.default_rng(seed)
    blocks: list[list[tuple[int, int]]] = [[] for _ in goal]
    for source, block, words in sorted(tuple(r) for r in block_sizes):
        blocks[source].append((block, int(words)))
    uses: list[list[list[int]]] = []   # per source, the block uses in the order in which they are dealt
    passes, part = [], []
    for source, own in enumerate(blocks):
        size = sum(w for _, w in own)
        want = int(round(goal[source]))
        full = min(MAX_REPEATS, want // size) if size else 0
        rest = want - full * size if size else 0
        p, cut, dealt = [full] * len(own), [0] * len(own), []
        for _ in range(full):
            dealt += list(rng.permutation(len(own)))
        for k in rng.permutation(len(own)):
            if rest <= 0 or full >= MAX_REPEATS:
                break
            if own[k][1] <= rest:
                p[k] += 1
            else:
                cut[k] = rest
            rest -= own[k][1]
            if own[k][1]:
                dealt.append(k)
        passes.append(p)
        part.append(cut)
        uses.append(dealt)
    quotas = np.array([len(d) for d in uses], dtype=np.int64)
    shards = max(1, -(-int(quotas.sum()) // SHARD_BLOCKS)) if len(quotas) else 1
    counts = split_tree(quotas, shards, rng)
    out = []
    for source, own in enumerate(blocks):
        shard_of: list[list[int]] = [[] for _ in own]
        for k, shard in zip(uses[source], np.repeat(np.arange(shards), counts[:, source])):
            shard_of[k].append(int(shard))
        out += [(source, b, int(passes[source][k]), int(part[source][k]), shard_of[k])
                for k, (b, _) in enumerate(own)]
    return out


def mixed_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               source_col: str = "source", n_chars_col: str | None = "n_chars", seed: int = 17) -> DataFrame:
    """The mix itself, with the columns of ``docs``: each text as often as it is taken, a
    cut use with the text's first words, the rows dealt to shards and shuffled in each."""
    plan = save(mix_plan(docs, id_col, text_col, source_col, seed).where("taken > 0"), "mix-plan")
    part = F.col("taken") - F.col("passes") * F.col("size")
    # a text that is used n times has n shards; a cut use of it comes last
    n, id_, size, passes, cut_part, h, shards, use, shard = free_names(
        docs, "_n", "_id", "_size", "_passes", "_part", "_h", "_shards", "_use", "_shard")
    uses = plan.dropDuplicates(["doc_id", "size"]).withColumn("part", part)
    uses = uses.select(F.col("doc_id").alias(id_), F.col("size").alias(size), F.col("passes").alias(passes),
                       F.col("part").alias(cut_part), F.col("h").alias(h), F.col("shards").alias(shards))
    rows = docs.withColumn(n, n_words(F.col(text_col))).join(
        uses, F.col(id_col).cast("long").eqNullSafe(F.col(id_)) & (F.col(n) == F.col(size)))
    n_uses = F.col(passes) + (F.col(cut_part) > 0).cast("int")
    rows = rows.select("*", F.posexplode(F.slice(shards, 1, n_uses)).alias(use, shard))
    cut = (F.col(use) == F.col(passes)) & (F.col(cut_part) > 0)
    head = F.array_join(F.slice(F.regexp_extract_all(
        F.col(text_col), F.lit(rf"([\x20\x09-\x0D]*{WORD_PATTERN})"), F.lit(1)), F.lit(1), F.col(cut_part).cast("int")), "")
    rows = rows.withColumn(text_col, F.when(cut, head).otherwise(F.col(text_col)))
    if n_chars_col in docs.columns:
        kind = docs.schema[n_chars_col].dataType
        rows = rows.withColumn(n_chars_col, F.when(cut, F.char_length(text_col).cast(kind)).otherwise(F.col(n_chars_col)))
    return rows.repartition(shard).sortWithinPartitions(
        shard, F.xxhash64(h, shard, use)).select(*docs.columns)


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_plan(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "passes", "shards")
