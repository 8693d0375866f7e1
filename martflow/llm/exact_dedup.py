"""Exact dedup by progressive refinement: byte length, then a prefix hash, then the
full hash of what is still undecided.

Texts are equal when identical after lower-casing A-Z only; null counts as empty. Of
equal texts the row with the largest id stays.

Defined cases: an empty table gives no rows; rows whose ids tie at the maximum (a
repeated row, or only null ids) all count in ``group_size`` and are all marked kept,
since the id names the document (:func:`keep_rows` then leaves one of them); a null id
never wins against another id. Extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import broadcast_if_small, free_names, map_texts, read_table, save

PREFIX_CHARS = 64
_UPPER, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _prefix_hash(text: Column) -> Column:
    return F.xxhash64(F.translate(F.substring(text, 1, PREFIX_CHARS), _UPPER, _SMALL))


def _keys(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Cheap keys of each row: byte length and the hash of the lower-cased prefix."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"),
                       F.octet_length(text).cast("long").alias("n_bytes"),
                       _prefix_hash(text).alias("prefix_hash"))


def _digest(keyed: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, prefix_hash, digest): SHA-256 over the whole lower-cased text."""
    schema = "doc_id long, n_bytes long, prefix_hash long, digest binary"

    def make():
        def f(batch, texts):
            # bytes.lower() changes A-Z only, which is the contract's rule
            digests = pa.array([hashlib.sha256(t.lower()).digest() for t in texts], pa.binary())
            return pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), batch.column(3), digests],
                ["doc_id", "n_bytes", "prefix_hash", "digest"])
        return f
    return map_texts(keyed, "text", make, schema)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                digest_all: bool = False) -> DataFrame:
    """Rows (doc_id, keep_id, group_size, kept, digest, n_bytes, prefix_hash), one per input row.

    The full content is hashed only for rows that share length and prefix hash with
    another row; ``digest`` is null elsewhere unless ``digest_all`` asks for it."""
    if digest_all:
        keyed = save(_digest(_keys(docs, id_col, text_col)), "exact-keys")
    else:
        keyed = save(_keys(docs, id_col, text_col).drop("text"), "exact-keys")
    # counts are summed per task before they meet, so a hot length is a few rows
    counted = keyed.groupBy("n_bytes", "prefix_hash").agg(F.count(F.lit(1)).alias("n"))
    lengths = counted.groupBy("n_bytes").agg(F.sum("n").alias("rows")).where("rows > 1").select("n_bytes")
    by_prefix = broadcast_if_small(save(counted.where("n > 1").join(lengths, "n_bytes", "left_semi")
                                        .select("n_bytes", "prefix_hash"), "exact-open"))
    open_rows = keyed.join(by_prefix, ["n_bytes", "prefix_hash"], "left_semi")
    if digest_all:
        rows = keyed
        undecided = open_rows
    else:
        # the full read touches only the texts whose (length, prefix) is shared
        undecided = save(_digest(_keys(docs, id_col, text_col)
                                 .join(by_prefix, ["n_bytes", "prefix_hash"], "left_semi")
                                 .select("doc_id", "text", "n_bytes", "prefix_hash")), "exact-digests")
        alone = keyed.join(by_prefix, ["n_bytes", "prefix_hash"], "left_anti") \
            .withColumn("digest", F.lit(None).cast("binary"))
        rows = undecided.unionByName(alone)
    key = ["n_bytes", "prefix_hash", "digest"]
    groups = broadcast_if_small(save(undecided.groupBy(*key).agg(
        F.max("doc_id").alias("top"), F.count(F.lit(1)).alias("n")).where("n > 1"), "exact-groups"))
    out = rows.join(groups, key, "left")
    keep = F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("top"))
    return out.select("doc_id", keep.alias("keep_id"),
                      F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
                      F.col("doc_id").eqNullSafe(keep).alias("kept"), "digest", "n_bytes", "prefix_hash")


def keep_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without exact copies, all columns as they were.

    The texts don't move: rows are tested against the narrow table of dropped rows. Only
    ids that occur more than once among the kept rows (a repeated row) are regrouped."""
    key = ["doc_id", "n_bytes", "prefix_hash"]
    decided = save(exact_dedup(docs, id_col, text_col), "exact-decided")
    text = F.coalesce(F.col(text_col), F.lit(""))
    row, other, mark = free_names(docs, "_row", "_id", "_mark")
    mine = F.struct(F.col(id_col).cast("long").alias("doc_id"),
                    F.octet_length(text).cast("long").alias("n_bytes"), _prefix_hash(text).alias("prefix_hash"))
    marked = docs.withColumn(row, mine)

    def against(rows: DataFrame, ids: DataFrame, how: str) -> DataFrame:
        ids = broadcast_if_small(ids.select(F.struct(*key).alias(other)))
        return rows.join(ids, (F.col(f"{row}.n_bytes") == F.col(f"{other}.n_bytes"))
                         & (F.col(f"{row}.prefix_hash") == F.col(f"{other}.prefix_hash"))
                         & F.col(f"{row}.doc_id").eqNullSafe(F.col(f"{other}.doc_id")), how)

    rows = against(marked, save(decided.where("not kept").select(*key), "exact-dropped"), "left_anti")
    again = save(decided.where("kept").groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
                 .select(*key), "exact-repeated")
    if not again.isEmpty():
        once = against(rows, again, "left_anti")
        twice = against(rows, again, "left_semi").withColumn(mark, F.sha2(text.cast("binary"), 256))
        rows = once.unionByName(twice.dropDuplicates([row, mark]).drop(mark))
    return rows.drop(row)


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = exact_dedup(read_table(spark, sf_dir, "documents"), digest_all=True)
    return out.select("doc_id", "keep_id", "group_size", "kept",
                      F.lower(F.hex("digest")).alias("text_sha256"))


OP10_SQL = r"""
WITH t AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                  'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER w AS kept, text_sha256
FROM t WINDOW w AS (PARTITION BY text_sha256)
"""
