"""Merkle manifest of a dataset, one tree per source and one over the sources, by slot pivots.

H is the lowercase hex SHA-256 of its inputs' concatenation, digests as hex text. A row's
leaf is H of its fields (:func:`field`). Leaves of a tree are in order of id; while a tree
has several nodes, every ``FANOUT`` consecutive ones, the last run shorter, become their H.
The tree of a source ends in its subroot; the subroots, in order of source (null first,
UTF-8 bytewise), are the leaves of the tree that ends in the root.

* **Places.** Rows are range-partitioned and sorted by (source, id), so a source that holds
  a third of all rows is many partitions. A row's place is its number within its partition
  plus the rows of the partitions before (:func:`ranked`).
* **Slot pivot.** A level is one aggregate: conditional aggregates spread each parent's
  children into the columns c0 to c15. Their concatenation, hashed, is the parent; without
  the own slot it is the siblings.
* **Proofs** go down from the root. A pivot row meets its parent's path once, and all its
  children take theirs from that row, so a leaf costs a sixteenth of a path in the shuffle.

Only the digest of a text leaves the scan. The driver sees one number, the size of the
largest tree, for the number of levels.

Defined cases: an empty table gives no rows; a null field counts as ``-`` and an empty one
as ``0:``; null ids come first in their tree; rows with the same id are ordered by leaf, and
repeated rows are leaves each, next to one another; a tree of one leaf has that leaf as its
subroot and no siblings; a null id is not tampered with. Other columns are not read,
whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import broadcast_if_small, read_table, save

FANOUT = 16
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
_SLOTS = [f"c{k}" for k in range(FANOUT)]
_UPPER, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_ROW_BITS = 33      # monotonically_increasing_id: partition above, row number below


def digest(*parts: Column) -> Column:
    """H of text columns."""
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """``<UTF-8 bytes>:<value>``, ``-`` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def ranked(df: DataFrame, *by: str) -> DataFrame:
    """``df`` with ``place``, each row's 0-based place in the order of ``by`` (nulls first)."""
    sorted_rows = save(df.repartitionByRange(*by).sortWithinPartitions(*by)
                       .withColumn("_seq", F.monotonically_increasing_id()), "merkle-ranked")
    part = F.shiftright("_seq", _ROW_BITS)
    # one row per partition: the running sum over them is short, and so is its broadcast
    before = sorted_rows.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n")).select(
        "_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))
    return sorted_rows.join(F.broadcast(before), part == F.col("_part")).select(
        *df.columns, (F.col("_before") + F.col("_seq").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))).alias("place"))


def leaf_rows(docs: DataFrame, columns=COLUMNS, tree: str = "source", order: str = "doc_id",
              altered: dict[str, Column] | None = None, where: Column | None = None) -> DataFrame:
    """``key, id, leaf, altered_leaf``: a leaf per row and, for the rows for which ``where``
    holds, the leaf that it would have with the ``altered`` columns (else null)."""
    leaf = digest(*[field(F.col(c)) for c in columns])
    other = F.lit(None).cast("string")
    if altered:
        other = digest(*[field(altered.get(c, F.col(c))) for c in columns])
        other = other if where is None else F.when(where, other)
    return docs.select(F.col(tree).alias("key"), F.col(order).alias("id"), leaf.alias("leaf"),
                       other.alias("altered_leaf"), F.monotonically_increasing_id().alias("row"))


def planted(leaves: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The leaves in their trees, ``tree, pos, n, hash`` and their own columns, and the
    trees, ``tree, key, n``; trees are numbered in order of key."""
    # the row's number as last key splits any run of repeated rows over partitions
    placed = ranked(save(leaves, "merkle-leaves"), "key", "id", "leaf", "row")
    groups = placed.groupBy("key").agg(F.min("place").alias("start"), F.count(F.lit(1)).alias("n"))
    trees = save(ranked(save(groups, "merkle-groups"), "start").withColumnRenamed("place", "tree"), "merkle-trees")
    side = broadcast_if_small(trees.withColumnRenamed("key", "tree_key"))
    nodes = placed.join(side, F.col("key").eqNullSafe(F.col("tree_key"))).select(
        "tree", (F.col("place") - F.col("start")).alias("pos"), "n", F.col("leaf").alias("hash"),
        "key", "id", "altered_leaf")
    return save(nodes, "merkle-nodes"), trees


def _slot() -> Column:
    return F.pmod("pos", F.lit(FANOUT)).cast("int")


def _parent() -> Column:
    return F.expr(f"pos div {FANOUT}")


def build(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Hash trees of ``tree, pos, n, hash`` (n nodes in the tree) level by level.

    Returns the pivots, lowest first, with ``tree, pos`` of the parent, ``n`` of its level
    and the children's slots; and the trees' ends, ``tree, hash``."""
    at = nodes.select("tree", "pos", "n", "hash")
    most = at.agg(F.max("n")).first()[0] or 0
    pivots, ends = [], at.where("n = 1")
    while most > 1:
        slots = [F.max(F.when(_slot() == k, F.col("hash"))).alias(c) for k, c in enumerate(_SLOTS)]
        pivot = save(at.where("n > 1").groupBy("tree", _parent().alias("pos"))
                     .agg(F.expr(f"(max(n) + {FANOUT - 1}) div {FANOUT}").alias("n"), *slots), "merkle-pivot")
        pivots.append(pivot)
        at = pivot.select("tree", "pos", "n", digest(*[F.coalesce(c, F.lit("")) for c in _SLOTS]).alias("hash"))
        ends = ends.unionByName(at.where("n = 1"))
        most = -(-most // FANOUT)
    return pivots, save(ends.select("tree", "hash"), "merkle-ends")


def _siblings(slot: Column) -> Column:
    """What stands left and right of a slot in its pivot row (missing slots are skipped)."""
    row = F.array(*_SLOTS)
    return F.struct(F.array_join(F.slice(row, F.lit(1), slot), "").alias("left"),
                    F.array_join(F.slice(row, slot + 2, F.lit(FANOUT)), "").alias("right"))


def _children(pivot: DataFrame, carried: list[str]) -> DataFrame:
    """``tree, pos, path`` and what is carried, of each child of pivot rows with paths."""
    slot, path = F.col("slot"), F.concat(F.array(_siblings(F.col("slot"))), F.col("path")).alias("path")
    return (pivot.select("*", F.posexplode(F.array(*_SLOTS)).alias("slot", "child")).where("child IS NOT NULL")
            .select("tree", (F.col("pos") * FANOUT + slot).alias("pos"), path, *carried))


def descend(pivots: list[DataFrame], tops: DataFrame) -> DataFrame | None:
    """The lowest pivot with the path from each of its rows upwards; ``tops`` has ``tree,
    path`` and further columns to carry, for the trees' ends."""
    carried = [c for c in tops.columns if c not in ("tree", "path")]
    below = None
    for pivot in reversed(pivots):
        ended = pivot.where("n = 1").join(tops, "tree")
        if below is not None:
            ended = ended.unionByName(pivot.where("n > 1").join(_children(below, carried), ["tree", "pos"]))
        below = ended
    return below


def proofs(docs: DataFrame, columns=COLUMNS, tree: str = "source", order: str = "doc_id",
           altered: dict[str, Column] | None = None, where: Column | None = None) -> DataFrame:
    """The manifest with a proof per row: ``key, id, leaf, altered_leaf, path, subroot, root``.

    ``path`` is an array, own run first, of the hex digests ``left`` and ``right`` of the
    node in its run; folding the leaf along it (:func:`fold`) gives the root."""
    nodes, trees = planted(leaf_rows(docs, columns, tree, order, altered, where))
    pivots, subroots = build(nodes)

    number = trees.agg(F.count(F.lit(1))).scalar()
    over = save(subroots.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("pos"),
                                number.alias("n"), "hash"), "merkle-sources")
    source_pivots, root = build(over)
    empty = F.array().cast("array<struct<left:string,right:string>>")
    top = root.select("tree", empty.alias("path"), F.col("hash").alias("root"))
    if source_pivots:
        paths = _children(descend(source_pivots, top), ["root"]).select(F.col("pos").alias("tree"), "path", "root")
    else:
        paths = top
    tops = save(paths.join(subroots.withColumnRenamed("hash", "subroot"), "tree"), "merkle-tops")

    names = ["key", "id", "hash", "altered_leaf", "path", "subroot", "root"]
    found = nodes.where("n = 1").join(tops, "tree").select(*names)
    if pivots:
        lowest = descend(pivots, tops).withColumnRenamed("pos", "parent").drop("n")
        path = F.concat(F.array(_siblings(_slot())), F.col("path")).alias("path")
        found = found.unionByName(
            nodes.where("n > 1").withColumn("parent", _parent()).join(lowest, ["tree", "parent"])
            .select(*[path if c == "path" else c for c in names]))
    return found.withColumnRenamed("hash", "leaf")


def fold(leaf: Column, path: Column) -> Column:
    """The root that ``leaf`` and its siblings give."""
    return F.aggregate(path, leaf, lambda node, run: digest(run["left"], node, run["right"]))


def siblings_digest(path: Column) -> Column:
    """H of all siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda run: F.concat(run["left"], run["right"])), ""), 256)


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = proofs(read_table(spark, sf_dir, "documents"),
                   altered={"text": F.translate("text", _UPPER, _SMALL)},
                   where=F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0)
    folded = fold(F.coalesce("altered_leaf", "leaf"), F.col("path"))
    return (found.withColumn("folded_root", folded)
            .select(F.col("id").alias("doc_id"), "leaf", "subroot", "root",
                    siblings_digest(F.col("path")).alias("proof_sha256"), "folded_root",
                    (F.col("folded_root") == F.col("root")).alias("verified")))


OP11_SQL = r"""
WITH RECURSIVE raw AS (
  SELECT row_number() OVER () AS row, doc_id, source, text,
         coalesce(strlen(doc_id::VARCHAR)::VARCHAR || ':' || doc_id::VARCHAR, '-')
         || coalesce(strlen(source)::VARCHAR || ':' || source, '-')
         || coalesce(strlen(lang)::VARCHAR || ':' || lang, '-')
         || coalesce(strlen(n_chars::VARCHAR)::VARCHAR || ':' || n_chars::VARCHAR, '-') AS head,
         xor(4294967295, list_reduce(
           list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ord(c)::BIGINT)),
           lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0],
                                    lambda x, i: xor(x >> 1, 3988292384 * (x & 1))))) % 5 = 0 AS tamper
  FROM documents),
leaves AS (
  SELECT row, doc_id, source, sha256(head || coalesce(strlen(text)::VARCHAR || ':' || text, '-')) AS leaf,
         sha256(head || coalesce(strlen(text)::VARCHAR || ':' || CASE WHEN tamper
                THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END, '-')) AS seen
  FROM raw),
planted AS (
  SELECT row, doc_id, leaf, seen, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
         row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
         count(*) OVER (PARTITION BY source) AS n
  FROM leaves),
nodes AS (
  SELECT 0 AS level, tree, pos, n, leaf AS hash FROM planted
  UNION ALL
  SELECT level + 1, tree, pos // 16, (n + 15) // 16, sha256(string_agg(hash, '' ORDER BY pos))
  FROM nodes WHERE n > 1 GROUP BY level, tree, pos // 16, n),
tops AS (
  SELECT 0 AS level, tree AS pos, count(*) OVER () AS n, hash FROM nodes WHERE n = 1
  UNION ALL
  SELECT level + 1, pos // 16, (n + 15) // 16, sha256(string_agg(hash, '' ORDER BY pos))
  FROM tops WHERE n > 1 GROUP BY level, pos // 16, n),
runs AS (SELECT level, tree, pos // 16 AS parent, list(hash ORDER BY pos) AS run FROM nodes GROUP BY ALL),
top_runs AS (SELECT level, pos // 16 AS parent, list(hash ORDER BY pos) AS run FROM tops GROUP BY ALL),
up AS (
  SELECT row, 0 AS level, tree, pos, n, '' AS proof, seen AS folded FROM planted
  UNION ALL
  SELECT row, up.level + 1, up.tree, pos // 16, (n + 15) // 16,
         proof || array_to_string(run[1:pos % 16], '') || array_to_string(run[pos % 16 + 2:], ''),
         sha256(array_to_string(run[1:pos % 16], '') || folded || array_to_string(run[pos % 16 + 2:], ''))
  FROM up JOIN runs ON runs.level = up.level AND runs.tree = up.tree AND runs.parent = up.pos // 16
  WHERE n > 1),
over AS (
  SELECT row, 0 AS level, tree AS pos, (SELECT count(*) FROM tops WHERE level = 0) AS n, proof, folded
  FROM up WHERE n = 1
  UNION ALL
  SELECT row, over.level + 1, pos // 16, (n + 15) // 16,
         proof || array_to_string(run[1:pos % 16], '') || array_to_string(run[pos % 16 + 2:], ''),
         sha256(array_to_string(run[1:pos % 16], '') || folded || array_to_string(run[pos % 16 + 2:], ''))
  FROM over JOIN top_runs ON top_runs.level = over.level AND top_runs.parent = over.pos // 16
  WHERE n > 1)
SELECT p.doc_id, p.leaf, s.hash AS subroot, r.hash AS root, sha256(over.proof) AS proof_sha256,
       over.folded AS folded_root, over.folded = r.hash AS verified
FROM planted p JOIN over ON over.row = p.row AND over.n = 1
JOIN nodes s ON s.tree = p.tree AND s.n = 1
JOIN tops r ON r.n = 1
"""
