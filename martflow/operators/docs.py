"""Document-table operations keyed by id.

A document index becomes a table with an ``id`` column.  Every write is a
set operation between the base table and a frame of changes - anti join,
union, left join - so each runs as shuffles on ``id`` over the whole table,
never as a driver loop.  Writing the result (``martflow.streaming.sinks``)
makes it durable.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def get_by_id(docs: DataFrame, doc_id, id_col: str = "id") -> DataFrame:
    """A15."""
    return docs.where(F.col(id_col) == F.lit(doc_id))


def _latest_per_id(patch: DataFrame, id_col: str, order_col: str | None) -> DataFrame:
    """When a change frame holds an id more than once, the last one by
    ``order_col`` wins (partial aggregation, no per-id task gather)."""
    if order_col is None:
        return patch
    rest = [c for c in patch.columns if c not in (id_col, order_col)]
    agg = patch.groupBy(id_col).agg(F.max(F.struct(order_col, *rest)).alias("_l"))
    return agg.select(id_col, *[F.col(f"_l.{c}").alias(c) for c in [order_col] + rest])


def upsert(docs: DataFrame, patch: DataFrame, id_col: str = "id", order_col: str | None = None) -> DataFrame:
    """Put documents by id (idempotent): new ids are added, known
    ids are replaced whole."""
    p = _latest_per_id(patch, id_col, order_col)
    if order_col is not None:
        p = p.drop(order_col)
    kept = docs.join(p.select(id_col), id_col, "left_anti")
    return kept.unionByName(p.select(*docs.columns))


def append_new(docs: DataFrame, new_docs: DataFrame, id_col: str = "id") -> DataFrame:
    """Append with generated ids (not idempotent by design)."""
    fresh = new_docs.withColumn(id_col, F.expr("uuid()"))
    return docs.unionByName(fresh.select(*docs.columns))


def delete_by_id(docs: DataFrame, ids: DataFrame, id_col: str = "id") -> DataFrame:
    """A19."""
    return docs.join(ids.select(id_col).distinct(), id_col, "left_anti")


def update_by_id(docs: DataFrame, patch: DataFrame, id_col: str = "id") -> DataFrame:
    """Partial update: columns present in ``patch`` replace the
    document's where the patch value is not null; other columns stay."""
    cols = [c for c in patch.columns if c != id_col]
    p = patch.select(id_col, *[F.col(c).alias(f"_p_{c}") for c in cols])
    j = docs.join(p, id_col, "left")
    return j.select(*[F.coalesce(F.col(f"_p_{c}"), F.col(c)).alias(c) if c in cols else F.col(c)
                      for c in docs.columns])


def unmatched_ids(docs: DataFrame, patch: DataFrame, id_col: str = "id") -> DataFrame:
    """Ids of a partial update that name no document (an error in an index)."""
    return patch.select(id_col).join(docs.select(id_col), id_col, "left_anti")


def update_by_query(docs: DataFrame, predicate: Column, assignments: dict[str, object]) -> DataFrame:
    """Set columns on every document matching ``predicate``."""
    def value(v):
        return v if isinstance(v, Column) else F.lit(v)
    # One projection: every assignment sees the document as it was.
    return docs.select(*[F.when(predicate, value(assignments[c])).otherwise(F.col(c)).alias(c)
                         if c in assignments else F.col(c) for c in docs.columns])
