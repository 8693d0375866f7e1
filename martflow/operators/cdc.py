"""Change-record routing.

Each change record names a table, an operation and a ``data`` payload.
Operations map to I/U/D (others are dropped); tables listed as facts are
forwarded to ``DWD_<TABLE>_<OP>``; tables listed as dimensions update a
latest-value-per-id snapshot.  The table lists are small config tables
read when the plan is built - inside ``foreachBatch`` for streams, so an
edit applies from the next micro-batch on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martflow import schemas
from martflow.operators.dims import sized_side

# Change type -> operation code (C5); other types are dropped.
OPERATIONS = {"bootstrap-insert": "I", "insert": "I", "update": "U", "delete": "D"}

# Default table lists (fact and dimension tables; a table may be in both).
FACT_TABLES = ["order_info", "order_detail"]
DIM_TABLES = ["user_info", "base_province"]

BAD_TOPIC = "BAD_RECORDS"

# What makes a change the later one of its key: offsets of different topic
# partitions aren't comparable, so the record's time comes first.
CHANGE_ORDER = ["timestamp", "partition", "offset"]


def table_list(spark: SparkSession, names: list[str] | None = None, path: str | None = None,
               fmt: str = "parquet") -> DataFrame:
    """A table list as a one-column (``table``) DataFrame, from a
    stored config table (re-read on every call) or from given names."""
    if path is not None:
        return spark.read.format(fmt).load(path).select(F.col("table").cast("string"))
    listed = F.array(*[F.lit(n) for n in names or []]).cast("array<string>")
    return spark.range(1).select(F.explode(listed).alias("table"))


def operation(type_col="type"):
    col = F.col(type_col)
    expr = None
    for k, v in OPERATIONS.items():
        expr = F.when(col == k, v) if expr is None else expr.when(col == k, v)
    return expr


def parse_change(raw: DataFrame, value_col: str = "value", keep: list[str] | None = None) -> DataFrame:
    """B1 + C5: ``type, table, op, data`` (``data`` kept as the raw JSON
    text, B9).  Other change types are left out (C5); malformed records are
    those of :func:`bad_changes`."""
    env = F.from_json(F.col(value_col), schemas.CDC_ENVELOPE)
    out = raw.select(*(keep or []), env.alias("_e"),
                     F.get_json_object(F.col(value_col), "$.data").alias("data"))
    row = F.struct(*[F.col(c) for c in (keep or [])], F.col("_e.type").alias("type"),
                   F.col("_e.table").alias("table"), operation("_e.type").alias("op"), F.col("data"))
    # Filter behind a generator so the envelope is parsed once per record
    # (a pushed-down ``where`` would re-run ``from_json`` in the predicate).
    return (out.select(F.explode(F.when(operation("_e.type").isNotNull(), F.array(row))).alias("_r"))
               .select("_r.*"))


def bad_changes(raw: DataFrame, value_col: str = "value") -> DataFrame:
    """B1: records whose text is no JSON object or names no change type, as messages of
    ``BAD_RECORDS`` with their text (a known type that isn't I/U/D is left out by C5)."""
    kind = F.from_json(F.col(value_col), schemas.CDC_ENVELOPE)["type"]
    return raw.where(F.col(value_col).isNotNull() & kind.isNull()) \
        .select(F.lit(BAD_TOPIC).alias("topic"), F.col(value_col).alias("value"))


def _in_list(changes: DataFrame, tables: DataFrame) -> DataFrame:
    """Semi join with a size-checked broadcast config table."""
    t = sized_side(tables.select(F.col("table").alias("_t")).distinct())
    return changes.join(t, changes["table"] == t["_t"], "left_semi")


def fact_messages(changes: DataFrame, fact_tables: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Fact changes as ``topic = DWD_<TABLE>_<OP>, value = data``."""
    f = _in_list(changes, fact_tables)
    topic = F.concat_ws("_", F.lit("DWD"), F.upper(F.col("table")), F.col("op"))
    return f.select(*(keep or []), topic.alias("topic"), F.col("data").alias("value"))


def dim_changes(changes: DataFrame, dim_tables: DataFrame) -> DataFrame:
    """Dimension changes: ``table, id, op, data`` and the columns of ``CHANGE_ORDER``."""
    d = _in_list(changes, dim_tables)
    return d.select("table", F.get_json_object("data", "$.id").alias("id"), "op", "data", *CHANGE_ORDER)


def upsert_dimension(changes: DataFrame, snapshot: DataFrame | None = None,
                     apply_deletes: bool = False) -> DataFrame:
    """A10: the latest change per ``(table, id)`` by ``CHANGE_ORDER`` merged
    over the previous snapshot (same columns).  An aggregate of
    ``max(struct(timestamp, ...))`` (sort-based: the buffer is a struct) -
    partial per task, so a hot id never gathers in one task.  Deletes are kept as the latest value (as in the
    original) unless ``apply_deletes``.
    """
    cols = ["table", "id", "op", "data", *CHANGE_ORDER]
    allc = changes.select(*cols)
    if snapshot is not None:
        allc = snapshot.select(*cols).unionByName(allc)
    latest = (allc.groupBy("table", "id")
                  .agg(F.max(F.struct(*CHANGE_ORDER, "op", "data")).alias("_l"))
                  .select("table", "id", "_l.op", "_l.data", *[f"_l.{c}" for c in CHANGE_ORDER]))
    if apply_deletes:
        latest = latest.where(F.col("op") != "D")
    return latest
