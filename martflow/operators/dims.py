"""Dimension lookups (D1-D4) as joins.

The reference looks up one key per record in a key-value store.  Here the
lookup is a left join against the dimension table.  A dimension is
broadcast only when its measured size is within ``martflow.broadcast.maxBytes``:
the bytes of its files as the optimizer's statistics have them, and the bytes
of the rows that the driver would hold, as the Parquet footers count them
(files of few distinct values are many times smaller than their rows).
Beyond that (or where the size isn't known) the planner's shuffle join with
AQE's runtime re-planning is used.  Reading statistics and footers runs no job,
and they are read again for every plan, so a grown dimension changes its join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martflow.functions.dates import age_years

# Bytes of a dimension, as files and as rows, that may be broadcast.
DEFAULT_BROADCAST_BYTES = 32 << 20
ROW_OVERHEAD = 48       # of a row in a broadcast hash table, beside its values
MAX_FOOTERS = 1000      # files whose rows are counted; more are an unknown size
UNKNOWN = 1 << 62


def broadcast_bytes_limit(spark) -> int:
    return int(spark.conf.get("martflow.broadcast.maxBytes", str(DEFAULT_BROADCAST_BYTES)))


def size_in_bytes(df: DataFrame) -> int:
    """The optimizer's size of ``df``; unknown sizes come out huge."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def stored_rows(df: DataFrame) -> int:
    """Rows of the Parquet files that ``df`` reads, from their footers; 0 if it reads none."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    relations = [leaf.relation() for leaf in map(leaves.apply, range(leaves.size()))
                 if leaf.getClass().getSimpleName() == "LogicalRelation"]
    files = [name for r in relations if r.toString() == "parquet" for name in r.inputFiles()]
    if len(files) > MAX_FOOTERS:
        return UNKNOWN
    jvm, conf, rows = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration(), 0
    for name in files:
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(name))
        reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(
            jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(path, conf))
        try:
            rows += reader.getRecordCount()
        finally:
            reader.close()
    return rows


def held_bytes(df: DataFrame) -> int:
    """What the rows of ``df`` take at most when they are broadcast as a hash table, by the
    rows of its files and the usual widths of its columns."""
    return stored_rows(df) * (df._jdf.schema().defaultSize() + ROW_OVERHEAD)


def is_small(df: DataFrame, max_bytes: int | None = None) -> bool:
    limit = max_bytes if max_bytes is not None else broadcast_bytes_limit(df.sparkSession)
    return size_in_bytes(df) <= limit and held_bytes(df) <= limit


def sized_side(dim: DataFrame, max_bytes: int | None = None) -> DataFrame:
    """``dim`` with a broadcast hint if its size is known to be small, else as is.  Small
    files of too many rows get a merge hint, as the planner goes by the files' bytes."""
    if dim.isStreaming:
        return dim
    if is_small(dim, max_bytes):
        return F.broadcast(dim)
    limit = max_bytes if max_bytes is not None else broadcast_bytes_limit(dim.sparkSession)
    return dim if size_in_bytes(dim) > limit else dim.hint("merge")


def lookup(fact: DataFrame, dim: DataFrame, fact_key, dim_key: str, columns: dict[str, str],
           max_bytes: int | None = None, key_type: str | None = None) -> DataFrame:
    """Left join ``fact`` with ``dim`` on ``fact_key == dim_key`` and add
    ``columns`` (output name -> dimension column).  Unmatched rows keep
    null attributes (the reference would fail on them).

    ``key_type`` casts both keys.  Log records carry ids as text, which need
    not be numbers, so they are compared as text (``key_type='string'``).
    """
    fk = F.col(fact_key) if isinstance(fact_key, str) else fact_key
    dk = F.col(dim_key)
    if key_type:
        fk, dk = fk.cast(key_type), dk.cast(key_type)
    alias = "_dk"
    d = dim.select(dk.alias(alias), *[F.col(src).alias(dst) for dst, src in columns.items()])
    return fact.join(sized_side(d, max_bytes), fk == F.col(alias), "left").drop(alias)


def with_user(fact: DataFrame, users: DataFrame, key: str, as_of=None, age_type: str = "int",
              max_bytes: int | None = None, key_type: str = "string") -> DataFrame:
    """Add ``user_gender`` and ``user_age`` (I1, I13) from the user
    dimension (``id, gender, birthday``)."""
    out = lookup(fact, users, key, "id", {"user_gender": "gender", "_birthday": "birthday"},
                 max_bytes=max_bytes, key_type=key_type)
    return (out.withColumn("user_age", age_years(F.col("_birthday"), as_of).cast(age_type))
               .drop("_birthday"))


def with_province(fact: DataFrame, provinces: DataFrame, key: str, columns: dict[str, str],
                  max_bytes: int | None = None, key_type: str = "string") -> DataFrame:
    """Add province attributes (output name -> dimension column)."""
    return lookup(fact, provinces, key, "id", columns, max_bytes=max_bytes, key_type=key_type)


def unmatched(gender: str = "user_gender", province: str = "province_name") -> list:
    """Counts of rows without a user or province row, for ``observe``."""
    return [F.count(F.lit(1)).alias("rows"), F.count(F.when(F.col(gender).isNull(), 1)).alias("no_user"),
            F.count(F.when(F.col(province).isNull(), 1)).alias("no_province")]
