"""Daily active devices: session entries, first record per (mid, day), and
the enriched ``dau_info`` row (C4, J2 batch form, B10, D1, D2, I1-I3)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martflow import schemas
from martflow.functions.dates import day_of_millis, hour_of_millis
from martflow.operators import dims
from martflow.operators.reshape import copy_matching

# Province attributes of the daily-active row (output name -> dimension column).
DAU_PROVINCE_COLUMNS = {
    "province_name": "name", "province_iso_code": "iso_code",
    "province_3166_2": "iso_3166_2", "province_area_code": "area_code",
}


def session_entries(page_log: DataFrame) -> DataFrame:
    """C4: page records that open a session (``last_page_id`` is null;
    an empty string is not null and is dropped)."""
    return page_log.where(F.col("last_page_id").isNull())


def with_day(page_log: DataFrame) -> DataFrame:
    """Add ``dt`` (I2) from the record's epoch-millis ``ts``."""
    return page_log.withColumn("dt", day_of_millis("ts"))


def first_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row per ``keys`` by ``order`` (then by all other columns).

    Expressed as ``min(struct(order..., rest...))`` per group, an
    aggregate with a map-side partial step: a key holding a third of all
    rows is reduced to one row per map task before the shuffle, so no task
    ever holds a whole hot group (a ``row_number`` window would).  A struct
    buffer is not fixed-width, so Spark runs it as a sort-based aggregate
    (spills, never gathers a group); a ``min(ts)`` hash aggregate joined
    back would shuffle the whole input a second time.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    packed = F.struct(*[F.col(c) for c in order + rest]).alias("_first")
    agg = df.groupBy(*keys).agg(F.min(packed).alias("_first"))
    return agg.select(*keys, *[F.col(f"_first.{c}").alias(c) for c in order + rest])


def first_visit_per_day(page_log: DataFrame) -> DataFrame:
    """J2 (batch): one page record per (mid, dt) - the earliest by ts."""
    return first_per_key(with_day(session_entries(page_log)), ["mid", "dt"], ["ts"])


def active_devices(starts: DataFrame) -> DataFrame:
    """``mid, dt, hr`` per (device, day) from session starts (``mid, ts``): the day's
    first visit, as a ``min`` with a map-side hash aggregate."""
    first = with_day(starts).groupBy("mid", "dt").agg(F.min("ts").alias("ts"))
    return first.select("mid", "dt", hour_of_millis("ts").alias("hr"))


def to_dau_info(visits: DataFrame, users: DataFrame, provinces: DataFrame,
                as_of=None) -> DataFrame:
    """B10 + D1 + D2 + I1 + I3: enrich first visits into ``dau_info`` rows.

    ``last_page_id`` is dropped because ``dau_info`` has no such field;
    ``user_age`` is text in this table.
    """
    v = copy_matching(visits, schemas.DAU_INFO, extra=["dt"])
    v = dims.with_user(v, users, "user_id", as_of=as_of, age_type="string")
    v = dims.with_province(v, provinces, "province_id", DAU_PROVINCE_COLUMNS)
    v = v.withColumn("hr", hour_of_millis("ts"))
    return v.select(*schemas.names(schemas.DAU_INFO))


def dau_info(page_log: DataFrame, users: DataFrame, provinces: DataFrame,
             as_of=None) -> DataFrame:
    """The daily-active table from a page log (batch form of the DAU job)."""
    return to_dau_info(first_visit_per_day(page_log), users, provinces, as_of)
