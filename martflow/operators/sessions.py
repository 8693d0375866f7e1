"""Sessions of the page log (M3, M4): islands of a device's records in order of time.

A record without ``last_page_id`` opens a session; the device's records up to the next
such record belong to it.  The log has no session id, so sessions come from a running
count of openings.  That count is a segmented prefix scan, not one window per device:

1. **Segments.**  The records of a device and time slice (an hour) are numbered by a
   window of their own, so a device with a third of all records is as many window groups
   as it has hours.  Each segment becomes its *fragments*: fragment 0 holds the records
   before the segment's first opening, fragment k those from its k-th opening on.  Window
   and aggregate share one shuffle.
2. **Carry.**  Fragment 0 goes on with the session that is open at the slice's start.  A
   window over one row per (device, slice) finds it: the last opening of an earlier slice.
3. **Stitch.**  Fragments of one session are summed; the aggregate has a map-side partial
   step, so a session over many slices is a row per task.

Records of equal time are ordered by ``last_page_id`` (openings first), then by the other
columns that are read; records equal in all of them are interchangeable.  Records before
the first opening of their device belong to a session that began before the log (or the
chosen days) did: ``opened`` is false, and ``ordinal`` 0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SLICE = "hour"
# The columns that sessions read, in order of precedence after the time.
READ = ["last_page_id", "page_id", "is_new", "channel", "during_time"]


def _sliced(page_log: DataFrame, slice_unit: str) -> DataFrame:
    start = F.unix_millis(F.date_trunc(slice_unit, F.timestamp_millis("ts")))
    return page_log.select("mid", "ts", *READ, start.alias("slice"))


def fragments(page_log: DataFrame, slice_unit: str = SLICE) -> DataFrame:
    """``mid, slice, k`` and sums per fragment: ``views``, ``time`` and ``timed`` (page time
    in ms, and records that have one), ``is_new`` (the largest), ``first`` and ``last`` (the
    first and last record: ``ts`` and the columns read)."""
    order = [F.col(c).asc_nulls_first() for c in ["ts", *READ]]
    segment = Window.partitionBy("mid", "slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    opens = F.when(F.col("last_page_id").isNull(), 1).otherwise(0)
    numbered = _sliced(page_log, slice_unit).withColumn("k", F.sum(opens).over(segment))
    record = F.struct("ts", *READ)
    return numbered.groupBy("mid", "slice", "k").agg(
        F.count(F.lit(1)).alias("views"), F.sum("during_time").alias("time"), F.count("during_time").alias("timed"),
        F.max("is_new").alias("is_new"), F.min(record).alias("first"), F.max(record).alias("last"))


def stitch(parts: DataFrame) -> DataFrame:
    """Sessions from fragments: ``mid, start_ts, end_ts, opened, views, time, timed, is_new,
    channel, entry_page, exit_page``."""
    sums = ["views", "time", "timed", "is_new", "first", "last"]
    # a row per (device, slice): its last opening, and its fragment 0, which looks for the
    # session that is open when the slice begins
    per_slice = parts.groupBy("mid", "slice").agg(
        F.max("k").alias("most"), F.max(F.when(F.col("k") == 0, F.struct(*sums))).alias("zero"))
    earlier = Window.partitionBy("mid").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    opening = F.when(F.col("most") > 0, F.struct(F.col("slice").alias("slice"), F.col("most").alias("k")))
    before = per_slice.select("mid", F.last(opening, ignorenulls=True).over(earlier).alias("session"), "zero") \
        .where("zero IS NOT NULL").select("mid", "session", "zero.*")
    inside = parts.where("k > 0").select("mid", F.struct("slice", "k").alias("session"), *sums)
    whole = inside.unionByName(before).groupBy("mid", "session").agg(
        F.sum("views").alias("views"), F.sum("time").alias("time"), F.sum("timed").alias("timed"),
        F.max("is_new").alias("is_new"), F.min("first").alias("first"), F.max("last").alias("last"))
    return whole.select("mid", F.col("first.ts").alias("start_ts"), F.col("last.ts").alias("end_ts"),
                       F.col("session").isNotNull().alias("opened"), "views", "time", "timed", "is_new",
                       F.col("first.channel").alias("channel"), F.col("first.page_id").alias("entry_page"),
                       F.col("last.page_id").alias("exit_page"))


def sessions(page_log: DataFrame, slice_unit: str = SLICE) -> DataFrame:
    """The sessions of a page log; see the module's text."""
    return stitch(fragments(page_log, slice_unit))


def _bounced(of=None):
    """Sessions of one view, in percent; one that began before the log was no bounce."""
    one = F.col("opened") & (F.col("views") == 1)
    some = F.lit(True) if of is None else of
    return F.try_divide(F.lit(100.0) * F.count(F.when(some & one, 1)), F.count(F.when(some, 1)))


def visit_table(found: DataFrame) -> DataFrame:
    """M3 over sessions: rows ``field, old, new`` for views, visitors, bounce %, mean page
    time in ms and mean pages per session; null where there is no session.  A session is a
    new visitor's when any of its records says so."""
    sides = {"old": F.col("is_new") == "0", "new": F.col("is_new") == "1"}

    def fields(of):
        views = F.sum(F.when(of, F.col("views")))
        return {"views": F.coalesce(views, F.lit(0)).cast("double"),
                "visitors": F.count_distinct(F.when(of, F.col("mid"))).cast("double"), "bounce_percent": _bounced(of),
                "mean_time": F.try_divide(F.sum(F.when(of, F.col("time"))), F.sum(F.when(of, F.col("timed")))),
                "mean_pages": F.try_divide(views, F.count(F.when(of, 1)))}
    of_side = {side: fields(of) for side, of in sides.items()}
    names = list(of_side["old"])
    one = found.agg(*[F.struct(*[m.alias(n) for n, m in f.items()]).alias(side) for side, f in of_side.items()])
    rows = F.array(*[F.struct(F.lit(n).alias("field"), *[F.col(f"{side}.{n}").alias(side) for side in sides])
                     for n in names])
    return one.select(F.explode(rows).alias("r")).select("r.*")


def bounce_by_channel(found: DataFrame) -> DataFrame:
    """M4 (``t=br``) over sessions: ``name, value``, bounce rate in % per channel of the
    session's first record."""
    return found.groupBy(F.col("channel").alias("name")).agg(_bounced().alias("value"))
