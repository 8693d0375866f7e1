"""Distinct counts over any range of days, from state that merges (M1, M2, M7).

A dashboard asks for distinct devices of a day, of 7 days, of 30.  Counts of days don't add
up to those of a range, so what is kept is mergeable and exact:

* every member of a set (device, user) has a dense number, given once, in a stored dictionary;
* per set and day the members are bitmaps of 32,768 numbers each (``bitmap_construct_agg``),
  which are or-ed over batches, days and levels of the table, and counted at the end;
* views, orders and amounts are sums per day, added up over batches;
* the day of a user's first order is a row per user, and a debut that moves to an earlier
  day takes one from the old day and adds one to the new, so that first-time buyers of a
  range are a sum, too.

A micro-batch writes its own bitmaps and sums and reads none back (:class:`MergeTable`);
only members are looked up, in the dictionary and among the first orders.  An answer reads
the bitmaps and sums of its days, never the log or older orders.

Order of arrival doesn't matter.  A replayed batch replaces what it wrote; it gives the same
numbers again, as they follow from the dictionary without that batch.  One query at a time
writes a store, since two would give the same numbers to different members.  Rows without a
day, and null members, count in no set; sums take every row that has a day.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from martflow.functions.dates import day_of_millis, text_day
from martflow.streaming import jobs
from martflow.streaming.sinks import KeyedTable, writer_tag

SHARDS = 64     # of a dictionary; each numbers its own members, and they are equally large
LANES = 8       # folders of a batch of first days
TASK_ROWS = 400_000     # members (day and set) of a batch that a task of its shuffles holds, about
SHUFFLES, READ_BYTES = "spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes"
TASK_BYTES = 8 << 20    # of shuffled rows that adaptive execution puts together for a task at most

# The sets and sums of the dashboard: set -> (member column, condition), sum -> whole number per row.
PAGE_SETS = {"uv": ("mid", "true"), "uv_new": ("mid", "is_new = '1'"),
             "users": ("user_id", "true"), "users_new": ("user_id", "is_new = '1'")}
PAGE_SUMS = {"pv": "1"}
ORDER_SETS = {"buyers": ("user_id", "true")}
ORDER_SUMS = {"orders": "1", "cents": "CAST(CAST(final_total_amount AS DECIMAL(18,2)) * 100 AS BIGINT)"}
DEBUTS = "debuts"


class MergeTable(KeyedTable):
    """A keyed table whose rows of one key are merged instead of replaced: ``merge`` has an
    aggregate for every other column, one that may be applied in any order and in parts."""

    def __init__(self, spark: SparkSession, path: str, keys: list[str], slice_col: str,
                 merge: dict[str, Callable[[Column], Column]], **options):
        super().__init__(spark, path, keys, slice_col, **options)
        self.merge = merge

    def _merged(self) -> list[Column]:
        return [f(F.col(c)).alias(c) for c, f in self.merge.items()]

    def _resolve(self, raw: DataFrame) -> DataFrame:
        group = self.keys + ([self.slice_col] if self.slice_col not in self.keys else [])
        return raw.groupBy(*group).agg(*self._merged(), F.max(self.VERSION).alias(self.VERSION),
                                       F.lit(False).alias(self.DELETED))

    def over(self, by: list[str], where: Column) -> DataFrame | None:
        """The rows that ``where`` keeps merged to the columns ``by``, in one aggregate."""
        raw = self._raw()
        return None if raw is None else raw.where(where).groupBy(*by).agg(*self._merged())

    def delete(self, ids: DataFrame, batch_id: int, writer: str = "") -> None:
        raise NotImplementedError("merged rows can't be taken out again")


def _month(day: str = "dt") -> Column:
    """The storage slice of a day, ``yyyyMM``."""
    return F.concat(F.substring(day, 1, 4), F.substring(day, 6, 2))


def _shard() -> Column:
    return F.pmod(F.xxhash64("domain", "member"), F.lit(SHARDS)).cast("int")


class DistinctStore:
    """Sets and sums per day (``dt``) of one stream; ``debut`` names the column of a set whose
    members' first days are counted, too, under :data:`DEBUTS`."""

    def __init__(self, spark: SparkSession, path: str, sets: dict[str, tuple[str, str]], sums: dict[str, str],
                 debut: str | None = None):
        self.spark, self.sets, self.sums, self.debut, path = spark, sets, sums, debut, path.rstrip("/")
        self.members = KeyedTable(spark, f"{path}/members", keys=["domain", "member"], slice_col="domain")
        self.bits = MergeTable(spark, f"{path}/bits", ["name", "dt", "bucket"], "month", {"bits": F.bitmap_or_agg},
                               slice_expr=_month())
        self.counts = MergeTable(spark, f"{path}/counts", ["name", "dt"], "month", {"n": F.sum}, slice_expr=_month())
        self.first = KeyedTable(spark, f"{path}/first", keys=["member"], slice_col="lane", order_cols=["dt"],
                                slice_expr=F.pmod(F.xxhash64("member"), F.lit(LANES)), keep="earliest")

    # ------------------------------------------------------------ writing

    def add(self, rows: DataFrame, batch_id: int, writer: str = "") -> None:
        """Take in a micro-batch: rows with a day ``dt`` (text) and the columns of sets and sums.
        Its shuffles have as many partitions as its rows ask for, at least the session's."""
        rows = rows.where("dt IS NOT NULL")
        conf = rows.sparkSession.conf
        before = {key: conf.get(key) for key in (SHUFFLES, READ_BYTES)}
        conf.set(SHUFFLES, str(max(int(before[SHUFFLES]), -(-rows.count() * len(self.sets) // TASK_ROWS))))
        conf.set(READ_BYTES, str(TASK_BYTES))
        try:
            self._add_sets(rows, batch_id, writer)
            changes = self._sums(rows)
            if self.debut is not None:
                changes = changes.unionByName(self._add_debuts(rows, batch_id, writer))
            self.counts.upsert(changes.groupBy("name", "dt").agg(F.sum("n").alias("n")), batch_id, writer)
        finally:
            for key, value in before.items():
                conf.set(key, value)

    def _add_sets(self, rows: DataFrame, batch_id: int, writer: str) -> None:
        one = [F.when(F.expr(where), F.struct(F.lit(name).alias("name"), F.lit(col).alias("domain"),
                                              F.col(col).cast("string").alias("member")))
               for name, (col, where) in self.sets.items()]
        seen = (rows.select("dt", F.explode(F.array(*one)).alias("m")).select("dt", "m.*")
                .where("member IS NOT NULL").distinct().persist())
        try:
            self._number(seen.select("domain", "member").distinct(), batch_id, writer)
            if (known := self.members.read()) is None:
                return
            placed = seen.join(known.select("domain", "member", "number"), ["domain", "member"])
            bits = placed.groupBy("name", "dt", F.bitmap_bucket_number("number").alias("bucket")).agg(
                F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits"))
            self.bits.upsert(bits, batch_id, writer)
        finally:
            seen.unpersist()

    def _number(self, members: DataFrame, batch_id: int, writer: str) -> None:
        """Give the members that the dictionary lacks their numbers.  Numbers of a shard are
        shard + 1, shard + 1 + SHARDS ...; shards hold distinct members by hash, so none is
        much larger than another and the numbers are dense."""
        known = self.members.read_but(batch_id, writer)
        new = members.withColumn("shard", _shard())
        place = F.row_number().over(Window.partitionBy("domain", "shard").orderBy("member")).cast("long")
        taken = F.lit(0).cast("long")
        if known is not None:
            new = new.join(known.select("domain", "member"), ["domain", "member"], "left_anti")
            used = known.groupBy("domain", "shard").agg(
                F.floor((F.max("number") - 1) / SHARDS).alias("last"))
            new = new.join(used, ["domain", "shard"], "left")
            taken = F.coalesce(F.col("last") + 1, F.lit(0))
        number = ((taken + place - 1) * SHARDS + F.col("shard") + 1).cast("long")
        self.members.upsert(new.select("domain", "member", "shard", number.alias("number")), batch_id, writer)

    def _sums(self, rows: DataFrame) -> DataFrame:
        per_day = rows.groupBy("dt").agg(*[F.sum(F.expr(e)).cast("long").alias(name) for name, e in self.sums.items()])
        each = F.array(*[F.struct(F.lit(name).alias("name"), F.col(name).alias("n")) for name in self.sums])
        return per_day.select("dt", F.explode(each).alias("s")).select("s.name", "dt", "s.n").where("n IS NOT NULL")

    def _add_debuts(self, rows: DataFrame, batch_id: int, writer: str) -> DataFrame:
        """Renew the first days; returns ``name, dt, n``, what that changes in the days' counts."""
        firsts = (rows.select(F.col(self.debut).cast("string").alias("member"), "dt").where("member IS NOT NULL")
                  .groupBy("member").agg(F.min("dt").alias("dt")))
        known = self.first.read_but(batch_id, writer)
        if known is None:
            moved = firsts.withColumn("was", F.lit(None).cast("string"))
        else:
            moved = firsts.join(known.select("member", F.col("dt").alias("was")), "member", "left").where(
                "was IS NULL OR dt < was")
        self.first.upsert(moved.select("member", "dt"), batch_id, writer)
        steps = F.array(F.struct("dt", F.lit(1).cast("long").alias("n")),
                        F.struct(F.col("was").alias("dt"), F.lit(-1).cast("long").alias("n")))
        return (moved.select(F.explode(steps).alias("s")).select(F.lit(DEBUTS).alias("name"), "s.dt", "s.n")
                .where("dt IS NOT NULL"))

    # ------------------------------------------------------------ answers

    @staticmethod
    def _between(first: str, last: str) -> Column:
        month = lambda d: d[:4] + d[5:7]
        return F.col("dt").between(first, last) & F.col("month").between(month(first), month(last))

    def _answer(self, by: list[str], first: str, last: str) -> DataFrame:
        where, out = self._between(first, last), None
        bits = self.bits.over([*by, "bucket"], where)
        counts = self.counts.over(by, where)
        if bits is not None:
            out = bits.groupBy(*by).agg(F.sum(F.bitmap_count("bits")).alias("n"))
        if counts is not None:
            out = counts if out is None else out.unionByName(counts)
        return out if out is not None else self.spark.createDataFrame([], ", ".join(f"{c} string" for c in by) + ", n long")

    def per_day(self, first: str, last: str) -> DataFrame:
        """``name, dt, n``: sizes of the sets and the sums, day by day."""
        return self._answer(["name", "dt"], first, last)

    def total(self, first: str, last: str) -> DataFrame:
        """``name, n``: sizes of the sets and the sums over all days of the range together."""
        return self._answer(["name"], first, last)


def page_store(spark: SparkSession, path: str) -> DistinctStore:
    return DistinctStore(spark, path, PAGE_SETS, PAGE_SUMS)


def order_store(spark: SparkSession, path: str) -> DistinctStore:
    return DistinctStore(spark, path, ORDER_SETS, ORDER_SUMS, debut="user_id")


def distinct_job(rows: DataFrame, store: DistinctStore, checkpoint: str, trigger: str | None = None) -> StreamingQuery:
    """Keep a store up to date with a stream that has a day ``dt``."""
    def each(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()     # read for the sets, the sums and the first days
        try:
            store.add(batch, batch_id, writer_tag(checkpoint))
        finally:
            batch.unpersist()
    return jobs._start(rows.writeStream.foreachBatch(each), checkpoint, trigger, "distinct_counts")


def page_days(page_log: DataFrame) -> DataFrame:
    return page_log.withColumn("dt", day_of_millis("ts"))


def order_days(orders: DataFrame) -> DataFrame:
    return orders.withColumn("dt", text_day("create_time"))
