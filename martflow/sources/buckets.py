"""Orders and lines stored by order key, so that they join where they lie.

Both tables are bucketed by the order's id into the same number of files, which follows
their size.  A join on the id, and an aggregate after it by the id, then reads bucket by
bucket without an exchange.  The one shuffle is paid when the tables are written.

A bucket can't be split when it is read, so lines of an order that has :data:`HOT_LINES` or
more are kept apart, with a copy of their orders, in tables without buckets; that join is
planned as any other (a broadcast of the few orders if their bytes are small, else a shuffle
that AQE splits).  Answers are the union of both and so whole.

Orders are stored as enriched, with the user and province of the time of writing, as the
stream's sink has them.  Lines without an order id, or of an order that isn't there, join
with nothing; an order id that is there twice joins twice.  Names are looked up in the
session's catalog, whose tables lie below ``path``.
"""

from __future__ import annotations

import math
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martflow.operators import orders as ops
from martflow.operators.dims import sized_side

HOT_LINES = 100_000             # lines of one order; more are kept apart
BUCKET_BYTES = 16 << 20         # of the files that the lines come from; a task sorts a bucket, some 20 times that
MAX_BUCKETS = 50_000            # more bytes make larger buckets, which sort on disk


def buckets_for(df: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> int:
    """Number of buckets by the planner's size of the tables that ``df`` reads; no job runs."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    size = sum(int(str(leaves.apply(k).stats().sizeInBytes())) for k in range(leaves.size()))
    return max(8, min(MAX_BUCKETS, math.ceil(size / bucket_bytes)))


class OrderBuckets:
    """``orders`` (enriched rows, key ``id``) and ``lines`` (key ``order_id``) of one writing."""

    def __init__(self, spark: SparkSession, path: str, orders: DataFrame, lines: DataFrame, buckets: int | None = None,
                 hot_lines: int = HOT_LINES):
        self.spark, self.path, self.buckets = spark, path.rstrip("/"), buckets or buckets_for(lines)
        tag = uuid.uuid4().hex[:12]
        self.names = {"orders": f"orders_{tag}", "lines": f"lines_{tag}"}
        # sums per task meet first, so a hot order is a row per task here
        hot = lines.groupBy("order_id").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= hot_lines)
        hot.where("order_id IS NOT NULL").select(F.col("order_id").alias("_hot")).write.parquet(f"{self.path}/hot_keys")
        keys = sized_side(spark.read.parquet(f"{self.path}/hot_keys"))
        is_hot = lambda c: F.col(c) == F.col("_hot")
        self._store("orders", orders, "id")
        self._store("lines", lines.join(keys, is_hot("order_id"), "left_anti"), "order_id")
        orders.join(keys, is_hot("id"), "left_semi").write.parquet(f"{self.path}/hot_orders")
        lines.join(keys, is_hot("order_id"), "left_semi").write.parquet(f"{self.path}/hot_lines")

    def _store(self, what: str, rows: DataFrame, key: str) -> None:
        # a task per bucket, by the hash that the buckets use, so a bucket is one sorted file
        (rows.where(F.col(key).isNotNull()).repartition(self.buckets, key)
             .write.bucketBy(self.buckets, key).sortBy(key).option("path", f"{self.path}/{what}")
             .format("parquet").saveAsTable(self.names[what]))

    def orders(self) -> DataFrame:
        return self.spark.table(self.names["orders"])

    def lines(self) -> DataFrame:
        """The lines in buckets, without those of hot orders."""
        return self.spark.table(self.names["lines"])

    def _both(self, join) -> DataFrame:
        """``join(orders, lines)`` over the buckets and over what is kept apart."""
        hot = sized_side(self.spark.read.parquet(f"{self.path}/hot_orders"))
        return join(self.orders(), self.lines()).unionByName(join(hot, self.spark.read.parquet(f"{self.path}/hot_lines")))

    def order_wide(self) -> DataFrame:
        """:func:`orders.order_wide` of all orders and lines."""
        return self._both(ops.order_wide)

    def order_wide_within(self, order_time: Column, detail_time: Column, bound: str = "24 hours") -> DataFrame:
        """D8 with the time bound, event times as expressions of the stored columns."""
        return self._both(lambda o, d: ops.order_wide_within(
            o.withColumn("_et", order_time), d.withColumn("_et", detail_time), "_et", "_et", bound))

    def sold_lines(self, first: str, last: str) -> DataFrame:
        """``sku_id, split_total_amount`` of the lines whose order is of these days."""
        def join(o, d):
            of_days = o.where(F.col("create_date").between(first, last)).select(F.col("id").alias("_order"))
            return d.join(of_days, d.order_id == F.col("_order"), "left_semi").select("sku_id", "split_total_amount")
        return self._both(join)

    def drop(self) -> None:
        """Take the tables out of the catalog; the files stay for readers under way."""
        for name in self.names.values():
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
