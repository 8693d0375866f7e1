"""Sessions kept up to date from a page-log stream, whatever the order of arrival.

A late record can lengthen, split or join sessions, so no session is final when it is
written.  What changes is narrow, though: a record touches the segment of its device and
hour only (:mod:`martflow.operators.sessions`).  Each micro-batch stores its records, reads
the touched segments of the touched days back, makes their fragments anew and upserts them.
Sessions are stitched from the stored fragments when they are asked for, so a dashboard
reads fragments, not the log.

Both outputs are keyed by (writer, batch id): a replayed batch replaces what it wrote.  A
segment's openings only grow in number, so its fragments are replaced one by one; fragment
0 alone can vanish, and is written as deleted then.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from martflow.functions.dates import day_of_millis
from martflow.operators import sessions as ops
from martflow.streaming import jobs
from martflow.streaming.sinks import KeyedTable, writer_tag


class SessionStore:
    """The stored records, by day and batch, and the fragments of their segments."""

    def __init__(self, spark: SparkSession, path: str, slice_unit: str = ops.SLICE):
        self.spark, self.log_path, self.slice_unit = spark, f"{path.rstrip('/')}/records", slice_unit
        self.parts = KeyedTable(spark, f"{path.rstrip('/')}/fragments", keys=["mid", "slice", "k"], slice_col="dt",
                                slice_expr=day_of_millis("slice"))

    def _segments(self, log: DataFrame) -> DataFrame:
        return log.select("mid", F.unix_millis(F.date_trunc(self.slice_unit, F.timestamp_millis("ts"))).alias("slice"))

    def add(self, batch: DataFrame, batch_id: int, writer: str) -> None:
        """Store a micro-batch and renew the fragments of the segments it touches."""
        rows = batch.select("mid", "ts", *ops.READ).withColumn("dt", day_of_millis("ts")).persist()
        try:
            (rows.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("dt")
                 .parquet(f"{self.log_path}/_batch=b{writer}_{batch_id:012d}"))
            days = [r.dt for r in rows.select("dt").distinct().collect()]   # a batch has few
            touched = self._segments(rows).distinct()
            log = self.spark.read.schema(f"{rows.drop('dt')._jdf.schema().toDDL()}, _batch string, dt string").parquet(self.log_path)
            log = log.where(F.col("dt").isin(days)).drop("_batch", "dt")
            mine = log.withColumns({"_mid": F.col("mid"), "_slice": F.unix_millis(
                F.date_trunc(self.slice_unit, F.timestamp_millis("ts")))})
            mine = mine.join(touched.select(F.col("mid").alias("_mid"), F.col("slice").alias("_slice")),
                             ["_mid", "_slice"], "left_semi").drop("_mid", "_slice")
            parts = ops.fragments(mine, self.slice_unit).withColumn(KeyedTable.DELETED, F.lit(False))
            no_start = touched.join(parts.where("k = 0"), ["mid", "slice"], "left_anti").select(
                "mid", "slice", F.lit(0).cast("long").alias("k"), F.lit(True).alias(KeyedTable.DELETED))
            self.parts.upsert(parts.unionByName(no_start, allowMissingColumns=True), batch_id, writer)
        finally:
            rows.unpersist()

    def sessions(self, days: list[str] | None = None) -> DataFrame:
        """All sessions, or those of the records of some days."""
        parts = self.parts.table()
        return ops.stitch((parts if days is None else parts.where(F.col("dt").isin(days))).drop("dt"))


def session_job(page_log: DataFrame, store: SessionStore, checkpoint: str, trigger: str | None = None) -> StreamingQuery:
    """Keep ``store`` up to date with a page-log stream."""
    def each(batch: DataFrame, batch_id: int) -> None:
        store.add(batch, batch_id, writer_tag(checkpoint))
    return jobs._start(page_log.writeStream.foreachBatch(each), checkpoint, trigger, "sessions")
