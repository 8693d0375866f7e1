"""End-to-end runs of the streaming jobs over the driver tables.

The input topics are staged as Parquet files of ``topic, partition, offset,
timestamp, value`` in the shared work folder (derived from the tables by
Spark), oldest event time first, as many files per micro-batch as their size
asks for; then the jobs run with ``availableNow`` and their sink tables are returned as batch
DataFrames.  The order join's topics grow in steps, each a run of the job under its checkpoint.  This is how the registry checks stream = batch, and how a
backfill would run the same code: state is bounded by the watermark, not by
the history.
"""

from __future__ import annotations

import functools
import math
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martflow import schemas
from martflow.operators import cdc, parse
from martflow.session import work_dir
from martflow.sources import tables
from martflow.streaming import distinct_counts, first_visits, jobs, page_sessions
from martflow.streaming.offsets import OffsetLedger
from martflow.streaming.sinks import TopicFiles
from martflow.streaming.sources import read_topic

BATCHES = 4
FILE_BYTES = 2 << 20        # of the tables; as JSON, about twenty times that in a task
MAX_FILES_PER_BATCH = 10_000
SPLITS, SPLIT_BYTES = "spark.sql.files.maxPartitionBytes", 16 << 20
STEP_BYTES = 512 << 20      # of the tables; what orders and lines grow by between two runs of their join
SAMPLED, SAMPLE_ROWS = "spark.sql.execution.rangeExchange.sampleSizePerPartition", 100_000


def _small_tasks(run):
    """Tasks of ``run`` read at most :data:`SPLIT_BYTES` of files, whatever the input's size:
    Spark deals files out by cores up to 128 MB, which is some GB of JSON."""
    @functools.wraps(run)
    def with_splits(spark: SparkSession, *args, **options):
        before = spark.conf.get(SPLITS)
        spark.conf.set(SPLITS, str(SPLIT_BYTES))
        try:
            return run(spark, *args, **options)
        finally:
            spark.conf.set(SPLITS, before)
    return with_splits


def source_bytes(df: DataFrame) -> int:
    """The planner's size of the tables that ``df`` reads (no job runs; a join's own estimate
    is the product of its sides)."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(k).stats().sizeInBytes())) for k in range(leaves.size()))


def files_per_batch(df: DataFrame, batches: int, file_bytes: int = FILE_BYTES) -> int:
    """Files that a micro-batch reads, by the size of the tables that ``df`` reads."""
    return max(1, min(MAX_FILES_PER_BATCH, math.ceil(source_bytes(df) / (batches * file_bytes))))


def deal_out(df: DataFrame, path: str, n: int, ordered: bool = True, by: tuple = ("timestamp", "offset"),
             message: Callable[[DataFrame], DataFrame] | None = None) -> list[str]:
    """Write a topic frame as (up to) ``n`` files; returns their paths.

    ``ordered`` writes a range of ``by`` per file (sampled boundaries, no single-task sort),
    returned in their order.  Otherwise the rows are spread at random (input as late as it
    can be).  ``message`` makes the topic's rows of ``df``'s, after these were dealt out, so
    that columns are moved and not the longer texts.

    All rows are written, whatever is sampled.  The sample of the boundaries meets in the
    driver (three times what is asked for), so beyond :data:`SAMPLE_ROWS` there are fewer of
    it per file, which makes files less equal and leaves their order.
    """
    conf = df.sparkSession.conf
    before = conf.get(SAMPLED)
    conf.set(SAMPLED, str(max(1, min(int(before), SAMPLE_ROWS // n))))
    try:
        dealt = df.repartitionByRange(n, *by) if ordered else df.repartition(n)
        (message(dealt) if message else dealt).write.mode("overwrite").parquet(path)
    finally:
        conf.set(SAMPLED, before)
    return files_in_order(df.sparkSession, path)


def stage_topic(df: DataFrame, path: str, batches: int = BATCHES, ordered: bool = True,
                by: tuple = ("timestamp", "offset"), parts: int | None = None,
                message: Callable[[DataFrame], DataFrame] | None = None) -> int:
    """Write a topic frame for ``batches`` micro-batches of as many files each as its size
    asks for; returns that number, the reader's ``maxFilesPerTrigger``.

    ``ordered`` ranges follow one another as a log grows (by the record time, a watermark
    passes only what came before; by the offset, it is the order of arrival).
    """
    parts = parts or files_per_batch(df, batches)
    if ordered:
        publish(df.sparkSession, deal_out(df, f"{path}_ranges", batches * parts, True, by, message), path, parts)
    else:
        deal_out(df, path, batches * parts, False, message=message)
    return parts


def files_in_order(spark: SparkSession, path: str) -> list[str]:
    """The data files of one writing, by the number of their task."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)
    named = [(s.getPath().getName(), s.getPath().toString()) for s in found]
    return [at for _, at in sorted((int(name.split("-")[1]), at) for name, at in named if name.startswith("part-"))]


def publish(spark: SparkSession, files: list[str], path: str, parts: int) -> None:
    """Put ``files`` into the topic's folder, in their order, for micro-batches of ``parts``.
    A stream reads files by their time, so they get times one second apart that end now."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    folder = hadoop.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(folder)
    first = (int(time.time()) - len(files)) * 1000
    for k, file in enumerate(map(hadoop.Path, files)):
        when = first + k * 1000
        fs.setTimes(file, when, -1)
        if k == 0 and fs.getFileStatus(file).getModificationTime() != when:
            break       # no times can be set in this file system
        if not fs.rename(file, hadoop.Path(folder, file.getName())):
            raise RuntimeError(f"{file} could not be put into {path}")
    else:
        return
    for i in range(0, len(files), parts):       # a writing per micro-batch gives the order, too
        spark.read.parquet(*files[i:i + parts]).repartition(parts).write.mode("append").parquet(path)


def as_topic(df: DataFrame, topic: str, offset_col: str, time_col: str) -> DataFrame:
    """Rows as JSON messages of one topic."""
    return df.select(F.lit(topic).alias("topic"), F.lit(0).alias("partition"),
                     F.col(offset_col).cast("long").alias("offset"), F.to_timestamp(time_col).alias("timestamp"),
                     F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias("value"))


def dims_of(spark, sf_dir) -> jobs.Dims:
    """The dimensions as they are now, for each micro-batch."""
    return lambda: (tables.user_info(spark, sf_dir), tables.base_province(spark, sf_dir))


def finish(q) -> None:
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


@_small_tasks
def run_log_split(spark: SparkSession, sf_dir: str, files: int = BATCHES, base: str | None = None) -> str:
    base = base or work_dir(spark, "log_split")
    src = f"{base}/ods_base_log"
    parts = stage_topic(tables.events_with_nation(spark, sf_dir), src, files, by=("ts", "event_id"),
                        message=tables.app_log_messages)
    raw = read_topic(spark, "parquet", src, max_files_per_trigger=parts)
    finish(jobs.log_split_job(raw, f"{base}/dwd", f"{base}/_ckpt/log_split", trigger="availableNow"))
    return f"{base}/dwd"


@_small_tasks
def run_dau(spark: SparkSession, sf_dir: str, as_of=None, files: int = BATCHES, mode: str = "earliest",
            report: jobs.Report | None = None):
    """Raw log -> log split job -> page topic -> DAU job -> (daily-active table, query)."""
    base = work_dir(spark, "dau_pipeline")
    dwd = run_log_split(spark, sf_dir, files, base)
    page = jobs.read_routed(spark, dwd, parse.PAGE_TOPIC, schemas.PAGE_LOG, max_files_per_trigger=8).drop("offset")
    table = jobs.dau_table(spark, f"{base}/dau_info")
    query = jobs.dau_job(page, dims_of(spark, sf_dir), table, f"{base}/_ckpt/dau", "availableNow",
                         as_of=as_of, mode=mode, report=report)
    finish(query)
    return table, query


@_small_tasks
def run_order_join(spark: SparkSession, sf_dir: str, as_of=None, files: int = BATCHES, line_files: int | None = None,
                   ordered: bool = True, reconcile: bool = False, step_bytes: int = STEP_BYTES):
    """Order and line topics -> order join job -> (wide-order table, late rows, reconciled pairs).

    ``line_files`` below ``files`` lets the lines run ahead of their orders.  Both topics grow
    in steps, as many as their tables have ``step_bytes``; the job goes on from its checkpoint
    and reads each in ``files`` micro-batches.  So the join's state is that of a step's rows at
    most, and lines are no more than a step ahead, however long the history is.
    """
    base = work_dir(spark, "order_join")
    orders, lines = tables.order_info(spark, sf_dir), tables.order_detail(spark, sf_dir)
    o_src, d_src, line_files = f"{base}/order_info", f"{base}/order_detail", line_files or files
    by = (F.to_timestamp("create_time"), F.col("id"))
    steps = max(1, math.ceil(source_bytes(lines) / step_bytes))
    o_parts, d_parts = files_per_batch(orders, steps * files), files_per_batch(lines, steps * line_files)
    o_files = deal_out(orders, f"{o_src}_ranges", steps * files * o_parts, ordered, by,
                       lambda rows: as_topic(rows, "DWD_ORDER_INFO_I", "id", "create_time"))
    d_files = deal_out(lines, f"{d_src}_ranges", steps * line_files * d_parts, ordered, by,
                       lambda rows: as_topic(rows, "DWD_ORDER_DETAIL_I", "id", "create_time"))
    table, late = jobs.order_wide_table(spark, f"{base}/order_wide"), 0
    for step in range(steps):
        publish(spark, _share(o_files, step, steps), o_src, o_parts)
        publish(spark, _share(d_files, step, steps), d_src, d_parts)
        o = (read_topic(spark, "parquet", o_src, max_files_per_trigger=o_parts)
             .select(F.from_json("value", schemas.ORDER_INFO_RAW).alias("r")).select("r.*"))
        d = (read_topic(spark, "parquet", d_src, max_files_per_trigger=d_parts)
             .select(F.from_json("value", schemas.ORDER_DETAIL).alias("r")).select("r.*"))
        with jobs.Progress(spark) as progress:
            query = jobs.order_join_job(o, d, dims_of(spark, sf_dir), table, f"{base}/_ckpt/join", "availableNow", as_of=as_of)
            finish(query)
            late += jobs.late_rows(query, progress)
    missed = jobs.reconcile_orders(orders, lines, dims_of(spark, sf_dir), table, as_of=as_of) if reconcile else 0
    return table, late, missed


def _share(files: list[str], step: int, steps: int) -> list[str]:
    """The files that arrive before a step of ``steps``."""
    return files[len(files) * step // steps:len(files) * (step + 1) // steps]


@_small_tasks
def run_cdc(spark: SparkSession, sf_dir: str, files: int = BATCHES, apply_deletes: bool = False,
            checkpoints: int = 1):
    """Change topic -> change split job -> (fact topic files, dimension table).

    ``checkpoints`` > 1 cuts the topic in as many parts and runs each under a
    checkpoint of its own, the newest part first: batch ids restart and older
    changes come after newer ones, as after a lost checkpoint."""
    base = work_dir(spark, "cdc_split")
    facts = TopicFiles(spark, f"{base}/dwd")
    dims_table = jobs.dimension_table(spark, f"{base}/dim")
    log = tables.change_log(spark, sf_dir)
    for k in reversed(range(checkpoints)):
        part = log.where(F.pmod(F.col("offset"), F.lit(checkpoints)) == k)
        src = f"{base}/ods_base_db_{k}"
        raw = read_topic(spark, "parquet", src, max_files_per_trigger=stage_topic(part, src, files))
        finish(jobs.cdc_split_job(raw, facts, dims_table,
                                  lambda: cdc.table_list(spark, cdc.FACT_TABLES),
                                  lambda: cdc.table_list(spark, cdc.DIM_TABLES),
                                  f"{base}/_ckpt/cdc_{k}", "availableNow", apply_deletes=apply_deletes))
    return facts, dims_table


@_small_tasks
def run_sessions(spark: SparkSession, sf_dir: str, files: int = BATCHES) -> "page_sessions.SessionStore":
    """Page log in random order -> session job -> the store that answers with the sessions."""
    base = work_dir(spark, "sessions")
    log = tables.page_log(spark, sf_dir, with_province=False)
    parts = stage_topic(log, f"{base}/page", files, ordered=False)
    page = (spark.readStream.schema(schemas.PAGE_LOG).option("maxFilesPerTrigger", str(parts)).parquet(f"{base}/page"))
    store = page_sessions.SessionStore(spark, f"{base}/store")
    finish(page_sessions.session_job(page, store, f"{base}/_ckpt", "availableNow"))
    return store


@_small_tasks
def run_first_visits(spark: SparkSession, sf_dir: str, as_of=None, files: int = 2, runs: int = 1):
    """Page log in random order -> first-visit job -> (daily-active table, hourly counts).

    With several ``runs`` each has a checkpoint of its own and reads the whole topic, as
    after a lost checkpoint; state and counts come from the table."""
    base = work_dir(spark, "first_visits")
    parts = stage_topic(tables.page_log(spark, sf_dir), f"{base}/page", files, ordered=False)
    table, hourly = jobs.dau_table(spark, f"{base}/dau"), first_visits.RunningCounts(spark, f"{base}/hourly")
    for k in range(runs):
        page = (spark.readStream.schema(schemas.PAGE_LOG).option("maxFilesPerTrigger", str(parts)).parquet(f"{base}/page"))
        first_visits.drain(first_visits.first_visit_job(
            page, dims_of(spark, sf_dir), table, f"{base}/_ckpt/{k}", hourly, trigger="availableNow", as_of=as_of))
    return table, hourly


@_small_tasks
def run_page_counts(spark: SparkSession, sf_dir: str, files: int = 2) -> "distinct_counts.DistinctStore":
    """Page log in random order -> distinct-count job -> its store of sets and sums per day."""
    base = work_dir(spark, "page_counts")
    log = distinct_counts.page_days(tables.page_log(spark, sf_dir, with_province=False)).select(
        "dt", "mid", "user_id", "is_new")
    parts = stage_topic(log, f"{base}/page", files, ordered=False)
    rows = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", str(parts)).parquet(f"{base}/page")
    store = distinct_counts.page_store(spark, f"{base}/store")
    finish(distinct_counts.distinct_job(rows, store, f"{base}/_ckpt", "availableNow"))
    return store


@_small_tasks
def run_order_counts(spark: SparkSession, sf_dir: str, files: int = 2) -> "distinct_counts.DistinctStore":
    """Orders in random order -> distinct-count job -> its store of sets, sums and debuts per day."""
    base = work_dir(spark, "order_counts")
    orders = distinct_counts.order_days(tables.order_info(spark, sf_dir, with_province=False)).select(
        "dt", "user_id", "final_total_amount")
    parts = stage_topic(orders, f"{base}/orders", files, ordered=False)
    rows = spark.readStream.schema(orders.schema).option("maxFilesPerTrigger", str(parts)).parquet(f"{base}/orders")
    store = distinct_counts.order_store(spark, f"{base}/store")
    finish(distinct_counts.distinct_job(rows, store, f"{base}/_ckpt", "availableNow"))
    return store


PARTITIONS = 4


@_small_tasks
def run_ledger(spark: SparkSession, sf_dir: str, files: int = BATCHES, checkpoints: int = 1):
    """Change topic of several partitions, in order of arrival -> change split job with an
    offset ledger -> (fact topic files, ledger).

    With several ``checkpoints`` the topic grows between runs, and each run has a checkpoint
    of its own and only the ledger to tell what was read."""
    base = work_dir(spark, "offset_ledger")
    log = tables.change_log(spark, sf_dir).withColumn("partition", F.pmod("offset", F.lit(PARTITIONS)).cast("int"))
    parts = stage_topic(log, f"{base}/topic", files, by=("offset",))
    facts, dims_table = TopicFiles(spark, f"{base}/dwd"), jobs.dimension_table(spark, f"{base}/dim")
    ledger = OffsetLedger(spark, f"{base}/offsets")
    half = log.selectExpr("percentile_approx(offset, 0.5)").scalar()
    for k in range(checkpoints):
        src = f"{base}/topic"
        if k + 1 < checkpoints:     # what had arrived by then
            src = f"{base}/topic_{k}"
            stage_topic(log.where(F.col("offset") < half), src, files, by=("offset",), parts=parts)
        raw = read_topic(spark, "parquet", src, max_files_per_trigger=parts)
        raw = ledger.unread(raw, "ods_base_db_group")
        finish(jobs.cdc_split_job(raw, facts, dims_table, lambda: cdc.table_list(spark, cdc.FACT_TABLES),
                                  lambda: cdc.table_list(spark, cdc.DIM_TABLES), f"{base}/_ckpt/{k}", "availableNow",
                                  ledger=ledger, group="ods_base_db_group"))
    return facts, ledger
