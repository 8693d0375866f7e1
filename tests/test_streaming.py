"""Streaming jobs: stream = batch, restart, replay, arrival order."""

import datetime
import json

import pytest
from pyspark.sql import functions as F

from martflow import schemas
from martflow.plans.catalog import Catalog
from martflow.sources import tables
from martflow.streaming import jobs, pipeline
from martflow.streaming.sinks import KeyedTable

from conftest import SF_SMALL

AS_OF = "2024-01-31"


def rows(df, cols=None):
    cols = cols or sorted(df.columns)
    return sorted(tuple(r[c] for c in cols) for r in df.select(*cols).collect())


def test_dau_stream_equals_batch_over_several_files(spark):
    batch = Catalog(spark, SF_SMALL, AS_OF).dau_info()
    table, _ = pipeline.run_dau(spark, SF_SMALL, as_of=AS_OF, files=3)
    assert rows(table.table().select(*schemas.names(schemas.DAU_INFO))) == rows(batch)


def test_dau_restart_on_same_checkpoint(spark, tmp_dir):
    page = tables.page_log(spark, SF_SMALL).withColumn("_id", F.monotonically_increasing_id())
    page = page.withColumn("_half", (F.col("ts") >= page.selectExpr("percentile_approx(ts, 0.5)").first()[0]))
    src = f"{tmp_dir}/page_src"
    page.where(~F.col("_half")).drop("_id", "_half").write.mode("append").parquet(src)
    table = jobs.dau_table(spark, f"{tmp_dir}/dau")
    dims = lambda: (tables.user_info(spark, SF_SMALL), tables.base_province(spark, SF_SMALL))

    def run():
        s = spark.readStream.schema(schemas.PAGE_LOG).parquet(src)
        q = jobs.dau_job(s, dims, table, f"{tmp_dir}/ckpt", "availableNow", as_of=AS_OF)
        q.awaitTermination()
    run()
    first = table.table().count()
    page.where(F.col("_half")).drop("_id", "_half").write.mode("append").parquet(src)
    run()  # restart: only the new file is read, state carries the seen devices
    batch = Catalog(spark, SF_SMALL, AS_OF).dau_info()
    assert 0 < first < table.table().count()
    assert rows(table.table().select(*schemas.names(schemas.DAU_INFO))) == rows(batch)


def test_keyed_sink_replay_is_idempotent(spark, tmp_dir):
    t = KeyedTable(spark, f"{tmp_dir}/kt", keys=["id"], slice_col="dt")
    b0 = spark.createDataFrame([(1, "2024-01-01", "a"), (2, "2024-01-02", "b")], "id long, dt string, v string")
    t.upsert(b0, 0)
    t.upsert(b0, 0)  # replay of batch 0
    assert rows(t.table()) == [("2024-01-01", 1, "a"), ("2024-01-02", 2, "b")]
    b1 = spark.createDataFrame([(2, "2024-01-02", "c")], "id long, dt string, v string")
    t.upsert(b1, 1)
    t.upsert(b1, 1)
    assert rows(t.table()) == [("2024-01-01", 1, "a"), ("2024-01-02", 2, "c")]
    t.delete(spark.createDataFrame([(1,)], "id long"), 2)
    assert rows(t.table()) == [("2024-01-02", 2, "c")]


# ---------------------------------------------------------------- order join cases

def _order(i, t, user=1, prov=1):
    return {"id": i, "province_id": prov, "order_status": "1001", "user_id": user,
            "final_total_amount": 10.0, "activity_reduce_amount": 0.0, "coupon_reduce_amount": 0.0,
            "original_total_amount": 10.0, "feight_fee": 0.0, "feight_fee_reduce": 0.0,
            "create_time": t}


def _detail(i, oid, t):
    return {"id": i, "order_id": oid, "sku_id": 7, "order_price": 2.5, "sku_num": 2,
            "sku_name": "red bolt", "create_time": t, "split_total_amount": 5.0,
            "split_activity_amount": 0.0, "split_coupon_amount": 0.0}


class Join:
    def __init__(self, spark, base):
        self.spark, self.base, self.step = spark, base, 0
        self.table = jobs.order_wide_table(spark, f"{base}/wide", slice_by="day")

    def push(self, orders=(), details=()):
        for name, recs in (("o", orders), ("d", details)):
            if recs:
                df = self.spark.createDataFrame([(json.dumps(r),) for r in recs], "value string")
                df.coalesce(1).write.mode("append").text(f"{self.base}/{name}")
            else:  # keep both sources readable
                self.spark.createDataFrame([], "value string").coalesce(1).write.mode("append").text(
                    f"{self.base}/{name}")

    def run(self):
        o = (self.spark.readStream.text(f"{self.base}/o")
             .select(F.from_json("value", schemas.ORDER_INFO_RAW).alias("r")).select("r.*"))
        d = (self.spark.readStream.text(f"{self.base}/d")
             .select(F.from_json("value", schemas.ORDER_DETAIL).alias("r")).select("r.*"))
        dims = lambda: (tables.user_info(self.spark, SF_SMALL), tables.base_province(self.spark, SF_SMALL))  # noqa
        q = jobs.order_join_job(o, d, dims, self.table, f"{self.base}/ckpt", "availableNow", as_of=AS_OF)
        q.awaitTermination()
        assert q.exception() is None

    def result(self):
        try:
            return {r["detail_id"]: r for r in self.table.table().collect()}
        except FileNotFoundError:
            return {}


def test_order_join_arrival_orders(spark, tmp_dir):
    j = Join(spark, tmp_dir)
    # order first, line in a later batch
    j.push(orders=[_order(1, "2024-01-01 10:00:00")])
    j.run()
    j.push(details=[_detail(11, 1, "2024-01-01 10:05:00")])
    j.run()
    # line first, order later
    j.push(details=[_detail(21, 2, "2024-01-01 11:00:00")])
    j.run()
    j.push(orders=[_order(2, "2024-01-01 10:59:00")])
    j.run()
    # same batch; and an order with 3 lines over two batches
    j.push(orders=[_order(3, "2024-01-01 12:00:00"), _order(4, "2024-01-01 12:00:00")],
           details=[_detail(31, 3, "2024-01-01 12:00:00"), _detail(41, 4, "2024-01-01 12:01:00")])
    j.run()
    j.push(details=[_detail(42, 4, "2024-01-01 12:02:00"), _detail(43, 4, "2024-01-01 13:00:00")])
    j.run()
    # a line without order, an order without line, a line 25 h after its order
    j.push(orders=[_order(5, "2024-01-01 09:00:00"), _order(6, "2024-01-01 09:00:00")],
           details=[_detail(99, 98, "2024-01-01 09:00:00"), _detail(61, 6, "2024-01-02 10:00:01")])
    j.run()
    got = j.result()
    assert sorted(got) == [11, 21, 31, 41, 42, 43]
    # the wide row takes the line's create_time, the order's create_date/hour
    r = got[11]
    assert r["create_time"] == "2024-01-01 10:05:00" and r["create_hour"] == "10"
    r = got[21]
    assert r["create_time"] == "2024-01-01 11:00:00" and r["create_hour"] == "10"
    assert r["order_id"] == 2 and r["user_gender"] == "M" and r["province_name"] == "NATION_1"


@pytest.mark.parametrize("files, line_files", [(1, 1), (2, 2), (4, 4), (8, 8), (6, 2), (2, 5)])
def test_order_join_is_the_batch_join_for_any_number_of_batches(spark, files, line_files):
    batch = Catalog(spark, SF_SMALL, AS_OF).order_wide
    table, late, _ = pipeline.run_order_join(spark, SF_SMALL, as_of=AS_OF, files=files, line_files=line_files)
    assert late == 0
    assert rows(table.table().select(*schemas.names(schemas.ORDER_WIDE))) == rows(batch)


def test_order_join_reports_late_rows_and_reconciles_them(spark):
    batch = Catalog(spark, SF_SMALL, AS_OF).order_wide
    table, late, missed = pipeline.run_order_join(spark, SF_SMALL, as_of=AS_OF, files=4, ordered=False, reconcile=True)
    assert late > 0 and missed > 0
    assert rows(table.table().select(*schemas.names(schemas.ORDER_WIDE))) == rows(batch)


def test_counts_do_not_depend_on_the_progress_that_a_query_keeps(spark):
    """A query that keeps only its last progress record still reports all batches."""
    from martflow.plans.registry import REGISTRY
    build = REGISTRY["stream_batch_counts"][0]
    want = rows(build(spark, SF_SMALL))
    key = "spark.sql.streaming.numRecentProgressUpdates"
    spark.conf.set(key, "1")
    try:
        got = rows(build(spark, SF_SMALL))
        _, late, _ = pipeline.run_order_join(spark, SF_SMALL, as_of=AS_OF, files=4, ordered=False)
    finally:
        spark.conf.unset(key)
    page = tables.page_log(spark, SF_SMALL).where("page_id in ('view', 'click', 'purchase')")
    assert got == want and (page.count(), "input") in got
    assert late > 0


def test_cdc_table_list_edit_applies_next_batch(spark, tmp_dir):
    from martflow.operators import cdc
    from martflow.streaming.sinks import TopicFiles
    src, conf = f"{tmp_dir}/src", f"{tmp_dir}/fact_tables"
    rec = lambda t, i: json.dumps({"type": "insert", "table": t, "data": {"id": i}})
    cdc.table_list(spark, ["order_info"]).write.mode("overwrite").parquet(conf)
    facts = TopicFiles(spark, f"{tmp_dir}/dwd")
    dims_t = jobs.dimension_table(spark, f"{tmp_dir}/dim")
    topic = "topic string, partition int, offset long, timestamp timestamp, value string"

    def run(values, start):
        spark.createDataFrame([("ODS", 0, start + k, datetime.datetime(2024, 1, 1, 0, 0, start + k), v)
                               for k, v in enumerate(values)], topic) \
            .coalesce(1).write.mode("append").parquet(src)
        raw = spark.readStream.schema(topic).parquet(src)
        q = jobs.cdc_split_job(raw, facts, dims_t, lambda: cdc.table_list(spark, path=conf),
                               lambda: cdc.table_list(spark, ["user_info"]), f"{tmp_dir}/ckpt", "availableNow")
        q.awaitTermination()
    run([rec("order_info", 1), rec("order_detail", 2)], 0)
    cdc.table_list(spark, ["order_info", "order_detail"]).write.mode("overwrite").parquet(conf)
    run([rec("order_detail", 3), rec("user_info", 4), "no json"], 10)
    bad = facts.read("BAD_RECORDS").collect()
    assert [r["value"] for r in bad] == ["no json"]
    topics = sorted((r["topic"], json.loads(r["value"])["id"]) for r in facts.read().where("topic <> 'BAD_RECORDS'").collect())
    assert topics == [("DWD_ORDER_DETAIL_I", 3), ("DWD_ORDER_INFO_I", 1)]
    assert [(r["table"], r["id"]) for r in dims_t.table().collect()] == [("user_info", "4")]


def test_dau_observed_counts_and_bootstrap(spark, tmp_dir):
    page = tables.page_log(spark, SF_SMALL)
    src = f"{tmp_dir}/page_src"
    page.write.mode("append").parquet(src)
    table = jobs.dau_table(spark, f"{tmp_dir}/dau")
    dims = lambda: (tables.user_info(spark, SF_SMALL), tables.base_province(spark, SF_SMALL))
    s = spark.readStream.schema(schemas.PAGE_LOG).parquet(src)
    q = jobs.dau_job(s, dims, table, f"{tmp_dir}/ckpt1", "availableNow", as_of=AS_OF, mode="first_arrival")
    q.awaitTermination()
    metrics = [p.observedMetrics for p in q.recentProgress if p.observedMetrics]
    assert metrics and metrics[0]["dau_input"]["rows"] == page.count()
    assert metrics[0]["dau_entries"]["rows"] == page.where("last_page_id is null").count()
    n = table.table().count()
    # A new query on a fresh checkpoint (state lost) replays the same input:
    # with the sink as seen-set nothing is written twice or replaced.
    before = rows(table.table())
    q2 = jobs.dau_job(spark.readStream.schema(schemas.PAGE_LOG).parquet(src), dims, table,
                      f"{tmp_dir}/ckpt2", "availableNow", as_of=AS_OF, mode="first_arrival",
                      bootstrap_from_sink=True)
    q2.awaitTermination()
    assert table.table().count() == n and rows(table.table()) == before


def test_earliest_table_keeps_first_visit(spark, tmp_dir):
    t = jobs.dau_table(spark, f"{tmp_dir}/dau_e")
    cols = schemas.names(schemas.DAU_INFO)
    base = {c: None for c in cols}
    r1 = dict(base, mid="m", dt="2024-01-01", ts=200, page_id="late")
    r0 = dict(base, mid="m", dt="2024-01-01", ts=100, page_id="early")
    mk = lambda r: spark.createDataFrame([tuple(r[c] for c in cols)], schemas.DAU_INFO)
    t.upsert(mk(r0), 0)
    t.upsert(mk(r1), 1)  # a later batch with a later visit does not replace it
    assert [x["page_id"] for x in t.table().collect()] == ["early"]


def test_keyed_sink_merge_on_read(spark, tmp_dir):
    schema = "id long, dt string, v string"
    make = lambda rs: spark.createDataFrame(rs, schema)
    t = KeyedTable(spark, f"{tmp_dir}/kt_c", keys=["id"], slice_col="dt")
    t.upsert(make([(1, "2024-01-01", "a"), (2, "2024-01-02", "b")]), 0, writer="w")
    t.upsert(make([(2, "2024-01-02", "c"), (3, "2024-01-02", "d")]), 1, writer="w")
    t.delete(spark.createDataFrame([(3,)], "id long"), 2, writer="w")
    expected = [("2024-01-01", 1, "a"), ("2024-01-02", 2, "c")]
    assert rows(t.table()) == expected
    # a new writer restarting at batch 0 puts a newer row over an existing key
    t.upsert(make([(2, "2024-01-02", "e")]), 0, writer="other")
    assert rows(t.table()) == [expected[0], ("2024-01-02", 2, "e")]
    assert [r["v"] for r in t.field("v", "2024-01-02").collect()] == ["e"]
    # a slice filter reaches the scan as a partition filter
    plan = t.table().where(F.col("dt") == "2024-01-01")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan and "2024-01-01" in plan
    copy = KeyedTable(spark, f"{tmp_dir}/kt_copy", keys=["id"], slice_col="dt")
    t.copy_to(copy)
    assert rows(copy.table()) == rows(t.table())


def test_source_order_beats_batch_order(spark, tmp_dir):
    t = KeyedTable(spark, f"{tmp_dir}/kt_o", keys=["id"], slice_col="dt", order_cols=["offset"])
    make = lambda o, v: spark.createDataFrame([(1, "d", o, v)], "id long, dt string, offset long, v string")
    t.upsert(make(100, "old"), 7, writer="aaa")
    t.upsert(make(200, "new"), 0, writer="bbb")
    t.upsert(make(150, "between"), 9, writer="aaa")
    assert [r["v"] for r in t.table().collect()] == ["new"]


def test_replay_with_less_leaves_nothing_behind(spark, tmp_dir):
    from martflow.streaming.sinks import TopicFiles
    facts = TopicFiles(spark, f"{tmp_dir}/topics")
    make = lambda names: spark.createDataFrame([(n, "v") for n in names], "topic string, value string")
    facts.write_batch(make("AB"), 3, "w")
    facts.write_batch(make("A"), 3, "w")
    facts.write_batch(make("C"), 3, "other")
    assert sorted(r["topic"] for r in facts.read().collect()) == ["A", "C"]
    t = KeyedTable(spark, f"{tmp_dir}/kt_r", keys=["id"], slice_col="dt")
    t.upsert(spark.createDataFrame([(1, "x"), (2, "y")], "id long, dt string"), 0, "w")
    t.upsert(spark.createDataFrame([(1, "x")], "id long, dt string"), 0, "w")
    assert [r["id"] for r in t.table().collect()] == [1]


def test_bad_user_ids_and_unmatched_counts(spark, tmp_dir):
    """An id that is no number finds no user and stops nothing; the counts say so."""
    page = tables.page_log(spark, SF_SMALL).where("last_page_id IS NULL").limit(5).withColumn("user_id", F.lit("abc"))
    page.write.parquet(f"{tmp_dir}/page")
    said = []
    dims = lambda: (tables.user_info(spark, SF_SMALL), tables.base_province(spark, SF_SMALL))
    table = jobs.dau_table(spark, f"{tmp_dir}/dau")
    q = jobs.dau_job(spark.readStream.schema(schemas.PAGE_LOG).parquet(f"{tmp_dir}/page"), dims, table, f"{tmp_dir}/c",
                     "availableNow", as_of=AS_OF, report=lambda *x: said.append(x))
    pipeline.finish(q)
    n = table.table().count()
    assert n > 0 and said[0][0] == "dau" and said[0][2]["rows"] == said[0][2]["no_user"] == n
    assert said[0][2]["no_province"] == 0


def test_bootstrap_is_for_first_arrival_only(spark, tmp_dir):
    page = spark.readStream.schema(schemas.PAGE_LOG).parquet(tmp_dir)
    with pytest.raises(ValueError):
        jobs.dau_job(page, None, jobs.dau_table(spark, f"{tmp_dir}/t"), f"{tmp_dir}/c", bootstrap_from_sink=True)


def test_processing_time_trigger(spark, tmp_dir):
    """A running query with an interval trigger takes new files by itself."""
    path = f"{tmp_dir}/in"
    tables.app_log(spark, SF_SMALL).limit(50).coalesce(1).write.parquet(path)
    from martflow.streaming.sources import read_topic
    q = jobs.log_split_job(read_topic(spark, "parquet", path), f"{tmp_dir}/out", f"{tmp_dir}/c", trigger="1 second")
    try:
        q.processAllAvailable()
        first = spark.read.parquet(f"{tmp_dir}/out").count()
        tables.app_log(spark, SF_SMALL).limit(80).coalesce(1).write.mode("append").parquet(path)
        q.processAllAvailable()
        assert spark.read.parquet(f"{tmp_dir}/out").count() > first > 0
    finally:
        q.stop()


def test_kafka_options_and_messages(spark):
    """A1, A2, A6, A7 without a broker: options and columns."""
    from martflow.streaming.sinks import KafkaTopic
    from martflow.streaming.sources import kafka_options
    assert kafka_options("h:1", "t")["startingOffsets"] == "latest"
    explicit = kafka_options("h:1", "t", {"t": {0: 5, 1: 7}}, failOnDataLoss="false")
    assert json.loads(explicit["startingOffsets"]) == {"t": {"0": 5, "1": 7}} and explicit["failOnDataLoss"] == "false"
    out = KafkaTopic("h:1", **{"kafka.linger.ms": "5"})
    assert out.options["kafka.acks"] == "all" and out.options["kafka.linger.ms"] == "5"
    unkeyed = spark.createDataFrame([("t", 1, "v")], "topic string, offset long, value string")
    assert out.messages(unkeyed).columns == ["topic", "value"]
    keyed = spark.createDataFrame([("t", 4, "v")], "topic string, key long, value string")
    assert out.messages(keyed).dtypes == [("topic", "string"), ("key", "string"), ("value", "string")]
