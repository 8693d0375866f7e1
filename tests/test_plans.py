"""Plan shapes the scale design relies on: filters reaching the scan, the
part join placed by its checked size, no per-movie arrays in the actor
statistics."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from martflow.plans.catalog import Catalog
from martflow.sources import tables

AS_OF = "2024-01-31"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted(tuple(r) for r in df.select(*sorted(df.columns)).collect())


def test_day_slice_reaches_the_orders_scan(spark):
    c = Catalog(spark, SF_SMALL, AS_OF)
    whole = c.sales()
    # the busiest day of the small data
    top = (whole.groupBy("create_date").count()
           .orderBy(F.desc("count"), "create_date").first())
    DAY = top["create_date"]
    day = c.sales(DAY)
    p = plan(day)
    assert "GreaterThanOrEqual(o_orderdate," in p and "LessThan(o_orderdate," in p
    # the same rows as the unpruned wide table cut to the day
    full = whole.where(F.col("create_date") == DAY)
    assert day.count() == top["count"] > 0
    assert rows(day) == rows(full)


def test_dimensions_are_broadcast_by_measured_bytes(spark):
    key = "martflow.broadcast.maxBytes"
    auto = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" in plan(tables.order_detail(spark, SF_SMALL, with_create_time=False))
        spark.conf.set(key, "10")
        big = tables.order_detail(spark, SF_SMALL, with_create_time=False)
        assert "BroadcastHashJoin" not in plan(big)
        assert big.count() == 6000 and big.select("id").distinct().count() == 6000
    finally:
        spark.conf.unset(key)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", auto)


def test_daily_active_counts_join_nothing_and_push_days(spark):
    import __spark_entry__ as E
    for name in ("dau_realtime", "dau_hourly", "dau_daily_total"):
        assert "Join" not in plan(E.queries()[name](spark, SF_SMALL))
    p = plan(E.queries()["dau_realtime"](spark, SF_SMALL))
    assert "GreaterThanOrEqual(ts," in p and "LessThan(ts," in p


def test_order_plans_have_no_window_and_totals_no_join(spark):
    import __spark_entry__ as E
    for name in ("order_wide", "order_wide_within_24h", "detail_by_item", "detail_by_item_day", "detail_by_item_relevance"):
        assert "Window" not in plan(E.queries()[name](spark, SF_SMALL)), name
    for name in ("order_total_by_day", "m8_order_total_days"):
        assert "Join" not in plan(E.queries()[name](spark, SF_SMALL)), name


def test_building_plans_runs_no_job(spark):
    """No registered batch query starts a job before its result is asked for."""
    from martflow.plans import registry
    auto = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    tracker = spark.sparkContext.statusTracker()
    writes = ("stream_", "sink_", "stored_", "deep_", "cdc_listed_tables")  # these write tables or count while they are built
    try:
        for name, build in registry.queries().items():
            if not name.startswith(writes):
                spark.sparkContext.setJobGroup(f"build-{name}", name)
                # reading a Parquet footer for the schema is the only job allowed, and it reads no rows
                df = build(spark, SF_SMALL)
                df._jdf.queryExecution().executedPlan()
                jobs = tracker.getJobIdsForGroup(f"build-{name}")
                stages = [s for j in jobs for s in tracker.getJobInfo(j).stageIds]
                infos = [tracker.getStageInfo(s) for s in stages]
                assert all(i is None or i.name.startswith("parquet at") for i in infos), (name, infos)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", auto)


def test_new_files_are_seen(spark, tmp_dir):
    tables.table(spark, SF_SMALL, "customer").limit(5).write.parquet(f"{tmp_dir}/customer.parquet")
    assert Catalog(spark, tmp_dir).users.count() == 5
    tables.table(spark, SF_SMALL, "customer").limit(7).write.mode("append").parquet(f"{tmp_dir}/customer.parquet")
    assert Catalog(spark, tmp_dir).users.count() == 12


def test_actor_stats_use_no_per_movie_array(spark):
    import __spark_entry__ as E
    q = E.queries()["actor_stats"](spark, SF_SMALL)
    assert "collect_list" not in plan(q)
