"""What keeps the driver's memory small while dimensions and topics grow (findings of round 4)."""

from pyspark.sql import functions as F

from martflow.operators import dims, orders
from martflow.sources import tables
from martflow.streaming import pipeline
from tests.conftest import SF_SMALL

AUTO = "spark.sql.autoBroadcastJoinThreshold"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def sf_of(spark, base, n=600_000):
    """Parts and customers whose files are many times smaller than their rows; one order with a line."""
    one = spark.range(0, n, 1, 1)
    one.selectExpr("id AS p_partkey", "'red bolt' AS p_name", "1.5D AS p_retailprice").write.parquet(f"{base}/part.parquet")
    one.selectExpr("id AS c_custkey", "CAST(3 AS INT) AS c_nationkey").write.parquet(f"{base}/customer.parquet")
    spark.sql("SELECT 3 AS n_nationkey, 'N3' AS n_name").write.parquet(f"{base}/nation.parquet")
    spark.sql("SELECT 1L AS o_orderkey, 7L AS o_custkey, 'O' AS o_orderstatus, 9.5D AS o_totalprice, "
              "TIMESTAMP_NTZ '1997-05-20 00:00:00' AS o_orderdate").write.parquet(f"{base}/orders.parquet")
    spark.sql("SELECT 1L AS l_orderkey, k AS l_partkey, 1L AS l_suppkey, 1 AS l_linenumber, 2.0D AS l_quantity, 5.0D AS l_extendedprice, "
              "0.0D AS l_discount, 0.0D AS l_tax, 'N' AS l_returnflag, 'O' AS l_linestatus, TIMESTAMP_NTZ '1997-05-21 00:00:00' "
              "AS l_shipdate FROM VALUES (9L), (NULL), (-1L) AS t(k)").write.parquet(f"{base}/lineitem.parquet")
    return base


def test_f1_f2_f3_small_files_of_many_rows_are_not_broadcast(spark, tmp_dir):
    sf, before = sf_of(spark, tmp_dir), spark.conf.get(AUTO)
    users = tables.user_info(spark, sf)
    assert dims.size_in_bytes(users) < dims.DEFAULT_BROADCAST_BYTES and dims.stored_rows(users) == 600_000
    spark.conf.set(AUTO, "100m")        # the planner goes by the files, too
    try:
        lines = tables.order_detail(spark, sf, with_create_time=False)
        info = tables.order_info(spark, sf)
        rich = orders.enrich_orders(info, users, tables.base_province(spark, sf), as_of="2024-01-31")
        assert "BroadcastHashJoin" not in plan(lines) and "BroadcastHashJoin" not in plan(info)
        assert plan(rich).count("BroadcastHashJoin") == 1      # the provinces
        assert plan(tables.order_detail(spark, SF_SMALL, with_create_time=False)).count("BroadcastHashJoin") == 1
    finally:
        spark.conf.set(AUTO, before)
    assert sorted((r.sku_id or 0, r.sku_name) for r in lines.collect()) == [(-1, None), (0, None), (9, "red bolt")]
    assert [(r.province_name, r.user_gender) for r in rich.collect()] == [("N3", "M")]


def test_f1_f2_f3_rows_are_counted_without_a_job(spark, tmp_dir):
    spark.range(10).selectExpr("id", "id % 2 AS `p q`").write.partitionBy("p q").parquet(f"{tmp_dir}/a b")
    found = spark.read.parquet(f"{tmp_dir}/a b")
    spark.sparkContext.setJobGroup("footers", "footers")
    try:
        assert dims.stored_rows(found) == 10 and dims.stored_rows(found.union(found)) == 20
        assert dims.stored_rows(found.where("false")) == 0 and dims.stored_rows(spark.range(5)) == 0
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("footers")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_f1_f2_f3_many_files_of_a_dimension_are_an_unknown_size(spark, tmp_dir, monkeypatch):
    spark.range(4).repartition(2).write.parquet(f"{tmp_dir}/t")
    found = spark.read.parquet(f"{tmp_dir}/t")
    assert dims.is_small(found)
    monkeypatch.setattr(dims, "MAX_FOOTERS", 1)
    assert not dims.is_small(found)


def test_f1_f2_f3_the_sample_of_file_boundaries_is_bounded(spark, tmp_dir, monkeypatch):
    before, seen = spark.conf.get(pipeline.SAMPLED), []
    monkeypatch.setattr(pipeline, "SAMPLE_ROWS", 80)
    topic = spark.range(0, 4000, 1, 4).selectExpr("3999 - id AS offset", "timestamp_millis(id) AS timestamp")
    files = pipeline.deal_out(topic, f"{tmp_dir}/t", 8, by=("offset",),
                              message=lambda d: (seen.append(spark.conf.get(pipeline.SAMPLED)), d)[1])
    assert seen == ["10"] and spark.conf.get(pipeline.SAMPLED) == before
    ranges = [spark.read.parquet(f).agg(F.min("offset"), F.max("offset"), F.count(F.lit(1))).first() for f in files]
    assert sum(r[2] for r in ranges) == 4000 and len(ranges) > 4
    assert all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))
