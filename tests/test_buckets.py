"""Orders and lines in buckets: the same rows as the shuffled join, without its exchange."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from martflow.operators import orders as ops
from martflow.plans.catalog import Catalog
from martflow.sources import tables
from martflow.sources.buckets import OrderBuckets, buckets_for

AS_OF = "2024-01-31"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))


@pytest.fixture()
def no_broadcast(spark):
    auto = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", auto)


def store_of(spark, path, lines=None, orders=None, **options):
    c = Catalog(spark, SF_SMALL, AS_OF)
    lines = tables.order_detail(spark, SF_SMALL, with_ship_time=True, with_create_time=False) if lines is None else lines
    return OrderBuckets(spark, path, c.order_info if orders is None else orders, lines, **options), c


def test_joins_of_buckets_need_no_exchange(spark, tmp_dir, no_broadcast):
    store, c = store_of(spark, tmp_dir)
    cold = ops.order_wide(store.orders(), store.lines())
    assert "SortMergeJoin" in plan(cold) and "Exchange" not in plan(cold)
    within = ops.order_wide_within(store.orders().withColumn("_et", F.to_timestamp("create_time")),
                                   store.lines().withColumn("_et", F.to_timestamp("ship_time")), "_et", "_et")
    assert "SortMergeJoin" in plan(within) and "Exchange" not in plan(within)
    per_order = cold.groupBy("order_id").count()
    assert "Exchange" not in plan(per_order)            # the buckets serve the aggregate, too
    assert "Exchange" in plan(c.order_wide)
    wide = store.order_wide()
    assert rows(wide) == rows(c.order_wide) and wide.columns == c.order_wide.columns
    store.drop()


def test_lines_of_hot_orders_are_kept_apart_and_joined(spark, tmp_dir, no_broadcast):
    lines = tables.order_detail(spark, SF_SMALL, with_ship_time=True, with_create_time=False)
    hot = lines.agg(F.min("order_id")).first()[0]
    third = lines.withColumn("order_id", F.when(F.pmod("id", F.lit(3)) == 0, F.lit(hot)).otherwise(F.col("order_id")))
    store, c = store_of(spark, tmp_dir, third, buckets=8, hot_lines=1000)
    assert [r["_hot"] for r in spark.read.parquet(f"{tmp_dir}/hot_keys").collect()] == [hot]
    assert store.lines().where(F.col("order_id") == hot).isEmpty()
    sizes = [r["n"] for r in store.lines().groupBy(F.input_file_name()).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * sum(sizes) / 8      # no bucket has the hot order
    assert rows(store.order_wide()) == rows(ops.order_wide(c.order_info, third))
    days = "1995-01-01", "1997-12-31"
    keys = c.order_info.where(F.col("create_date").between(*days)).select("id")
    assert rows(store.sold_lines(*days)) == rows(third.join(keys, third.order_id == keys.id, "left_semi")
                                                 .select("sku_id", "split_total_amount"))


def test_null_unknown_and_repeated_keys(spark, tmp_dir):
    c = Catalog(spark, SF_SMALL, AS_OF)
    lines = tables.order_detail(spark, SF_SMALL, with_ship_time=True, with_create_time=False).where("order_id < 100")
    odd = lines.limit(5).withColumn("order_id", F.lit(None).cast("long")).unionByName(
        lines.limit(5).withColumn("order_id", F.lit(-1).cast("long")))
    orders = c.order_info.where("id < 100")
    orders = orders.unionByName(orders.where("id < 10")).unionByName(orders.limit(2).withColumn("id", F.lit(None).cast("long")))
    store, _ = store_of(spark, f"{tmp_dir}/a", lines.unionByName(odd).unionByName(lines.where("order_id < 5")), orders)
    want = ops.order_wide(orders, lines.unionByName(lines.where("order_id < 5")))
    assert rows(store.order_wide()) == rows(want)
    empty, _ = store_of(spark, f"{tmp_dir}/b", lines.limit(0), orders.limit(0))
    assert empty.order_wide().isEmpty() and empty.sold_lines("1990-01-01", "1999-01-01").isEmpty()


def test_buckets_follow_the_bytes(spark):
    lines = tables.table(spark, SF_SMALL, "lineitem")
    assert buckets_for(lines) == 8
    assert buckets_for(lines, 1000) > 100
