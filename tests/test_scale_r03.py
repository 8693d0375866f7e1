"""What keeps tasks, state and shuffles small while tables grow (findings of round 3)."""

from pyspark.sql import Observation
from pyspark.sql import functions as F

from martflow import schemas
from martflow.operators import parse
from martflow.plans.catalog import Catalog
from martflow.sources import buckets
from martflow.streaming import jobs, pipeline
from martflow.streaming.sinks import KeyedTable
from tests.conftest import SF_SMALL

AS_OF = "2024-01-31"


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def sf_of(spark, base):
    """Lines and orders with repeated, null and unknown keys; a part that is there twice."""
    (spark.createDataFrame([(k, 11, "O", 9.5, "1997-05-20") for k in (1, 2, 2, None)], "o_orderkey long, o_custkey long, "
                           "o_orderstatus string, o_totalprice double, o_orderdate string")
     .withColumn("o_orderdate", F.expr("CAST(o_orderdate AS TIMESTAMP_NTZ)")).write.parquet(f"{base}/orders.parquet"))
    lines = [(o, p, 1, n, 2.0, 5.0, 0.0, 0.0, "N", "O", "1997-05-21")
             for n, (o, p) in enumerate([(1, 7), (1, 8), (2, 7), (2, None), (3, 7), (None, 8), (1, 9), (2, 5)])]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber long, l_quantity double, "
                          "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                          "l_linestatus string, l_shipdate string") \
        .withColumn("l_shipdate", F.expr("CAST(l_shipdate AS TIMESTAMP_NTZ)")).write.parquet(f"{base}/lineitem.parquet")
    spark.createDataFrame([(7, "red bolt", 1.0), (8, "blue nut", 2.0), (9, "x", 1.0), (9, "x", 3.0), (9, "y", 1.0)],
                          "p_partkey long, p_name string, p_retailprice double").write.parquet(f"{base}/part.parquet")
    return f"{base}"


def test_f8_products_are_counted_from_two_keys(spark, tmp_dir):
    c = Catalog(spark, sf_of(spark, tmp_dir), AS_OF)
    got = c.product_sales()
    assert rows(got) == rows(c.sales().groupBy("sku_id", "sku_name").agg(F.count(F.lit(1)).alias("lines")))
    assert (7, "red bolt", 3) in rows(got) and (9, "x", 2) in rows(got) and (None, None, 2) in rows(got)
    assert "l_extendedprice" not in got._jdf.queryExecution().optimizedPlan().toString().split("Relation")[0]


def test_f8_only_the_products_lines_are_joined(spark, tmp_dir):
    c = Catalog(spark, sf_of(spark, tmp_dir), AS_OF)
    skus = spark.createDataFrame([(7,), (9,), (None,)], "sku_id long")
    assert rows(c.sales(skus=skus)) == rows(c.sales().where("sku_id IN (7, 9)"))


def test_f5_f7_f15_a_bucket_is_a_small_task(spark):
    assert 20 * buckets.BUCKET_BYTES <= 400 << 20


def test_f10_a_slice_is_several_tasks_where_aqe_is_off(spark, tmp_dir):
    keys = {"spark.sql.adaptive.enabled": "false", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000"}
    before = {k: spark.conf.get(k) for k in keys}
    table = KeyedTable(spark, f"{tmp_dir}/t", keys=["id"], slice_col="day")
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        table.upsert(spark.range(20_000).selectExpr("id", "'d' AS day", "sha2(CAST(id AS STRING), 256) AS text"), 0)
        assert spark.conf.get("spark.sql.adaptive.enabled") == "false"
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    stored = table._raw()
    assert stored.count() == 20_000 and stored.select(F.input_file_name()).distinct().count() > 1


def test_f4_topics_are_written_without_a_sort(spark, tmp_dir, monkeypatch):
    seen = []
    monkeypatch.setattr(jobs, "_start", lambda *a: seen.append(spark.conf.get(jobs.OPEN_WRITERS)))
    raw = spark.readStream.schema("topic string, partition int, offset long, timestamp timestamp, value string").parquet(tmp_dir)
    before = spark.conf.get(jobs.OPEN_WRITERS, None)
    jobs.log_split_job(raw, f"{tmp_dir}/out", f"{tmp_dir}/ckpt")
    topics = [v for k, v in vars(parse).items() if k.endswith("_TOPIC")]
    assert int(seen[0]) > len(topics) and spark.conf.get(jobs.OPEN_WRITERS, None) == before


def test_f1_f2_f3_topics_grow_in_steps(spark):
    """Several runs of one checkpoint: the same rows, none late, lines ahead or not."""
    batch = rows(Catalog(spark, SF_SMALL, AS_OF).order_wide)
    assert pipeline.source_bytes(Catalog(spark, SF_SMALL, AS_OF).lines()) > 40_000
    for options in ({"files": 2}, {"files": 3, "line_files": 1}):
        table, late, _ = pipeline.run_order_join(spark, SF_SMALL, as_of=AS_OF, step_bytes=100_000, **options)
        assert late == 0 and rows(table.table().select(*schemas.names(schemas.ORDER_WIDE))) == batch


def test_f1_f2_f3_a_topic_is_written_once_and_read_in_order(spark, tmp_dir):
    topic = spark.range(1000).selectExpr("'t' AS topic", "0 AS partition", "999 - id AS offset",
                                         "timestamp_millis(id * 1000) AS timestamp")
    text = lambda df: df.withColumn("value", F.col("offset").cast("string"))
    assert pipeline.stage_topic(topic, f"{tmp_dir}/t", 4, by=("offset",), parts=2, message=text) == 2
    found, seen = spark.read.parquet(f"{tmp_dir}/t"), []
    files = found.groupBy(F.col("_metadata.file_modification_time").alias("at")).agg(
        F.min("offset").alias("first"), F.max("offset").alias("last"), F.count(F.lit(1)).alias("n")).orderBy("at").collect()
    assert len(files) == 8 and sum(f.n for f in files) == 1000
    assert all(a.last < b.first for a, b in zip(files, files[1:]))
    stream = spark.readStream.schema(found.schema).option("maxFilesPerTrigger", "2").parquet(f"{tmp_dir}/t")
    pipeline.finish(stream.writeStream.foreachBatch(lambda b, i: seen.append(b.agg(F.min("offset"), F.max("offset")).first()))
                    .option("checkpointLocation", f"{tmp_dir}/c").trigger(availableNow=True).start())
    assert len(seen) == 4 and all(a[1] < b[0] for a, b in zip(seen, seen[1:]))


def test_f10_an_empty_batch_reports_its_counts(spark, tmp_dir):
    table, seen = KeyedTable(spark, f"{tmp_dir}/t", keys=["id"], slice_col="day"), Observation("empty")
    none = spark.range(10).selectExpr("id", "'d' AS day").repartition(2).where("id > 10 AND rand(1) < 2")
    table.upsert(none.observe(seen, F.count(F.lit(1)).alias("rows")), 0)
    assert seen.get == {"rows": 0}


def test_shared_topics_are_read_by_small_tasks(spark):
    """Files of a few MB of the tables, and splits that don't grow."""
    assert pipeline.FILE_BYTES <= 4 << 20 and pipeline.SPLIT_BYTES <= 32 << 20
    before, seen = spark.conf.get(pipeline.SPLITS), []
    pipeline._small_tasks(lambda s: seen.append(s.conf.get(pipeline.SPLITS)))(spark)
    assert int(seen[0]) == pipeline.SPLIT_BYTES and spark.conf.get(pipeline.SPLITS) == before
