"""Change-record routing and dimension upsert."""

import json

from pyspark.sql import functions as F

from martflow.operators import cdc


def changes(spark, *recs):
    df = spark.createDataFrame([(0, i, json.dumps(r)) for i, r in enumerate(recs)],
                               "partition int, offset long, value string") \
        .withColumn("timestamp", F.timestamp_seconds(F.col("offset")))
    return cdc.parse_change(df, keep=cdc.CHANGE_ORDER)


def facts(spark, parsed, tables=("order_info",)):
    m = cdc.fact_messages(parsed, cdc.table_list(spark, list(tables)))
    return sorted((r["topic"], r["value"]) for r in m.collect())


def test_operation_mapping_and_topics(spark):
    recs = [{"type": t, "table": "order_info", "data": {"id": i}} for i, t in
            enumerate(["bootstrap-insert", "insert", "update", "delete", "bootstrap-start", "other"])]
    got = [t for t, _ in facts(spark, changes(spark, *recs))]
    assert got == sorted(["DWD_ORDER_INFO_I", "DWD_ORDER_INFO_I", "DWD_ORDER_INFO_U", "DWD_ORDER_INFO_D"])


def test_payload_forwarded_as_written(spark):
    r = {"type": "insert", "table": "order_info", "data": {"id": 1, "note": None, "amount": 2.5}}
    (_, value), = facts(spark, changes(spark, r))
    assert json.loads(value) == {"id": 1, "note": None, "amount": 2.5}


def test_table_in_both_lists(spark):
    r = {"type": "insert", "table": "t", "data": {"id": 5}}
    p = changes(spark, r)
    assert len(facts(spark, p, tables=("t",))) == 1
    d = cdc.dim_changes(p, cdc.table_list(spark, ["t"])).collect()
    assert [(x["table"], x["id"]) for x in d] == [("t", "5")]


def test_last_offset_wins_and_deletes(spark):
    recs = [{"type": "insert", "table": "user_info", "data": {"id": 1, "v": "a"}},
            {"type": "update", "table": "user_info", "data": {"id": 1, "v": "b"}},
            {"type": "insert", "table": "user_info", "data": {"id": 2, "v": "c"}},
            {"type": "delete", "table": "user_info", "data": {"id": 2, "v": "c"}}]
    d = cdc.dim_changes(changes(spark, *recs), cdc.table_list(spark, ["user_info"]))
    snap = {r["id"]: (r["op"], json.loads(r["data"])["v"]) for r in cdc.upsert_dimension(d).collect()}
    assert snap == {"1": ("U", "b"), "2": ("D", "c")}
    kept = {r["id"] for r in cdc.upsert_dimension(d, apply_deletes=True).collect()}
    assert kept == {"1"}


def test_snapshot_merge(spark):
    first = cdc.dim_changes(changes(spark, {"type": "insert", "table": "u", "data": {"id": 1, "v": 1}}),
                            cdc.table_list(spark, ["u"]))
    snap = cdc.upsert_dimension(first)
    later = spark.createDataFrame([("u", "1", "U", '{"id":1,"v":2}', 0, 10), ("u", "3", "I", '{"id":3}', 0, 11)],
                                  "table string, id string, op string, data string, partition int, offset long") \
        .withColumn("timestamp", F.timestamp_seconds(F.col("offset")))
    merged = {r["id"]: r["data"] for r in cdc.upsert_dimension(later, snapshot=snap).collect()}
    assert merged == {"1": '{"id":1,"v":2}', "3": '{"id":3}'}


def test_offsets_of_partitions_do_not_compete(spark):
    """The record's time decides between partitions, whatever their offsets."""
    rows = [("u", "1", "U", '{"v":"old"}', 0, 900, 1), ("u", "1", "U", '{"v":"new"}', 1, 5, 2),
            ("u", "2", "U", '{"v":"a"}', 0, 7, 1), ("u", "2", "U", '{"v":"b"}', 1, 6, 1)]
    df = spark.createDataFrame(rows, "table string, id string, op string, data string, partition int, offset long, t long") \
        .withColumn("timestamp", F.timestamp_seconds(F.col("t")))
    got = {r["id"]: json.loads(r["data"])["v"] for r in cdc.upsert_dimension(df).collect()}
    assert got == {"1": "new", "2": "b"}


def test_bad_changes_are_kept(spark):
    values = ["not json", "[1]", '{"table":"t"}', '{"type":"insert","table":"t","data":{"id":1}}', '{"type":"odd"}', None]
    raw = spark.createDataFrame([(v,) for v in values], "value string")
    got = sorted(r["value"] for r in cdc.bad_changes(raw).collect())
    assert got == sorted(["not json", "[1]", '{"table":"t"}'])
