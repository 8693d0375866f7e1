"""The offset ledger: ranges, positions, restarts without a checkpoint."""

import json

import pytest
from pyspark.sql import functions as F

from martflow.streaming import pipeline
from martflow.streaming.offsets import OffsetLedger, ProgressLedger, progress_ranges, ranges
from martflow.streaming.sinks import TopicFiles
from martflow.streaming.sources import kafka_options, read_topic

from conftest import SF_SMALL

TOPIC = "topic string, partition int, offset long, timestamp timestamp, value string"


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture()
def topic(spark, tmp_dir):
    """Appends records (partition, offset) of a topic as one file."""
    def push(*records, topic="T"):
        df = spark.createDataFrame([(topic, p, o, None, f"{topic}-{p}-{o}") for p, o in records], TOPIC)
        df.coalesce(1).write.mode("append").parquet(f"{tmp_dir}/{topic}")
        return f"{tmp_dir}/{topic}"
    return push


def consume(spark, path, ledger, facts, group, checkpoint, fail_after_output=False):
    raw = ledger.unread(read_topic(spark, "parquet", path, max_files_per_trigger=1), group)
    save = ledger.save
    if fail_after_output:
        def save(*_):
            raise RuntimeError("lost before the offsets were saved")
    ledger_save, ledger.save = ledger.save, save
    out = lambda batch, i: facts.write_batch(batch.select("topic", "value"), i, writer=checkpoint[-6:])
    q = raw.writeStream.foreachBatch(ledger.after(out, group, checkpoint)).option("checkpointLocation", checkpoint).trigger(
        availableNow=True).start()
    try:
        q.awaitTermination()
    except Exception:
        pass
    ledger.save = ledger_save
    return q.exception()


def test_ranges_of_a_batch(spark):
    df = spark.createDataFrame([("a", 0, 5), ("a", 0, 9), ("a", 1, 2), ("b", 0, 0)], "topic string, partition int, offset long")
    assert rows(ranges(df)) == [("a", 0, 5, 10, 2), ("a", 1, 2, 3, 1), ("b", 0, 0, 1, 1)]


def test_positions_per_group_and_topic(spark, tmp_dir):
    ledger = OffsetLedger(spark, f"{tmp_dir}/l")
    assert ledger.starting_offsets("g", "a") is None and ledger.saved("g").count() == 0 and ledger.history().count() == 0
    batch = lambda *r: spark.createDataFrame(list(r), "topic string, partition int, offset long")
    ledger.save(batch(("a", 0, 4), ("a", 1, 7), ("b", 0, 1)), 0, "g", "w1")
    ledger.save(batch(("a", 0, 5), ("a", 0, 6)), 1, "g", "w1")
    ledger.save(batch(("a", 0, 5), ("a", 0, 6)), 1, "g", "w1")      # a replay
    ledger.save(batch(("a", 0, 100)), 0, "other", "w2")
    assert json.loads(ledger.starting_offsets("g", "a")) == {"a": {"0": 7, "1": 8}}
    assert json.loads(ledger.starting_offsets("other", "a")) == {"a": {"0": 101}}
    assert ledger.starting_offsets("other", "b") is None
    assert ledger.history().count() == 5
    # a later run that was set back (batch ids restart) decides, not the largest offset
    ledger.save(batch(("a", 0, 2)), 0, "g", "w3")
    assert json.loads(ledger.starting_offsets("g", "a")) == {"a": {"0": 3, "1": 8}}
    assert kafka_options("h:1", "a", json.loads(ledger.starting_offsets("g", "a")))["startingOffsets"] == '{"a": {"0": 3, "1": 8}}'


def test_new_checkpoint_reads_only_what_is_new(spark, tmp_dir, topic):
    ledger, facts = OffsetLedger(spark, f"{tmp_dir}/l"), TopicFiles(spark, f"{tmp_dir}/out")
    path = topic((0, 0), (0, 1), (1, 0))
    topic((0, 2), (1, 1))
    assert consume(spark, path, ledger, facts, "g", f"{tmp_dir}/ckpt_1") is None
    topic((0, 3), (2, 0))       # a partition that the ledger doesn't know starts at its beginning
    assert consume(spark, path, ledger, facts, "g", f"{tmp_dir}/ckpt_2") is None
    values = [r.value for r in facts.read().collect()]
    assert sorted(values) == ["T-0-0", "T-0-1", "T-0-2", "T-0-3", "T-1-0", "T-1-1", "T-2-0"]
    assert json.loads(ledger.starting_offsets("g", "T")) == {"T": {"0": 4, "1": 2, "2": 1}}


def test_output_without_saved_offsets_is_read_again(spark, tmp_dir, topic):
    """A4's order: a loss between output and ledger repeats a batch, and never skips one."""
    ledger, facts = OffsetLedger(spark, f"{tmp_dir}/l"), TopicFiles(spark, f"{tmp_dir}/out")
    path = topic((0, 0), (0, 1))
    assert consume(spark, path, ledger, facts, "g", f"{tmp_dir}/ckpt_1", fail_after_output=True) is not None
    assert ledger.starting_offsets("g", "T") is None
    assert consume(spark, path, ledger, facts, "g", f"{tmp_dir}/ckpt_2") is None
    assert {r.value for r in facts.read().collect()} == {"T-0-0", "T-0-1"}
    assert json.loads(ledger.starting_offsets("g", "T")) == {"T": {"0": 2}}


def test_each_stream_has_its_own_offsets(spark, tmp_dir, topic):
    ledger = OffsetLedger(spark, f"{tmp_dir}/l")
    a, b = topic((0, 0), (0, 1), topic="orders"), topic((0, 0), topic="lines")
    for name, path in (("orders", a), ("lines", b)):
        facts = TopicFiles(spark, f"{tmp_dir}/out_{name}")
        assert consume(spark, path, ledger, facts, f"{name}_group", f"{tmp_dir}/ckpt_{name}") is None
    assert json.loads(ledger.starting_offsets("orders_group", "orders")) == {"orders": {"0": 2}}
    assert json.loads(ledger.starting_offsets("lines_group", "lines")) == {"lines": {"0": 1}}
    assert ledger.starting_offsets("lines_group", "orders") is None


def test_progress_of_kafka_sources(spark, tmp_dir):
    source = {"startOffset": '{"t":{"0":3,"1":5}}', "endOffset": '{"t":{"0":9,"1":5,"2":4},"u":{"0":1}}'}
    assert progress_ranges(source) == [("t", 0, 3, 9, 6), ("t", 2, None, 4, None), ("u", 0, None, 1, None)]
    assert progress_ranges({"startOffset": None, "endOffset": '{"logOffset":3}'}) == []
    assert progress_ranges({"startOffset": None, "endOffset": None}) == []
    ledger = OffsetLedger(spark, f"{tmp_dir}/l")
    follow = ProgressLedger(ledger, "g", f"{tmp_dir}/ckpt", "order_join")
    follow.record("order_join", 0, [{"startOffset": None, "endOffset": '{"o":{"0":2}}'}, {"startOffset": None, "endOffset": '{"d":{"0":7}}'}])
    follow.record("order_join", 1, [{"startOffset": '{"o":{"0":2}}', "endOffset": '{"o":{"0":5}}'}])
    follow.record("another", 1, [{"startOffset": '{"o":{"0":2}}', "endOffset": '{"o":{"0":50}}'}])
    assert json.loads(ledger.starting_offsets("g", "o")) == {"o": {"0": 5}}
    assert json.loads(ledger.starting_offsets("g", "d")) == {"d": {"0": 7}}


def test_pipeline_restart_from_the_ledger_alone(spark):
    facts, ledger = pipeline.run_ledger(spark, SF_SMALL, files=2, checkpoints=2)
    read = spark.read.parquet(f"{SF_SMALL}/events.parquet").count()
    assert ledger.history().agg(F.sum("rows")).first()[0] == read
    assert facts.read().groupBy("offset").count().where("count > 1").count() == 0
