"""The offset ledger (A3-A5): what each consumer group has read of each topic partition.

The query's checkpoint is what a restart normally goes on from.  The ledger is for a restart
*without* it (a lost or discarded checkpoint, a changed query): rows
``group, topic, partition, from_offset, until_offset, rows, batch_id`` in a keyed table of
the shared folder.

* A3, :func:`ranges`: the offset range per topic and partition of a micro-batch.
* A4, :meth:`OffsetLedger.save`: appended after the batch's output, under (writer, batch id),
  so a replayed batch replaces its rows.  If the output was written and the ledger not, the
  batch is read again, and the keyed sink replaces it; never the other way round.
* A5, :meth:`OffsetLedger.saved`: the end offsets saved last, per partition; as reader options
  for Kafka (:meth:`starting_offsets`) or as a filter for topics on files
  (:meth:`unread`).  No row means the default position.

Each group and topic has its own offsets; a stream never starts from another one's.

Jobs whose micro-batches still hold the topic's columns save from ``foreachBatch``
(:meth:`after`).  Others (joins, aggregates) are followed from outside:
:class:`ProgressLedger` saves the per-partition offsets that Kafka sources report with every
finished batch.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from martflow.streaming.sinks import KeyedTable, writer_tag

KEYS = ["group", "topic", "partition"]
SCHEMA = ("group string, topic string, partition int, from_offset long, until_offset long, rows long, "
          "batch_id long, writer string")


def ranges(batch: DataFrame) -> DataFrame:
    """A3: ``topic, partition, from_offset, until_offset, rows`` of a batch; the end is
    exclusive.  A partial aggregate, so a task sends a row per partition."""
    return batch.groupBy("topic", "partition").agg(
        F.min("offset").alias("from_offset"), (F.max("offset") + 1).alias("until_offset"),
        F.count(F.lit(1)).alias("rows"))


class OffsetLedger:
    """Offset ranges per (group, topic, partition) and batch."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        # every range is a row of its own (history); the last one saved is the position
        self.table = KeyedTable(spark, path, keys=[*KEYS, "writer", "batch_id"], slice_col="group")

    def save(self, batch: DataFrame, batch_id: int, group: str, writer: str) -> None:
        """A4: append the ranges of a batch whose output is written."""
        self._append(ranges(batch).withColumn("group", F.lit(group)), batch_id, writer)

    def _append(self, rows: DataFrame, batch_id: int, writer: str) -> None:
        rows = rows.withColumn("batch_id", F.lit(batch_id).cast("long")).withColumn("writer", F.lit(writer))
        self.table.upsert(rows.coalesce(1), batch_id, writer)    # a row per partition of the topic

    def after(self, output: Callable[[DataFrame, int], None], group: str, checkpoint: str) -> Callable:
        """A ``foreachBatch`` function that writes a batch's output and then its ranges; the
        batch is read once."""
        def each(batch: DataFrame, batch_id: int) -> None:
            batch = batch.persist()
            try:
                output(batch, batch_id)
                self.save(batch, batch_id, group, writer_tag(checkpoint))
            finally:
                batch.unpersist()
        return each

    def history(self) -> DataFrame:
        """All ranges: ``group, topic, partition, from_offset, until_offset, rows, batch_id, writer``."""
        if self.table.read() is None:
            return self.spark.createDataFrame([], SCHEMA)
        return self.table.table().select(*[c.split()[0] for c in SCHEMA.split(", ")])

    def saved(self, group: str, topic: str | None = None) -> DataFrame:
        """A5: ``topic, partition, until_offset``, the end saved last (by time of saving, as
        batch ids restart with a new checkpoint, then by batch id)."""
        rows = self.table.read()
        if rows is None:
            return self.spark.createDataFrame([], "topic string, partition int, until_offset long")
        mine = rows.where(F.col("group") == group)
        mine = mine if topic is None else mine.where(F.col("topic") == topic)
        last = F.max_by("until_offset", F.struct(KeyedTable.VERSION, "batch_id"))
        return mine.groupBy("topic", "partition").agg(last.alias("until_offset"))

    def starting_offsets(self, group: str, topic: str) -> str | None:
        """A5 for Kafka: the ``startingOffsets`` JSON of one topic, None when nothing is
        saved (then the reader's default holds).  One short text, a number per partition."""
        pairs = F.collect_list(F.struct(F.col("partition").cast("string"), "until_offset"))
        one = self.saved(group, topic).groupBy("topic").agg(F.map_from_entries(pairs).alias("ends"))
        row = one.select(F.to_json(F.map_from_arrays(F.array("topic"), F.array("ends"))).alias("json")).first()
        return row.json if row else None

    def unread(self, stream: DataFrame, group: str) -> DataFrame:
        """A5 for topics on files: the records that the group has not read, by the offsets
        saved when the query is made.  The table has a row per topic partition."""
        ends = self.saved(group).select(F.col("topic").alias("_topic"), F.col("partition").alias("_partition"),
                                        F.col("until_offset").alias("_until"))
        ends = self.spark.createDataFrame(ends.collect(), ends.schema)   # as they are now, not at each batch
        on = (F.col("topic") == F.col("_topic")) & (F.col("partition") == F.col("_partition"))
        new = F.col("_until").isNull() | (F.col("offset") >= F.col("_until"))
        return stream.join(F.broadcast(ends), on, "left").where(new).drop("_topic", "_partition", "_until")


def progress_ranges(source: dict) -> list[tuple]:
    """``topic, partition, from_offset, until_offset, rows`` from a source's progress, empty
    for sources that don't report offsets per partition.  Start and number of rows are null
    for a partition that the batch before didn't know."""
    def parsed(text):
        value = json.loads(text) if isinstance(text, str) and text.startswith("{") else text
        return value if isinstance(value, dict) and all(isinstance(v, dict) for v in value.values()) else {}
    start, end = parsed(source.get("startOffset")), parsed(source.get("endOffset"))
    out = []
    for topic, parts in sorted(end.items()):
        for p, until in sorted(parts.items(), key=lambda x: int(x[0])):
            first = start.get(topic, {}).get(p)
            if first is None or int(until) > int(first):
                out.append((topic, int(p), first, int(until), None if first is None else int(until) - int(first)))
    return out


class ProgressLedger(StreamingQueryListener):
    """Saves, for one query, the offsets that its Kafka sources report after each batch."""

    def __init__(self, ledger: OffsetLedger, group: str, checkpoint: str, query_name: str):
        self.ledger, self.group, self.writer, self.query_name = ledger, group, writer_tag(checkpoint), query_name

    def record(self, name: str, batch_id: int, sources: list[dict]) -> None:
        rows = [r for s in sources for r in progress_ranges(s)] if name == self.query_name else []
        if rows:
            schema = "topic string, partition int, from_offset long, until_offset long, rows long"
            df = self.ledger.spark.createDataFrame(rows, schema).withColumn("group", F.lit(self.group))
            self.ledger._append(df, batch_id, self.writer)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self.record(p.name, p.batchId, [{"startOffset": s.startOffset, "endOffset": s.endOffset} for s in p.sources])

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
