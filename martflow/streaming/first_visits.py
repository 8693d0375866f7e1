"""First visits in keyed state with a time to live, and hourly counts kept by retraction.

:func:`first_visit_job` keeps, per device and day, the time of the earliest visit that it
has seen (``transformWithState``).  The state

* expires a processing-time TTL after its last change (J3), so a key that is never seen
  again costs nothing later, whatever the event times are;
* begins, on a new checkpoint, from the live days of the sink (J4): the table is read once,
  as the query's initial state, and no micro-batch reads it again.

The state knows which visit a new one replaces.  So a batch tells the change as well as the
row: a first visit adds one to its hour, and an earlier one takes one from the old hour and
adds one to its own.  :class:`RunningCounts` sums these changes into one current row per day
and hour (E1, E2, L1), which is all that a dashboard reads.

A replayed batch gives the same changes, as its state is that of the batch before; the
counts then start again from what was there without that batch.
"""

from __future__ import annotations

import time
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from martflow import schemas
from martflow.functions.dates import day_of_millis, hour_of_millis
from martflow.operators import dau
from martflow.streaming import jobs
from martflow.streaming.sinks import KeyedTable, path_exists, writer_tag

TTL = 48 * 3_600_000    # ms after the last change of a key
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# What both the page record and the daily-active row have; a mark of these columns tells a
# repeated record from another one of the same millisecond.
SHARED = [c for c in schemas.names(schemas.PAGE_LOG) if c in schemas.names(schemas.DAU_INFO) and c not in ("mid", "ts")]
CARRIED = [f for f in schemas.PAGE_LOG.fields if f.name in SHARED]


def _mark():
    return F.xxhash64(*SHARED).alias("mark")


class FirstVisit(StatefulProcessor):
    """Per (mid, dt): passes a visit on when it is earlier than all before (or as early, and
    another record), with ``old_ts``, the time that it replaces."""

    def __init__(self, ttl_ms: int = TTL):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.first = handle.getValueState("first", "ts long, mark long", self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        best, held = None, {}       # the batch's earliest records, one per mark
        for r in rows:
            if best is None or r.ts < best:
                best, held = r.ts, {r.mark: r}
            elif r.ts == best:
                held.setdefault(r.mark, r)
        seen = self.first.get() if self.first.exists() else None
        old, mark = seen if seen is not None else (None, None)
        if best is None or old is not None and best > old:
            return
        news = [held[m] for m in sorted(held) if old is None or best < old or m != mark]
        for r in news:
            yield Row(mid=key[0], dt=key[1], ts=r.ts, **{c: r[c] for c in SHARED}, old_ts=old)
            old = best      # a second record of this millisecond changes no count
        if news:
            self.first.update((best, news[-1].mark))

    def handleInitialState(self, key, initialState: Row, timerValues) -> None:
        self.first.update((initialState.ts, initialState.mark))

    def close(self) -> None:
        pass


class RunningCounts:
    """Counts per key, changed by deltas: one current row per key in a keyed table."""

    def __init__(self, spark: SparkSession, path: str, keys: tuple = ("dt", "hr"), slice_col: str = "dt"):
        self.keys = list(keys)
        self.table = KeyedTable(spark, path, keys=self.keys, slice_col=slice_col)

    def apply(self, changes: DataFrame, batch_id: int, writer: str) -> None:
        """Add ``delta`` per key.  A replayed batch starts from the counts without it."""
        sums = changes.groupBy(*self.keys).agg(F.sum("delta").alias("delta")).where("delta <> 0")
        base = self.table.read_but(batch_id, writer)
        if base is not None:
            sums = sums.join(base.select(*self.keys, F.col("n").alias("_n")), self.keys, "left")
        else:
            sums = sums.withColumn("_n", F.lit(0))
        n = (F.coalesce("_n", F.lit(0)) + F.col("delta")).cast("long")
        self.table.upsert(sums.select(*self.keys, n.alias("n")), batch_id, writer)

    def rebuild(self, counts: DataFrame, writer: str) -> None:
        """Replace the counts of the slices that ``counts`` (keys and ``n``) has."""
        self.table.upsert(counts, 0, f"{writer}-rebuild")

    def counts(self) -> DataFrame:
        """Keys and ``n``, of the keys that count anything."""
        return self.table.table().where("n <> 0").select(*self.keys, "n")


def hour_changes(visits: DataFrame) -> DataFrame:
    """``dt, hr, delta``: one more in the visit's hour, one less in that of the visit that it
    replaces."""
    steps = F.array(F.struct(hour_of_millis("ts").alias("hr"), F.lit(1).alias("delta")),
                    F.struct(hour_of_millis("old_ts").alias("hr"), F.lit(-1).alias("delta")))
    return visits.select("dt", F.explode(steps).alias("s")).select("dt", "s.hr", "s.delta").where("hr IS NOT NULL")


def first_visit_job(page_log: DataFrame, dims: jobs.Dims, table: KeyedTable, checkpoint: str,
                    hourly: RunningCounts | None = None, ttl_ms: int = TTL, live_from: str | None = None,
                    trigger: str | None = None, as_of=None, report: jobs.Report | None = None) -> StreamingQuery:
    """Daily active devices (the earliest visit, as :func:`jobs.dau_job`), with state that
    expires and starts from ``table``; ``hourly`` gets the changes of the counts.

    On a new checkpoint the rows of ``table`` from day ``live_from`` on (all without it)
    become the state, and the counts of those days are made from them, so that state, table
    and counts agree wherever the last run stopped.  Keep the TTL longer than records are
    late: a visit that comes after it counts as the first one again (the table still keeps
    the earliest).  The state's clock runs batches also without input, so ``availableNow``
    doesn't end by itself: see :func:`drain`.
    """
    spark = page_log.sparkSession
    entries = dau.session_entries(page_log).withColumn("dt", day_of_millis("ts")).withColumn("mark", _mark())
    stored = table.table() if not path_exists(spark, f"{checkpoint}/offsets") and table.read() is not None else None
    if stored is not None:
        stored = stored if live_from is None else stored.where(F.col("dt") >= live_from)
        if hourly is not None:
            hourly.rebuild(stored.groupBy("dt", "hr").agg(F.count(F.lit(1)).alias("n")), writer_tag(checkpoint))
        known = stored.select("mid", "dt", "ts", _mark())
    else:
        known = spark.createDataFrame([], "mid string, dt string, ts long, mark long")
    out = ", ".join(["mid string", "dt string", "ts long", *[f"`{f.name}` {f.dataType.simpleString()}" for f in CARRIED],
                     "old_ts long"])
    firsts = entries.select("mid", "dt", "ts", *SHARED, "mark").groupBy("mid", "dt").transformWithState(
        FirstVisit(ttl_ms), out, "Update", "ProcessingTime", known.groupBy("mid", "dt"))

    def each(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()     # the state is asked once for both outputs
        try:
            if batch.isEmpty():     # a batch of the state's clock
                return
            if hourly is not None:
                hourly.apply(hour_changes(batch), batch_id, writer_tag(checkpoint))
            users, provinces = dims()
            jobs._write(table, dau.to_dau_info(batch.drop("old_ts"), users, provinces, as_of), batch_id, checkpoint,
                        "first_visits", report)
        finally:
            batch.unpersist()

    provider = spark.conf.get(STATE_STORE, None)
    spark.conf.set(STATE_STORE, ROCKSDB)        # the only store with a TTL; a query keeps its own
    try:
        return jobs._start(firsts.writeStream.outputMode("update").foreachBatch(each), checkpoint, trigger, "first_visits")
    finally:
        if provider is None:
            spark.conf.unset(STATE_STORE)
        else:
            spark.conf.set(STATE_STORE, provider)


def drain(query: StreamingQuery, poll: float = 0.2) -> None:
    """Wait until a query has read all that there is, and stop it: until a batch without
    input.  (With a processing-time state, ``availableNow`` goes on with empty batches.)"""
    while query.isActive:
        last = query.lastProgress
        if last is not None and last["numInputRows"] == 0:
            query.stop()
            break
        time.sleep(poll)
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
