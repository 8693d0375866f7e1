"""First visits in state with a time to live, and hourly counts by retraction."""

import collections
import random
import time

import pytest
from pyspark.sql import functions as F

from martflow import schemas
from martflow.plans.catalog import Catalog
from martflow.sources import tables
from martflow.streaming import first_visits, jobs, pipeline
from martflow.streaming.first_visits import RunningCounts

from conftest import SF_SMALL

AS_OF = "2024-01-31"
NAMES = schemas.names(schemas.PAGE_LOG)
T0 = 1_704_067_200_000   # 2024-01-01


def view(mid, minutes, page="p", last=None):
    r = dict.fromkeys(NAMES)
    r.update(mid=mid, user_id="1", province_id="1", page_id=page, last_page_id=last, ts=T0 + minutes * 60_000, during_time=1)
    return tuple(r[n] for n in NAMES)


class Run:
    """The job over files that are added between its runs."""

    def __init__(self, spark, base, ttl_ms=first_visits.TTL):
        self.spark, self.base, self.ttl_ms = spark, base, ttl_ms
        self.table, self.hourly = jobs.dau_table(spark, f"{base}/dau"), RunningCounts(spark, f"{base}/hourly")
        self.written = []

    def push(self, *views):
        self.spark.createDataFrame(list(views), schemas.PAGE_LOG).coalesce(1).write.mode("append").parquet(f"{self.base}/in")

    def run(self, checkpoint="ckpt"):
        page = self.spark.readStream.schema(schemas.PAGE_LOG).parquet(f"{self.base}/in")
        dims = lambda: (tables.user_info(self.spark, SF_SMALL), tables.base_province(self.spark, SF_SMALL))
        upsert = self.table.upsert

        def counted(rows, batch_id, writer=""):
            self.written.append(rows.count())
            upsert(rows, batch_id, writer)
        self.table.upsert = counted
        try:
            first_visits.drain(first_visits.first_visit_job(page, dims, self.table, f"{self.base}/{checkpoint}", self.hourly,
                                                            self.ttl_ms, trigger="availableNow", as_of=AS_OF))
        finally:
            self.table.upsert = upsert

    def firsts(self):
        return {(r.mid, r.dt): (r.ts - T0) // 60_000 for r in self.table.table().collect()}

    def counts(self):
        return {(r.dt, r.hr): r.n for r in self.hourly.counts().collect()}


def test_earlier_visits_retract_the_old_hour(spark, tmp_dir):
    r, day = Run(spark, tmp_dir), "2024-01-01"
    r.push(view("a", 130), view("a", 500), view("b", 65), view("c", 5, last="home"))
    r.run()
    assert r.counts() == {(day, "02"): 1, (day, "01"): 1}
    r.push(view("a", 61), view("b", 60), view("a", 24 * 60 + 1))        # another hour, the same hour, the next day
    r.run()
    assert r.firsts() == {("a", day): 61, ("b", day): 60, ("a", "2024-01-02"): 1441}
    assert r.counts() == {(day, "01"): 2, ("2024-01-02", "00"): 1}      # hour 02 counts nothing any more
    r.push(view("a", 61), view("b", 61, "q"), view("a", 61, "q"))       # a repeat, a later one, a tie
    r.run()
    assert r.counts() == {(day, "01"): 2, ("2024-01-02", "00"): 1}
    assert r.written == [2, 3, 1]                                       # only the tie went on


def test_new_checkpoint_starts_from_the_table(spark, tmp_dir):
    r = Run(spark, tmp_dir)
    r.push(view("a", 130), view("b", 65))
    r.run("one")
    r.push(view("a", 60), view("d", 10))
    r.hourly = RunningCounts(spark, f"{tmp_dir}/other")                 # lost counts come back, too
    r.run("two")                                                        # reads all files again
    assert r.written == [2, 2]                                          # what the table had isn't written again
    assert r.firsts() == {("a", "2024-01-01"): 60, ("b", "2024-01-01"): 65, ("d", "2024-01-01"): 10}
    assert r.counts() == {("2024-01-01", "01"): 2, ("2024-01-01", "00"): 1}


def test_state_expires_by_the_clock(spark, tmp_dir):
    r = Run(spark, tmp_dir, ttl_ms=1000)
    r.push(view("a", 10))
    r.run()
    time.sleep(1.5)
    r.push(view("a", 20))       # later, but nothing is known of the device any more
    r.run()
    assert r.written == [1, 1]
    assert r.firsts() == {("a", "2024-01-01"): 10}                      # the table keeps the earliest


def test_state_lives_within_its_time(spark, tmp_dir):
    r = Run(spark, tmp_dir)
    r.push(view("a", 10))
    r.run()
    r.push(view("a", 20))
    r.run()
    assert r.written == [1]


def test_the_table_is_not_read_by_batches(spark, tmp_dir, monkeypatch):
    r = Run(spark, tmp_dir)
    r.push(view("a", 10))
    r.run()
    reads, read = [], jobs.KeyedTable._raw
    monkeypatch.setattr(jobs.KeyedTable, "_raw", lambda self, *a: reads.append(self.path) or read(self, *a))
    for k in range(2):
        r.push(view(f"m{k}", k))
        r.run()
    assert r.table.path not in reads


def test_counts_after_replays(spark, tmp_dir):
    c = RunningCounts(spark, f"{tmp_dir}/c")
    deltas = lambda *rows: spark.createDataFrame(rows, "dt string, hr string, delta int")
    c.apply(deltas(("d", "01", 2), ("d", "02", 1)), 0, "w")
    for _ in range(3):
        c.apply(deltas(("d", "01", -1), ("d", "03", 1), ("e", "00", 5)), 1, "w")
    c.apply(deltas(("d", "02", -1), ("d", "03", 1), ("d", "03", -1)), 2, "w")
    assert sorted(map(tuple, c.counts().collect())) == [("d", "01", 1), ("d", "03", 1), ("e", "00", 5)]


def test_random_order_gives_the_batch_counts(spark):
    table, hourly = pipeline.run_first_visits(spark, SF_SMALL, as_of=AS_OF, files=3)
    batch = Catalog(spark, SF_SMALL, AS_OF).dau_info()
    want = collections.Counter((r.dt, r.hr) for r in batch.select("dt", "hr").collect())
    assert {(r.dt, r.hr): r.n for r in hourly.counts().collect()} == dict(want)
    assert sorted(map(tuple, table.table().select(*batch.columns).collect()), key=str) == sorted(map(tuple, batch.collect()), key=str)


def test_dashboard_reads_the_folders_of_its_days(spark, tmp_dir):
    c = RunningCounts(spark, f"{tmp_dir}/c")
    r = random.Random(2)
    rows = [(f"2024-01-{d:02d}", f"{h:02d}", r.randrange(1, 9)) for d in range(1, 29) for h in range(24)]
    c.apply(spark.createDataFrame(rows, "dt string, hr string, delta int"), 0, "w")
    days = c.counts().where(F.col("dt").isin("2024-01-05", "2024-01-06"))
    assert days.count() == 48
    assert len({f.split("dt=")[1][:10] for f in (x.path for x in days.select(F.input_file_name().alias("path")).distinct().collect()) if f}) <= 2
