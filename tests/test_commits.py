"""Atomic commits and leveled merging of the keyed table."""

import random

import pytest
from pyspark.sql import functions as F

from martflow.streaming.commits import CommitLog
from martflow.streaming.sinks import KeyedTable

SCHEMA = "id long, dt string, ts long, v string"


def rows(df):
    return sorted(map(tuple, df.select("id", "dt", "ts", "v").collect()))


def table(spark, path, **kw):
    return KeyedTable(spark, path, keys=["id"], slice_col="dt", **kw)


def batch(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


def test_a_reader_sees_the_old_rows_or_the_new(spark, tmp_dir):
    t = table(spark, f"{tmp_dir}/t")
    t.upsert(batch(spark, (1, "a", 1, "x"), (2, "b", 1, "y")), 0, "w")
    reader = t.table()              # planned before the replay, run after it
    t.upsert(batch(spark, (1, "a", 1, "z")), 0, "w")
    assert rows(reader) == [(1, "a", 1, "x"), (2, "b", 1, "y")]
    assert rows(t.table()) == [(1, "a", 1, "z")]


def test_what_is_not_committed_is_not_there(spark, tmp_dir, monkeypatch):
    t = table(spark, f"{tmp_dir}/t")
    t.upsert(batch(spark, (1, "a", 1, "x")), 0, "w")

    def lost(*_):
        raise RuntimeError("driver lost between write and commit")
    monkeypatch.setattr(CommitLog, "commit", lost)
    with pytest.raises(RuntimeError):
        t.upsert(batch(spark, (1, "a", 1, "half")), 0, "w")
    with pytest.raises(RuntimeError):
        t.upsert(batch(spark, (2, "a", 1, "half")), 1, "w")
    assert rows(t.table()) == [(1, "a", 1, "x")]
    monkeypatch.undo()
    t.upsert(batch(spark, (2, "a", 1, "whole")), 1, "w")
    assert rows(t.table()) == [(1, "a", 1, "x"), (2, "a", 1, "whole")]
    assert t.vacuum(hours=24) == 0 and t.vacuum(hours=-1) == 2      # what the lost attempts left
    assert rows(t.table()) == [(1, "a", 1, "x"), (2, "a", 1, "whole")]


def test_two_writers_both_get_in(spark, tmp_dir, monkeypatch):
    log = CommitLog(spark, tmp_dir)
    log.commit(lambda live: live + ["a"])
    put, raced = CommitLog._put, []

    def late(self, number, folders):        # another writer takes the number first
        if not raced:
            raced.append(number)
            put(self, number, ["a", "other"])
        return put(self, number, folders)
    monkeypatch.setattr(CommitLog, "_put", late)
    assert log.commit(lambda live: live + ["mine"]) == ["a", "other", "mine"]
    assert log.live() == (3, ["a", "other", "mine"]) and log.commit(lambda live: live) == ["a", "other", "mine"]


@pytest.mark.parametrize("keep", ["latest", "earliest"])
def test_levels_bound_the_folders_and_keep_the_rows(spark, tmp_dir, keep):
    r, merged, plain = random.Random(3), None, None
    KeyedTable.FANOUT, fanout = 3, KeyedTable.FANOUT
    try:
        merged = table(spark, f"{tmp_dir}/m", order_cols=["ts"], keep=keep)
        plain = table(spark, f"{tmp_dir}/p", order_cols=["ts"], keep=keep, compact=False)
        for k in range(14):
            data = [(i, f"d{i % 3}", r.randrange(5), f"{k}-{i}") for i in r.sample(range(12), 4)]
            for t in (merged, plain):
                t.upsert(batch(spark, *data).withColumn(KeyedTable.DELETED, F.col("id") % 7 == k % 7), k, "w")
    finally:
        KeyedTable.FANOUT = fanout
    assert rows(merged.table()) == rows(plain.table())
    live = merged.commits.live()[1]
    assert len(live) <= 8 < len(plain.commits.live()[1]) == 14
    assert max(int(f.split(".")[0]) for f in live) >= 2
    # the last batch is still one of its own, so its replay replaces it
    before = rows(merged.read_but(13, "w").where(~F.col(KeyedTable.DELETED)))
    merged.upsert(batch(spark, *[]), 13, "w")
    assert rows(merged.table()) == before


def test_merging_gives_way_to_a_replay(spark, tmp_dir, monkeypatch):
    t = table(spark, f"{tmp_dir}/t", compact=False)
    for k in range(9):
        t.upsert(batch(spark, (k, "a", 1, "x")), k, "w")
    store = KeyedTable._store

    def slow(self, data, prefix):
        out = store(self, data, prefix)
        if prefix == "1.c":     # meanwhile batch 2 is replaced
            monkeypatch.setattr(KeyedTable, "_store", store)
            self.upsert(batch(spark, (2, "a", 1, "again")), 2, "w")
        return out
    monkeypatch.setattr(KeyedTable, "_store", slow)
    t.compact()
    assert {r[3] for r in rows(t.table()) if r[0] == 2} == {"again"} and len(rows(t.table())) == 9
    t.compact()
    assert len(t.commits.live()[1]) == 2 and len(rows(t.table())) == 9


def test_empty_batches_and_tables(spark, tmp_dir):
    t = table(spark, f"{tmp_dir}/t")
    assert t.read() is None
    with pytest.raises(FileNotFoundError):
        t.table()
    t.upsert(batch(spark), 0, "w")
    assert t.read() is None
    t.upsert(batch(spark, (1, "a", 1, "x")), 1, "w")
    t.upsert(batch(spark), 1, "w")
    assert t.read() is None
