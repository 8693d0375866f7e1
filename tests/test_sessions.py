"""Sessions of the page log: batch against a plain loop, stream against batch."""

import random
import re

import pytest
from pyspark.sql import functions as F

from martflow.operators import sessions as S
from martflow.streaming import pipeline
from martflow.streaming.page_sessions import SessionStore

COLUMNS = "mid string, ts long, last_page_id string, page_id string, is_new string, channel string, during_time long"
T0 = 1_704_067_200_000   # 2024-01-01


def plain(rows):
    """Sessions by walking through each device's records in order."""
    key = lambda r: [(r[1],), *[(x is not None, x or 0) if not isinstance(x, str) else (True, x) for x in r[2:]]]
    out, now = [], {}
    for r in sorted(rows, key=lambda r: (r[0], key(r))):
        mid, ts, last, page, new, channel, time = r
        if last is None or mid not in now:
            now[mid] = [mid, ts, ts, last is None, 0, None, 0, None, channel, page, page]
            out.append(now[mid])
        s = now[mid]
        s[2], s[10], s[4] = ts, page, s[4] + 1
        if time is not None:
            s[5], s[6] = (s[5] or 0) + time, s[6] + 1
        if new is not None:
            s[7] = max(s[7] or new, new)
    return sorted(map(tuple, out), key=str)


def found(df):
    return sorted(map(tuple, df.collect()), key=str)


def log_rows(seed, n=900, hours=30):
    """A device with a third of the records, equal times, nulls, and slices without openings."""
    r = random.Random(seed)
    rows = []
    for _ in range(n):
        mid = "hot" if r.random() < 0.33 else f"m{r.randrange(20)}"
        rows.append((mid, T0 + r.randrange(hours * 3600) * 1000 // r.choice([1, 60]) * 1,
                     None if r.random() < 0.15 else r.choice(["home", ""]), r.choice("abc"),
                     r.choice(["0", "1", None]), r.choice(["c1", "c2", None]), r.choice([None, 5, 17])))
    return rows + rows[:20]


@pytest.mark.parametrize("unit", ["hour", "day", "minute"])
def test_sessions_against_a_plain_loop(spark, unit):
    rows = log_rows(4)
    log = spark.createDataFrame(rows, COLUMNS).repartition(5)
    assert found(S.sessions(log, unit)) == plain(rows)


def test_a_session_over_many_slices_and_one_never_opened(spark):
    rows = [("a", T0, None, "p0", "1", "c", 1)] + [("a", T0 + h * 3_600_000, "x", f"p{h}", "0", "d", 1) for h in range(1, 60)]
    rows += [("b", T0 + h * 3_600_000, "x", "q", "0", "c", None) for h in range(5)]
    got = found(S.sessions(spark.createDataFrame(rows, COLUMNS)))
    assert got == plain(rows) and [(r[0], r[3], r[4]) for r in got] == [("a", True, 60), ("b", False, 5)]


def test_empty_log(spark):
    empty = spark.createDataFrame([], COLUMNS)
    assert found(S.sessions(empty)) == []
    assert [tuple(r)[1:] for r in S.visit_table(S.sessions(empty)).collect()] == [(0, 0), (0, 0), (None, None), (None, None), (None, None)]


def test_bounce_counts_opened_sessions_of_one_view(spark):
    rows = [("a", T0, None, "p", "0", "c", 1), ("a", T0 + 1, None, "p", "0", "c", 1), ("a", T0 + 2, "p", "q", "0", "c", 1),
            ("b", T0, "p", "q", "0", "c", 1), ("d", T0, None, "p", "1", "e", 1)]
    log = spark.createDataFrame(rows, COLUMNS)
    assert dict(map(tuple, S.bounce_by_channel(S.sessions(log)).collect())) == {"c": pytest.approx(100 / 3), "e": 100}


def test_a_busy_device_is_many_window_groups(spark):
    """A third of the records has one device; no window group holds more than its busiest hour."""
    r = random.Random(9)
    rows = [(x[0], T0 + r.randrange(48 * 3600) * 1000, *x[2:]) for x in log_rows(9, n=3000)]
    log = spark.createDataFrame(rows, COLUMNS)
    parts = S.fragments(log)
    plan = parts._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"hashpartitioning\(mid#\d+, slice#", plan)
    busiest = parts.where("mid = 'hot'").groupBy("slice").agg(F.sum("views").alias("n")).agg(F.max("n")).first()[0]
    assert busiest < sum(r[0] == "hot" for r in rows) / 20


def test_stream_in_any_order_with_replays(spark, tmp_dir):
    rows = log_rows(6)
    random.Random(1).shuffle(rows)
    store, seen = SessionStore(spark, f"{tmp_dir}/s"), []
    for k, at in enumerate(range(0, len(rows), 400)):
        batch = spark.createDataFrame(rows[at:at + 400], COLUMNS)
        seen += rows[at:at + 400]
        store.add(batch, k, "w")
        if k != 1:
            store.add(batch, k, "w")      # a replay of the same batch
        assert found(store.sessions()) == plain(seen)
    day = [s for s in plain(rows) if s[2] < T0 + 86_400_000]
    assert [s for s in found(store.sessions(["2024-01-01"])) if s in day] != []


def test_files_per_batch_follows_the_size(spark, tmp_dir):
    rows = spark.range(1000).selectExpr("id AS offset", "timestamp_millis(id) AS timestamp")
    assert pipeline.stage_topic(rows, f"{tmp_dir}/few", 4) == 1
    assert pipeline.stage_topic(rows, f"{tmp_dir}/many", 2, parts=3) == 3
    many = spark.read.parquet(f"{tmp_dir}/many")
    assert many.count() == 1000 and many.select(F.input_file_name()).distinct().count() == 6
    big = rows.write.parquet(f"{tmp_dir}/src") or spark.read.parquet(f"{tmp_dir}/src")
    assert pipeline.files_per_batch(big.join(big.withColumnRenamed("offset", "o"), "timestamp"), 1, file_bytes=1000) < 40
