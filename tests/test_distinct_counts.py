"""Distinct counts from bitmaps and sums that merge, against plain counting."""

from collections import defaultdict

from pyspark.sql import functions as F

from martflow.plans import queries as Q
from martflow.streaming import distinct_counts as dc

PAGE = "dt string, mid string, user_id string, is_new string"
ORDER = "dt string, user_id long, final_total_amount double"
FIRST, LAST = "2024-01-30", "2024-02-02"      # over the end of a month


def add_pages(spark, store, rows, batch_id, writer="w"):
    store.add(spark.createDataFrame(rows, PAGE).coalesce(1), batch_id, writer)


def add_orders(spark, store, rows, batch_id, writer="w"):
    store.add(spark.createDataFrame(rows, ORDER).coalesce(1), batch_id, writer)


def answers(store, first=FIRST, last=LAST):
    return ({(r.name, r.dt): r.n for r in store.per_day(first, last).collect() if r.n},
            {r.name: r.n for r in store.total(first, last).collect() if r.n})


def counted(rows, first=FIRST, last=LAST):
    days, total = defaultdict(set), defaultdict(set)
    for k, (dt, mid, user, new) in enumerate(rows):
        if dt is None or not first <= dt <= last:
            continue
        for name, member, holds in (("uv", mid, True), ("uv_new", mid, new == "1"), ("users", user, True),
                                    ("users_new", user, new == "1"), ("pv", k, True)):
            if member is not None and holds:
                days[name, dt].add(member)
                total[name].add(member)
    return {k: len(v) for k, v in days.items()}, {k: len(v) for k, v in total.items()}


A = [("2024-01-31", "a", "1", "1"), ("2024-02-01", "a", "1", "0"), ("2024-02-01", "b", "2", None), (None, "z", "9", "1"),
     ("2024-02-01", "b", "2", "0"), ("2024-01-01", "old", "7", "1"), ("2024-02-02", None, "3", "1"), ("2024-02-02", "", None, "0")]
B = [("2024-01-30", "c", "1", "1"), ("2024-01-31", "a", "4", "0"), ("2024-02-01", "old", "7", "1"), ("2024-02-05", "d", "5", "1"),
     (None, None, None, None)]


def test_sets_over_days_and_batches_count_each_member_once(spark, tmp_dir):
    store = dc.page_store(spark, tmp_dir)
    assert answers(store) == ({}, {})
    add_pages(spark, store, A, 0)
    assert answers(store) == counted(A)
    add_pages(spark, store, B, 1)
    assert answers(store) == counted(A + B)
    add_pages(spark, store, B, 1)               # a replay
    assert answers(store) == counted(A + B)
    add_pages(spark, store, B[:2], 1)           # a replay with fewer rows replaces all of them
    assert answers(store) == counted(A + B[:2])
    read = [f for df in (store.per_day(FIRST, LAST), store.total(FIRST, LAST)) for f in df.inputFiles()]
    assert read and all("/bits/" in f or "/counts/" in f for f in read)     # neither the log nor the dictionary
    assert not any("month=202312" in f for f in read)
    one = Q.visit_total_of_state(store.total("2030-01-01", "2030-01-02")).collect()
    assert [tuple(r) for r in one] == [(0, 0, 0)]


def test_an_empty_batch_changes_nothing(spark, tmp_dir):
    store = dc.page_store(spark, tmp_dir)
    store.add(spark.createDataFrame([], PAGE), 0, "w")
    assert answers(store) == ({}, {})
    add_pages(spark, store, A, 1)
    store.add(spark.createDataFrame([], PAGE), 2, "w")
    assert answers(store) == counted(A)


def test_many_members_get_dense_numbers_once(spark, tmp_dir):
    store = dc.DistinctStore(spark, tmp_dir, {"uv": ("mid", "true")}, {"pv": "1"})
    rows = lambda lo, hi, day: spark.range(lo, hi).selectExpr(f"'{day}' AS dt", "'m' || id AS mid")
    store.add(rows(0, 60_000, "2024-01-30"), 0, "w")
    store.add(rows(20_000, 90_000, "2024-01-31").union(rows(20_000, 90_000, "2024-01-31")), 1, "w")
    days, total = answers(store)
    assert days == {("uv", "2024-01-30"): 60_000, ("uv", "2024-01-31"): 70_000, ("pv", "2024-01-30"): 60_000,
                    ("pv", "2024-01-31"): 140_000}
    assert total == {"uv": 90_000, "pv": 200_000}
    r = store.members.table().agg(F.count("number").alias("n"), F.count_distinct("number").alias("d"),
                                  F.min("number").alias("lo"), F.max("number").alias("hi")).first()
    assert (r.n, r.d) == (90_000, 90_000) and r.lo >= 1 and r.hi < 1.2 * 90_000


def test_first_orders_that_move_to_an_earlier_day(spark, tmp_dir):
    store = dc.order_store(spark, tmp_dir)
    one = [("2024-02-01", 1, 10.25), ("2024-02-02", 1, 0.1), ("2024-02-01", 2, 5.0), ("2024-02-01", None, 3.0), (None, 5, 1.0)]
    two = [("2024-01-30", 1, 1.1), ("2024-02-02", 2, 2.2), ("2024-01-02", 3, 7.0), ("2024-02-02", 3, None)]
    add_orders(spark, store, one, 0)
    days, total = answers(store)
    assert total == {"buyers": 2, "orders": 4, "cents": 1835, "debuts": 2}
    assert days["debuts", "2024-02-01"] == 2
    for _ in range(2):      # the second time as a replay
        add_orders(spark, store, two, 1)
        days, total = answers(store)
        assert total == {"buyers": 3, "orders": 7, "cents": 2165, "debuts": 2}
        assert {d: n for (name, d), n in days.items() if name == "debuts"} == {"2024-01-30": 1, "2024-02-01": 1}
    row = Q.user_totals_of_state(spark.createDataFrame([("users", 9)], "name string, n long"),
                                 store.total(FIRST, LAST)).first()
    assert tuple(row) == (9, 3, 0, 2, 21.65 / 3)


def test_merged_folders_count_the_same(spark, tmp_dir):
    table = dc.MergeTable(spark, tmp_dir, ["name", "dt"], "month", {"n": F.sum}, slice_expr=dc._month())
    for k in range(table.FANOUT + 2):
        table.upsert(spark.createDataFrame([("pv", "2024-01-31", 1), (f"x{k}", "2024-02-01", k)],
                                           "name string, dt string, n long").coalesce(1), k, "w")
    assert any(f.startswith("1.") for f in table.commits.live()[1])
    table.upsert(spark.createDataFrame([("pv", "2024-01-31", 5)], "name string, dt string, n long"), table.FANOUT + 1, "w")
    got = {(r.name, r.dt): r.n for r in table.table().collect()}
    assert got.pop(("pv", "2024-01-31")) == table.FANOUT + 1 + 5
    assert got == {(f"x{k}", "2024-02-01"): k for k in range(table.FANOUT + 1)}     # the last batch was replaced


def test_f13_a_batch_has_as_many_tasks_as_its_rows_ask_for(spark, tmp_dir, monkeypatch):
    """The largest task of the bitmaps' join and sort holds no more when the batch grows."""
    monkeypatch.setattr(dc, "TASK_ROWS", 1_000)
    store, before, parts = dc.DistinctStore(spark, tmp_dir, {"uv": ("mid", "true")}, {"pv": "1"}), spark.conf.get(dc.SHUFFLES), []
    upsert = store.bits.upsert
    store.bits.upsert = lambda rows, *where: (parts.append(spark.conf.get(dc.SHUFFLES)), upsert(rows, *where))
    for k, n in enumerate((100, 20_000)):
        store.add(spark.range(n).selectExpr("'2024-01-30' AS dt", "'m' || id AS mid"), k, "w")
    assert parts == [before, "20"] and spark.conf.get(dc.SHUFFLES) == before
    assert answers(store) == ({("uv", "2024-01-30"): 20_000, ("pv", "2024-01-30"): 20_100}, {"uv": 20_000, "pv": 20_100})
