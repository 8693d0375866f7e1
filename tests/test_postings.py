"""Stored postings against matching and scoring the texts themselves."""

import math

import pytest
from pyspark.sql import functions as F

from martflow.functions import text
from martflow.operators import postings, search

DOCS = [(1, "red bolt", 2), (2, "Red RED nut", 1), (3, "blue bolt, red bolt", 5), (4, None, 3), (5, "", 1), (6, "...", 2),
        (7, "红色 bolt", 1), (8, "色 red", 4), (9, "redbolt", 1), (10, "x " * 5000 + "bolt", 1), (11, "red bolt", 1)]
QUERIES = ["red", "bolt RED", "red red", "nothing", "red nothing", "", "...", "红色", "色 red bolt", "x"]


@pytest.fixture(scope="module")
def stored(spark):
    from martflow.session import work_dir
    docs = spark.createDataFrame(DOCS, "id long, name string, n long")
    return docs, postings.write_postings(docs, work_dir(spark, "postings_test"), "id", "name", F.col("n"), files=3)


def got(df):
    return sorted((r["doc"], r["weight"]) for r in df.collect())


def test_matches_are_those_of_the_texts(stored):
    docs, index = stored
    for q in QUERIES:
        want = lambda m: sorted((r["id"], r["n"]) for r in docs.where(m("name", q)).collect())
        assert got(index.match_all(q)) == want(text.match_all), q
        assert got(index.match_any(q)) == want(text.match_any), q


def test_scores_are_those_of_the_texts(stored):
    docs, index = stored
    for q in ("bolt red", "色", "red nothing"):
        direct = {r["id"]: r["score"] for r in search.bm25(docs, "name", q, "n").collect()}
        every = {r["doc"]: r["score"] for r in index.bm25(q).collect()}
        some = {r["doc"]: r["score"] for r in index.bm25(q, require_all=False).collect()}
        assert set(every) == {r["id"] for r in docs.where(text.match_all("name", q)).collect()}
        assert set(some) == {k for k, v in direct.items() if v != 0}
        for k, v in (every | some).items():
            assert math.isclose(v, direct[k], rel_tol=1e-12)


def test_large_intersections_are_not_broadcast(spark, stored, monkeypatch):
    _, index = stored
    auto = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan(index.match_all("red bolt"))
        monkeypatch.setattr(postings, "BROADCAST_DOCS", 1)
        large = index.match_all("red bolt")
        assert "BroadcastHashJoin" not in plan(large) and got(large) == [(1, 2), (3, 5), (11, 1)]
        scored = index.bm25("red bolt")
        assert "BroadcastHashJoin" not in plan(scored) and got(scored) == got(large)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", auto)


def test_a_query_reads_its_terms_and_tokenizes_nothing(stored):
    _, index = stored
    for df in (index.match_any("red bolt"), index.bm25("red bolt")):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "In(term, [" in plan and "regexp" not in plan


def test_an_empty_corpus_finds_nothing(spark, tmp_dir):
    docs = spark.createDataFrame([], "id long, name string, n long")
    index = postings.write_postings(docs, tmp_dir, "id", "name", F.col("n"))
    assert got(index.match_all("red")) == got(index.match_any("red")) == got(index.bm25("red")) == []
