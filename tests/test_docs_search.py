"""Document-table operations, search and aggregation on the demo index."""

from pyspark.sql import functions as F

from martflow.operators import aggregates, docs, search
from martflow.plans import queries as Q

MOVIES = [
    ("1", "red sea operation", 8.5, [(1, "zhang"), (2, "huang")]),
    ("2", "the sea", 5.0, [(2, "huang"), (2, "huang")]),
    ("3", "red cliff", 4.9, [(3, "liang")]),
    ("4", "mekong", 7.0, []),
]


def movies(spark):
    return spark.createDataFrame(MOVIES, "id string, name string, doubanScore double, "
                                         "actorList array<struct<id:int,name:string>>")


def test_search_by_filter_any_term_score_edge(spark):
    out = Q.search_by_filter(movies(spark), 5.0, "red sea", page_no=1, page_size=2).collect()
    assert [(r["id"], r["name"], r["total"]) for r in out] == [
        ("1", "<em>red</em> <em>sea</em> operation", 2), ("2", "the <em>sea</em>", 2)]
    past_end = Q.search_by_filter(movies(spark), 5.0, "red sea", page_no=5, page_size=2).collect()
    assert [(r["id"], r["name"], r["total"]) for r in past_end] == [(None, None, 2)]
    nothing = Q.search_by_filter(movies(spark), 5.0, "nosuch", page_no=1, page_size=2).collect()
    assert [(r["id"], r["total"]) for r in nothing] == [(None, 0)]


def test_actor_stats_count_once_per_film(spark):
    got = {r["key"]: (r["doc_count"], r["avg_metric"])
           for r in aggregates.array_element_stats(movies(spark), "actorList", "name", "doubanScore").collect()}
    assert got == {"zhang": (1, 8.5), "huang": (2, 6.75), "liang": (1, 4.9)}
    top = Q.avg_score_by_actor(movies(spark), 10).collect()
    assert [r["actor"] for r in top] == ["zhang", "huang", "liang"]


def test_actor_stats_long_form_equals_array_form(spark):
    m = movies(spark)
    pairs = m.select(F.col("id").alias("movie_id"), F.explode("actorList").alias("a")).select(
        "movie_id", F.col("a.name").alias("actor"))
    pairs = pairs.unionByName(spark.createDataFrame([("4", None)], "movie_id string, actor string"))
    long_form = aggregates.pair_stats(pairs, m, "movie_id", "id", "actor", "doubanScore")
    array_form = aggregates.array_element_stats(m, "actorList", "name", "doubanScore")
    assert sorted(map(tuple, long_form.collect())) == sorted(map(tuple, array_form.collect()))
    top = Q.avg_score_by_actor(m, 10, actors=pairs).collect()
    assert [(r["actor"], r["movies"]) for r in top] == [("zhang", 1), ("huang", 2), ("liang", 1)]


def test_document_writes(spark):
    base = spark.createDataFrame([("1001", "a"), ("1002", "b")], "id string, movie_name string")
    assert docs.get_by_id(base, "1002").first()["movie_name"] == "b"
    put = docs.upsert(base, spark.createDataFrame([("1002", "B"), ("1003", "c")], "id string, movie_name string"))
    assert sorted(map(tuple, put.collect())) == [("1001", "a"), ("1002", "B"), ("1003", "c")]
    # the later of two puts of one id wins when an order is given
    patch = spark.createDataFrame([("1001", "x", 1), ("1001", "y", 2)], "id string, movie_name string, seq int")
    assert docs.upsert(base, patch, order_col="seq").where("id = '1001'").first()["movie_name"] == "y"
    again = docs.upsert(put, spark.createDataFrame([("1002", "B")], "id string, movie_name string"))
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, put.collect()))
    dele = docs.delete_by_id(base, spark.createDataFrame([("1001",)], "id string"))
    assert [r["id"] for r in dele.collect()] == ["1002"]
    upd = docs.update_by_id(base, spark.createDataFrame([("1001", "gongfu"), ("9", "z")], "id string, movie_name string"))
    assert sorted(map(tuple, upd.collect())) == [("1001", "gongfu"), ("1002", "b")]
    assert [r["id"] for r in docs.unmatched_ids(base, spark.createDataFrame([("9",)], "id string")).collect()] == ["9"]
    ubq = docs.update_by_query(base, F.col("movie_name") == "b", {"movie_name": "c"})
    assert sorted(map(tuple, ubq.collect())) == [("1001", "a"), ("1002", "c")]
    post = docs.append_new(base, spark.createDataFrame([("d",)], "movie_name string"))
    assert post.count() == 3 and post.where("movie_name = 'd'").first()["id"] not in ("1001", "1002")


def test_bm25_orders_by_relevance(spark):
    df = spark.createDataFrame([(1, "red bolt"), (2, "red red bolt"), (3, "blue bolt"), (4, "red gear big")],
                               "id long, name string")
    scored = search.bm25(df.withColumn("n", F.lit(1)), "name", "red", "n").collect()
    s = {r["id"]: r["score"] for r in scored}
    assert s[3] == 0.0
    assert s[2] > s[1] > s[4] > 0
    # idf of "red": 3 of 4 documents
    import math
    idf = math.log(1 + (4 - 3 + 0.5) / (3 + 0.5))
    avgdl = (2 + 3 + 2 + 3) / 4
    tf, dl = 1, 2
    expect = idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * dl / avgdl))
    assert abs(s[1] - expect) < 1e-12


def test_detail_by_item_relevance_order(spark):
    from martflow.plans.catalog import Catalog
    from conftest import SF_SMALL
    c = Catalog(spark, SF_SMALL, "2024-01-31")
    page = Q.detail_by_item(c.sales(), c.enrich_sales, "red", 1, 5, order="score").collect()
    assert len(page) == 5 and all("<em>red</em>" in r["sku_name"] for r in page)
    assert len({r["total"] for r in page}) == 1


def test_weighted_statistics_equal_repeated_documents(spark):
    df = spark.createDataFrame([("red bolt", 3), ("red red gear", 1), ("blue bolt", 4)], "name string, n int")
    each = df.select("name", F.explode(F.sequence(F.lit(1), "n"))).select("name").withColumn("n", F.lit(1))
    a = {r["name"]: r["score"] for r in search.bm25(df, "name", "red bolt", "n").collect()}
    b = {r["name"]: r["score"] for r in search.bm25(each, "name", "red bolt", "n").collect()}
    assert a == b


def test_pages_by_rank_are_those_of_a_full_sort(spark):
    import random
    rng = random.Random(5)
    data = [(rng.choice([1.5, 1.5, 2.5, -3.0, None, rng.random()]), k) for k in range(3000)]
    data += [(7.25, k) for k in range(3000, 4500)] + [(float("nan"), 4500), (float("nan"), 4501)]   # a third are one score
    rng.shuffle(data)
    df = spark.createDataFrame(data, "score double, id long").repartition(3).cache()
    for keys in ([("score", True), ("id", False)], [("score", False), ("id", True)], [("id", False)]):
        order = [F.desc(k) if down else F.asc(k) for k, down in keys]
        full = [r["id"] for r in df.orderBy(*order).collect()]
        for page_no, size in ((1, 7), (20, 50), (31, 49), (90, 50), (91, 50), (1000, 50)):
            found = search.page_by_rank(df, keys, page_no, size, parts=8, sorted_rows=100)
            at = (page_no - 1) * size
            assert [r["id"] for r in found.collect()] == full[at:at + size], (keys, page_no, size)
    one = spark.createDataFrame([(1.0, 2**60 + k) for k in range(300)], "score double, id long")
    found = search.page_by_rank(one, [("score", True), ("id", False)], 5, 20, parts=4, sorted_rows=10)
    assert [r["id"] - 2**60 for r in found.collect()] == list(range(80, 100))
    assert search.page_by_rank(df.limit(0), [("id", False)], 1, 5).collect() == []
    df.unpersist()
