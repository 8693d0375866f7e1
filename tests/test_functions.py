"""Scalar functions: ages, day/hour cuts, labels, tokens, highlight."""

from pyspark.sql import functions as F

from martflow.functions import dates, labels, text


def one(spark, expr, **cols):
    names = list(cols)
    df = spark.createDataFrame([tuple(cols[n] for n in names)], ", ".join(f"{n} string" for n in names))
    return df.select(expr.alias("x")).first()["x"]


def test_age_is_calendar_years(spark):
    as_of = "2021-02-28"
    assert one(spark, dates.age_years(F.col("b"), as_of), b="2000-02-29") == 20
    assert one(spark, dates.age_years(F.col("b"), as_of), b="2000-02-28") == 21
    assert one(spark, dates.age_years(F.col("b"), as_of), b="not a date") is None
    # A future birthday truncates toward zero like a negative Period.
    assert one(spark, dates.age_years(F.col("b"), "2021-01-01"), b="2021-06-01") == 0
    assert one(spark, dates.age_years(F.col("b"), "2021-01-01"), b="2023-06-01") == -2


def test_age_buckets_edges(spark):
    df = spark.createDataFrame([(19, 1.0), (20, 10.0), (29, 100.0), (30, 1000.0), (None, 5.0)],
                               "user_age int, amount double")
    from martflow.operators.aggregates import age_buckets
    got = {r["name"]: r["value"] for r in age_buckets(df, "user_age", "amount").collect()}
    assert got == {labels.AGE_BUCKET_LABELS[0]: 1.0, labels.AGE_BUCKET_LABELS[1]: 110.0,
                   labels.AGE_BUCKET_LABELS[2]: 1000.0}
    empty = df.where("user_age is null")
    assert age_buckets(empty, "user_age", "amount").count() == 0


def test_gender_labels_and_fields(spark):
    assert one(spark, labels.gender_label(F.col("g")), g="F") == "女"
    assert one(spark, labels.gender_label(F.col("g")), g="M") == "男"
    assert one(spark, labels.gender_label(F.col("g")), g="X") == "X"
    assert labels.stat_field("age") == "user_age"
    import pytest
    with pytest.raises(ValueError):
        labels.stat_field("city")


def test_day_and_hour_follow_session_zone(spark):
    ms = 1653998723000
    df = spark.createDataFrame([(ms,)], "ts long")
    r = df.select(dates.day_of_millis("ts").alias("d"), dates.hour_of_millis("ts").alias("h")).first()
    assert (r["d"], r["h"]) == ("2022-05-31", "12")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Shanghai")
    try:
        r = df.select(dates.day_of_millis("ts").alias("d"), dates.hour_of_millis("ts").alias("h")).first()
        assert (r["d"], r["h"]) == ("2022-05-31", "20")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_text_day_hour_split(spark):
    assert one(spark, dates.text_day(F.col("t")), t="2020-03-10 07:08:09") == "2020-03-10"
    assert one(spark, dates.text_hour(F.col("t")), t="2020-03-10 07:08:09") == "07"
    assert one(spark, dates.text_hour(F.col("t")), t="2020-03-10") is None
    assert dates.previous_day("2024-03-01") == "2024-02-29"


def test_tokens_split_cjk_and_ascii(spark):
    toks = one(spark, text.tokens(F.col("s")), s="小米手机 Red-x9")
    assert toks == ["小", "米", "手", "机", "red", "x9"]


def test_match_all_any(spark):
    df = spark.createDataFrame([("Red Bolt",), ("red widget",), ("blue bolt",), ("小米手机",)], "n string")

    def hits(cond):
        return sorted(r["n"] for r in df.where(cond).collect())
    assert hits(text.match_all("n", "RED")) == ["Red Bolt", "red widget"]
    assert hits(text.match_all("n", "bolt red")) == ["Red Bolt"]
    assert hits(text.match_all("n", "red gizmo")) == []
    assert hits(text.match_all("n", "")) == []
    assert hits(text.match_all("n", "小米")) == ["小米手机"]
    assert hits(text.match_any("n", "red sea")) == ["Red Bolt", "red widget"]
    assert hits(text.match_all("n", "re(d")) == []


def test_highlight(spark):
    assert one(spark, text.highlight(F.col("n"), "red"), n="Red bolt, bored") == "<em>Red</em> bolt, bored"
    assert one(spark, text.highlight(F.col("n"), "bolt RED"), n="red bolt") == "<em>red</em> <em>bolt</em>"
    assert one(spark, text.highlight(F.col("n"), "小米"), n="小米手机") == "<em>小</em><em>米</em>手机"
    assert one(spark, text.highlight(F.col("n"), "a.b"), n="a.b axb") == "<em>a</em>.<em>b</em> axb"
    assert one(spark, text.highlight(F.col("n"), "$1"), n="x 1 y") == "x <em>1</em> y"


def test_text_to_number(spark):
    from martflow.functions.labels import to_number
    texts = ["12", " 3.5 ", "-1e2", "", "12 pcs", None, "NaN"]
    got = [r.n for r in spark.createDataFrame([(t,) for t in texts], "t string").select(to_number("t").alias("n")).collect()]
    assert got[:6] == [12.0, 3.5, -100.0, None, None, None] and got[6] != got[6]
