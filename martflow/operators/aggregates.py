"""Aggregations of the dashboard.

All of them are aggregates with a map-side partial step; groups with a
third of all rows are pre-reduced per task before the shuffle.  Results
that must list every hour or bucket are expanded from one global-aggregate
row, so no spine table or join is needed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martflow.functions import labels


def total_per_day(dau: DataFrame, day_col: str = "dt") -> DataFrame:
    """E1 for every day: ``dt, n``."""
    return dau.groupBy(day_col).agg(F.count(F.lit(1)).alias("n"))


def per_hour(dau: DataFrame, day_col: str = "dt", hour_col: str = "hr") -> DataFrame:
    """E2 for every day: ``dt, hr, n``."""
    return dau.groupBy(day_col, hour_col).agg(F.count(F.lit(1)).alias("n"))


def dense_hours(dau: DataFrame, series: dict[str, str], day_col: str = "dt",
                hour_col: str = "hr", total_series: str | None = None) -> DataFrame:
    """E1 + E2 + L4: for each ``label -> day`` of ``series`` the 24 hourly
    counts (missing hours are 0) and, if ``total_series`` is given, that
    day's total as ``dau_total``.

    The filtered counts (at most 24 per day) are folded into one map in a
    global aggregate, which returns exactly one row even when no day has
    data, and the dense series is generated from that row.
    """
    counts = (dau.where(F.col(day_col).isin(list(series.values())))
                 .groupBy(day_col, hour_col).agg(F.count(F.lit(1)).alias("n")))
    return dense_hours_of_counts(counts, series, day_col, hour_col, total_series)


def dense_hours_of_counts(counts: DataFrame, series: dict[str, str], day_col: str = "dt",
                          hour_col: str = "hr", total_series: str | None = None) -> DataFrame:
    """:func:`dense_hours` from counts per day and hour (``n``), such as a maintained table
    has: it reads the rows of its days, 24 each at most."""
    counts = counts.where(F.col(day_col).isin(list(series.values())))
    key = F.concat_ws("|", F.col(day_col), F.col(hour_col))
    aggs = [F.map_from_entries(F.collect_list(F.struct(key, F.col("n")))).alias("m")]
    if total_series is not None:
        total_day = series[total_series]
        aggs.append(F.coalesce(F.sum(F.when(F.col(day_col) == total_day, F.col("n"))), F.lit(0))
                    .cast("long").alias("dau_total"))
    folded = counts.agg(*aggs)
    pairs = F.array(*[F.struct(F.lit(lbl).alias("series"), F.lit(day).alias("day"))
                      for lbl, day in series.items()])
    keep = ["m"] + (["dau_total"] if total_series is not None else [])
    rows = folded.select(*keep, F.explode(pairs).alias("s"))
    rows = rows.select(*keep, "s", F.explode(F.sequence(F.lit(0), F.lit(23))).alias("h"))
    hr = F.lpad(F.col("h").cast("string"), 2, "0")
    n = F.coalesce(F.element_at(F.col("m"), F.concat_ws("|", F.col("s.day"), hr)), F.lit(0)).cast("long")
    return rows.select(F.col("s.series").alias("series"), hr.alias("hr"), n.alias("n"),
                       *keep[1:])


def sum_by_group(df: DataFrame, group_col: str, value_col: str, max_groups: int | None = None,
                 name_alias: str = "name", value_alias: str = "value") -> DataFrame:
    """E3 (+G4): ``sum(value)`` per group, null groups left out.  The
    original kept the 100 largest groups by row count; ``max_groups``
    reproduces a cap, the default is exact."""
    agg = (df.where(F.col(group_col).isNotNull())
             .groupBy(group_col)
             .agg(labels.money_sum(value_col).alias(value_alias), F.count(F.lit(1)).alias("_n")))
    if max_groups is not None:
        agg = agg.orderBy(F.desc("_n"), F.col(group_col)).limit(max_groups)
    return agg.select(F.col(group_col).cast("string").alias(name_alias), value_alias)


def age_buckets(df: DataFrame, age_col: str, value_col: str) -> DataFrame:
    """Sums for ages <20, 20-29, >=30 as three ``name, value`` rows;
    no rows when no row has an age.  One conditional global aggregate."""
    b = labels.age_bucket(F.col(age_col))
    amount = F.col(value_col).cast("decimal(18,2)")
    sums = [F.sum(F.when(b == i, amount)).alias(f"s{i}") for i in range(3)]
    agg = df.agg(*sums, F.count(F.col(age_col)).alias("_n")).where(F.col("_n") > 0)
    rows = F.array(*[F.struct(F.lit(lbl).alias("name"),
                              F.coalesce(F.col(f"s{i}"), F.lit(0).cast("decimal(18,2)"))
                              .cast("double").alias("value"))
                     for i, lbl in enumerate(labels.AGE_BUCKET_LABELS)])
    return agg.select(F.explode(rows).alias("r")).select("r.name", "r.value")


def array_element_stats(docs: DataFrame, array_col: str, field: str, metric_col: str,
                        key_alias: str = "key") -> DataFrame:
    """E5: group documents by each distinct element value of an array of
    structs; doc count and mean metric per value (a document counts once
    per value).  The mean is an exact decimal sum divided by the count."""
    values = F.array_distinct(F.transform(F.col(array_col), lambda a: a[field]))
    ex = docs.select(F.explode(values).alias(key_alias), F.col(metric_col))
    return (ex.where(F.col(key_alias).isNotNull())
              .groupBy(key_alias)
              .agg(F.count(F.lit(1)).alias("doc_count"),
                   (labels.money_sum(metric_col) / F.count(F.col(metric_col))).alias("avg_metric")))


def pair_stats(pairs: DataFrame, docs: DataFrame, pair_doc: str, doc_id: str, value_col: str,
               metric_col: str, key_alias: str = "key") -> DataFrame:
    """E5 over the long form of an array field: ``pairs`` holds one
    ``(pair_doc, value_col)`` row per document and element.  Same result as
    :func:`array_element_stats` on the array (a document counts once per
    distinct value; null values left out), but no document's elements are
    ever gathered into one row: the distinct pairs are partial aggregates,
    the join to the documents' metric is an equi-join whose hot document
    key AQE splits, and the per-value aggregate has a map-side step."""
    p = pairs.where(F.col(value_col).isNotNull()).select(pair_doc, value_col).distinct()
    d = docs.select(F.col(doc_id).alias("_doc"), F.col(metric_col).alias("_metric"))
    j = p.join(d, F.col(pair_doc) == F.col("_doc"), "inner")
    return (j.groupBy(F.col(value_col).alias(key_alias))
             .agg(F.count(F.lit(1)).alias("doc_count"),
                  (labels.money_sum("_metric") / F.count(F.col("_metric"))).alias("avg_metric")))


def with_total(page: DataFrame, total: DataFrame, alias: str = "total") -> DataFrame:
    """A page's rows with the number of all matches beside each.  A page
    without rows (past the end, or no match) gives one row of nulls with the
    number, so the number is never lost.

    ``total`` is a one-row, one-column frame; the page (bounded by its size) is folded
    into one row to meet it, so no join is needed.
    """
    folded = page.agg(F.collect_list(F.struct(*page.columns)).alias("_rows"))
    out = folded.select(F.explode_outer("_rows").alias("_r"), total.scalar().alias(alias))
    return out.select("_r.*", alias)


def count_of(df: DataFrame) -> DataFrame:
    return df.select(F.count(F.lit(1)).alias("n"))


def dense_days(df: DataFrame, day_col: str, first: str, last: str, metrics: dict) -> DataFrame:
    """One row per day ``first``..``last``, days without rows as zeros: ``dt`` and the
    named aggregates of ``metrics``.  The per-day rows (at most one per day of the
    range) are folded into one map, from which the series is generated."""
    per_day = df.where(F.col(day_col).between(first, last)).groupBy(day_col) \
        .agg(*[m.cast("long").alias(name) for name, m in metrics.items()])
    folded = per_day.agg(F.map_from_entries(F.collect_list(
        F.struct(F.col(day_col), F.struct(*metrics)))).alias("m"))
    days = F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))
    rows = folded.select("m", F.explode(F.transform(days, lambda d: F.date_format(d, "yyyy-MM-dd"))).alias("dt"))
    found = F.element_at("m", F.col("dt"))
    return rows.select("dt", *[F.coalesce(found[name], F.lit(0)).cast("long").alias(name) for name in metrics])
