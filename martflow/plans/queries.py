"""The parametrised queries of the dashboard and the demo (L1-L6) and the
dashboard contracts with no server code in the original (M1-M10).

Each function takes already-built DataFrames (tables or stream sinks read
back) plus parameters and returns a DataFrame; nothing is collected.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martflow.functions import labels, text
from martflow.functions.dates import previous_day
from martflow.operators import aggregates, search
from martflow.operators.reshape import rename


# ---------------------------------------------------------------- L1 / L4

def dau_realtime(dau: DataFrame, td: str) -> DataFrame:
    """L1 + L4: today's and yesterday's hourly daily-active counts, dense
    over 24 hours, with today's total: ``series ('td'|'yd'), hr, n,
    dau_total``.  A missing day gives zeros, never an error."""
    return aggregates.dense_hours(dau, {"td": td, "yd": previous_day(td)}, total_series="td")


def dau_realtime_of_counts(counts: DataFrame, td: str) -> DataFrame:
    """L1 + L4 from maintained hourly counts ``dt, hr, n``: reads two days' rows of them."""
    return aggregates.dense_hours_of_counts(counts, {"td": td, "yd": previous_day(td)}, total_series="td")


# ---------------------------------------------------------------- L2

def _day_slice(df: DataFrame, day: str | None, day_col: str) -> DataFrame:
    """One day slice (partition column filter); ``None`` = all days."""
    return df if day is None else df.where(F.col(day_col) == day)


def stats_by_item(order_wide: DataFrame, item: str, day: str | None, t: str,
                  max_groups: int | None = None, found: DataFrame | None = None) -> DataFrame:
    """L2: amount of the lines whose ``sku_name`` holds every token of
    ``item``, per gender (labelled) or per age bucket: ``name, value``.
    ``found`` (``doc``, the matching products from stored postings) spares the
    matching of texts here."""
    field = labels.stat_field(t)
    m = _day_slice(order_wide, day, "create_date")
    m = m.where(text.match_all("sku_name", item)) if found is None else \
        m.join(found.select("doc"), F.col("sku_id") == F.col("doc"), "left_semi")
    if t == "gender":
        g = aggregates.sum_by_group(m, field, "split_total_amount", max_groups=max_groups)
        return g.select(labels.gender_label(F.col("name")).alias("name"), "value")
    return aggregates.age_buckets(m, field, "split_total_amount")


# ---------------------------------------------------------------- L3

# The fields of the detail answer, in order.
DETAIL_FIELDS = ["create_time", "order_price", "province_name", "sku_name", "sku_num",
                 "split_total_amount", "user_age", "user_gender"]


def detail_by_item(sales: DataFrame, enrich: Callable[[DataFrame], DataFrame], item: str, page_no: int = 1,
                   page_size: int = 20, order: str = "id", scored: DataFrame | None = None,
                   deep: bool = False) -> DataFrame:
    """L3: one page of matching lines with the keyword highlighted and the
    number of all matches beside each row.

    ``sales`` are order lines with their order's own columns; the page is
    chosen on them (a top-(from+size) selection per task and a merge), and
    ``enrich`` adds the user and province to its few rows only.
    ``order='id'`` pages by line id; ``order='score'`` by BM25 relevance
    (G5), ties by line id.  Relevance depends on the product alone, so
    products are scored (weighted by their lines) and the lines of the
    matching ones looked up.  ``scored`` (``sku_id, _lines, score`` of the
    matching products, from stored postings) spares the scoring of texts here.
    ``deep`` finds the page by ranks (:func:`search.page_by_rank`) instead.
    """
    is_match = text.match_all("sku_name", item)
    if order == "score":
        if scored is None:
            per_product = sales.groupBy("sku_id", "sku_name").agg(F.count(F.lit(1)).alias("_lines"))
            scored = search.bm25(per_product, "sku_name", item, "_lines").where(is_match)
        rows = sales.join(scored.select(F.col("sku_id").alias("_sku"), "score"), F.col("sku_id") == F.col("_sku"))
        total = scored.agg(F.coalesce(F.sum("_lines"), F.lit(0)).cast("long").alias("n"))
        keys = [("score", True), ("id", False)]
    else:
        rows = sales.where(is_match)
        total = aggregates.count_of(rows)
        keys = [("id", False)]
    if deep:
        page = enrich(search.page_by_rank(rows, keys, page_no, page_size))
    else:
        page = enrich(search.page(rows, [F.desc(k) if down else F.asc(k) for k, down in keys], page_no, page_size))
    page = page.select(*DETAIL_FIELDS).withColumn("sku_name", text.highlight("sku_name", item))
    return aggregates.with_total(rename(page, {"split_total_amount": "total_amount"}), total)


# ---------------------------------------------------------------- L5 / L6

def search_by_filter(movies: DataFrame, min_score: float, words: str, page_no: int = 1,
                     page_size: int = 1) -> DataFrame:
    """Score >= ``min_score`` AND any token of ``words`` in the name,
    sorted by score descending (ties by id), one page, the name
    highlighted, the match count beside."""
    m = movies.where((F.col("doubanScore") >= F.lit(min_score)) & text.match_any("name", words))
    page = search.page(m, [F.desc("doubanScore"), F.col("id")], page_no, page_size)
    page = page.select("id", text.highlight("name", words).alias("name"), "doubanScore")
    return aggregates.with_total(page, aggregates.count_of(m))


def avg_score_by_actor(movies: DataFrame, top: int = 10, actors: DataFrame | None = None) -> DataFrame:
    """The ``top`` actors by mean score of their films (descending,
    ties by name): ``actor, movies, avg_score``.  ``actors`` (``movie_id,
    actor`` rows) uses the long form of the actor field instead of the
    ``actorList`` array."""
    if actors is None:
        s = aggregates.array_element_stats(movies, "actorList", "name", "doubanScore", key_alias="actor")
    else:
        s = aggregates.pair_stats(actors, movies, "movie_id", "id", "actor", "doubanScore",
                                  key_alias="actor")
    s = s.select("actor", F.col("doc_count").alias("movies"), F.col("avg_metric").alias("avg_score"))
    return s.orderBy(F.desc("avg_score"), F.col("actor")).limit(top)


# ---------------------------------------------------------------- M1-M10
#
# The dashboard's contracts take ``days`` (1, 7 or 30; default 7), a range that ends
# with the given day.  The callers cut the tables to ``day_span`` (a pushed range of the
# scans); without a cut the same functions answer for all days.

DAYS = 7
TOP = 7


def day_span(td: str, days: int = DAYS) -> tuple[str, str]:
    """First and last day of the range."""
    last = datetime.date.fromisoformat(td)
    return (last - datetime.timedelta(days=days - 1)).isoformat(), td


def _days(df: DataFrame, ts_col: str = "ts") -> DataFrame:
    return df.withColumn("dt", F.date_format(F.timestamp_millis(F.col(ts_col)), "yyyy-MM-dd"))


def pv_uv_by_day(page_log: DataFrame) -> DataFrame:
    """M1: page views and distinct devices per day that has any."""
    return (_days(page_log).groupBy("dt")
            .agg(F.count(F.lit(1)).alias("pv"), F.count_distinct("mid").alias("uv")))


def pv_uv_series(page_log: DataFrame, td: str, days: int = DAYS) -> DataFrame:
    """M1 over the range: a row for each of its days, ``dt, pv, uv``."""
    return aggregates.dense_days(_days(page_log), "dt", *day_span(td, days),
                                 {"pv": F.count(F.lit(1)), "uv": F.count_distinct("mid")})


def visit_total(page_log: DataFrame) -> DataFrame:
    """M2: views, distinct devices, distinct new devices over the range."""
    return page_log.agg(F.count(F.lit(1)).alias("pv_count"),
                        F.count_distinct("mid").alias("uv_count"),
                        F.count_distinct(F.when(F.col("is_new") == "1", F.col("mid"))).alias("new_count"))


def _named(*names: str) -> list:
    """Aggregates that turn rows ``name, n`` into one column per name; zero where there is none."""
    return [F.coalesce(F.sum(F.when(F.col("name") == x, F.col("n"))), F.lit(0)).cast("long").alias(x) for x in names]


def pv_uv_series_of_state(per_day: DataFrame, td: str, days: int = DAYS) -> DataFrame:
    """M1 from maintained counts ``name, dt, n``: reads the rows of the range's days only."""
    return aggregates.dense_days(per_day, "dt", *day_span(td, days),
                                 {x: F.sum(F.when(F.col("name") == x, F.col("n"))) for x in ("pv", "uv")})


def visit_total_of_state(total: DataFrame) -> DataFrame:
    """M2 from maintained counts ``name, n`` of the range."""
    return total.agg(*_named("pv", "uv", "uv_new")).toDF("pv_count", "uv_count", "new_count")


def new_visit_stats(page_log: DataFrame) -> DataFrame:
    """M3 long form, per new/old device: views, visitors, sessions (records that open
    a session), mean page time in ms, views per session."""
    return (page_log.groupBy("is_new")
            .agg(F.count(F.lit(1)).alias("views"),
                 F.count_distinct("mid").alias("visitors"),
                 F.count(F.when(F.col("last_page_id").isNull(), 1)).alias("sessions"),
                 (F.sum("during_time") / F.count("during_time")).alias("mean_during_time"))
            .withColumn("pages_per_session",
                        F.when(F.col("sessions") > 0, F.col("views") / F.col("sessions"))))


def _visits(page_log: DataFrame, *by: str) -> DataFrame:
    """A visit is all that a device views on one day (the log has no session id):
    ``by..., mid, dt, views, time, timed``.  A plain aggregate, so a busy device is
    a row per task before anything is shuffled."""
    return (_days(page_log).groupBy(*by, "mid", "dt")
            .agg(F.count(F.lit(1)).alias("views"), F.sum("during_time").alias("time"),
                 F.count("during_time").alias("timed")))


def _visit_fields(of) -> dict:
    """M3's fields over the visits for which ``of`` holds."""
    pick = lambda c: F.when(of, c)
    visits, views = F.count(pick(F.lit(1))), F.sum(pick(F.col("views")))
    return {"views": views.cast("double"), "visitors": F.count_distinct(pick(F.col("mid"))).cast("double"),
            "bounce_percent": F.try_divide(F.lit(100.0) * F.count(pick(F.when(F.col("views") == 1, 1))), visits),
            "mean_time": F.try_divide(F.sum(pick(F.col("time"))), F.sum(pick(F.col("timed")))),
            "mean_pages": F.try_divide(views, visits)}


def new_visit_table(page_log: DataFrame) -> DataFrame:
    """M3: rows ``field, old, new`` for views, visitors, bounce % (visits of one view),
    mean page time in ms and mean pages per visit; null where there is no visit."""
    visits = _visits(page_log, "is_new")
    sides = {"old": F.col("is_new") == "0", "new": F.col("is_new") == "1"}
    fields = {side: _visit_fields(of) for side, of in sides.items()}
    names = list(fields["old"])
    # divisions by no visits are null, not errors
    one = visits.agg(*[F.struct(*[m.alias(n) for n, m in f.items()]).alias(side) for side, f in fields.items()])
    rows = F.array(*[F.struct(F.lit(n).alias("field"), *[F.col(f"{side}.{n}").alias(side) for side in sides])
                     for n in names])
    return one.select(F.explode(rows).alias("r")).select("r.*")


def channel_views(page_log: DataFrame) -> DataFrame:
    """M4 long form: page views and distinct devices per channel."""
    return (page_log.groupBy("channel")
            .agg(F.count(F.lit(1)).alias("pv"), F.count_distinct("mid").alias("uv")))


def channel(page_log: DataFrame, t: str = "pv") -> DataFrame:
    """M4: ``name, value`` per channel: page views (``pv``) or bounce rate in % (``br``:
    visits of one view among the channel's visits)."""
    if t == "pv":
        return page_log.groupBy(F.col("channel").alias("name")).agg(F.count(F.lit(1)).cast("double").alias("value"))
    if t == "br":
        return _visits(page_log, "channel").groupBy(F.col("channel").alias("name")).agg(
            (F.lit(100.0) * F.count(F.when(F.col("views") == 1, 1)) / F.count(F.lit(1))).alias("value"))
    raise ValueError(t)


def page_path(page_log: DataFrame) -> DataFrame:
    """M5: page transitions ``source -> target`` with their counts."""
    return (page_log.groupBy(F.col("last_page_id").alias("source"), F.col("page_id").alias("target"))
            .agg(F.count(F.lit(1)).alias("value")))


def page_nodes(page_log: DataFrame) -> DataFrame:
    """M5: the pages that take part in a transition."""
    names = F.explode(F.array("last_page_id", "page_id")).alias("name")
    return page_log.select(names).where("name IS NOT NULL").distinct()


# The funnel steps as page ids, in order.
FUNNEL_STEPS = ["view", "click", "purchase"]


def funnel(page_log: DataFrame, steps: list[str] = FUNNEL_STEPS) -> DataFrame:
    """M6: distinct users reaching each step: ``step, name, value``.  One
    conditional global aggregate, exploded to one row per step."""
    aggs = [F.count_distinct(F.when(F.col("page_id") == s, F.col("user_id"))).alias(f"s{i}")
            for i, s in enumerate(steps)]
    one = page_log.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(i + 1).alias("step"), F.lit(s).alias("name"),
                              F.col(f"s{i}").alias("value")) for i, s in enumerate(steps)])
    return one.select(F.explode(rows).alias("r")).select("r.step", "r.name", "r.value")


# The steps of the conversion funnel, in order.
CONVERT_STEPS = ["home", "good_detail", "cart", "order", "pay"]


def user_action_convert(users: dict[str, DataFrame]) -> DataFrame:
    """M6: distinct users who reached each of the five steps: ``step, name, value``.
    ``users`` has a frame with ``user_id`` (text) for each step; the steps come from
    different tables, so they are counted as (step, user) pairs in one aggregate."""
    pairs = None
    for i, name in enumerate(CONVERT_STEPS):
        one = users[name].select(F.lit(i + 1).alias("step"), F.lit(name).alias("name"),
                                 F.col("user_id").cast("string").alias("user_id"))
        pairs = one if pairs is None else pairs.unionByName(one)
    return pairs.groupBy("step", "name").agg(F.count_distinct("user_id").alias("value"))


def user_paid(page_log: DataFrame, pay_page: str = "purchase") -> DataFrame:
    """M6: visitors who paid and who did not: ``name, value``."""
    one = page_log.agg(F.count_distinct("user_id").alias("n"),
                       F.count_distinct(F.when(F.col("page_id") == pay_page, F.col("user_id"))).alias("paid"))
    rows = F.array(F.struct(F.lit("paid").alias("name"), F.col("paid").alias("value")),
                   F.struct(F.lit("unpaid").alias("name"), (F.col("n") - F.col("paid")).alias("value")))
    return one.select(F.explode(rows).alias("r")).select("r.*")


def user_totals(page_log: DataFrame, orders: DataFrame, all_orders: DataFrame, first: str) -> DataFrame:
    """M7: visitors, buyers, new visitors, first-time buyers (no order before ``first``)
    and ``pct``, the mean spend per buyer."""
    visitors = page_log.agg(F.count_distinct("user_id").alias("user_total"),
                            F.count_distinct(F.when(F.col("is_new") == "1", F.col("user_id"))).alias("new_user_count"))
    buyers = orders.agg(F.count_distinct("user_id").alias("n"), labels.money_sum("final_total_amount").alias("amount"))
    debut = all_orders.groupBy("user_id").agg(F.min("create_date").alias("debut"))
    fresh = orders.select("user_id").distinct().join(debut, "user_id").where(F.col("debut") >= first)
    return visitors.select(
        "user_total", buyers.select("n").scalar().alias("order_user_total"), "new_user_count",
        aggregates.count_of(fresh).scalar().alias("new_order_user_count"),
        buyers.select(F.when(F.col("n") > 0, F.col("amount") / F.col("n"))).scalar().alias("pct"))


def user_totals_of_state(pages: DataFrame, orders: DataFrame) -> DataFrame:
    """M7 from maintained counts ``name, n`` of the two ranges; amounts are whole cents."""
    o = orders.agg(*_named("buyers", "cents", "debuts"))
    amount = (F.col("cents").cast("decimal(20,0)") / 100).cast("decimal(20,2)").cast("double")
    return pages.agg(*_named("users", "users_new")).select(
        F.col("users").alias("user_total"), o.select("buyers").scalar().alias("order_user_total"),
        F.col("users_new").alias("new_user_count"), o.select("debuts").scalar().alias("new_order_user_count"),
        o.select(F.when(F.col("buyers") > 0, amount / F.col("buyers"))).scalar().alias("pct"))


def user_total(page_log: DataFrame, order_info: DataFrame) -> DataFrame:
    """M7: visitors, buyers, new visitors, and mean spend per buyer."""
    visitors = page_log.agg(F.count_distinct("user_id").alias("user_total"),
                            F.count_distinct(F.when(F.col("is_new") == "1", F.col("user_id")))
                            .alias("new_user_count"))
    buyers = order_info.agg(F.count_distinct("user_id").alias("order_user_total"),
                            labels.money_sum("final_total_amount").alias("_amount"))
    b = buyers.select("order_user_total",
                      (F.col("_amount") / F.col("order_user_total")).alias("amount_per_buyer"))
    # Both sides are single global-aggregate rows.
    return visitors.select(
        "user_total", "new_user_count",
        b.select("order_user_total").scalar().alias("order_user_total"),
        b.select("amount_per_buyer").scalar().alias("amount_per_buyer"))


def order_total_by_day(order_info: DataFrame) -> DataFrame:
    """M8: orders, amount and distinct buyers per day."""
    return (order_info.groupBy("create_date")
            .agg(F.count(F.lit(1)).alias("order_count"),
                 labels.money_sum("final_total_amount").alias("order_amount"),
                 F.count_distinct("user_id").alias("order_user")))


def order_total(orders: DataFrame) -> DataFrame:
    """M8: orders, amount and distinct buyers of the range, one row."""
    return orders.agg(F.count(F.lit(1)).alias("order_count"),
                      F.coalesce(labels.money_sum("final_total_amount"), F.lit(0.0)).alias("order_amount"),
                      F.count_distinct("user_id").alias("order_user"))


def orders_by_area(order_info: DataFrame) -> DataFrame:
    """M9: order count per province name."""
    return (order_info.groupBy(F.col("province_name").alias("name"))
            .agg(F.count(F.lit(1)).alias("value")))


def top_items(lines: DataFrame, products: DataFrame, by: str, num: int = TOP) -> DataFrame:
    """Line count and amount per product attribute (category, brand, product),
    the ``num`` first by count (ties by name).

    The lines are aggregated per product first (map-side partial step), so
    only one row per product meets the product table.  Amounts stay exact
    decimals through both levels.  A product missing from the table counts
    under a null name, as a left join would."""
    per_sku = lines.groupBy(F.col("sku_id").alias("_sku_id")).agg(
        F.count(F.lit(1)).alias("_n"),
        F.sum(F.col("split_total_amount").cast("decimal(18,2)")).alias("_amount"))
    p = products.select(F.col("sku_id").alias("_sku"), F.col(by).alias("name"))
    j = per_sku.join(p, per_sku._sku_id == p._sku, "left")
    return (j.groupBy("name").agg(F.sum("_n").alias("num"),
                                  F.sum("_amount").cast("double").alias("amount"))
            .orderBy(F.desc("num"), F.col("name")).limit(num))
