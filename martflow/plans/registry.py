"""Registered queries: name -> (Spark plan builder, DuckDB oracle SQL).

Each builder takes ``(spark, sf_dir)`` and returns a DataFrame over the
whole input tables.  Parameters are fixed here (a day inside the events
range, ``as_of`` for ages, keywords present in the data).  An oracle of
``None`` marks a query checked by its tests instead (row count only at the
driver).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from martflow import schemas
from martflow.functions.dates import previous_day
from martflow.operators import sessions as S
from martflow.plans import oracle as O
from martflow.plans.catalog import Catalog
from martflow.plans import queries as Q

AS_OF = O.AS_OF
TD = "2024-01-15"
ITEM = "red"
ITEM2 = "red bolt"

REGISTRY: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def register(name: str, sql: str | None):
    def deco(fn):
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


def cat(spark: SparkSession, sf_dir: str) -> Catalog:
    return Catalog(spark, sf_dir, AS_OF)


# ---------------------------------------------------------------- daily active

@register("dau_info", O.with_views(["dau"], "SELECT * FROM dau"))
def _dau_info(spark, sf_dir):
    return cat(spark, sf_dir).dau_info()


@register("dau_hourly", O.with_views(["dau"], """
SELECT dt, hr, COUNT(*) AS n FROM dau GROUP BY dt, hr"""))
def _dau_hourly(spark, sf_dir):
    from martflow.operators import aggregates
    return aggregates.per_hour(cat(spark, sf_dir).active_devices())


@register("dau_daily_total", O.with_views(["dau"], """
SELECT dt, COUNT(*) AS n FROM dau GROUP BY dt"""))
def _dau_daily(spark, sf_dir):
    from martflow.operators import aggregates
    return aggregates.total_per_day(cat(spark, sf_dir).active_devices())


@register("dau_realtime", O.with_views(["dau"], f"""
SELECT s.series, lpad(CAST(h.h AS VARCHAR), 2, '0') AS hr, CAST(COALESCE(c.n, 0) AS BIGINT) AS n,
       (SELECT COUNT(*) FROM dau WHERE dt = '{TD}') AS dau_total
FROM (VALUES ('td', '{TD}'), ('yd', '2024-01-14')) s(series, day)
CROSS JOIN generate_series(0, 23) h(h)
LEFT JOIN (SELECT dt, hr, COUNT(*) AS n FROM dau GROUP BY dt, hr) c
  ON c.dt = s.day AND c.hr = lpad(CAST(h.h AS VARCHAR), 2, '0')"""))
def _dau_realtime(spark, sf_dir):
    return Q.dau_realtime(cat(spark, sf_dir).active_devices(previous_day(TD), TD), TD)


# ---------------------------------------------------------------- orders

DAY = "1997-05-20"
_RED = ["red"]
_RED_BOLT = ["red", "bolt"]


@register("order_info_enriched", O.with_views(["order_enriched"], "SELECT * FROM order_enriched"))
def _order_info(spark, sf_dir):
    return cat(spark, sf_dir).order_info


@register("order_wide", O.with_views(["order_wide"], "SELECT * FROM order_wide"))
def _order_wide(spark, sf_dir):
    return cat(spark, sf_dir).order_wide


@register("order_wide_within_24h", O.with_views(["order_enriched", "order_detail"], f"""
SELECT {O._WIDE}
FROM order_enriched o JOIN order_detail d
  ON o.id = d.order_id
 AND CAST(d.ship_time AS TIMESTAMP) BETWEEN CAST(o.create_time AS TIMESTAMP) - INTERVAL 24 HOUR
                                        AND CAST(o.create_time AS TIMESTAMP) + INTERVAL 24 HOUR"""))
def _order_wide_within(spark, sf_dir):
    return cat(spark, sf_dir).order_wide_within("24 hours")


def _gender_sql(words, day=None):
    where = O.all_terms_sql("sku_name", words) + (f" AND create_date = '{day}'" if day else "")
    return O.with_views(["order_wide"], f"""
SELECT CASE WHEN user_gender = 'F' THEN '女' WHEN user_gender = 'M' THEN '男' ELSE user_gender END AS name,
       {O.money_sum_sql('split_total_amount')} AS value
FROM order_wide WHERE {where} AND user_gender IS NOT NULL
GROUP BY user_gender""")


def _age_sql(words, day=None):
    where = O.all_terms_sql("sku_name", words) + (f" AND create_date = '{day}'" if day else "")
    amt = "CAST(split_total_amount AS DECIMAL(18,2))"
    return O.with_views(["order_wide"], f"""
SELECT name, value FROM (
  SELECT SUM(CASE WHEN user_age < 20 THEN {amt} END) AS s0,
         SUM(CASE WHEN user_age >= 20 AND user_age < 30 THEN {amt} END) AS s1,
         SUM(CASE WHEN user_age >= 30 THEN {amt} END) AS s2,
         COUNT(user_age) AS n
  FROM order_wide WHERE {where}) a,
LATERAL (VALUES ('20岁以下', CAST(COALESCE(a.s0, 0) AS DOUBLE)),
                ('20岁到29', CAST(COALESCE(a.s1, 0) AS DOUBLE)),
                ('30岁以上', CAST(COALESCE(a.s2, 0) AS DOUBLE))) v(name, value)
WHERE a.n > 0""")


@register("stats_by_item_gender", _gender_sql(_RED))
def _stats_gender(spark, sf_dir):
    return Q.stats_by_item(cat(spark, sf_dir).buyer_sales(), ITEM, None, "gender")


@register("stats_by_item_age", _age_sql(_RED))
def _stats_age(spark, sf_dir):
    return Q.stats_by_item(cat(spark, sf_dir).buyer_sales(), ITEM, None, "age")


@register("stats_by_item_gender_day", _gender_sql(_RED, DAY))
def _stats_gender_day(spark, sf_dir):
    return Q.stats_by_item(cat(spark, sf_dir).buyer_sales(DAY), ITEM, DAY, "gender")


@register("stats_by_item_age_two_words", _age_sql(_RED_BOLT))
def _stats_age2(spark, sf_dir):
    return Q.stats_by_item(cat(spark, sf_dir).buyer_sales(), "Bolt RED", None, "age")


def _detail_sql(words, day, page_no, page_size):
    where = O.all_terms_sql("sku_name", words) + (f" AND create_date = '{day}'" if day else "")
    return O.with_views(["order_wide"], f"""
SELECT p.*, t.total FROM (SELECT COUNT(*) AS total FROM order_wide WHERE {where}) t LEFT JOIN (
  SELECT create_time, order_price, province_name, {O.highlight_sql('sku_name', words)} AS sku_name,
         sku_num, split_total_amount AS total_amount, user_age, user_gender
  FROM order_wide WHERE {where}
  ORDER BY detail_id LIMIT {page_size} OFFSET {(page_no - 1) * page_size}) p ON true""")


def _detail_page(spark, sf_dir, item, page_no, page_size, day=None, order="id"):
    c = cat(spark, sf_dir)
    return Q.detail_by_item(c.sales(day), c.enrich_sales, item, page_no, page_size, order)


@register("detail_by_item", _detail_sql(_RED, None, 1, 20))
def _detail(spark, sf_dir):
    return _detail_page(spark, sf_dir, ITEM, 1, 20)


@register("detail_by_item_page3", _detail_sql(_RED_BOLT, None, 3, 10))
def _detail_p3(spark, sf_dir):
    return _detail_page(spark, sf_dir, "bolt red", 3, 10)


@register("detail_by_item_day", _detail_sql(_RED, DAY, 1, 20))
def _detail_day(spark, sf_dir):
    return _detail_page(spark, sf_dir, ITEM, 1, 20, DAY)


@register("detail_by_item_past_end", _detail_sql(_RED, DAY, 1000, 20))
def _detail_past_end(spark, sf_dir):
    """Past the last page: no detail, the total kept."""
    return _detail_page(spark, sf_dir, ITEM, 1000, 20, DAY)


@register("detail_by_item_no_match", _detail_sql(["nosuchthing"], None, 1, 20))
def _detail_no_match(spark, sf_dir):
    return _detail_page(spark, sf_dir, "nosuchthing", 1, 20)


@register("stats_by_item_gender_top1", _gender_sql(_RED) + " ORDER BY COUNT(*) DESC, user_gender LIMIT 1")
def _stats_gender_top1(spark, sf_dir):
    """The group with the most lines."""
    return Q.stats_by_item(cat(spark, sf_dir).buyer_sales(), ITEM, None, "gender", max_groups=1)


# ---------------------------------------------------------------- app log routing

_COMMON = ("p.mid, p.user_id, p.province_id, p.channel, p.is_new, p.model, p.operate_system, "
           "p.version_code, p.brand")
_PAGE6 = "p.page_id, p.last_page_id, p.page_item, p.page_item_type, p.during_time, p.sourceType"
_K = "CAST(p.page_item AS BIGINT)"


def _parsed_log(spark, sf_dir):
    from martflow.operators import parse
    return parse.parse_log(cat(spark, sf_dir).app_log)


@register("log_page_rows", O.with_views(["page_log"], f"""
SELECT {_COMMON}, {_PAGE6}, p.ts FROM page_log p WHERE p.page_id IN ('view', 'click', 'purchase')"""))
def _log_page(spark, sf_dir):
    from martflow.operators import parse
    return parse.page_rows(_parsed_log(spark, sf_dir))


@register("log_display_rows", O.with_views(["page_log"], f"""
SELECT {_COMMON}, {_PAGE6},
       CASE WHEN i % 2 = 1 THEN 'query' ELSE 'promotion' END AS display_type,
       CAST({_K} + i AS VARCHAR) AS display_item, 'sku_id' AS display_item_type,
       CAST(i AS VARCHAR) AS display_order, CAST(i AS VARCHAR) AS display_pos_id, p.ts
FROM (SELECT *, unnest(generate_series(1, CAST(page_item AS BIGINT) % 3)) AS i
      FROM page_log WHERE page_id IN ('view', 'click')) p"""))
def _log_display(spark, sf_dir):
    from martflow.operators import parse
    return parse.display_rows(_parsed_log(spark, sf_dir))


@register("log_action_rows", O.with_views(["page_log"], f"""
SELECT {_COMMON}, {_PAGE6},
       CASE WHEN i = 1 THEN 'cart_add' ELSE 'favor_add' END AS action_id,
       CAST({_K} + 10 * i AS VARCHAR) AS action_item, 'sku_id' AS action_item_type,
       p.ts + i * 1000 AS ts
FROM (SELECT *, unnest(generate_series(1, CAST(page_item AS BIGINT) % 2 + 1)) AS i
      FROM page_log WHERE page_id = 'click') p"""))
def _log_action(spark, sf_dir):
    from martflow.operators import parse
    return parse.action_rows(_parsed_log(spark, sf_dir))


_START_SQL = O.with_views(["page_log"], f"""
SELECT {_COMMON}, 'icon' AS entry, CAST({_K} % 5 AS VARCHAR) AS open_ad_id,
       CAST(FLOOR(e.value * 10) AS BIGINT) AS loading_time_ms, {_K} * 10 AS open_ad_ms,
       CAST(0 AS BIGINT) AS open_ad_skip_ms, p.ts
FROM page_log p JOIN events e ON p.ts = CAST(epoch_us(e.ts) // 1000 AS BIGINT)
 AND p.user_id = CAST(e.user_id AS VARCHAR) AND p.page_id = e.event_type
 AND p.page_item = json_extract_string(e.props, '$.k') AND p.during_time = CAST(FLOOR(e.value * 100) AS BIGINT)
WHERE p.page_id IN ('signup', 'purchase')""")


@register("log_start_rows", _START_SQL)
def _log_start(spark, sf_dir):
    from martflow.operators import parse
    return parse.start_rows(_parsed_log(spark, sf_dir))


@register("log_error_records", O.with_views(["page_log"], """
SELECT CAST(page_item AS BIGINT) AS error_code, mid, ts FROM page_log WHERE page_id = 'error'"""))
def _log_errors(spark, sf_dir):
    from pyspark.sql import functions as F
    from martflow.operators import parse
    e = parse.error_records(_parsed_log(spark, sf_dir))
    return e.select(F.get_json_object("value", "$.err.error_code").cast("long").alias("error_code"),
                    F.get_json_object("value", "$.common.mid").alias("mid"),
                    F.get_json_object("value", "$.ts").cast("long").alias("ts"))


@register("log_route_counts", O.with_views(["page_log"], f"""
SELECT topic, n FROM (
  SELECT 'DWD_PAGE_LOG_TOPIC' AS topic, COUNT(*) AS n FROM page_log p WHERE p.page_id IN ('view', 'click', 'purchase')
  UNION ALL SELECT 'DWD_PAGE_DISPLAY_TOPIC', SUM({_K} % 3) FROM page_log p WHERE p.page_id IN ('view', 'click')
  UNION ALL SELECT 'DWD_PAGE_ACTION_TOPIC', SUM({_K} % 2 + 1) FROM page_log p WHERE p.page_id = 'click'
  UNION ALL SELECT 'DWD_START_LOG_TOPIC', COUNT(*) FROM page_log p WHERE p.page_id IN ('signup', 'purchase')
  UNION ALL SELECT 'DWD_ERROR_LOG_TOPIC', COUNT(*) FROM page_log p WHERE p.page_id = 'error') t
WHERE n > 0"""))
def _log_route_counts(spark, sf_dir):
    from pyspark.sql import functions as F
    from martflow.operators import parse
    return (parse.route_log(_parsed_log(spark, sf_dir))
            .groupBy("topic").agg(F.count(F.lit(1)).alias("n")))


@register("log_route_page_roundtrip", O.with_views(["page_log"], f"""
SELECT {_COMMON}, {_PAGE6}, p.ts FROM page_log p WHERE p.page_id IN ('view', 'click', 'purchase')"""))
def _log_roundtrip(spark, sf_dir):
    from martflow.operators import parse
    routed = parse.route_log(_parsed_log(spark, sf_dir))
    return parse.read_topic_rows(routed, parse.PAGE_TOPIC)


# ---------------------------------------------------------------- change records

_OP_SQL = ("CASE event_type WHEN 'signup' THEN 'I' WHEN 'view' THEN 'I' WHEN 'click' THEN 'U' "
           "WHEN 'purchase' THEN 'D' END")


def _changes(spark, sf_dir, keep=("offset",)):
    from martflow.operators import cdc
    return cdc.parse_change(cat(spark, sf_dir).change_log, keep=list(keep))


@register("cdc_fact_messages", f"""
SELECT 'DWD_ORDER_INFO_' || op AS topic, user_id AS id, value AS amount, event_id AS src_offset
FROM (SELECT *, {_OP_SQL} AS op FROM events) e
WHERE op IS NOT NULL AND user_id % 2 = 1""")
def _cdc_facts(spark, sf_dir):
    from pyspark.sql import functions as F
    from martflow.operators import cdc
    m = cdc.fact_messages(_changes(spark, sf_dir), cdc.table_list(spark, cdc.FACT_TABLES), keep=["offset"])
    return m.select("topic", F.get_json_object("value", "$.id").cast("long").alias("id"),
                    F.get_json_object("value", "$.value").cast("double").alias("amount"),
                    F.col("offset").alias("src_offset"))


def _dim_sql(apply_deletes: bool) -> str:
    extra = " AND op <> 'D'" if apply_deletes else ""
    return f"""
SELECT table_name, id, op, amount, src_offset FROM (
  SELECT 'user_info' AS table_name, user_id AS id, op, value AS amount, event_id AS src_offset,
         row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
  FROM (SELECT *, {_OP_SQL} AS op FROM events) e
  WHERE op IS NOT NULL AND user_id % 2 = 0) t
WHERE rn = 1{extra}"""


def _dim_snapshot(spark, sf_dir, apply_deletes):
    from pyspark.sql import functions as F
    from martflow.operators import cdc
    ch = cdc.dim_changes(_changes(spark, sf_dir, cdc.CHANGE_ORDER), cdc.table_list(spark, cdc.DIM_TABLES))
    snap = cdc.upsert_dimension(ch, apply_deletes=apply_deletes)
    return snap.select(F.col("table").alias("table_name"), F.col("id").cast("long").alias("id"), "op",
                       F.get_json_object("data", "$.value").cast("double").alias("amount"),
                       F.col("offset").alias("src_offset"))


@register("cdc_dim_snapshot", _dim_sql(False))
def _cdc_dim(spark, sf_dir):
    return _dim_snapshot(spark, sf_dir, False)


@register("cdc_dim_snapshot_apply_deletes", _dim_sql(True))
def _cdc_dim_del(spark, sf_dir):
    return _dim_snapshot(spark, sf_dir, True)


@register("cdc_topic_counts", f"""
SELECT 'DWD_ORDER_INFO_' || op AS topic, COUNT(*) AS n
FROM (SELECT *, {_OP_SQL} AS op FROM events) e
WHERE op IS NOT NULL AND user_id % 2 = 1 GROUP BY op""")
def _cdc_counts(spark, sf_dir):
    from pyspark.sql import functions as F
    from martflow.operators import cdc
    m = cdc.fact_messages(_changes(spark, sf_dir), cdc.table_list(spark, cdc.FACT_TABLES))
    return m.groupBy("topic").agg(F.count(F.lit(1)).alias("n"))



# ---------------------------------------------------------------- documents demo

_TITLES = "SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS movie_name FROM part"


def _part(spark, sf_dir):
    return cat(spark, sf_dir).table("part")


@register("docs_get_by_id", f"SELECT * FROM ({_TITLES}) t WHERE id = '7'")
def _docs_get(spark, sf_dir):
    from martflow.operators import docs
    return docs.get_by_id(cat(spark, sf_dir).movie_titles, "7")


@register("docs_bulk_put", f"""
SELECT t.* FROM ({_TITLES}) t
WHERE t.id NOT IN (SELECT CAST(p_partkey AS VARCHAR) FROM part WHERE p_size >= 45)
UNION ALL SELECT CAST(p_partkey AS VARCHAR), p_name || ' II' FROM part WHERE p_size >= 45
UNION ALL SELECT CAST(p_partkey + 1000000 AS VARCHAR), 'new ' || p_name FROM part WHERE p_size <= 3""")
def _docs_bulk_put(spark, sf_dir):
    from pyspark.sql import functions as F
    from martflow.operators import docs
    p = _part(spark, sf_dir)
    patch = (p.where(F.col("p_size") >= 45)
              .select(F.col("p_partkey").cast("string").alias("id"),
                      F.concat("p_name", F.lit(" II")).alias("movie_name"))
              .unionByName(p.where(F.col("p_size") <= 3)
                           .select((F.col("p_partkey") + 1000000).cast("string").alias("id"),
                                   F.concat(F.lit("new "), "p_name").alias("movie_name"))))
    return docs.upsert(cat(spark, sf_dir).movie_titles, patch)


@register("docs_delete", f"""
SELECT t.* FROM ({_TITLES}) t
WHERE t.id NOT IN (SELECT CAST(p_partkey AS VARCHAR) FROM part WHERE p_size = 1)""")
def _docs_delete(spark, sf_dir):
    from pyspark.sql import functions as F
    from martflow.operators import docs
    ids = _part(spark, sf_dir).where(F.col("p_size") == 1).select(F.col("p_partkey").cast("string").alias("id"))
    return docs.delete_by_id(cat(spark, sf_dir).movie_titles, ids)


@register("docs_update", """
SELECT CAST(p_partkey AS VARCHAR) AS id, CASE WHEN p_size = 2 THEN upper(p_name) ELSE p_name END AS movie_name
FROM part""")
def _docs_update(spark, sf_dir):
    from pyspark.sql import functions as F
    from martflow.operators import docs
    patch = (_part(spark, sf_dir).where(F.col("p_size") == 2)
             .select(F.col("p_partkey").cast("string").alias("id"), F.upper("p_name").alias("movie_name")))
    return docs.update_by_id(cat(spark, sf_dir).movie_titles, patch)


@register("docs_update_by_query", """
SELECT CAST(p_partkey AS VARCHAR) AS id, CASE WHEN p_name = 'red bolt' THEN 'blue bolt' ELSE p_name END AS movie_name
FROM part""")
def _docs_ubq(spark, sf_dir):
    from martflow.functions import text
    from martflow.operators import docs
    return docs.update_by_query(cat(spark, sf_dir).movie_titles,
                                text.exact_term("movie_name", "red bolt"), {"movie_name": "blue bolt"})


@register("docs_post", f"""
SELECT movie_name, id AS old_id, NULL AS id_length, 1 AS id_uses FROM ({_TITLES}) t
UNION ALL SELECT p_name || ' (new)', NULL, 36, 1 FROM part WHERE p_size = 50""")
def _docs_post(spark, sf_dir):
    from pyspark.sql import functions as F
    from martflow.operators import docs
    base = cat(spark, sf_dir).movie_titles.withColumn("old_id", F.col("id"))
    new = (_part(spark, sf_dir).where(F.col("p_size") == 50)
           .select(F.concat("p_name", F.lit(" (new)")).alias("movie_name"), F.lit(None).cast("string").alias("old_id")))
    out = docs.append_new(base.select("id", "movie_name", "old_id"), new)
    # base ids must come through unchanged; new ids have 36 characters; each id is used once
    per_id = out.groupBy("id").agg(F.max("movie_name").alias("movie_name"), F.max("old_id").alias("old_id"),
                                   F.count(F.lit(1)).alias("id_uses"))
    kept = per_id.where("old_id IS NULL OR id = old_id")
    return kept.select("movie_name", "old_id", F.when(F.col("old_id").isNull(), F.length("id")).alias("id_length"),
                       "id_uses")


def _search_sql(words, min_score, page_no, page_size):
    where = f"doubanScore >= {min_score} AND {O.any_term_sql('name', words)}"
    return O.with_views(["movies"], f"""
SELECT p.*, t.total FROM (SELECT COUNT(*) AS total FROM movies WHERE {where}) t LEFT JOIN (
  SELECT id, {O.highlight_sql('name', words)} AS name, doubanScore FROM movies WHERE {where}
  ORDER BY doubanScore DESC, id LIMIT {page_size} OFFSET {(page_no - 1) * page_size}) p ON true""")


@register("movie_search", _search_sql(["red", "bolt"], 5.0, 1, 1))
def _movie_search(spark, sf_dir):
    return Q.search_by_filter(cat(spark, sf_dir).movies, 5.0, "red bolt", 1, 1)


@register("movie_search_page2", _search_sql(["red", "bolt"], 5.0, 2, 2))
def _movie_search2(spark, sf_dir):
    return Q.search_by_filter(cat(spark, sf_dir).movies, 5.0, "Red  BOLT", 2, 2)


@register("movie_search_past_end", _search_sql(["red", "bolt"], 5.0, 100000, 5))
def _movie_search_past_end(spark, sf_dir):
    return Q.search_by_filter(cat(spark, sf_dir).movies, 5.0, "red bolt", 100000, 5)


_ACTOR_STATS = O.with_views(["movies", "movie_actors"], """
SELECT a.actor, COUNT(*) AS doc_count,
       CAST(SUM(CAST(m.doubanScore AS DECIMAL(18,2))) AS DOUBLE) / COUNT(m.doubanScore) AS avg_metric
FROM movie_actors a JOIN movies m ON a.movie_id = m.id
WHERE a.actor IS NOT NULL GROUP BY a.actor""")


@register("actor_stats", _ACTOR_STATS)
def _actor_stats(spark, sf_dir):
    from martflow.operators import aggregates
    c = cat(spark, sf_dir)
    return aggregates.pair_stats(c.movie_actors, c.movies, "movie_id", "id", "actor", "doubanScore",
                                 key_alias="actor")


@register("actor_avg_score_top10", f"""
SELECT actor, doc_count AS movies, avg_metric AS avg_score FROM ({_ACTOR_STATS}) s
ORDER BY avg_score DESC, actor LIMIT 10""")
def _actor_top(spark, sf_dir):
    c = cat(spark, sf_dir)
    return Q.avg_score_by_actor(c.movies, 10, actors=c.movie_actors)


# ---------------------------------------------------------------- dashboard contracts

_DAY_OF_TS = "strftime(epoch_ms(ts), '%Y-%m-%d')"


@register("pv_uv_by_day", O.with_views(["page_log"], f"""
SELECT {_DAY_OF_TS} AS dt, COUNT(*) AS pv, COUNT(DISTINCT mid) AS uv FROM page_log GROUP BY 1"""))
def _pv_uv(spark, sf_dir):
    return Q.pv_uv_by_day(cat(spark, sf_dir).page_log)


@register("visit_total", O.with_views(["page_log"], """
SELECT COUNT(*) AS pv_count, COUNT(DISTINCT mid) AS uv_count,
       COUNT(DISTINCT CASE WHEN is_new = '1' THEN mid END) AS new_count FROM page_log"""))
def _visit_total(spark, sf_dir):
    return Q.visit_total(cat(spark, sf_dir).page_log)


@register("new_visit_stats", O.with_views(["page_log"], """
SELECT is_new, views, visitors, sessions, mean_during_time,
       CASE WHEN sessions > 0 THEN views / sessions END AS pages_per_session FROM (
  SELECT is_new, COUNT(*) AS views, COUNT(DISTINCT mid) AS visitors,
         COUNT(CASE WHEN last_page_id IS NULL THEN 1 END) AS sessions,
         SUM(during_time) / COUNT(during_time) AS mean_during_time
  FROM page_log GROUP BY is_new) t"""))
def _new_visit(spark, sf_dir):
    return Q.new_visit_stats(cat(spark, sf_dir).page_log)


@register("channel_views", O.with_views(["page_log"], """
SELECT channel, COUNT(*) AS pv, COUNT(DISTINCT mid) AS uv FROM page_log GROUP BY channel"""))
def _channel(spark, sf_dir):
    return Q.channel_views(cat(spark, sf_dir).page_log)


@register("page_path", O.with_views(["page_log"], """
SELECT last_page_id AS source, page_id AS target, COUNT(*) AS value FROM page_log GROUP BY 1, 2"""))
def _page_path(spark, sf_dir):
    return Q.page_path(cat(spark, sf_dir).page_log)


@register("funnel", O.with_views(["page_log"], """
SELECT step, name, value FROM (
  SELECT COUNT(DISTINCT CASE WHEN page_id = 'view' THEN user_id END) AS s0,
         COUNT(DISTINCT CASE WHEN page_id = 'click' THEN user_id END) AS s1,
         COUNT(DISTINCT CASE WHEN page_id = 'purchase' THEN user_id END) AS s2 FROM page_log) a,
LATERAL (VALUES (1, 'view', a.s0), (2, 'click', a.s1), (3, 'purchase', a.s2)) v(step, name, value)"""))
def _funnel(spark, sf_dir):
    return Q.funnel(cat(spark, sf_dir).page_log)


@register("user_total", O.with_views(["page_log", "order_info"], f"""
SELECT (SELECT COUNT(DISTINCT user_id) FROM page_log) AS user_total,
       (SELECT COUNT(DISTINCT CASE WHEN is_new = '1' THEN user_id END) FROM page_log) AS new_user_count,
       COUNT(DISTINCT user_id) AS order_user_total,
       {O.money_sum_sql('final_total_amount')} / COUNT(DISTINCT user_id) AS amount_per_buyer
FROM order_info"""))
def _user_total(spark, sf_dir):
    c = cat(spark, sf_dir)
    return Q.user_total(c.page_log, c.order_info_raw)


@register("order_total_by_day", O.with_views(["order_enriched"], f"""
SELECT create_date, COUNT(*) AS order_count, {O.money_sum_sql('final_total_amount')} AS order_amount,
       COUNT(DISTINCT user_id) AS order_user FROM order_enriched GROUP BY create_date"""))
def _order_total(spark, sf_dir):
    return Q.order_total_by_day(cat(spark, sf_dir).order_facts())


@register("orders_by_area", O.with_views(["order_enriched"], """
SELECT province_name AS name, COUNT(*) AS value FROM order_enriched GROUP BY province_name"""))
def _area(spark, sf_dir):
    return Q.orders_by_area(cat(spark, sf_dir).order_provinces())


def _top_items_sql(col, num=10, where="true"):
    return O.with_views(["order_wide"], f"""
SELECT p.{col} AS name, COUNT(*) AS num, {O.money_sum_sql('w.split_total_amount')} AS amount
FROM order_wide w LEFT JOIN part p ON w.sku_id = p.p_partkey WHERE {where}
GROUP BY p.{col} ORDER BY num DESC, name LIMIT {num}""")


@register("top_categories", _top_items_sql("p_type"))
def _top_cat(spark, sf_dir):
    c = cat(spark, sf_dir)
    return Q.top_items(c.sold_lines(), c.products, "category", 10)


@register("top_brands", _top_items_sql("p_brand"))
def _top_brand(spark, sf_dir):
    c = cat(spark, sf_dir)
    return Q.top_items(c.sold_lines(), c.products, "tm", 10)


# ---------------------------------------------------------------- dashboard contracts over the last 7 days

LOG_SPAN = Q.day_span(TD)
ORDER_SPAN = Q.day_span(DAY)
_IN_LOG = f"strftime(epoch_ms(ts), '%Y-%m-%d') BETWEEN '{LOG_SPAN[0]}' AND '{LOG_SPAN[1]}'"
_IN_ORDERS = f"substr(create_time, 1, 10) BETWEEN '{ORDER_SPAN[0]}' AND '{ORDER_SPAN[1]}'"
_LOG7 = f"log7 AS (SELECT *, {_DAY_OF_TS} AS dt FROM page_log WHERE {_IN_LOG})"


def _log7(spark, sf_dir):
    return cat(spark, sf_dir).page_log_on(*LOG_SPAN)


@register("m1_pv_uv_days", O.with_views(["page_log"], f"""
, {_LOG7}
SELECT strftime(d.day, '%Y-%m-%d') AS dt, COUNT(l.ts) AS pv, COUNT(DISTINCT l.mid) AS uv
FROM (SELECT unnest(generate_series(DATE '{LOG_SPAN[0]}', DATE '{LOG_SPAN[1]}', INTERVAL 1 DAY)) AS day) d
LEFT JOIN log7 l ON l.dt = strftime(d.day, '%Y-%m-%d') GROUP BY 1"""))
def _m1(spark, sf_dir):
    return Q.pv_uv_series(_log7(spark, sf_dir), TD)


@register("m2_visit_total_days", O.with_views(["page_log"], f"""
, {_LOG7}
SELECT COUNT(*) AS pv_count, COUNT(DISTINCT mid) AS uv_count,
       COUNT(DISTINCT CASE WHEN is_new = '1' THEN mid END) AS new_count FROM log7"""))
def _m2(spark, sf_dir):
    return Q.visit_total(_log7(spark, sf_dir))


def _m3_side(flag):
    return f"""(SELECT CAST(SUM(views) AS DOUBLE) AS views, CAST(COUNT(DISTINCT mid) AS DOUBLE) AS visitors,
  100.0::DOUBLE * COUNT(CASE WHEN views = 1 THEN 1 END) / COUNT(*) AS bounce_percent,
  CAST(SUM(time) AS DOUBLE) / CAST(SUM(timed) AS DOUBLE) AS mean_time,
  CAST(SUM(views) AS DOUBLE) / COUNT(*) AS mean_pages FROM visits WHERE is_new = '{flag}')"""


@register("m3_new_visit_days", O.with_views(["page_log"], f"""
, {_LOG7},
visits AS (SELECT is_new, mid, dt, COUNT(*) AS views, SUM(during_time) AS time, COUNT(during_time) AS timed
           FROM log7 GROUP BY is_new, mid, dt)
SELECT f.field, f.o AS old, f.n AS new FROM {_m3_side('0')} o, {_m3_side('1')} n,
LATERAL (VALUES ('views', o.views, n.views), ('visitors', o.visitors, n.visitors),
  ('bounce_percent', o.bounce_percent, n.bounce_percent), ('mean_time', o.mean_time, n.mean_time),
  ('mean_pages', o.mean_pages, n.mean_pages)) f(field, o, n)"""))
def _m3(spark, sf_dir):
    return Q.new_visit_table(_log7(spark, sf_dir))


@register("m4_channel_pv_days", O.with_views(["page_log"], f"""
, {_LOG7} SELECT channel AS name, CAST(COUNT(*) AS DOUBLE) AS value FROM log7 GROUP BY channel"""))
def _m4_pv(spark, sf_dir):
    return Q.channel(_log7(spark, sf_dir), "pv")


@register("m4_channel_br_days", O.with_views(["page_log"], f"""
, {_LOG7},
visits AS (SELECT channel, mid, dt, COUNT(*) AS views FROM log7 GROUP BY channel, mid, dt)
SELECT channel AS name, 100.0::DOUBLE * COUNT(CASE WHEN views = 1 THEN 1 END) / COUNT(*) AS value
FROM visits GROUP BY channel"""))
def _m4_br(spark, sf_dir):
    return Q.channel(_log7(spark, sf_dir), "br")


_RECORD_ORDER = ", ".join(f"{c} NULLS FIRST" for c in ("ts", *S.READ))
_SESSIONS = f"""
numbered AS (
  SELECT *, SUM(CASE WHEN last_page_id IS NULL THEN 1 ELSE 0 END) OVER w AS k, row_number() OVER w AS rn FROM {{log}}
  WINDOW w AS (PARTITION BY mid ORDER BY {_RECORD_ORDER} ROWS UNBOUNDED PRECEDING)),
found AS (
  SELECT mid, MIN(ts) AS start_ts, MAX(ts) AS end_ts, k > 0 AS opened, COUNT(*) AS views,
         CAST(SUM(during_time) AS BIGINT) AS time, COUNT(during_time) AS timed, MAX(is_new) AS is_new,
         arg_min_null(channel, rn) AS channel, arg_min_null(page_id, rn) AS entry_page, arg_max_null(page_id, rn) AS exit_page
  FROM numbered GROUP BY mid, k)"""
_SESSIONS7 = f", {_LOG7}, {_SESSIONS.format(log='log7')}"


def _sessions7(spark, sf_dir):
    from martflow.sources import tables
    return S.sessions(tables.page_log(spark, sf_dir, *LOG_SPAN, with_province=False))


@register("sessions_days", O.with_views(["page_log"], f"{_SESSIONS7} SELECT * FROM found"))
def _sessions_days(spark, sf_dir):
    """The sessions of the range, islands opened by a record without ``last_page_id``."""
    return _sessions7(spark, sf_dir)


@register("m3_sessions_days", O.with_views(["page_log"], f"""{_SESSIONS7},
side AS (SELECT is_new, CAST(SUM(views) AS DOUBLE) AS views, CAST(COUNT(DISTINCT mid) AS DOUBLE) AS visitors,
  100.0::DOUBLE * COUNT(CASE WHEN opened AND views = 1 THEN 1 END) / COUNT(*) AS bounce_percent,
  CAST(SUM(time) AS DOUBLE) / CAST(SUM(timed) AS DOUBLE) AS mean_time,
  CAST(SUM(views) AS DOUBLE) / COUNT(*) AS mean_pages FROM found GROUP BY is_new)
SELECT f.field, f.o AS old, f.n AS new
FROM (SELECT 1) one LEFT JOIN side o ON o.is_new = '0' LEFT JOIN side n ON n.is_new = '1',
LATERAL (VALUES ('views', coalesce(o.views, 0), coalesce(n.views, 0)), ('visitors', coalesce(o.visitors, 0), coalesce(n.visitors, 0)),
  ('bounce_percent', o.bounce_percent, n.bounce_percent), ('mean_time', o.mean_time, n.mean_time),
  ('mean_pages', o.mean_pages, n.mean_pages)) f(field, o, n)"""))
def _m3_sessions(spark, sf_dir):
    return S.visit_table(_sessions7(spark, sf_dir))


@register("m4_bounce_sessions_days", O.with_views(["page_log"], f"""{_SESSIONS7}
SELECT channel AS name, 100.0::DOUBLE * COUNT(CASE WHEN opened AND views = 1 THEN 1 END) / COUNT(*) AS value
FROM found GROUP BY channel"""))
def _m4_sessions(spark, sf_dir):
    return S.bounce_by_channel(_sessions7(spark, sf_dir))


@register("m5_page_links_days", O.with_views(["page_log"], f"""
, {_LOG7} SELECT last_page_id AS source, page_id AS target, COUNT(*) AS value FROM log7 GROUP BY 1, 2"""))
def _m5_links(spark, sf_dir):
    return Q.page_path(_log7(spark, sf_dir))


@register("m5_page_nodes_days", O.with_views(["page_log"], f"""
, {_LOG7} SELECT DISTINCT name FROM (SELECT last_page_id AS name FROM log7 UNION ALL SELECT page_id FROM log7) t
WHERE name IS NOT NULL"""))
def _m5_nodes(spark, sf_dir):
    return Q.page_nodes(_log7(spark, sf_dir))


@register("m6_user_action_convert_days", O.with_views(["page_log", "order_info"], f"""
, {_LOG7}
SELECT s.step, s.name, s.value FROM (
  SELECT COUNT(DISTINCT CASE WHEN page_id = 'view' THEN user_id END) AS home,
         COUNT(DISTINCT CASE WHEN page_id = 'click' THEN user_id END) AS detail,
         COUNT(DISTINCT CASE WHEN page_id = 'purchase' THEN user_id END) AS pay FROM log7) a,
  (SELECT COUNT(DISTINCT user_id) AS buyers FROM order_info WHERE {_IN_ORDERS}) b,
LATERAL (VALUES (1, 'home', a.home), (2, 'good_detail', a.detail), (3, 'cart', a.detail), (4, 'order', b.buyers),
  (5, 'pay', a.pay)) s(step, name, value) WHERE s.value > 0"""))
def _m6(spark, sf_dir):
    """Home = a session start, detail = a click, cart = an action that adds to the cart
    (from the action rows of the app log), order = an order, pay = a purchase page."""
    from pyspark.sql import functions as F
    from martflow.operators import parse
    from martflow.sources import tables
    c, log = cat(spark, sf_dir), _log7(spark, sf_dir)
    actions = parse.action_rows(parse.parse_log(tables.app_log(spark, sf_dir, *LOG_SPAN)))
    return Q.user_action_convert({
        "home": log.where("last_page_id IS NULL"), "good_detail": log.where("page_id = 'click'"),
        "cart": actions.where(F.col("action_id") == "cart_add"), "order": c.order_facts(*ORDER_SPAN),
        "pay": log.where("page_id = 'purchase'")})


@register("m6_user_paid_days", O.with_views(["page_log"], f"""
, {_LOG7}
SELECT v.name, v.value FROM (SELECT COUNT(DISTINCT user_id) AS n,
  COUNT(DISTINCT CASE WHEN page_id = 'purchase' THEN user_id END) AS paid FROM log7) a,
LATERAL (VALUES ('paid', a.paid), ('unpaid', a.n - a.paid)) v(name, value)"""))
def _m6_paid(spark, sf_dir):
    return Q.user_paid(_log7(spark, sf_dir))


@register("m7_user_total_days", O.with_views(["page_log", "order_info"], f"""
, {_LOG7}, orders7 AS (SELECT * FROM order_info WHERE {_IN_ORDERS}),
debut AS (SELECT user_id, MIN(substr(create_time, 1, 10)) AS debut FROM order_info GROUP BY user_id)
SELECT (SELECT COUNT(DISTINCT user_id) FROM log7) AS user_total,
       (SELECT COUNT(DISTINCT user_id) FROM orders7) AS order_user_total,
       (SELECT COUNT(DISTINCT CASE WHEN is_new = '1' THEN user_id END) FROM log7) AS new_user_count,
       (SELECT COUNT(DISTINCT o.user_id) FROM orders7 o JOIN debut d ON o.user_id = d.user_id
        WHERE d.debut >= '{ORDER_SPAN[0]}') AS new_order_user_count,
       (SELECT {O.money_sum_sql('final_total_amount')} / NULLIF(COUNT(DISTINCT user_id), 0) FROM orders7) AS pct"""))
def _m7(spark, sf_dir):
    c = cat(spark, sf_dir)
    return Q.user_totals(_log7(spark, sf_dir), c.order_facts(*ORDER_SPAN), c.order_facts(), ORDER_SPAN[0])


@register("m8_order_total_days", O.with_views(["order_info"], f"""
SELECT COUNT(*) AS order_count, COALESCE({O.money_sum_sql('final_total_amount')}, 0) AS order_amount,
       COUNT(DISTINCT user_id) AS order_user FROM order_info WHERE {_IN_ORDERS}"""))
def _m8(spark, sf_dir):
    return Q.order_total(cat(spark, sf_dir).order_facts(*ORDER_SPAN))


@register("m9_area_days", O.with_views(["order_enriched"], f"""
SELECT province_name AS name, COUNT(*) AS value FROM order_enriched WHERE {_IN_ORDERS} GROUP BY province_name"""))
def _m9(spark, sf_dir):
    return Q.orders_by_area(cat(spark, sf_dir).order_provinces(*ORDER_SPAN))


def _m10(spark, sf_dir, by):
    c = cat(spark, sf_dir)
    return Q.top_items(c.sold_lines(*ORDER_SPAN), c.products, by)


_W7 = "substr(w.create_time, 1, 10) BETWEEN '{}' AND '{}'".format(*ORDER_SPAN)


@register("m10_category_days", _top_items_sql("p_type", Q.TOP, _W7))
def _m10_category(spark, sf_dir):
    return _m10(spark, sf_dir, "category")


@register("m10_spu_days", _top_items_sql("p_name", Q.TOP, _W7))
def _m10_spu(spark, sf_dir):
    return _m10(spark, sf_dir, "spu")


@register("m10_tm_days", _top_items_sql("p_brand", Q.TOP, _W7))
def _m10_tm(spark, sf_dir):
    return _m10(spark, sf_dir, "tm")


# ---------------------------------------------------------------- streaming jobs (stream = batch)

@register("stream_dau_info", O.with_views(["dau"], "SELECT * FROM dau"))
def _stream_dau(spark, sf_dir):
    """Raw app log through the log-split and DAU streaming jobs."""
    from martflow.streaming import pipeline
    table, _ = pipeline.run_dau(spark, sf_dir, as_of=AS_OF)
    return table.table().select(*schemas.names(schemas.DAU_INFO))


@register("stream_order_wide", O.with_views(["order_wide"], "SELECT * FROM order_wide"))
def _stream_order_wide(spark, sf_dir):
    """Order and line topics through the time-bounded stream join, four micro-batches."""
    from martflow.streaming import pipeline
    table, late, _ = pipeline.run_order_join(spark, sf_dir, as_of=AS_OF)
    if late:
        raise RuntimeError(f"{late} rows of a time-ordered topic were late")
    return table.table().select(*schemas.names(schemas.ORDER_WIDE))


@register("stream_order_wide_lines_first", O.with_views(["order_wide"], "SELECT * FROM order_wide"))
def _stream_order_wide_lines_first(spark, sf_dir):
    """The same with the lines ahead of their orders (two files against six)."""
    from martflow.streaming import pipeline
    table, late, _ = pipeline.run_order_join(spark, sf_dir, as_of=AS_OF, files=6, line_files=2)
    if late:
        raise RuntimeError(f"{late} rows of a time-ordered topic were late")
    return table.table().select(*schemas.names(schemas.ORDER_WIDE))


@register("stream_order_wide_reconciled", O.with_views(["order_wide"], "SELECT * FROM order_wide"))
def _stream_order_wide_reconciled(spark, sf_dir):
    """Topics in random order: the stream drops late rows, the reconcile job brings
    their pairs in."""
    from martflow.streaming import pipeline
    table, late, missed = pipeline.run_order_join(spark, sf_dir, as_of=AS_OF, ordered=False, reconcile=True)
    if missed and not late:
        raise RuntimeError(f"{missed} pairs were missing without late rows")
    return table.table().select(*schemas.names(schemas.ORDER_WIDE))


def _dim_rows(dims_table):
    from pyspark.sql import functions as F
    return dims_table.table().select(
        F.col("table").alias("table_name"), F.col("id").cast("long").alias("id"), "op",
        F.get_json_object("data", "$.value").cast("double").alias("amount"), F.col("offset").alias("src_offset"))


@register("stream_cdc_dim_snapshot", _dim_sql(False))
def _stream_cdc_dim(spark, sf_dir):
    from martflow.streaming import pipeline
    return _dim_rows(pipeline.run_cdc(spark, sf_dir)[1])


@register("stream_cdc_dim_two_checkpoints", _dim_sql(False))
def _stream_cdc_dim_two(spark, sf_dir):
    """Two checkpoints one after the other update the same keys; batch ids restart."""
    from martflow.streaming import pipeline
    return _dim_rows(pipeline.run_cdc(spark, sf_dir, files=2, checkpoints=2)[1])


@register("stream_cdc_fact_counts", f"""
SELECT 'DWD_ORDER_INFO_' || op AS topic, COUNT(*) AS n
FROM (SELECT *, {_OP_SQL} AS op FROM events) e
WHERE op IS NOT NULL AND user_id % 2 = 1 GROUP BY op""")
def _stream_cdc_facts(spark, sf_dir):
    from pyspark.sql import functions as F
    from martflow.streaming import pipeline
    facts, _ = pipeline.run_cdc(spark, sf_dir)
    return facts.read().groupBy("topic").agg(F.count(F.lit(1)).alias("n"))


@register("stream_log_route_counts", REGISTRY["log_route_counts"][1] + """
UNION ALL SELECT 'BAD_RECORDS', 0""")
def _stream_log_counts(spark, sf_dir):
    """Messages per topic, BAD_RECORDS always among them (none expected)."""
    from pyspark.sql import functions as F
    from martflow.streaming import pipeline
    routed = spark.read.parquet(pipeline.run_log_split(spark, sf_dir))
    bad = routed.agg(F.count(F.when(F.col("topic") == "BAD_RECORDS", 1)).alias("n"))
    return (routed.where(F.col("topic") != "BAD_RECORDS").groupBy("topic").agg(F.count(F.lit(1)).alias("n"))
            .unionByName(bad.select(F.lit("BAD_RECORDS").alias("topic"), "n")))


@register("stream_batch_counts", O.with_views(["page_log", "dau"], """
SELECT 'input' AS name, COUNT(*) AS n FROM page_log WHERE page_id IN ('view', 'click', 'purchase')
UNION ALL SELECT 'entries', COUNT(*) FROM page_log WHERE page_id = 'view'
UNION ALL SELECT 'no_user', 0
UNION ALL SELECT 'no_province', 0"""))
def _stream_batch_counts(spark, sf_dir):
    """The counts that the DAU job reports per micro-batch, summed."""
    from martflow.streaming import jobs, pipeline
    said = []
    with jobs.Progress(spark) as progress:
        _, query = pipeline.run_dau(spark, sf_dir, as_of=AS_OF, report=lambda name, batch, counts: said.append(counts))
        n = {"input": progress.observed(query, "dau_input"), "entries": progress.observed(query, "dau_entries")}
    n = {**n,
         **{k: sum(c[k] for c in said) for k in ("no_user", "no_province")}}
    return spark.createDataFrame(sorted(n.items()), "name string, n long")


@register("stream_sessions", O.with_views(["page_log"], f", {_SESSIONS.format(log='page_log')} SELECT * FROM found"))
def _stream_sessions(spark, sf_dir):
    """M3, M4 in a stream: sessions kept up to date while records arrive in no order."""
    from martflow.streaming import pipeline
    return pipeline.run_sessions(spark, sf_dir).sessions()


@register("stream_dau_restart", O.with_views(["dau"], "SELECT DISTINCT mid, dt FROM dau"))
def _stream_dau_restart(spark, sf_dir):
    """The first-arrival job restarted without its state reads the whole topic
    again; the devices already in the sink are dropped, so each is there once."""
    from martflow.sources import tables
    from martflow.session import work_dir
    from martflow.streaming import jobs, pipeline
    base = work_dir(spark, "dau_restart")
    tables.page_log(spark, sf_dir).write.parquet(f"{base}/page")
    table = jobs.KeyedTable(spark, f"{base}/dau", keys=["mid", "dt", "ts"], slice_col="dt")
    for run in ("first", "second"):
        page = spark.readStream.schema(schemas.PAGE_LOG).parquet(f"{base}/page")
        pipeline.finish(jobs.dau_job(page, pipeline.dims_of(spark, sf_dir), table, f"{base}/_ckpt/{run}", "availableNow",
                                     as_of=AS_OF, mode="first_arrival", bootstrap_from_sink=True))
    return table.table().select("mid", "dt")


@register("stream_dau_state_restart", O.with_views(["dau"], "SELECT * FROM dau"))
def _stream_dau_state_restart(spark, sf_dir):
    """State with a TTL; a second run without its checkpoint starts from the table."""
    from martflow.streaming import pipeline
    table, _ = pipeline.run_first_visits(spark, sf_dir, as_of=AS_OF, runs=2)
    return table.table().select(*schemas.names(schemas.DAU_INFO))


@register("stream_dau_hourly", REGISTRY["dau_hourly"][1])
def _stream_dau_hourly(spark, sf_dir):
    """Hourly counts kept by retraction while visits arrive in no order."""
    from martflow.streaming import pipeline
    return pipeline.run_first_visits(spark, sf_dir, as_of=AS_OF)[1].counts()


@register("stream_dau_realtime", REGISTRY["dau_realtime"][1])
def _stream_dau_realtime(spark, sf_dir):
    """L1 from the maintained counts: a dashboard reads two days' rows of them."""
    from martflow.streaming import pipeline
    _, hourly = pipeline.run_first_visits(spark, sf_dir, as_of=AS_OF)
    return Q.dau_realtime_of_counts(hourly.counts(), TD)


@register("stream_pv_uv_days", REGISTRY["m1_pv_uv_days"][1])
def _stream_pv_uv(spark, sf_dir):
    """M1 from bitmaps and sums per day, kept while records arrive in no order."""
    from martflow.streaming import pipeline
    return Q.pv_uv_series_of_state(pipeline.run_page_counts(spark, sf_dir).per_day(*LOG_SPAN), TD)


@register("stream_visit_total_days", REGISTRY["m2_visit_total_days"][1])
def _stream_visit_total(spark, sf_dir):
    """M2: the days' bitmaps or-ed over the range, not added up."""
    from martflow.streaming import pipeline
    return Q.visit_total_of_state(pipeline.run_page_counts(spark, sf_dir).total(*LOG_SPAN))


@register("stream_user_total_days", REGISTRY["m7_user_total_days"][1])
def _stream_user_total(spark, sf_dir):
    """M7: buyers and first-time buyers of the range without a look at older orders."""
    from martflow.streaming import pipeline
    pages, orders = pipeline.run_page_counts(spark, sf_dir), pipeline.run_order_counts(spark, sf_dir)
    return Q.user_totals_of_state(pages.total(*LOG_SPAN), orders.total(*ORDER_SPAN))


@register("stream_offset_ranges", """
SELECT 'ods_base_db_group' AS "group", 'ODS_BASE_DB' AS topic, CAST(event_id % 4 AS INTEGER) AS partition, MIN(event_id) AS from_offset,
       MAX(event_id) + 1 AS until_offset, COUNT(*) AS rows, true AS in_order, MAX(event_id) + 1 AS saved
FROM events GROUP BY event_id % 4""")
def _stream_offset_ranges(spark, sf_dir):
    """A3, A4: the ranges that the batches saved, per partition: from the first offset to
    the last, each batch's after the one before; and the position to go on from (A5)."""
    from pyspark.sql import Window, functions as F
    from martflow.streaming import pipeline
    _, ledger = pipeline.run_ledger(spark, sf_dir)
    w = Window.partitionBy("group", "topic", "partition").orderBy("batch_id")
    steps = ledger.history().withColumn("before", F.lag("until_offset").over(w))
    saved = ledger.saved("ods_base_db_group").select("topic", "partition", F.col("until_offset").alias("saved"))
    return steps.groupBy("group", "topic", "partition").agg(
        F.min("from_offset").alias("from_offset"), F.max("until_offset").alias("until_offset"), F.sum("rows").alias("rows"),
        F.every(F.coalesce(F.col("from_offset") >= F.col("before"), F.lit(True))).alias("in_order")
    ).join(saved, ["topic", "partition"])


@register("stream_restart_from_ledger", REGISTRY["stream_cdc_fact_counts"][1])
def _stream_restart_from_ledger(spark, sf_dir):
    """A5: a second query with a new checkpoint goes on from the ledger; the topic files,
    which keep each writer's batches, have every message once."""
    from pyspark.sql import functions as F
    from martflow.streaming import pipeline
    facts, _ = pipeline.run_ledger(spark, sf_dir, checkpoints=2)
    return facts.read().groupBy("topic").agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- sinks and config tables

def _dau_sink(spark, sf_dir, name):
    from martflow.session import work_dir
    from martflow.streaming import jobs
    return jobs.dau_table(spark, work_dir(spark, name))


@register("sink_day_slice_field", O.with_views(["dau"], f"SELECT mid FROM dau WHERE dt = '{TD}'"))
def _sink_field(spark, sf_dir):
    """One field of a day slice of a stored table."""
    table = _dau_sink(spark, sf_dir, "sink_field")
    table.upsert(cat(spark, sf_dir).dau_info(), 0, "a")
    return table.field("mid", TD)


@register("sink_replayed", O.with_views(["dau"], "SELECT * FROM dau"))
def _sink_replayed(spark, sf_dir):
    """A batch written twice, and once more by another writer, is there once."""
    table, rows = _dau_sink(spark, sf_dir, "sink_replayed"), cat(spark, sf_dir).dau_info()
    table.upsert(rows, 0, "a")
    table.upsert(rows, 0, "a")
    table.upsert(rows, 0, "b")
    return table.table().select(*schemas.names(schemas.DAU_INFO))


FRESH_DAY = "2024-01-16"


@register("stream_fresh_dimension", O.with_views(["dau"], f"""
SELECT mid, dt, CASE WHEN dt >= '{FRESH_DAY}' OR province_id = '0' THEN province_name END AS province_name FROM dau"""))
def _stream_fresh_dimension(spark, sf_dir):
    """Provinces that are stored between two micro-batches show in the second."""
    from pyspark.sql import functions as F
    from martflow.functions.dates import day_of_millis
    from martflow.session import work_dir
    from martflow.sources import tables
    from martflow.streaming import jobs, pipeline
    base = work_dir(spark, "fresh_dimension")
    provinces, table = tables.base_province(spark, sf_dir), jobs.dau_table(spark, f"{base}/dau")
    log = tables.page_log(spark, sf_dir)
    now = lambda: (tables.user_info(spark, sf_dir), spark.read.parquet(f"{base}/provinces"))
    for rows, known in ((day_of_millis("ts") < FRESH_DAY, "id = 0"), (day_of_millis("ts") >= FRESH_DAY, "id <> 0")):
        log.where(rows).write.mode("append").parquet(f"{base}/page")
        provinces.where(F.expr(known)).write.mode("append").parquet(f"{base}/provinces")
        page = spark.readStream.schema(schemas.PAGE_LOG).parquet(f"{base}/page")
        pipeline.finish(jobs.dau_job(page, now, table, f"{base}/_ckpt", "availableNow", as_of=AS_OF))
    return table.table().select("mid", "dt", "province_name")


@register("text_to_number", """
SELECT event_type AS name, COUNT(*) AS rows, COUNT(n) AS numbers, SUM(n) AS total FROM (
  SELECT event_type, TRY_CAST(CASE WHEN event_type = 'error' THEN json_extract_string(props, '$.k') || ' pcs'
                                   ELSE json_extract_string(props, '$.k') END AS DOUBLE) AS n FROM events) t
GROUP BY event_type""")
def _text_to_number(spark, sf_dir):
    """Numbers out of text; the error events' text is no number and gives null."""
    from pyspark.sql import functions as F
    from martflow.functions import labels
    k = F.get_json_object("props", "$.k")
    text = F.when(F.col("event_type") == "error", F.concat(k, F.lit(" pcs"))).otherwise(k)
    rows = cat(spark, sf_dir).table("events").select(F.col("event_type").alias("name"), labels.to_number(text).alias("n"))
    return rows.groupBy("name").agg(F.count(F.lit(1)).alias("rows"), F.count("n").alias("numbers"), F.sum("n").alias("total"))


@register("cdc_listed_tables", f"""
SELECT 'DWD_' || upper(t) || '_' || op AS topic, COUNT(*) AS n FROM (
  SELECT *, {_OP_SQL} AS op, CASE WHEN user_id % 2 = 0 THEN 'user_info' ELSE 'order_info' END AS t FROM events) e
WHERE op IS NOT NULL GROUP BY 1""")
def _cdc_listed(spark, sf_dir):
    """The table list read from a stored config table that was edited."""
    from pyspark.sql import functions as F
    from martflow.operators import cdc
    from martflow.session import work_dir
    path = work_dir(spark, "table_list")
    for name in ("order_info", "user_info"):
        cdc.table_list(spark, [name]).write.mode("append").parquet(f"{path}/tables")
    m = cdc.fact_messages(_changes(spark, sf_dir), cdc.table_list(spark, path=f"{path}/tables"))
    return m.groupBy("topic").agg(F.count(F.lit(1)).alias("n"))


def _relevance_sql(words, page_no, page_size):
    """BM25 (k1 = 1.2, b = 0.75) over all wide rows as the corpus, the same
    operation order as the Spark expression; only the page order is
    compared (the score is not an output column)."""
    where = O.all_terms_sql("sku_name", words)
    terms = []
    for w in words:
        tf = f"CAST(len(list_filter(c.toks, lambda x: x = '{w}')) AS DOUBLE)"
        n = f"CAST(COALESCE((SELECT df FROM dfq WHERE term = '{w}'), 0) AS DOUBLE)"
        idf = f"ln(1.0 + (st.n - {n} + 0.5) / ({n} + 0.5))"
        norm = f"({tf} + 1.2 * (0.25 + 0.75 * len(c.toks) / st.avgdl))"
        terms.append(f"{idf} * {tf} * 2.2 / {norm}")
    score = "0.0"
    for t in terms:
        score = f"({score} + {t})"
    return O.with_views(["order_wide"], f"""
, c AS (SELECT *, {O.tokens_sql('sku_name')} AS toks FROM order_wide),
st AS (SELECT COUNT(*) AS n, AVG(len(toks)) AS avgdl FROM c),
dfq AS (SELECT t AS term, COUNT(*) AS df FROM (SELECT list_distinct(toks) AS u FROM c) x, unnest(x.u) AS z(t)
        GROUP BY t),
m AS (SELECT c.*, {score} AS score FROM c, st WHERE {where.replace('sku_name', 'c.sku_name')})
SELECT p.*, t.total FROM (SELECT COUNT(*) AS total FROM m) t LEFT JOIN (
  SELECT create_time, order_price, province_name, {O.highlight_sql('sku_name', words)} AS sku_name,
         sku_num, split_total_amount AS total_amount, user_age, user_gender
  FROM m ORDER BY score DESC, detail_id LIMIT {page_size} OFFSET {(page_no - 1) * page_size}) p ON true""")


@register("detail_by_item_relevance", _relevance_sql(_RED_BOLT, 2, 15))
def _detail_rel(spark, sf_dir):
    return _detail_page(spark, sf_dir, "red bolt", 2, 15, order="score")


# ---------------------------------------------------------------- stored by key, then asked

def _order_buckets(spark, sf_dir):
    from martflow.session import work_dir
    from martflow.sources.buckets import OrderBuckets
    from martflow.sources import tables
    c = cat(spark, sf_dir)
    return OrderBuckets(spark, work_dir(spark, "order_buckets"), c.order_info,
                        tables.order_detail(spark, sf_dir, with_ship_time=True, with_create_time=False))


@register("stored_order_wide", REGISTRY["order_wide"][1])
def _stored_order_wide(spark, sf_dir):
    """D8 from tables bucketed by order: no exchange in the join."""
    return _order_buckets(spark, sf_dir).order_wide()


@register("stored_order_wide_within_24h", REGISTRY["order_wide_within_24h"][1])
def _stored_order_wide_within(spark, sf_dir):
    """D8 with the time bound from the same tables."""
    from pyspark.sql import functions as F
    return _order_buckets(spark, sf_dir).order_wide_within(F.to_timestamp("create_time"), F.to_timestamp("ship_time"))


@register("stored_m10_spu_days", REGISTRY["m10_spu_days"][1])
def _stored_m10(spark, sf_dir):
    """M10 from the same tables: lines meet their orders without an exchange."""
    return Q.top_items(_order_buckets(spark, sf_dir).sold_lines(*ORDER_SPAN), cat(spark, sf_dir).products, "spu")


@register("deep_detail_by_item", _detail_sql(_RED, None, 150, 20))
def _deep_detail(spark, sf_dir):
    """G1 for a deep page: the range that holds it is found by counts."""
    c = cat(spark, sf_dir)
    return Q.detail_by_item(c.sales(), c.enrich_sales, ITEM, 150, 20, deep=True)


def _line_postings(spark, sf_dir):
    """Postings of the product names, weighted by the lines that have an order."""
    from pyspark.sql import functions as F
    from martflow.operators.postings import write_postings
    from martflow.session import work_dir
    return write_postings(cat(spark, sf_dir).product_sales(), work_dir(spark, "postings"), "sku_id", "sku_name", F.col("lines"))


@register("stored_detail_by_item_relevance", REGISTRY["detail_by_item_relevance"][1])
def _stored_detail_rel(spark, sf_dir):
    """G5 from stored postings: no text is tokenized by the query."""
    from pyspark.sql import functions as F
    c, q = cat(spark, sf_dir), "red bolt"
    postings = _line_postings(spark, sf_dir)
    scored = postings.bm25(q).select(F.col("doc").alias("sku_id"), F.col("weight").alias("_lines"), "score")
    skus = scored.select("sku_id")
    skus = F.broadcast(skus) if postings.few(q) else skus
    return Q.detail_by_item(c.sales(skus=skus), c.enrich_sales, q, 2, 15, "score", scored=scored)


@register("stored_stats_by_item_gender", _gender_sql(_RED_BOLT))
def _stored_stats(spark, sf_dir):
    """C7 from stored postings, the rarest term first."""
    found = _line_postings(spark, sf_dir).match_all("Bolt RED")
    return Q.stats_by_item(cat(spark, sf_dir).buyer_sales(), "Bolt RED", None, "gender", found=found)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: v[0] for k, v in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {k: v[1] for k, v in REGISTRY.items() if v[1] is not None}
