"""Input tables and the pipeline's record streams derived from them.

The driver data is a TPC-H-like star schema plus an ``events`` table.  The
functions here express the commerce pipeline's inputs (page log, app log
JSON, change records, dimensions, order facts, demo documents) as
DataFrame plans over those tables, so every downstream operator reads the
given data and its work grows with it.  The DuckDB oracle builds the same
views from the same rules (``martflow.plans.oracle``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martflow.functions.dates import ts_to_millis
from martflow.operators.dims import sized_side

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()

# The change-record operation each event type stands for,
# and the table chosen by user parity.
EVENT_TO_CHANGE_TYPE = {
    "signup": "bootstrap-insert", "view": "insert", "click": "update",
    "purchase": "delete", "error": "bootstrap-start",
}
CHANGE_TABLE_EVEN, CHANGE_TABLE_ODD = "user_info", "order_info"

# The birthday rule of the user dimension.
BIRTHDAY_EPOCH, BIRTHDAY_MULT, BIRTHDAY_SPAN = "1950-01-01", 7919, 25000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, listed anew each time, so that new files are seen."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _lookup(mapping: dict, col) -> F.Column:
    expr = None
    for k, v in mapping.items():
        expr = F.when(col == k, v) if expr is None else expr.when(col == k, v)
    return expr


# ---------------------------------------------------------------- dimensions

def user_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User dimension: ``id, gender, birthday`` (birthday as ISO text)."""
    c = table(spark, sf_dir, "customer").select("c_custkey")
    return c.select(
        F.col("c_custkey").alias("id"),
        F.when(F.col("c_custkey") % 2 == 0, "F").otherwise("M").alias("gender"),
        F.date_format(F.date_add(F.lit(BIRTHDAY_EPOCH).cast("date"),
                                 ((F.col("c_custkey") * BIRTHDAY_MULT) % BIRTHDAY_SPAN).cast("int")),
                      "yyyy-MM-dd").alias("birthday"),
    )


def base_province(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Province dimension: ``id, name, iso_code, area_code, iso_3166_2``."""
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    k = F.col("n_nationkey").cast("string")
    return n.select(
        F.col("n_nationkey").cast("long").alias("id"),
        F.col("n_name").alias("name"),
        F.concat(F.lit("ISO-"), k).alias("iso_code"),
        F.concat(F.lit("AREA-"), F.lpad(k, 3, "0")).alias("area_code"),
        F.concat(F.lit("CN-"), k).alias("iso_3166_2"),
    )


# ---------------------------------------------------------------- page log

def _device_columns(user_id, nation_key) -> list:
    """The nine device fields of a log record, derived from the user."""
    u = user_id
    return [
        F.concat(F.lit("mid_"), u.cast("string")).alias("mid"),
        u.cast("string").alias("user_id"),
        nation_key.cast("string").alias("province_id"),
        F.concat(F.lit("ch_"), (u % 5).cast("string")).alias("channel"),
        F.lit(None).cast("string").alias("is_new"),  # replaced per event below
        F.concat(F.lit("model_"), (u % 7).cast("string")).alias("model"),
        F.when(u % 2 == 0, "Android").otherwise("iOS").alias("operate_system"),
        F.concat(F.lit("v"), (u % 3).cast("string")).alias("version_code"),
        F.concat(F.lit("brand_"), (u % 6).cast("string")).alias("brand"),
    ]


def events_with_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` with the user's nation key (the province of the device).

    customer is a dimension keyed by ``c_custkey``; the planner picks a
    broadcast while its size statistic is small and a shuffle join beyond.
    """
    ev = table(spark, sf_dir, "events")
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return ev.join(cust, ev.user_id == cust.c_custkey, "left").drop("c_custkey")


def day_range(col: str, first: str, last: str | None = None) -> F.Column:
    """``col`` within the calendar days ``first``..``last`` ('yyyy-MM-dd'), as a range on
    the raw timestamp column with typed literals, so the scan receives it as pushed
    filters (row-group and partition skipping) where a test on formatted text could only
    run after the scan."""
    lo, hi = (F.expr(f"TIMESTAMP_NTZ '{d} 00:00:00'") for d in (first, last or first))
    return (F.col(col) >= lo) & (F.col(col) < hi + F.expr("INTERVAL 1 DAY"))


def session_starts(spark: SparkSession, sf_dir: str, first: str | None = None,
                   last: str | None = None) -> DataFrame:
    """``mid, ts`` of the page records that open a session, all that the daily-active
    counts need: no dimension is joined, and days become a pushed range."""
    e = table(spark, sf_dir, "events")
    if first is not None:
        e = e.where(day_range("ts", first, last))
    return e.where(F.col("event_type") == "view") \
        .select(F.concat(F.lit("mid_"), F.col("user_id").cast("string")).alias("mid"), ts_to_millis("ts").alias("ts"))


def page_log(spark: SparkSession, sf_dir: str, first: str | None = None, last: str | None = None,
             with_province: bool = True) -> DataFrame:
    """The page-log topic as typed rows (16 columns of the page bean).

    Every event is a page view whose ``page_id`` is the event type; only
    ``view`` events start a session (``last_page_id`` null).  ``first`` and
    ``last`` keep a range of days (pushed to the scan).  ``with_province=False``
    leaves ``province_id`` null, and with it the join to the customers.
    """
    e = events_with_nation(spark, sf_dir) if with_province else \
        table(spark, sf_dir, "events").withColumn("c_nationkey", F.lit(None).cast("long"))
    if first is not None:
        e = e.where(day_range("ts", first, last))
    u = F.col("user_id")
    dev = _device_columns(u, F.col("c_nationkey"))
    dev[4] = F.when(F.col("event_type") == "signup", "1").otherwise("0").alias("is_new")
    k = F.get_json_object("props", "$.k")
    return e.select(
        *dev,
        F.col("event_type").alias("page_id"),
        F.when(F.col("event_type") == "view", F.lit(None)).otherwise(F.lit("home"))
         .cast("string").alias("last_page_id"),
        k.alias("page_item"),
        F.lit("sku_id").alias("page_item_type"),
        F.floor(F.col("value") * 100).cast("long").alias("during_time"),
        F.when(F.col("value") > 50, "promotion").otherwise("query").alias("sourceType"),
        ts_to_millis("ts").alias("ts"),
    )


# ---------------------------------------------------------------- app log JSON

def app_log(spark: SparkSession, sf_dir: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """The raw app-log topic: ``topic, partition, offset, timestamp, value``
    with one JSON document per event.

    error -> ``err`` + ``page``; view -> ``page`` + displays; click ->
    ``page`` + displays + actions; signup -> ``start`` only; purchase ->
    ``page`` + ``start``.  ``k`` of ``props`` drives the number of displays
    (k % 3) and actions (k % 2 + 1).  ``first`` and ``last`` keep a range of
    days (pushed to the scan).
    """
    e = events_with_nation(spark, sf_dir)
    return app_log_messages(e if first is None else e.where(day_range("ts", first, last)))


def app_log_messages(e: DataFrame) -> DataFrame:
    """The records of :func:`app_log` from rows of :func:`events_with_nation`."""
    e = e.withColumn("_k", F.get_json_object("props", "$.k").cast("long"))
    et, u = F.col("event_type"), F.col("user_id")
    k = F.col("_k")
    ms = ts_to_millis("ts")
    common = F.struct(
        F.col("c_nationkey").cast("string").alias("ar"),
        u.cast("string").alias("uid"),
        F.when(u % 2 == 0, "Android").otherwise("iOS").alias("os"),
        F.concat(F.lit("ch_"), (u % 5).cast("string")).alias("ch"),
        F.when(et == "signup", "1").otherwise("0").alias("is_new"),
        F.concat(F.lit("model_"), (u % 7).cast("string")).alias("md"),
        F.concat(F.lit("mid_"), u.cast("string")).alias("mid"),
        F.concat(F.lit("v"), (u % 3).cast("string")).alias("vc"),
        F.concat(F.lit("brand_"), (u % 6).cast("string")).alias("ba"),
    )
    has_page = et.isin("error", "view", "click", "purchase")
    page = F.when(has_page, F.struct(
        et.alias("page_id"),
        k.cast("string").alias("item"),
        F.floor(F.col("value") * 100).cast("long").alias("during_time"),
        F.lit("sku_id").alias("item_type"),
        F.when(et == "view", F.lit(None)).otherwise(F.lit("home")).cast("string").alias("last_page_id"),
        F.when(F.col("value") > 50, "promotion").otherwise("query").alias("source_type"),
    ))
    n_disp = k % 3
    displays = F.when(et.isin("view", "click") & (n_disp > 0), F.transform(
        F.sequence(F.lit(1).cast("long"), n_disp),
        lambda i: F.struct(
            F.when(i % 2 == 1, "query").otherwise("promotion").alias("display_type"),
            (k + i).cast("string").alias("item"),
            F.lit("sku_id").alias("item_type"),
            i.cast("string").alias("pos_id"),
            i.cast("string").alias("order"),
        )))
    actions = F.when(et == "click", F.transform(
        F.sequence(F.lit(1).cast("long"), k % 2 + 1),
        lambda i: F.struct(
            (k + 10 * i).cast("string").alias("item"),
            F.when(i == 1, "cart_add").otherwise("favor_add").alias("action_id"),
            F.lit("sku_id").alias("item_type"),
            (ms + i * 1000).alias("ts"),
        )))
    start = F.when(et.isin("signup", "purchase"), F.struct(
        F.lit("icon").alias("entry"),
        F.lit(0).cast("long").alias("open_ad_skip_ms"),
        (k * 10).alias("open_ad_ms"),
        F.floor(F.col("value") * 10).cast("long").alias("loading_time"),
        (k % 5).cast("string").alias("open_ad_id"),
    ))
    err = F.when(et == "error", F.struct(k.alias("error_code"), F.lit("error").alias("msg")))
    doc = F.struct(common.alias("common"), page.alias("page"), displays.alias("displays"),
                   actions.alias("actions"), start.alias("start"), err.alias("err"), ms.alias("ts"))
    return e.select(
        F.lit("ODS_BASE_LOG").alias("topic"),
        F.lit(0).alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.to_json(doc).alias("value"),
    )


# ---------------------------------------------------------------- change records

def change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The change-record topic: ``topic, partition, offset, timestamp, value`` where
    value is ``{"type":…, "table":…, "data":{"id":…, "value":…}}``."""
    e = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    env = F.struct(
        _lookup(EVENT_TO_CHANGE_TYPE, F.col("event_type")).alias("type"),
        F.when(F.col("user_id") % 2 == 0, CHANGE_TABLE_EVEN).otherwise(CHANGE_TABLE_ODD).alias("table"),
        F.struct(F.col("user_id").alias("id"), F.col("value").alias("value")).alias("data"),
    )
    return e.select(
        F.lit("ODS_BASE_DB").alias("topic"),
        F.lit(0).alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.to_json(env).alias("value"),
    )


# ---------------------------------------------------------------- order facts

def _orders(spark: SparkSession, sf_dir: str, first: str | None, last: str | None, *cols: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select(*cols)
    return o if first is None else o.where(day_range("o_orderdate", first, last))


def order_info(spark: SparkSession, sf_dir: str, day: str | None = None, last_day: str | None = None,
               with_province: bool = True) -> DataFrame:
    """Order facts as they arrive (14 fields); province = the buyer's nation.
    ``day`` (to ``last_day``) keeps the orders created then (pushed to the scan).
    ``with_province=False`` leaves ``province_id`` out, and with it the join."""
    o = _orders(spark, sf_dir, day, last_day, "o_orderkey", "o_custkey", "o_orderstatus",
                "o_totalprice", "o_orderdate")
    province = []
    if with_province:
        cust = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
        o = o.join(sized_side(cust), o.o_custkey == cust.c_custkey, "left")
        province = [F.col("c_nationkey").cast("long").alias("province_id")]
    zero = F.lit(0.0).cast("double")
    null_s = F.lit(None).cast("string")
    return o.select(
        F.col("o_orderkey").alias("id"),
        *province,
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_totalprice").alias("final_total_amount"),
        zero.alias("activity_reduce_amount"),
        zero.alias("coupon_reduce_amount"),
        F.col("o_totalprice").alias("original_total_amount"),
        zero.alias("feight_fee"),
        zero.alias("feight_fee_reduce"),
        null_s.alias("expire_time"),
        null_s.alias("refundable_time"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("create_time"),
        null_s.alias("operate_time"),
    )


def line_id() -> F.Column:
    """The id of an order line, from its own columns: 60 bits of the MD5 of their text.
    The data has no line id; a rank within the order would put an order's lines in one
    task.  Lines equal in all of these columns would share an id (none do here)."""
    cents = [F.round(F.col(c) * 100).cast("long").cast("string")
             for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")]
    text = F.concat_ws("|", *[F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")],
                       *cents, F.date_format("l_shipdate", "yyyy-MM-dd"), "l_returnflag", "l_linestatus")
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


def order_detail(spark: SparkSession, sf_dir: str, with_ship_time: bool = False,
                 day: str | None = None, with_create_time: bool = True, skus: DataFrame | None = None) -> DataFrame:
    """Order-line facts (10 fields).

    A line's ``create_time`` is its order's; ``with_create_time=False``
    leaves it out, and with it a join, for callers that join the orders
    anyway.  ``with_ship_time`` adds the line's ship date as ``ship_time``
    text (the event time of the time-bounded join).  ``day`` keeps the lines
    of the orders created that day, by a semi-join with their keys; ``skus``
    (one column) those of some products, before any other join.
    """
    li = table(spark, sf_dir, "lineitem")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_retailprice")
    if skus is not None:
        li = li.join(skus.toDF("_sku"), F.col("l_partkey") == F.col("_sku"), "left_semi")
    if day is not None:
        keys = _orders(spark, sf_dir, day, day, "o_orderkey", "o_orderdate").select("o_orderkey")
        li = li.join(keys, li.l_orderkey == keys.o_orderkey, "left_semi")
    # Only what a line needs is moved by the joins; of its other columns, the id.
    li = li.select(line_id().alias("id"), "l_orderkey", "l_partkey", F.col("l_quantity").cast("long").alias("sku_num"),
                   "l_extendedprice", *(["l_shipdate"] if with_ship_time else []))
    d = li.join(sized_side(part), li.l_partkey == part.p_partkey, "left")
    if with_create_time:
        orders = _orders(spark, sf_dir, day, day, "o_orderkey", "o_orderdate")
        d = d.join(orders, d.l_orderkey == orders.o_orderkey, "left")
    zero = F.lit(0.0).cast("double")
    cols = [
        F.col("id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("sku_id"),
        F.col("p_retailprice").alias("order_price"),
        F.col("sku_num"),
        F.col("p_name").alias("sku_name"),
        F.col("l_extendedprice").alias("split_total_amount"),
        zero.alias("split_activity_amount"),
        zero.alias("split_coupon_amount"),
    ]
    if with_create_time:
        cols.insert(6, F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("create_time"))
    if with_ship_time:
        cols.append(F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss").alias("ship_time"))
    return d.select(*cols)


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``sku_id, sku_name, category, tm, spu``: type, brand and name of each part."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("sku_id"), F.col("p_name").alias("sku_name"), F.col("p_type").alias("category"),
        F.col("p_brand").alias("tm"), F.col("p_name").alias("spu"))


# ---------------------------------------------------------------- demo documents

def movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Demo document index: one document per part, ``name`` = part name,
    ``doubanScore`` = size / 5.  The actors (the suppliers that shipped the
    part) are a field of their own in long form, :func:`movie_actors`: an
    array per movie would gather an unbounded group into one row."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("id"), F.col("p_name").alias("name"),
        (F.col("p_size") / 5.0).alias("doubanScore"))


def movie_actors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The demo index's actor field in long form: one ``movie_id, actor``
    row per movie and distinct actor name (null names kept, as in the
    array).  Built from distinct pairs (partial aggregates), never as one
    array per movie, so a movie with a huge cast is no single row."""
    pairs = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey").distinct()
    sup = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    return (pairs.join(sup, pairs.l_suppkey == sup.s_suppkey, "left")
                 .select(F.col("l_partkey").cast("string").alias("movie_id"),
                         F.col("s_name").alias("actor"))
                 .distinct())


def movie_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Demo title index ``id, movie_name`` (one document per part)."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("id"), F.col("p_name").alias("movie_name"))
