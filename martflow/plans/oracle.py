"""DuckDB SQL for every registered query (the correctness oracle).

The derived views (page log, dimensions, order facts, documents) are
written once here as SQL with the same rules as ``martflow.sources.tables``
and composed into self-contained statements with ``WITH``.  The base
tables are the driver's pre-registered views.
"""

from __future__ import annotations

AS_OF = "2024-01-31"

VIEWS: dict[str, str] = {}
DEPS: dict[str, list[str]] = {}


def view(name: str, sql: str, deps: list[str] | None = None) -> None:
    VIEWS[name] = sql.strip()
    DEPS[name] = deps or []


def _order(names: list[str]) -> list[str]:
    out: list[str] = []

    def visit(n):
        for d in DEPS[n]:
            visit(d)
        if n not in out:
            out.append(n)
    for n in names:
        visit(n)
    return out


def with_views(names: list[str], body: str) -> str:
    """Prefix ``body`` with the views it needs; a body starting with ``,``
    adds CTEs of its own after them."""
    ctes = ",\n".join(f"{n} AS (\n{VIEWS[n]}\n)" for n in _order(names))
    return f"WITH {ctes}\n{body.strip()}"


def age_sql(birthday_text: str, as_of: str = AS_OF) -> str:
    b = f"CAST({birthday_text} AS DATE)"
    d = f"DATE '{as_of}'"
    return (f"CAST(CASE WHEN {b} <= {d} THEN year({d}) - year({b}) - "
            f"CASE WHEN strftime({d}, '%m%d') < strftime({b}, '%m%d') THEN 1 ELSE 0 END "
            f"ELSE -(year({b}) - year({d}) - CASE WHEN strftime({b}, '%m%d') < strftime({d}, '%m%d') "
            f"THEN 1 ELSE 0 END) END AS INTEGER)")


def tokens_sql(col: str) -> str:
    return f"regexp_extract_all(lower({col}), '[a-z0-9]+')"


def all_terms_sql(col: str, words: list[str]) -> str:
    arr = ", ".join(f"'{w}'" for w in words)
    return f"list_has_all({tokens_sql(col)}, [{arr}])"


def any_term_sql(col: str, words: list[str]) -> str:
    arr = ", ".join(f"'{w}'" for w in words)
    return f"list_has_any({tokens_sql(col)}, [{arr}])"


def highlight_sql(col: str, words: list[str]) -> str:
    alt = "|".join(words)
    return f"regexp_replace({col}, '(?i)\\b({alt})\\b', '<em>\\1</em>', 'g')"


def money_sum_sql(col: str) -> str:
    return f"CAST(SUM(CAST({col} AS DECIMAL(18,2))) AS DOUBLE)"


# ---------------------------------------------------------------- dimensions

view("user_info", """
SELECT c_custkey AS id,
       CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
       strftime(DATE '1950-01-01' + CAST((c_custkey * 7919) % 25000 AS INTEGER), '%Y-%m-%d') AS birthday
FROM customer""")

view("base_province", """
SELECT CAST(n_nationkey AS BIGINT) AS id, n_name AS name,
       'ISO-' || CAST(n_nationkey AS VARCHAR) AS iso_code,
       'AREA-' || lpad(CAST(n_nationkey AS VARCHAR), 3, '0') AS area_code,
       'CN-' || CAST(n_nationkey AS VARCHAR) AS iso_3166_2
FROM nation""")

# ---------------------------------------------------------------- page log

view("page_log", """
SELECT 'mid_' || CAST(e.user_id AS VARCHAR) AS mid,
       CAST(e.user_id AS VARCHAR) AS user_id,
       CAST(c.c_nationkey AS VARCHAR) AS province_id,
       'ch_' || CAST(e.user_id % 5 AS VARCHAR) AS channel,
       CASE WHEN e.event_type = 'signup' THEN '1' ELSE '0' END AS is_new,
       'model_' || CAST(e.user_id % 7 AS VARCHAR) AS model,
       CASE WHEN e.user_id % 2 = 0 THEN 'Android' ELSE 'iOS' END AS operate_system,
       'v' || CAST(e.user_id % 3 AS VARCHAR) AS version_code,
       'brand_' || CAST(e.user_id % 6 AS VARCHAR) AS brand,
       e.event_type AS page_id,
       CASE WHEN e.event_type = 'view' THEN NULL ELSE 'home' END AS last_page_id,
       json_extract_string(e.props, '$.k') AS page_item,
       'sku_id' AS page_item_type,
       CAST(FLOOR(e.value * 100) AS BIGINT) AS during_time,
       CASE WHEN e.value > 50 THEN 'promotion' ELSE 'query' END AS sourceType,
       CAST(epoch_us(e.ts) // 1000 AS BIGINT) AS ts
FROM events e LEFT JOIN customer c ON e.user_id = c.c_custkey""")

_PAGE_REST = ("user_id, province_id, channel, is_new, model, operate_system, version_code, brand, "
              "page_id, last_page_id, page_item, page_item_type, during_time, sourceType")

view("dau_first", f"""
SELECT * FROM (
  SELECT p.*, strftime(epoch_ms(p.ts), '%Y-%m-%d') AS dt,
         row_number() OVER (PARTITION BY p.mid, strftime(epoch_ms(p.ts), '%Y-%m-%d')
                            ORDER BY {', '.join(f'p.{c} ASC NULLS FIRST' for c in ['ts'] + _PAGE_REST.split(', '))}) AS rn
  FROM page_log p WHERE p.last_page_id IS NULL) t
WHERE rn = 1""", ["page_log"])

view("dau", f"""
SELECT f.mid, f.user_id, f.province_id, f.channel, f.is_new, f.model, f.operate_system,
       f.version_code, f.brand, f.page_id, f.page_item, f.page_item_type, f.sourceType,
       f.during_time, u.gender AS user_gender, CAST({age_sql('u.birthday')} AS VARCHAR) AS user_age,
       bp.name AS province_name, bp.iso_code AS province_iso_code,
       bp.iso_3166_2 AS province_3166_2, bp.area_code AS province_area_code,
       f.dt, strftime(epoch_ms(f.ts), '%H') AS hr, f.ts
FROM dau_first f
LEFT JOIN user_info u ON CAST(f.user_id AS BIGINT) = u.id
LEFT JOIN base_province bp ON CAST(f.province_id AS BIGINT) = bp.id""",
     ["dau_first", "user_info", "base_province"])

# ---------------------------------------------------------------- orders

view("order_info", """
SELECT o.o_orderkey AS id, CAST(c.c_nationkey AS BIGINT) AS province_id,
       o.o_orderstatus AS order_status, o.o_custkey AS user_id,
       o.o_totalprice AS final_total_amount, CAST(0.0 AS DOUBLE) AS activity_reduce_amount,
       CAST(0.0 AS DOUBLE) AS coupon_reduce_amount, o.o_totalprice AS original_total_amount,
       CAST(0.0 AS DOUBLE) AS feight_fee, CAST(0.0 AS DOUBLE) AS feight_fee_reduce,
       CAST(NULL AS VARCHAR) AS expire_time, CAST(NULL AS VARCHAR) AS refundable_time,
       strftime(o.o_orderdate, '%Y-%m-%d %H:%M:%S') AS create_time,
       CAST(NULL AS VARCHAR) AS operate_time
FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey""")

view("order_enriched", f"""
SELECT o.*,
       NULLIF(split_part(o.create_time, ' ', 1), '') AS create_date,
       NULLIF(split_part(split_part(o.create_time, ' ', 2), ':', 1), '') AS create_hour,
       bp.name AS province_name, bp.area_code AS province_area_code,
       CAST(NULL AS VARCHAR) AS province_3166_2_code, bp.iso_code AS province_iso_code,
       {age_sql('u.birthday')} AS user_age, u.gender AS user_gender
FROM order_info o
LEFT JOIN user_info u ON o.user_id = u.id
LEFT JOIN base_province bp ON o.province_id = bp.id""", ["order_info", "user_info", "base_province"])

_CENTS = ", ".join(f"CAST(round({c} * 100) AS BIGINT)" for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax"))
_LINE_ID = ("CAST('0x' || substr(md5(concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey, "
            f"{_CENTS}, strftime(l_shipdate, '%Y-%m-%d'), l_returnflag, l_linestatus)), 1, 15) AS BIGINT)")

view("order_detail", f"""
SELECT {_LINE_ID} AS id,
       l.l_orderkey AS order_id, l.l_partkey AS sku_id, p.p_retailprice AS order_price,
       CAST(l.l_quantity AS BIGINT) AS sku_num, p.p_name AS sku_name,
       strftime(o.o_orderdate, '%Y-%m-%d %H:%M:%S') AS create_time,
       l.l_extendedprice AS split_total_amount, CAST(0.0 AS DOUBLE) AS split_activity_amount,
       CAST(0.0 AS DOUBLE) AS split_coupon_amount,
       strftime(l.l_shipdate, '%Y-%m-%d %H:%M:%S') AS ship_time
FROM lineitem l
LEFT JOIN part p ON l.l_partkey = p.p_partkey
LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey""")

_WIDE = """
d.id AS detail_id, o.id AS order_id, d.sku_id, d.order_price, d.sku_num, d.sku_name,
d.split_total_amount, d.split_activity_amount, d.split_coupon_amount, o.province_id,
o.order_status, o.user_id, o.final_total_amount, o.activity_reduce_amount,
o.coupon_reduce_amount, o.original_total_amount, o.feight_fee, o.feight_fee_reduce,
o.expire_time, o.refundable_time, d.create_time, o.operate_time, o.create_date, o.create_hour,
o.province_name, o.province_area_code, o.province_3166_2_code, o.province_iso_code,
o.user_age, o.user_gender"""

WIDE_COLUMNS = [c.strip().split(" AS ")[-1].split(".")[-1] for c in _WIDE.split(",")]

view("order_wide", f"""
SELECT {_WIDE}
FROM order_enriched o JOIN order_detail d ON o.id = d.order_id""", ["order_enriched", "order_detail"])

# ---------------------------------------------------------------- demo documents

view("movies", """
SELECT CAST(p.p_partkey AS VARCHAR) AS id, p.p_name AS name, p.p_size / 5.0 AS doubanScore
FROM part p""")

view("movie_actors", """
SELECT DISTINCT CAST(l.l_partkey AS VARCHAR) AS movie_id, s.s_name AS actor
FROM lineitem l LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey""")

view("movie_titles", """
SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS movie_name FROM part""")
