"""Orders: enrichment (D3, D4, I1, I4), the order/line join (D5-D8) and
the wide row (B11)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martflow import schemas
from martflow.functions.dates import text_day, text_hour
from martflow.operators import dims

# Province attributes of the order row (output name -> dimension column).
# ``province_3166_2_code`` is not filled (the original never sets it);
# ``fill_3166_2=True`` fills it.
ORDER_PROVINCE_COLUMNS = {
    "province_name": "name", "province_iso_code": "iso_code", "province_area_code": "area_code",
}

# Wide-row fields taken from the order line; ``create_time`` is among them,
# so the line's time wins over the order's while ``create_date`` and
# ``create_hour`` stay the order's (the original's copy order).
DETAIL_FIELDS = ["sku_id", "order_price", "sku_num", "sku_name", "split_total_amount",
                 "split_activity_amount", "split_coupon_amount", "create_time"]


def enrich_orders(orders: DataFrame, users: DataFrame, provinces: DataFrame,
                  as_of=None, fill_3166_2: bool = False, keep_extra: bool = False) -> DataFrame:
    """D3 + D4 + I1 + I4: the 22-field order row (``keep_extra`` keeps
    other input columns after them)."""
    extra = [c for c in orders.columns if c not in schemas.names(schemas.ORDER_INFO)] if keep_extra else []
    cols = dict(ORDER_PROVINCE_COLUMNS)
    if fill_3166_2:
        cols["province_3166_2_code"] = "iso_3166_2"
    o = dims.with_user(orders, users, "user_id", as_of=as_of, age_type="int", key_type="long")
    o = dims.with_province(o, provinces, "province_id", cols, key_type="long")
    o = (o.withColumn("create_date", text_day("create_time"))
          .withColumn("create_hour", text_hour("create_time")))
    if "province_3166_2_code" not in o.columns:
        o = o.withColumn("province_3166_2_code", F.lit(None).cast("string"))
    return o.select(*schemas.names(schemas.ORDER_INFO), *extra)


def wide_row(line_columns: list[str]) -> list:
    """The 30-field wide row from a joined order (alias ``o``) and line
    (``d``).  A line without a field of its own takes the order's."""
    out = []
    for f in schemas.ORDER_WIDE.fields:
        if f.name == "detail_id":
            out.append(F.col("d.id").alias("detail_id"))
        elif f.name == "order_id":
            out.append(F.col("o.id").alias("order_id"))
        elif f.name in DETAIL_FIELDS and f.name in line_columns:
            out.append(F.col(f"d.{f.name}").alias(f.name))
        else:
            out.append(F.col(f"o.{f.name}").alias(f.name))
    return out


def order_wide(orders: DataFrame, details: DataFrame) -> DataFrame:
    """D8 (batch): inner equi-join of enriched orders and their lines.

    Orders without lines and lines without orders give no row.  Both sides
    are shuffled on the order key once; a hot order key is split by AQE's
    skew-join handling (the order side of a key is a single row).
    """
    o, d = orders.alias("o"), details.alias("d")
    return o.join(d, F.col("o.id") == F.col("d.order_id"), "inner").select(*wide_row(details.columns))


def order_wide_within(orders: DataFrame, details: DataFrame, order_time: str,
                      detail_time: str, bound: str = "24 hours") -> DataFrame:
    """D8 with the time bound of the streaming join: a line pairs with its
    order only when its event time lies within ``bound`` of the order's.

    The equi-key keeps this a shuffle (or stream-stream state) join; the
    range is a post-join condition on the same key, never a cross product.
    """
    o, d = orders.alias("o"), details.alias("d")
    ot, dt = F.col(f"o.{order_time}"), F.col(f"d.{detail_time}")
    cond = ((F.col("o.id") == F.col("d.order_id"))
            & (dt >= ot - F.expr(f"INTERVAL {bound}"))
            & (dt <= ot + F.expr(f"INTERVAL {bound}")))
    return o.join(d, cond, "inner").select(*wide_row(details.columns))


DETAIL_PREFIX = "d_"


def wide_from_pairs(pairs: DataFrame) -> DataFrame:
    """B11 for rows holding an enriched order and its line, the line's
    fields prefixed ``d_`` (the stream join's output)."""
    out = []
    for f in schemas.ORDER_WIDE.fields:
        if f.name == "detail_id":
            out.append(F.col(DETAIL_PREFIX + "id").alias("detail_id"))
        elif f.name == "order_id":
            out.append(F.col("id").alias("order_id"))
        elif f.name in DETAIL_FIELDS:
            out.append(F.col(DETAIL_PREFIX + f.name).alias(f.name))
        else:
            out.append(F.col(f.name))
    return pairs.select(*out)
