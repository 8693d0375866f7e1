"""Record layouts of the commerce pipeline.

Column order is part of the contract: the log outputs, the daily-active
table and the wide order rows keep the field order of the original beans.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, L, D, I = T.StringType(), T.LongType(), T.DoubleType(), T.IntegerType()


def _struct(*fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# Device fields shared by all log outputs, in output order, with the raw
# log key each one comes from.
COMMON_FIELDS = [
    ("mid", "mid"), ("user_id", "uid"), ("province_id", "ar"), ("channel", "ch"),
    ("is_new", "is_new"), ("model", "md"), ("operate_system", "os"),
    ("version_code", "vc"), ("brand", "ba"),
]
COMMON_COLUMNS = [name for name, _ in COMMON_FIELDS]

# Raw app log: one JSON document per record.  Numbers are read as text and
# cast when the rows are made, so a number in quotes counts like the number;
# text that is no number gives null.  ``err`` is kept as its JSON text.
LOG_SCHEMA = _struct(
    ("common", _struct(("ar", S), ("uid", S), ("os", S), ("ch", S), ("is_new", S),
                       ("md", S), ("mid", S), ("vc", S), ("ba", S))),
    ("page", _struct(("page_id", S), ("item", S), ("during_time", S), ("item_type", S),
                     ("last_page_id", S), ("source_type", S))),
    ("displays", T.ArrayType(_struct(("display_type", S), ("item", S), ("item_type", S),
                                     ("pos_id", S), ("order", S)))),
    ("actions", T.ArrayType(_struct(("item", S), ("action_id", S), ("item_type", S),
                                    ("ts", S)))),
    ("start", _struct(("entry", S), ("open_ad_skip_ms", S), ("open_ad_ms", S),
                      ("loading_time", S), ("open_ad_id", S))),
    ("err", S),
    ("ts", S),
    # Filled with the record's text when it is not a JSON object of this shape.
    ("_corrupt_record", S),
)

PAGE_COLUMNS = ["page_id", "last_page_id", "page_item", "page_item_type", "during_time", "sourceType"]

PAGE_LOG = _struct(*[(c, S) for c in COMMON_COLUMNS],
                   ("page_id", S), ("last_page_id", S), ("page_item", S), ("page_item_type", S),
                   ("during_time", L), ("sourceType", S), ("ts", L))

PAGE_DISPLAY = _struct(*[(c, S) for c in COMMON_COLUMNS],
                       ("page_id", S), ("last_page_id", S), ("page_item", S), ("page_item_type", S),
                       ("during_time", L), ("sourceType", S), ("display_type", S),
                       ("display_item", S), ("display_item_type", S), ("display_order", S),
                       ("display_pos_id", S), ("ts", L))

PAGE_ACTION = _struct(*[(c, S) for c in COMMON_COLUMNS],
                      ("page_id", S), ("last_page_id", S), ("page_item", S), ("page_item_type", S),
                      ("during_time", L), ("sourceType", S), ("action_id", S), ("action_item", S),
                      ("action_item_type", S), ("ts", L))

START_LOG = _struct(*[(c, S) for c in COMMON_COLUMNS],
                    ("entry", S), ("open_ad_id", S), ("loading_time_ms", L), ("open_ad_ms", L),
                    ("open_ad_skip_ms", L), ("ts", L))

DAU_INFO = _struct(*[(c, S) for c in COMMON_COLUMNS],
                   ("page_id", S), ("page_item", S), ("page_item_type", S), ("sourceType", S),
                   ("during_time", L), ("user_gender", S), ("user_age", S), ("province_name", S),
                   ("province_iso_code", S), ("province_3166_2", S), ("province_area_code", S),
                   ("dt", S), ("hr", S), ("ts", L))

# order_info as it arrives on the fact topic (first 14 fields) and after
# enrichment (all 22).
ORDER_INFO_RAW = _struct(
    ("id", L), ("province_id", L), ("order_status", S), ("user_id", L),
    ("final_total_amount", D), ("activity_reduce_amount", D), ("coupon_reduce_amount", D),
    ("original_total_amount", D), ("feight_fee", D), ("feight_fee_reduce", D),
    ("expire_time", S), ("refundable_time", S), ("create_time", S), ("operate_time", S))

ORDER_INFO = _struct(
    *[(f.name, f.dataType) for f in ORDER_INFO_RAW.fields],
    ("create_date", S), ("create_hour", S), ("province_name", S), ("province_area_code", S),
    ("province_3166_2_code", S), ("province_iso_code", S), ("user_age", I), ("user_gender", S))

ORDER_DETAIL = _struct(
    ("id", L), ("order_id", L), ("sku_id", L), ("order_price", D), ("sku_num", L),
    ("sku_name", S), ("create_time", S), ("split_total_amount", D),
    ("split_activity_amount", D), ("split_coupon_amount", D))

ORDER_WIDE = _struct(
    ("detail_id", L), ("order_id", L), ("sku_id", L), ("order_price", D), ("sku_num", L),
    ("sku_name", S), ("split_total_amount", D), ("split_activity_amount", D),
    ("split_coupon_amount", D), ("province_id", L), ("order_status", S), ("user_id", L),
    ("final_total_amount", D), ("activity_reduce_amount", D), ("coupon_reduce_amount", D),
    ("original_total_amount", D), ("feight_fee", D), ("feight_fee_reduce", D),
    ("expire_time", S), ("refundable_time", S), ("create_time", S), ("operate_time", S),
    ("create_date", S), ("create_hour", S), ("province_name", S), ("province_area_code", S),
    ("province_3166_2_code", S), ("province_iso_code", S), ("user_age", I), ("user_gender", S))

# Change-data-capture envelope; ``data`` stays raw JSON text and is typed
# per table downstream.
CDC_ENVELOPE = _struct(("type", S), ("table", S))

# Source frames that stand for a topic carry these columns.
TOPIC_COLUMNS = ["topic", "partition", "offset", "timestamp", "value"]

# Demo document index.
MOVIE = _struct(("id", S), ("name", S), ("doubanScore", D),
                ("actorList", T.ArrayType(_struct(("id", I), ("name", S)))))


def names(schema: T.StructType) -> list[str]:
    return [f.name for f in schema.fields]
