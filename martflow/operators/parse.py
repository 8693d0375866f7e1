"""App-log parsing and routing.

A raw record is parsed once with an explicit schema.  Error records are
passed through as their original text; the others are projected into page,
display, action and start rows.  :func:`route_log` produces all five
outputs from one scan as one ``(topic, value)`` frame, so a single
streaming query (or batch job) serves every topic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martflow import schemas

# Output topic names.
PAGE_TOPIC = "DWD_PAGE_LOG_TOPIC"
ERROR_TOPIC = "DWD_ERROR_LOG_TOPIC"
START_TOPIC = "DWD_START_LOG_TOPIC"
DISPLAY_TOPIC = "DWD_PAGE_DISPLAY_TOPIC"
ACTION_TOPIC = "DWD_PAGE_ACTION_TOPIC"


def parse_log(raw: DataFrame, value_col: str = "value") -> DataFrame:
    """B1: add the parsed document as struct ``log``; keeps all input
    columns (the raw text is needed for error pass-through)."""
    return raw.withColumn("log", F.from_json(F.col(value_col), schemas.LOG_SCHEMA,
                                             {"mode": "PERMISSIVE",
                                              "columnNameOfCorruptRecord": "_corrupt_record"}))


def is_bad() -> Column:
    """Text that is not a JSON object of the log's shape (malformed JSON,
    an array, text where a section belongs)."""
    return F.col("log._corrupt_record").isNotNull()


def bad_records(parsed: DataFrame, value_col: str = "value") -> DataFrame:
    """Records whose text is not a JSON object (the original fails the task)."""
    keep = [c for c in parsed.columns if c != "log"]
    bad = F.col(value_col).isNotNull() & is_bad()
    return _rows(parsed, F.when(bad, F.array(F.struct(*[F.col(c) for c in keep]))))


def is_error() -> Column:
    """An ``err`` is present, an object or any other value (``{}`` and
    text count; JSON null does not)."""
    return F.col("log.err").isNotNull() & ~is_bad()


def error_records(parsed: DataFrame, value_col: str = "value") -> DataFrame:
    """C1 + B9: error records, forwarded as their original text."""
    return parsed.select(F.explode(F.when(is_error(), F.array(F.col(value_col)))).alias("value"))


def is_normal() -> Column:
    return F.col("log").isNotNull() & ~is_bad() & F.col("log.err").isNull()


# ---------------------------------------------------------------- expressions

def common_exprs() -> list[Column]:
    """Lift and rename the device fields."""
    return [F.col(f"log.common.{src}").alias(dst) for dst, src in schemas.COMMON_FIELDS]


def page_exprs(item: Column | None = None, item_type: Column | None = None) -> list[Column]:
    """The six page columns; ``item``/``item_type`` override the page's own
    (the original's display/action rows carry the element's values)."""
    p = "log.page"
    return [
        F.col(f"{p}.page_id").alias("page_id"),
        F.col(f"{p}.last_page_id").alias("last_page_id"),
        (item if item is not None else F.col(f"{p}.item")).alias("page_item"),
        (item_type if item_type is not None else F.col(f"{p}.item_type")).alias("page_item_type"),
        F.col(f"{p}.during_time").try_cast("long").alias("during_time"),
        F.col(f"{p}.source_type").alias("sourceType"),
    ]


def display_exprs(d: Column, strict_reference: bool = False) -> list[Column]:
    """B5 row for display element ``d``; ``ts`` is the record's."""
    page = page_exprs(d["item"], d["item_type"]) if strict_reference else page_exprs()
    return [*common_exprs(), *page,
            d["display_type"].alias("display_type"), d["item"].alias("display_item"),
            d["item_type"].alias("display_item_type"), d["order"].alias("display_order"),
            d["pos_id"].alias("display_pos_id"), F.col("log.ts").try_cast("long").alias("ts")]


def action_exprs(a: Column, strict_reference: bool = False) -> list[Column]:
    """B6 row for action element ``a``; ``ts`` is the action's."""
    page = page_exprs(a["item"], a["item_type"]) if strict_reference else page_exprs()
    return [*common_exprs(), *page,
            a["action_id"].alias("action_id"), a["item"].alias("action_item"),
            a["item_type"].alias("action_item_type"), a["ts"].try_cast("long").alias("ts")]


def page_row_exprs() -> list[Column]:
    return [*common_exprs(), *page_exprs(), F.col("log.ts").try_cast("long").alias("ts")]


def start_row_exprs() -> list[Column]:
    s = "log.start"
    return [*common_exprs(),
            F.col(f"{s}.entry").alias("entry"), F.col(f"{s}.open_ad_id").alias("open_ad_id"),
            F.col(f"{s}.loading_time").try_cast("long").alias("loading_time_ms"),
            F.col(f"{s}.open_ad_ms").try_cast("long").alias("open_ad_ms"),
            F.col(f"{s}.open_ad_skip_ms").try_cast("long").alias("open_ad_skip_ms"),
            F.col("log.ts").try_cast("long").alias("ts")]


# ---------------------------------------------------------------- typed outputs
#
# Each output is one projection whose rows come out of an ``explode`` of a
# zero-or-one (or n) element array.  A plain ``where`` on the parsed struct
# would be pushed below the parse by the optimizer with ``from_json``
# inlined into every predicate - one JSON parse per condition.  Behind the
# generator the document is parsed once per record.

def _rows(parsed: DataFrame, rows: Column) -> DataFrame:
    return parsed.select(F.explode(rows).alias("_r")).select("_r.*")


def _when_normal(cond: Column, value: Column) -> Column:
    return F.when(is_normal() & cond, value)


def page_rows(parsed: DataFrame) -> DataFrame:
    """B4 (+C2): one page row per record with a ``page`` section."""
    return _rows(parsed, _when_normal(F.col("log.page").isNotNull(),
                                      F.array(F.struct(*page_row_exprs()))))


def display_rows(parsed: DataFrame, strict_reference: bool = False) -> DataFrame:
    """B5 (+C3): one row per display of a page record."""
    return _rows(parsed, _when_normal(F.col("log.page").isNotNull(), F.transform(
        "log.displays", lambda d: F.struct(*display_exprs(d, strict_reference)))))


def action_rows(parsed: DataFrame, strict_reference: bool = False) -> DataFrame:
    """B6 (+C3): one row per action of a page record."""
    return _rows(parsed, _when_normal(F.col("log.page").isNotNull(), F.transform(
        "log.actions", lambda a: F.struct(*action_exprs(a, strict_reference)))))


def start_rows(parsed: DataFrame) -> DataFrame:
    """B7 (+C2): one start row per record with a ``start`` section."""
    return _rows(parsed, _when_normal(F.col("log.start").isNotNull(),
                                      F.array(F.struct(*start_row_exprs()))))


# ---------------------------------------------------------------- one-pass routing

def route_log(parsed: DataFrame, value_col: str = "value", strict_reference: bool = False,
              keep: list[str] | None = None) -> DataFrame:
    """A9 + B8: every output message of every record as ``topic, value``
    (JSON text, null fields left out) from one pass over the input.

    Per record an array of (topic, value) pairs is built - the raw text for
    an error record, else the page row, one row per display and action, and
    the start row - and exploded.  ``keep`` carries input columns (offsets)
    along.
    """
    def msg(topic: str, row: list[Column]) -> Column:
        return F.struct(F.lit(topic).alias("topic"), F.to_json(F.struct(*row)).alias("value"))

    one = lambda c: F.array(c)
    empty = F.array().cast("array<struct<topic:string,value:string>>")
    has_page = F.col("log.page").isNotNull()
    page_part = F.when(has_page, one(msg(PAGE_TOPIC, page_row_exprs()))).otherwise(empty)
    disp_part = F.when(has_page & F.col("log.displays").isNotNull(), F.transform(
        "log.displays", lambda d: msg(DISPLAY_TOPIC, display_exprs(d, strict_reference)))).otherwise(empty)
    act_part = F.when(has_page & F.col("log.actions").isNotNull(), F.transform(
        "log.actions", lambda a: msg(ACTION_TOPIC, action_exprs(a, strict_reference)))).otherwise(empty)
    start_part = F.when(F.col("log.start").isNotNull(),
                        one(msg(START_TOPIC, start_row_exprs()))).otherwise(empty)
    err_part = one(F.struct(F.lit(ERROR_TOPIC).alias("topic"), F.col(value_col).alias("value")))
    messages = (F.when(F.col("log").isNull() | is_bad(), empty)
                 .when(is_error(), err_part)
                 .otherwise(F.concat(page_part, disp_part, act_part, start_part)))
    out = parsed.select(*(keep or []), F.explode(messages).alias("_m"))
    return out.select(*(keep or []), F.col("_m.topic").alias("topic"), F.col("_m.value").alias("value"))


# Typed schema of each routed topic (to read a topic back as rows).
TOPIC_SCHEMAS = {
    PAGE_TOPIC: schemas.PAGE_LOG, DISPLAY_TOPIC: schemas.PAGE_DISPLAY,
    ACTION_TOPIC: schemas.PAGE_ACTION, START_TOPIC: schemas.START_LOG,
}


def read_topic_rows(messages: DataFrame, topic: str) -> DataFrame:
    """B2: the messages of one routed topic parsed back into typed rows."""
    schema = TOPIC_SCHEMAS[topic]
    return (messages.where(F.col("topic") == topic)
            .select(F.from_json("value", schema).alias("r")).select("r.*"))
