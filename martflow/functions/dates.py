"""Date and time expressions (all JVM-side, codegen friendly)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_of_date(as_of: str | _dt.date | None) -> Column:
    """Reference date for ages; ``None`` means today in the session zone."""
    if as_of is None:
        return F.current_date()
    return F.lit(str(as_of)).cast("date")


def age_years(birthday, as_of: str | _dt.date | None = None) -> Column:
    """Whole years between ``birthday`` and ``as_of``, like ``Period.getYears``.

    Calendar arithmetic, not ``months_between``: 2000-02-29 to 2021-02-28
    is 20 years.  A birthday after ``as_of`` gives a negative count that is
    truncated toward zero, as a negative ``Period`` does.  An unparsable
    birthday gives null.
    """
    b = F.try_to_date(_col(birthday).cast("string"), "yyyy-MM-dd") \
        if not isinstance(birthday, Column) else F.try_to_date(birthday.cast("string"), "yyyy-MM-dd")
    d = as_of_date(as_of)

    def whole_years(lo, hi):
        return (F.year(hi) - F.year(lo)
                - F.when(F.date_format(hi, "MMdd") < F.date_format(lo, "MMdd"), 1).otherwise(0))

    return F.when(b <= d, whole_years(b, d)).otherwise(-whole_years(d, b)).cast("int")


def millis_to_ts(ms) -> Column:
    return F.timestamp_millis(_col(ms))


def ts_to_millis(ts) -> Column:
    """Event timestamp (with or without zone) to epoch millis in the session zone."""
    return F.unix_millis(_col(ts).cast("timestamp"))


def day_of_millis(ms) -> Column:
    """Epoch millis to ``yyyy-MM-dd`` in the session zone."""
    return F.date_format(millis_to_ts(ms), "yyyy-MM-dd")


def hour_of_millis(ms) -> Column:
    """Epoch millis to two-digit hour ``HH``."""
    return F.date_format(millis_to_ts(ms), "HH")


def text_day(datetime_text) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` text to its day part; '' becomes null (I4)."""
    part = F.split_part(_col(datetime_text), F.lit(" "), F.lit(1))
    return F.when(part == "", None).otherwise(part)


def text_hour(datetime_text) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` text to its hour part; '' becomes null (I4)."""
    time_part = F.split_part(_col(datetime_text), F.lit(" "), F.lit(2))
    part = F.split_part(time_part, F.lit(":"), F.lit(1))
    return F.when(part == "", None).otherwise(part)


def previous_day(day: str) -> str:
    """I6 on a parameter (a query argument, not a column)."""
    return str(_dt.date.fromisoformat(day) - _dt.timedelta(days=1))
