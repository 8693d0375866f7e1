"""Parameter mapping and result labels of the dashboard queries."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Dashboard parameter -> result column.
STAT_FIELDS = {"age": "user_age", "gender": "user_gender"}

# Gender codes and their labels (I8); other codes pass as is.
GENDER_LABELS = {"F": "女", "M": "男"}

# Age bucket labels, in output order (E4): under 20,
# 20 to 29, 30 and over.
AGE_BUCKET_LABELS = ["20岁以下", "20岁到29", "30岁以上"]


def stat_field(t: str) -> str:
    """``age`` / ``gender`` to the column grouped on."""
    try:
        return STAT_FIELDS[t]
    except KeyError:
        raise ValueError(f"unknown statistic type {t!r}; expected one of {sorted(STAT_FIELDS)}")


def gender_label(c) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    expr = None
    for code, label in GENDER_LABELS.items():
        expr = (F.when(col == code, label) if expr is None else expr.when(col == code, label))
    return expr.otherwise(col)


def age_bucket(age) -> Column:
    """E4 bucket index 0, 1, 2 for ages <20, 20-29, >=30; null stays null."""
    col = F.col(age) if isinstance(age, str) else age
    return F.when(col < 20, 0).when(col < 30, 1).when(col >= 30, 2)


def to_number(c) -> Column:
    """Text to double; bad text gives null instead of an ANSI error."""
    return (F.col(c) if isinstance(c, str) else c).try_cast("double")


def money_sum(c) -> Column:
    """Sum of money as decimal(18,2) so the result does not depend on the
    order of addition; returned as double."""
    col = F.col(c) if isinstance(c, str) else c
    return F.sum(col.cast("decimal(18,2)")).cast("double")
