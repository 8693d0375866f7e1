"""Column-level reshaping helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def copy_matching(src: DataFrame, dest: T.StructType, extra: list[str] | None = None) -> DataFrame:
    """Keep the columns of ``src`` whose name and type also appear in
    ``dest`` (resolved at plan time), plus ``extra`` columns.  Fields of
    ``src`` unknown to ``dest`` are dropped."""
    src_types = {f.name: f.dataType for f in src.schema.fields}
    keep = [f.name for f in dest.fields if src_types.get(f.name) == f.dataType]
    keep += [c for c in (extra or []) if c in src_types and c not in keep]
    return src.select(*keep)


def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename result fields."""
    for old, new in mapping.items():
        df = df.withColumnRenamed(old, new)
    return df
