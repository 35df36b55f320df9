"""Null rules. Missing is always null, never NaN."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def add_missing_as_zero(*cols: Column) -> Column:
    """Sum in which a null counts as 0, unless every operand is null."""
    zero = F.lit(0)
    total = reduce(lambda a, b: a + b, [F.coalesce(c, zero) for c in cols])
    return F.when(F.coalesce(*cols).isNotNull(), total)


def not_in(col: Column, values) -> Column:
    """NOT IN that holds for null."""
    return ~F.coalesce(col.isin(list(values)), F.lit(False))


def total(col: Column) -> Column:
    """Sum that is 0 when every value is null."""
    return F.coalesce(F.sum(col), F.lit(0))


def count_or_null(condition: Column) -> Column:
    """Rows that meet the condition; null when there is none."""
    return F.nullif(F.count_if(condition), F.lit(0))


def nan_to_null(df: DataFrame) -> DataFrame:
    """Replace NaN by null in every floating column (after pandas or an ML model)."""
    floats = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.nanvl(F.col(c), F.lit(None).cast("double")) for c in floats})


def fill(df: DataFrame, value, columns=None) -> DataFrame:
    """Fill nulls by a constant, in all columns of the value's type or in those named."""
    return df.fillna(value, subset=list(columns) if columns else None)


def drop_incomplete(df: DataFrame, columns) -> DataFrame:
    """Keep rows with a value in every named column."""
    return df.dropna(subset=list(columns))
