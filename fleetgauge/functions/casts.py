"""Casts that give NULL instead of an error and accept every spelling of a number."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Java reads "5d" and "5f" as numbers; feed files do not mean that.
_DECIMAL_TEXT = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def _whole_number(df: DataFrame, name: str, target: str) -> Column:
    value = F.col(name)
    source = df.schema[name].dataType
    if isinstance(source, (T.FloatType, T.DoubleType)):
        return F.bround(value).try_cast(target)
    if isinstance(source, T.StringType):
        # Plain digits are the common case; only "1.5" or "1e3" reach the second branch.
        decimal = F.when(value.rlike(_DECIMAL_TEXT), F.round(value.try_cast("double")))
        return F.coalesce(value.try_cast(target), decimal.try_cast(target))
    return value.try_cast(target)


def lenient_int(df: DataFrame, name: str) -> Column:
    return _whole_number(df, name, "int")


def lenient_long(df: DataFrame, name: str) -> Column:
    return _whole_number(df, name, "bigint")


def lenient_double(df: DataFrame, name: str) -> Column:
    value = F.col(name)
    if isinstance(df.schema[name].dataType, T.StringType):
        return F.when(value.rlike(_DECIMAL_TEXT), value.try_cast("double"))
    return value.try_cast("double")


def number_from_json(text: Column, target: str) -> Column:
    """Whole number from a JSON field read as text; JSON floats are rounded half to even."""
    return F.coalesce(text.try_cast(target), F.bround(text.try_cast("double")).try_cast(target))
