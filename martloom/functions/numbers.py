"""Numeric cells."""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql.types import DataType, NumericType


def bool_to_int(col: Column) -> Column:
    """False and True as 0 and 1."""
    return col.cast("int")


def nan_to_null(col: Column) -> Column:
    """NULL for NaN."""
    return F.when(~F.isnan(col), col)


def zero_if_null(col: Column) -> Column:
    """0 for NULL."""
    return F.coalesce(col, F.lit(0))


def has_leading_zero(col: Column) -> Column:
    """True for text that starts with 0 and goes on, ``0.5`` included."""
    return col.startswith("0") & (F.length(col) > 1)


def is_number(col: Column) -> Column:
    """True for text that reads as a decimal number, exponent allowed."""
    return col.rlike(r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$")


def retyped(col: Column, dtype: DataType) -> Column:
    """The type a new stored column gets: double for numbers, text for the rest."""
    return col.cast("double") if isinstance(dtype, NumericType) else col.cast("string")
