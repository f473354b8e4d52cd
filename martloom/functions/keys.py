"""Record ids that arrive as text. Casts are always explicit and never raise."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from martloom import settings as S


def is_integer(col: Column) -> Column:
    """True for text made of an optional minus and digits."""
    return col.cast("string").rlike(S.INTEGER_TEXT)


def to_id(col: Column) -> Column:
    """Integer text as bigint, NULL for the rest.

    A cast that fails costs as much as many that succeed, so the text is tested first.
    """
    return F.when(is_integer(col), col.try_cast("bigint"))


def clamp_int(col: Column) -> Column:
    """Integer text as a 32-bit integer; values beyond its limits become the limit."""
    wide = F.when(is_integer(col), col.try_cast("decimal(38,0)"))
    inside = F.least(F.greatest(wide, F.lit(S.INT_MIN)), F.lit(S.INT_MAX)).cast("int")
    return F.when(wide.isNotNull(), inside)


def first_id(col: Column) -> Column:
    """The leading integer of a relation cell: 12 of ``'12, 15'``; NULL for empty text."""
    return F.nullif(F.regexp_extract(col.cast("string"), r"^\s*(-?\d+)", 1), F.lit("")).try_cast("bigint")


def id_list(col: Column) -> Column:
    """Every integer of a comma-separated relation cell."""
    parts = F.transform(F.split(col.cast("string"), ","), lambda x: to_id(F.trim(x)))
    return F.filter(parts, lambda x: x.isNotNull())
