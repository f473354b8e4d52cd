"""The two cleaning recipes, applied to whole DataFrames.

Each step is a projection of its own: the steps mention their input several times, and one
nested expression would compute the inner steps again for every mention.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, FloatType, NumericType, StringType

from martloom import functions as fn


def _on_text(df: DataFrame, step: Callable[[Column], Column]) -> DataFrame:
    """The step applied to every text column."""
    return df.select(*[
        step(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, StringType) else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ])


def clean_entity(df: DataFrame) -> DataFrame:
    """Rows of the entity API: lists, booleans, marks, money, timestamps, sentinel, blanks."""
    def flat(field):
        col = F.col(f"`{field.name}`")
        if isinstance(field.dataType, BooleanType):
            return fn.bool_to_int(col).alias(field.name)
        if isinstance(field.dataType, ArrayType):
            return fn.join_list(col, field.dataType).alias(field.name)
        return col

    out = df.select(*[flat(f) for f in df.schema.fields])
    # an amount holds '|', an offset timestamp cannot: the two rules never meet on one cell
    for step in (fn.strip_marks, fn.money_text, fn.local_timestamp_text, fn.sentinel_to_null, fn.blank_to_null):
        out = _on_text(out, step)
    return out


def clean_connector(df: DataFrame, empty_for_null: bool = False) -> DataFrame:
    """Rows of the table connector: sentinel, blanks, lists, zero dates, NaN; nothing else.

    ``empty_for_null`` stores empty text for NULL, which makes every "is set" test on a text
    column true; the marts need it off.
    """
    def flat(field):
        col = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (DoubleType, FloatType)):
            return fn.nan_to_null(col).alias(field.name)
        if isinstance(field.dataType, ArrayType):
            return fn.join_list(col, field.dataType).alias(field.name)
        return col

    out = _on_text(_on_text(df, fn.sentinel_to_null), fn.blank_to_null)
    out = out.select(*[flat(f) for f in df.schema.fields])
    if empty_for_null:
        out = _on_text(out, fn.null_to_empty)
    return _on_text(out, fn.zero_date_to_null)


def zero_fill(df: DataFrame) -> DataFrame:
    """0 for NULL in every numeric column; an option that the standard recipes leave out."""
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]
    return df.fillna(0, subset=names) if names else df
