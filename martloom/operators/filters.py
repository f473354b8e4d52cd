"""Row filters."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from martloom import functions as fn


def by_flag(df: DataFrame, flag: str) -> DataFrame:
    """Rows where the flag column is set. Over a left join it makes the join an inner one."""
    return df.where(F.col(flag).isNotNull())


def by_category(df: DataFrame, category: int, col: str = "CATEGORY_ID") -> DataFrame:
    """Rows of one category; the code may be stored as text."""
    return df.where(fn.to_id(F.trim(F.col(col).cast("string"))) == F.lit(category))


def greater_than(df: DataFrame, col: str, bound) -> DataFrame:
    """Rows whose column is above the bound."""
    return df.where(F.col(col) > F.lit(bound))


def delete_nonint_ids(df: DataFrame, id_col: str) -> DataFrame:
    """Without the rows whose id is not integer text; rows without an id stay."""
    return df.where(F.col(id_col).isNull() | fn.is_integer(F.col(id_col)))


def null_nonint(df: DataFrame, col: str) -> DataFrame:
    """The column with NULL in place of everything that is not integer text."""
    return df.withColumn(col, F.when(fn.is_integer(F.col(col)), F.col(col)))


def int_ids(df: DataFrame, id_col: str, references: tuple[str, ...] = (), clamp: bool = False) -> DataFrame:
    """Rows with an integer id, id and references retyped to bigint (or a clamped 32-bit int)."""
    cast = fn.clamp_int if clamp else fn.to_id
    rows = delete_nonint_ids(df, id_col)
    return rows.withColumns({c: cast(F.col(c)) for c in (id_col, *references)})
