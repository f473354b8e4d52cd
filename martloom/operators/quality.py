"""Counts, checks and type votes. All of them aggregate per task before anything is shuffled."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DateType, IntegralType, StructField, TimestampNTZType, TimestampType

from martloom import functions as fn


def row_count(df: DataFrame, table: str) -> DataFrame:
    """One row: table name and number of rows."""
    return df.agg(F.count(F.lit(1)).alias("n_loaded")).select(F.lit(table).alias("table_name"), "n_loaded")


def reconcile(loaded: Mapping[str, DataFrame], declared: DataFrame) -> DataFrame:
    """Loaded rows against the count the source declares, one row per table.

    ``declared`` has ``table_name`` and ``n_source``. A table the source says nothing about
    has NULL there and in ``gap``.
    """
    counts = None
    for name, df in loaded.items():
        one = row_count(df, name)
        counts = one if counts is None else counts.unionByName(one)
    out = counts.join(declared, "table_name", "left")
    return out.select("table_name", "n_loaded", "n_source", (F.col("n_source") - F.col("n_loaded")).alias("gap"))


def distinct_ids(df: DataFrame, id_col: str) -> DataFrame:
    """One row: rows, distinct ids and rows that repeat an id."""
    per_id = df.where(F.col(id_col).isNotNull()).groupBy(id_col).count()
    return per_id.agg(
        F.coalesce(F.sum("count"), F.lit(0)).cast("bigint").alias("n_rows"),
        F.count(F.lit(1)).alias("n_ids"),
        F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).cast("bigint").alias("n_repeats"),
    )


def check_key(df: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Key values that break a primary key: repeated ones, and those with a NULL part."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    missing = F.lit(False)
    for k in keys:
        missing = missing | F.col(k).isNull()
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
    return per_key.where((F.col("n_rows") > 1) | missing)


def check_int_key(df: DataFrame, id_col: str) -> DataFrame:
    """Ids that break an integer primary key: repeated, NULL or not integer text."""
    typed = df.select(fn.to_id(F.col(id_col)).alias(id_col))
    return check_key(typed, id_col)


def max_id(df: DataFrame, id_col: str) -> DataFrame:
    """One row: the largest id, where the next incremental read starts."""
    return df.agg(F.max(id_col).alias("max_id"))


# one bit per kind of value; a column's votes are the bits that occur
_DATE, _LEADING_ZERO, _WHOLE, _FRACTION, _OTHER = 1, 2, 4, 8, 16


def vote(field: StructField) -> Column:
    """Kind of each value of a column, NULL for unset and empty ones."""
    col = F.col(f"`{field.name}`")
    if isinstance(field.dataType, IntegralType):
        return F.when(col.isNotNull(), _WHOLE)
    if isinstance(field.dataType, (DateType, TimestampType, TimestampNTZType)):
        return F.when(col.isNotNull(), _DATE)
    value = col.cast("string")
    # no value is both whole or fractional and a date, so the dates can wait unless they start with 0
    return (
        F.when(value == "", None)
        .when(fn.has_leading_zero(value), F.when(fn.has_date_shape(value), _DATE).otherwise(_LEADING_ZERO))
        .when(fn.is_integer(value), _WHOLE)
        .when(fn.is_number(value), _FRACTION)
        .when(fn.has_date_shape(value), _DATE)
        .when(value.isNotNull(), _OTHER)
    )


def infer_types(df: DataFrame, mode: str = "intended") -> DataFrame:
    """Type of every column by a vote of its values read as text: ``column_name``, ``sql_type``, ``n_values``.

    Dates when all values have a date shape; text when a value has a leading zero or is no
    number; integers when all values are whole, else floats. Only the two explicit date shapes
    count, a bare number is not read as a date. ``mode="reference"`` gives what the loader does
    in effect: text for every column. Empty values have no vote. All columns are voted on in one pass.
    """
    kinds = df.select(*[vote(f).alias(f.name) for f in df.schema.fields])
    votes = kinds.agg(*[
        F.struct(F.bit_or(F.col(f"`{c}`")).alias("kinds"), F.count(F.col(f"`{c}`")).alias("n")).alias(c) for c in df.columns
    ])

    def verdict(name: str) -> Column:
        v = F.col(f"`{name}`")
        return F.struct(F.lit(name).alias("column_name"), sql_type(v["kinds"], mode).alias("sql_type"), v["n"].alias("n_values"))

    return votes.select(F.inline(F.array(*[verdict(c) for c in df.columns])))


def sql_type(kinds: Column, mode: str = "intended") -> Column:
    """The type that the votes of a column give; without votes, and with ``mode="reference"``, text."""
    if mode == "reference":
        return F.lit("TEXT")
    return (
        F.when(kinds == _DATE, "DATETIME")
        .when(kinds.isNull() | (kinds.bitwiseAND(_DATE | _LEADING_ZERO | _OTHER) != 0), "TEXT")
        .when(kinds == _WHOLE, "INTEGER")
        .otherwise("FLOAT")
    )


def date_columns(df: DataFrame, columns: Sequence[str] | None = None) -> list[str]:
    """Text columns in which every set value is an offset timestamp and at least one is valid.

    One aggregation over the raw values; one row of counts comes to the driver.
    """
    columns = list(columns or [f.name for f in df.schema.fields if f.dataType.typeName() == "string"])
    if not columns:
        return []
    tests = []
    for c in columns:
        col = F.col(f"`{c}`")
        tests.append(
            ((F.count_if(~fn.is_offset_timestamp(col)) == 0) & (F.count(fn.local_timestamp(col)) > 0)).alias(c)
        )
    found = df.agg(*tests).first()
    return [c for c in columns if found[c]]
