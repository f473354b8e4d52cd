"""Which columns a table keeps, and what they are called."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import NumericType

from martloom import settings as S


def keep_columns(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """The listed columns in list order, and the listed names that are absent."""
    present = [c for c in columns if c in df.columns]
    return df.select(*[F.col(f"`{c}`") for c in present]), [c for c in columns if c not in df.columns]


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """All but the listed columns; absent names do not matter."""
    return df.drop(*columns)


def numeric_only(df: DataFrame, active: bool = True) -> DataFrame:
    """The numeric columns, or the table as it is when not ``active``."""
    if not active:
        return df
    return df.select(*[F.col(f"`{f.name}`") for f in df.schema.fields if isinstance(f.dataType, NumericType)])


def fields_of_type(fields: DataFrame, types: Sequence[str] = tuple(S.RELATION_TYPES)) -> list[str]:
    """Names of the fields whose declared type is listed, in name order.

    ``fields`` is the field catalogue (``field``, ``type``), one row per column of a table.
    """
    chosen = fields.where(F.col("type").isin(*types)).select("field").distinct()
    return sorted(r.field for r in chosen.collect())


def schema_diff(a: DataFrame, b: DataFrame) -> tuple[list[str], list[str]]:
    """Columns only ``a`` has, and columns only ``b`` has; case does not matter."""
    in_a, in_b = {c.lower() for c in a.columns}, {c.lower() for c in b.columns}
    return [c for c in a.columns if c.lower() not in in_b], [c for c in b.columns if c.lower() not in in_a]


def drop_shared(primary: DataFrame, secondary: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The secondary table without the columns the primary one has, except those in ``keep``.

    Names are compared whole and without regard to case. Only schemas are looked at.
    """
    kept = {k.lower() for k in keep}
    shared = {c.lower() for c in primary.columns} - kept
    return secondary.drop(*[c for c in secondary.columns if c.lower() in shared])


def prefix_columns(df: DataFrame, entity: str, id_col: str = "ID", relation_prefix: str = "sql_") -> DataFrame:
    """Rename an entity table for the marts: its id gets the entity's name, the rest a prefix."""
    names: Mapping[str, str] = {
        c: f"entity_{entity}_{id_col}" if c.lower() == id_col.lower() else f"{relation_prefix}{c}"
        for c in df.columns
    }
    return df.withColumnsRenamed(names)


def add_null_text(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Text columns full of NULL, added at the end where they are not there yet."""
    have = {c.lower() for c in df.columns}
    return df.withColumns({c: F.lit(None).cast("string") for c in columns if c.lower() not in have})
