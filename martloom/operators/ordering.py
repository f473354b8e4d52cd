"""Row order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def sort_mart(df: DataFrame, keys: Sequence[str], spread: Sequence[str] = ()) -> DataFrame:
    """Global order by the keys, NULL first.

    ``spread`` lists columns to break ties with. The range shuffle then cuts inside a very
    frequent key (or the NULL key) instead of sending all its rows to one task.
    """
    return df.orderBy(*[F.col(k).asc_nulls_first() for k in (*keys, *spread)])


def top_page(df: DataFrame, id_col: str, size: int) -> DataFrame:
    """The first ``size`` rows in id order."""
    return df.orderBy(F.col(id_col).asc()).limit(size)
