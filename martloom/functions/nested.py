"""Cells that hold a map."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from martloom import settings as S
from martloom.functions.text import join_list


def first_value(col: Column) -> Column:
    """First value of a map, NULL for an empty one."""
    return F.try_element_at(F.map_values(col), F.lit(1))


def value_under(col: Column, key: str = S.PROPERTY_KEY) -> Column:
    """Value of a map under ``key``; the whole map as JSON when the key is absent."""
    return F.when(F.map_contains_key(col, key), F.try_element_at(col, F.lit(key))).otherwise(F.to_json(col))


def value_in_text(col: Column, key: str = S.PROPERTY_KEY) -> Column:
    """Like :func:`value_under` for text cells: JSON objects give their value, other text stays."""
    parsed = F.from_json(col, "map<string,string>")
    return F.when(F.map_contains_key(parsed, key), F.try_element_at(parsed, F.lit(key))).otherwise(col)


def first_in_text(col: Column) -> Column:
    """Like :func:`first_value` for text cells: JSON objects give their first value, other text stays."""
    parsed = F.from_json(col, "map<string,string>")
    return F.when(parsed.isNotNull(), first_value(parsed)).otherwise(col)


def _list_text(as_json: Column, text: Column) -> Column:
    """Items of a list joined. As variants its items still tell a boolean from the text ``true``."""
    items = F.transform(F.from_json(as_json, "array<variant>"), lambda x: F.when(F.schema_of_variant(x) == "BOOLEAN", F.initcap(x.cast("string"))))
    plain = F.from_json(text, "array<string>")
    return join_list(F.transform(plain, lambda x, i: F.coalesce(F.get(items, i), x)))


def typed_text(col: Column, text: Column) -> Column:
    """Text of a variant cell: lists joined, booleans as 0 and 1, the rest as it reads.

    ``text`` is the cell cast to text. Only where it looks like a list or a boolean is the cell's
    JSON made, in which real text is quoted.
    """
    as_json = F.to_json(col)
    return (
        F.when(text.startswith("["), F.when(as_json.startswith("["), _list_text(as_json, text)).otherwise(text))
        .when(text == "false", F.when(as_json == "false", "0").otherwise(text))
        .when(text == "true", F.when(as_json == "true", "1").otherwise(text))
        .otherwise(text)
    )
