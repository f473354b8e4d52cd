"""Text cells."""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql.types import ArrayType, BooleanType, DataType

from martloom import settings as S

# Unicode white space, plus the four separators that Java leaves out of that class.
_BLANK = r"(?U)^[\s\x1c-\x1f]*$"


def sentinel_to_null(col: Column, sentinel: str = S.UNSELECTED) -> Column:
    """NULL for the exact sentinel; case matters."""
    return F.nullif(col, F.lit(sentinel))


def blank_to_null(col: Column) -> Column:
    """NULL for empty text and text of white space only.

    A first character from ``!`` to ``~`` settles almost every cell without reading on.
    """
    return F.when(F.ascii(col).between(33, 126) | ~col.rlike(_BLANK), col)


def null_to_empty(col: Column) -> Column:
    """Empty text for NULL."""
    return F.coalesce(col, F.lit(""))


def join_list(col: Column, dtype: DataType | None = None) -> Column:
    """A list as one text, ``', '`` between items; NULL items read ``None``.

    Pass the column's ``dtype`` so that booleans are spelled ``True`` and ``False``.
    """
    if isinstance(dtype, ArrayType) and isinstance(dtype.elementType, BooleanType):
        col = F.transform(col, lambda x: F.initcap(x.cast("string")))
    return F.array_join(col.cast("array<string>"), S.LIST_SEPARATOR, S.NULL_IN_LIST)


def json_list(col: Column) -> Column:
    """A list as JSON text, for readers that need the items back."""
    return F.to_json(col, {"ignoreNullFields": "false"})


def strip_marks(col: Column) -> Column:
    """Remove byte-order marks wherever they stand."""
    return F.replace(col, F.lit(S.BYTE_ORDER_MARK), F.lit(""))


def whole_characters(json: Column) -> Column:
    """JSON text without escapes of half characters (a surrogate without its other half), which no text can hold.

    Pairs and escaped backslashes are read first, so they stay.
    """
    half = r"(\\\\|\\u[dD][89abAB][0-9a-fA-F]{2}\\u[dD][c-fC-F][0-9a-fA-F]{2})|\\u[dD][89a-fA-F][0-9a-fA-F]{2}"
    return F.when(F.lower(json).contains("\\ud"), F.regexp_replace(json, half, "$1")).otherwise(json)


def money_text(col: Column) -> Column:
    """Digits and dots of an amount marked ``|EUR``; other text is unchanged.

    The sign goes with the other characters, as the CRM reports expect.
    """
    return F.when(col.contains(S.EURO_MARK), F.regexp_replace(col, "[^0-9.]+", "")).otherwise(col)


def clean_name(col: Column) -> Column:
    """A name usable for a table: spaces become ``_``, other non-word characters go."""
    return F.regexp_replace(F.replace(col, F.lit(" "), F.lit("_")), r"(?U)[^\w]", "")
