"""Landed API pages: one JSON document per row, a bounded number of records in each."""

from __future__ import annotations

import re
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F
from pyspark.sql.types import MapType, VariantType

from martloom import functions as fn
from martloom import settings as S

#: Row schema that remembers whether a cell was a list, a boolean, a number or text.
TYPED_ROWS = "map<string,variant>"
#: Column that holds a page which is no complete JSON.
CORRUPT = "_corrupt_record"
#: Column with the place of a page in landing order, see :func:`landing_order`.
LANDED = "_landed"


def read_envelope(
    df: DataFrame,
    json_col: str,
    payload: str = "result",
    items: str | None = None,
    row_schema: str = "map<string,string>",
    keep: Sequence[str] = (),
    place: str | None = None,
) -> DataFrame:
    """Records of ``{"<payload>": [...], "total": n}`` pages, as columns ``row`` and ``total``.

    ``items`` names the list inside a nested envelope ``{"result": {"items": [...]}}``.
    A page without the payload gives no rows. ``keep`` carries page columns along, such as the
    page number that :func:`dedupe_pages` orders by; ``place`` names a column for the record's place in its page.
    """
    return page_rows(parse_pages(df, json_col, payload, items, row_schema, keep), payload, items, keep, place)


def parse_pages(df: DataFrame, json_col: str, payload: str = "result", items: str | None = None, row_schema: str = "map<string,string>",
                keep: Sequence[str] = (), corrupt: bool = False) -> DataFrame:
    """Pages as a struct ``_page``; with ``corrupt`` it holds the text of a page that is no complete JSON."""
    body = f"array<{row_schema}>" if items is None else f"struct<`{items}`: array<{row_schema}>>"
    schema, told = f"`{payload}` {body}, `total` string", {}
    if corrupt:
        schema, told = f"{schema}, `{CORRUPT}` string", {"columnNameOfCorruptRecord": CORRUPT}
    return df.select(*keep, F.from_json(fn.whole_characters(F.col(json_col)), schema, told).alias("_page"))


def page_rows(parsed: DataFrame, payload: str = "result", items: str | None = None, keep: Sequence[str] = (), place: str | None = None) -> DataFrame:
    """The records of parsed pages, as :func:`read_envelope` gives them."""
    rows = F.col(f"_page.`{payload}`" if items is None else f"_page.`{payload}`.`{items}`")
    total = F.col("_page.total").try_cast("bigint").alias("total")
    if place is None:
        return parsed.select(*keep, F.explode(rows).alias("row"), total).where("row is not null")
    return parsed.select(*keep, F.posexplode(rows).alias(place, "row"), total).where("row is not null")


def landing_order() -> Column:
    """Place of a landed page among all: file names in order, numbers in them by value, then the line of the file.

    For tables read from text files. Spark packs files into tasks by size, so the order of its tasks says nothing; inside a piece of a
    file the lines are numbered in order. Names are padded once per file and batch of rows, for it takes far longer than reading a page.
    """
    @F.arrow_udf("string")
    def padded(files: pa.Array) -> pa.Array:
        told = files.dictionary_encode()
        names = [re.sub(r"[0-9]+", lambda digits: digits[0][-20:].rjust(20, "0"), f) for f in told.dictionary.to_pylist()]
        return pa.array(names, pa.string()).take(told.indices)

    file, block = F.col("_metadata.file_path"), F.col("_metadata.file_block_start")
    return F.struct(padded(file).alias("name"), file.alias("file"), block.alias("block"), F.monotonically_increasing_id().alias("line"))


def check_pages(df: DataFrame, json_col: str) -> int | None:
    """The largest declared total; a page that is no complete JSON raises an error, so that a load keeps the old table."""
    page = F.from_json(F.col(json_col), f"`total` string, `{CORRUPT}` string", {"columnNameOfCorruptRecord": CORRUPT})
    pages = df.select(page.alias("p")).select(F.col("p.total").try_cast("bigint").alias("total"), F.col(f"p.`{CORRUPT}`").isNotNull().alias("bad"))
    found = pages.agg(F.max("total").alias("total"), F.count_if("bad").alias("bad")).first()
    if found.bad:
        raise ValueError(f"{found.bad} landed pages are no complete JSON")
    return found.total


def page_totals(df: DataFrame, json_col: str, by: str) -> DataFrame:
    """Record count the source declares, one row per ``by``: the largest ``total`` of its pages."""
    total = F.get_json_object(json_col, "$.total").try_cast("bigint")
    return df.groupBy(by).agg(F.max(total).alias("n_source"))


def field_names(df: DataFrame, map_col: str = "row") -> list[str]:
    """Sorted names of all fields that occur; the distinct names come to the driver, no data."""
    names = df.select(F.explode(F.map_keys(map_col)).alias("k")).distinct()
    return sorted(r.k for r in names.collect())


def survey_pages(df: DataFrame, json_col: str, payload: str = "result", items: str | None = None) -> tuple[list[str], int | None]:
    """Names of all fields that occur and the largest declared total, from one pass over the pages.

    A page that is no complete JSON raises an error, so that a load keeps the old table. Records that are ``null`` are passed over.

    Names are distinct per page and per task before they are shuffled; one row per name comes to
    the driver.
    """
    page = parse_pages(df, json_col, payload, items, corrupt=True)
    records = F.col(f"_page.`{payload}`" if items is None else f"_page.`{payload}`.`{items}`")
    names = F.array_distinct(F.flatten(F.transform(F.filter(records, lambda r: r.isNotNull()), F.map_keys)))
    found = page.select(F.explode_outer(names).alias("name"), F.col("_page.total").try_cast("bigint").alias("total"), F.col(f"_page.`{CORRUPT}`").isNotNull().alias("bad"))
    found = found.groupBy("name").agg(F.max("total").alias("total"), F.count_if("bad").alias("bad")).collect()
    if bad := sum(r.bad for r in found if r.name is None):
        raise ValueError(f"{bad} landed pages are no complete JSON")
    totals = [r.total for r in found if r.total is not None]
    return sorted(r.name for r in found if r.name is not None), max(totals, default=None)


def spread_map(df: DataFrame, fields: Sequence[str], map_col: str = "row", keep: Sequence[str] = ()) -> DataFrame:
    """One text column per field of a map column, in the order given; absent fields are NULL. ``keep`` carries columns along.

    Cells read with :data:`TYPED_ROWS` keep apart lists, booleans and text that looks like them.
    """
    cells = df.select(*keep, *[F.try_element_at(F.col(map_col), F.lit(f)).alias(f) for f in fields])
    if not isinstance(df.schema[map_col].dataType.valueType, VariantType):
        return cells
    cells = cells.select("*", *[F.col(f"`{f}`").cast("string").alias(f"_text {f}") for f in fields])
    return cells.select(*keep, *[fn.typed_text(F.col(f"`{f}`"), F.col(f"`_text {f}`")).alias(f) for f in fields])


def dedupe_pages(df: DataFrame, id_col: str, page_col: str | None = None) -> DataFrame:
    """One row per id over all pages.

    With ``page_col`` the earliest page wins, decided before the shuffle, so an id repeated on
    very many pages is reduced to one row per task first. Without it any copy may be kept.
    """
    if page_col is None:
        return df.dropDuplicates([id_col])
    order = W.partitionBy(id_col).orderBy(F.col(page_col).asc_nulls_last())
    return df.withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n")


def read_matrix(df: DataFrame, json_col: str, columns: Sequence[str]) -> DataFrame:
    """Rows of ``[[header...], [row...], ...]`` documents as text columns.

    Every document carries its own header, so a large table lands as many documents and the
    column order may differ between them. Columns a document lacks are NULL.
    """
    doc = df.select(F.from_json(F.col(json_col), "array<array<string>>").alias("_m"))
    cells = doc.select(
        F.get("_m", F.lit(0)).alias("_head"),
        F.explode(F.slice("_m", F.lit(2), F.greatest(F.size("_m") - 1, F.lit(0)))).alias("_row"),
    )

    def cell(name: str) -> Column:
        at = F.array_position("_head", F.lit(name)).cast("int")
        return F.when(at > 0, F.try_element_at(F.col("_row"), F.nullif(at, F.lit(0))))

    return cells.select(*[cell(c).alias(c) for c in columns])


def matrix_columns(df: DataFrame, json_col: str) -> list[str]:
    """Sorted names in the headers of all documents; only the distinct names come to the driver.

    A document that is no complete JSON raises an error, so that a load keeps the old table.
    """
    doc = F.from_json(F.col(json_col), "array<array<string>>")
    read = df.select(F.explode_outer(F.get(doc, F.lit(0))).alias("c"), (doc.isNull() & (F.trim(F.col(json_col)) != "")).alias("bad"))
    found = read.groupBy("c").agg(F.count_if("bad").alias("bad")).collect()
    if bad := sum(r.bad for r in found):
        raise ValueError(f"{bad} landed documents are no complete JSON")
    return sorted(r.c for r in found if r.c is not None)


def _unwrap(df: DataFrame, prefix: str, on_map, on_text) -> DataFrame:
    def cell(field):
        col = F.col(f"`{field.name}`")
        if not field.name.startswith(prefix):
            return col
        unwrap = on_map if isinstance(field.dataType, MapType) else on_text
        return unwrap(col).alias(field.name)

    return df.select(*[cell(f) for f in df.schema.fields])


def unwrap_first(df: DataFrame, prefix: str = S.PROPERTY_PREFIX) -> DataFrame:
    """Property columns reduced to the first value of their map."""
    return _unwrap(df, prefix, fn.first_value, fn.first_in_text)


def unwrap_key(df: DataFrame, prefix: str = S.PROPERTY_PREFIX, key: str = S.PROPERTY_KEY) -> DataFrame:
    """Property columns reduced to the value under ``key``, where the key is there."""
    return _unwrap(df, prefix, lambda c: fn.value_under(c, key), lambda c: fn.value_in_text(c, key))
