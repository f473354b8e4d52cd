"""The CRM's catalogues (lists, types, fields) and rows that belong to other records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window as W, functions as F

from martloom import functions as fn
from martloom import settings as S


def positive_ids(df: DataFrame, id_col: str, measure: str) -> DataFrame:
    """Ids of the records whose measure is above zero."""
    return df.where(F.col(measure) > 0).select(id_col)


def rows_for_owners(rows: DataFrame, owners: DataFrame, owner_col: str, owner_id: str,
                    type_col: str | None = None, owner_type: str | None = None) -> DataFrame:
    """Rows whose owner is in ``owners``, of one owner type where given.

    A semi join of two plain tables: rows never multiply, and a very frequent owner is split
    over tasks by the adaptive skew join.
    """
    if type_col is not None:
        rows = rows.where(F.col(type_col) == F.lit(owner_type))
    keys = owners.select(F.col(owner_id).alias("_owner"))
    return rows.join(keys, F.col(owner_col) == F.col("_owner"), "left_semi")


def list_catalogue(df: DataFrame, name_col: str, id_col: str, order_col: str) -> DataFrame:
    """Cleaned list name and list id; where two names clean to the same text, the last one wins."""
    named = df.select(fn.clean_name(F.col(name_col)).alias("name"), F.col(id_col).alias("list_id"),
                      F.col(order_col).alias("_order"))
    last = W.partitionBy("name").orderBy(F.col("_order").desc())
    return named.withColumn("_n", F.row_number().over(last)).where("_n = 1").select("name", "list_id")


def entity_type_ids(df: DataFrame, type_col: str, extra: Sequence[int] = (S.INVOICE_TYPE,)) -> DataFrame:
    """Type ids of the catalogue, then the ids it does not list."""
    ids = df.select(F.col(type_col).cast("bigint").alias("entity_type_id"))
    more = df.sparkSession.createDataFrame([(int(i),) for i in extra], "entity_type_id bigint")
    return ids.unionByName(more)


def field_catalogue(df: DataFrame, json_col: str) -> DataFrame:
    """Field name and declared type of a ``{"result": {"<field>": {"type": ...}}}`` document."""
    schema = "result map<string, struct<type: string>>"
    fields = df.select(F.explode(F.from_json(F.col(json_col), schema)["result"]).alias("field", "meta"))
    return fields.select("field", F.col("meta.type").alias("type"))
