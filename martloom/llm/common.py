"""Helpers of the operators: words, hold-out rows, stored intermediate tables, checked broadcasts."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of anything but these characters: blank and the controls 9 to 13.
BLANKS = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def col(name: str) -> Column:
    """The column of that exact name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def packed(df: DataFrame, name: str = "row") -> Column:
    """The whole row as one struct, so that no input column can clash with an operator's own."""
    return F.struct(*[col(c) for c in df.columns]).alias(name)


def text_of(name: str = "text") -> Column:
    """The text; NULL counts as empty."""
    return F.coalesce(col(name).cast("string"), F.lit(""))


def words(text: Column) -> Column:
    return F.array_remove(F.split(text, BLANKS), "")


def ascii_lower(text: Column) -> Column:
    """Lower case of A-Z only."""
    return F.translate(text, UPPER, LOWER)


def remainder(doc_id: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a NULL id counts as empty text (remainder 0)."""
    return F.crc32(F.coalesce(col(doc_id).cast("string"), F.lit("")).cast("binary")) % F.lit(modulus)


def shared_dir(spark: SparkSession, label: str) -> str:
    """A new folder below ``spark.checkpoint.dir``; where that is unset one of this machine, if the whole session is one process, as in tests."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="martloom-")
        spark.sparkContext.setCheckpointDir(root)
    return f"{root.rstrip('/')}/llm/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Written to the shared folder and read again: cuts the lineage, and survives lost executors."""
    path = shared_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(df: DataFrame, rows: int) -> DataFrame:
    """Marked for broadcast if it has at most ``rows`` rows, which are counted first; else left to Spark's choice.

    Both ways give the same join result. ``df`` should be a stored table.
    """
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
