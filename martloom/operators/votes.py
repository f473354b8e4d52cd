"""Type votes that are kept beside a table's files and added up, so that a load has only its new files voted on.

``<table>/_votes/<run>/`` holds a row per file with the votes of its columns. Files are never changed, so a vote stays right as long as its file is named.
"""

from __future__ import annotations

import posixpath
import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField

from martloom import functions as fn
from martloom.operators.quality import sql_type, vote
from martloom.sources.versions import FILES, Entry, Version, divided_by, plain_name, rows_of, version

VOTES = "_votes"
#: Of each column of a file: bits of the kinds of values, values with a vote, values that are no offset timestamps, valid offset timestamps.
STATE = "file string, votes array<struct<column_name string, kinds int, n bigint, n_no_times bigint, n_times bigint>>"
#: The folder of a load and what follows, which tells a file wherever the table that names it lies.
_IN_LOAD = FILES + "/([0-9a-f]{32}/.*)$"
#: Paths may have escapes more than once.
_ESCAPED = 3


def _key(file: str) -> str:
    found = re.search(_IN_LOAD, plain_name(file))
    return found[1] if found else posixpath.basename(plain_name(file))


def _key_of(path: Column) -> Column:
    """The same for a column of paths; one row a file by then."""
    for _ in range(_ESCAPED):
        path = F.coalesce(F.try_url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))), path)
    found = F.regexp_extract(path, _IN_LOAD, 1)
    return F.when(found != "", found).otherwise(F.element_at(F.split(path, "/"), -1))


def file_votes(rows: DataFrame) -> DataFrame:
    """One row per file that ``rows`` are read from, as :data:`STATE`; each task adds up before the shuffle."""
    def times(f: StructField) -> list[Column]:
        value = F.col(f"`{f.name}`")
        if not isinstance(f.dataType, StringType):
            return [F.lit(None).cast("boolean"), F.lit(None).cast("boolean")]
        return [~fn.is_offset_timestamp(value), fn.local_timestamp(value).isNotNull()]

    fields = rows.schema.fields
    # positions as names: those of the table may hold any character
    cells = [c for k, f in enumerate(fields) for c in (vote(f).alias(f"v{k}"), *(t.alias(f"{n}{k}") for n, t in zip("nt", times(f))))]
    told = rows.select(F.col("_metadata.file_path").alias("file"), *cells).groupBy("file").agg(*[
        F.struct(F.lit(f.name).alias("column_name"), F.bit_or(f"v{k}").cast("int").alias("kinds"), F.count(f"v{k}").alias("n"),
                 F.count_if(F.col(f"n{k}")).alias("n_no_times"), F.count_if(F.col(f"t{k}")).alias("n_times")).alias(f"s{k}")
        for k, f in enumerate(fields)])
    return told.select(_key_of(F.col("file")).alias("file"), F.array(*[F.col(f"s{k}") for k in range(len(fields))]).alias("votes"))


def _stored(spark: SparkSession, path: str) -> DataFrame:
    """The votes that lie beside the table, a file once: two runs at a time may have voted on one."""
    folder = f"{path.rstrip('/')}/{VOTES}"
    where = spark._jvm.org.apache.hadoop.fs.Path(folder)
    if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        return spark.createDataFrame([], STATE)
    return spark.read.schema(STATE).parquet(f"{folder}/*").groupBy("file").agg(F.any_value("votes").alias("votes"))


def _wanted(spark: SparkSession, v: Version) -> DataFrame:
    return spark.createDataFrame([(_key(e.file), k) for k, e in enumerate(v.files)], "file string, place int")


def keep_votes(spark: SparkSession, path: str, number: int | None = None) -> list[Entry]:
    """Vote on the files of a version that have no stored votes yet, and store them; these files. No other file is opened.

    File names come to the driver, which holds those of the manifest as it is.
    """
    v = version(spark, path, number)
    if v is None:
        raise ValueError(f"no version {number or ''} of {path}")
    if not v.files:
        return []
    missing = [v.files[r.place] for r in _wanted(spark, v).join(_stored(spark, path).select("file"), "file", "left_anti").collect()]
    # a file without a row has nothing to vote on
    missing = sorted((e for e in missing if e.rows != 0), key=lambda e: e.file)
    for files in _alike(missing):
        named = spark.createDataFrame([(_key(e.file),) for e in files], "file string")
        # where the manifest does not count a file's rows, one without any is stored with NULL for its votes, so that it is not opened again
        told = named.join(file_votes(rows_of(spark, path, v, files)), "file", "left")
        told.write.parquet(f"{path.rstrip('/')}/{VOTES}/{uuid.uuid4().hex}")
    return missing


def _alike(files: list[Entry]) -> list[list[Entry]]:
    """Files by the values of the columns that divide the table, which are read together; columns that only place the rows do not count."""
    alike: dict[tuple, list[Entry]] = {}
    for e in files:
        alike.setdefault(tuple(p for p in divided_by(e.part).items() if not p[0].startswith("_")), []).append(e)
    return list(alike.values())


def column_votes(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """(column_name, kinds, n, n_no_times, n_times) of the columns of a version, added up over its files' stored votes."""
    keep_votes(spark, path, number)
    v = version(spark, path, number)
    votes = _stored(spark, path).join(_wanted(spark, v).select("file"), "file").select(F.inline("votes"))
    total = votes.groupBy("column_name").agg(
        F.bit_or("kinds").alias("kinds"), *[F.sum(c).alias(c) for c in ("n", "n_no_times", "n_times")])
    names = spark.createDataFrame([(f.name,) for f in v.schema.fields], "column_name string")
    zero = [F.coalesce(F.col(c), F.lit(0).cast("bigint")).alias(c) for c in ("n", "n_no_times", "n_times")]
    return names.join(total, "column_name", "left").select("column_name", "kinds", *zero)


def voted_types(spark: SparkSession, path: str, number: int | None = None, mode: str = "intended") -> DataFrame:
    """What :func:`martloom.operators.quality.infer_types` tells of a version's rows, reading only files that have not been voted on."""
    return column_votes(spark, path, number).select("column_name", sql_type(F.col("kinds"), mode).alias("sql_type"), F.col("n").alias("n_values"))


def voted_dates(spark: SparkSession, path: str, number: int | None = None) -> list[str]:
    """What :func:`martloom.operators.quality.date_columns` tells of a version's rows, in the order of its columns."""
    found = column_votes(spark, path, number).where("n_no_times = 0 and n_times > 0")
    names = {r.column_name for r in found.select("column_name").collect()}
    return [f.name for f in version(spark, path, number).schema.fields if f.name in names]
