"""Stored tables: versions of Parquet files under one root, one folder per table and source database.

``<root>/<table>/database_name=<database>`` holds one source's rows, in versions (see :mod:`martloom.sources.versions`); a folder of
plain Parquet files is read as it is. :func:`load_sources` gives the rows of all sources.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from martloom.sources.versions import MANIFESTS, read_version


#: Source database of a table when none is named.
MAIN = "main"


def table_path(root: str, name: str, database: str = MAIN) -> str:
    """Folder of one source's rows of a table."""
    return f"{root.rstrip('/')}/{name}/database_name={database}"


def load_table(spark: SparkSession, root: str, name: str, database: str = MAIN, number: int | None = None) -> DataFrame:
    """All rows that one source has in a stored table, of its newest version or of the one given."""
    return read_stored(spark, table_path(root, name, database), number)


def load_sources(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The rows of all sources of a table, with a ``database_name`` column; columns that a source lacks are NULL."""
    where = spark._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{name}/database_name=*")
    found = where.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(where) or []
    out = None
    for folder in sorted(s.getPath().getName() for s in found):
        rows = read_stored(spark, f"{root.rstrip('/')}/{name}/{folder}")
        rows = rows.withColumn("database_name", F.lit(folder.partition("=")[2]))
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    if out is None:
        raise ValueError(f"no source has stored {name}")
    return out


def read_stored(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """A table's rows; its manifest tells files and columns, so no file is opened for them."""
    return read_version(spark, path, number)


def load_jdbc(spark: SparkSession, url: str, table: str, id_col: str, lower: int, upper: int,
              parts: int, **options: str) -> DataFrame:
    """A database table read in ``parts`` id ranges at once.

    The bounds only place the ranges; rows outside them are read too.
    """
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **options)
    return reader.options(partitionColumn=id_col, lowerBound=lower, upperBound=upper,
                          numPartitions=parts).load()


def has_table(spark: SparkSession, path: str) -> bool:
    """True when the folder has a version, or plain Parquet files; asks the file system, reads none of them."""
    for pattern in (f"{MANIFESTS}/*.json", "*.parquet"):
        files = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{pattern}")
        if files.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(files):
            return True
    return False


def column_names(spark: SparkSession, path: str) -> list[str]:
    """Columns of a stored table."""
    return read_stored(spark, path).columns


def has_column(df: DataFrame, name: str) -> bool:
    """True when the column is there; case does not matter, every character of the name does."""
    return name.lower() in {c.lower() for c in df.columns}


def keyset_scan(df: DataFrame, id_col: str, after, upto=None, limit: int | None = None) -> DataFrame:
    """Rows with ``id > after`` (and ``id <= upto``); the bounds reach the file scan.

    ``limit`` gives one page: the first rows in id order, taken per partition before they meet.
    Without it the rows keep their partitioning and are not sorted.
    """
    rows = df.where(F.col(id_col) > F.lit(after))
    if upto is not None:
        rows = rows.where(F.col(id_col) <= F.lit(upto))
    return rows if limit is None else rows.orderBy(F.col(id_col).asc()).limit(limit)
