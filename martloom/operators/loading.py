"""Writing tables: refresh, replace, evolve, snapshot, audit log."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import (
    DoubleType, FloatType, LongType, StringType, StructField, StructType, TimestampNTZType,
)

from martloom import functions as fn
from martloom.operators.quality import check_int_key
from martloom.sources.tables import MAIN, table_path
from martloom.sources.versions import (
    Version, bucket, copy_version, count_ids, holds, index_ids, merged_ids, publish, rows_of, stored_ids, version, write_version,
)

# The audit table.
SYNC_LOG = "synchronization_log"
SYNC_SCHEMA = StructType([
    StructField("timestamp", TimestampNTZType()),
    StructField("database_name", StringType()),
    StructField("table_name", StringType()),
    StructField("db_entry_count", LongType()),
    StructField("crm_entry_count", LongType()),
    StructField("error_message", StringType()),
])


def _fitted(df: DataFrame, existing: StructType) -> tuple[list[Column], dict[str, Column]]:
    """The cells of the rows under the stored schema and its new columns, and where a stored type cannot hold a value."""
    names = {c.lower(): c for c in df.columns}
    cells, lost = [], {}
    for field in existing.fields:
        source = names.get(field.name.lower())
        if source is None:
            value = F.lit(None).cast(field.dataType)
        elif df.schema[source].dataType == field.dataType:
            value = F.col(f"`{source}`")
        elif isinstance(field.dataType, StringType):
            value = F.col(f"`{source}`").cast("string")
        else:
            value = F.col(f"`{source}`").try_cast(field.dataType)
            lost[field.name] = F.col(f"`{source}`").isNotNull() & value.isNull()
        cells.append(value.alias(field.name))
    known = {f.name.lower() for f in existing.fields}
    cells += [fn.retyped(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema.fields if f.name.lower() not in known]
    return cells, lost


def align_additive(df: DataFrame, existing: StructType) -> DataFrame:
    """The rows under the stored schema plus the columns it does not have yet.

    Stored columns keep their type and place, values that do not fit it become NULL, as do
    stored columns the rows lack. New columns are double if numeric, else text. Loads count the values that became NULL.
    """
    return df.select(*_fitted(df, existing)[0])


def normalise_nulls(df: DataFrame) -> DataFrame:
    """NULL for all-zero dates in text columns and for NaN in floating-point columns."""
    def cell(f: StructField):
        col = F.col(f"`{f.name}`")
        if isinstance(f.dataType, StringType):
            col = fn.zero_date_to_null(col)
        elif isinstance(f.dataType, (DoubleType, FloatType)):
            col = fn.nan_to_null(col)
        return col.alias(f.name)

    return df.select(*[cell(f) for f in df.schema.fields])


def retype_dates(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """The listed text columns as timestamps without zone."""
    return df.withColumns({c: fn.to_datetime(F.col(f"`{c}`")) for c in columns})


def _load(df: DataFrame, path: str, operation: str, evolve: bool, **how) -> Version | None:
    """Write a new version; with ``evolve`` under the stored schema, counting the values that it cannot hold."""
    old = version(df.sparkSession, path) if evolve else None
    if old is None:
        return write_version(df, path, operation, **how)
    cells, lost = _fitted(df, old.schema)
    marks = {c: F.col(f"`lost {c}`") for c in lost}
    rows = df.select(*cells, *[test.alias(f"lost {c}") for c, test in lost.items()])
    return write_version(rows, path, operation, lost=marks, **how)


def replace_table(df: DataFrame, path: str, id_col: str | None = None) -> int:
    """Drop and recreate: the table takes the schema and the contents of the rows; their number is returned.

    ``path`` is a folder as :func:`table_path` gives it. Older versions stay readable until they expire.
    """
    return _load(df, path, "replace", False, id_col=id_col).rows


def full_refresh(df: DataFrame, path: str, id_col: str | None = None) -> int:
    """New contents under the stored schema, widened by the columns that are new; the number of rows."""
    return _load(df, path, "refresh", True, id_col=id_col).rows


def load_if_nonempty(df: DataFrame, path: str, recreate: bool = False, id_col: str | None = None) -> Version | None:
    """Refresh, or with ``recreate`` replace, unless there are no rows: then the stored table stays as it is.

    The rows are computed once. The new version tells their number, the values that the stored schema could not hold and, with
    ``id_col``, how many ids are repeated or no integers.
    """
    return _load(df, path, "replace" if recreate else "refresh", not recreate, keep_if_empty=True, id_col=id_col)


def append_new(df: DataFrame, path: str, id_col: str) -> Version | None:
    """Add the rows whose id is not stored yet; rows without an id are added always.

    Integer ids are looked up in the bitmaps that lie beside the files, so neither the stored rows nor the batch is read twice, whatever ids
    the batch has. Ids that are no integers are compared as text with the few files that have such ids.
    """
    spark = df.sparkSession
    old = version(spark, path)
    if old is not None and old.files:
        if old.ids is None or old.ids.column != id_col:
            old = publish(spark, path, replace(old, number=old.number + 1, operation="index", ids=count_ids(spark, path, id_col, [index_ids(spark, path, id_col, old, old.files)])))
        df = unseen(df, path, id_col, old)
    return _load(df.sortWithinPartitions(id_col), path, "append", True, add=True, keep_if_empty=old is not None, id_col=id_col)


def unseen(df: DataFrame, path: str, id_col: str, old: Version) -> DataFrame:
    """Rows whose id a stored version does not have, by its bitmaps; ids that are no integers are looked up in the files that have such."""
    spark = df.sparkSession
    bitmaps = stored_ids(spark, path, old.ids)
    merged = merged_ids(bitmaps).select(F.col("bucket").alias("_bucket"), F.col("bits").alias("_bits"))
    rows = df.withColumn("_key", fn.to_id(F.col(f"`{id_col}`")))
    rows = rows.join(merged, bucket(F.col("_key")) == F.col("_bucket"), "left").where(~holds(F.col("_bits"), F.col("_key")))
    if old.ids.odd:
        names = {r.file for r in bitmaps.where("bucket is null").select("file").distinct().collect()}
        known = rows_of(spark, path, old, [e for e in old.files if e.file.rpartition("/")[2] in names]).select(F.col(f"`{id_col}`").cast("string").alias("_odd"))
        known = known.where("_odd is not null").where(fn.to_id(F.col("_odd")).isNull()).distinct()
        rows = rows.join(known, (F.col(f"`{id_col}`").cast("string") == F.col("_odd")) & F.col("_key").isNull(), "left_anti")
    return rows.select(*[f"`{c}`" for c in df.columns])


def write_mart(df: DataFrame, path: str, keys: Sequence[str] = (), by: str | None = None,
               ties: Sequence[str] = (), ranged: bool = False) -> int:
    """Drop and create a mart as a new version, its files in key order; the number of rows.

    Readers keep the old mart until the new one is complete, and the rows may come from it.

    ``by`` splits it into one folder per value. With ``ranged`` rows are ranged over tasks by that value and the
    keys, so every task writes to few folders, and a value or key with many rows is cut; for that the rows are computed twice. The
    columns in ``ties`` only serve to cut inside equal keys and are not stored. By default
    rows stay where they are and are sorted within their task only.
    """
    order = [F.col(k).asc_nulls_first() for k in (*([by] if by else []), *keys, *ties)]
    if order:
        df = df.orderBy(*order) if ranged else df.sortWithinPartitions(*order)
    return write_version(df.drop(*ties), path, "mart", by=[by] if by else []).rows


def snapshot(spark: SparkSession, root: str, names: Iterable[str], suffix: str = "_transform",
             database: str = MAIN, number: int | None = None) -> list[str]:
    """Copies of stored tables under the suffixed name; the work that follows leaves the originals alone.

    A copy is a manifest that names the original's files: no row is moved, and later loads of the original do not change it.
    """
    copies = []
    for name in names:
        target = table_path(root, f"{name}{suffix}", database)
        copy_version(spark, table_path(root, name, database), target, number)
        copies.append(target)
    return copies


def snapshot_bucketed(tables: Mapping[str, DataFrame], keys: Mapping[str, str], buckets: int,
                      suffix: str = "_transform", root: str | None = None) -> dict[str, DataFrame]:
    """Copies as catalog tables, bucketed and sorted by the key the marts join them on.

    Joins of these copies on their keys need no shuffle, however many marts are built from them. Rows
    are brought together by key first, so that every bucket is one file.
    Text keys are stored as they are, so tables that are joined should have keys of one type.
    ``root`` places the files outside the catalog's own folder.
    """
    copies = {}
    for name, df in tables.items():
        key, target = keys[name], f"{name}{suffix}"
        writer = df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).mode("overwrite").format("parquet")
        if root:
            writer = writer.option("path", f"{root.rstrip('/')}/{target}")
        writer.saveAsTable(target)
        copies[name] = df.sparkSession.table(target)
    return copies


def key_is_clean(df: DataFrame, id_col: str) -> bool:
    """True when the id is an integer primary key."""
    return check_int_key(df, id_col).isEmpty()


def key_faults(loaded: Version) -> str | None:
    """What breaks the integer primary key of a loaded version, from its bitmaps, and what its schema could not hold."""
    told = []
    if loaded.ids and loaded.ids.odd:
        told.append(f"{loaded.ids.odd} rows without an integer {loaded.ids.column}")
    if loaded.ids and loaded.ids.repeated:
        told.append(f"{loaded.ids.repeated} rows repeat an {loaded.ids.column}")
    told += [f"{n} values of {c} do not fit its type" for c, n in sorted(loaded.nulled.items()) if n]
    return "; ".join(told) or None


def distinct_stored_ids(spark: SparkSession, path: str, id_col: str, number: int | None = None) -> DataFrame:
    """:func:`distinct_ids` of a stored table from its bitmaps, without reading an id."""
    found = version(spark, path, number)
    ids = found.ids if found.ids and found.ids.column == id_col else count_ids(spark, path, id_col, [index_ids(spark, path, id_col, found, found.files)])
    return spark.range(1).select(F.lit(ids.rows - ids.odd).cast("bigint").alias("n_rows"), F.lit(ids.distinct).cast("bigint").alias("n_ids"),
                                 F.lit(ids.repeated).cast("bigint").alias("n_repeats"))


def repeated_stored_ids(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """(id, n_rows) of the ids that a stored table repeats; only files with a bitmap that has fewer ids than rows are read."""
    found = version(spark, path, number)
    bitmaps = stored_ids(spark, path, found.ids)
    full = merged_ids(bitmaps).where(F.col("n") > F.bitmap_count("bits")).select("bucket")
    names = {r.file for r in bitmaps.join(full, "bucket", "left_semi").select("file").distinct().collect()}
    rows = rows_of(spark, path, found, [e for e in found.files if e.file.rpartition("/")[2] in names])
    key = fn.to_id(F.col(f"`{found.ids.column}`"))
    hit = rows.select(key.alias("id")).withColumn("_b", bucket(F.col("id"))).join(full.withColumnRenamed("bucket", "_b"), "_b", "left_semi")
    return hit.groupBy("id").agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")


def reset_log(spark: SparkSession, root: str, database: str = MAIN) -> None:
    """An empty audit table."""
    empty = spark.createDataFrame([], SYNC_SCHEMA)
    empty.write.mode("overwrite").parquet(table_path(root, SYNC_LOG, database))


def log_sync(entries: DataFrame, root: str, database: str = MAIN) -> None:
    """Add audit rows, one per table that was loaded."""
    rows = entries.select(*[F.col(f.name).cast(f.dataType) for f in SYNC_SCHEMA.fields])
    rows.coalesce(1).write.mode("append").parquet(table_path(root, SYNC_LOG, database))
