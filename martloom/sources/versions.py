"""Versions of a stored table: a manifest per version names its files and is written last.

``<table>/files/<load>/`` holds what one load has written, ``<table>/_versions/<number>.json`` the manifests, ``<table>/_ids/<load>/`` the
ids of that load as bitmaps. Files are never changed, so a reader keeps the version it has opened, a load that stops half-way leaves nothing but files
that no manifest names, and a copy of a table is a manifest.
"""

from __future__ import annotations

import json
import posixpath
import uuid
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StructField, StructType

from martloom import functions as fn

MANIFESTS, FILES, IDS = "_versions", "files", "_ids"
#: Folder of the rows without a value in a column that divides a table.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True)
class Entry:
    """A file, told from the table's folder; where columns divide the table, their folders (``mart=tutor/_block=3``) and its rows."""

    file: str
    part: str = ""
    rows: int | None = None


@dataclass(frozen=True)
class Ids:
    """The id column, the folders with its bitmaps, and what they say: rows, distinct ids, rows without an integer id."""

    column: str
    folders: tuple[str, ...]
    rows: int
    distinct: int
    odd: int

    @property
    def repeated(self) -> int:
        """Rows that repeat an id."""
        return self.rows - self.odd - self.distinct


@dataclass(frozen=True)
class Version:
    """What a manifest says. ``nulled`` counts, by column, values that the stored type could not hold; ``sources`` are the
    versions of other tables that the rows were made of."""

    number: int
    operation: str
    schema: StructType
    files: tuple[Entry, ...] = ()
    rows: int = 0
    ids: Ids | None = None
    nulled: Mapping[str, int] = field(default_factory=dict)
    sources: Mapping[str, int] = field(default_factory=dict)


def _hadoop(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def _below(spark: SparkSession, folder: str) -> list[str]:
    """Parquet files below a folder, told from it."""
    where, fs = _hadoop(spark, folder)
    root, found, files = fs.makeQualified(where).toString().rstrip("/") + "/", [], fs.listFiles(where, True)
    while files.hasNext():
        name = files.next().getPath().toString()
        if name.endswith(".parquet"):
            found.append(name.removeprefix(root))
    return sorted(found)


def plain_name(name: str) -> str:
    """A file name without the escapes that paths may have more than once."""
    while (shorter := unquote(name)) != name:
        name = shorter
    return name


def numbers(spark: SparkSession, path: str) -> list[int]:
    """The versions of a table, oldest first."""
    where, fs = _hadoop(spark, f"{path.rstrip('/')}/{MANIFESTS}/*.json")
    return sorted(int(s.getPath().getName().removesuffix(".json")) for s in fs.globStatus(where) or [])


def _read(spark: SparkSession, path: str, number: int) -> Version | None:
    """A manifest, or None while it is being written."""
    where, fs = _hadoop(spark, f"{path.rstrip('/')}/{MANIFESTS}/{number:012d}.json")
    stream = fs.open(where)
    try:
        head, *lines = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").split("\n")
    finally:
        stream.close()
    told = json.loads(head) if head.endswith("}") else {}
    if not told or len(lines) != told["files"] + 1:  # the last line is the empty one after the last line end
        return None
    ids = told["ids"] and Ids(**told["ids"] | {"folders": tuple(told["ids"]["folders"])})
    files = tuple(Entry(*json.loads(line)) for line in lines[:-1])
    return Version(told["number"], told["operation"], StructType.fromJson(told["schema"]), files, told["rows"], ids, told["nulled"], told["sources"])


def version(spark: SparkSession, path: str, number: int | None = None) -> Version | None:
    """A version of a table, by default the newest; None where there is none.

    A folder of plain Parquet files counts as version 0.
    """
    if number is not None and number > 0:
        return _read(spark, path, number) if number in numbers(spark, path) else None
    for n in reversed(numbers(spark, path) if number is None else []):
        if found := _read(spark, path, n):
            return found
    where, fs = _hadoop(spark, f"{path.rstrip('/')}/*.parquet")
    plain = sorted(s.getPath().getName() for s in fs.globStatus(where) or [])
    if not plain:
        return None
    names = [f"{path.rstrip('/')}/{name}" for name in plain]
    rows = spark.read.option("mergeSchema", "true").parquet(*names)
    return Version(0, "plain", rows.schema, tuple(map(Entry, plain)), rows.count())


def publish(spark: SparkSession, path: str, new: Version) -> Version:
    """Write a manifest; it is the moment from which readers see the version. A number that another load has taken raises an error."""
    told = {"number": new.number, "operation": new.operation, "files": len(new.files), "rows": new.rows, "nulled": dict(new.nulled), "sources": dict(new.sources),
            "ids": new.ids and new.ids.__dict__, "schema": new.schema.jsonValue()}
    lines = [json.dumps(told), *(json.dumps([e.file, e.part, e.rows]) for e in new.files)]
    where, fs = _hadoop(spark, f"{path.rstrip('/')}/{MANIFESTS}/{new.number:012d}.json")
    out = fs.create(where, False)
    out.write(bytearray(("\n".join(lines) + "\n").encode()))
    out.close()
    return new


def divided_by(part: str) -> dict[str, str | None]:
    """The dividing columns of a part and their values."""
    pairs = [p.split("=", 1) for p in part.split("/") if p]
    return {k: None if v == NO_VALUE else unquote(v) for k, v in pairs}


def rows_of(spark: SparkSession, path: str, v: Version, files: Iterable[Entry] | None = None) -> DataFrame:
    """The rows of a version, or of some of its files, without looking into any of them for the schema.

    Columns that divide the table come back; those that begin with ``_`` only place the rows.
    """
    named: dict[tuple, list[str]] = {}
    for e in v.files if files is None else files:
        values = tuple((c, x) for c, x in divided_by(e.part).items() if not c.startswith("_"))
        named.setdefault(values, []).append(f"{path.rstrip('/')}/{e.file}")
    out = None
    for values, names in named.items():
        told = dict(values)
        inside = StructType([f for f in v.schema.fields if f.name not in told])
        rows = spark.read.schema(inside).parquet(*names)
        rows = rows.select(*[F.lit(told[f.name]).cast(f.dataType).alias(f.name) if f.name in told else F.col(f"`{f.name}`") for f in v.schema.fields])
        out = rows if out is None else out.unionByName(rows)
    return spark.createDataFrame([], v.schema) if out is None else out


def read_version(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """The rows of a version, by default the newest."""
    found = version(spark, path, number)
    if found is None:
        raise ValueError(f"no version {number or ''} of {path}")
    return rows_of(spark, path, found)


def read_part(spark: SparkSession, path: str, number: int | None = None, **where: str) -> DataFrame:
    """The rows of the parts with the given values of dividing columns, without these columns; only their files are read."""
    found = version(spark, path, number)
    files = [e for e in found.files if divided_by(e.part).items() >= where.items()]
    return rows_of(spark, path, found, files).drop(*where)


def history(spark: SparkSession, path: str) -> DataFrame:
    """One row per version and column: ``version``, ``operation``, ``n_rows``, ``column_name``, ``column_type``, ``n_nulled``. No data file is opened."""
    rows = [(v.number, v.operation, v.rows, f.name, f.dataType.simpleString(), v.nulled.get(f.name, 0))
            for v in (_read(spark, path, n) for n in numbers(spark, path)) if v for f in v.schema.fields]
    return spark.createDataFrame(rows, "version int, operation string, n_rows bigint, column_name string, column_type string, n_nulled bigint")


def bucket(key: Column) -> Column:
    """Number of the bitmap of 32,768 neighbouring ids that holds an integer id."""
    return F.bitmap_bucket_number(key)


def id_bitmaps(rows: DataFrame, id_col: str, file: Column) -> DataFrame:
    """(bucket, file, bits, n): the ids of each file as bitmaps of neighbouring ids; bucket NULL counts rows without an integer id.

    Ids as counters give them fill their bitmaps: 32,768 ids take 4 KB, before compression, whatever the number of rows.
    """
    key = fn.to_id(F.col(f"`{id_col}`"))
    cells = rows.select(bucket(key).alias("bucket"), file.alias("file"), F.bitmap_bit_position(key).alias("place"))
    return cells.groupBy("bucket", "file").agg(F.bitmap_construct_agg("place").alias("bits"), F.count(F.lit(1)).alias("n"))


def stored_ids(spark: SparkSession, path: str, ids: Ids) -> DataFrame:
    """The bitmaps of a version as they lie beside its files."""
    schema = "bucket bigint, file string, bits binary, n bigint"
    return spark.read.schema(schema).parquet(*[f"{path.rstrip('/')}/{f}" for f in ids.folders])


def merged_ids(bitmaps: DataFrame) -> DataFrame:
    """(bucket, bits, n): one bitmap per bucket."""
    return bitmaps.where("bucket is not null").groupBy("bucket").agg(F.bitmap_or_agg("bits").alias("bits"), F.sum("n").alias("n"))


def holds(bits: Column, key: Column) -> Column:
    """True where a bitmap has the id; NULL bitmaps have none."""
    place = F.bitmap_bit_position(key)
    byte = F.conv(F.hex(F.substr(bits, (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.coalesce(F.getbit(byte, (place % 8).cast("int")) == 1, F.lit(False))


def count_ids(spark: SparkSession, path: str, column: str, folders: Sequence[str]) -> Ids:
    """Rows, distinct ids and rows without an integer id, from the bitmaps alone."""
    found = stored_ids(spark, path, Ids(column, tuple(folders), 0, 0, 0))
    odd = F.col("bucket").isNull()
    merged = found.groupBy("bucket").agg(F.bitmap_or_agg("bits").alias("bits"), F.sum("n").alias("n"))
    told = merged.agg(F.sum("n").alias("n"), F.sum(F.when(odd, F.col("n"))).alias("odd"), F.sum(F.when(~odd, F.bitmap_count("bits"))).alias("distinct")).first()
    return Ids(column, tuple(folders), told.n or 0, told.distinct or 0, told.odd or 0)


def index_ids(spark: SparkSession, path: str, column: str, v: Version, files: Sequence[Entry]) -> str:
    """Store the ids of some files as bitmaps, reading that one column; the folder."""
    folder = f"{IDS}/{uuid.uuid4().hex}"
    base = f"{path.rstrip('/')}/"
    inside = StructType([f for f in v.schema.fields if f.name == column])
    rows = spark.read.schema(inside).parquet(*[base + e.file for e in files])
    id_bitmaps(rows, column, F.col("_metadata.file_name")).write.parquet(base + folder)
    return folder


def write_version(df: DataFrame, path: str, operation: str, *, add: bool = False, by: Sequence[str] = (), instead_of: Iterable[str] | None = None,
                  id_col: str | None = None, keep_if_empty: bool = False, lost: Mapping[str, Column] | None = None,
                  sources: Mapping[str, int] | None = None) -> Version | None:
    """Write rows as a new version of a table: in place of the old ones, added to them (``add``), or in place of some parts (``instead_of``).

    ``by`` divides the files by columns; only tables that are divided can have parts replaced. With ``id_col`` the ids of the new files are stored as bitmaps, and the whole version's are counted from them.
    ``lost`` are conditions by column, counted on the way to the files: values that the stored type cannot hold. Without any rows the version is
    written all the same, or with ``keep_if_empty`` none is written and None returned.
    Rows may come from the table itself. Two loads at a time take the same number, and the second one fails.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    old, folder, counter = version(spark, path), f"{FILES}/{uuid.uuid4().hex}", Observation()
    watched = df.observe(counter, F.count(F.lit(1)).alias("n"), *[F.count_if(test).alias(f"lost {c}") for c, test in (lost or {}).items()])
    marks = {f"lost {c}" for c in lost or {}}
    kept = watched.select(*[f"`{c}`" for c in df.columns if c not in marks])
    writer = kept.write
    (writer.partitionBy(*by) if by else writer).parquet(f"{path}/{folder}")
    n = counter.get["n"]
    if n == 0 and keep_if_empty:
        return None
    # a load without rows leaves a file without rows
    found = _below(spark, f"{path}/{folder}") if n else []
    new = [Entry(f"{folder}/{name}", posixpath.dirname(name) if by else "") for name in found]
    if by and new:
        # one task writes files of the same name into several parts
        sizes = spark.read.parquet(*[f"{path}/{e.file}" for e in new]).groupBy(F.col("_metadata.file_path").alias("f")).count().collect()
        held = {plain_name(r.f).rpartition(f"/{folder}/")[2]: r["count"] for r in sizes}
        new = [replace(e, rows=held.get(plain_name(e.file.removeprefix(f"{folder}/")), 0)) for e in new]
    gone = set(instead_of or ())
    left = [e for e in old.files if e.part not in gone] if old and (add or instead_of is not None) else []
    # files can always hold NULL
    schema = StructType([StructField(f.name, f.dataType) for f in kept.schema.fields if f.name not in by or not f.name.startswith("_")])
    made = Version(old.number + 1 if old else 1, operation, schema, (*left, *new), n, None, {c: counter.get[f"lost {c}"] for c in lost or {}}, dict(sources or {}))
    if add and old:
        made = replace(made, rows=n + old.rows)
    elif instead_of is not None:
        made = replace(made, rows=sum(e.rows or 0 for e in made.files))
    if id_col:
        folders = []
        if add and old and old.files:
            known = old.ids is not None and old.ids.column == id_col
            folders = list(old.ids.folders) if known else [index_ids(spark, path, id_col, old, old.files)]
        if new:
            folders.append(index_ids(spark, path, id_col, made, new))
        if folders:
            made = replace(made, ids=count_ids(spark, path, id_col, folders))
    return publish(spark, path, made)


def copy_version(spark: SparkSession, source: str, target: str, number: int | None = None) -> Version:
    """A version of ``source`` as a new version of ``target``: the manifest is copied, the files stay where they are."""
    found, old = version(spark, source, number), version(spark, target)
    if found is None:
        raise ValueError(f"no version {number or ''} of {source}")
    way = posixpath.relpath(source.rstrip("/"), target.rstrip("/"))
    files = tuple(Entry(f"{way}/{e.file}", e.part) for e in found.files)
    ids = found.ids and replace(found.ids, folders=tuple(f"{way}/{f}" for f in found.ids.folders))
    return publish(spark, target, replace(found, number=old.number + 1 if old else 1, operation="copy", files=files, ids=ids))


def expire(spark: SparkSession, root: str, keep: int = 7) -> int:
    """Delete all but the newest ``keep`` versions of every table below ``root``, and the files that no version of any table names; their number.

    Copies protect the files they name. Run it while nothing is being loaded: files of a load under way are not named yet.
    """
    root = root.rstrip("/")
    tables, named = [], set()
    for depth in ("*", "*/*"):
        where, fs = _hadoop(spark, f"{root}/{depth}/{MANIFESTS}")
        tables += [s.getPath().getParent().toString() for s in fs.globStatus(where) or []]
    for table in tables:
        for n in numbers(spark, table)[:-keep]:
            where, fs = _hadoop(spark, f"{table}/{MANIFESTS}/{n:012d}.json")
            fs.delete(where, False)
        for v in (_read(spark, table, n) for n in numbers(spark, table)):
            if v:
                named |= {posixpath.normpath(f"{table}/{e.file}") for e in v.files}
                named |= {posixpath.normpath(f"{table}/{f}") for f in (v.ids.folders if v.ids else ())}
    gone = 0
    for table in tables:
        for kind in (FILES, IDS):
            where, fs = _hadoop(spark, f"{table}/{kind}")
            for name in _below(spark, f"{table}/{kind}") if fs.exists(where) else []:
                file = posixpath.normpath(f"{table}/{kind}/{name}")
                if file not in named and posixpath.dirname(file) not in named:
                    where, fs = _hadoop(spark, f"{table}/{kind}/{name}")
                    gone += fs.delete(where, False)
    return gone
