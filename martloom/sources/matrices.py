"""One header-row matrix document that is too large for one task: ``[[header...], [row...], ...]`` in a file, read in pieces.

A file is cut after every ``]``, which Spark does in many tasks. Whether a ``]`` ends a row hangs on all that stands before it: is it inside a text, and how many
brackets are open. Each piece tells what it does to these two for either case it may begin in; running sums inside a block of the file, and over the blocks'
totals, tell in which case it does begin. Rows are then put together inside their block, and only the one row that a block's border cuts is moved.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from martloom.session import work_dir

_BLOCK = ("file", "block")


def _brackets(parts: Column, first: int) -> Column:
    """Opening brackets in every second part of a piece cut at its quotes."""
    def count(acc: Column, k: Column) -> Column:
        part = F.get(parts, k)
        return acc + F.length(part) - F.length(F.replace(part, F.lit("["), F.lit("")))

    places = F.filter(F.sequence(F.lit(0), F.size(parts) - 1), lambda k: k % 2 == first)
    return F.aggregate(places, F.lit(0), count)


def _pieces(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(file, block, line, text, flips, open0, open1): the pieces with their ``]``; whether they end in another case, and the brackets that are left open
    by one that begins outside (0) or inside (1) a text."""
    read = spark.read.option("lineSep", "]").text(list(paths))
    place = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line")]
    # an escaped sign is neither a quote nor the start of another escape
    parts = F.split(F.regexp_replace("value", r"(?s)\\.", "__"), '"')
    cut = read.select(*place, F.concat("value", F.lit("]")).alias("text"), parts.alias("parts"))
    flips = (F.size("parts") - 1) % 2
    # the closing bracket counts for the case that leads outside
    return cut.select("file", "block", "line", "text", flips.alias("flips"), (_brackets(F.col("parts"), 0) - F.when(flips == 0, 1).otherwise(0)).alias("open0"),
                      (_brackets(F.col("parts"), 1) - F.when(flips == 1, 1).otherwise(0)).alias("open1"))


def _states(pieces: DataFrame) -> DataFrame:
    """(file, block, line, text, case, depth0, depth1): the case each piece begins in and the brackets open after it, told from the block's start, for a block that begins outside and one that begins inside a text."""
    order = W.partitionBy(*_BLOCK).orderBy("line")
    before = F.coalesce(F.sum("flips").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)) % 2
    cased = pieces.withColumn("case", before.cast("int"))
    upto = order.rowsBetween(W.unboundedPreceding, W.currentRow)
    same, other = F.when(F.col("case") == 0, F.col("open0")).otherwise(F.col("open1")), F.when(F.col("case") == 0, F.col("open1")).otherwise(F.col("open0"))
    return cased.select(*_BLOCK, "line", "text", "flips", "case", F.sum(same).over(upto).alias("depth0"), F.sum(other).over(upto).alias("depth1"))


def _starts(states: DataFrame) -> DataFrame:
    """(file, block, inside, base): the case and the open brackets that each block begins with; one row a block.

    The case is a running sum of the blocks' changes; with it each block's own depth is known, and the base is the running sum of these.
    """
    totals = states.groupBy(*_BLOCK).agg((F.sum("flips") % 2).alias("flips"), F.max_by("depth0", "line").alias("depth0"), F.max_by("depth1", "line").alias("depth1"))
    earlier = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    cased = totals.withColumn("inside", (F.coalesce(F.sum("flips").over(earlier), F.lit(0)) % 2).cast("int"))
    depth = F.when(F.col("inside") == 0, F.col("depth0")).otherwise(F.col("depth1"))
    ended = (F.col("inside") + F.col("flips")) % 2
    return cased.select(*_BLOCK, "inside", F.coalesce(F.sum(depth).over(earlier), F.lit(0)).alias("base"), depth.alias("depth"), ended.alias("ended"))


def document_rows(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(file, row, cells): the rows of matrix documents, one document a file, as lists of text; row 0 is the header.

    Lists inside a cell are its JSON text. A document that is not complete raises an error, and so does more than one document in a file.
    The cut pieces are written once to a work folder: how Spark cuts a file hangs on the cores it has just then.
    """
    folder = work_dir(spark, "matrix")
    _states(_pieces(spark, paths)).write.parquet(folder)
    states = spark.read.parquet(folder)
    starts = _starts(states)
    last = starts.groupBy("file").agg(F.sum("depth").alias("depth"), F.max_by("ended", "block").alias("ended"), F.max("block").alias("block"))
    tail = states.groupBy(*_BLOCK).agg(F.max_by("text", "line").alias("text"))
    # what follows the last bracket is cut off as a piece too
    tail = last.join(tail, [*_BLOCK]).select("file", "depth", "ended", F.regexp_like(F.col("text"), F.lit(r"^\s*\]$")).alias("blank"))
    bad = tail.where(~((F.col("ended") == 0) & ((F.col("depth") == 0) | ((F.col("depth") == -1) & F.col("blank")))))
    if (n := bad.count()):
        raise ValueError(f"{n} landed documents are no complete JSON")
    placed = states.join(starts.select(*_BLOCK, "inside", "base"), [*_BLOCK])
    inside = (F.col("case") + F.col("inside")) % 2
    depth = F.col("base") + F.when(F.col("inside") == 0, F.col("depth0")).otherwise(F.col("depth1"))
    # a row ends outside any text where one bracket is left open
    placed = placed.select(*_BLOCK, "line", "text", (((inside + F.col("flips")) % 2 == 0) & (depth == 1)).alias("ends"), depth.alias("depth"), "base")
    before = W.partitionBy(*_BLOCK).orderBy("line").rowsBetween(W.unboundedPreceding, -1)
    placed = placed.withColumn("nth", F.coalesce(F.sum(F.col("ends").cast("int")).over(before), F.lit(0)))
    if placed.where("depth = 0").groupBy("file").count().where("count > 1").limit(1).count():
        raise ValueError("a file holds more than one document")
    joined = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("line", "text"))), lambda p: p["text"]), "").alias("text")
    inner = placed.groupBy(*_BLOCK, "nth").agg(joined, F.max("ends").alias("ends"))
    ended = placed.groupBy(*_BLOCK).agg(F.sum(F.col("ends").cast("bigint")).alias("rows"))
    earlier = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    ended = ended.select(*_BLOCK, F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("first"))
    numbered = inner.join(ended, [*_BLOCK]).select("file", "block", "ends", "text", (F.col("first") + F.col("nth")).alias("row"), "nth")
    # a block's first row may have begun in a block before it, and what follows its last row end goes on in a later one
    cut = (F.col("nth") == 0) | ~F.col("ends")
    parts = F.sort_array(F.collect_list(F.struct("block", "text")))
    mended = numbered.where(cut).groupBy("file", "row").agg(F.array_join(F.transform(parts, lambda p: p["text"]), "").alias("text"), F.max("ends").alias("ends"))
    whole = numbered.where(~cut).select("file", "row", "text").unionByName(mended.where("ends").select("file", "row", "text"))
    body = F.when(F.col("row") == 0, F.regexp_replace("text", r"^\s*\[\s*", "")).otherwise(F.regexp_replace("text", r"^\s*,\s*", ""))
    return whole.select("file", "row", F.from_json(body, "array<string>").alias("cells"))


def read_document(spark: SparkSession, paths: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """Rows of matrix documents as text columns, as :func:`martloom.sources.pages.read_matrix` gives them, each document read by many tasks.

    ``columns`` are by default all names in the headers. Each file has its own header; a column that it lacks is NULL. The headers, one a file, come to
    the driver.
    """
    rows = document_rows(spark, paths)
    heads = [(r.file, r.cells) for r in rows.where("row = 0").select("file", "cells").collect()]
    names = sorted({c for _, h in heads for c in h or [] if c is not None}) if columns is None else list(columns)
    heads = spark.createDataFrame(heads, "file string, _head array<string>")
    cells = rows.where("row > 0").join(heads, "file")

    def cell(name: str) -> Column:
        at = F.array_position("_head", F.lit(name)).cast("int")
        return F.when(at > 0, F.try_element_at(F.col("cells"), F.nullif(at, F.lit(0))))

    return cells.select(*[cell(c).alias(c) for c in names])
