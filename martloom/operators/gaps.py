"""What is missing of numbered things: pages that were not fetched, ids that a table does not have."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

#: Numbers that are looked at together.
BLOCK = 4096


def missing_ranges(found: DataFrame, wanted: DataFrame, by: str, number: str, block: int = BLOCK) -> DataFrame:
    """(``by``, ``first``, ``last``, ``n_missing``): the runs of numbers from ``low`` to ``high`` that are not found, one row a run.

    ``wanted`` has ``by``, ``low`` and ``high``. Numbers are looked at in blocks, which are spread over tasks, so one long row of numbers
    is no task's alone and a block without any number costs one row; runs that meet at the edge of a block are joined afterwards.
    """
    size = F.lit(block).cast("bigint")
    edges = wanted.where("low <= high").select(by, "low", "high", F.explode(F.sequence(F.floor(F.col("low") / size), F.floor(F.col("high") / size))).alias("_b"))
    edges = edges.select(by, "_b", F.greatest("low", F.col("_b") * size).alias("_low"), F.least("high", (F.col("_b") + 1) * size - 1).alias("_high"))
    seen = found.where(F.col(number).isNotNull()).select(F.col(by).alias("_by"), F.floor(F.col(number) / size).alias("_fb"), F.col(number).cast("bigint").alias("_n"))
    seen = seen.groupBy("_by", "_fb").agg(F.collect_set("_n").alias("_seen"))  # at most ``block`` numbers
    held = edges.join(seen, F.col(by).eqNullSafe(F.col("_by")) & (F.col("_b") == F.col("_fb")), "left")
    inside = F.filter(F.coalesce("_seen", F.array().cast("array<bigint>")), lambda n: n.between(F.col("_low"), F.col("_high")))
    marks = held.select(by, F.concat(F.array(F.col("_low") - 1), F.array_sort(inside), F.array(F.col("_high") + 1)).alias("_m"))
    runs = F.transform(F.sequence(F.lit(1), F.size("_m") - 1), lambda i: F.struct((F.get("_m", i - 1) + 1).alias("first"), (F.get("_m", i) - 1).alias("last")))
    runs = marks.select(by, F.inline(F.filter(runs, lambda r: r["first"] <= r["last"])))
    order = W.partitionBy(by).orderBy("first")
    joined = runs.withColumn("_new", (F.col("first") != F.lag("last", 1).over(order) + 1).cast("int")).withColumn("_run", F.sum(F.coalesce("_new", F.lit(1))).over(order))
    out = joined.groupBy(by, "_run").agg(F.min("first").alias("first"), F.max("last").alias("last"))
    return out.select(by, "first", "last", (F.col("last") - F.col("first") + 1).alias("n_missing"))


def missing_pages(pages: DataFrame, totals: DataFrame, by: str, start: str = "start", size: int = 50) -> DataFrame:
    """Runs of pages that did not land: ``pages`` has the offset each page begins at, ``totals`` (``by``, ``n_source``) the declared records.

    ``first`` and ``last`` number the pages of ``size`` records from 0.
    """
    found = pages.select(by, F.floor(F.col(start) / F.lit(size)).alias("_page"))
    wanted = totals.select(by, F.lit(0).cast("bigint").alias("low"), (F.ceil(F.col("n_source") / F.lit(size)) - 1).alias("high"))
    return missing_ranges(found, wanted, by, "_page")
