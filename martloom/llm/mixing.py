"""Mix sources to target weights by Pareto order sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martloom.llm.common import BLANKS, col, packed, small, stored, text_of

#: Rows of the per-source tables up to which they are broadcast; more sources than this join by shuffle.
SOURCES = 100_000
#: A score is kept in thousandths, so that its sums are exact in any order.
GRAIN = 1000


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(BLANKS.replace("[", "[^", 1))).cast("long")


def targets(sized: DataFrame, share: float, weights: Sequence[int], max_copies: int) -> DataFrame:
    """Words to take of each source: (source, source_size, target).

    ``share`` times all words is dealt out by weight; a source stops at ``max_copies`` times its words and the rest
    goes to the others by weight. In the order of cap to weight, the sources before the first one below its cap are the
    full ones, so one running sum finds the level that all others share. One row per source.
    """
    every = Window.partitionBy()
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), ((F.col("rank") - 1) % len(weights) + 1).cast("int"))
    s = (sized.groupBy("source").agg(F.sum("size").alias("source_size"))
         .withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
         .withColumn("weight", weight.cast("double"))
         .withColumn("cap", (F.col("source_size") * F.lit(max_copies)).cast("double"))
         .withColumn("ratio", F.col("cap") / F.col("weight")))
    order = Window.orderBy("ratio", "rank")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rest = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = (F.lit(share) * F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(rest)
    s = s.withColumn("level", level).withColumn("full", F.col("ratio") <= F.col("level"))
    s = s.withColumn("tau", F.max(F.when(~F.col("full"), F.col("level"))).over(every))
    return s.select("source", "source_size", F.when(F.col("full"), F.col("cap")).otherwise(F.col("weight") * F.col("tau")).alias("target"))


def default_score(size: Column) -> Column:
    """Thousandths: 1000 for no words, 500 at 1000 words, falling with the length."""
    return F.floor(F.lit(GRAIN * GRAIN) / (size + F.lit(GRAIN))).cast("long")


def uniform(doc_id: Column, seed: str) -> Column:
    """A number strictly between 0 and 1 that depends on the id and the seed only."""
    digits = F.substring(F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("null")), F.lit(seed)).cast("binary")), 1, 13)
    return (F.conv(digits, 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(1 << 52))


def mix(docs: DataFrame, *, share: float = 1.5, weights: Sequence[int] = (3, 1, 2), max_copies: int = 2, bins: int = 4096,
        seed: str = ":mix") -> DataFrame:
    """``docs`` with size, source_size, target, copies and taken (= copies * size).

    Every document of a source first gets the whole copies that all of them get, floor(target / source_size). What is
    left of the target is drawn in Pareto order: a document with inclusion probability p and random u has the rank
    (u / (1 - u)) / (p / (1 - p)), kept as rank / (1 + rank), and the lowest ranks are taken as long as they fit into the rest
    of the target. The one document of the others whose size comes nearest to the gap that is left closes the sample, if it
    makes the gap smaller; so the sample has a fixed size in words.
    p is f + f (1 - f) (score - mean score), where f is the fraction left and the mean is weighted by size: it stays
    between 0 and 1, the expected words are f of the source, and documents with a high score (the short ones) are likelier.

    A running sum over ranks would put a source into one task. Words are summed by (source, rank bin) first; the bins say
    where the target is reached, and only the rows of that one bin per source are ordered. The texts are not shuffled.

    NULL text or no word: size 0, never drawn beyond the whole copies, taken 0. NULL source: a source, the last one. NULL
    id: counts as the text "null". Rows of one id and source have one rank and are drawn or left together. Empty table: no
    rows. Input columns with the name of a new column are replaced; all others pass through.
    """
    new = ("size", "source_size", "target", "copies", "taken")
    kept = docs.select(*[col(c) for c in docs.columns if c not in new])
    wide = kept.select(packed(kept), col("doc_id").alias("id"), col("source").cast("string").alias("source"), word_count(text_of()).alias("size"))
    slim = stored(wide.select("id", "source", "size", default_score(F.col("size")).alias("score")), "mix-sizes")
    means = slim.groupBy("source").agg(F.sum(F.col("size") * F.col("score")).alias("scored"))
    goal = targets(slim, share, weights, max_copies).alias("t").join(means.alias("m"), F.col("t.source").eqNullSafe(F.col("m.source")))
    repeat = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    goal = (goal.select("t.source", "source_size", "target", "scored", repeat.alias("repeat"))
            .withColumn("whole", F.floor("repeat").cast("long"))
            .withColumn("f", F.col("repeat") - F.col("whole"))
            .withColumn("need", F.col("target") - F.col("whole") * F.col("source_size"))
            .withColumn("mean", F.when(F.col("source_size") > 0, F.col("scored") / F.col("source_size") / GRAIN).otherwise(F.lit(0.0))))
    goal = stored(goal.drop("scored", "repeat"), "mix-targets")

    def ranked(df: DataFrame, score: Column) -> DataFrame:
        g = small(goal.withColumnRenamed("source", "of"), SOURCES)
        p = F.col("f") + F.col("f") * (1 - F.col("f")) * (score / F.lit(float(GRAIN)) - F.col("mean"))
        df = df.join(g, F.col("source").eqNullSafe(F.col("of"))).drop("of")
        df = df.withColumn("u", uniform(F.col("id"), seed)).withColumn("p", p)
        df = df.withColumn("rank", (F.col("u") / (1 - F.col("u"))) * F.try_divide(1 - F.col("p"), F.col("p")))
        open_ = (F.col("f") > 0) & (F.col("size") > 0)
        df = df.withColumn("rank", F.when(open_, F.col("rank") / (1 + F.col("rank"))))
        return df.withColumn("bin", F.floor(F.col("rank") * bins).cast("int"))

    drawn = ranked(slim, F.col("score")).filter(F.col("rank").isNotNull())
    run = Window.partitionBy("source").orderBy("bin")
    per_bin = drawn.groupBy("source", "bin").agg(F.sum("size").alias("n"), F.first("need").alias("need"))
    per_bin = per_bin.withColumn("upto", F.sum("n").over(run)).withColumn("base", F.col("upto") - F.col("n"))
    edge = stored(per_bin.filter((F.col("base") <= F.col("need")) & (F.col("need") < F.col("upto")))
                  .select(F.col("source").alias("of"), F.col("bin").alias("edge"), "base"), "mix-edges")
    inner = Window.partitionBy("source").orderBy("rank", "id")
    # rows of one rank and id count as one unit: the default frame takes them together
    units = (drawn.join(small(edge, SOURCES), F.col("source").eqNullSafe(F.col("of")) & (F.col("bin") == F.col("edge")))
             .groupBy("source", "rank", "id").agg(F.sum("size").alias("n"), F.first("need").alias("need"), F.first("base").alias("base"))
             .withColumn("upto", F.col("base") + F.sum("n").over(inner)))
    cut = units.groupBy("source").agg(
        F.max(F.when(F.col("upto") <= F.col("need"), F.struct("rank", "id"))).alias("last"),
        F.first("need").alias("need"), F.coalesce(F.max(F.when(F.col("upto") <= F.col("need"), F.col("upto"))), F.first("base")).alias("reached"))
    gap = (F.col("need") - F.col("reached")).alias("gap")
    bounds = edge.join(cut, F.col("of").eqNullSafe(F.col("source")), "left").select("of", "edge", "last", gap)
    bounds = stored(bounds, "mix-bounds")

    def placed(df: DataFrame, bounds: DataFrame) -> DataFrame:
        inside = (F.col("bin") < F.col("edge")) | ((F.col("bin") == F.col("edge")) & F.coalesce(F.struct("rank", "id") <= F.col("last"), F.lit(False)))
        df = df.join(small(bounds, SOURCES), F.col("source").eqNullSafe(F.col("of")), "left").drop("of")
        return df.withColumn("inside", F.coalesce(F.col("rank").isNotNull() & inside, F.lit(False)))

    off = F.abs(F.col("gap") - F.col("size"))
    closing = (placed(drawn, bounds).filter(~F.col("inside") & (off < F.col("gap"))).groupBy("source")
               .agg(F.min(F.struct(off.alias("off"), F.col("rank"), F.col("id"))).alias("closing")).withColumnRenamed("source", "closed"))
    bounds = bounds.join(closing, F.col("of").eqNullSafe(F.col("closed")), "left")
    bounds = stored(bounds.select("of", "edge", "last", "gap", "closing.rank", "closing.id").withColumnsRenamed({"rank": "end_rank", "id": "end_id"}), "mix-ends")
    out = placed(ranked(wide, default_score(F.col("size"))), bounds)
    last = (F.col("rank") == F.col("end_rank")) & F.col("id").eqNullSafe(F.col("end_id"))
    copies = (F.col("whole") + (F.col("inside") | F.coalesce(last, F.lit(False))).cast("long")).alias("copies")
    return out.select("row.*", "size", "source_size", "target", copies).withColumn("taken", F.col("copies") * F.col("size"))
