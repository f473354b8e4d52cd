"""Quality rules whose thresholds come from the documents: quantile sketches per language and source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martloom.llm.common import col, packed, small, stored, text_of, words

#: Characters that count as symbols.
SYMBOLS = "#*$%&|<>"
#: Feature and its slack, in thousandths: the least distance of a threshold from the tail of a group. It only decides where a tail is as good as flat.
FEATURES = {"word_length": 200, "symbols": 100, "dup_lines": 300, "repeats": 50}
#: Bins of a sketch between two powers of two.
BINS = 32
GROUPS = 100_000


def measured(docs: DataFrame) -> DataFrame:
    """(row, lang, source, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words) per row; row has all columns but the text.

    Everything is counted inside the row, over the whole text, by SQL functions; nothing is shuffled. Repeated 3-word windows
    are found by sorting (hash, position), only in texts that repeat a hash; the words they cover are counted by the
    gaps between their positions. NULL text: zeros.
    """
    chars = text_of()
    dense = F.translate(chars, " \t\n\x0b\f\r", "")
    lines = F.filter(F.split(chars, "\n"), lambda x: F.length(F.translate(x, " \t\x0b\f\r", "")) > 0)
    d = docs.select(packed(docs.drop("text")), words(chars).alias("w"), F.length(dense).alias("word_chars"), lines.alias("lines"),
                    (F.length(chars) - F.length(F.translate(chars, SYMBOLS, ""))).alias("n_symbols"))
    d = d.select("row", F.size("w").alias("n_words"), "word_chars", "n_symbols", F.size("lines").alias("n_lines"),
                 (F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
                 F.when(F.size("w") >= 3, F.transform(F.sequence(F.lit(0), F.size("w") - 3),
                        lambda i: F.xxhash64(F.get("w", i), F.get("w", i + 1), F.get("w", i + 2)))).alias("runs"))
    again = F.size(F.array_distinct("runs")) < F.size("runs")
    placed = F.sort_array(F.transform("runs", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    d = d.select(*[c for c in d.columns if c != "runs"], F.when(again, placed).alias("placed"))
    same = lambda x, k: F.coalesce(x.h == F.get("placed", k).h, F.lit(False))
    twice = F.filter("placed", lambda x, k: same(x, k - 1) | same(x, k + 1))
    start = F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last"))
    covered = F.aggregate(F.sort_array(F.transform(twice, lambda x: x.i)), start,
                          lambda a, i: F.struct((a.n + F.least(F.lit(3), i - a.last)).alias("n"), i.alias("last")))
    counts = [F.col(c).cast("long").alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines")]
    return d.select("row", F.col("row.lang").cast("string").alias("lang"), F.col("row.source").cast("string").alias("source"), *counts, F.coalesce(covered.n, F.lit(0)).cast("long").alias("n_repeat_words"))


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def features() -> dict[str, Column]:
    """Per word or line, in whole thousandths."""
    per = lambda a, b: F.when(F.col(b) > 0, F.floor(1000 * F.col(a) / F.col(b))).otherwise(0).cast("long")
    return {"word_length": per("word_chars", "n_words"), "symbols": per("n_symbols", "n_words"),
            "dup_lines": per("n_dup_lines", "n_lines"), "repeats": per("n_repeat_words", "n_words")}


def bin_of(value: Column) -> Column:
    """Lower edge of the bin: the value itself up to 2 * BINS, beyond that its leading six binary digits."""
    low = F.greatest(F.length(F.bin(value)) - F.lit((2 * BINS - 1).bit_length()), F.lit(0))
    unit = F.pow(F.lit(2.0), low)
    return (F.floor(value / unit) * unit).cast("long")


def sketches(slim: DataFrame) -> DataFrame:
    """(lang, source, feature, bin, n): one log-linear histogram a group and feature.

    Sketches are merged by adding the counts of equal bins, so they are built by partial aggregation, a group of any size costs
    some hundred rows a task, and a quantile is off by 1/32 at most.
    """
    long = F.explode(F.array(*[F.struct(F.lit(k).alias("feature"), bin_of(v).alias("bin")) for k, v in features().items()])).alias("f")
    return slim.filter(~base_failed()).select("lang", "source", long).groupBy("lang", "source", "f.feature", "f.bin").agg(F.count("*").alias("n"))


def tails(sketch: DataFrame, *by: str) -> DataFrame:
    """The lowest and highest tenth's ends (low, high), the middle (mid) and size of the merged sketch of every group: the first bins that reach 10, 50, 90 %."""
    merged = sketch.groupBy(*by, "feature", "bin").agg(F.sum("n").alias("n"))
    w = Window.partitionBy(*by, "feature")
    merged = merged.withColumn("upto", F.sum("n").over(w.orderBy("bin"))).withColumn("size", F.sum("n").over(w))
    reach = lambda k: F.min(F.when(10 * F.col("upto") >= k * F.col("size"), F.col("bin")))
    return merged.groupBy(*by, "feature").agg(F.max("size").alias("size"), reach(1).alias("low"), reach(5).alias("mid"), reach(9).alias("high"))


def spreads(sketch: DataFrame, min_group: int, reach: int) -> DataFrame:
    """(lang, source, feature, lowest, highest, floored): the range that is kept, and whether the feature's slack set an end that the sketch would set closer.

    A tail's end moves out by ``reach`` times its distance from the middle, each side by its own. A group of fewer than ``min_group``
    documents uses the merged sketch of its language, a language of fewer that of all.
    """
    own, lang, every = tails(sketch, "lang", "source").alias("o"), tails(sketch, "lang").alias("l"), tails(sketch).alias("e")
    q = (own.join(lang, F.col("o.lang").eqNullSafe(F.col("l.lang")) & (F.col("o.feature") == F.col("l.feature")))
         .join(every, F.col("o.feature") == F.col("e.feature")))
    pick = lambda c: (F.when(F.col("o.size") >= min_group, F.col(f"o.{c}"))
                      .when(F.col("l.size") >= min_group, F.col(f"l.{c}")).otherwise(F.col(f"e.{c}")))
    q = q.select("o.lang", "o.source", "o.feature", *[pick(c).alias(c) for c in ("low", "mid", "high")])
    slack = F.create_map(*[F.lit(x) for pair in FEATURES.items() for x in pair])[F.col("feature")]
    up, down = reach * (F.col("high") - F.col("mid")), reach * (F.col("mid") - F.col("low"))
    return q.select("lang", "source", "feature", (F.col("low") - F.greatest(down, slack)).alias("lowest"), (F.col("high") + F.greatest(up, slack)).alias("highest"),
                    (up < slack).alias("floored"))


def thresholds(slim: DataFrame, min_group: int, reach: int) -> DataFrame:
    """One row a (lang, source) with the highest and lowest value of every feature that is kept, see ``spreads``."""
    q = spreads(stored(sketches(slim), "quality-sketches"), min_group, reach)
    limits = [f for name in FEATURES for f in (F.max(F.when(F.col("feature") == name, F.col("highest"))).alias(f"{name}_high"),
                                               F.max(F.when(F.col("feature") == name, F.col("lowest"))).alias(f"{name}_low"))]
    return stored(q.groupBy("lang", "source").agg(*limits), "quality-thresholds")


def judge(docs: DataFrame, *, min_group: int = 50, reach: int = 5) -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed and kept.

    A document that passes the base rules is kept unless one of its features (characters and symbols per word, shares of
    repeated lines and of words in repeated windows) lies beyond the outer tenth of its language and source by more than ``reach``
    times the distance of that tenth from the middle and by more than the feature's slack. Only documents that pass the base rules shape the thresholds.

    NULL language or source: a group of its own. NULL or blank text: zeros, base_failed. Repeated rows are judged each, and
    alike. A group without any document that passes the base rules has no thresholds and keeps none. Empty table: no rows.
    Input columns with the name of a new column are replaced; all others but the text, which is read only once, pass through.
    """
    new = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    slim = stored(measured(docs.select(*[col(c) for c in docs.columns if c not in new])), "quality-measures")
    t = small(thresholds(slim, min_group, reach), GROUPS).withColumnsRenamed({"lang": "of_lang", "source": "of_source"})
    fine = F.lit(True)
    for name, value in features().items():
        fine = fine & value.between(F.col(f"{name}_low"), F.col(f"{name}_high"))
    out = slim.join(t, F.col("lang").eqNullSafe(F.col("of_lang")) & F.col("source").eqNullSafe(F.col("of_source")), "left")
    kept = ~base_failed() & F.coalesce(fine, F.lit(False))
    return out.select("row.*", *new[:5], base_failed().alias("base_failed"), kept.alias("kept"))
