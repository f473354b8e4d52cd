"""Find benchmark passages in documents by spaced-seed hashing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import col, small, stored

#: Positions that count of each seed. Any 13 words in a row of which two differ contain, at some shift, all positions of one seed.
SEEDS: tuple[tuple[int, ...], ...] = ((0, 1, 4, 5, 6, 9), (0, 2, 5, 7, 8, 9))
WINDOW, EQUAL = 13, 11
#: For items of so many words, whose few shifts leave some allowed differences in both seeds, positions that those avoid, and the item's words before them.
OWN: dict[int, tuple[tuple[int, ...], int]] = {10: ((0, 1, 2, 3, 5, 6, 7), 1), 12: ((0, 3, 4, 5, 8, 10, 11), 0)}
#: Tokens that a window may have before or after a seed in it, and seeds to a piece of text.
EDGE, CHUNK = 3, 32
#: Seeds of the benchmark up to which they are broadcast; more are joined by shuffle.
BROADCAST = 200_000


def token_hashes(text: Column) -> Column:
    """Hashes of the lower-cased runs of letters and digits."""
    tokens = F.array_remove(F.split(F.lower(F.coalesce(text.cast("string"), F.lit(""))), r"[^\p{L}\p{N}]+"), "")
    return F.transform(tokens, lambda t: F.xxhash64(t))


def seeds_of(tokens: Column, mask: Sequence[int], skip: int = 0, most: int | None = None) -> Column:
    """Hash of the tokens at the mask's positions, for every shift of the mask inside the array; the others are ignored.

    The first ``skip`` tokens start no seed, nor do those after the next ``most``.
    """
    span = mask[-1] + 1
    count = F.size(tokens) - F.lit(skip + span - 1)
    count = F.least(count, F.lit(most)) if most else count
    hashed = F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.xxhash64(*[F.get(tokens, i + F.lit(skip + k)) for k in mask], F.lit(span)))
    return F.when(count > 0, hashed).otherwise(F.array().cast("array<bigint>"))


def _placed(df: DataFrame, tokens: str, masks: Sequence[Sequence[int]], *keep: str, skip: int = 0, most: int | None = None) -> DataFrame:
    """(keep, tokens, mask, at, seed): one row a seed."""
    per_mask = F.array(*[F.struct(F.lit(k).alias("mask"), seeds_of(F.col(tokens), m, skip, most).alias("seeds")) for k, m in enumerate(masks)])
    df = df.select(*keep, tokens, F.explode(per_mask).alias("m"))
    df = df.select(*keep, tokens, F.col("m.mask").alias("mask"), F.col("m.seeds").alias("seeds"))
    return df.select(*keep, tokens, "mask", F.posexplode("seeds").alias("at", "seed"))


def chunks(df: DataFrame, span: int, *keep: str) -> DataFrame:
    """(keep, tokens): pieces of CHUNK tokens with the EDGE before them and what a seed and its window may reach after them.

    Seeds carry their piece along instead of the text, so a long text costs no more a word than a short one.
    """
    wide = F.concat(F.array_repeat(F.lit(None).cast("bigint"), EDGE), F.col("tokens"))
    df = df.select(*keep, "tokens", wide.alias("wide"))
    starts = F.sequence(F.lit(0), F.greatest(F.size("tokens") - 1, F.lit(0)), F.lit(CHUNK))
    pieces = F.transform(starts, lambda c: F.slice("wide", c + 1, CHUNK + 2 * EDGE + span - 1))
    return df.select(*keep, F.explode(pieces).alias("tokens"))


def masks_for(items: DataFrame) -> list[tuple[tuple[int, ...], int, int]]:
    """(positions, words, before): the spaced seeds, for items of any length (words 0), and those used only for items of so many words.

    Below the seeds' length these are all words of the item; at 10 and 12 words there is one more, which starts ``before`` words after the item does.
    """
    least = min(m[-1] + 1 for m in SEEDS)
    lengths = items.filter((F.size("item_tokens") > 0) & (F.size("item_tokens") < WINDOW)).select(F.size("item_tokens").alias("n")).distinct()
    found = sorted(r.n for r in lengths.collect())
    return [*((m, 0, 0) for m in SEEDS), *((tuple(range(n)), n, 0) if n < least else (OWN[n][0], n, OWN[n][1]) for n in found if n < least or n in OWN)]


def benchmark_seeds(items: DataFrame, masks: Sequence[tuple[Sequence[int], int, int]]) -> DataFrame:
    """(seed, mask, left, around, item_id): the seeds of the items with the words around them, ``left`` of them before the seed.

    The seeds of a mask for items of one length are used for those only.
    """
    get = lambda values: F.get(F.array(*[F.lit(v) for v in values]), F.col("mask"))
    s = _placed(items, "item_tokens", [m for m, _, _ in masks], "item_id")
    s = s.withColumn("span", get([m[-1] + 1 for m, _, _ in masks])).withColumn("words", get([n for _, n, _ in masks])).withColumn("before", get([b for _, _, b in masks]))
    s = s.filter((F.col("words") == 0) | ((F.col("words") == F.size("item_tokens")) & (F.col("at") == F.col("before"))))
    s = s.withColumn("left", F.when(F.col("words") > 0, F.col("before")).otherwise(F.least(F.col("at"), F.lit(WINDOW) - F.col("span"))))
    around = F.slice("item_tokens", F.col("at") - F.col("left") + 1, F.when(F.col("words") > 0, F.col("words")).otherwise(F.col("left") + F.lit(WINDOW)))
    return s.select("seed", "mask", "left", around.alias("around"), "item_id")


def best_overlap(ours: Column, theirs: Column) -> Column:
    """Most equal tokens in any WINDOW aligned positions of two arrays of one length; over all of them if they are shorter."""
    same = F.transform(F.sequence(F.lit(0), F.size(theirs) - 1), lambda i: F.coalesce(F.get(ours, i) == F.get(theirs, i), F.lit(False)).cast("int"))
    wide = F.greatest(F.size(theirs) - F.lit(WINDOW), F.lit(0))
    sums = F.transform(F.sequence(F.lit(0), wide), lambda i: F.aggregate(F.slice(same, i + 1, WINDOW), F.lit(0), lambda a, x: a + x))
    return F.array_max(sums)


def _hits(docs: DataFrame, benchmark: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(doc_id, content, around, item_id, equal): every verified seed hit, with the first item that has these words; and (around, item_id) of the items.

    A passage is WINDOW words in a row of which at least EQUAL equal the item's at the same places; for an item of fewer words all
    of its words, with one difference at most per six (none below 10 words). Every passage holds a seed hit at which it is verified.
    """
    items = stored(benchmark.select("item_id", token_hashes(col("text")).alias("item_tokens")).filter("item_id is not null"), "benchmark-items")
    masks = masks_for(items)
    placed = stored(benchmark_seeds(items, masks).distinct(), "benchmark-places")
    first = placed.groupBy("seed", F.col("mask").alias("seed_mask"), "left", "around").agg(F.min("item_id").alias("item_id"))
    seeds = stored(first, "benchmark-seeds")
    texts = docs.select(col("doc_id").alias("doc_id"), F.xxhash64(F.coalesce(col("text").cast("string"), F.lit(""))).alias("content"), token_hashes(col("text")).alias("tokens"))
    pieces = chunks(texts, max(m[-1] + 1 for m, _, _ in masks), "doc_id", "content")
    hits = _placed(pieces, "tokens", [m for m, _, _ in masks], "doc_id", "content", skip=EDGE, most=CHUNK).join(small(seeds, BROADCAST), "seed").filter("mask = seed_mask")
    # what would lie before the text's start or after its end is no token, and equal to none
    ours = F.slice("tokens", F.col("at") - F.col("left") + (EDGE + 1), F.size("around"))
    hits = hits.select("doc_id", "content", "around", "item_id", ours.alias("ours"), F.size("around").alias("wide"))
    hits = hits.select("doc_id", "content", "around", "item_id", "wide", best_overlap(F.col("ours"), F.col("around")).alias("equal"))
    need = F.when(F.col("wide") >= WINDOW, EQUAL).otherwise(F.col("wide") - F.floor(F.col("wide") / 6) * (F.col("wide") >= 10).cast("int"))
    return hits.filter(F.col("equal") >= need).drop("wide"), placed.select("around", "item_id").distinct()


def passages(docs: DataFrame, benchmark: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(doc_id, content, around, equal) of the documents that hold a passage of an item, and (around, item_id) of the items.

    content is a hash of the text, around the words of the item around the passage, equal the most equal words. A passage that many items
    share is found once, by its words; which items have it tells the second table. Items that share a passage but not the words
    next to it are different words around it, and a document is listed with each: for one row a document see ``contaminated``.
    """
    found, owners = _hits(docs, benchmark)
    return found.groupBy("doc_id", "content", "around").agg(F.max("equal").alias("equal")), owners


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, content, item_id, n_hits, equal) of the documents that hold benchmark passages: the smallest item, the number of verified seed hits
    (of different words around), the most equal words.

    Hits are added up in the task that verifies them, so of a passage that many items and documents share a row a document leaves it.
    """
    found, _ = _hits(docs, benchmark)
    return found.groupBy("doc_id", "content").agg(F.min("item_id").alias("item_id"), F.count("*").alias("n_hits"), F.max("equal").alias("equal"))


def marked(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, contaminated, item_id, n_hits and n_equal per row of ``docs``: the smallest item of which the text holds a passage, the number of verified
    seed hits, and the most equal words of one.

    NULL or empty text: not contaminated. Items without a word or an id match nothing. Repeated rows are marked each, and alike; rows
    of one id with different texts each for their own. An empty benchmark marks nothing; no documents: no rows.
    """
    found = contaminated(docs, benchmark).withColumnsRenamed({"doc_id": "id", "content": "of"})
    d = docs.select(col("doc_id").alias("doc_id"), F.xxhash64(F.coalesce(col("text").cast("string"), F.lit(""))).alias("content"))
    d = d.join(found, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("content") == F.col("of")), "left")
    return d.select("doc_id", F.col("of").isNotNull().alias("contaminated"), "item_id", F.coalesce("n_hits", F.lit(0)).alias("n_hits"),
                    F.coalesce("equal", F.lit(0)).alias("n_equal"))


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` without a benchmark passage, all columns as they came."""
    found = contaminated(docs, benchmark).select(F.col("doc_id").alias("__found_id"), F.col("content").alias("__found_content"))
    content = F.xxhash64(F.coalesce(col("text").cast("string"), F.lit("")))
    return docs.join(found, col("doc_id").eqNullSafe(F.col("__found_id")) & (content == F.col("__found_content")), "left_anti")
