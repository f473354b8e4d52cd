"""Toxicity by a weighted lexicon, matched by Aho-Corasick over folded text."""

from __future__ import annotations

import math
import re
import unicodedata
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.llm.common import col, packed, remainder, stored, text_of, words
from martloom.llm.simhash import shingle_hashes

#: Look-alike letters and the Latin letter each stands for; fixed values.
HOMOGLYPHS = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ѕ": "s", "ј": "j", "ԁ": "d", "һ": "h", "ӏ": "l", "ԛ": "q", "ԝ": "w",
    "α": "a", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ɡ": "g", "ı": "i", "ℓ": "l",
}
#: Digits and signs written for letters; fixed values.
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a"}
_FOLD = str.maketrans({**{chr(c): " " for c in range(128) if not chr(c).isalnum()}, **HOMOGLYPHS, **DIGITS})
_WORD = re.compile(r"[^ ]+")
SHORTEST, LONGEST = 4, 12


def fold(text: str | None) -> str:
    """Lower case, compatibility forms, look-alikes and digits as Latin letters, ASCII punctuation as blanks; a blank at both ends."""
    text = text or ""
    if not unicodedata.is_normalized("NFKC", text):
        text = unicodedata.normalize("NFKC", text)
    return f" {text.lower().translate(_FOLD)} "


def patterns_of(words: Iterable[str]) -> set[str]:
    """Beginnings of words (a blank before) and whole words (a blank on both sides)."""
    found = set()
    for w in words:
        found.add(f" {w} ")
        found.update(f" {w[:k]}" for k in range(SHORTEST, min(len(w), LONGEST) + 1))
    return found


@dataclass
class Lexicon:
    """Weights of patterns, phrases in which a pattern does not count, and the weights of the score's features."""

    weights: dict[str, float] = field(default_factory=dict)
    exceptions: list[str] = field(default_factory=list)
    model: tuple[float, ...] = (-4.0, 0.0, 0.0)

    def automaton(self) -> ahocorasick.Automaton | None:
        a = ahocorasick.Automaton()
        for p, w in self.weights.items():
            a.add_word(p, (len(p), w))
        for p in self.exceptions:
            if p not in self.weights:
                a.add_word(p, (len(p), 0.0))
        if not len(a):
            return None
        a.make_automaton()
        return a


def hits(automaton: ahocorasick.Automaton | None, text: str) -> list[tuple[int, int, float]]:
    """(start, end, weight) of the matches in a folded text that do not lie inside an exception phrase."""
    if automaton is None:
        return []
    found, free = [], []
    for end, (size, weight) in automaton.iter(text):
        (found if weight else free).append((end + 1 - size, end + 1, weight))
    if free:
        found = [h for h in found if not any(s <= h[0] and h[1] <= e for s, e, _ in free)]
    return found


def features(automaton: ahocorasick.Automaton | None, text: str | None) -> tuple[float, float, float]:
    """1, the weight of all matches, and the same per hundred words, both on a log scale."""
    folded = fold(text)
    total = sum(h[2] for h in hits(automaton, folded))
    if not total:
        return 1.0, 0.0, 0.0
    return 1.0, math.log1p(total), math.log1p(100 * total / (len(folded.split()) + 10))


def score(model: tuple[float, ...], x: tuple[float, ...]) -> float:
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, sum(a * b for a, b in zip(model, x))))))


def _count(make: Callable[[str], Iterable[str]]) -> Callable:
    """Weight of the documents of each label that have a string made of their text, one row a string and batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: tuple[dict[str, float], dict[str, float]] = (defaultdict(float), defaultdict(float))
            for text, toxic, weight in zip(*(batch.column(c).to_pylist() for c in ("text", "toxic", "weight"))):
                for key in set(make(fold(text))):
                    seen[toxic][key] += weight
            keys = sorted(seen[0].keys() | seen[1].keys())
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.string()), *(pa.array([seen[k].get(key, 0.0) for key in keys], pa.float64()) for k in (1, 0))], ["pattern", "toxic", "clean"])
    return run


COUNTS = "pattern string, toxic double, clean double"


def labelled(docs: DataFrame, labels: DataFrame, per_label: int) -> tuple[DataFrame, int, int]:
    """(text, toxic, weight) of at most ``per_label`` texts of each label, by hash of the id, of rows with crc32(id) mod 4 other than 2; and how many rows
    there are of each.

    No row of the sample is left out. Copies of a text and most near copies, which share both its smallest and its largest hash of 3-word runs, together weigh
    as much as one text, each the same. Of unlike texts with a line in common few share both; those weigh less, but count.
    """
    ids = (labels.filter(col("doc_id").isNotNull() & col("toxic").isin(0, 1) & (remainder("doc_id", 4) != 2))
           .groupBy(col("doc_id").alias("doc_id")).agg(F.max(col("toxic").cast("int")).alias("toxic")))
    n = {r.toxic: r.n for r in ids.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    part = [ids.filter(F.col("toxic") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_label) for k in (0, 1)]
    # at most 2 * per_label ids: a bound that holds whatever the tables' size
    texts = docs.select(col("doc_id").alias("doc_id"), text_of().alias("text")).join(F.broadcast(part[0].union(part[1])), "doc_id").select("text", "toxic")
    hashed = texts.select("text", "toxic", words(F.col("text")).alias("tokens")).select("text", "toxic", shingle_hashes(F.col("tokens"), 3).alias("h"))
    size = F.count("*").over(Window.partitionBy("toxic", F.array_min("h"), F.array_max("h")))
    weighed = hashed.select("text", "toxic", (1 / size).alias("weight"))
    return stored(weighed, "toxicity-sample"), n.get(1, 0), n.get(0, 0)


def prune(found: dict[str, tuple[float, float]]) -> dict[str, float]:
    """Weights of the patterns that are left when, of two of which one begins with the other, the longer goes if it is found in clearly
    fewer toxic texts, and else the shorter, which would also match other words."""
    gone = set()
    for p, (_, n) in found.items():
        for q in (p[:k] for k in range(SHORTEST + 1, len(p)) if p[:k] in found):
            gone.add(p if n < 0.8 * found[q][1] and found[q][0] >= found[p][0] - 0.7 else q)
    return {p: w for p, (w, _) in found.items() if p not in gone}


def learn(docs: DataFrame, labels: DataFrame, *, per_label: int = 3000, max_patterns: int = 20_000, significance: float = 25.0) -> Lexicon:
    """A lexicon from at most ``per_label`` labelled texts of each label.

    Patterns are counted on the executors by documents, copies by their weight; one is a candidate if its likelihood ratio against chance reaches
    ``significance`` and it is likelier in toxic texts, and its weight is the log odds. Of
    two beginnings of one word only one is kept. Word pairs around a match that are likelier in clean texts become exceptions. The
    two features are weighed by logistic regression, each label at its share of all labelled rows. Without both labels there is nothing to
    learn, and every score is low.
    """
    texts, n_toxic, n_clean = labelled(docs, labels, per_label)
    if not n_toxic or not n_clean:
        return Lexicon()
    held = {r.toxic: r.w for r in texts.groupBy("toxic").agg(F.sum("weight").alias("w")).collect()}
    t_all, c_all = held.get(1, 0.0), held.get(0, 0.0)
    if not t_all or not c_all:
        return Lexicon()
    counts = texts.mapInArrow(_count(lambda text: patterns_of(_WORD.findall(text))), COUNTS).groupBy("pattern").agg(F.sum("toxic").alias("t"), F.sum("clean").alias("c"))
    share = F.lit(t_all / (t_all + c_all))
    both = F.col("t") + F.col("c")
    part = lambda x, p: F.when(x > 0, x * F.log(x / (both * p))).otherwise(0.0)
    weight = F.log((F.col("t") + 0.5) / (t_all + 1) / ((F.col("c") + 0.5) / (c_all + 1)))
    ratio = 2 * (part(F.col("t"), share) + part(F.col("c"), 1 - share))
    rows = (counts.withColumn("w", weight).withColumn("llr", ratio).filter((F.col("llr") >= significance) & (F.col("w") > 1.5))
            .orderBy(F.desc("llr"), "pattern").limit(max_patterns).select("pattern", "w", "t").collect())
    chosen = prune({r.pattern: (r.w, r.t) for r in rows})
    lexicon = Lexicon(chosen)
    if not chosen:
        return lexicon

    def pairs(text: str) -> Iterator[str]:
        for start, end, _ in hits(lexicon.automaton(), text):
            end = text.index(" ", max(end - 1, start + 1))
            before, after = text.rfind(" ", 0, start), text.find(" ", end + 1)
            if before >= 0 and before < start - 1:
                yield text[before:end + 1]
            if after > end + 1:
                yield text[start:after + 1]

    seen = texts.mapInArrow(_count(pairs), COUNTS).groupBy("pattern").agg(F.sum("toxic").alias("t"), F.sum("clean").alias("c"))
    free = seen.filter((F.col("c") >= 3) & (F.col("c") * t_all > 3 * F.col("t") * c_all)).orderBy(F.desc("c"), "pattern").limit(max_patterns)
    lexicon.exceptions = [r.pattern for r in free.collect()]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = lexicon.automaton()
        for batch in batches:
            x = np.array([features(automaton, t) for t in batch.column("text").to_pylist()]).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays([pa.array(x[:, 1]), pa.array(x[:, 2]), batch.column("toxic"), batch.column("weight")], ["a", "b", "toxic", "weight"])

    # two numbers for each of at most 2 * per_label texts
    data = np.array(sorted(tuple(r) for r in texts.mapInArrow(measure, "a double, b double, toxic int, weight double").collect()), dtype=float).reshape(-1, 4)
    y = data[:, 2]
    weights = data[:, 3] * np.where(y == 1, n_toxic / t_all, n_clean / c_all)
    lexicon.model = fit(np.column_stack([np.ones(len(y)), data[:, :2]]), y, weights / weights.sum() * len(y))
    return lexicon


def fit(x: np.ndarray, y: np.ndarray, weights: np.ndarray, ridge: float = 0.5) -> tuple[float, ...]:
    """Logistic regression by Newton steps; the ridge keeps it finite where the labels can be told apart."""
    beta = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = x.T @ (weights * (p - y)) + ridge * beta
        curve = (x * (weights * np.maximum(p * (1 - p), 1e-9))[:, None]).T @ x + ridge * np.eye(len(beta))
        step = np.linalg.solve(curve, slope)
        beta -= np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(b) for b in beta)


def scored(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """(row, score): the input row as a struct and its score between 0 and 1; the whole text is matched, NULL counts as empty."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = lexicon.automaton()
        for batch in batches:
            s = [score(lexicon.model, features(automaton, t)) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(s, pa.float64())], ["row", "score"])

    wide = docs.select(packed(docs), text_of().alias("text"))
    return wide.mapInArrow(run, T.StructType([wide.schema["row"], T.StructField("score", T.DoubleType())]))


def judge(docs: DataFrame, labels: DataFrame, *, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score and predicted (0 or 1) per row of ``docs``, by a lexicon learned from ``labels`` (doc_id, toxic).

    Labels of held-out ids, of no document, NULL or other than 0 and 1 teach nothing; an id that is labelled twice counts as
    toxic if any label says so. NULL or empty text: the score of a text without a match. Repeated rows are scored each.
    No labels: all scores low. No documents: no rows. Only doc_id and text are read.
    """
    found = scored(docs.select(col("doc_id"), col("text")), learn(docs, labels)).select("row.doc_id", "score")
    return found.select("doc_id", (remainder("doc_id", 4) == 2).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def clean(docs: DataFrame, labels: DataFrame, *, threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, all columns as they came."""
    return scored(docs, learn(docs, labels)).filter(F.col("score") < threshold).select("row.*")
