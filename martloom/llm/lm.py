"""Log probabilities of texts under a hidden Markov language model."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import ascii_lower, col, remainder, stored, text_of, words

#: Tokens that are not symbols of their own share one of so many symbols, by a hash of their last bytes.
CLASSES, TAIL = 256, 3
#: Training sequences are pieces of so many tokens.
PIECE, ROWS = 256, 1024
END = ""  # no word is empty


def class_of(token: Column) -> Column:
    return (F.crc32(F.substring(token.cast("binary"), -TAIL, TAIL)) % CLASSES).cast("int")


def token_class(token: bytes) -> int:
    return zlib.crc32(token[-TAIL:]) % CLASSES


def lowered(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, text): the text with A-Z lowered; NULL text is empty."""
    return docs.select(col("doc_id").alias("doc_id"), (remainder("doc_id", 7) == 2).alias("held_out"), ascii_lower(text_of()).alias("text"))


def token_counts(docs: DataFrame) -> DataFrame:
    """(token, c) over all training texts, the end of a text being a token; counted by partial aggregation."""
    each = F.explode(F.concat(words(F.col("text")), F.array(F.lit(END)))).alias("token")
    return lowered(docs).filter("not held_out").select(each).groupBy("token").agg(F.count("*").alias("c"))


def least_count(counts: DataFrame, most: int) -> int:
    """A count such that at most ``most`` tokens have it or more; found from a histogram of counts on a log scale."""
    level = F.floor(F.log2("c") * 8).cast("int")
    rows = sorted(counts.groupBy(level.alias("level")).agg(F.count("*").alias("n"), F.min("c").alias("c")).collect(), key=lambda r: -r.level)
    total, least = 0, None
    for r in rows:
        total += r.n
        if total > most:
            break
        least = r.c
    return least if least is not None else (rows[0].c + 1 if rows else 1)


class Model:
    """Start, transition and emission probabilities of ``states`` states over ``symbols`` symbols."""

    def __init__(self, states: int, frequencies: np.ndarray, seed: int = 5) -> None:
        rng = np.random.default_rng(seed)
        near = lambda *shape: 1 + 0.5 * rng.random(shape)
        self.start = near(states) / near(states).sum()
        self.start /= self.start.sum()
        self.move = near(states, states) + 4 * np.eye(states)
        self.move /= self.move.sum(axis=1, keepdims=True)
        # states start as different tilts of the symbol frequencies
        self.emit = frequencies[None] * np.exp(rng.normal(0, 1, (states, len(frequencies))))
        self.emit /= self.emit.sum(axis=1, keepdims=True)

    @property
    def flat_size(self) -> int:
        k, s = self.emit.shape
        return k + k * k + k * s

    def reestimated(self, sums: np.ndarray, frequencies: np.ndarray) -> None:
        """New probabilities from expected counts; each row gets one more count spread over what is known of it."""
        k, s = self.emit.shape
        start, move, emit = sums[:k] + 1 / k, sums[k:k + k * k].reshape(k, k) + 1 / k, sums[k + k * k:].reshape(k, s) + frequencies[None]
        self.start, self.move, self.emit = start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=1, keepdims=True)


def expected(model: Model, pieces: list[np.ndarray], first: list[bool], sums: np.ndarray) -> None:
    """Add the expected starts, moves and emissions of the pieces, by scaled forward and backward passes over all of them at once.

    A piece that continues a text starts from the average of the states, and its start is not counted as a start of a text.
    """
    k, s = model.emit.shape
    order = sorted(range(len(pieces)), key=lambda i: -len(pieces[i]))
    sizes = np.array([len(pieces[i]) for i in order])
    x = np.zeros((len(order), sizes[0]), np.int64)
    for r, i in enumerate(order):
        x[r, :sizes[r]] = pieces[i]
    starts = np.array([first[i] for i in order])
    average = np.full(k, 1 / k) @ np.linalg.matrix_power(model.move, 64)
    by_symbol = np.ascontiguousarray(model.emit.T)
    alphas, scales, live = [], [], []
    a = np.where(starts[:, None], model.start, average)
    for t in range(sizes[0]):
        n = int(np.searchsorted(-sizes, -t, side="left"))  # rows longer than t
        a = (a[:n] @ model.move if t else a[:n]) * by_symbol[x[:n, t]]
        c = a.sum(axis=1, keepdims=True)
        a = a / c
        alphas.append(a)
        scales.append(c)
        live.append(n)
    move, emit = np.zeros((k, k)), np.zeros((s, k))
    b = np.ones((live[-1], k))
    seen_x, seen_g = [], []
    for t in range(sizes[0] - 1, -1, -1):
        if len(b) < live[t]:
            b = np.concatenate([b, np.ones((live[t] - len(b), k))])
        seen_x.append(x[:live[t], t])
        seen_g.append(alphas[t] * b)
        if t:
            weighted = by_symbol[x[:live[t], t]] * b / scales[t]
            move += alphas[t - 1][:live[t]].T @ weighted
            b = weighted @ model.move.T
    sx, sg = np.concatenate(seen_x), np.concatenate(seen_g)
    for j in range(k):
        emit[:, j] = np.bincount(sx, weights=sg[:, j], minlength=s)
    sums[:k] += seen_g[-1][starts].sum(axis=0)
    sums[k:k + k * k] += (move * model.move).ravel()
    sums[k + k * k:] += emit.T.ravel()


def log_likelihoods(model: Model, texts: list[np.ndarray]) -> np.ndarray:
    """Natural log of the probability of each symbol sequence: the scaled forward recursion over whole texts."""
    order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
    sizes = np.array([len(texts[i]) for i in order])
    flat = np.concatenate([texts[i] for i in order])
    begin = np.cumsum(sizes) - sizes
    by_symbol = np.ascontiguousarray(model.emit.T)
    out, a = np.zeros(len(texts)), np.tile(model.start, (len(texts), 1))
    for t in range(sizes[0]):
        n = int(np.searchsorted(-sizes, -t, side="left"))
        a = (a[:n] @ model.move if t else a[:n]) * by_symbol[flat[begin[:n] + t]]
        c = a.sum(axis=1)
        a = a / c[:, None]
        out[:n] += np.log(c)
    result = np.empty(len(texts))
    result[order] = out
    return result


class Vocabulary:
    """Frequent tokens: symbol and count of each; symbol k < own for the first ones, then one a class, the end being the last."""

    def __init__(self, rows: list[tuple[str, int]], own: int) -> None:
        tokens = [t.encode("utf-8", "replace") for t, _ in rows]
        self.own = min(own, len(rows))
        self.place = dict(zip(tokens, range(len(rows))))
        self.symbol = np.array([i if i < self.own else self.own + token_class(t) for i, t in enumerate(tokens)] + [-1], np.int64)
        self.count = np.array([n for _, n in rows] + [0], np.int64)
        self.symbols = self.own + CLASSES + 1

    def encode(self, tokens: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        """Symbols of a text's tokens and its end, the count of every token (0 if it is not frequent), and the tokens that are not."""
        at = np.fromiter(map(self.place.get, tokens, repeat(-1)), np.int64, len(tokens))
        symbols = np.append(self.symbol[at], self.symbols - 1)
        lost = np.nonzero(at < 0)[0]
        rare = [tokens[i] for i in lost.tolist()]
        symbols[lost] = np.fromiter(map(token_class, rare), np.int64, len(rare)) + self.own
        return symbols, self.count[at], rare


def scores(docs: DataFrame, *, states: int = 8, own: int = 4096, frequent: int = 200_000, rounds: int = 4) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score (log10) per row of ``docs``.

    Tokens of all training texts are counted. The ``own`` most frequent are symbols of the hidden Markov model; every other token is a
    symbol of its ending's class, and is drawn from it by (c + 1) / (class count + class tokens + 1). ``rounds`` of Baum-Welch run over all training
    texts, each partition adding up expected counts, which Spark sums; the score of a text is the exact probability of its
    symbols, end included, by the scaled forward recursion, times those of the tokens within their symbols.

    Of the vocabulary, at most ``frequent`` tokens travel to the tasks; the other tokens of a text meet their counts in a join, so a
    vocabulary of any size is used whole.

    NULL or blank text: the end alone. A NULL id counts as a training text. Repeated rows are scored, and counted, each. No
    training text: counts of zero, and a model that knows nothing but the classes. No documents: no rows.
    """
    spark = docs.sparkSession
    counts = stored(token_counts(docs), "lm-counts")
    least = least_count(counts, frequent)
    known = counts.filter((F.col("c") >= least) & (F.col("token") != END))
    rows = sorted(((r.token, r.c) for r in known.collect()), key=lambda r: (-r[1], r[0]))
    total = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v"),
                       F.coalesce(F.max(F.when(F.col("token") == END, F.col("c"))), F.lit(0)).alias("ends")).first()
    # counts and tokens of the classes: all tokens by class, less those that are symbols of their own
    by_class = counts.filter(F.col("token") != END).groupBy(class_of(F.col("token")).alias("k")).agg(F.sum("c").alias("c"), F.count("*").alias("v"))
    mass, sorts = np.zeros(CLASSES), np.zeros(CLASSES)
    for r in by_class.collect():
        mass[r.k], sorts[r.k] = r.c, r.v
    chosen = rows[:own]
    for t, n in chosen:
        mass[token_class(t.encode("utf-8", "replace"))] -= n
        sorts[token_class(t.encode("utf-8", "replace"))] -= 1
    frequencies = np.array([n for _, n in chosen] + list(mass) + [total.ends], float) + 0.5
    frequencies /= frequencies.sum()
    inside = np.log10(mass + sorts + 1)
    # plain tuples: a broadcast does not carry classes of this package
    shared = spark.sparkContext.broadcast((rows, own))
    texts = lowered(docs)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = Vocabulary(*shared.value)
        for batch in batches:
            out: tuple[list, ...] = ([], [], [], [], [], [])
            for raw in batch.column("text").cast(pa.binary()).to_pylist():
                # bytes.split() divides at the blanks of a word's definition, and at no others
                symbols, c, rare = v.encode(raw.split())
                classes = symbols[:-1] - v.own
                logs = np.log10(c + 1)
                within = logs[classes >= 0].sum() - inside[classes[classes >= 0]].sum()
                for column, value in zip(out, (len(symbols), int((c > 0).sum()) + (total.ends > 0), float(logs.sum()) + math.log10(total.ends + 1), float(within),
                                               symbols.astype(np.uint16 if v.symbols < 1 << 16 else np.uint32).tobytes(), rare)):
                    column.append(value)
            kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.binary(), pa.list_(pa.binary()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), *[pa.array(x, k) for x, k in zip(out, kinds)]],
                                             ["doc_id", "held_out", "n_tokens", "n_known", "base", "within", "symbols", "rare"])

    kind = texts.schema["doc_id"].dataType.simpleString()
    coded = texts.mapInArrow(encode, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, base double, within double, symbols binary, rare array<binary>")
    coded = stored(coded.withColumn("row", F.monotonically_increasing_id()), "lm-rows")
    width = np.uint16 if len(frequencies) < 1 << 16 else np.uint32
    model = Model(states, frequencies)

    for _ in range(rounds):
        now = model

        def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums, pieces, first = np.zeros(now.flat_size), [], []
            for batch in batches:
                for raw in batch.column("symbols").to_pylist():
                    symbols = np.frombuffer(raw, width)
                    for at in range(0, len(symbols), PIECE):
                        pieces.append(symbols[at:at + PIECE])
                        first.append(at == 0)
                    if len(pieces) >= ROWS:
                        expected(now, pieces, first, sums)
                        pieces, first = [], []
            if pieces:
                expected(now, pieces, first, sums)
            at = np.nonzero(sums)[0]
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(sums[at], pa.float64())], ["at", "n"])

        parts = coded.filter("not held_out").select("symbols").mapInArrow(add_up, "at long, n double")
        sums = np.zeros(model.flat_size)
        for r in parts.groupBy("at").agg(F.sum("n").alias("n")).collect():
            sums[r["at"]] = r["n"]
        model.reestimated(sums, frequencies)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, len(batch), ROWS):
                part = batch.slice(lo, ROWS)
                found = log_likelihoods(model, [np.frombuffer(raw, width) for raw in part.column("symbols").to_pylist()]) / math.log(10)
                yield pa.RecordBatch.from_arrays([part.column("row"), pa.array(found)], ["row", "hidden"])

    # what a text's own columns hold comes along by number: both sides are read from the stored table
    hidden = coded.select("row", "symbols").mapInArrow(measure, "row long, hidden double")
    rare = coded.select("row", F.explode("rare").alias("b")).select("row", F.col("b").cast("string").alias("token"))
    rare = rare.join(counts.filter((F.col("c") < least) & (F.col("token") != END)), "token")
    # a token within its class has c + 1, as in the base; the classes' totals are in ``within`` already
    more = rare.groupBy("row").agg(F.sum(F.log10(F.col("c") + 1)).alias("more"), F.count("*").alias("found"))
    out = coded.drop("rare", "symbols").join(hidden, "row").join(more, "row", "left")
    extra = F.coalesce("more", F.lit(0.0))
    return out.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("found", F.lit(0))).alias("n_known"), F.lit(total.n).cast("long").alias("train_tokens"),
        (F.col("base") + extra - F.col("n_tokens") * F.lit(math.log10(total.n + total.v + 1))).alias("base_score"), (F.col("hidden") + F.col("within") + extra).alias("score"))
