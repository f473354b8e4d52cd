"""Language of a text by a bidirectional gated recurrent network over bytes."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martloom.llm.common import col, remainder, text_of

#: Bytes of a sequence: longer words are read in pieces of this size.
PIECE = 24
#: Words of a language that are learned from even if there are so many languages that ``max_words`` would leave it fewer.
FEWEST = 1_000
_LETTERS = re.compile(r"[^\W\d_]+")


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


class ByteGru:
    """Two gated recurrent layers, one in each direction, over byte embeddings, and a softmax at every position."""

    def __init__(self, classes: int, hidden: int = 16, embedding: int = 12, seed: int = 7) -> None:
        rng = np.random.default_rng(seed)
        self.hidden, self.classes = hidden, classes
        draw = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
        self.p: dict[str, np.ndarray] = {"E": draw(256, embedding) * 4, "V": draw(2 * hidden, classes), "c": np.zeros(classes, np.float32)}
        for d in "fb":
            self.p |= {f"W{d}": draw(embedding, 3 * hidden), f"U{d}": draw(hidden, 3 * hidden), f"b{d}": np.zeros(3 * hidden, np.float32)}

    def _run(self, x: np.ndarray, mask: np.ndarray, d: str, keep: bool) -> tuple[np.ndarray, list]:
        """States (n, t, h) of one direction; the state of a position beyond the end stays zero."""
        n, steps = x.shape
        h, out, memory = np.zeros((n, self.hidden), np.float32), np.zeros((n, steps, self.hidden), np.float32), []
        table = self.p["E"] @ self.p[f"W{d}"] + self.p[f"b{d}"]
        u, k = self.p[f"U{d}"], self.hidden
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            a = table[x[:, t]]
            zr = _sigmoid(a[:, :2 * k] + h @ u[:, :2 * k])
            z, r = zr[:, :k], zr[:, k:]
            g = np.tanh(a[:, 2 * k:] + (r * h) @ u[:, 2 * k:])
            m = mask[:, t, None]
            new = ((1 - z) * h + z * g) * m
            if keep:
                memory.append((t, h, z, r, g, m))
            h = out[:, t] = new
        return out, memory

    def forward(self, x: np.ndarray, mask: np.ndarray, keep: bool = False) -> tuple[np.ndarray, np.ndarray, list, list]:
        """Label probabilities (n, t, classes) of every position, and what the way back needs."""
        (f, mf), (b, mb) = self._run(x, mask, "f", keep), self._run(x, mask, "b", keep)
        states = np.concatenate([f, b], axis=2)
        logits = states @ self.p["V"] + self.p["c"]
        e = np.exp(logits - logits.max(axis=2, keepdims=True))
        return e / e.sum(axis=2, keepdims=True), states, mf, mb

    def gradients(self, x: np.ndarray, mask: np.ndarray, target: np.ndarray, weight: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Weighted mean cross entropy of all positions with soft labels (n, classes), and its gradients, back through time."""
        probs, states, mf, mb = self.forward(x, mask, keep=True)
        w = (mask * weight[:, None])[:, :, None]
        w = w / w.sum()
        loss = float(-(w * target[:, None] * np.log(probs + 1e-9)).sum())
        dlogits = (probs - target[:, None]) * w
        g = {"V": np.einsum("nth,ntc->hc", states, dlogits), "c": dlogits.sum(axis=(0, 1)), "E": np.zeros_like(self.p["E"])}
        dstates = dlogits @ self.p["V"].T
        k = self.hidden
        for d, memory, part in (("f", mf, dstates[:, :, :k]), ("b", mb, dstates[:, :, k:])):
            u, dtable, du, dh = self.p[f"U{d}"], np.zeros((256, 3 * k), np.float32), np.zeros_like(self.p[f"U{d}"]), 0
            for t, h, z, r, cand, m in reversed(memory):
                dn = (part[:, t] + dh) * m
                dg = dn * z * (1 - cand * cand)
                drh = dg @ u[:, 2 * k:].T
                dzr = np.concatenate([dn * (cand - h) * z * (1 - z), drh * h * r * (1 - r)], axis=1)
                du[:, 2 * k:] += (r * h).T @ dg
                du[:, :2 * k] += h.T @ dzr
                np.add.at(dtable, x[:, t], np.concatenate([dzr, dg], axis=1))
                dh = dn * (1 - z) + drh * r + dzr @ u[:, :2 * k].T
            g |= {f"U{d}": du, f"b{d}": dtable.sum(axis=0), f"W{d}": self.p["E"].T @ dtable}
            g["E"] += dtable @ self.p[f"W{d}"].T
        return loss, g

    def train(self, words: Sequence[bytes], target: np.ndarray, weight: np.ndarray, *, steps: int = 900, batch: int = 256, rate: float = 0.01, seed: int = 11) -> float:
        """Adam steps on batches drawn by weight; returns the mean loss of the last tenth."""
        rng, first, second, losses = np.random.default_rng(seed), {}, {}, []
        share = weight / weight.sum()
        for step in range(1, steps + 1):
            pick = rng.choice(len(words), size=batch, p=share)
            x, mask = padded([words[i] for i in pick])
            loss, grads = self.gradients(x, mask, target[pick], np.ones(batch, np.float32))
            losses.append(loss)
            lr = rate * (1 - 0.9 * step / steps)
            for name, g in grads.items():
                first[name] = 0.9 * first.get(name, 0) + 0.1 * g
                second[name] = 0.999 * second.get(name, 0) + 0.001 * g * g
                self.p[name] -= (lr * (first[name] / (1 - 0.9**step)) / (np.sqrt(second[name] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
        return float(np.mean(losses[-max(1, steps // 10):]))


def padded(pieces: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Bytes (n, t) with a blank before and after each piece, and 1 where they are real."""
    size = max(len(p) for p in pieces) + 2
    x = np.frombuffer(b"".join((b" " + p + b" ").ljust(size, b"\0") for p in pieces), np.uint8).reshape(-1, size)
    ends = np.array([len(p) + 2 for p in pieces])
    return x, (np.arange(size) < ends[:, None]).astype(np.float32)


def word_sums(net: ByteGru, words: Sequence[str], block: int = 4096) -> tuple[np.ndarray, np.ndarray]:
    """For each word, the sum of the label probabilities of its positions, and the number of positions."""
    sums, sizes = np.zeros((len(words), net.classes), np.float32), np.zeros(len(words), np.int64)
    pieces, owner = [], []
    for k, w in enumerate(words):
        raw = w.encode("utf-8", "replace")
        for at in range(0, len(raw), PIECE):
            pieces.append(raw[at:at + PIECE])
            owner.append(k)
    order = sorted(range(len(pieces)), key=lambda i: len(pieces[i]))
    for at in range(0, len(order), block):
        part = order[at:at + block]
        x, mask = padded([pieces[i] for i in part])
        probs = net.forward(x, mask)[0] * mask[:, :, None]
        who = np.array([owner[i] for i in part])
        np.add.at(sums, who, probs.sum(axis=1))
        np.add.at(sizes, who, mask.sum(axis=1).astype(np.int64))
    return sums, sizes


def taught(docs: DataFrame) -> DataFrame:
    """(doc_id, lang) of the labelled rows that are not held out."""
    ids = docs.filter(col("lang").isNotNull() & col("doc_id").isNotNull() & (remainder("doc_id", 4) != 2))
    return ids.select(col("doc_id").alias("doc_id"), col("lang").cast("string").alias("lang"))


def sample_words(docs: DataFrame, per_lang: int, max_words: int) -> list:
    """(lang, word, n) of at most ``per_lang`` texts a language, by hash of the id, none of them held out; ``word`` is a piece of PIECE bytes at most.

    Of the pieces, the most frequent of each language, so many of each that they are ``max_words``: a language that has fewer gives all of
    its own and leaves the others more. Pieces of one frequency are taken by hash.
    """
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id"))
    ids = taught(docs).withColumn("rank", rank).filter(F.col("rank") <= per_lang).select("doc_id").distinct()
    # per_lang ids a language, whatever the table's size
    texts = docs.select(col("doc_id").alias("doc_id"), col("lang").cast("string").alias("lang"), text_of().alias("text")).filter("lang is not null").join(F.broadcast(ids), "doc_id")
    words = texts.select("lang", F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"(\p{L}+)")).cast("array<binary>")).alias("word"))
    cuts = F.sequence(F.lit(1), F.octet_length("word"), F.lit(PIECE))
    pieces = words.filter(F.octet_length("word") > 0).select("lang", F.explode(F.transform(cuts, lambda at: F.substring(F.col("word"), at, F.lit(PIECE)))).alias("word"))
    counted = pieces.groupBy("lang", "word").agg(F.count("*").alias("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), F.xxhash64("word"), "word"))
    return counted.withColumn("place", place).orderBy("place", F.xxhash64("lang"), "lang").limit(max_words).select("lang", "word", "n").collect()


def learn(docs: DataFrame, *, per_lang: int = 300, max_words: int = 60_000) -> tuple[list[str], ByteGru | None]:
    """The languages and a network trained on the words of a bounded sample, each with its share of every language as soft label.

    Every language of a labelled row is one. With very many of them the sample has FEWEST words of each, if there are.
    """
    langs = sorted(r.lang for r in taught(docs).select("lang").distinct().collect())
    rows = sample_words(docs, per_lang, max(max_words, FEWEST * len(langs)))
    if not rows:
        return [], None
    place, total = {name: k for k, name in enumerate(langs)}, dict.fromkeys(langs, 0)
    for r in rows:
        total[r.lang] += r.n
    words = list(dict.fromkeys(bytes(r.word) for r in rows))
    at = {w: k for k, w in enumerate(words)}
    mass = np.zeros((len(words), len(langs)), np.float32)
    for r in rows:
        mass[at[bytes(r.word)], place[r.lang]] += r.n / total[r.lang]
    weight = mass.sum(axis=1, dtype=np.float64)
    mass /= mass.sum(axis=1, keepdims=True)
    net = ByteGru(len(langs))
    net.train(words, mass, np.sqrt(weight))
    return langs, net


def predict(docs: DataFrame, *, per_lang: int = 300, max_words: int = 60_000, cache: int = 400_000) -> DataFrame:
    """doc_id, held_out, lang_pred and score per row of ``docs``.

    Every run of letters of the whole text is one sequence of bytes between two blanks; the network labels each of its positions,
    and the document gets the mean of the probabilities of all positions: the best language and its probability. The state
    starts anew at every word, so equal words have equal labels, and a word is run through the network once per
    ``cache`` different words of a task and counted as often as it occurs.

    NULL text or no letter: ``und``, score 0. No labelled row to learn from: ``und`` for all. Held-out rows and rows without a
    language teach nothing. Repeated rows are predicted each. No documents: no rows. Other columns do not matter.
    """
    langs, net = learn(docs, per_lang=per_lang, max_words=max_words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, int] = {}
        sums, sizes = np.zeros((0, len(langs)), np.float32), np.zeros(0, np.int64)
        for batch in batches:
            tokens = [_LETTERS.findall((t or "").lower()) for t in batch.column("text").to_pylist()]
            if net is not None:
                if len(known) > cache:
                    known, sums, sizes = {}, sums[:0], sizes[:0]
                new = list({w for ws in tokens for w in ws if w not in known})
                if new:
                    s, n = word_sums(net, new)
                    known.update(zip(new, range(len(known), len(known) + len(new))))
                    sums, sizes = np.concatenate([sums, s]), np.concatenate([sizes, n])
            pred, score = [], []
            for ws in tokens:
                if net is None or not ws:
                    pred.append("und")
                    score.append(0.0)
                    continue
                at = np.fromiter(map(known.__getitem__, ws), np.int64, len(ws))
                p = sums[at].sum(axis=0, dtype=np.float64) / sizes[at].sum()
                k = int(p.argmax())
                pred.append(langs[k])
                score.append(min(1.0, float(p[k])))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(pred, pa.string()), pa.array(score, pa.float64())], ["doc_id", "lang_pred", "score"])

    d = docs.select(col("doc_id").alias("doc_id"), text_of().alias("text"))
    found = d.mapInArrow(run, f"doc_id {d.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double")
    return found.select("doc_id", (remainder("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")
