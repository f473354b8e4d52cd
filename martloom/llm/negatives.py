"""Hard negatives of anchors: exact integer scores of anchor and candidate tiles by Strassen multiplication, kept in mergeable heaps."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martloom.llm.common import col, stored

#: Rows of candidates to a slice and of anchors to a group: one task multiplies a group with a slice, in tiles.
SLICE, GROUP = 4096, 32768
TILE = (512, 2048)
#: Side below which matrices are multiplied directly.
LEAF = 32
#: A candidate without id is the last of equal scores.
NO_ID = (1 << 63) - 1


def padded(x: np.ndarray, rows: int, columns: int) -> np.ndarray:
    """Filled up with zeros."""
    if x.shape == (rows, columns):
        return x
    out = np.zeros((rows, columns), x.dtype)
    out[:x.shape[0], :x.shape[1]] = x
    return out


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """The matrix product by seven products of halves, padded with zeros to even sides; exact, as integers that leave 64 bits come back."""
    (m, k), n = a.shape, b.shape[1]
    if min(m, k, n) <= leaf:
        return a @ b
    r, q, c = -(-m // 2), -(-k // 2), -(-n // 2)
    a, b = padded(a, 2 * r, 2 * q), padded(b, 2 * q, 2 * c)
    a11, a12, a21, a22 = a[:r, :q], a[:r, q:], a[r:, :q], a[r:, q:]
    b11, b12, b21, b22 = b[:q, :c], b[:q, c:], b[q:, :c], b[q:, c:]
    p1, p2, p3 = strassen(a11 + a22, b11 + b22, leaf), strassen(a21 + a22, b11, leaf), strassen(a11, b12 - b22, leaf)
    p4, p5 = strassen(a22, b21 - b11, leaf), strassen(a11 + a12, b22, leaf)
    p6, p7 = strassen(a21 - a11, b11 + b12, leaf), strassen(a12 - a22, b21 + b22, leaf)
    out = np.empty((2 * r, 2 * c), a.dtype)
    out[:r, :c], out[:r, c:], out[r:, :c], out[r:, c:] = p1 + p4 - p5 + p7, p3 + p5, p2 + p4, p1 - p2 + p3 + p6
    return out[:m, :n]


def scores(a: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Inner products of the rows of two integer matrices. Those that no long can hold count as the end of its range."""
    width = max(a.shape[1], c.shape[1])
    a, c = (padded(x, len(x), width) for x in (a, c))
    far = [max(abs(int(x.min())), abs(int(x.max()))) if x.size else 0 for x in (a, c)]
    if far[0] * far[1] * width < 1 << 62:
        return strassen(a, c.T)
    exact = strassen(a.astype(object), c.astype(object).T)
    return np.clip(exact, 1 - (1 << 63), (1 << 63) - 1).astype(np.int64)


def matrix(lists: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Rows of integers; shorter ones are filled up with zeros."""
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    sizes = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(sizes), int(sizes.max(initial=0))), np.int64)
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


class Heap:
    """The first ``limit`` entries (score descending, then id) of every key; adding one heap to another gives the heap of both."""

    def __init__(self, limit: int) -> None:
        self.limit, self.rows = limit, np.zeros((0, 3), np.int64)

    def add(self, keys: np.ndarray, found: np.ndarray, ids: np.ndarray) -> None:
        rows = np.concatenate([self.rows, np.stack([keys, found, ids], axis=1)])
        rows = rows[np.lexsort((rows[:, 2], -rows[:, 1], rows[:, 0]))]
        new = np.ones(len(rows), bool)
        new[1:] = rows[1:, 0] != rows[:-1, 0]
        first = np.maximum.accumulate(np.where(new, np.arange(len(rows)), 0))
        self.rows = rows[np.arange(len(rows)) - first < self.limit]


def _tiles(a: pa.Table, c: pa.Table) -> Iterator[tuple]:
    """Anchor rows, then their scores with candidate tiles: (slice of anchors, slice of candidates, scores)."""
    x, y = matrix(a.column("q")), matrix(c.column("q"))
    for i in range(0, len(x), TILE[0]):
        for j in range(0, len(y), TILE[1]):
            yield slice(i, i + TILE[0]), slice(j, j + TILE[1]), scores(x[i:i + TILE[0]], y[j:j + TILE[1]])


def _numbers(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy().astype(np.int64)


def _positives(limit: int):
    def run(a: pa.Table, c: pa.Table) -> pa.Table:
        heap = Heap(limit)
        if len(a) and len(c):
            # only rows of one label meet
            la, lc, anchors = _numbers(a, "label"), _numbers(c, "label"), _numbers(a, "anchor")
            for label in np.intersect1d(la, lc).tolist():
                own, other = a.filter(pa.array(la == label)), c.filter(pa.array(lc == label))
                numbers, named, ids = anchors[la == label], _numbers(own, "id"), _numbers(other, "id")
                for i, j, found in _tiles(own, other):
                    r, k = np.nonzero(named[i][:, None] != ids[j][None, :])
                    heap.add(numbers[i][r], found[r, k], ids[j][k])
        return pa.table({"anchor": heap.rows[:, 0], "score": heap.rows[:, 1], "id": heap.rows[:, 2]})
    return run


def _windows(limit: int, low: int, high: int):
    def run(a: pa.Table, c: pa.Table) -> pa.Table:
        out = []
        if len(a) and len(c):
            la, lc, anchors, ids = _numbers(a, "label"), _numbers(c, "label"), _numbers(a, "anchor"), _numbers(c, "id")
            tops = matrix(a.column("tops"))
            held = np.array([len(t) for t in a.column("tops").to_pylist()])
            for w in range(tops.shape[1]):
                out.append((tops[:, w], Heap(limit)))
            for i, j, found in _tiles(a, c):
                unlike = la[i][:, None] != lc[j][None, :]
                for w, (top, heap) in enumerate(out):
                    most = top[i][:, None]
                    # low * top <= high * score without leaving 64 bits: top less the whole part of its share
                    least = most - most // high * (high - low) - most % high * (high - low) // high
                    r, k = np.nonzero(unlike & (held[i] > w)[:, None] & (found <= most) & (found >= least))
                    heap.add(np.arange(len(la))[i][r], found[r, k], ids[j][k])
        rows = [(anchors[h.rows[:, 0]], t[h.rows[:, 0]], h.rows[:, 1], h.rows[:, 2]) for t, h in out]
        parts = [np.concatenate(p) for p in zip(*rows)] if rows else [np.zeros(0, np.int64)] * 4
        return pa.table(dict(zip(("anchor", "top", "score", "id"), parts)))
    return run


def _part(key: list[Column], parts: int) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(parts)).cast("int")


def quantised(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """(id, label, q): rows with a label and a vector of finite numbers; q has floor(scale * x) per component x."""
    x = F.transform(col("embedding").cast("array<double>"), lambda v: F.floor(v * F.lit(float(scale))).cast("bigint"))
    finite = F.forall(col("embedding").cast("array<double>"), lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = vectors.filter(col("label").isNotNull() & col("embedding").isNotNull() & finite)
    return rows.select(F.coalesce(col("vec_id").cast("bigint"), F.lit(NO_ID)).alias("id"), col("label").cast("bigint").alias("label"), x.alias("q"))


def mine(vectors: DataFrame, *, every: int = 100, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100, scale: int = 256) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: for every anchor and positive its hardest negatives.

    Anchors are the rows whose vec_id is divisible by ``every``; the score of a row is the integer inner product of the two vectors, after floor(``scale`` * x). An
    anchor's positives are the first ``positives`` other rows of its label by score, ties by smaller vec_id; a positive's negatives are the first
    ``negatives`` rows of other labels with ``low`` * positive score <= ``high`` * score <= ``high`` * positive score.

    All is exact and in two passes, as windows hang on the positives' scores: first only rows of one label are multiplied, then all. A task multiplies a
    group of at most some 32,768 anchors with a slice of some 4,096 candidates (both dealt by hash, so no label or vector is one task's) and
    returns heaps, which are merged by anchor.

    Rows with a NULL label or vector, or a component that is NULL or not finite take no part. A NULL vec_id is no anchor, and last of equal scores.
    Vectors of unequal length meet as if filled up with zeros. Rows that share the anchor's vec_id are no positives of it. Repeated rows count
    each as candidates; repeated anchors count once. Scores beyond a long count as the end of its range. Empty table: no rows. Other columns do not matter.
    """
    if not 0 < low <= high:
        raise ValueError("the window is a share of the positive's score")
    rows = stored(quantised(vectors, scale), "negatives-rows")
    anchors = rows.filter((F.col("id") % every == 0) & (F.col("id") != NO_ID)).distinct()
    anchors = stored(anchors.withColumn("anchor", F.monotonically_increasing_id()), "negatives-anchors")
    slices, groups = max(1, -(-rows.count() // SLICE)), max(1, -(-anchors.count() // GROUP))
    spread = F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("g")
    candidates = rows.select("*", _part([F.col("id"), F.col("q")], slices).alias("s"), spread).groupBy("g", "s")

    def grid(queries: DataFrame):
        every_slice = F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("s")
        return queries.select("*", _part([F.col("anchor")], groups).alias("g"), every_slice).groupBy("g", "s").cogroup(candidates)

    first = grid(anchors).applyInArrow(_positives(positives), "anchor long, score long, id long")
    order = Window.partitionBy("anchor").orderBy(F.col("score").desc(), "id")
    best = stored(first.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= positives), "negatives-positives")
    tops = best.groupBy("anchor").agg(F.sort_array(F.collect_set("score"), asc=False).alias("tops"))  # at most ``positives``
    found = grid(anchors.join(tops, "anchor")).applyInArrow(_windows(negatives, low, high), "anchor long, top long, score long, id long")
    order = Window.partitionBy("anchor", "top").orderBy(F.col("score").desc(), "id")
    hard = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= negatives).select("anchor", F.col("top").alias("positive_score"), "rank",
                                                                                                         F.col("score").alias("negative_score"), F.col("id").alias("negative"))
    pairs = best.select("anchor", F.col("id").alias("positive"), F.col("score").alias("positive_score"))
    named = anchors.select("anchor", F.col("id").alias("anchor_id"))
    known = [F.nullif(F.col(c), F.lit(NO_ID)).alias(f"{c}_id") for c in ("positive", "negative")]
    return named.join(pairs, "anchor").join(hard, ["anchor", "positive_score"]).select("anchor_id", known[0], "rank", known[1], "positive_score", "negative_score")


def relabelled(vectors: DataFrame, every: int = 7, labels: int = 10) -> DataFrame:
    """``vec_id``, ``embedding`` and ``label``; where vec_id is divisible by ``every`` the next of ``labels`` labels."""
    label = col("label").cast("bigint")
    moved = F.when(col("vec_id") % every == 0, (label + 1) % labels).otherwise(label)
    return vectors.select(col("vec_id").alias("vec_id"), col("embedding").alias("embedding"), moved.alias("label"))
