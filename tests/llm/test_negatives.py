"""Hard negatives: the product against numpy, the operator against a full sort, and edge rows."""

import math
import random

import numpy as np

from martloom.llm import negatives as N

SCHEMA = "vec_id long, embedding array<float>, label int"


def test_strassen_is_exact_for_odd_sides():
    rng = np.random.default_rng(1)
    for _ in range(40):
        m, k, n = rng.integers(1, 40, 3)
        a, b = rng.integers(-10**6, 10**6, (m, k)), rng.integers(-10**6, 10**6, (k, n))
        assert (N.strassen(a, b, leaf=2) == a @ b).all()


def test_scores_beyond_64_bits_count_as_the_end():
    rng = np.random.default_rng(2)
    a, c = rng.integers(-2**62, 2**62, (37, 35)), rng.integers(-2**62, 2**62, (41, 35))
    want = np.clip(a.astype(object) @ c.astype(object).T, 1 - 2**63, 2**63 - 1)
    assert (N.scores(a, c) == want.astype(np.int64)).all()


def test_heaps_merge():
    rng = np.random.default_rng(3)
    keys, found, ids = rng.integers(0, 5, 400), rng.integers(0, 9, 400), np.arange(400)
    whole, left, right = N.Heap(4), N.Heap(4), N.Heap(4)
    whole.add(keys, found, ids)
    left.add(keys[:200], found[:200], ids[:200])
    right.add(keys[200:], found[200:], ids[200:])
    left.add(*right.rows.T)
    assert (left.rows == whole.rows).all() and len(whole.rows) == 20


def plain(rows, every=100, limit=5):
    ok = [(i, label, [math.floor(256 * x) for x in v]) for i, v, label in rows
          if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, label, q in [r for r in ok if r[0] is not None and r[0] % every == 0]:
        scored = sorted(((-sum(a * b for a, b in zip(q, p)), j is None, j or 0, other) for j, other, p in ok), key=lambda r: r[:3])
        back = [(-s, None if none else j, other) for s, none, j, other in scored]
        for score, j, _ in [r for r in back if r[2] == label and r[1] != i][:limit]:
            hard = [r for r in back if r[2] != label and 80 * score <= 100 * r[0] <= 100 * score][:limit]
            out += [(i, j, n + 1, k, score, s) for n, (s, k, _) in enumerate(hard)]
    return out


def rows_of(df):
    return sorted(map(tuple, df.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()), key=str)


def test_equals_a_full_sort(spark, monkeypatch):
    monkeypatch.setattr(N, "SLICE", 60)
    monkeypatch.setattr(N, "GROUP", 3)
    monkeypatch.setattr(N, "TILE", (2, 17))
    rng = random.Random(4)
    vector = [np.float32(x).item() for x in (0.5, -0.25, 0.75)]
    rows = [(i, [np.float32(rng.uniform(-1, 1)).item() for _ in range(3)], rng.randrange(4)) for i in range(0, 700)]
    # one vector for a third of the rows, equal scores, a wide spread of labels
    rows += [(1000 + i, vector, i % 3) for i in range(300)] + [(5000 + i, vector, 100 + i) for i in range(40)]
    got = rows_of(N.mine(spark.createDataFrame(rows, SCHEMA), every=100))
    assert got == sorted(plain(rows), key=str) and len(got) > 50


def test_edge_rows(spark):
    nan, big = float("nan"), 3e38
    rows = [
        (0, [1.0, 1.0], 1), (1, [1.0, 0.5], 1), (2, [0.9, 0.5], 2), (3, [0.9, 0.5], 2), (4, [nan, 1.0], 1), (5, [None, 1.0], 1), (6, None, 1), (7, [1.0, 1.0], None),
        (8, [float("inf"), 0.0], 2), (None, [0.9, 0.5], 2), (100, [], 1), (200, [1.0], 3), (300, [big, big], 4), (301, [big, 1.0], 4), (302, [big, 1.0], 5)]
    rows += [(0, [1.0, 1.0], 1), (3, [0.9, 0.5], 2)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS q", "2 AS anchor", "'x' AS id")
    got = rows_of(N.mine(df))
    zero = [r for r in got if r[0] == 0 and r[1] == 1]
    # equal scores by id, repeated rows each, a row without id last; repeated anchors once
    assert [r[3] for r in sorted(zero, key=lambda r: r[2])][:4] == [2, 3, 3, None]
    assert not {4, 5, 6, 7, 8} & {r[3] for r in got} | {r[1] for r in got} & {4, 5, 6, 7, 8}
    assert [r[1:] for r in got if r[0] == 300][0][3] == 2**63 - 1
    assert N.mine(df.limit(0)).count() == 0


def test_next_label(spark):
    rows = [(7, [1.0], 9), (8, [1.0], 9), (None, [1.0], 3), (14, None, None)]
    out = {r.vec_id: r.label for r in N.relabelled(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert out == {7: 0, 8: 9, None: 3, 14: None}
