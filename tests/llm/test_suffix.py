"""Bytes of earlier documents against brute force, and what a bucket of surroundings takes."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from martloom.llm import suffix
from martloom.llm.repeats import positions


def brute(texts, docs):
    """What is left of each text, the bytes that went and the runs of them."""
    raw, least = [t.encode() for t in texts], {}
    for r, d in zip(raw, docs):
        for s in range(len(r) - suffix.MATCH + 1):
            w = r[s:s + suffix.MATCH]
            least[w] = min(least.get(w, suffix.NO_ID), d)
    out = []
    for r, d in zip(raw, docs):
        spans = [x for s in range(len(r) - suffix.MATCH + 1) if least[r[s:s + suffix.MATCH]] < d for x in (s, s + suffix.MATCH)]
        out.append(suffix.cut_bytes(r, np.array(spans, np.int64)))
    return out


def rows_of(batches):
    return [r for b in batches for r in b.to_pylist()]


def buckets_of(rows):
    """The tables of the groups, as Spark makes them."""
    for b in sorted({r["bucket"] for r in rows}):
        part = [r for r in rows if r["bucket"] == b]
        yield pa.table([pa.array([r["block"] for r in part], pa.int64()), pa.array([r["data"] for r in part], pa.binary())], ["block", "data"])


def by_row(tables, gather):
    rows = [r for t in tables for r in t.to_pylist()]
    out = {}
    for block in {r["block"] for r in rows}:
        found = gather(pa.table([pa.array([r["data"] for r in rows if r["block"] == block], pa.binary())], ["data"]))
        out |= dict(zip(found.column("id").to_pylist(), found.column("found").to_pylist()))
    return out


def batches_of(texts, docs, per, found=None):
    ids = [i for i in range(len(texts)) if found is None or i in found]
    for a in range(0, len(ids), per):
        part = ids[a:a + per]
        columns = {"id": pa.array(part, pa.int64()), "text": pa.array([texts[i] for i in part], pa.string()), "doc": pa.array([docs[i] for i in part], pa.int64())}
        yield pa.RecordBatch.from_pydict(columns | ({} if found is None else {"found": pa.array([found[i] for i in part], pa.binary())}))


def every_anchor(texts):
    """Row -> the places of its anchors, as if all occurred again."""
    raw = [t.encode() for t in texts]
    out = {}
    for i, r in enumerate(raw):
        p = suffix.anchors(np.frombuffer(r, np.uint8), np.array([0, len(r)]))[0]
        if len(p):
            out[i] = p.astype(np.int32).tobytes()
    return out


def left(texts, docs, buckets, per):
    """What the operator's steps make of the texts, without Spark between them."""
    again = by_row(map(suffix._again, buckets_of(rows_of(suffix._anchors(buckets)(batches_of(texts, docs, per))))), suffix.gather) if any(texts) else {}
    spans = by_row(map(suffix._decide, buckets_of(rows_of(suffix._contexts(buckets)(batches_of(texts, docs, per, again))))), suffix._united) if again else {}
    return [suffix.cut_bytes(t.encode(), positions(spans.get(i))) for i, t in enumerate(texts)]


@pytest.mark.parametrize("alphabet", ["a", "ab", "ab\0", "abcdefgh ", "aé"])
def test_bytes_that_go_equal_brute_force(alphabet):
    rng = random.Random(len(alphabet))
    for _ in range(15):
        cores = ["".join(rng.choice(alphabet) for _ in range(rng.randint(20, 200))) for _ in range(rng.randint(1, 3))]
        texts = ["".join(rng.choice(cores)[rng.choice([0, 0, rng.randint(0, 30)]):rng.randint(40, 200)] + "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 4))) for _ in range(rng.randint(0, 4))) + "." for _ in range(rng.randint(1, 30))]
        docs = [rng.choice([-5, suffix.NO_ID, rng.randint(1, 20), rng.randint(1, 90)]) for _ in texts]
        assert left(texts, docs, rng.choice([1, 3]), rng.choice([1, 5, 100])) == brute(texts, docs)


def test_one_passage_in_many_different_texts():
    """More surroundings of one anchor than are left to one suffix array; neighbours of the passage are shared by some of them."""
    rng = random.Random(3)
    passage = "".join(rng.choice("abcdefgh") for _ in range(60))
    texts = ["".join(rng.choice("xyz") for _ in range(40)) + passage + "".join(rng.choice("xyz") for _ in range(40)) for _ in range(300)]
    docs = [rng.randint(0, 200) for _ in texts]
    assert left(texts, docs, 2, 70) == brute(texts, docs)


def test_anchors_do_not_hang_on_the_pieces(monkeypatch):
    rng = random.Random(4)
    data = np.frombuffer(bytes(rng.choice(b"abc") for _ in range(3000)), np.uint8)
    starts = np.array([0, 900, 900, 960, 2000, 3000])
    whole = suffix.anchors(data, starts)
    monkeypatch.setattr(suffix, "PIECE", 64)
    for a, b in zip(whole, suffix.anchors(data, starts)):
        assert a.tolist() == b.tolist()


def test_a_bucket_of_surroundings_stays_small():
    """Memory of a bucket's task, and bytes shuffled to it, next to the bytes of text whose anchors all occur again."""
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9))) for _ in range(500)]
    texts = [" ".join(rng.choice(words) for _ in range(200)) for _ in range(150)]
    texts += [t for t in texts for _ in range(2)]
    size = sum(len(t.encode()) for t in texts)
    docs = list(range(len(texts)))
    rows = [r for a in range(0, len(texts), 150) for r in rows_of(suffix._contexts(1)(batches_of(texts[a:a + 150], docs[a:a + 150], 150, every_anchor(texts[a:a + 150]))))]
    assert sum(len(r["data"]) for r in rows) < 2.5 * size
    [table] = buckets_of(rows)
    tracemalloc.start()
    try:
        assert suffix._decide(table).num_rows
        assert tracemalloc.get_traced_memory()[1] < 14 * size
    finally:
        tracemalloc.stop()
