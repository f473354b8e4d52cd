"""The registered queries on the small tables: against their SQL, brute force or held-out labels."""

import re
import zlib
from collections import Counter
from math import log10

import numpy as np
import pytest
import xxhash

from martloom.llm import common
from martloom.llm.queries import ORACLE, QUERIES
from workload.check import compare, duck

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans(common.UPPER, common.LOWER)


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.fixture(scope="module")
def texts(con):
    return dict(con.execute("SELECT doc_id, coalesce(text, '') FROM documents").fetchall())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, sf_dir, con, name):
    n, faults = compare(QUERIES[name](spark, sf_dir), con, ORACLE[name])
    assert not faults and n > 0


def test_every_operator_has_a_query():
    assert sorted(int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES) == list(range(1, 14))


def test_fingerprints_and_components(spark, sf_dir, texts):
    def fingerprint(text):
        w = WORD.findall(text.translate(LOWER))
        runs = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
        h = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    prints = {i: fingerprint(t) for i, t in texts.items()}
    root = {i: i for i in texts}
    ids = sorted(texts)
    for a in ids:
        for b in ids:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= 2:
                x, y = root[a], root[b]
                if x != y:
                    root = {i: min(x, y) if r in (x, y) else r for i, r in root.items()}
    got = QUERIES["op9_simhash_near_dedup"](spark, sf_dir).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got} == {i: (f"{prints[i]:016x}", root[i]) for i in ids}


def test_benchmark_passages(spark, sf_dir, con, texts):
    tokens = lambda t: [w for w in re.split(r"[\W_]+", t.lower()) if w]
    code: dict[str, int] = {}
    coded = lambda t: np.array([code.setdefault(w, len(code)) for w in tokens(t)])
    items = [coded(t) for t, in con.execute("SELECT text FROM benchmark").fetchall()]

    def holds(doc, item):
        if min(len(doc), len(item)) < 13:
            return False
        same = (item[:, None] == doc[None, :]).astype(int)
        n, m = same.shape
        return sum(same[k:n - 12 + k, k:m - 12 + k] for k in range(13)).max() >= 11

    docs = {i: coded(t) for i, t in texts.items()}
    want = {i for i, d in docs.items() if any(holds(d, item) for item in items)}
    got = QUERIES["op10_decontaminate"](spark, sf_dir).collect()
    assert {r.doc_id for r in got if r.contaminated} == want and len(got) == len(texts) and want


def test_language_model_base_scores(spark, sf_dir, texts):
    tokens = {i: [*WORD.findall(t.translate(LOWER)), ""] for i, t in texts.items()}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in texts}
    c = Counter(w for i, ws in tokens.items() if not held[i] for w in ws)
    n = sum(c.values())
    from martloom.llm import lm
    rows = lm.scores(common.table(spark, sf_dir, "documents"), frequent=500, own=100, rounds=2).collect()
    for r in rows:
        assert (r.held_out, r.n_tokens, r.train_tokens) == (held[r.doc_id], len(tokens[r.doc_id]), n)
        assert r.n_known == sum(c[w] > 0 for w in tokens[r.doc_id])
        assert r.base_score == pytest.approx(sum(log10((c[w] + 1) / (n + len(c) + 1)) for w in tokens[r.doc_id]))
        assert r.score < 0
    out = [r for r in rows if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out) * 1.02


def test_language_model_scores_equal_a_plain_recursion(spark, sf_dir, texts, monkeypatch):
    from martloom.llm import lm
    seen = []
    again = lm.Model.reestimated
    monkeypatch.setattr(lm.Model, "reestimated", lambda self, sums, f: (again(self, sums, f), seen.append(self))[0])
    rows = {r.doc_id: r.score for r in lm.scores(common.table(spark, sf_dir, "documents"), states=3, frequent=500, own=100, rounds=2).collect()}
    model = seen[-1]
    tokens = {i: [*(w.encode() for w in WORD.findall(t.translate(LOWER))), None] for i, t in texts.items()}
    c = Counter(w for i, ws in tokens.items() if zlib.crc32(str(i).encode()) % 7 != 2 for w in ws)
    ranked = sorted((w for w in c if w is not None), key=lambda w: (-c[w], w))[:100]
    symbol = {w: k for k, w in enumerate(ranked)} | {None: 100 + lm.CLASSES}
    mass, kinds = Counter(), Counter()
    for w in c.keys() - symbol.keys():
        mass[zlib.crc32(w[-3:]) % lm.CLASSES] += c[w]
        kinds[zlib.crc32(w[-3:]) % lm.CLASSES] += 1
    assert len(seen) == 2 and rows.keys() == tokens.keys()
    for i, ws in tokens.items():
        a, total = model.start, 0.0
        for t, w in enumerate(ws):
            k = zlib.crc32(w[-3:]) % lm.CLASSES if w not in symbol else None
            a = (a @ model.move if t else a) * model.emit[:, symbol[w] if k is None else 100 + k]
            total += log10(a.sum()) + (log10((c[w] + 1) / (mass[k] + kinds[k] + 1)) if k is not None else 0)
            a = a / a.sum()
        assert rows[i] == pytest.approx(total)


def test_language_on_held_out_rows(spark, sf_dir, con):
    lang = dict(con.execute("SELECT doc_id, lang FROM documents").fetchall())
    rows = [r for r in QUERIES["op4_language"](spark, sf_dir).collect() if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in rows) >= 0.95 * len(rows) > 0
    assert all(0 < r.score <= 1 for r in rows)


def test_toxicity_on_held_out_english_rows(spark, con):
    sf_dir = "/root/testdata/sf0.01"
    toxic = dict(duck(sf_dir).execute("SELECT doc_id, toxic FROM labels JOIN documents USING (doc_id) WHERE lang = 'en'").fetchall())
    rows = [r for r in QUERIES["op2_toxicity"](spark, sf_dir).collect() if r.held_out and r.doc_id in toxic]
    assert sum(r.predicted == toxic[r.doc_id] for r in rows) >= 0.95 * len(rows) > 0
    assert any(r.predicted for r in rows)


def test_pipeline(spark, sf_dir):
    import corpus_pipeline
    docs = common.table(spark, sf_dir, "documents")
    columns, left = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        docs = common.stored(stage(spark, docs, sf_dir), f"test-{name}")
        left.append(docs.count())
        assert docs.columns[:5] == columns
    assert left == sorted(left, reverse=True) and left[-1] > 0
    assert docs.filter("taken <> copies * size or copies < 1 or copies > 2").count() == 0
