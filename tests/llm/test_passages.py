"""Decontamination against brute force: short items, and items that share a passage."""

import itertools
import random

from martloom.llm import decontaminate

ITEMS = {n: [f"i{n}w{k}" for k in range(n)] for n in range(1, 15)}
ALLOWED = {n: 0 if n < 10 else n // 6 if n < 13 else 2 for n in ITEMS}


def most_equal(doc, item):
    """Most equal words in a row of 13 aligned ones, or of the whole item if it is shorter; beyond the text is no word."""
    width = min(len(item), 13)
    wide = [None] * 13 + doc + [None] * 13
    return max(sum(a == b for a, b in zip(wide[i:i + width], item[j:j + width])) for i in range(len(wide) - width + 1) for j in range(len(item) - width + 1))


def test_all_differences_of_short_items_are_found(spark):
    rng, docs = random.Random(8), {}
    for n, words in ITEMS.items():
        for r in range(ALLOWED[n] + 2):
            for places in itertools.combinations(range(n), r):
                text = [f"x{k}" if k in places else w for k, w in enumerate(words)]
                if rng.random() < 0.5:
                    text = ["before"] * rng.randrange(1, 40) + text + ["after"] * rng.randrange(1, 40)
                docs[len(docs)] = text
        for a, b in ((0, 1), (0, 2), (1, 0), (1, 1), (2, 0)):
            docs[len(docs)] = words[a:len(words) - b]
    benchmark = spark.createDataFrame([(n, " ".join(w)) for n, w in ITEMS.items()], "item_id long, text string")
    table = spark.createDataFrame([(i, " ".join(t)) for i, t in docs.items()], "doc_id long, text string").repartition(4)
    best = {i: {n: most_equal(t, w) for n, w in ITEMS.items() if any(x in w for x in t)} for i, t in docs.items()}
    want = {i for i, b in best.items() if any(e >= (11 if n >= 13 else n - ALLOWED[n]) for n, e in b.items())}
    got = {r.doc_id: r for r in decontaminate.marked(table, benchmark).collect()}
    assert {i for i, r in got.items() if r.contaminated} == want
    assert all(got[i].item_id == min(n for n, e in best[i].items() if e >= (11 if n >= 13 else n - ALLOWED[n])) for i in want)
    assert all((got[i].n_hits > 0) == (i in want) for i in docs)
    assert {r.doc_id for r in decontaminate.clean(table, benchmark).collect()} == set(docs) - want


def test_items_that_share_a_passage_are_all_counted(spark):
    prompt = [f"prompt{k}" for k in range(20)]
    items = [(k, " ".join([*prompt, *[f"own{k}w{i}" for i in range(20)]])) for k in range(1, 6)] + [(6, "yes no"), (7, "yes no")]
    docs = [(1, " ".join(prompt)), (2, " ".join([*prompt, *[f"own3w{i}" for i in range(20)]])), (3, " ".join(f"own4w{i}" for i in range(20))), (4, "say yes no"), (5, "no")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    table = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: (r.item_id, r.n_hits > 0) for r in decontaminate.marked(table, benchmark).collect()}
    assert got == {1: (1, True), 2: (1, True), 3: (4, True), 4: (6, True), 5: (None, False)}
    found, owners = decontaminate.passages(table, benchmark)
    pairs = {(r.doc_id, r.item_id) for r in found.join(owners, "around").select("doc_id", "item_id").collect()}
    assert pairs == {*((d, k) for d in (1, 2) for k in range(1, 6)), (3, 4), (4, 6), (4, 7)}


def test_a_prompt_of_many_items_and_documents_gives_a_row_a_document(spark, monkeypatch):
    n = 40
    prompt = [f"prompt{k}" for k in range(13)]
    benchmark = spark.createDataFrame([(k, " ".join([*prompt, *[f"own{k}w{i}" for i in range(13)]])) for k in range(n)], "item_id long, text string")
    docs = spark.createDataFrame([(k, " ".join([*prompt, *[f"own{k}w{i}" for i in range(13)]])) for k in range(n)], "doc_id long, text string")
    runs = []
    for broadcast in (decontaminate.BROADCAST, 0):  # the seeds broadcast, and joined by shuffle
        monkeypatch.setattr(decontaminate, "BROADCAST", broadcast)
        found = decontaminate.contaminated(docs, benchmark)
        plan = found._jdf.queryExecution().executedPlan().toString()
        # the hits are added up before they are shuffled: no Exchange holds the words around
        assert not any("Exchange" in line and "around" in line for line in plan.splitlines())
        runs.append(sorted((r.doc_id, r.item_id, r.n_hits, r.equal) for r in found.collect()))
    assert runs[0] == runs[1] and [r[:2] + r[3:] for r in runs[0]] == [(k, 0, 13) for k in range(n)]
