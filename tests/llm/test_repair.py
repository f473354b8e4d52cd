"""Conversation repair: the search against an exhaustive table of ways, pieces against whole searches, and edge rows."""

import hashlib
import random

import pytest
from pyspark.sql import types as T

from martloom.llm import repair as R


def ways(rows):
    """The cheapest and ASCII-least letters by a table over rows and states."""
    def inserts(best):
        out = dict(best)
        for state, (cost, path) in best.items():
            for _ in range(3):
                state, cost, path = R.NEXT[state], cost + R.INSERT, path + "I"
                out[state] = min(out.get(state, (cost, path)), (cost, path))
        return out

    best = {R.START: (0, "")}
    for initial, kind in rows:
        new: dict = {}
        for state, (cost, path) in inserts(best).items():
            steps = [("D", state, R.DELETE)]
            if kind in (R.CLEAN, R.TRUNCATED):
                more = R.LOOSE if kind == R.TRUNCATED else 0
                steps.append(("R", R.NEXT[state], R.RETITLE + more))
                if (state, initial) in R.KEEP:
                    steps.append(("K", R.KEEP[state, initial], more))
            for letter, to, price in steps:
                new[to] = min(new.get(to, (cost + price, path + letter)), (cost + price, path + letter))
        best = new
    best = inserts(best)
    return min(best[s] for s in R.ENDS if s in best)


def some_rows(rng, n):
    return [(rng.choice(["s", "u", "a", "u", "a", "x", ""]), rng.choice([0, 0, 0, 0, 0, 1, 2, 3])) for _ in range(n)]


def test_search_finds_the_first_of_the_cheapest():
    rng = random.Random(3)
    for _ in range(1500):
        rows = some_rows(rng, rng.randrange(10))
        assert R.cheapest(rows, R.START, R.ENDS, True) == ways(rows), rows


@pytest.mark.parametrize("piece", [1, 2, 3, 7])
def test_pieces_equal_the_whole(monkeypatch, piece):
    monkeypatch.setattr(R, "PIECE", piece)
    rng = random.Random(piece)
    for _ in range(60):
        rows = some_rows(rng, rng.randrange(1, 30))
        part = R.Part(R.STATES)
        for initial, kind in rows:
            part.add(initial, kind)
        part.link()
        assert part.chains[R.START].finish() == ways(rows), rows


def test_estimates_never_exceed_the_cost():
    rng = random.Random(9)
    for _ in range(500):
        rows = some_rows(rng, rng.randrange(12))
        assert R.estimates(rows)[0] <= ways(rows)[0]


def by_id(df):
    return {r.conv_id: r for r in df.collect()}


SCHEMA = "conv_id long, turn long, role string, text string"


def test_edge_rows(spark):
    rows = [
        (1, 0, "user", "Hi."), (1, 1, "assistant", "Yes."), (1, 1, "assistant", "Yes."), (1, 4, "user", "x"),
        (2, None, None, None), (2, None, "user", "A?"), (None, 0, "user", "Null id."), (None, None, "assistant", "First."),
        (3, 7, "", "No role."), (4, 2, "system", "Only."), (5, -(2**63), "user", "a."), (5, 2**63 - 1, "assistant", "b!  \n")]
    convs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS audit", "'x' AS digest", "2 AS kind")
    got = by_id(R.digest(convs, spark.createDataFrame([(i,) for i in (1, 2, 3, 4, 5, 6, None)], "conv_id long")))
    assert len(got) == 7
    one = got[1]
    assert (one.gaps, one.blank, one.duplicate, one.truncated, one.illegal, one.cost, one.audit) == (2, 0, 1, 1, 1, 4, "KKDD")
    assert one.repaired_sha256 == hashlib.sha256(b"user:Hi.\nassistant:Yes.").hexdigest()
    # roles of NULL fit nowhere, NULL texts are blank; by turn with NULLs first, then role
    assert (got[2].gaps, got[2].blank, got[2].audit) == (0, 1, "DD") and got[2].repaired_sha256 == hashlib.sha256(b"").hexdigest()
    assert (got[None].gaps, got[None].illegal, got[None].audit) == (0, 0, "RR")
    assert (got[3].audit, got[4].audit) == ("D", "D") and got[5].audit == "KK" and got[5].gaps is None
    six = got[6]
    assert (six.gaps, six.blank, six.duplicate, six.truncated, six.illegal, six.cost, six.audit, six.repaired_sha256) == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_empty_table_and_other_id_types(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert R.digest(empty).count() == 0 and R.repaired(empty).count() == 0
    named = spark.createDataFrame([("c", 0, "user", "A."), ("c", 1, "user", "B.")], "conv_id string, turn int, role string, text string")
    assert [(r.conv_id, r.place, r.edit, r.role, r.text) for r in R.repaired(named).orderBy("place").collect()] == [("c", 0, "K", "user", "A."), ("c", 1, "R", "assistant", "B.")]


def test_long_conversation_over_many_tasks(spark):
    rng = random.Random(5)
    rows = [(1, t, rng.choice(["system", "user", "assistant"]), rng.choice([f"Text {t}.", f"Text {t}", "", "Same."])) for t in range(1500)]
    rows += [(2, 0, "user", "x" * 300_000 + "."), (2, 1, "assistant", "ok.")] + [(1, 40, "user", "Copy.")] * 200
    got = by_id(R.digest(spark.createDataFrame(rows, SCHEMA).repartition(7)))
    ordered, seen, kinds, texts = sorted((r for r in rows if r[0] == 1), key=lambda r: (r[1], r[2], hashlib.md5(r[3].encode()).digest())), set(), [], []
    for _, _, role, text in ordered:
        kind = R.BLANKED if not text else R.DUPLICATE if (role, text) in seen else R.CLEAN if text[-1] == "." else R.TRUNCATED
        seen.add((role, text))
        kinds.append((role[0], kind))
    cost, audit = ways(kinds)
    assert (got[1].cost, got[1].audit, got[1].duplicate, got[1].blank) == (cost, audit, sum(k == R.DUPLICATE for _, k in kinds), sum(k == R.BLANKED for _, k in kinds))
    assert got[1].illegal == sum(a[0] + b[0] not in R.LEGAL for a, b in zip(kinds, kinds[1:])) and got[1].gaps == 0
    state, at = R.START, 0
    for (_, _, role, text) in [*ordered, (0, 0, None, None)]:
        while at < len(audit) and audit[at] == "I":
            state, at = R.NEXT[state], at + 1
            texts.append(R.ROLE[state] + ":")
        if role and audit[at] != "D":
            state = R.KEEP[state, role[0]] if audit[at] == "K" else R.NEXT[state]
            texts.append((role if audit[at] == "K" else R.ROLE[state]) + ":" + text)
        at += 1
    assert got[1].repaired_sha256 == hashlib.sha256("\n".join(texts).encode()).hexdigest()
    assert got[2].audit == "KK" and got[2].repaired_sha256 == hashlib.sha256(f"user:{'x' * 300_000}.\nassistant:ok.".encode()).hexdigest()


def test_damage(spark):
    rows = [(c, t, "assistant", "One. Two!") for c in range(30) for t in range(4)] + [(None, None, None, None)]
    out = R.damaged(spark.createDataFrame(rows, SCHEMA))
    assert out.schema.simpleString() == "struct<conv_id:bigint,turn:bigint,role:string,text:string>"
    import zlib
    want = []
    for c, t, role, text in rows:
        name = f"{' ' if c is None else c}:{' ' if t is None else t}"
        role, text, fault = role or " ", text or " ", zlib.crc32(name.encode()) % 20
        want += [] if fault == 0 else [(c, t, "user" if fault == 4 else role, "" if fault == 1 else "One Two" if fault == 2 else text)] * (2 if fault == 3 else 1)
    key = lambda r: tuple((v is not None, v) for v in r)
    assert sorted(map(tuple, out.collect()), key=key) == sorted(want, key=key)
    assert isinstance(out.schema["turn"].dataType, T.LongType)
