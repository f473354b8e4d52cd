"""The methods themselves, without Spark."""

import gzip
import io
import itertools
import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from martloom.llm import language, lm, simhash, substring, suffix, toxicity, warc
from martloom.llm.lyndon import suffix_order, suffix_orders


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 3), max_size=30))
def test_suffix_order_is_sorted(text):
    text = [*text, 0]
    assert suffix_order(text) == sorted(range(len(text)), key=lambda i: text[i:])


def test_many_suffix_orders_at_once_equal_single_ones():
    rng = random.Random(1)
    rows = [[rng.randint(1, a) for _ in range(30 - z)] + [0] * (z + 1) for a in (1, 2, 5) for z in (0, 1, 4, 29)]
    for row, order in zip(rows, suffix_orders(np.array(rows, np.uint8))):
        assert order.tolist() == suffix_order(row)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2**64 - 1), max_size=600), max_size=4))
def test_majority_counts_bits(lists):
    starts = np.cumsum([0, *map(len, lists)])
    got = simhash.majority(np.array([h for x in lists for h in x], np.uint64), starts)
    for hashes, bits in zip(lists, got.tolist()):
        assert bits == sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_masks_are_the_ball():
    assert len(simhash.masks(1)) == 65 and len(set(simhash.masks(2))) == 1 + 64 + 64 * 63 // 2


@pytest.mark.parametrize("period", [1, 2, 7, 13, 21])
def test_difference_cover_meets_every_offset(period):
    cover = set(substring.difference_cover(period))
    assert all(any((i + d) % period in cover and (j + d) % period in cover for d in range(period)) for i in range(period) for j in range(period))


def test_run_hashes_depend_on_the_run_only():
    x = np.array([5, 6, 7, 5, 6, 7, 8], np.uint64)
    h = substring.run_hashes(x, 3, substring.BASES[0])
    assert h[0] == h[3] and len(set(h.tolist())) == 4 and len(substring.run_hashes(x[:2], 3, 3)) == 0


def test_cut_words_keeps_the_blanks_of_what_stays():
    text = " a b\tc d\ne "
    assert substring.cut_words(text, np.array([1]), 2) == (" a d\ne ", 5, 2)
    assert substring.cut_words(text, np.array([], np.int64), 2) == (text, 5, 0)
    assert substring.cut_words("", np.array([], np.int64), 2) == ("", 0, 0)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text("ab", min_size=0, max_size=160), min_size=1, max_size=3))
def test_every_stretch_has_one_anchor(texts):
    raw = [t.encode() for t in texts]
    starts = np.cumsum([0, *map(len, raw)])
    _, h, text, first, last = suffix.anchors(np.frombuffer(b"".join(raw), np.uint8), starts)
    seen, by_bytes = [], {}
    for k, t, a, b in zip(h.tolist(), text.tolist(), (first - starts[text]).tolist(), (last - starts[text]).tolist()):
        for s in range(a, b + 1):
            seen.append((t, s))
            assert by_bytes.setdefault(raw[t][s:s + suffix.MATCH], k) == k
    assert sorted(seen) == [(t, s) for t, r in enumerate(raw) for s in range(len(r) - suffix.MATCH + 1)]


def test_shared_starts_against_all_pairs():
    rng = random.Random(2)
    core = bytes(rng.choice(b"ab") for _ in range(70))
    groups, owners = [], []
    for _ in range(30):
        g = list({core[rng.randint(0, 9):rng.randint(60, 70)] + bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 3))) for _ in range(4)})
        groups.append(g)
        owners.append([rng.randint(1, 4) for _ in g])
    for g, own, found in zip(groups, owners, suffix.shared_starts(groups, owners)):
        for k, c in enumerate(g):
            want = [s for s in range(len(c) - 49) if any(own[j] < own[k] and c[s:s + 50] in g[j] for j in range(len(g)))]
            assert found[k].tolist() == want


def test_scaled_forward_equals_the_sum_over_all_paths():
    model = lm.Model(3, np.array([.5, .3, .2]))
    text = np.array([0, 2, 1, 1])
    total = 0.0
    for path in itertools.product(range(3), repeat=4):
        p = model.start[path[0]] * model.emit[path[0], text[0]]
        for a, b, x in zip(path, path[1:], text[1:]):
            p *= model.move[a, b] * model.emit[b, x]
        total += p
    assert lm.log_likelihoods(model, [text, text[:1]])[0] == pytest.approx(np.log(total))


def test_baum_welch_raises_the_likelihood_and_adds_up_over_parts():
    rng = np.random.default_rng(0)
    texts = [rng.integers(0, 3, n) * (i % 2) + (i % 2) for i, n in enumerate((9, 5, 7, 3))]
    f = np.array([.4, .2, .2, .2])
    model = lm.Model(2, f)
    whole, parts, before = np.zeros(model.flat_size), np.zeros(model.flat_size), -np.inf
    lm.expected(model, texts, [True] * 4, whole)
    lm.expected(model, texts[:1], [True], parts)
    lm.expected(model, texts[1:], [True] * 3, parts)
    assert np.allclose(whole, parts) and whole[:2].sum() == pytest.approx(4) and whole[6:].sum() == pytest.approx(24)
    for _ in range(5):
        now = lm.log_likelihoods(model, texts).sum()
        assert now > before - 0.5
        before, sums = now, np.zeros(model.flat_size)
        lm.expected(model, texts, [True] * 4, sums)
        model.reestimated(sums * 100, f)


def test_gradients_of_the_network():
    net = language.ByteGru(3, hidden=3, embedding=2)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    x, mask = language.padded([b"ab", b"cde"])
    target, weight = np.array([[1, 0, 0], [.2, .3, .5]]), np.array([1.0, 2.0])
    _, grads = net.gradients(x, mask, target, weight)
    for name, at in (("Uf", (1, 2)), ("Ub", (0, 7)), ("E", (ord("b"), 1)), ("V", (4, 0)), ("Wf", (1, 5)), ("bb", (3,))):
        old, loss = net.p[name][at], []
        for step in (1e-4, -1e-4):
            net.p[name][at] = old + step
            loss.append(net.gradients(x, mask, target, weight)[0])
        net.p[name][at] = old
        assert grads[name][at] == pytest.approx((loss[0] - loss[1]) / 2e-4, rel=0.05, abs=1e-4)


def test_long_words_are_read_in_pieces():
    net = language.ByteGru(2)
    sums, sizes = language.word_sums(net, ["a", "b" * 60])
    assert sizes.tolist() == [3, 60 + 2 * 3] and np.allclose(sums.sum(axis=1), sizes, rtol=1e-4)


def test_folding_and_exceptions():
    assert toxicity.fold("1d1оt, SCUM!") == " idiot  scum  "
    lex = toxicity.Lexicon({" scum ": 2.0, " idio": 1.0}, [" sea scum "], (-2.0, 1.0, 1.0))
    a = lex.automaton()
    assert [h[2] for h in toxicity.hits(a, toxicity.fold("idiotic sea scum"))] == [1.0]
    assert toxicity.features(a, None) == (1.0, 0.0, 0.0)
    short, long = (toxicity.score(lex.model, toxicity.features(a, "scum " + "x " * n)) for n in (3, 3000))
    assert short > long
    assert toxicity.features(toxicity.Lexicon().automaton(), "scum")[1] == 0


def test_pruning_prefers_what_tells_more():
    found = {" idio": (3.0, 50), " idiot": (3.0, 50), " idiot ": (3.0, 48), " lowe": (3.0, 90), " loweia": (3.0, 10), " loweia ": (3.0, 10)}
    assert set(toxicity.prune(found)) == {" idiot ", " lowe"}


RECORD = {"record_id": "urn:page:1", "warc_type": "response", "target_uri": "http://x/\n", "warc_date": "2024-01-01T00:00:00Z", "payload_digest": None,
          "payload_length": None, "refers_to": None, "payload": b"WARC/1.1\r\n\r\nfoo" * 3000}


@pytest.mark.parametrize("compressed", [True, False])
def test_records_survive_and_unwanted_ones_are_skipped(tmp_path, compressed, monkeypatch):
    rows = [RECORD | {"record_id": f"urn:page:{k}", "warc_type": "revisit" if k % 2 else "response", "payload_length": 77 if k % 2 else None} for k in range(6)]
    data = b"".join(warc.gzip_member(warc.encode_record(r), 3) if compressed else warc.encode_record(r) for r in rows)
    read = warc._gzip_records if compressed else warc._plain_records
    got = list(read(io.BytesIO(data), len(data), []))
    assert [r["record_id"] for _, r, _ in got] == [r["record_id"] for r in rows]
    assert [warc.split_block(b, h) for h, _, b in got][:2] == [(RECORD["payload"], len(RECORD["payload"])), (b"", 77)]
    only = list(read(io.BytesIO(data), len(data), [("warc_type", "eq", "revisit"), ("target_uri", "starts", "http:")]))
    assert [r["record_id"][-1] for _, r, _ in only] == ["1", "3", "5"]
    with pytest.raises(ValueError):
        list(read(io.BytesIO(data[:-30000]) if not compressed else io.BytesIO(data[:-40]), len(data) - 40, []))
    if compressed:
        assert gzip.decompress(data) == b"".join(map(warc.encode_record, rows))
        other = b"".join(gzip.compress(warc.encode_record(r)) for r in rows)
        assert [b for _, _, b in warc._gzip_records(io.BytesIO(other), len(other), [])] == [b for _, _, b in got]
        # several records in one member, and members after it
        whole = gzip.compress(b"".join(map(warc.encode_record, rows))) + other
        assert [b for _, _, b in warc._gzip_records(io.BytesIO(whole), len(whole), [])] == [b for _, _, b in got] * 2
        kinds = [("warc_type", "eq", got[-1][1]["warc_type"])]
        some = [b for _, r, b in got if r["warc_type"] == got[-1][1]["warc_type"]]
        assert [b for _, _, b in warc._gzip_records(io.BytesIO(whole), len(whole), kinds)] == some * 2


def test_packed_places_come_back_by_row():
    from martloom.llm import repeats
    ids, pos, h = np.array([7, 7, 9 + (5 << 33), 9 + (5 << 33), 9 + (5 << 33)]), np.array([0, 5, 1, 2, 3]), np.array([10, 11, 10, 12, 11], np.uint64)
    sent = repeats.send(ids, pos, [h], 4)
    table = pa.Table.from_batches([sent])
    got = {}
    for b in range(4):
        part = repeats.answer(1)(table.filter(pa.compute.equal(table["bucket"], b)))
        for i, d in zip(part["block"].to_pylist(), part["data"].to_pylist()):
            got.setdefault(i, []).append(d)
    rows = [repeats.gather(pa.table([pa.array(d)], ["data"])).to_pylist() for d in got.values()]
    assert {r["id"]: sorted(repeats.positions(r["found"]).tolist()) for part in rows for r in part} == {7: [0, 5], 9 + (5 << 33): [1, 3]}
