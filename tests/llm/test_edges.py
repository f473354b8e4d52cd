"""NULLs, empty and long texts, repeated rows, empty tables and clashing names."""

import hashlib

import pytest
from pyspark.sql import functions as F

from martloom.llm import common, decontaminate, language, lm, mixing, quality, simhash, substring, suffix, toxicity, warc

LONG = " ".join(f"w{i % 977}x{i // 977}" for i in range(20_000))
COPY = " ".join(f"copy{i}" for i in range(60))
ROWS = [
    (1, None, "en", "a"), (2, "", "en", "a"), (3, " \t\n", None, "b"), (4, COPY, "en", None), (5, COPY, "fr", "a"), (6, "two words", None, None),
    (6, "two words", None, None), (None, "no id " + COPY, "fr", "b"), (8, LONG, "de", "b"), (9, "日本語 " * 30, "ja", "a"), (10, "!!! ### 12", "en", "a")]
#: Names that operators use inside.
CLASH = ["id", "row", "found", "size", "tokens", "hashes", "score", "print", "bin", "rank", "kept", "w", "doc", "a.b"]


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string, lang string, source string").withColumn("n_chars", F.length("text").cast("long"))
    return common.stored(df.select("*", *[F.lit(f"x{c}").alias(c) for c in CLASH]), "edges")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(4, 1, 1), (6, 0, 0), (None, 1, 1), (77, None, None), (1, 1, 0)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame([(1, " ".join(f"copy{i}" for i in range(20, 40))), (2, None), (3, ""), (4, "two words"), (None, "no id")], "item_id long, text string")


def operators(docs, labels, benchmark):
    return {
        "toxicity": lambda d: toxicity.judge(d, labels), "toxicity clean": lambda d: toxicity.clean(d, labels), "mixing": mixing.mix, "language": language.predict,
        "suffix": suffix.digest, "quality": quality.judge, "substring": substring.digest, "substring trimmed": substring.trimmed,
        "lm": lambda d: lm.scores(d, frequent=20, own=10, rounds=1), "simhash": simhash.near_duplicates, "simhash one": simhash.one_of_each,
        "decontaminate": lambda d: decontaminate.marked(d, benchmark), "decontaminate clean": lambda d: decontaminate.clean(d, benchmark)}


FILTERS = ("toxicity clean", "substring trimmed", "simhash one", "decontaminate clean")
NAMES = sorted(operators(None, None, None))


@pytest.mark.parametrize("name", NAMES)
def test_every_row_has_a_result(docs, labels, benchmark, name):
    out = operators(docs, labels, benchmark)[name](docs)
    n = out.count()
    assert 0 < n <= len(ROWS) if name in FILTERS else n == len(ROWS)
    if name in FILTERS:
        assert out.columns == docs.columns and out.schema["text"].dataType == docs.schema["text"].dataType


@pytest.mark.parametrize("name", NAMES)
def test_empty_table(docs, labels, benchmark, name):
    empty = common.stored(docs.limit(0), "empty")
    assert operators(docs, labels.limit(0), benchmark.limit(0))[name](empty).count() == 0


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


def test_substring_values(docs):
    got = by_id(substring.digest(docs))
    assert (got[1].n_words, got[1].n_removed, got[1].kept_sha256) == (0, 0, hashlib.sha256(b"").hexdigest())
    assert got[4].n_removed == got[5].n_removed == 60 and got[None].n_removed == 60 and got[None].n_words == 62
    assert got[8].n_words == 20_000 and got[6].n_removed == 0
    kept = {r.doc_id: r.text for r in substring.trimmed(docs).collect()}
    assert 4 not in kept and kept[None] == "no id " and kept[1] is None and kept[2] == ""


def test_suffix_values(docs):
    got = by_id(suffix.digest(docs))
    assert (got[1].n_bytes, got[1].n_removed) == (0, 0) and got[4].n_removed == 0
    assert got[5].n_removed == got[5].n_bytes == len(COPY) and got[5].n_spans == 1
    # a document without id loses what others have, and the bytes before the copy that make 50 with it stay
    assert got[None].n_removed == len(COPY) and got[9].n_removed == 0


def test_simhash_values(docs):
    got = by_id(simhash.near_duplicates(docs))
    assert got[1].fingerprint == got[3].fingerprint == "0" * 16 and got[3].component_id == 1
    assert got[5].component_id == 4
    # the text without an id holds the copied one, and 56 of 58 runs of five words are common
    left = [r.doc_id for r in simhash.one_of_each(docs).collect()]
    assert None in left and sorted(i for i in left if i in (1, 2, 3, 4, 5, 6)) == [1, 6] and len(left) == 6


def test_decontaminate_values(docs, benchmark):
    got = by_id(decontaminate.marked(docs, benchmark))
    assert {i for i, r in got.items() if r.contaminated} == {4, 5, None, 6}
    assert (got[4].item_id, got[6].item_id, got[6].n_equal, got[1].n_equal) == (1, 4, 2, 0)


def test_quality_values(docs):
    got = by_id(quality.judge(docs))
    assert (got[1].n_words, got[10].n_symbols, got[1].base_failed, got[1].kept) == (0, 3, True, False)
    assert got[9].n_words == 30 and got[9].n_repeat_words == 30 and got[9].base_failed


def test_quality_thresholds_follow_their_group(spark):
    """The same values are kept in a source that varies widely and not in one that hardly does."""
    def text(size, extra=0):
        return " ".join("abcdefghijklmnopqrstuvwxyz"[:size - (k % 3 == 0)] + str(k) for k in range(60 - extra)) + " #&" * extra

    rows = [(k, "narrow", text(5 + k % 2)) for k in range(200)] + [(1000 + k, "wide", text(4 + k % 12, 30 * (k % 4 == 0))) for k in range(200)]
    rows += [(5000, "narrow", text(14)), (5001, "wide", text(14)), (5002, "narrow", text(6, 30)), (5003, "wide", text(6, 30))]
    df = spark.createDataFrame([(i, "en", s, t) for i, s, t in rows], "doc_id long, lang string, source string, text string")
    got = by_id(quality.judge(df))
    assert [got[k].kept for k in (5000, 5001, 5002, 5003)] == [False, True, False, True]
    assert all(got[k].kept for k in (0, 1, 199, 1001, 1199))
    ranges = {(r.source, r.feature): r for r in quality.spreads(quality.sketches(common.stored(quality.measured(df), "test")), 50, 5).collect()}
    assert ranges["wide", "word_length"].highest - ranges["narrow", "word_length"].highest > 5000
    assert not ranges["wide", "symbols"].floored and ranges["narrow", "symbols"].floored and not ranges["narrow", "word_length"].floored


def test_mixing_values(docs):
    rows = mixing.mix(docs).collect()
    by_source = {}
    for r in rows:
        assert 0 <= r.taken <= 2 * r["size"] and r.taken == r.copies * r["size"]
        by_source[r.source] = (r.source_size, r.target)
    assert sum(t for _, t in by_source.values()) == pytest.approx(1.5 * sum(s for s, _ in by_source.values()))
    assert all(t <= 2 * s for s, t in by_source.values())
    again = mixing.mix(docs.repartition(3))
    assert sorted((str(r.doc_id), r.taken) for r in again.collect()) == sorted((str(r.doc_id), r.taken) for r in rows)


def test_language_values(docs):
    got = by_id(language.predict(docs))
    assert (got[1].lang_pred, got[10].lang_pred, got[10].score) == ("und", "und", 0.0)


def test_language_model_values(docs):
    got = by_id(lm.scores(docs, frequent=20, own=10, rounds=1))
    assert got[1].n_tokens == got[2].n_tokens == 1 and got[1].score == got[2].score < 0


def test_warc_round_trip(spark):
    pages = spark.createDataFrame([(1, "http://a", "x"), (2, None, "x"), (3, "http://b", None), (None, "http://c", ""), (5, "http://d", "é" * 50_000), (5, "http://d", "é" * 50_000)],
                                  "page_id long, url string, html string").withColumn("payload", F.lit("clash"))
    got = sorted(((r.page_id or 0), r.payload_bytes, r.record_type, r.refers_to, len(r.payload_digest)) for r in warc.round_trip(pages).collect())
    assert got == [(0, 0, "revisit", 3, 32), (1, 1, "revisit", 2, 32), (2, 1, "response", None, 32), (3, 0, "response", None, 32),
                   (5, 100_000, "response", None, 32), (5, 100_000, "response", None, 32)]
    assert warc.round_trip(pages.limit(0)).count() == 0
    assert {r.record_type for r in warc.round_trip(pages, min_payload=10**6).collect()} == {"response"}


def test_warc_filters_reach_the_headers(spark, tmp_path):
    pages = spark.createDataFrame([(1, "http://a", "x"), (2, "http://b", "x")], "page_id long, url string, html string")
    warc.export(pages, str(tmp_path / "w"))
    df = warc.read(spark, str(tmp_path / "w")).filter("warc_type = 'response' and target_uri like 'http://b%' and octet_length(payload) = 1")
    assert [r.record_id for r in df.collect()] == ["urn:page:2"]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "warc_type" not in plan.split("Filter")[1].split("BatchScan")[0].replace("warc_type#", "", 0) or "PushedFilters" in plan
