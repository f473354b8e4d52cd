"""One document of each group of near duplicates, row numbers, and the pipeline's stages on edge rows."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from martloom.llm import common, repeats, simhash, substring
from tests.llm.test_edges import ROWS


def kept_by(found):
    """The smallest id (NULL before all) of each component, from fingerprints held against each other in pairs."""
    prints = {}
    for i, print_ in found:
        prints.setdefault(print_, []).append(i)
    root = {p: p for p in prints}
    for a in prints:
        for b in prints:
            if (int(a, 16) ^ int(b, 16)).bit_count() <= 2 and root[a] != root[b]:
                x, y = root[a], root[b]
                root = {p: min(x, y) if r in (x, y) else r for p, r in root.items()}
    groups = {}
    for p, r in root.items():
        groups.setdefault(r, []).extend(prints[p])
    return sorted((min(ids, key=lambda i: (i is not None, i or 0)) for ids in groups.values()), key=lambda i: (i is not None, i or 0))


def ids_of(df):
    return sorted((r.doc_id for r in df.select("doc_id").collect()), key=lambda i: (i is not None, i or 0))


def test_one_of_each_component_stays(spark):
    rng = random.Random(1)
    texts = []
    for k in range(40):
        words = [f"w{rng.randrange(10**6)}" for _ in range(rng.choice([3, 20, 400]))]
        for copy in range(rng.randrange(1, 5)):
            at = rng.randrange(len(words))
            changed = [*words[:at], "other", *words[at + 1:]] if copy % 2 else words
            texts.append((rng.randrange(10**6) if rng.random() < 0.95 else None, " ".join(changed)))
    texts += [(3, None), (2, " \n"), (2, ""), (7, "the same"), (7, "the same"), (7, "the same")]
    docs = common.stored(spark.createDataFrame(texts, "doc_id long, text string").repartition(3).selectExpr("*", "'x' AS id", "1 AS print", "2 AS component", "3 AS row"), "links")
    found = [(r.doc_id, r.fingerprint) for r in simhash.near_duplicates(docs).collect()]
    for stable in (True, False):
        out = simhash.one_of_each(docs, stable=stable)
        assert ids_of(out) == kept_by(found) and out.columns == docs.columns
    assert simhash.one_of_each(docs.limit(0)).count() == 0


def test_row_numbers_do_not_hang_on_the_cluster(spark, tmp_path):
    path = str(tmp_path / "docs")
    spark.range(40_000).selectExpr("id as doc_id", "repeat(md5(cast(id as string)), 8) as text", "'x' as id").repartition(3).write.option("parquet.block.size", "300000").parquet(path)

    def numbers(most, cost):
        spark.conf.set("spark.sql.files.maxPartitionBytes", most)
        spark.conf.set("spark.sql.files.openCostInBytes", cost)
        try:
            docs = spark.read.parquet(path)
            rows = repeats.numbered(docs.select(common.packed(docs)), True)
            return {r.doc_id: r.id for r in rows.select("row.doc_id", "id").collect()}, rows.rdd.getNumPartitions()
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")

    (few, n), (many, m) = numbers("128m", "64m"), numbers("200k", "1k")
    assert n < m and few == many and len(set(few.values())) == 40_000
    one = spark.read.parquet(sorted(str(f) for f in (tmp_path / "docs").glob("*.parquet"))[0])
    assert repeats.numbered(one.select("doc_id"), True).select("id").distinct().count() == one.count()


def test_intermediate_tables_need_a_shared_folder_on_a_cluster(spark, monkeypatch):
    class Context:
        master = "spark://somewhere:7077"

        @staticmethod
        def getCheckpointDir():
            return None

    class Session:
        sparkContext = Context

        class conf:  # noqa: N801
            @staticmethod
            def get(name, default=None):
                return default

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        common.shared_dir(Session, "x")


def test_stages_on_edge_rows(spark, sf_dir):
    """NULLs in any column, empty, blank and very long texts, repeated rows, columns with clashing names, an empty table."""
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, lang string, source string").withColumn("n_chars", F.length("text").cast("long"))
    docs = common.stored(docs.withColumns({"id": F.lit("x"), "row": F.lit(1), "print": F.lit("p"), "kept": F.lit(True)}), "pipeline-edges")
    empty, columns = common.stored(docs.limit(0), "pipeline-empty"), docs.columns
    for name, stage in corpus_pipeline.STAGES:
        given = docs
        docs, empty = (common.stored(stage(spark, d, sf_dir), f"edges-{name}") for d in (docs, empty))
        assert docs.columns[:len(columns)] == columns and empty.count() == 0, name
        if name == "near-duplicates":
            found = [(r.doc_id, r.fingerprint) for r in simhash.near_duplicates(given).collect()]
            assert ids_of(docs) == kept_by(found)
        if name == "substrings":
            removed = {r.doc_id: (r.n_words, r.n_removed) for r in substring.digest(given).collect()}
            assert set(ids_of(docs)) == {i for i, (n, gone) in removed.items() if gone == 0 or gone < n}
    assert docs.count() > 0 and set(docs.columns) == {*columns, "size", "source_size", "target", "copies", "taken"}


def test_near_duplicate_stage_on_the_table(spark, sf_dir):
    docs = common.stored(corpus_pipeline.not_toxic(spark, common.table(spark, sf_dir, "documents"), sf_dir), "near-given")
    found = [(r.doc_id, r.fingerprint) for r in simhash.near_duplicates(docs).collect()]
    assert ids_of(corpus_pipeline.not_near_duplicate(spark, docs, sf_dir)) == kept_by(found)
