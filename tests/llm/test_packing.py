"""Packing: ids against the tokenizer on whole texts, pieces against one long run, and edge rows."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from martloom.llm import common, packing as K

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def whole(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]


def test_words_equal_whole_texts(tokenizer, monkeypatch):
    monkeypatch.setattr(K, "TEXT", 50)
    monkeypatch.setattr(K, "KNOWN", 500)
    rng = random.Random(0)
    odd = ["", " \n", "a b\x1cc\x85d", "É é ΑΣ. İI <|endoftext|> x<|startoftext|>y", "don't I'LL 12 ½² 日本語 \U0001f600 ̀a  ̸x", "a" * 300 + " b\x0b\x0c\r"]
    odd += ["".join(rng.choice(["a", "B", "'s", " ", "\n", "é", "́", "٣", "#", "日", "​", "\x85", "İ", "ß", "\x1f", "_"]) for _ in range(120)) for _ in range(500)]
    with open(PATH, encoding="utf-8") as file:
        words = K.Words(file.read())
    for text in odd:
        assert [*np.concatenate([*words.encode(text.encode()), np.zeros(0, np.uint32)]).tolist(), 2] == whole(tokenizer, text), text


def check(pieces, texts, tokenizer, length):
    """Every id once, sequences without gaps, only the last one shorter; ``texts``: list of (doc_id, text)."""
    pieces = sorted(pieces, key=lambda r: (r.sequence_id, r.offset))
    at, run = 0, []
    for p in pieces:
        assert p.sequence_id * length + p.offset == at and 0 < p.length <= length - p.offset
        at += p.length
        ids = np.frombuffer(p.ids, "<u4")
        assert len(ids) == p.length
        run.append((p.doc_id, p.start, p.doc_tokens, ids.tolist()))
    want = sorted(((d, whole(tokenizer, t)) for d, t in texts), key=str)
    docs, open_ = [], None
    for d, start, total, ids in run:
        if start == 0:
            open_ = []
            docs.append((d, open_))
        assert docs[-1][0] == d and len(open_) == start
        open_ += ids
        assert len(open_) <= total == total
    assert sorted(docs, key=str) == want


def test_edge_rows(spark, tokenizer, monkeypatch):
    monkeypatch.setattr(K, "CHUNK", 50)
    rng = random.Random(2)
    texts = [(1, None), (2, ""), (None, "no id"), (4, "same text"), (4, "same text"), (5, " ".join(f"w{rng.randrange(999)}" for _ in range(3000)))]
    texts += [(10 + i, "word " * rng.randrange(0, 40)) for i in range(200)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(5).selectExpr("*", "1 AS part", "2 AS place", "'x' AS ids", "3 AS `n`", "4 AS `at`")
    docs = common.stored(docs, "packing-test")
    pieces = K.pack(docs, vocabulary=PATH, length=64).collect()
    check(pieces, texts, tokenizer, 64)
    assert K.pack(docs.limit(0), vocabulary=PATH).count() == 0


def test_whole_table(spark, sf_dir, tokenizer):
    docs = common.table(spark, sf_dir, "documents")
    pieces = K.pack(docs, vocabulary=PATH).persist()
    rows = pieces.collect()
    check(rows, [(r.doc_id, r.text) for r in docs.collect()], tokenizer, 4096)
    from martloom.llm.queries import QUERIES
    got = {(r.doc_id, r.start): r.ids_crc32 for r in QUERIES["op13_pack_sequences"](spark, sf_dir).collect()}
    assert sorted(got.values()) == sorted(zlib.crc32(r.ids) for r in rows) and len(got) == len(rows)
    made = K.sequences(pieces).collect()
    assert all(len(r.ids) == 4096 or r.used == len(r.ids) and r.used & (r.used - 1) == 0 for r in made)
    assert sum(r.used for r in made) == pieces.agg(F.sum("length")).first()[0] and len(made) == max(r.sequence_id for r in rows) + 1
