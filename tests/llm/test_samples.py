"""What the classifiers learn from."""

import random
import zlib

import pytest

from martloom.llm import common, language, toxicity


def test_every_language_keeps_its_share_of_words(spark):
    word = lambda lang, k: lang + "".join(chr(97 + int(c)) for c in f"{k:04d}")
    rows = [(k, lang, " ".join(word(lang, 50 * k + i) for i in range(50))) for k in range(1, 9) for lang in ("aa", "mm", "zz")] + [(9, "yy", "once")]
    docs = common.stored(spark.createDataFrame(rows, "doc_id long, lang string, text string"), "test-languages")
    got = language.sample_words(docs, 300, 301)
    counts = {lang: sum(r.lang == lang for r in got) for lang in ("aa", "mm", "zz", "yy")}
    assert counts == {"aa": 100, "mm": 100, "zz": 100, "yy": 1}
    assert language.learn(docs, max_words=5)[0] == ["aa", "mm", "yy", "zz"]


def test_all_pieces_of_a_long_word_are_learned(spark):
    long = "日" * 16 + "本" * 5
    docs = common.stored(spark.createDataFrame([(1, "ja", long), (3, "en", "word")], "doc_id long, lang string, text string"), "test-pieces")
    got = {(r.lang, bytes(r.word)) for r in language.sample_words(docs, 300, 100)}
    raw = long.encode()
    assert got == {("en", b"word"), *(("ja", raw[a:a + 24]) for a in range(0, len(raw), 24))}


def test_labelled_texts_are_all_kept_and_copies_weigh_one_text(spark):
    rng = random.Random(3)
    line = "a line that all of these texts have in common at their end"
    text = lambda: " ".join(f"w{rng.randrange(10**6)}" for _ in range(40))
    unlike = [f"{text()} {line}" for _ in range(30)]
    copied, empty = text(), ["", None, "  "]
    rows = list(enumerate([*unlike, *[copied] * 20, *empty]))
    learned = [i for i, _ in rows if zlib.crc32(str(i).encode()) % 4 != 2]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, toxic int")
    runs = [toxicity.labelled(docs, labels, 100) for _ in range(2)]
    got = [sorted((r.text, r.toxic, r.weight) for r in sample.collect()) for sample, _, _ in runs]
    assert got[0] == got[1] and len(got[0]) == len(learned)
    assert runs[0][1:] == (sum(i % 2 for i in learned), sum(i % 2 == 0 for i in learned))
    for toxic in (0, 1):
        weights = {t: [w for x, k, w in got[0] if (x, k) == (t, toxic)] for t, _, _ in got[0]}
        assert sum(weights[copied]) == pytest.approx(1) and len(set(weights[copied])) == 1
        own = [w for t in unlike for w in weights.get(t, [])]
        assert all(w > 0 for w in own) and sum(own) >= 0.8 * len(own)


def test_near_copies_of_one_text_do_not_make_their_words_toxic(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(8))
    common_words = [word() for _ in range(300)]
    text = lambda n=60: [rng.choice(common_words) for _ in range(n)]
    passage = [word() for _ in range(60)]
    rows = [(text() + (["idiotic"] if k % 4 == 0 else []), int(k % 4 == 0)) for k in range(600)]
    rows += [(passage, 1)] * 200
    docs = spark.createDataFrame([(i, " ".join(t)) for i, (t, _) in enumerate(rows)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, k) for i, (_, k) in enumerate(rows)], "doc_id long, toxic int")
    lexicon = toxicity.learn(docs, labels)
    assert any(p.strip() in "idiotic" for p in lexicon.weights)
    assert not any(w.startswith(p.strip()) for p in lexicon.weights for w in passage)
