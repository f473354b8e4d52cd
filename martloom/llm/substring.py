"""Remove passages that occur elsewhere, found by anchors at the positions of a difference cover."""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.llm.common import packed, words
from martloom.llm.repeats import PLACES, buckets_for, numbered, positions, repeated, rows_in, send

WINDOW, PERIOD = 35, 21
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Odd multipliers of the rolling hashes, and of the mixing of word hashes.
BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
MIX = np.uint64(0xBF58476D1CE4E5B9)
#: Bytes of a batch that is worked on at once.
BATCH = 8 << 20


def difference_cover(period: int) -> tuple[int, ...]:
    """The first smallest set of residues such that any two positions reach it together within one period."""
    for size in range(1, period + 1):
        for rest in combinations(range(1, period), size - 1):
            cover = (0, *rest)
            if len({(a - b) % period for a in cover for b in cover}) == period:
                return cover
    raise ValueError("a period is at least 1")


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * MIX
    return h ^ (h >> np.uint64(29))


def run_hashes(x: np.ndarray, size: int, base: int) -> np.ndarray:
    """64-bit hash of every run of ``size`` of the hashed words ``x``, by prefix sums of a polynomial with an odd base."""
    n = len(x)
    if n < size:
        return np.zeros(0, np.uint64)
    powers = np.full(n, base, np.uint64)
    powers[0] = 1
    powers = np.multiply.accumulate(powers)
    inverse = np.full(n, pow(base, -1, 1 << 64), np.uint64)
    inverse[0] = 1
    inverse = np.multiply.accumulate(inverse)
    sums = np.concatenate([np.zeros(1, np.uint64), np.add.accumulate(mixed(x ^ np.uint64(base)) * powers)])
    return mixed((sums[size:] - sums[:-size]) * inverse[:n - size + 1])


def _hash_lists(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    lists = batch.column("hashes")
    starts = lists.offsets.to_numpy().astype(np.int64)
    return lists.values.to_numpy(zero_copy_only=False)[starts[0]:starts[-1]].astype(np.int64).view(np.uint64), starts - starts[0]


def _anchors(window: int, period: int, buckets: int):
    cover, size = np.array(difference_cover(period)), window - period + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_in(batches, BATCH):
            flat, starts = _hash_lists(batch)
            ids, pos, keys = [], [], []
            for row, a, b in zip(batch.column("id").to_pylist(), starts[:-1], starts[1:]):
                if b - a < window:
                    continue
                last = b - a - size
                at = (np.arange(0, last + 1, period)[:, None] + cover).ravel()
                at = at[at <= last]
                keys.append(run_hashes(flat[a:b], size, BASES[0])[at])
                pos.append(at)
                ids.append(np.full(len(at), row, np.int64))
            if ids:
                yield send(np.concatenate(ids), np.concatenate(pos), [np.concatenate(keys)], buckets)
    return run


def _windows(window: int, period: int, buckets: int):
    """Around every repeated anchor, all windows that hold it, each with a 128-bit hash of its words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_in(batches, BATCH):
            flat, starts = _hash_lists(batch)
            ids, pos, one, two = [], [], [], []
            for row, found, a, b in zip(batch.column("id").to_pylist(), batch.column("found").to_pylist(), starts[:-1], starts[1:]):
                p = positions(found)
                near = np.zeros(b - a + 1, np.int64)
                np.add.at(near, np.maximum(p - period + 1, 0), 1)
                np.add.at(near, p + 1, -1)
                at = np.nonzero(np.cumsum(near)[:b - a - window + 1] > 0)[0]
                x = flat[a:b]
                one.append(run_hashes(x, window, BASES[0])[at])
                two.append(run_hashes(x, window, BASES[1])[at])
                pos.append(at)
                ids.append(np.full(len(at), row, np.int64))
            if ids:
                yield send(np.concatenate(ids), np.concatenate(pos), [np.concatenate(one), np.concatenate(two)], buckets)
    return run


def covered(starts: np.ndarray, window: int, n: int) -> np.ndarray:
    """Which of n places lie in one of the windows."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, np.minimum(starts + window, n), -1)
    return np.cumsum(edge[:n]) > 0


def cut_words(text: str, starts: np.ndarray, window: int) -> tuple[str, int, int]:
    """The text without the words of the windows, each with the blanks after it; the number of words, and of those removed."""
    spans = [m.span() for m in _WORD.finditer(text)] if len(starts) else None
    if spans is None:
        return text, len(_WORD.findall(text)), 0
    gone = covered(starts, window, len(spans))
    begin = np.array([s for s, _ in spans] + [len(text)])
    edges = np.nonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))[0].reshape(-1, 2)
    parts, at = [], 0
    for a, b in edges:
        parts.append(text[at:begin[a]])
        at = begin[b]
    parts.append(text[at:])
    return "".join(parts), len(spans), int(gone.sum())


def _cut(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = [cut_words(t or "", positions(f), window) for t, f in zip(batch.column("row").field("text").to_pylist(), batch.column("found").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array([d[0] for d in done], pa.string()), pa.array([d[1] for d in done], pa.int64()), pa.array([d[2] for d in done], pa.int64())],
                ["row", "kept", "n_words", "n_removed"])
    return run


def dedup(docs: DataFrame, *, window: int = WINDOW, period: int = PERIOD, stable: bool = False) -> DataFrame:
    """(row, kept, n_words, n_removed) per row of ``docs``: the input row as a struct, the text that is left, and its words.

    Every word goes that lies in a window of ``window`` words which occurs once more anywhere, in the same text too; all is judged
    on the input. Of any two equal windows, one of the first ``period`` offsets brings both to positions of the difference cover, so
    the runs of window - period + 1 words hashed there meet; they are a quarter of all positions. Around repeated anchors the match
    is extended: every window that holds one is hashed whole, on 128 bits, and those that occur twice are removed. Anchors and
    windows are exchanged in packed batches (see ``repeats``); the texts are shuffled once.

    NULL text: no words, kept is empty. Texts of fewer than ``window`` words stay as they are. Repeated rows are copies of each
    other. Empty table: no rows. All columns pass through inside the struct.
    """
    if not 0 < period <= window:
        raise ValueError("the period is at most the window")
    rows = numbered(docs.select(packed(docs)), stable)
    buckets = buckets_for(docs)
    hashed = F.transform("tokens", lambda w: F.xxhash64(w)).alias("hashes")
    hashes = rows.select("id", words(text_of_row()).alias("tokens")).select("id", hashed)
    anchors = repeated(hashes.mapInArrow(_anchors(window, period, buckets), PLACES), 1)
    # the whole row is read in both joins, so that both use one shuffle of the texts
    near = rows.join(anchors, "id").select("id", "row", "found", words(text_of_row()).alias("tokens")).select("id", "row", "found", hashed)
    twice = repeated(near.mapInArrow(_windows(window, period, buckets), PLACES), 2)
    schema = T.StructType([rows.schema["row"], T.StructField("kept", T.StringType()), T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType())])
    return rows.join(twice, "id", "left").select("row", "found").mapInArrow(_cut(window), schema)


def text_of_row():
    return F.coalesce(F.col("row.text").cast("string"), F.lit(""))


def digest(docs: DataFrame, *, window: int = WINDOW, period: int = PERIOD, stable: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256, the SHA-256 of the kept words joined by single blanks."""
    found = dedup(docs.select("doc_id", "text"), window=window, period=period, stable=stable)
    return found.select("row.doc_id", "n_words", "n_removed", F.sha2(F.concat_ws(" ", words(F.col("kept"))).cast("binary"), 256).alias("kept_sha256"))


def trimmed(docs: DataFrame, *, window: int = WINDOW, period: int = PERIOD, stable: bool = False) -> DataFrame:
    """``docs`` with what is left of the texts; a text of which nothing is left goes, and n_chars is counted anew where it exists.

    Rows of which nothing is removed stay as they are, those with NULL or empty texts included."""
    found = dedup(docs, window=window, period=period, stable=stable).filter((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_words")))
    new = {"text": F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("row.text")),
           "n_chars": F.when(F.col("n_removed") > 0, F.length("kept")).otherwise(F.col("row.n_chars")) if "n_chars" in docs.columns else None}
    return found.select(*[(new[c].cast(docs.schema[c].dataType) if c in new else F.col("row").getField(c)).alias(c) for c in docs.columns])
