"""Pack tokenised documents into sequences of one length: concatenate all, then cut at fixed places."""

from __future__ import annotations

import os
import re
import sys
import types
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martloom.llm.common import col, stored
from martloom.llm.repeats import rows_in

LENGTH, END = 4096, 2
#: Ids of a document that one stored row holds at most, bytes of text that are cut into words at once, and bytes of a batch.
CHUNK, TEXT, BATCH = 1 << 16, 1 << 20, 8 << 20
#: Words whose ids a worker process remembers: some 150 MB.
KNOWN = 1 << 20
BLANKS = b" \t\n\x0b\x0c\r"
PLAIN = re.compile(rb"([A-Za-z]+)([.,;:!?]?)")


class Places(dict):
    """Words numbered in the order in which they are first asked for; ``new`` has those since it was last emptied."""

    def __init__(self) -> None:
        self.new: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        self.new.append(word)
        self[word] = place = len(self)
        return place


class Words:
    """Ids of texts by a tokenizer that lowers case, splits letters from marks and never joins text across ASCII blanks.

    Every different word is encoded once and remembered.
    """

    def __init__(self, vocabulary: str) -> None:
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the tasks share the cores
        self.tokenizer = Tokenizer.from_str(vocabulary)
        self.model = self.tokenizer.model
        self.clear()

    def clear(self) -> None:
        self.places, self.size = Places(), 0
        self.ids, self.ends = np.zeros(1 << 16, np.uint32), np.zeros(1 << 16, np.int64)

    def learn(self) -> None:
        """Encode the new words; word k has the ids from ends[k] to ends[k + 1]."""
        new, self.places.new = self.places.new, []
        rest = iter(self.tokenizer.encode_batch_fast([w.decode() for w in new if not PLAIN.fullmatch(w)], add_special_tokens=False))
        coded = [self.plain(*m.groups()) if (m := PLAIN.fullmatch(w)) else next(rest).ids for w in new]
        first, flat = len(self.places) - len(new), [i for ids in coded for i in ids]
        self.ids, self.ends = roomy(self.ids, self.size + len(flat)), roomy(self.ends, len(self.places) + 1)
        self.ids[self.size:self.size + len(flat)] = flat
        self.ends[first + 1:first + 1 + len(new)] = self.size + np.cumsum([len(ids) for ids in coded])
        self.size += len(flat)

    def plain(self, letters: bytes, mark: bytes) -> list[int]:
        """Letters of ASCII are one piece of the tokenizer, the mark after them another: no need to normalise and to split."""
        pieces = [letters.lower().decode(), *([mark.decode()] if mark else [])]
        return [token.id for piece in pieces for token in self.model.tokenize(piece)]

    def encode(self, text: bytes) -> Iterator[np.ndarray]:
        """The ids, in runs; long texts are cut at blanks."""
        at = 0
        while at < len(text):
            upto = min(len(text), at + TEXT)
            while upto < len(text) and text[upto] not in BLANKS:
                upto += 1
            words = text[at:upto].split()
            at = upto
            if len(self.places) > KNOWN:
                self.clear()
            where = np.fromiter(map(self.places.__getitem__, words), np.int64, len(words))
            if self.places.new:
                self.learn()
            begin, size = self.ends[where], self.ends[where + 1] - self.ends[where]
            yield self.ids[np.repeat(begin - np.cumsum(size) + size, size) + np.arange(int(size.sum()))]


def roomy(x: np.ndarray, size: int) -> np.ndarray:
    """``x``, or a copy that has room for ``size`` and as much again."""
    return x if len(x) >= size else np.concatenate([x, np.zeros(2 * size - len(x), x.dtype)])


def words_of(vocabulary: str) -> Words:
    """The words that this worker process knows already: it serves many tasks, each of which unpickles this module's functions anew."""
    kept = sys.modules.setdefault("martloom_packing_words", types.ModuleType("martloom_packing_words"))
    key = hash(vocabulary)
    if getattr(kept, "key", None) != key:
        kept.key, kept.words = key, Words(vocabulary)
    return kept.words


def _tokenised(vocabulary, end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, part, place = words_of(vocabulary.value), TaskContext.get().partitionId(), 0
        for batch in rows_in(batches, BATCH):
            rows, out = [], []
            for row, text in enumerate(batch.column("text").to_pylist()):
                ids = np.concatenate([*words.encode((text or "").encode()), np.array([end], np.uint32)]).astype("<u4")
                for at in range(0, len(ids), CHUNK):
                    piece = ids[at:at + CHUNK]
                    rows.append(row)
                    out.append((part, place, at, len(piece), len(ids), piece.tobytes()))
                    place += len(piece)
            kinds = [pa.int32(), *[pa.int64()] * 4, pa.binary()]
            columns = [pa.array(c, k) for c, k in zip(zip(*out), kinds)] if out else [pa.array([], k) for k in kinds]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(rows, pa.int32())), *columns], ["doc_id", "part", "place", "start", "n", "doc_tokens", "ids"])
    return run


def tokenised(docs: DataFrame, vocabulary: str, end: int = END) -> DataFrame:
    """(doc_id, part, place, start, n, doc_tokens, ids): the ids of every document, each with ``end`` after its last, as little-endian 32-bit numbers.

    ``vocabulary`` is the path of a tokenizer file of lower-case word pieces, whose ids never reach across ASCII blanks; its content, of a fixed size, is broadcast. ``part``
    is the number of the task that read the document, ``place`` the ids that the task has before it. Documents of more than 65,536 ids have several rows.
    """
    with open(vocabulary, encoding="utf-8") as file:
        content = docs.sparkSession.sparkContext.broadcast(file.read())
    rows = docs.select(col("doc_id").alias("doc_id"), col("text").cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_tokenised(content, end), f"doc_id {kind}, part int, place long, start long, n long, doc_tokens long, ids binary")


def pack(docs: DataFrame, *, vocabulary: str, length: int = LENGTH, end: int = END) -> DataFrame:
    """Pieces of ``docs`` (doc_id, text): doc_id, start, length, ids, doc_tokens, sequence_id, offset.

    All ids of all documents form one run, which is cut every ``length`` ids, so only the last sequence is shorter. A piece is what one document
    (or 65,536 ids of a long one) has of one sequence: ``length`` ids from its document's id ``start`` on, at ``offset`` of the sequence.
    The first pass encodes every text and writes the ids with their places in the task's run; the totals of the tasks, a row each, are
    summed up to the places where the tasks' runs begin; the second pass cuts with SQL functions. Nothing is shuffled but the totals.

    NULL text: empty, so the document is its ``end``. NULL ids and repeated rows stay rows of their own. Very long texts are encoded by parts of 1 MB
    and end at the next blank. Empty table: no rows. Other columns do not matter.
    """
    runs = stored(tokenised(docs, vocabulary, end), "packing-ids")
    totals = runs.groupBy("part").agg(F.max(F.col("place") + F.col("n")).alias("total"))
    before = F.sum("total").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    bases = F.broadcast(totals.select("part", F.coalesce(before, F.lit(0).cast("long")).alias("base")))  # a row for each task of the first pass
    size = F.lit(length).cast("long")
    placed = runs.join(bases, "part").withColumn("at", F.col("base") + F.col("place"))
    cut = placed.withColumn("sequence_id", F.explode(F.sequence(F.floor(F.col("at") / size), F.floor((F.col("at") + F.col("n") - 1) / size))))
    first = F.greatest(F.col("sequence_id") * size, F.col("at"))
    cut = cut.withColumn("first", first).withColumn("length", F.least((F.col("sequence_id") + 1) * size, F.col("at") + F.col("n")) - F.col("first"))
    ids = F.substr("ids", ((F.col("first") - F.col("at")) * 4 + 1).cast("int"), (F.col("length") * 4).cast("int"))
    return cut.select("doc_id", (F.col("start") + F.col("first") - F.col("at")).alias("start"), "length", ids.alias("ids"), "doc_tokens", "sequence_id",
                      (F.col("first") - F.col("sequence_id") * size).alias("offset"))


def sequences(pieces: DataFrame, length: int = LENGTH, pad: int = 0) -> DataFrame:
    """(sequence_id, ids, used): every sequence's ids as numbers; one that is not full is padded with ``pad`` unless its length is a power of two.

    ``used`` counts the ids before the padding. A sequence has at most ``length`` pieces.
    """
    def joined(table: pa.Table) -> pa.Table:
        table = table.sort_by("offset")
        ids = np.concatenate([np.frombuffer(b, "<u4") for b in table.column("ids").to_pylist()]).astype(np.int64)
        size = len(ids) if len(ids) & (len(ids) - 1) == 0 else length
        return pa.table({"sequence_id": table.column("sequence_id")[:1], "ids": pa.array([np.concatenate([ids, np.full(size - len(ids), pad)])], pa.list_(pa.int64())), "used": [len(ids)]})
    return pieces.select("sequence_id", "offset", "ids").groupBy("sequence_id").applyInArrow(joined, "sequence_id long, ids array<long>, used long")


def digest(docs: DataFrame, *, vocabulary: str, length: int = LENGTH, end: int = END) -> DataFrame:
    """The pieces of ``pack`` with the CRC-32 of their ids in place of the ids."""
    pieces = pack(docs, vocabulary=vocabulary, length=length, end=end)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
