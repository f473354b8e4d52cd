"""Near duplicates by SimHash fingerprints, linked by meet-in-the-middle ball hashing."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.llm.common import ascii_lower, col, packed, stored, text_of, words
from martloom.llm.components import components
from martloom.llm.repeats import numbered

#: The eight bits of a byte, one to a byte of a 64-bit word: 255 hashes can be added up without a carry between bits.
LANES = np.array([int.from_bytes(bytes((b >> k) & 1 for k in range(8)), "little") for b in range(256)], dtype=np.uint64)
PIECE, BLOCK = 255, 1 << 16


def shingle_hashes(tokens: Column, size: int) -> Column:
    """XXH64 (seed 42) of every run of ``size`` tokens joined by blanks; of all of them if there are fewer; of none if none.

    ``tokens`` should be a column of the table, not an expression, which would be evaluated for every shingle.
    """
    runs = F.transform(F.sequence(F.lit(0), F.size(tokens) - F.lit(size)),
                       lambda i: F.xxhash64(F.concat_ws(" ", *[F.get(tokens, i + F.lit(k)) for k in range(size)])))
    short = F.when(F.size(tokens) > 0, F.array(F.xxhash64(F.concat_ws(" ", tokens)))).otherwise(F.array().cast("array<bigint>"))
    return F.when(F.size(tokens) >= size, runs).otherwise(short)


def majority(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """For each run hashes[starts[i]:starts[i + 1]], the bits set in over half of it; an empty run has none."""
    n = len(starts) - 1
    counts = np.zeros((n, 64), np.int64)
    sizes = np.diff(starts)
    # pieces of at most PIECE hashes, none of them across a run
    parts = (sizes + PIECE - 1) // PIECE
    owner = np.repeat(np.arange(n), parts)
    first = np.repeat(np.cumsum(parts) - parts, parts)
    begin = np.repeat(starts[:-1], parts) + (np.arange(len(owner)) - first) * PIECE
    stop = np.minimum(begin + PIECE, np.repeat(starts[1:], parts))
    at = 0
    while at < len(owner):
        to = max(at + 1, int(np.searchsorted(stop, begin[at] + BLOCK, side="right")))
        spread = LANES[hashes[begin[at]:stop[to - 1]].view(np.uint8).reshape(-1, 8)]
        sums = np.add.reduceat(spread, begin[at:to] - begin[at], axis=0)
        np.add.at(counts, owner[at:to], sums.view(np.uint8).reshape(-1, 64))
        at = to
    bits = counts * 2 > sizes[:, None]
    return np.packbits(bits, axis=1, bitorder="little").view(np.uint64).ravel()


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column("hashes")
        starts = lists.offsets.to_numpy().astype(np.int64)
        hashes = np.ascontiguousarray(lists.values.to_numpy(zero_copy_only=False)[starts[0]:starts[-1]].astype(np.int64))
        prints = majority(hashes, starts - starts[0]).view(np.int64)
        yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(prints)], ["row", "print"])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(row, print): the input row as a struct and its 64-bit SimHash as a long.

    Words of the text with A-Z lowered, shingles of ``shingle`` words with repeats, hashed in the JVM; only the hashes pass
    to Python, where bits are counted in numpy. NULL or blank text: print 0.
    """
    split = docs.select(packed(docs), words(ascii_lower(text_of())).alias("tokens"))
    hashed = split.select("row", shingle_hashes(F.col("tokens"), shingle).alias("hashes"))
    schema = T.StructType([hashed.schema["row"], T.StructField("print", T.LongType())])
    return hashed.mapInArrow(_fingerprints, schema)


def masks(reach: int) -> list[int]:
    """All words with at most ``reach`` bits set, as signed longs."""
    found = [sum(1 << b for b in bits) for r in range(reach + 1) for bits in combinations(range(64), r)]
    return [m - (1 << 64) if m >> 63 else m for m in found]


def links(prints: DataFrame, radius: int = 2) -> DataFrame:
    """Links (a, b) between distinct values of ``prints`` (print: long) that connect all pairs differing in at most ``radius`` bits.

    Every value emits all variants within half the radius; two values within the radius share one half way between them. All
    values that share a variant are within the radius of each other, so each is linked to the smallest of them instead of to
    every other: the same components, one row a variant. The distance of every link is checked. ``radius`` is even.
    """
    if radius < 0 or radius % 2:
        raise ValueError("the radius must be even: an odd one has no middle")
    flips = F.explode(F.array(*[F.lit(m) for m in masks(radius // 2)])).alias("flip")
    near = prints.select("print").distinct().select("print", flips).select("print", F.col("print").bitwiseXOR(F.col("flip")).alias("variant"))
    least = F.min("print").over(Window.partitionBy("variant"))
    pairs = near.select("print", least.alias("b")).filter("print <> b").select(F.col("print").alias("a"), "b").distinct()
    return pairs.filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius)


def groups(prints: DataFrame, radius: int = 2, component: str = "id") -> DataFrame:
    """(print, component_id) of every distinct print; component_id is the smallest ``id`` reachable over links, itself included.

    With ``component="print"`` the smallest print reachable is given instead, as ``component``. ``prints`` (id, print) should be a stored table: it
    is read three times.
    """
    nodes = prints.groupBy("print").agg(F.min("id").alias("id"))
    roots = components(links(prints, radius)).withColumnRenamed("a", "print")
    if component == "print":
        return nodes.join(roots, "print", "left").select("print", F.coalesce("root", "print").alias("component"))
    placed = stored(nodes.join(roots, "print", "left").select("print", "id", F.coalesce("root", "print").alias("root")), "simhash-nodes")
    least = placed.groupBy("root").agg(F.min("id").alias("component_id"))
    return placed.join(least, "root").select("print", "component_id")


def near_duplicates(docs: DataFrame, *, shingle: int = 3, radius: int = 2) -> DataFrame:
    """doc_id, fingerprint (16 lower-case hex digits) and component_id per row of ``docs``.

    Copies are one node: equal fingerprints are grouped before any variant is made. NULL or blank text has the fingerprint
    zero and is linked like any other. A component without any id (all NULL) has component_id NULL. Repeated rows
    each keep their row. Empty table: no rows. Other columns do not matter.
    """
    prints = stored(fingerprints(docs.select("doc_id", "text"), shingle).select(F.col("row.doc_id").alias("id"), "print"), "simhash-prints")
    found = prints.join(groups(prints, radius), "print")
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, *, shingle: int = 3, radius: int = 2, stable: bool = False) -> DataFrame:
    """``docs`` without near duplicates: of each component of ``near_duplicates`` the row with the smallest doc_id stays, of rows that share it the first.

    A NULL id is the smallest. NULL and blank texts have the fingerprint zero, so one of them stays. Very long texts are read whole. Empty
    table: no rows. All columns as they came, whatever their names. ``stable`` says that ``docs`` is read straight from Parquet files, else it is written first.
    """
    rows = numbered(docs.select(packed(docs)), stable)
    texts = rows.select("id", F.col("row.text").alias("text"), F.col("row.doc_id").alias("doc_id"))
    prints = stored(fingerprints(texts, shingle).select(F.col("row.doc_id").alias("id"), F.col("row.id").alias("place"), "print"), "simhash-prints")
    placed = prints.join(groups(prints.select("id", "print"), radius, component="print"), "print")
    # copies are reduced to one row a task and component before they meet
    stays = placed.groupBy("component").agg(F.min(F.struct("id", "place")).alias("first")).select(F.col("first.place").alias("id"))
    return rows.join(stays, "id", "left_semi").select("row.*")
