"""Exchange of hashed places between texts: which of them have an equal elsewhere.

Places are packed into one binary row a batch and bucket instead of a row each. Of the places of one batch that are equal only
one is sent, so a hash that a third of all texts share costs one entry a batch; the bucket's task answers with the places to keep.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import col, stored

#: Bytes of text to a bucket.
BUCKET_BYTES = 16 << 20
#: Answers to 256 neighbouring rows travel together.
BLOCK_BITS = 8
#: Bits of a row's number that tell its place in its file.
PLACE_BITS = 36
PLACES = "bucket int, block long, data binary"
FOUND = "block long, data binary"


def numbered(docs: DataFrame, stable: bool) -> DataFrame:
    """``docs`` with a number ``id`` for every row that is the same each time the table is read, whatever the cluster is by then.

    A row's number is that of its file, by name, and its place in the file, not that of a task: how Spark cuts files into tasks hangs on the
    cores it has just then. ``stable`` says that ``docs`` comes straight from Parquet files; anything else is written first. The file names come to
    the driver, which holds them to plan the scan, and go back with the tasks. Input columns named ``id`` are replaced, so keep them
    inside a struct; ``docs`` may be a selection of columns.
    """
    if not stable:
        docs = stored(docs, "numbered")
    file = F.col("_metadata.file_path")
    names = sorted(r.file for r in docs.select(file.alias("file")).distinct().collect())
    return docs.select("*", (F.shiftleft(number_of(names, file), PLACE_BITS) + F.col("_metadata.row_index")).alias("id"))


def number_of(names: list[str], name: Column) -> Column:
    """The place of ``name`` in ``names``, looked up by hash in constant arrays; a join would keep Spark from using one shuffle of the texts twice."""
    hashes = [xxhash.xxh64_intdigest(n.encode(), 42) for n in names]
    if len(set(hashes)) < len(names):
        raise ValueError("two files have names of one hash")
    slots: list[list[tuple[int, int]]] = [[] for _ in names] or [[]]
    for k, h in enumerate(hashes):
        slots[h % len(slots)].append((h - (1 << 64) if h >> 63 else h, k))
    keys, places = (F.expr("array(" + ",".join("array(" + ",".join(f"{pair[i]}L" for pair in slot or [(-1, -1)]) + ")" for slot in slots) + ")") for i in (0, 1))
    h = F.xxhash64(name)
    # the remainder of the hash as an unsigned number
    slot = F.pmod(F.pmod(h, F.lit(len(slots))) + F.when(h < 0, (1 << 64) % len(slots)).otherwise(0), F.lit(len(slots))).cast("int")
    # never NULL, or Spark would put a filter below one of two joins on the number, and shuffle the texts for each
    return F.coalesce(F.get(F.get(places, slot), (F.array_position(F.get(keys, slot), h) - 1).cast("int")), F.lit(0).cast("long"))


def buckets_for(docs: DataFrame) -> int:
    """Number of buckets: in proportion to the bytes of text, and at least the session's shuffle width."""
    size = docs.agg(F.coalesce(F.sum(F.octet_length(col("text"))), F.lit(0)).alias("n")).first().n
    return max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET_BYTES))


def planes(x: np.ndarray) -> bytes:
    """Bytes of equal weight together: small numbers leave long runs of zeros, which the shuffle compresses."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), -1).T).tobytes()


def unplanes(data: bytes, at: int, n: int, kind: type) -> tuple[np.ndarray, int]:
    width = np.dtype(kind).itemsize
    raw = np.frombuffer(data, np.uint8, n * width, at).reshape(width, n)
    return np.ascontiguousarray(raw.T).view(kind).ravel(), at + n * width


def equal_runs(keys: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """An order that brings equal keys together, and where each run of them starts in it."""
    order = np.lexsort(keys[::-1])
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = False
        for k in keys:
            s = k[order]
            new[1:] |= s[1:] != s[:-1]
    return order, np.nonzero(new)[0]


def found_rows(ids: np.ndarray, values: np.ndarray) -> tuple[list[int], list[bytes]]:
    """Answers (row, 32-bit numbers) packed by block of rows: the blocks, and the bytes of each."""
    order = np.argsort(ids, kind="stable")
    ids, values = ids[order], values[order].astype(np.int32)
    blocks = ids >> BLOCK_BITS
    cut = [0, *(np.nonzero(np.diff(blocks))[0] + 1).tolist(), len(ids)] if len(ids) else []
    packs = [np.array([b - a, values.shape[1]], np.int64).tobytes() + planes(ids[a:b]) + values[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:])]
    return blocks[cut[:-1]].tolist(), packs


def gather(table: pa.Table) -> pa.Table:
    """For one block of rows: all answers of each row."""
    ids, values = [], []
    for data in table.column("data").to_pylist():
        n, width = np.frombuffer(data, np.int64, 2).tolist()
        found, at = unplanes(data, 16, n, np.int64)
        ids.append(found)
        values.append(np.frombuffer(data, np.int32, n * width, at).reshape(n, width))
    ids, values = np.concatenate(ids), np.concatenate(values)
    order = np.argsort(ids, kind="stable")
    ids, values = ids[order], values[order]
    cut = [0, *(np.nonzero(np.diff(ids))[0] + 1).tolist(), len(ids)]
    return pa.table([pa.array(ids[cut[:-1]]), pa.array([values[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:])], pa.binary())], ["id", "found"])


def send(ids: np.ndarray, pos: np.ndarray, keys: list[np.ndarray], buckets: int) -> pa.RecordBatch:
    """One batch's places: ``ids`` of rows (long), ``pos`` in them, and one or two 64-bit hashes each.

    A run of equal places is sent once, marked as repeated; its other places are answers already.
    """
    order, starts = equal_runs(keys)
    sizes = np.diff(np.append(starts, len(order)))
    first = order[starts]
    rest = np.ones(len(order), bool)
    rest[starts] = False
    out_blocks, out_data = found_rows(ids[order[rest]], pos[order[rest], None])
    rows = [np.array(out_blocks, np.int64) % buckets]
    bucket = (keys[0][first] % np.uint64(buckets)).astype(np.int64)
    by_bucket = np.argsort(bucket, kind="stable")
    first, twice, bucket = first[by_bucket], (sizes > 1)[by_bucket], bucket[by_bucket]
    cut = np.concatenate([[0], np.nonzero(np.diff(bucket))[0] + 1, [len(bucket)]]) if len(bucket) else [0]
    for a, b in zip(cut[:-1], cut[1:]):
        pick = first[a:b]
        data = [np.array([b - a], np.int64).tobytes(), planes(ids[pick]), planes(pos[pick].astype(np.uint32)), twice[a:b].astype(np.uint8).tobytes()]
        out_data.append(b"".join(data + [planes(k[pick]) for k in keys]))
        out_blocks.append(None)
        rows.append(bucket[a:a + 1])
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(rows).astype(np.int32)), pa.array(out_blocks, pa.int64()), pa.array(out_data, pa.binary())], ["bucket", "block", "data"])


def answer(width: int) -> Callable[[pa.Table], pa.Table]:
    """For one bucket: the places, by row, of which an equal one exists."""
    def run(table: pa.Table) -> pa.Table:
        out_blocks, out_data = [], []
        ids, pos, twice, keys = [], [], [], [[] for _ in range(width)]
        for block, data in zip(table.column("block").to_pylist(), table.column("data").to_pylist()):
            if block is not None:
                out_blocks.append(block)
                out_data.append(data)
                continue
            n = int(np.frombuffer(data, np.int64, 1)[0])
            idx, at = unplanes(data, 8, n, np.int64)
            ids.append(idx)
            p, at = unplanes(data, at, n, np.uint32)
            pos.append(p)
            twice.append(np.frombuffer(data, np.uint8, n, at))
            at += n
            for k in keys:
                h, at = unplanes(data, at, n, np.uint64)
                k.append(h)
        if ids:
            ids, pos, twice, hashes = np.concatenate(ids), np.concatenate(pos), np.concatenate(twice) > 0, [np.concatenate(k) for k in keys]
            order, starts = equal_runs(hashes)
            sizes = np.diff(np.append(starts, len(order)))
            keep = order[np.repeat((sizes > 1) | np.maximum.reduceat(twice[order], starts), sizes)]
            blocks, more = found_rows(ids[keep], pos[keep, None])
            out_blocks += blocks
            out_data += more
        return pa.table([pa.array(out_blocks, pa.int64()), pa.array(out_data, pa.binary())], ["block", "data"])
    return run


def by_row(found: DataFrame) -> DataFrame:
    """(id, found): one row a row that has answers, from packed answers (block, data)."""
    return found.groupBy("block").applyInArrow(gather, "id long, found binary")


def repeated(places: DataFrame, width: int) -> DataFrame:
    """(id, found): for each row, the positions of its places that have an equal anywhere, as 32-bit numbers."""
    return by_row(places.groupBy("bucket").applyInArrow(answer(width), FOUND))


def positions(found: bytes | None) -> np.ndarray:
    return np.frombuffer(found or b"", np.int32).astype(np.int64)


def rows_in(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """Smaller batches where a column of a batch is large, so that work arrays stay small."""
    for batch in batches:
        step = max(1, int(len(batch) * limit / max(1, batch.nbytes)))
        for at in range(0, len(batch), step):
            yield batch.slice(at, step)
