"""Remove bytes that an earlier document has too, decided in suffix arrays of the places where documents meet."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.llm.common import packed
from martloom.llm.lyndon import suffix_order, suffix_orders
from martloom.llm.repeats import FOUND, PLACES, buckets_for, by_row, equal_runs, found_rows, gather, numbered, planes, positions, rows_in, unplanes

MATCH, GRAM = 50, 16
#: Most bytes on one side of an anchor that belong to its stretches; bytes that hold all of them, in whole 64-bit words.
SIDE, WIDE = MATCH - GRAM, 88
#: Bytes of a batch worked on at once; symbols of suffix arrays built together; longest text and fewest texts for which that pays.
BATCH, TOGETHER, LONGEST, FEWEST = 8 << 20, 400_000, 400, 64
#: Stretches whose anchors are looked for at once, so that the work arrays stay in the cache, and the bits that tell a place among them.
PIECE, PIECE_BITS = 1 << 17, np.uint64((1 << 18) - 1)
#: Rows of bytes compared at once.
SOME = 1 << 13
#: Buckets of surroundings to a bucket of anchors: around an anchor up to MATCH + SIDE bytes travel.
FINER = 4
NO_ID = np.iinfo(np.int64).max


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """64-bit hash of the GRAM bytes at each position."""
    n = len(data) - GRAM + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    data = np.ascontiguousarray(data)
    eight = np.empty(n + 8, np.uint64)
    for o in range(8):
        words = data[o:o + (len(data) - o) // 8 * 8].view(np.uint64)
        eight[o::8] = words[:len(eight[o::8])]
    return gram_hash(eight[:n], eight[8:])


def gram_hash(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """The hash of grams by their two halves."""
    h = one * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    h += two
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def slide(x: np.ndarray, width: int, op: np.ufunc) -> np.ndarray:
    """Minimum or maximum of every ``width`` neighbours."""
    done = 1
    while done * 2 <= width:
        x = op(x[:-done], x[done:])
        done *= 2
    rest = width - done
    return op(x[:-rest], x[rest:]) if rest else x


def anchors(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchors of the texts data[starts[i]:starts[i + 1]]: (position, hash, text, first, last).

    Every MATCH bytes of a text belong to the leftmost of the smallest hashes in them (by their leading bits), their anchor, whichever text they are
    in; ``first`` and ``last`` are the starts of the stretches that belong to one. Neighbouring texts do not disturb: what does not lie inside a text is no stretch of it.
    """
    none, parts = np.zeros(0, np.int64), []
    for a in range(0, len(data) - MATCH + 1, PIECE):
        h = gram_hashes(data[a:a + PIECE + MATCH - 1])
        # hash and place in one number: the smallest of a stretch tells its anchor
        place = (slide((h & ~PIECE_BITS) | np.arange(len(h), dtype=np.uint64), SIDE + 1, np.minimum) & PIECE_BITS).astype(np.int64)
        first = np.append(0, np.nonzero(place[1:] != place[:-1])[0] + 1)
        parts.append((place[first] + a, h[place[first]], first + a, np.append(first[1:], len(place)) - 1 + a))
    if not parts:
        return none, np.zeros(0, np.uint64), none, none, none
    p, h, first, last = (np.concatenate(x) for x in zip(*parts))
    begin = np.append(0, np.nonzero(p[1:] != p[:-1])[0] + 1)
    p, h, first, last = p[begin], h[begin], first[begin], last[np.append(begin[1:], len(p)) - 1]
    text = np.searchsorted(starts, p, side="right") - 1
    first = np.maximum(first, starts[text])
    last = np.minimum(last, starts[text + 1] - MATCH)
    ok = first <= last
    return p[ok], h[ok], text[ok], first[ok], last[ok]


def texts_of(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts of a batch, and where each starts."""
    texts = batch.column("text").cast(pa.large_binary())
    starts = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    buffer = texts.buffers()[2]
    data = np.frombuffer(buffer, np.uint8)[starts[0]:starts[-1]] if buffer is not None else np.zeros(0, np.uint8)
    return data, starts - starts[0]


def squeezed(parts: list[bytes]) -> bytes:
    raw = b"".join(parts)
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def unsqueezed(data: bytes) -> bytes:
    return pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)


def steps(x: np.ndarray) -> bytes:
    """Differences of neighbours, which are small where the numbers ascend; ``np.cumsum`` undoes them."""
    return planes(np.diff(x, prepend=0))


def packets(buckets: list[int], blocks: list, data: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(buckets, pa.int32()), pa.array(blocks, pa.int64()), pa.array(data, pa.binary())], ["bucket", "block", "data"])


def by_bucket(bucket: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each bucket and the places that go to it, in their order."""
    order = np.argsort(bucket, kind="stable")
    cut = np.nonzero(np.diff(bucket[order]))[0] + 1
    for part in np.split(order, cut):
        if len(part):
            yield int(bucket[part[0]]), part


def _anchors(buckets: int):
    """One batch's anchors by bucket of their hashes. Of equal ones one is sent, marked as repeated; the others are answers already.

    Which bucket it is and 32 more bits stand for a hash: in a bucket of bounded size hardly any anchor that occurs once is held for a repeated one,
    and one that is costs a look at its surroundings only.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_in(batches, BATCH):
            data, starts = texts_of(batch)
            p, h, text, _, _ = anchors(data, starts)
            if not len(p):
                continue
            ids, pos = batch.column("id").to_numpy()[text], p - starts[text]
            order, begin = equal_runs([h])
            one = order[begin]
            rest = np.ones(len(p), bool)
            rest[one] = False
            twice = np.zeros(len(p), np.uint8)
            twice[one] = np.diff(np.append(begin, len(p))) > 1
            one = np.sort(one)
            blocks, out = found_rows(ids[rest], pos[rest, None])
            bucket = [b % buckets for b in blocks]
            for b, part in by_bucket((h[one] % np.uint64(buckets)).astype(np.int64)):
                pick = one[part]
                key = (h[pick] // np.uint64(buckets)).astype(np.uint32)
                out.append(squeezed([len(pick).to_bytes(8, "little"), steps(ids[pick]), planes(pos[pick].astype(np.uint32)), twice[pick].tobytes(), key.tobytes()]))
                blocks.append(None)
                bucket.append(b)
            yield packets(bucket, blocks, out)
    return run


def _again(table: pa.Table) -> pa.Table:
    """For one bucket: the anchors, by row, of which an equal one exists."""
    blocks, out, parts = [], [], []
    for block, data in zip(table.column("block").to_pylist(), table.column("data")):
        data = data.as_py()
        if block is not None:
            blocks.append(block)
            out.append(data)
            continue
        raw = unsqueezed(data)
        n = int.from_bytes(raw[:8], "little")
        ids, at = unplanes(raw, 8, n, np.int64)
        pos, at = unplanes(raw, at, n, np.uint32)
        parts.append((np.cumsum(ids), pos, np.frombuffer(raw, np.uint8, n, at) > 0, np.frombuffer(raw, np.uint32, n, at + n)))
    if parts:
        ids, pos, twice, key = (np.concatenate(x) for x in zip(*parts))
        order, begin = equal_runs([key])
        sizes = np.diff(np.append(begin, len(order)))
        keep = order[np.repeat((sizes > 1) | np.maximum.reduceat(twice[order], begin), sizes)]
        more, packs = found_rows(ids[keep], pos[keep, None])
        blocks += more
        out += packs
    return pa.table([pa.array(blocks, pa.int64()), pa.array(out, pa.binary())], ["block", "data"])


def windows_at(data: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The ``size`` bytes from each place, in rows of WIDE, zeros behind them."""
    wide = np.concatenate([data, np.zeros(WIDE, np.uint8)])
    every = np.lib.stride_tricks.as_strided(wide, (len(data) + 1, WIDE), (1, 1))
    out = np.empty((len(begin), WIDE), np.uint8)
    for a in range(0, len(begin), SOME):
        some = every[begin[a:a + SOME]]
        some[np.arange(WIDE) >= size[a:a + SOME, None]] = 0
        out[a:a + SOME] = some
    return out


def alike(h: np.ndarray, size: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order in which equal bytes of one anchor stand together, and where each run of them starts in it; compared byte by byte."""
    words = rows.view(np.uint64)
    mix = h ^ (size.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    for k in range(words.shape[1]):
        mix = (mix ^ words[:, k]) * np.uint64(0xD6E8FEB86659FD93)
        mix ^= mix >> np.uint64(32)
    order = np.argsort(mix, kind="stable")
    new = np.ones(len(order), bool)
    if len(order):
        a, b = order[1:], order[:-1]
        new[1:] = (mix[a] != mix[b]) | (h[a] != h[b]) | (size[a] != size[b])
        # mixed alike is nearly always equal; the bytes decide
        near = np.nonzero(~new)[0]
        for at in range(0, len(near), SOME):
            k = near[at:at + SOME]
            new[k] = (words[order[k]] != words[order[k - 1]]).any(axis=1)
    return order, np.nonzero(new)[0]


def owned(doc: np.ndarray, order: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For the runs of equal bytes: the smallest document of each, and which places (of the input) have a larger one and lose them."""
    if not len(order):
        return doc, np.zeros(0, bool)
    least = np.minimum.reduceat(doc[order], begin)
    lose = np.zeros(len(order), bool)
    lose[order] = doc[order] > np.repeat(least, np.diff(np.append(begin, len(order))))
    return least, lose


def spans_by_block(rows: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[list[int], list[bytes]]:
    return found_rows(rows, np.stack([first, last], axis=1))


def _contexts(buckets: int):
    """Around each anchor that occurs again, the bytes of all stretches that belong to it.

    Equal bytes are sent once a batch, for the smallest document id; documents with larger ids lose them whole.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_in(batches, BATCH):
            data, starts = texts_of(batch)
            wanted = np.zeros(len(data) + 1, bool)
            for f, s in zip(batch.column("found").to_pylist(), starts[:-1]):
                wanted[positions(f) + s] = True
            p, h, text, first, last = anchors(data, starts)
            keep = wanted[p]
            p, h, text, first, size = p[keep], h[keep], text[keep], first[keep], last[keep] - first[keep] + MATCH
            row, doc, at = batch.column("id").to_numpy()[text], batch.column("doc").to_numpy()[text], first - starts[text]
            order, begin = alike(h, size, windows_at(data, first, size))
            _, lose = owned(doc, order, begin)
            blocks, out = spans_by_block(row[lose], at[lose], (at + size)[lose])
            bucket = [b % buckets for b in blocks]
            # the places that keep them, one run of equal bytes after the other in the order of their first places
            run_of = np.zeros(len(order), np.int64)
            run_of[order] = np.repeat(order[begin], np.diff(np.append(begin, len(order))))
            kept = np.nonzero(~lose)[0]
            kept = kept[np.argsort(run_of[kept], kind="stable")]
            for b, part in by_bucket((h[kept] % np.uint64(buckets)).astype(np.int64)):
                pick = kept[part]
                lead = np.nonzero(np.diff(run_of[pick], prepend=-1))[0]
                one = pick[lead]
                out.append(squeezed([
                    np.array([len(one), len(pick)], np.int64).tobytes(), (p - first)[one].astype(np.uint8).tobytes(), size[one].astype(np.uint8).tobytes(), steps(doc[one]),
                    planes(np.diff(np.append(lead, len(pick))).astype(np.uint32)), steps(row[pick]), planes(at[pick].astype(np.uint32)),
                    *[data[a:a + n].tobytes() for a, n in zip(first[one].tolist(), size[one].tolist())]]))
                blocks.append(None)
                bucket.append(b)
            yield packets(bucket, blocks, out)
    return run


def shared_starts(contexts: list[list[bytes]], owners: list[list[int]]) -> list[list[np.ndarray]]:
    """For each group and each of its contexts, the offsets of the MATCH bytes that a context with a smaller owner has too.

    A group is one text, its contexts divided by symbols that occur in none of them. In its suffix array, equal stretches of MATCH bytes are
    neighbours; a run of them is shared, and the smallest owner in it keeps its own.
    """
    out: list[list[np.ndarray]] = [[] for _ in contexts]
    lengths = [sum(len(c) + 1 for c in g) + 1 for g in contexts]
    todo = sorted(range(len(contexts)), key=lambda k: lengths[k])
    while todo:
        size, part = lengths[todo[-1]], []
        # the longest first, together with others of nearly that length
        while todo and (not part or (size <= LONGEST and len(part) * size < TOGETHER and lengths[todo[-1]] * 5 >= size * 4)):
            part.append(todo.pop())
        text = np.zeros((len(part), size), np.uint16)
        owner = np.full((len(part), size + MATCH), NO_ID, np.int64)
        valid = np.zeros((len(part), size + MATCH), bool)
        for r, k in enumerate(part):
            at = 0
            for c, d in zip(contexts[k], owners[k]):
                text[r, at:at + len(c)] = np.frombuffer(c, np.uint8)
                text[r, at:at + len(c)] += 2
                text[r, at + len(c)] = 1
                owner[r, at:at + len(c)] = d
                valid[r, at:at + len(c) - MATCH + 1] = True
                at += len(c) + 1
        if size > LONGEST or len(part) < FEWEST:
            order = np.array([suffix_order(row.tolist()) for row in text])
        else:
            order = suffix_orders(text)
        hit = shared_in(text, order, owner, valid)
        for r, k in enumerate(part):
            at = 0
            for c in contexts[k]:
                out[k].append(np.nonzero(hit[r, at:at + len(c)])[0])
                at += len(c) + 1
    return out


def shared_in(text: np.ndarray, order: np.ndarray, owner: np.ndarray, valid: np.ndarray) -> np.ndarray:
    """Which positions start MATCH bytes that a smaller owner in the same text has as well."""
    rows, n = text.shape
    wide = np.zeros((rows, n + MATCH), np.uint16)
    wide[:, :n] = text
    flat, stride = wide.ravel(), n + MATCH
    at = (np.arange(rows)[:, None] * stride + order).ravel()
    good = valid.ravel()[at]
    same = np.zeros(len(at), bool)
    same[1:] = good[1:] & good[:-1] & (at[1:] // stride == at[:-1] // stride)
    pairs = np.nonzero(same)[0]
    # the far end first: neighbours mostly share their beginnings
    for d in (MATCH - 1, *range(MATCH - 1)):
        pairs = pairs[flat[at[pairs] + d] == flat[at[pairs - 1] + d]]
    same[:] = False
    same[pairs] = True
    run = np.nonzero(~same)[0]
    held = owner.ravel()[at]
    least = np.repeat(np.minimum.reduceat(held, run), np.diff(np.append(run, len(at))))
    hit = np.zeros(rows * stride, bool)
    hit[at[(least < held) & good]] = True
    return hit.reshape(rows, stride)


def shared_side(side: np.ndarray, size: np.ndarray, group: np.ndarray) -> np.ndarray:
    """How many bytes of each row's side, from the anchor outwards, some other row of its group has as well (at most its own ``size``)."""
    words = side.view(">u8")
    order = np.lexsort([*(words[:, k] for k in range(words.shape[1] - 1, -1, -1)), group])
    out = np.zeros(len(order), np.int64)
    a, b = order[1:], order[:-1]
    differ = side[a] != side[b]
    equal = np.where(differ.any(axis=1), differ.argmax(axis=1), side.shape[1]) * (group[a] == group[b])
    out[a] = equal
    out[b] = np.maximum(out[b], equal)
    return np.minimum(out, size)


def met(group: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Which rows are in a group with several owners."""
    if not len(group):
        return np.zeros(0, bool)
    order, begin = equal_runs([group])
    several = np.minimum.reduceat(owner[order], begin) < np.maximum.reduceat(owner[order], begin)
    out = np.zeros(len(group), bool)
    out[order] = np.repeat(several, np.diff(np.append(begin, len(order))))
    return out


def _trimmed(rows: np.ndarray, off: np.ndarray, size: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first and last offset in each row of MATCH bytes that another row of its group can have too: none if last < first.

    Equal stretches hold the anchor at the same place, so both rows agree from there outwards, as far as the stretch goes.
    """
    k = np.arange(40)
    after, before = np.empty((len(rows), 40), np.uint8), np.empty((len(rows), 40), np.uint8)
    for a in range(0, len(rows), SOME):
        some, o, n = rows[a:a + SOME], off[a:a + SOME, None], size[a:a + SOME, None]
        at, right, left = np.arange(len(some))[:, None], o + GRAM + k, o - 1 - k
        after[a:a + SOME] = np.where(right < n, some[at, np.minimum(right, WIDE - 1)], 0)
        before[a:a + SOME] = np.where(left >= 0, some[at, np.maximum(left, 0)], 0)
    first = off - shared_side(before, off, group)
    last = np.minimum(size - MATCH, off - SIDE + shared_side(after, size - off - GRAM, group))
    return first, last


def _decide(table: pa.Table) -> pa.Table:
    """For one bucket: the spans that rows lose."""
    blocks, out, parts, texts = [], [], [], []
    for block, data in zip(table.column("block").to_pylist(), table.column("data")):
        data = data.as_py()
        if block is not None:
            blocks.append(block)
            out.append(data)
            continue
        raw = unsqueezed(data)
        n, m = np.frombuffer(raw, np.int64, 2).tolist()
        off, size = np.frombuffer(raw, np.uint8, n, 16), np.frombuffer(raw, np.uint8, n, 16 + n)
        doc, at = unplanes(raw, 16 + 2 * n, n, np.int64)
        count, at = unplanes(raw, at, n, np.uint32)
        row, at = unplanes(raw, at, m, np.int64)
        pos, at = unplanes(raw, at, m, np.uint32)
        size = size.astype(np.int64)
        parts.append((off.copy(), size, np.cumsum(doc), count, np.cumsum(row), pos))
        texts.append(windows_at(np.frombuffer(raw, np.uint8, -1, at), np.cumsum(size) - size, size))
    if parts:
        off, size, doc, count, row, pos = (np.concatenate(x).astype(np.int64) for x in zip(*parts))
        rows = np.concatenate(texts)
        del parts, texts
        which, first, last = lost(off, size, doc, rows)
        place = np.cumsum(count) - count
        n = count[which]
        at = np.repeat(place[which], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        more, packs = spans_by_block(row[at], pos[at] + np.repeat(first, n), pos[at] + np.repeat(last, n))
        blocks += more
        out += packs
    return pa.table([pa.array(blocks, pa.int64()), pa.array(out, pa.binary())], ["block", "data"])


def lost(off: np.ndarray, size: np.ndarray, doc: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, begin, end): the bytes that each of the surroundings ``rows`` loses. ``off``: where its anchor lies in it."""
    flat = np.arange(len(rows)) * WIDE + off
    eight = np.lib.stride_tricks.as_strided(rows.ravel(), (max(0, rows.size - 7), 8), (1, 1))
    h = gram_hash(*(eight[flat + o].view(np.uint64).ravel() for o in (0, 8)))
    order, begin = alike(h, size, rows)
    _, lose = owned(doc, order, begin)
    parts = [(np.nonzero(lose)[0], np.zeros(lose.sum(), np.int64), size[lose])]
    # of equal bytes that their smallest owner has several times one is enough
    lead = np.zeros(len(order), np.int64)
    lead[order] = np.repeat(order[begin], np.diff(np.append(begin, len(order))))
    kept = np.nonzero(~lose)[0]
    _, one, same = np.unique(lead[kept], return_index=True, return_inverse=True)
    one = kept[one]
    several = met(h[one], doc[one])
    at = one[several]
    first, last = _trimmed(rows[at], off[at], size[at], h[at])
    ok = first <= last
    at, first, last = at[ok], first[ok], last[ok]
    ok = met(h[at], doc[at])
    at, first, last = at[ok], first[ok], last[ok]
    # around an anchor with very many surroundings, what is left of them is mostly the same: once more the smallest document keeps it
    _, group, n = np.unique(h[at], return_inverse=True, return_counts=True)
    large = np.nonzero((n * MATCH > LONGEST)[group])[0]
    flat = rows[at[large]].ravel()
    length = last[large] - first[large] + MATCH
    _, over = owned(doc[at[large]], *alike(h[at[large]], length, windows_at(flat, np.arange(len(large)) * WIDE + first[large], length)))
    gone = large[over]
    hits = [(at[gone], first[gone], last[gone] + MATCH)]
    stay = np.ones(len(at), bool)
    stay[gone] = False
    at, first, last = at[stay], first[stay], last[stay]
    ok = met(h[at], doc[at])
    at, first, last = at[ok], first[ok], last[ok]
    order, begin = equal_runs([h[at]])
    at, first, last = at[order], first[order], last[order]
    cut = [*begin.tolist(), len(at)]
    contexts = [rows[i, a:b + MATCH].tobytes() for i, a, b in zip(at.tolist(), first.tolist(), last.tolist())]
    owners = doc[at].tolist()
    starts = shared_starts([contexts[a:b] for a, b in zip(cut[:-1], cut[1:])], [owners[a:b] for a, b in zip(cut[:-1], cut[1:])]) if len(at) else []
    offsets = [o for g in starts for o in g]
    n = np.array([len(o) for o in offsets], np.int64)
    if n.sum():
        who = np.repeat(np.arange(len(at)), n)
        start = np.concatenate(offsets) + first[who]
        new = np.append(True, (np.diff(who) != 0) | (np.diff(start) > MATCH))
        begin = np.nonzero(new)[0]
        end = np.append(begin[1:], len(new)) - 1
        hits.append((at[who[begin]], start[begin], start[end] + MATCH))
    # what one of them loses, its equals of the same document lose as well
    which, a, b = (np.concatenate(x) for x in zip(*hits))
    order = np.argsort(same, kind="stable")
    begin = np.searchsorted(same[order], np.arange(len(one) + 1))
    run = np.zeros(len(rows), np.int64)
    run[one] = np.arange(len(one))
    run = run[which]
    n = begin[run + 1] - begin[run]
    copies = kept[order[np.repeat(begin[run], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]]
    parts.append((copies, np.repeat(a, n), np.repeat(b, n)))
    return tuple(np.concatenate(x) for x in zip(*parts))


def _united(table: pa.Table) -> pa.Table:
    """For one block of rows: the spans of each row, those that overlap or touch as one."""
    spans = gather(table)
    out = []
    for found in spans.column("found").to_pylist():
        pairs = positions(found).reshape(-1, 2)
        pairs = pairs[np.argsort(pairs[:, 0], kind="stable")]
        end = np.maximum.accumulate(pairs[:, 1])
        begin = np.nonzero(np.append(True, pairs[1:, 0] > end[:-1]))[0]
        out.append(np.stack([pairs[begin, 0], end[np.append(begin[1:], len(end)) - 1]], axis=1).astype(np.int32).tobytes())
    return pa.table([spans.column("id"), pa.array(out, pa.binary())], ["id", "found"])


def cut_bytes(raw: bytes, spans: np.ndarray) -> tuple[bytes, int, int]:
    """What is left without the spans, the number of bytes removed, and of the runs they make."""
    if not len(spans):
        return raw, 0, 0
    pairs = spans.reshape(-1, 2)
    edge = np.zeros(len(raw) + 1, np.int64)
    np.add.at(edge, pairs[:, 0], 1)
    np.add.at(edge, pairs[:, 1], -1)
    gone = np.cumsum(edge[:-1]) > 0
    runs = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
    return np.frombuffer(raw, np.uint8)[~gone].tobytes(), int(gone.sum()), runs


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("row").field("text").to_pylist()
        done = [cut_bytes((t or "").encode("utf-8", "replace"), positions(f)) for t, f in zip(texts, batch.column("found").to_pylist())]
        yield pa.RecordBatch.from_arrays(
            [batch.column("row"), pa.array([d[0] for d in done], pa.binary()), pa.array([d[1] for d in done], pa.int64()), pa.array([d[2] for d in done], pa.int64())],
            ["row", "kept", "n_removed", "n_spans"])


def dedup(docs: DataFrame, *, stable: bool = False) -> DataFrame:
    """(row, kept, n_removed, n_spans) per row of ``docs``: the input row as a struct, the bytes that are left, and what went.

    A byte goes if it lies in MATCH bytes (UTF-8) that start in a document with a smaller doc_id as well; all is judged on the input.

    Every stretch of MATCH bytes has one anchor, the smallest hashed gram in it, that depends on its bytes only. Anchors that occur
    once are set aside. Around the others, the stretches of each anchor are gathered by its hash; where all documents have the same bytes
    there, the smallest id keeps them. Where they differ, each is trimmed to what another can share from the anchor outwards; what is left is
    one text, its suffix array is built by linear grouping (``lyndon``), and its runs of MATCH equal bytes tell what is shared with whom.
    No stretch is in two of these texts, so none is compared twice. Anchors and stretches travel packed; the texts are shuffled once.

    NULL text: no bytes, kept is empty. NULL doc_id: never smaller than another. Rows of one id do not count against each other, repeated
    ones included. Texts of fewer than MATCH bytes stay. Empty table: no rows. All columns pass through inside the struct.
    """
    rows = numbered(docs.select(packed(docs)), stable)
    buckets = buckets_for(docs)
    text = F.coalesce(F.col("row.text").cast("string"), F.lit("")).alias("text")
    doc = F.coalesce(F.col("row.doc_id").cast("long"), F.lit(int(NO_ID))).alias("doc")
    again = by_row(rows.select("id", text).mapInArrow(_anchors(buckets), PLACES).groupBy("bucket").applyInArrow(_again, FOUND))
    # the whole row is read in both joins, so that both use one shuffle of the texts
    near = rows.join(again, "id").select("id", "row", "found", text, doc)
    decided = near.mapInArrow(_contexts(FINER * buckets), PLACES).groupBy("bucket").applyInArrow(_decide, FOUND)
    spans = decided.groupBy("block").applyInArrow(_united, "id long, found binary")
    schema = T.StructType([rows.schema["row"], T.StructField("kept", T.BinaryType()), T.StructField("n_removed", T.LongType()), T.StructField("n_spans", T.LongType())])
    return rows.join(spans, "id", "left").select("row", "found").mapInArrow(_cut, schema)


def digest(docs: DataFrame, *, stable: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 (of the bytes that are left) per row of ``docs``."""
    found = dedup(docs.select("doc_id", "text"), stable=stable)
    n = F.coalesce(F.octet_length("row.text"), F.lit(0)).cast("long").alias("n_bytes")
    return found.select("row.doc_id", n, "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
