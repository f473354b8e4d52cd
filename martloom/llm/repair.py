"""Repair the structure of conversations by the cheapest edits, searched by iterative-deepening A*.

A conversation is sound if the initials of its roles read ``(s?(ua)+)?``: an optional system row, then pairs of user and assistant.
Edits are told by one letter each: (D)elete a row, (I)nsert an empty row, (K)eep a row, (R)erole it. After the rows read so far, only
one role can be inserted or set, so the letters and the rows tell the repaired conversation.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from math import inf

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.llm.common import col, stored

BLANK = " \t\n\x0b\x0c\r"
#: Kinds of rows.
CLEAN, TRUNCATED, BLANKED, DUPLICATE = range(4)
#: What has been read: nothing, the system row, a user's row last, an assistant's row last. A conversation may end in ENDS.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES, ENDS = range(4), (START, ASSISTANT)
#: The state that an inserted or re-roled row leads to, and its role.
NEXT = (USER, USER, ASSISTANT, USER)
ROLE = {USER: "user", ASSISTANT: "assistant"}
#: The state that a kept row leads to, by state and initial.
KEEP = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
LEGAL = {"su", "ua", "au"}
#: Costs of the edits; a truncated row that stays costs LOOSE more.
RETITLE, DELETE, INSERT, LOOSE = 1, 2, 5, 5
#: Rows that one search takes; longer conversations are searched in pieces that are put together exactly.
PIECE = 64

Row = tuple[str, int]  # initial of the role, kind


def estimates(rows: list[Row]) -> list[int]:
    """For every place, costs that the rows from there on have in any case.

    A faulty row costs its deletion at least. Of two clean rows that follow each other but for faulty ones and do not fit, one is edited, or
    something between them is inserted or kept that need not be; pairs without a common row cost one each.
    """
    out, faulty, after, pairs = [0] * (len(rows) + 1), 0, "", [0, 0]  # pairs[k + 1]: of the last k clean rows
    for i in range(len(rows) - 1, -1, -1):
        initial, kind = rows[i]
        if kind == CLEAN:
            pairs.append(max(pairs[-1], pairs[-2] + (len(pairs) > 2 and initial + after not in LEGAL)))
            after = initial
        else:
            faulty += DELETE
        out[i] = faulty + pairs[-1]
    return out


def cheapest(rows: list[Row], start: int, goals: tuple[int, ...], tail: bool) -> tuple[int, str]:
    """Cost and letters of the cheapest edits that lead from ``start`` to one of ``goals``; of equally cheap ones those that come first in ASCII.

    Iterative-deepening A*: depth-first search in the order D, I, K, R under a bound on the cost; the bound grows to the least cost
    that went beyond it, so the first path to a goal is the answer. The transposition table holds, for a place and state that failed, what it
    costs from there at least. ``tail`` allows inserts after the last row. A goal must be in reach (see ``reachable``).
    """
    n, ahead = len(rows), estimates(rows)
    least: dict[tuple[int, int], float] = {}

    def edits(i: int, state: int) -> Iterator[tuple[str, int, int, int]]:
        if i < n:
            yield "D", DELETE, i + 1, state
        if i < n or tail:
            yield "I", INSERT, i, NEXT[state]
        if i < n and rows[i][1] in (CLEAN, TRUNCATED):
            stay = LOOSE if rows[i][1] == TRUNCATED else 0
            if (state, rows[i][0]) in KEEP:
                yield "K", stay, i + 1, KEEP[state, rows[i][0]]
            yield "R", RETITLE + stay, i + 1, NEXT[state]

    def needs(i: int, state: int) -> float:
        return least.get((i, state), inf if i == n and not tail and state not in goals else ahead[i])

    def search(bound: float) -> str | None:
        # a stack of open places: (place, state, budget left, its edits, least cost beyond the budget so far)
        path, stack = [], [[0, start, bound, edits(0, start), inf]]
        if n == 0 and start in goals:
            return ""
        while stack:
            i, state, left, rest, _ = top = stack[-1]
            for letter, cost, j, to in rest:
                need = cost + needs(j, to)
                if need > left:
                    top[4] = min(top[4], need)
                    continue
                path.append(letter)
                if j == n and to in goals:
                    return "".join(path)
                stack.append([j, to, left - cost, edits(j, to), inf])
                break
            else:
                least[i, state] = max(needs(i, state), top[4])
                stack.pop()
                if stack:
                    # the edit that led here fails: what it costs with what is known now
                    path.pop()
                    above = stack[-1]
                    above[4] = min(above[4], above[2] - left + least[i, state])
        return None

    bound = needs(0, start)
    while (found := search(bound)) is None:
        bound = needs(0, start)
    return int(bound), found


def reachable(rows: list[Row], start: int) -> list[int]:
    """The states that edits of these rows can lead to from ``start``: nothing leads back to START, only a kept row to SYSTEM."""
    system = start == SYSTEM or start == START and any(initial == "s" and kind in (CLEAN, TRUNCATED) for initial, kind in rows)
    return [s for s in STATES if s in (USER, ASSISTANT) or s == START == start or s == SYSTEM and system]


Table = dict[int, dict[int, tuple[int, str]]]  # by state before and after: cost and letters


def table_of(rows: list[Row], starts: Iterable[int]) -> Table:
    """The cheapest edits of one piece between any two states; letters end with a row's, so none is the beginning of another."""
    return {s: {t: cheapest(rows, s, (t,), False) for t in reachable(rows, s)} for s in starts}


class Chain:
    """Pieces one after the other, from one state: the cheapest letters to every state.

    Letters from one state to two others differ before either ends, so an order of the (at most four) ways so far is all that is needed to
    compare longer ones; the letters themselves are put together once.
    """

    def __init__(self, start: int) -> None:
        self.cost, self.rank, self.back = {start: 0}, {start: 0}, []

    def add(self, table: Table) -> None:
        best: dict[int, tuple[int, int, str, int]] = {}
        for s, cost in self.cost.items():
            for t, (more, letters) in table[s].items():
                way = (cost + more, self.rank[s], letters, s)
                best[t] = min(best.get(t, way), way)
        order = sorted(best, key=lambda t: best[t][1:3])
        self.cost, self.rank = {t: best[t][0] for t in best}, {t: k for k, t in enumerate(order)}
        self.back.append({t: (best[t][3], best[t][2]) for t in best})

    def letters(self, end: int) -> str:
        parts = []
        for step in reversed(self.back):
            end, part = step[end]
            parts.append(part)
        return "".join(reversed(parts))

    def ways(self) -> dict[int, tuple[int, str]]:
        return {t: (self.cost[t], self.letters(t)) for t in self.cost}

    def finish(self) -> tuple[int, str]:
        """Cost and letters to a sound end: a user's row needs one more, a system row two."""
        more = {START: 0, ASSISTANT: 0, USER: 1, SYSTEM: 2}
        end = min(self.cost, key=lambda t: (self.cost[t] + INSERT * more[t], self.rank[t]))
        return self.cost[end] + INSERT * more[end], self.letters(end) + "I" * more[end]


def kind_of(text: Column) -> Column:
    """Blank, truncated (the last character that is not blank does not end a sentence) or clean."""
    last = F.right(F.rtrim(text, F.lit(BLANK)), F.lit(1))
    return F.when(last == "", BLANKED).when(~last.isin(".", "!", "?"), TRUNCATED).otherwise(CLEAN)


def _cells(convs: DataFrame) -> list[Column]:
    """conv_id, turn, role, text as they count: NULL roles and texts are one space."""
    return [col("conv_id").alias("conv_id"), col("turn").alias("turn"), F.coalesce(col("role").cast("string"), F.lit(" ")).alias("role"),
            F.coalesce(col("text").cast("string"), F.lit(" ")).alias("text")]


def _order(*second: Column) -> list[Column]:
    """Rows of a conversation by turn; rows of one turn by role and digest of the text, which tells equal rows only from others."""
    return [F.col("conv_id").asc_nulls_first(), *second, F.col("turn").asc_nulls_first(), F.col("role").asc(), F.col("digest").asc()]


def entries(convs: DataFrame) -> DataFrame:
    """(conv_id, turn, role, digest, kind, copies, repeated): equal rows of a conversation and turn as one, without their texts.

    ``repeated``: role and text occur at an earlier turn. Digests are grouped, not collected, so a conversation of very many rows, or a
    text that it repeats very often, is spread over tasks.
    """
    light = convs.select(*_cells(convs)).select("conv_id", "turn", "role", F.unhex(F.md5(F.col("text").cast("binary"))).alias("digest"), kind_of(F.col("text")).alias("kind"))
    rows = light.groupBy("conv_id", "turn", "role", "digest", "kind").agg(F.count("*").alias("copies"))
    when = F.struct(F.col("turn").isNotNull(), F.col("turn"))
    often = rows.groupBy("conv_id", "role", "digest").agg(F.min(when).alias("first"), F.count("*").alias("n")).filter("n > 1").select(
        F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d"), "first")
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("digest") == F.col("d"))
    return rows.join(often, same, "left").select(*rows.columns, F.coalesce(when > F.col("first"), F.lit(False)).alias("repeated"))


def _groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[object, Iterator[tuple]]]:
    """Runs of rows with one key, read one row after the other; a run must be read before the next is asked for."""
    def rows() -> Iterator[tuple]:
        for batch in batches:
            at = batch.schema.get_field_index(key)
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                yield row[at], row

    source = rows()
    head = next(source, None)

    def run(value) -> Iterator[tuple]:
        nonlocal head
        while head is not None and head[0] == value:
            row, head = head[1], None
            yield row
            head = next(source, None)

    while head is not None:
        value = head[0]
        yield value, run(value)


def arrow_type(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def _batches(rows: Iterator[tuple], names: list[str], types: list[pa.DataType], limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Record batches of some ``limit`` characters of text."""
    out, size = [], 0
    for row in rows:
        out.append(row)
        size += 100 + sum(len(v) for v in row if isinstance(v, str))
        if size > limit:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)
            out, size = [], 0
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)


class Part:
    """What a sorted partition has of one conversation."""

    def __init__(self, starts: Iterable[int]) -> None:
        self.faults, self.illegal, self.size, self.opening, self.closing = [0, 0, 0, 0], 0, 0, None, None
        self.buffer, self.chains = [], {s: Chain(s) for s in starts}

    def add(self, role: str, fault: int) -> None:
        initial = role[:1]
        if len(self.buffer) == PIECE:
            self.link()
        self.illegal += self.size > 0 and self.closing + initial not in LEGAL
        self.opening, self.closing = initial if self.size == 0 else self.opening, initial
        self.size += 1
        self.faults[fault] += 1
        self.buffer.append((initial, fault))

    def link(self) -> None:
        table = table_of(self.buffer, {t for chain in self.chains.values() for t in chain.cost})
        for chain in self.chains.values():
            chain.add(table)
        self.buffer = []

    def row(self, conv, part: int, ends: bool) -> tuple:
        """``ends``: the conversation has all its rows here, unless it began in an earlier partition."""
        head = (conv, part, self.faults[BLANKED], self.faults[DUPLICATE], self.faults[TRUNCATED], self.illegal, self.opening, self.closing)
        if ends and len(self.chains) == 1 and self.size <= PIECE:
            cost, audit = cheapest(self.buffer, START, ENDS, True)
            return *head, cost, audit, []
        self.link()
        if ends and len(self.chains) == 1:
            return *head, *self.chains[START].finish(), []
        return *head, None, None, [{"s": s, "t": t, "cost": cost, "letters": letters} for s, chain in self.chains.items() for t, (cost, letters) in chain.ways().items()]


PART_FIELDS = "part int, blank bigint, duplicate bigint, truncated bigint, illegal bigint, opening string, closing string, cost bigint, audit string"
WAYS = pa.list_(pa.struct([("s", pa.int32()), ("t", pa.int32()), ("cost", pa.int64()), ("letters", pa.string())]))


def _parts(id_type: T.DataType):
    names = ["conv_id", *[f.split()[0] for f in PART_FIELDS.split(", ")], "ways"]
    types = [arrow_type(id_type), pa.int32(), *[pa.int64()] * 4, pa.string(), pa.string(), pa.int64(), pa.string(), WAYS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            number, before = TaskContext.get().partitionId(), None
            for conv, group in _groups(batches, "conv_id"):
                if before is not None:
                    yield before[1].row(before[0], number, True)
                # the first conversation may have begun in the partition before
                part = Part((START,) if before is not None else STATES)
                for _, _, role, _, kind, copies, repeated in group:
                    for copy in range(copies):
                        part.add(role, DUPLICATE if kind != BLANKED and (repeated or copy) else kind)
                before = (conv, part)
            if before is not None:
                yield before[1].row(before[0], number, False)
        yield from _batches(rows(), names, types)
    return run


def _fold(id_type: T.DataType):
    """The parts of every conversation put together, in order."""
    names, types = ["conv_id", "blank", "duplicate", "truncated", "illegal", "cost", "audit"], [arrow_type(id_type), *[pa.int64()] * 5, pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for conv, parts in _groups(batches, "conv_id"):
                sums, chain, last, done = [0, 0, 0, 0], Chain(START), None, None
                for _, _, *faults, opening, closing, cost, audit, ways in parts:
                    sums = [a + b for a, b in zip(sums, faults)]
                    sums[3] += last is not None and last + opening not in LEGAL
                    last = closing
                    if not ways:
                        done = (cost, audit)
                        continue
                    table: Table = {}
                    for way in ways:
                        table.setdefault(way["s"], {})[way["t"]] = (way["cost"], way["letters"])
                    chain.add(table)
                yield conv, *sums, *(done or chain.finish())
        yield from _batches(rows(), names, types)
    return run


def audits(convs: DataFrame) -> DataFrame:
    """(conv_id, blank, duplicate, truncated, illegal, cost, audit) per conversation of ``convs`` (conv_id, turn, role, text).

    Rows are read by turn (NULLs first), then role and digest of the text. ``blank``, ``duplicate`` and ``truncated`` count rows by their first fault,
    ``illegal`` the neighbours whose roles do not fit. ``audit`` holds the letters of the cheapest edits that make the conversation sound: keeping
    costs 0, a new role 1, deleting 2 (required for blank and duplicate rows), inserting 5, a truncated row that stays 5 more; of equally
    cheap edits those that come first in ASCII.

    Rows without their texts are ranged over tasks in order, so a conversation with a large part of all rows lies in many; each searches pieces
    of 64 rows from every state to every other, and the few ways through a task's part are put together by conversation.

    NULL role or text: one space, which is no role and a blank text; an empty role fits nowhere either. A NULL conv_id is one conversation. Repeated
    rows are duplicates. Very long texts count by digest and last character. Empty table: no rows. Other columns do not matter.
    """
    id_type = convs.schema["conv_id"].dataType
    rows = stored(entries(convs.select(col("conv_id"), col("turn"), col("role"), col("text"))), "repair-entries")
    ordered = rows.repartitionByRange(*_order()).sortWithinPartitions(*_order())
    schema = f"conv_id {id_type.simpleString()}, {PART_FIELDS}, ways array<struct<s int, t int, cost bigint, letters string>>"
    pieces = ordered.mapInArrow(_parts(id_type), schema)
    gathered = pieces.repartition("conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "part")
    return gathered.mapInArrow(_fold(id_type), f"conv_id {id_type.simpleString()}, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string")


def _stream(convs: DataFrame, found: DataFrame) -> DataFrame:
    """Every conversation's audit, then its rows in order, in one task; sorted on disk, not held in memory."""
    rows = convs.select(*_cells(convs)).select("conv_id", F.lit(None).cast("string").alias("audit"), "turn", "role", F.unhex(F.md5(F.col("text").cast("binary"))).alias("digest"), "text")
    heads = found.select("conv_id", "audit", F.lit(None).alias("turn"), F.lit(None).alias("role"), F.lit(None).alias("digest"), F.lit(None).alias("text"))
    both = rows.unionByName(heads)
    return both.repartition("conv_id").sortWithinPartitions(*_order(F.col("audit").asc_nulls_last())).select("conv_id", "audit", "role", "text")


def _edited(rows: Iterator[tuple]) -> Iterator[tuple[str, str, str]]:
    """(letter, role, text) of the rows that a conversation has after its edits; ``rows`` begins with the audit."""
    audit = next(rows)[1]
    state, at = START, 0

    def inserted() -> Iterator[tuple[str, str, str]]:
        nonlocal state, at
        while at < len(audit) and audit[at] == "I":
            state, at = NEXT[state], at + 1
            yield "I", ROLE[state], ""

    for _, _, role, text in rows:
        yield from inserted()
        letter, at = audit[at], at + 1
        if letter == "D":
            continue
        state = KEEP[state, role[:1]] if letter == "K" else NEXT[state]
        yield letter, role if letter == "K" else ROLE[state], text
    yield from inserted()


def _rows(id_type: T.DataType):
    names, types = ["conv_id", "place", "edit", "role", "text"], [arrow_type(id_type), pa.int64(), pa.string(), pa.string(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ((conv, place, *row) for conv, group in _groups(batches, "conv_id") for place, row in enumerate(_edited(group)))
        yield from _batches(rows, names, types)
    return run


def repaired(convs: DataFrame) -> DataFrame:
    """(conv_id, place, edit, role, text): the rows of the repaired conversations, with the edit (I, K or R) that each comes from.

    A conversation's rows stream through one task in order, after its audit; memory holds the audit and one batch. See ``audits`` for the rest.
    """
    id_type = convs.schema["conv_id"].dataType
    return _stream(convs, audits(convs)).mapInArrow(_rows(id_type), f"conv_id {id_type.simpleString()}, place bigint, edit string, role string, text string")


def _hashes(id_type: T.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for conv, group in _groups(batches, "conv_id"):
                sha = hashlib.sha256()
                for place, (_, role, text) in enumerate(_edited(group)):
                    sha.update(f"{chr(10) if place else ''}{role}:{text}".encode())
                yield conv, sha.hexdigest()
        yield from _batches(rows(), ["conv_id", "sha"], [arrow_type(id_type), pa.string()])
    return run


def damaged(convs: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) with faults put in by crc32 of ``conv_id:turn`` modulo 20 (NULLs are one space).

    0 drops a row, 1 empties its text, 2 removes ``.!?`` from it, 3 repeats it, 4 makes it the user's.
    """
    name = [F.coalesce(col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    fault = (F.crc32(F.concat_ws(":", *name).cast("binary")) % 20).cast("int")
    rows = convs.select(*_cells(convs), fault.alias("fault")).filter("fault <> 0")
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("fault") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copy")).drop("copy")


def digest(convs: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """One row per conversation: ``audits``, the number of missing turns (``gaps``) and the SHA-256 of the repaired ``role:text`` lines.

    ``ids`` (conv_id) names conversations that get a row even without any rows: zeros, an empty audit and the hash of nothing. ``gaps`` is the span of
    the turns less the distinct turns; 0 where all are NULL, NULL beyond the range of a long. The hash of a conversation is one stream by nature: its texts
    pass through one task, sorted on disk.
    """
    rows = convs.select(col("conv_id"), col("turn"), col("role"), col("text"))
    id_type = rows.schema["conv_id"].dataType
    found = stored(audits(rows), "repair-audits")
    hashes = _stream(rows, found).mapInArrow(_hashes(id_type), f"conv_id {id_type.simpleString()}, sha string")
    wide = [F.col(c).cast("decimal(38,0)") for c in ("high", "low", "n")]
    span = (wide[0] - wide[1] + F.lit(1) - wide[2]).try_cast("bigint")
    turns = rows.groupBy("conv_id").agg(F.max("turn").alias("high"), F.min("turn").alias("low"), F.count_distinct("turn").alias("n"))
    turns = turns.select("conv_id", F.when(F.col("n") == 0, 0).otherwise(span).cast("bigint").alias("gaps"))
    every = (ids if ids is not None else rows).select("conv_id").distinct()
    for part in (turns, found, hashes):
        named = part.withColumnRenamed("conv_id", "other")
        every = every.join(named, F.col("conv_id").eqNullSafe(F.col("other")), "left").drop("other")
    zero = [F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")]
    gaps = F.when(F.col("cost").isNull(), F.lit(0).cast("bigint")).otherwise(F.col("gaps")).alias("gaps")
    return every.select("conv_id", gaps, *zero, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha", F.sha2(F.lit(b""), 256)).alias("repaired_sha256"))
