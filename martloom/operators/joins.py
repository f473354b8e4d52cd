"""Joins: the base/custom-field/relation chain, role joins, lookups and new rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F
from pyspark.sql.types import MapType, StringType

from martloom import functions as fn
from martloom.operators.columns import drop_shared
from martloom.session import shuffle_width

#: Copies of one row that a single task writes before the work is handed to others.
COPIES_PER_SLICE = 100_000
#: Places over which rows without a key are spread; they match nothing, wherever they are.
KEYLESS_WAYS = 1024


def _same_type(left: DataFrame, lcol: str, right: DataFrame, rcol: str) -> tuple[Column, Column]:
    """Both keys as columns of one type; where one side is numeric, text that is no whole number matches nothing."""
    l_text = isinstance(left.schema[lcol].dataType, StringType)
    r_text = isinstance(right.schema[rcol].dataType, StringType)
    l, r = F.col(f"l.`{lcol}`"), F.col(f"r.`{rcol}`")
    if l_text and not r_text:
        l = fn.to_id(l)
    if r_text and not l_text:
        r = fn.to_id(r)
    return l, r


def equi_join(left: DataFrame, right: DataFrame, lcol: str, rcol: str, how: str) -> DataFrame:
    """Join on one key, keeping all columns of both sides (the left ones for semi and anti)."""
    l, r = _same_type(left, lcol, right, rcol)
    joined = left.alias("l").join(right.alias("r"), l == r, how)
    return joined.select("l.*") if how in ("left_semi", "left_anti") else joined.select("l.*", "r.*")


def spread_join(left: DataFrame, right: DataFrame, lcol: str, rcol: str, how: str = "left") -> DataFrame:
    """:func:`equi_join` where many left rows may have no key.

    Rows without a key would meet in one task. A second join column, a hash of the row where the key is NULL and 0 elsewhere,
    spreads them; frequent keys are left to the adaptive skew join. The plan is the same whatever the data, and nothing is counted first.
    """
    l, r = _same_type(left, lcol, right, rcol)
    hashed = [F.col(f"l.`{f.name}`") for f in left.schema.fields if not isinstance(f.dataType, MapType)]
    place = F.when(l.isNull(), F.pmod(F.xxhash64(*hashed), F.lit(KEYLESS_WAYS))).otherwise(F.lit(0)).cast("int")
    lhs = left.alias("l").select("l.*", l.alias("_key"), place.alias("_place"))
    rhs = right.alias("r").select("r.*", r.alias("_key"), F.lit(0).alias("_place")).where("_key is not null")
    joined = lhs.alias("l").join(rhs.alias("r"), F.expr("l._key = r._key and l._place = r._place"), how)
    out = [f"l.`{c}`" for c in left.columns]
    if how not in ("left_semi", "left_anti"):
        out += [f"r.`{c}`" for c in right.columns]
    return joined.select(*out)


def chain(base: DataFrame, extras: Sequence[tuple[DataFrame, str]], key: str = "ID",
          how: str = "left", keep: Sequence[str] = ("ID",), spread: bool = False) -> DataFrame:
    """Base table joined to its secondary tables, ``(table, key column)`` each, on the base key.

    Columns that an earlier table already has are dropped from the later ones. All joins hash on
    the same key, so each table is shuffled once however many there are; inputs bucketed by it
    are not shuffled at all. The key is the primary key of every table; a load counts in its audit row what breaks it. Set ``spread`` for
    sources where it does.
    """
    out = base
    for table, table_key in extras:
        rest = drop_shared(out, table, keep=(*keep, table_key))
        join = spread_join if spread else equi_join
        out = join(out, rest, key, table_key, how)
    return out


def one_per_key(df: DataFrame, key: str, order_by: Sequence[str]) -> DataFrame:
    """The first row of every key in the given order; rows without a key go.

    Each task keeps one row per key before the shuffle, so a frequent key costs no more than
    one row per task.
    """
    order = W.partitionBy(key).orderBy(*[F.col(c).asc_nulls_last() for c in order_by])
    rows = df.where(F.col(key).isNotNull())
    return rows.withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n")


def enrich_left(df: DataFrame, other: DataFrame, on: tuple[str, str], columns: Mapping[str, str],
                order_by: Sequence[str] = ("ID",), spread: bool = False) -> DataFrame:
    """Set the new columns from the matching row of ``other``, NULL where nothing matches.

    ``columns`` maps source columns to their new names. Where several rows match, the first in
    ``order_by`` is used, so the result does not depend on the run. Rows never multiply.
    ``spread`` keeps rows of ``df`` without a key apart; use it where the key is no primary key.
    """
    left_key, right_key = on
    ties = [c for c in columns if c not in order_by]
    narrow = other.select(*dict.fromkeys([right_key, *order_by, *columns]))
    best = one_per_key(narrow, right_key, (*order_by, *ties))
    best = best.select(F.col(right_key).alias("_match"), *[F.col(c).alias(n) for c, n in columns.items()])
    rows = df.drop(*columns.values())
    join = spread_join if spread else equi_join
    return join(rows, best, left_key, "_match", "left").drop("_match")


def role_cells(relation: DataFrame, roles: Mapping[str, str], multi: str = "first") -> DataFrame:
    """(role, id): every id that a relation names, with the number of its role."""
    if multi not in ("first", "explode"):
        raise ValueError("multi is 'first' or 'explode'")
    read = fn.id_list if multi == "explode" else fn.first_id
    cells = relation.select(F.posexplode(F.array(*[read(F.col(c)) for c in roles.values()])).alias("role", "id"))
    if multi == "explode":
        cells = cells.select("role", F.explode("id").alias("id"))
    return cells.where("id is not null")


def role_counts(relation: DataFrame, roles: Mapping[str, str], multi: str = "first") -> DataFrame:
    """How often each record is named in each role: one row per id, an ``array<struct<role,n>>``.

    ``multi="first"`` reads the leading id of a cell, ``"explode"`` every id of it. Counts are
    taken per task before the shuffle, so one record may be named in any share of the rows.
    """
    counts = role_cells(relation, roles, multi).groupBy(F.col("id").alias("_role_id")).agg(
        *[F.count_if(F.col("role") == i).alias(f"_n{i}") for i in range(len(roles))]
    )
    named_n = [F.struct(F.lit(label).alias("role"), F.col(f"_n{i}").alias("n")) for i, label in enumerate(roles)]
    return counts.select("_role_id", F.filter(F.array(*named_n), lambda s: s["n"] > 0).alias("_roles"))


def repeat_rows(df: DataFrame, count_col: str) -> DataFrame:
    """Every row as often as ``count_col`` says; the copies stay in their task, side by side."""
    return df.withColumn("_c", F.explode(F.array_repeat(F.lit(True), F.col(count_col).cast("int")))).drop("_c", count_col)


def rows_by_roles(rows: DataFrame, relation: DataFrame, roles: Mapping[str, str], key: str = "ID",
                  multi: str = "first", dedupe: bool = False,
                  copies_per_slice: int = COPIES_PER_SLICE, order: Sequence[Column] = ()) -> DataFrame:
    """Records of ``rows`` named in a role, with a ``role`` column, once per naming row.

    Equals an inner join of the records with the relation table on each role column, for all
    roles together. The relation is reduced to counts before it is joined, and the copies are
    made in the task of that join, so they are never shuffled. Records with more than ``copies_per_slice`` copies in a role are few (each takes
    that many rows of the relation): their counts are broadcast, they are cut into slices, and the slices are shuffled apart, so many tasks write the
    copies. ``dedupe`` gives every record once per role.

    ``order`` sorts the result; it is the uncopied rows that are ranged and sorted. ``_slice`` numbers the slices of a record.
    """
    own, size = [f"`{c}`" for c in rows.columns], F.lit(copies_per_slice).cast("bigint")
    counts = role_counts(relation, roles, multi)
    most = F.array_max(F.transform("_roles", lambda r: r["n"]))

    def named(right: DataFrame) -> DataFrame:
        each = equi_join(rows, right, key, "_role_id", "inner").select(*own, F.explode("_roles").alias("_r"))
        return each.select(*own, F.col("_r.role").alias("role"), F.col("_r.n").alias("_copies"))

    if dedupe:
        out = named(counts).drop("_copies").withColumn("_slice", F.lit(0).cast("bigint"))
        return out.orderBy(*order) if order else out
    light = named(counts.where(most <= size)).withColumn("_slice", F.lit(0).cast("bigint"))
    heavy = named(F.broadcast(counts.where(most > size)))
    heavy = heavy.withColumn("_slice", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("_copies") - 1) / size))))
    heavy = heavy.withColumn("_copies", F.least(size, F.col("_copies") - F.col("_slice") * size))
    if order:
        return repeat_rows(light.unionByName(heavy).orderBy(*order, "_slice"), "_copies")
    heavy = heavy.repartition(shuffle_width(rows.sparkSession), key, "_slice")
    return repeat_rows(light.unionByName(heavy), "_copies")


def role_by_relation(rows: DataFrame, relation: DataFrame, role_col: str, key: str = "ID",
                     multi: str = "first", dedupe: bool = False) -> DataFrame:
    """Records named in one role column, with their own columns only."""
    out = rows_by_roles(rows, relation, {role_col: role_col}, key, multi, dedupe)
    return out.drop("role", "_slice")


def rows_by_flags(rows: DataFrame, flags: Mapping[str, str], label: str = "flag") -> DataFrame:
    """Records with a flag column set, once per flag that is set, with a column naming it.

    One pass for all flags; records without any are filtered before they are repeated, which
    turns a left join below into an inner one.
    """
    names = F.array(*[F.when(F.col(c).isNotNull(), F.lit(name)) for name, c in flags.items()])
    some = rows.where(F.coalesce(*[F.col(c).cast("string") for c in flags.values()]).isNotNull())
    return some.select("*", F.explode(F.filter(names, lambda x: x.isNotNull())).alias(label))


def new_rows(source: DataFrame, target: DataFrame, id_col: str) -> DataFrame:
    """Source rows whose id the target does not have."""
    return source.join(target.select(id_col), id_col, "left_anti")
