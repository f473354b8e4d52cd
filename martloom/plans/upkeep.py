"""Marts kept up to date by what has changed: only the blocks of ids that a change touches are written anew.

A mart's files are divided by blocks of neighbouring ids, and its manifest tells which versions of the stored tables it was made of. Rows that
only the old or only the new version of a table has lead to the touched blocks; for roles, the counts of both are subtracted.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegralType

from martloom import functions as fn
from martloom import settings as S
from martloom.operators.joins import role_cells
from martloom.plans import marts as M
from martloom.sources.tables import MAIN, table_path
from martloom.sources.versions import divided_by, publish, version, write_version

#: Ids of a block, as a power of two.
BLOCK_BITS = 16
#: Blocks of an entity from which on they are widened: every block is a file in each part of a mart, so their number must not grow with the ids.
MAX_BLOCKS = 128
Tables = Mapping[str, DataFrame]


def block_of(key: Column, bits: int) -> Column:
    """Number of the block of an id; NULL for ids that are no integers, which share a block."""
    return F.shiftright(fn.to_id(key), bits)


def block_width(ids: Column, rows: DataFrame, bits: int) -> int:
    """The least width from ``bits`` on at which the ids fall into at most about MAX_BLOCKS blocks. Blocks without an id do not count, so one far-off id widens none."""
    widths = range(bits, 64)
    blocks = rows.select(block_of(ids, bits).alias("b")).distinct()
    counts = blocks.agg(*[F.approx_count_distinct(F.shiftright("b", w - bits)).alias(str(w)) for w in widths]).first()
    return next((w for w in widths if counts[str(w)] <= MAX_BLOCKS), widths[-1])


def changed_rows(old: DataFrame, new: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The given cells of all rows that only one of two versions has, or that it has more often; the versions have the same columns.

    Rows are told by 128 bits of their cells, so the shuffle carries no row.
    """
    def signed(df: DataFrame, sign: int) -> DataFrame:
        cells = [F.col(f"`{c}`") for c in old.columns]
        cells += [c.isNull() for c in cells]  # a hash passes over NULLs
        return df.select(*[f"`{c}`" for c in columns], F.xxhash64(*cells).alias("_h1"), F.xxhash64(F.lit("second"), *cells).alias("_h2"), F.lit(sign).alias("_sign"))

    sums = signed(old, -1).unionByName(signed(new, 1)).groupBy(*columns, "_h1", "_h2").agg(F.sum("_sign").alias("_n"))
    return sums.where("_n <> 0").select(*[f"`{c}`" for c in columns])


def changed_roles(old: DataFrame, new: DataFrame, roles: Mapping[str, str], multi: str) -> DataFrame:
    """(id) of the records that two versions of a relation name in a role with different frequency."""
    signed = [role_cells(df, roles, multi).select("id", "role", F.lit(sign).alias("_sign")) for df, sign in ((old, -1), (new, 1))]
    return signed[0].unionByName(signed[1]).groupBy("id", "role").agg(F.sum("_sign").alias("_n")).where("_n <> 0").select("id")


def within(df: DataFrame, key: str, blocks: Sequence[int | None] | None, bits: int) -> DataFrame:
    """The rows whose key lies in one of the blocks; for integer keys the outermost blocks bound the scan."""
    if blocks is None:
        return df
    known = [b for b in blocks if b is not None]
    if isinstance(df.schema[key].dataType, IntegralType) and len(known) == len(blocks) and known:
        df = df.where(F.col(f"`{key}`").between(F.lit(min(known) << bits), F.lit(((max(known) + 1) << bits) - 1)))
    some = df.sparkSession.createDataFrame([(b,) for b in blocks], "_block bigint")
    return df.join(some, block_of(F.col(f"`{key}`"), bits).eqNullSafe(F.col("_block")), "left_semi")


@dataclass(frozen=True)
class Family:
    """Marts that share a folder: the tables they read, their rows, and the ids that a change touches besides those of the chain's own tables."""

    name: str
    entity: str
    more: tuple[str, ...]
    rows: Callable[[Tables, "Build"], DataFrame]
    touched: Callable[[Tables, Tables, "Build"], list[DataFrame]] = lambda old, new, build: []
    by: tuple[str, ...] = ()

    @property
    def chain(self) -> tuple[str, ...]:
        return (f"crm_{self.entity}", f"crm_{self.entity}_uf", f"entity_{self.entity}")

    @property
    def reads(self) -> tuple[str, ...]:
        return (*self.chain, *self.more)


@dataclass(frozen=True)
class Build:
    """How the marts are made."""

    bits: int
    multi: str
    dedupe: bool

    def order(self) -> list[Column]:
        return [block_of(F.col("ID"), self.bits).asc_nulls_first(), F.col("ID").asc_nulls_first()]


def _roles(relation: str, roles: Mapping[str, str]) -> tuple[Callable, Callable]:
    def rows(tables: Tables, build: Build) -> DataFrame:
        chained = M.entity_chain(tables, "contact")
        return M.contacts_by_roles(chained, tables[relation], roles, build.multi, build.dedupe, build.order()).drop("_slice")

    def touched(old: Tables, new: Tables, build: Build) -> list[DataFrame]:
        return [changed_roles(old[relation], new[relation], roles, build.multi)]

    return rows, touched


def _enriched_touched(old: Tables, new: Tables, build: Build) -> list[DataFrame]:
    """Leads of changed deals, old and new, of deals with changed fields, and of changed contacts."""
    of_deals = changed_rows(old["crm_deal"], new["crm_deal"], ["LEAD_ID"]).select(F.col("LEAD_ID").alias("id"))
    fields = changed_rows(old["crm_deal_uf"], new["crm_deal_uf"], ["DEAL_ID"]).select(fn.to_id(F.col("DEAL_ID")).alias("_deal"))
    of_fields = new["crm_deal"].join(fields, fn.to_id(F.col("ID")) == F.col("_deal"), "left_semi").select(F.col("LEAD_ID").alias("id"))
    contacts = changed_rows(old["crm_contact"], new["crm_contact"], ["ID"]).select(fn.to_id(F.col("ID")).alias("_contact"))
    of_contacts = new["crm_lead"].join(contacts, fn.to_id(F.col("CONTACT_ID")) == F.col("_contact"), "left_semi").select(F.col("ID").alias("id"))
    return [of_deals, of_fields, of_contacts]


_DEAL_ROLES, _COMPANY_ROLES = _roles("entity_deal", S.DEAL_ROLES), _roles("entity_company", S.COMPANY_ROLES)
FAMILIES = [
    Family("contacts", "contact", (), lambda t, b: M.entity_chain(t, "contact")),
    Family("contacts_by_flag", "contact", (), lambda t, b: M.contacts_by_flags(M.entity_chain(t, "contact")), by=("mart",)),
    Family("contacts_by_deal_role", "contact", ("entity_deal",), *_DEAL_ROLES, by=("mart",)),
    Family("contacts_by_company_role", "contact", ("entity_company",), *_COMPANY_ROLES, by=("mart",)),
    Family("deals", "deal", (), lambda t, b: M.entity_chain(t, "deal")),
    Family("deals_by_category", "deal", (), lambda t, b: M.deals_by_categories(M.entity_chain(t, "deal")), by=("mart",)),
    Family("leads", "lead", (), lambda t, b: M.entity_chain(t, "lead", "inner")),
    Family("leads_enriched", "lead", ("crm_contact", "crm_deal", "crm_deal_uf"), lambda t, b: M.enriched_leads(t), _enriched_touched),
    Family("companies", "company", (), lambda t, b: M.entity_chain(t, "company", "inner")),
]


def blocks_of(ids: Sequence[DataFrame], bits: int) -> set[int | None]:
    """The blocks of ids; their number, at most that of all ids by the size of a block, comes to the driver."""
    blocks = [i.toDF("id").select(block_of(F.col("id"), bits).alias("b")) for i in ids]
    return {r.b for r in reduce(DataFrame.union, blocks).distinct().collect()} if blocks else set()


def keep_up(spark: SparkSession, root: str, out: str, database: str = MAIN, suffix: str = "", bits: int = BLOCK_BITS, multi: str = "first",
            dedupe: bool = False) -> dict[str, int]:
    """Bring all 22 marts below ``out`` up to the stored tables below ``root``; the number of blocks written by family of marts.

    A family that was made of the present versions is left alone. Otherwise the versions it was made of are compared with the present ones, and
    the touched blocks are computed from the tables' rows in these blocks and take the place of the old files in a new version; all other
    files stay. Where there is no mart yet, a table's columns have changed or an old version has expired, everything is written. The marts equal
    those of :func:`martloom.plans.marts.write_all` and are read in the same way. Ids are typed first.

    Blocks have 2 ** ``bits`` ids, or more where an entity would have over MAX_BLOCKS of them; when its ids outgrow that, its marts are written with wider ones.
    """
    out = out.rstrip("/")
    now = {t: version(spark, table_path(root, f"{t}{suffix}", database)) for t in M.TABLES}
    if plain := [t for t, v in now.items() if v is None or v.number == 0]:
        raise ValueError(f"not stored in versions: {', '.join(plain)}")
    new = M.clean_ids(M.read_tables(spark, root, database, suffix))
    asked = f"keep up, {bits} bits, {multi}, {dedupe}"
    hows = {w: asked if w == bits else f"{asked}, widened to {w}" for w in range(bits, 64)}
    written, known, needed = {}, {}, {}
    for family in FAMILIES:
        path, sources = f"{out}/{family.name}", {t: now[t].number for t in family.reads}
        have = version(spark, path)
        held = next((w for w, how in hows.items() if have and have.operation == how), None)
        if held is not None and dict(have.sources) == sources:
            continue
        if family.entity not in needed:
            main = family.chain[0]
            needed[family.entity] = block_width(F.col(f"`{S.TABLE_KEYS[main]}`"), new[main], bits)
        width = max(needed[family.entity], held or bits)
        build, how = Build(width, multi, dedupe), hows[width]
        blocks = None
        if held == width:
            before = {t: version(spark, table_path(root, f"{t}{suffix}", database), n) for t, n in have.sources.items()}
            if all(v and v.schema == now[t].schema for t, v in before.items()):
                old = M.clean_ids(M.read_tables(spark, root, database, suffix, {**{t: v.number for t, v in now.items()}, **have.sources}))
                chain = (family.entity, width, *(have.sources[t] for t in family.chain))
                if chain not in known:  # families of one entity share it
                    known[chain] = blocks_of([changed_rows(old[t], new[t], [S.TABLE_KEYS[t]]) for t in family.chain], width)
                blocks = list(known[chain] | blocks_of(family.touched(old, new, build), width))
        if blocks == []:
            publish(spark, path, replace(have, number=have.number + 1, sources=sources))
            written[family.name] = 0
            continue
        some = {t: within(new[t], S.TABLE_KEYS[t], blocks, width) for t in family.chain}
        rows = family.rows(M.clean_ids({**new, **some}), build).withColumn("_block", block_of(F.col("ID"), width))
        if not family.name.endswith("_role"):  # those come in the order of their blocks
            rows = rows.repartition("_block").sortWithinPartitions(*family.by, "_block", "ID")
        gone = None
        if blocks is not None:
            named = {None if b is None else str(b) for b in blocks}
            gone = {e.part for e in have.files if divided_by(e.part)["_block"] in named}
        write_version(rows, path, how, by=[*family.by, "_block"], instead_of=gone, sources=sources)
        written[family.name] = -1 if blocks is None else len(blocks)
    return written
