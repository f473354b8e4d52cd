"""The marts: a list of specifications and one builder."""

from __future__ import annotations

from collections import ChainMap
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from martloom import settings as S
from martloom.functions import to_id
from martloom.operators.columns import prefix_columns
from martloom.operators.filters import by_category, by_flag, int_ids
from martloom.operators.joins import chain, enrich_left, rows_by_flags, rows_by_roles
from martloom.operators.loading import write_mart
from martloom.operators.ordering import sort_mart
from martloom.sources.tables import MAIN, has_column, load_table
from martloom.sources.versions import read_part, read_version

#: The stored tables the marts read.
TABLES = list(S.TABLE_KEYS)
ENTITIES = ["contact", "deal", "lead", "company"]


@dataclass(frozen=True)
class Mart:
    """One mart: an entity's joined tables, restricted by at most one of role, flag, category."""

    name: str
    table: str
    entity: str
    how: str = "left"
    role_table: str | None = None
    role: str | None = None
    flag: str | None = None
    category: int | None = None
    order: tuple[str, ...] = ("ID",)


# Names under which the marts are known to their readers.
MARTS = [
    Mart("contacts", "Contacts", "contact"),
    Mart("employer_contact", "Contact_Entreprise", "contact",
         role_table="entity_deal", role=S.DEAL_ROLES["employer_contact"]),
    Mart("emergency_contact", "Contact_en_cas_durgence", "contact", flag=S.CONTACT_FLAGS["emergency_contact"]),
    Mart("tutor", "Tuteur", "contact", role_table="entity_deal", role=S.DEAL_ROLES["tutor"]),
    Mart("tutor_2", "Tuteur2", "contact", role_table="entity_deal", role=S.DEAL_ROLES["tutor_2"]),
    Mart("legal_guardian_1", "Responsable_légal_1", "contact", flag=S.CONTACT_FLAGS["legal_guardian_1"]),
    Mart("legal_guardian_2", "Responsable_légal_2", "contact", flag=S.CONTACT_FLAGS["legal_guardian_2"]),
    Mart("payer_1", "Répondant_Financier_1", "contact", flag=S.CONTACT_FLAGS["payer_1"]),
    Mart("payer_2", "Répondant_Financier_2", "contact", flag=S.CONTACT_FLAGS["payer_2"]),
    Mart("accountant", "Responsable_Comptable", "contact",
         role_table="entity_deal", role=S.DEAL_ROLES["accountant"], order=("CONTACT_ID",)),
    Mart("director", "Dirigeant", "contact",
         role_table="entity_company", role=S.COMPANY_ROLES["director"], order=("CONTACT_ID",)),
    Mart("funder_contact", "Interlocuteur_OPCO", "contact",
         role_table="entity_company", role=S.COMPANY_ROLES["funder_contact"], order=("CONTACT_ID",)),
    Mart("recruiter", "Décideur_de_recrutement", "contact",
         role_table="entity_company", role=S.COMPANY_ROLES["recruiter"], order=("CONTACT_ID",)),
    Mart("deals", "Transactions", "deal"),
    Mart("deals_apprentice", "Transactions_Alternant", "deal", category=S.DEAL_CATEGORIES["deals_apprentice"]),
    Mart("deals_initial", "Transactions_Initial", "deal", category=S.DEAL_CATEGORIES["deals_initial"]),
    Mart("deals_employer", "Transactions_Entreprise", "deal", category=S.DEAL_CATEGORIES["deals_employer"]),
    Mart("deals_continuing", "Transactions_FPC", "deal", category=S.DEAL_CATEGORIES["deals_continuing"]),
    Mart("deals_funding", "Transactions_Prise_en_charge_OPCO", "deal", category=S.DEAL_CATEGORIES["deals_funding"]),
    Mart("leads", "Prospects", "lead", how="inner", order=()),
    Mart("companies", "Entreprise", "company", how="inner", order=()),
]
#: The enriched copy of the lead mart is built by :func:`enriched_leads`.
ENRICHED_LEADS = ("leads_enriched", "Prospects_TC")

BY_NAME = {m.name: m for m in MARTS}


def read_tables(spark: SparkSession, root: str, database: str = MAIN,
                suffix: str = "", numbers: Mapping[str, int] | None = None) -> dict[str, DataFrame]:
    """The stored tables the marts need, by name, or ``numbers`` of their versions; relation tables get their mart column names."""
    tables = {t: load_table(spark, root, f"{t}{suffix}", database, numbers and numbers[t]) for t in TABLES}
    for entity in ENTITIES:
        name = f"entity_{entity}"
        if has_column(tables[name], "ID"):
            tables[name] = prefix_columns(tables[name], entity)
    return tables


def entity_chain(tables: Mapping[str, DataFrame], entity: str, how: str = "left",
                 spread: bool = False) -> DataFrame:
    """Base, custom-field and relation table of an entity, joined on its id."""
    extras = [(tables[t], S.TABLE_KEYS[t]) for t in (f"crm_{entity}_uf", f"entity_{entity}")]
    return chain(tables[f"crm_{entity}"], extras, "ID", how, S.KEPT_SHARED[entity], spread)


def build_mart(tables: Mapping[str, DataFrame], mart: Mart | str, multi: str = "first",
               dedupe: bool = False, ordered: bool = True, spread: bool = False) -> DataFrame:
    """One mart as a DataFrame.

    ``dedupe`` gives each contact once per role; by default it comes once for every deal or
    company that names it. ``multi`` says how relation cells with several ids are read.
    """
    mart = BY_NAME[mart] if isinstance(mart, str) else mart
    out = entity_chain(tables, mart.entity, mart.how, spread)
    ties = [c for c in ("ID",) if c not in mart.order]
    if mart.flag:
        out = by_flag(out, mart.flag)
    if mart.category is not None:
        out = by_category(out, mart.category)
    if mart.role:
        order = [F.col(k).asc_nulls_first() for k in (*mart.order, *ties)] if ordered else []
        return rows_by_roles(out, tables[mart.role_table], {mart.name: mart.role}, "ID", multi, dedupe, order=order).drop("role", "_slice")
    return sort_mart(out, mart.order, ties) if ordered and mart.order else out


def contacts_by_flags(chained: DataFrame) -> DataFrame:
    """The five flag marts in one pass, with a ``mart`` column."""
    return rows_by_flags(chained, S.CONTACT_FLAGS, "mart")


def contacts_by_roles(chained: DataFrame, relation: DataFrame, roles: Mapping[str, str],
                      multi: str = "first", dedupe: bool = False, order: Sequence[Column] = ()) -> DataFrame:
    """The role marts of one relation table in one join, with a ``mart`` column; ``order`` sorts them before the copies are made."""
    return rows_by_roles(chained, relation, roles, "ID", multi, dedupe, order=order).withColumnRenamed("role", "mart")


def deals_by_categories(chained: DataFrame) -> DataFrame:
    """The five category marts in one pass, with a ``mart`` column."""
    code = to_id(F.trim(F.col("CATEGORY_ID").cast("string")))
    rows = chained.where(code.isin(*S.DEAL_CATEGORIES.values()))
    pick = F.lit(None).cast("string")
    for name, value in S.DEAL_CATEGORIES.items():
        pick = F.when(code == value, F.lit(name)).otherwise(pick)
    return rows.withColumn("mart", pick)


def clean_ids(tables: Mapping[str, DataFrame]) -> Mapping[str, DataFrame]:
    """The tables with integer ids: rows with other lead or contact ids go, other references become NULL."""
    typed = {
        "crm_lead": int_ids(tables["crm_lead"], "ID", ("CONTACT_ID",)),
        "crm_contact": int_ids(tables["crm_contact"], "ID"),
        "crm_deal": tables["crm_deal"].withColumn("LEAD_ID", to_id(F.col("LEAD_ID"))),
    }
    return ChainMap(typed, tables)


def enriched_leads(tables: Mapping[str, DataFrame], leads: DataFrame | None = None) -> DataFrame:
    """Leads with columns of their contact and of their first deal.

    ``leads`` is the lead mart; by default it is built here. Only the columns that are needed are
    read of contacts and deals, and only deals that name a lead take part. One contact may have
    any share of the leads.
    """
    tables = clean_ids(tables)
    leads = entity_chain(tables, "lead", "inner") if leads is None else int_ids(leads, "ID", ("CONTACT_ID",))

    base = [c for c in S.LEAD_FROM_DEAL if c in tables["crm_deal"].columns]
    extra = [c for c in S.LEAD_FROM_DEAL if c not in base]
    deals = tables["crm_deal"].select("ID", "LEAD_ID", *base)
    if extra:
        fields = tables["crm_deal_uf"].select("DEAL_ID", *extra)
        deals = chain(deals, [(fields, "DEAL_ID")]).drop("DEAL_ID")
    # deals first: their join is on the id by which the leads are partitioned already
    out = enrich_left(leads, deals, ("ID", "LEAD_ID"), S.LEAD_FROM_DEAL)
    contacts = tables["crm_contact"].select("ID", *S.LEAD_FROM_CONTACT)
    out = enrich_left(out, contacts, ("CONTACT_ID", "ID"), S.LEAD_FROM_CONTACT, spread=True)
    own = [c for c in leads.columns if c not in (*S.LEAD_FROM_CONTACT.values(), *S.LEAD_FROM_DEAL.values())]
    return out.select(*own, *S.LEAD_FROM_CONTACT.values(), *S.LEAD_FROM_DEAL.values())


#: Marts that are written together, by the folder they share.
FAMILIES = {"contacts_by_flag": S.CONTACT_FLAGS, "contacts_by_deal_role": S.DEAL_ROLES, "contacts_by_company_role": S.COMPANY_ROLES,
            "deals_by_category": S.DEAL_CATEGORIES}
BY_TABLE = {m.table: m.name for m in MARTS} | {ENRICHED_LEADS[1]: ENRICHED_LEADS[0]}


def read_mart(spark: SparkSession, root: str, name: str, number: int | None = None) -> DataFrame:
    """A written mart by its name here or the one its readers know, as of a version of its folder; only its own files are read."""
    name = BY_TABLE.get(name, name)
    family = next((f for f, names in FAMILIES.items() if name in names), None)
    root = root.rstrip("/")
    return read_part(spark, f"{root}/{family}", number, mart=name) if family else read_version(spark, f"{root}/{name}", number)


def write_all(spark: SparkSession, tables: Mapping[str, DataFrame], root: str, clean: bool = True,
              multi: str = "first", dedupe: bool = False, ranged: bool = False, failed: dict[str, str] | None = None) -> list[str]:
    """Write all 22 marts below ``root`` and return the names of those written.

    The contact and the deal chain are joined once and written as their marts; the flag, role and
    category marts and the enriched leads are derived from the written tables, one job per family, which also cuts the
    lineage. ``clean`` types the ids first; without it they are only typed for the enriched
    leads. ``ranged`` sorts the two large marts over all their files, for another shuffle of all their rows. Each folder gets a new version when its
    rows are complete; until then its readers have the old one.

    A family that fails does not stop the others, unless they are derived from it. With ``failed`` its names and first line of error
    are put there; without it the first error is raised when all families have had their turn.
    """
    root = root.rstrip("/")
    used = clean_ids(tables) if clean else tables
    stored = lambda name: read_version(spark, f"{root}/{name}")

    def enriched() -> DataFrame:
        # the written marts have all columns that the leads take, so contacts and deals are not joined again
        finished = ChainMap({"crm_contact": stored("contacts"), "crm_deal": stored("deals")}, tables)
        return enriched_leads(finished, stored("leads"))

    families = [
        (["contacts"], lambda: write_mart(entity_chain(used, "contact"), f"{root}/contacts", ["ID"], ranged=ranged)),
        (list(S.CONTACT_FLAGS), lambda: write_mart(contacts_by_flags(stored("contacts")), f"{root}/contacts_by_flag", ["ID"], by="mart")),
        (list(S.DEAL_ROLES), lambda: write_mart(contacts_by_roles(stored("contacts"), used["entity_deal"], S.DEAL_ROLES, multi, dedupe),
                                                f"{root}/contacts_by_deal_role", ["ID"], by="mart", ties=["_slice"])),
        (list(S.COMPANY_ROLES), lambda: write_mart(contacts_by_roles(stored("contacts"), used["entity_company"], S.COMPANY_ROLES, multi, dedupe),
                                                   f"{root}/contacts_by_company_role", ["CONTACT_ID", "ID"], by="mart", ties=["_slice"])),
        (["deals"], lambda: write_mart(entity_chain(used, "deal"), f"{root}/deals", ["ID"], ranged=ranged)),
        (list(S.DEAL_CATEGORIES), lambda: write_mart(deals_by_categories(stored("deals")), f"{root}/deals_by_category", ["ID"], by="mart")),
        (["leads"], lambda: write_mart(entity_chain(used, "lead", "inner"), f"{root}/leads")),
        ([ENRICHED_LEADS[0]], lambda: write_mart(enriched(), f"{root}/leads_enriched")),
        (["companies"], lambda: write_mart(entity_chain(used, "company", "inner"), f"{root}/companies")),
    ]
    errors: dict[str, Exception] = {}
    for names, write in families:
        try:
            write()
        except Exception as e:  # noqa: BLE001 - one mart must not stop the others
            errors |= dict.fromkeys(names, e)
    if errors and failed is None:
        raise next(iter(errors.values()))
    if failed is not None:
        failed |= {name: (str(e).splitlines() or [type(e).__name__])[0] for name, e in errors.items()}
    return [name for name in (*BY_NAME, ENRICHED_LEADS[0]) if name not in errors]
