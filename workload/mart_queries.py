"""The marts."""

from __future__ import annotations

from pyspark.sql import functions as F

from martloom import settings as S
from martloom.operators.columns import drop_shared
from martloom.operators.filters import int_ids
from martloom.operators.joins import role_by_relation
from martloom.operators.ordering import sort_mart
from martloom.operators.loading import replace_table
from martloom.plans import marts as M
from martloom.plans.upkeep import keep_up
from martloom.session import work_dir
from martloom.sources import load_table, table_path
from workload.oracle_views import CRM_TABLES
from workload.registry import query
from workload.views import VIEWS, crm_tables

_CHAIN = {"contact": "contact_chain", "deal": "deal_chain", "lead": "lead_chain", "company": "company_chain"}
_WHOLE = {"contacts": "contacts_mart", "deals": "deals_mart", "leads": "leads_mart", "companies": "companies_mart"}


def _mart_sql(mart: M.Mart) -> tuple[str, list[str]]:
    chain = _CHAIN[mart.entity]
    sql, views = f"SELECT c.* FROM {chain} c", [chain]
    if mart.role:
        # the leading integer of the relation cell; empty text names nobody
        sql += (f" JOIN {mart.role_table} r ON c.\"ID\" ="
                f" try_cast(regexp_extract(r.\"{mart.role}\", '^\\s*(-?\\d+)', 1) AS BIGINT)")
        views.append(mart.role_table)
    if mart.flag:
        sql += f' WHERE c."{mart.flag}" IS NOT NULL'
    if mart.category is not None:
        sql += f' WHERE try_cast(c."CATEGORY_ID" AS INTEGER) = {mart.category}'
    return sql, views


def _register(mart: M.Mart) -> None:
    sql, views = _mart_sql(mart)

    @query(sql, *views, name=_WHOLE.get(mart.name, f"mart_{mart.name}"))
    def build(spark, d):
        return M.build_mart(crm_tables(spark, d), mart)


for _mart in M.MARTS:
    _register(_mart)


def _role_sql(relation: str, roles: dict[str, str]) -> str:
    parts = [
        f"SELECT c.*, '{name}' AS mart FROM contact_chain c JOIN {relation} r ON c.\"ID\" ="
        f" try_cast(regexp_extract(r.\"{col}\", '^\\s*(-?\\d+)', 1) AS BIGINT)"
        for name, col in roles.items()
    ]
    return "\nUNION ALL ".join(parts)


@query("\nUNION ALL ".join(f"SELECT c.*, '{n}' AS mart FROM contact_chain c WHERE c.\"{f}\" IS NOT NULL"
                           for n, f in S.CONTACT_FLAGS.items()), "contact_chain")
def contacts_by_flag(spark, d):
    return M.contacts_by_flags(M.entity_chain(crm_tables(spark, d), "contact"))


@query(_role_sql("entity_deal", S.DEAL_ROLES), "contact_chain", "entity_deal")
def contacts_by_deal_role(spark, d):
    t = crm_tables(spark, d)
    return M.contacts_by_roles(M.entity_chain(t, "contact"), t["entity_deal"], S.DEAL_ROLES).drop("_slice")


@query(_role_sql("entity_company", S.COMPANY_ROLES), "contact_chain", "entity_company")
def contacts_by_company_role(spark, d):
    t = crm_tables(spark, d)
    return M.contacts_by_roles(M.entity_chain(t, "contact"), t["entity_company"], S.COMPANY_ROLES).drop("_slice")


@query("\nUNION ALL ".join(
    f"SELECT c.*, '{n}' AS mart FROM contact_chain c WHERE EXISTS (SELECT 1 FROM entity_deal r WHERE c.\"ID\" ="
    f" try_cast(regexp_extract(r.\"{col}\", '^\\s*(-?\\d+)', 1) AS BIGINT))" for n, col in S.DEAL_ROLES.items()),
    "contact_chain", "entity_deal")
def contacts_by_role_dedup(spark, d):
    t = crm_tables(spark, d)
    out = M.contacts_by_roles(M.entity_chain(t, "contact"), t["entity_deal"], S.DEAL_ROLES, dedupe=True)
    return out.drop("_slice")


@query("""SELECT c.* FROM crm_contact c JOIN entity_deal r
          ON c."ID" = CAST(regexp_extract(r."sql_UF_CRM_1588240383", '^(\\d+)', 1) AS BIGINT)""",
       "crm_contact", "entity_deal")
def role_multi_first(spark, d):
    t = crm_tables(spark, d)
    return role_by_relation(t["crm_contact"], t["entity_deal"], S.DEAL_ROLES["tutor"])


@query("""SELECT c.* FROM crm_contact c JOIN
          (SELECT unnest(string_split("sql_UF_CRM_1588240383", ', ')) AS one FROM entity_deal) r
          ON c."ID" = CAST(r.one AS BIGINT)""", "crm_contact", "entity_deal")
def role_multi_explode(spark, d):
    t = crm_tables(spark, d)
    return role_by_relation(t["crm_contact"], t["entity_deal"], S.DEAL_ROLES["tutor"], multi="explode")


@query('SELECT c.*, CASE "CATEGORY_ID" ' + " ".join(f"WHEN '{v}' THEN '{n}'" for n, v in S.DEAL_CATEGORIES.items())
       + " END AS mart FROM deal_chain c WHERE \"CATEGORY_ID\" IN ("
       + ", ".join(f"'{v}'" for v in S.DEAL_CATEGORIES.values()) + ")", "deal_chain")
def deals_by_category(spark, d):
    return M.deals_by_categories(M.entity_chain(crm_tables(spark, d), "deal"))


_ENRICHED = """
, contact_of AS (SELECT "ID", "EMAIL", "SOURCE_DESCRIPTION" FROM crm_contact),
deal_of AS (
    SELECT * FROM (
        SELECT b."LEAD_ID" AS lead, b."SOURCE_NAME", b."SOURCE_DESCRIPTION", u."UF_CRM_5E5634910DD58",
               u."UF_CRM_1591275382", u."UF_CRM_5FA697664B231", u."UF_CRM_6341774C87D94",
               row_number() OVER (PARTITION BY b."LEAD_ID" ORDER BY b."ID") AS n
        FROM crm_deal b LEFT JOIN crm_deal_uf u ON b."ID" = u."DEAL_ID"
        WHERE regexp_full_match(b."LEAD_ID", '-?[0-9]+')) WHERE n = 1)
SELECT CAST(l."ID" AS BIGINT) AS "ID", try_cast(l."CONTACT_ID" AS BIGINT) AS "CONTACT_ID", l."SOURCE_ID", {extra}
       c."EMAIL" AS "Contacts_EMAIL", c."SOURCE_DESCRIPTION" AS "Contact_Source_Description",
       d."SOURCE_NAME" AS "Transactions_SOURCE_NAME", d."SOURCE_DESCRIPTION" AS "Transaction_Source_Description",
       d."UF_CRM_5E5634910DD58", d."UF_CRM_1591275382", d."UF_CRM_5FA697664B231", d."UF_CRM_6341774C87D94"
FROM {leads} l LEFT JOIN contact_of c ON try_cast(l."CONTACT_ID" AS BIGINT) = c."ID"
LEFT JOIN deal_of d ON l."ID" = d.lead
WHERE regexp_full_match(l."ID", '-?[0-9]+')"""


@query(_ENRICHED.format(leads="lead_chain", extra='l."LEAD_ID", l."UF_LANG", l."UF_SIZE", l."entity_lead_ID", l."sql_USER",'),
       "lead_chain", "crm_contact", "crm_deal", "crm_deal_uf")
def leads_enriched(spark, d):
    return M.enriched_leads(crm_tables(spark, d))


@query(_ENRICHED.format(leads="crm_lead", extra=""), "crm_lead", "crm_contact", "crm_deal", "crm_deal_uf")
def leads_enriched_all(spark, d):
    t = crm_tables(spark, d)
    return M.enriched_leads(t, t["crm_lead"])


@query("""SELECT CAST("ID" AS BIGINT) AS "ID",
                 CASE WHEN regexp_full_match("CONTACT_ID", '-?[0-9]+') THEN CAST("CONTACT_ID" AS BIGINT) END AS "CONTACT_ID",
                 "SOURCE_ID" FROM crm_lead WHERE "ID" IS NULL OR regexp_full_match("ID", '-?[0-9]+')""", "crm_lead")
def clean_int_ids(spark, d):
    return int_ids(crm_tables(spark, d)["crm_lead"], "ID", ("CONTACT_ID",))


@query("""SELECT "CONTACT_ID", "UF_CRM_1643183509", "UF_CRM_1606994316", "UF_CRM_1606994331", "UF_CRM_1604401780",
                 "UF_CRM_1604401811" FROM crm_contact_uf""", "crm_contact_uf")
def shared_columns_dropped(spark, d):
    t = crm_tables(spark, d)
    return drop_shared(t["crm_contact"], t["crm_contact_uf"], S.KEPT_SHARED["contact"])


@query('SELECT "ID", "CONTACT_ID", "EMAIL" FROM contact_chain', "contact_chain")
def contacts_nulls_first(spark, d):
    chained = M.entity_chain(crm_tables(spark, d), "contact").select("ID", "CONTACT_ID", "EMAIL")
    return sort_mart(chained, ["CONTACT_ID"], ["ID"])


def _written_sql() -> str:
    ids = """CAST(sum(CASE WHEN regexp_full_match(CAST("ID" AS VARCHAR), '-?[0-9]{1,18}') THEN CAST("ID" AS BIGINT) END) AS BIGINT) AS id_sum"""
    parts = [f"SELECT '{m.name}' AS mart, count(*) AS n_rows, {ids} FROM ({_mart_sql(m)[0]})" for m in M.MARTS
             if m.name != "leads"]
    ints = """WHERE regexp_full_match("ID", '-?[0-9]+')"""
    parts += [f"SELECT '{n}' AS mart, count(*) AS n_rows, {ids} FROM lead_chain {ints}" for n in ("leads", "leads_enriched")]
    return "\nUNION ALL ".join(parts)


@query(_written_sql(), *_CHAIN.values(), *CRM_TABLES)
def marts_written(spark, d):
    """Writes all 22 marts, counts what is stored and adds up its ids."""
    root = work_dir(spark, "marts")
    counts = None
    for name in M.write_all(spark, crm_tables(spark, d), root):
        whole = F.when(F.col("ID").cast("string").rlike("^-?[0-9]{1,18}$"), F.col("ID").try_cast("bigint"))
        one = M.read_mart(spark, root, name).agg(F.count(F.lit(1)).alias("n_rows"), F.sum(whole).alias("id_sum"))
        one = one.select(F.lit(name).alias("mart"), "n_rows", "id_sum")
        counts = one if counts is None else counts.unionByName(one)
    return counts


_CHANGED = """
SELECT 'contacts' AS mart, CAST("ID" AS VARCHAR) AS id, CASE WHEN "ID" % 90 = 1 THEN upper("EMAIL") ELSE "EMAIL" END AS cell FROM contact_chain
UNION ALL SELECT 'Tuteur2', CAST(c."ID" AS VARCHAR), CASE WHEN c."ID" % 90 = 1 THEN upper(c."EMAIL") ELSE c."EMAIL" END
  FROM contact_chain c JOIN entity_deal r ON c."ID" = try_cast(r."sql_UF_CRM_1602495367" AS BIGINT) WHERE r."entity_deal_ID" % 70 <> 2
UNION ALL SELECT 'deals', CAST("ID" AS VARCHAR), CASE WHEN "ID" % 80 = 3 THEN 'changed' ELSE "SOURCE_NAME" END FROM deal_chain
UNION ALL SELECT 'companies', CAST("ID" AS VARCHAR), CAST("UF_ORDERS" AS VARCHAR) FROM company_chain WHERE "ID" % 60 <> 4
UNION ALL SELECT 'Prospects_TC', l."ID", d.name FROM lead_chain l LEFT JOIN (
    SELECT "LEAD_ID", arg_min(coalesce(CASE WHEN "ID" % 80 = 3 THEN 'changed' ELSE "SOURCE_NAME" END, ''), "ID") AS name FROM crm_deal WHERE regexp_full_match("LEAD_ID", '-?[0-9]+') GROUP BY 1) d
  ON l."ID" = d."LEAD_ID" WHERE regexp_full_match(l."ID", '-?[0-9]+')"""


@query(_CHANGED, *_CHAIN.values(), "entity_deal", "crm_deal")
def marts_kept_up(spark, d):
    """All marts written, then some contacts, deals, relations and companies changed, then only the touched blocks written anew."""
    root, out = work_dir(spark, "kept-tables"), work_dir(spark, "kept-marts")
    for name, view in VIEWS.items():
        replace_table(view(spark, d), table_path(root, name))
    keep_up(spark, root, out, bits=10)
    cells = {"crm_contact": ("EMAIL", F.when(F.col("ID") % 90 == 1, F.upper("EMAIL")).otherwise(F.col("EMAIL"))),
             "crm_deal": ("SOURCE_NAME", F.when(F.col("ID") % 80 == 3, "changed").otherwise(F.col("SOURCE_NAME")))}
    for name, (column, value) in cells.items():
        replace_table(load_table(spark, root, name).withColumn(column, value), table_path(root, name))
    replace_table(load_table(spark, root, "entity_deal").where("entity_deal_ID % 70 <> 2"), table_path(root, "entity_deal"))
    replace_table(load_table(spark, root, "crm_company").where("ID % 60 <> 4"), table_path(root, "crm_company"))
    keep_up(spark, root, out, bits=10)
    rows = None
    for mart, cell in (("contacts", "EMAIL"), ("Tuteur2", "EMAIL"), ("deals", "SOURCE_NAME"), ("companies", "UF_ORDERS"), ("Prospects_TC", "Transactions_SOURCE_NAME")):
        one = M.read_mart(spark, out, mart).select(F.lit(mart).alias("mart"), F.col("ID").cast("string").alias("id"), F.col(cell).cast("string").alias("cell"))
        rows = one if rows is None else rows.unionByName(one)
    return rows
