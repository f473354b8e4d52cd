"""The CRM views of ``workload.views`` once more, in SQL, for the independent check."""

from __future__ import annotations

SQL_VIEWS = {
    "crm_contact": """
        SELECT c_custkey AS "ID", c_name AS "NAME",
               lower(replace(c_name, '#', '.')) || '@x.example' AS "EMAIL",
               c_mktsegment AS "SOURCE_DESCRIPTION"
        FROM customer""",
    "crm_contact_uf": """
        SELECT user_id AS "CONTACT_ID", max(event_type) AS "NAME",
               max(event_id) FILTER (WHERE event_type = 'error' AND value > 150) AS "UF_CRM_1643183509",
               max(event_id) FILTER (WHERE event_type = 'click' AND value > 150) AS "UF_CRM_1606994316",
               max(event_id) FILTER (WHERE event_type = 'view' AND value > 150) AS "UF_CRM_1606994331",
               max(event_id) FILTER (WHERE event_type = 'purchase' AND value > 150) AS "UF_CRM_1604401780",
               max(event_id) FILTER (WHERE event_type = 'signup' AND value > 150) AS "UF_CRM_1604401811"
        FROM events GROUP BY user_id""",
    "entity_contact": """
        SELECT o_custkey AS "entity_contact_ID", max(o_orderkey) AS "sql_LAST_DEAL",
               max(o_orderstatus) AS "SOURCE_DESCRIPTION"
        FROM orders GROUP BY o_custkey""",
    "crm_deal": """
        SELECT o_orderkey AS "ID",
               CASE o_orderpriority WHEN '1-URGENT' THEN '8' WHEN '2-HIGH' THEN '4' WHEN '3-MEDIUM' THEN '10'
                    WHEN '4-NOT SPECIFIED' THEN '42' ELSE '20' END AS "CATEGORY_ID",
               CASE WHEN o_orderpriority = '5-LOW' THEN '' WHEN o_orderstatus = 'P' THEN 'L' || o_orderkey
                    ELSE CAST(o_custkey AS VARCHAR) END AS "LEAD_ID",
               o_orderstatus AS "SOURCE_NAME", o_orderpriority AS "SOURCE_DESCRIPTION",
               CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) || '|EUR' AS "OPPORTUNITY_RAW",
               CAST(CAST(o_orderdate AS DATE) AS VARCHAR) || 'T10:11:12+03:00' AS "CREATED_RAW"
        FROM orders""",
    "crm_deal_uf_raw": """
        SELECT l_orderkey AS "DEAL_ID", max(l_returnflag) AS "SOURCE_NAME",
               CAST(CAST(sum(l_quantity) AS BIGINT) AS VARCHAR) AS "UF_CRM_5E5634910DD58",
               CAST(max(l_linenumber) AS VARCHAR) AS "UF_CRM_1591275382",
               CAST(count(*) AS VARCHAR) AS "UF_CRM_5FA697664B231",
               CAST(min(l_suppkey) AS VARCHAR) AS "UF_CRM_6341774C87D94",
               CAST(min(l_linenumber) AS VARCHAR) AS "UF_CRM_1611039011",
               CAST(min(l_partkey) AS VARCHAR) AS "UF_CRM_1691245430"
        FROM lineitem GROUP BY l_orderkey""",
    "crm_deal_uf": """
        SELECT l_orderkey AS "DEAL_ID", max(l_returnflag) AS "SOURCE_NAME",
               CAST(CAST(sum(l_quantity) AS BIGINT) AS VARCHAR) AS "UF_CRM_5E5634910DD58",
               CAST(max(l_linenumber) AS VARCHAR) AS "UF_CRM_1591275382",
               CAST(count(*) AS VARCHAR) AS "UF_CRM_5FA697664B231",
               CAST(min(l_suppkey) AS VARCHAR) AS "UF_CRM_6341774C87D94"
        FROM lineitem GROUP BY l_orderkey""",
    "entity_deal": """
        SELECT o_orderkey AS "entity_deal_ID", CAST(o_custkey AS VARCHAR) AS "sql_UF_CRM_1589207602",
               CAST(o_custkey AS VARCHAR) || ', ' || CAST(o_orderkey // 10 AS VARCHAR) AS "sql_UF_CRM_1588240383",
               CASE WHEN o_orderstatus <> 'P' THEN CAST(o_custkey AS VARCHAR) END AS "sql_UF_CRM_1602495367",
               CASE WHEN o_orderpriority = '2-HIGH' THEN '' ELSE CAST(o_custkey AS VARCHAR) END
                   AS "sql_UF_CRM_1591262278"
        FROM orders""",
    "crm_lead": """
        SELECT CASE WHEN event_type = 'error' THEN 'X' || event_id ELSE CAST(event_id AS VARCHAR) END AS "ID",
               CASE event_type WHEN 'view' THEN '' WHEN 'click' THEN 'C' || user_id
                    ELSE CAST(user_id AS VARCHAR) END AS "CONTACT_ID",
               event_type AS "SOURCE_ID"
        FROM events""",
    "crm_lead_uf": """
        SELECT CASE WHEN lang = 'fr' THEN 'X' || doc_id ELSE CAST(doc_id AS VARCHAR) END AS "LEAD_ID",
               source AS "SOURCE_ID", lang AS "UF_LANG", n_chars AS "UF_SIZE"
        FROM documents""",
    "entity_lead": """
        SELECT CASE WHEN event_type = 'error' THEN 'X' || event_id ELSE CAST(event_id AS VARCHAR) END
                   AS "entity_lead_ID",
               user_id AS "sql_USER"
        FROM events""",
    "crm_company": """
        SELECT p_partkey AS "ID", p_name AS "TITLE", p_brand AS "BRAND" FROM part""",
    "crm_company_uf": """
        SELECT l_partkey AS "COMPANY_ID", max(l_returnflag) AS "TITLE", count(*) AS "UF_ORDERS"
        FROM lineitem GROUP BY l_partkey""",
    "entity_company": """
        SELECT s_suppkey AS "entity_company_ID", CAST(s_suppkey AS VARCHAR) AS "sql_UF_CRM_1589375441",
               CAST(s_nationkey AS VARCHAR) AS "sql_UF_CRM_1589375694",
               CASE WHEN s_acctbal < 0 THEN '' ELSE CAST(s_suppkey AS VARCHAR) END AS "sql_UF_CRM_1589355778"
        FROM supplier""",
}

# The four joined tables, written out column by column.
SQL_VIEWS["contact_chain"] = """
        SELECT b."ID", b."NAME", b."EMAIL", b."SOURCE_DESCRIPTION", u."CONTACT_ID", u."UF_CRM_1643183509",
               u."UF_CRM_1606994316", u."UF_CRM_1606994331", u."UF_CRM_1604401780", u."UF_CRM_1604401811",
               e."entity_contact_ID", e."sql_LAST_DEAL"
        FROM crm_contact b LEFT JOIN crm_contact_uf u ON b."ID" = u."CONTACT_ID"
        LEFT JOIN entity_contact e ON b."ID" = e."entity_contact_ID\""""
SQL_VIEWS["deal_chain"] = """
        SELECT b."ID", b."CATEGORY_ID", b."LEAD_ID", b."SOURCE_NAME", b."SOURCE_DESCRIPTION", b."OPPORTUNITY_RAW",
               b."CREATED_RAW", u."DEAL_ID", u."UF_CRM_5E5634910DD58", u."UF_CRM_1591275382",
               u."UF_CRM_5FA697664B231", u."UF_CRM_6341774C87D94", e."entity_deal_ID", e."sql_UF_CRM_1589207602",
               e."sql_UF_CRM_1588240383", e."sql_UF_CRM_1602495367", e."sql_UF_CRM_1591262278"
        FROM crm_deal b LEFT JOIN crm_deal_uf u ON b."ID" = u."DEAL_ID"
        LEFT JOIN entity_deal e ON b."ID" = e."entity_deal_ID\""""
SQL_VIEWS["lead_chain"] = """
        SELECT b."ID", b."CONTACT_ID", b."SOURCE_ID", u."LEAD_ID", u."UF_LANG", u."UF_SIZE", e."entity_lead_ID",
               e."sql_USER"
        FROM crm_lead b JOIN crm_lead_uf u ON b."ID" = u."LEAD_ID"
        JOIN entity_lead e ON b."ID" = e."entity_lead_ID\""""
SQL_VIEWS["company_chain"] = """
        SELECT b."ID", b."TITLE", b."BRAND", u."COMPANY_ID", u."UF_ORDERS", e."entity_company_ID",
               e."sql_UF_CRM_1589375441", e."sql_UF_CRM_1589375694", e."sql_UF_CRM_1589355778"
        FROM crm_company b JOIN crm_company_uf u ON b."ID" = u."COMPANY_ID"
        JOIN entity_company e ON b."ID" = e."entity_company_ID\""""

_NEEDS = {
    "contact_chain": ["crm_contact", "crm_contact_uf", "entity_contact"],
    "deal_chain": ["crm_deal", "crm_deal_uf", "entity_deal"],
    "lead_chain": ["crm_lead", "crm_lead_uf", "entity_lead"],
    "company_chain": ["crm_company", "crm_company_uf", "entity_company"],
}

CRM_TABLES = [t for needs in _NEEDS.values() for t in needs]


def with_views(sql: str, *views: str) -> str:
    """The SQL with the views it reads in front."""
    if not views:
        return sql
    ordered = list(dict.fromkeys(v for name in views for v in (*_NEEDS.get(name, []), name)))
    return "WITH " + ",\n".join(f"{v} AS ({SQL_VIEWS[v]})" for v in ordered) + "\n" + sql
