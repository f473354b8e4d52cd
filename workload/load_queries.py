"""Column rules, loads, checks and the incremental paths."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from martloom.operators import columns as cols
from martloom.operators import filters, gaps, loading, quality, votes
from martloom.operators.joins import new_rows as rows_not_in
from martloom.plans.refresh import audit_row, refresh_connector, refresh_entity
from martloom.session import work_dir
from martloom.sources import history, load_table, read_stored, read_version, table_path
from martloom.sources.versions import write_version
from martloom.streaming.arrivals import stream_new_rows as stream
from workload.function_queries import raw, raw_orders
from workload.oracle_views import CRM_TABLES
from workload.registry import query
from workload.source_queries import customer_matrices, order_pages
from workload.views import VIEWS, crm_deal, crm_deal_uf, crm_deal_uf_raw, crm_lead, crm_tables, load

#: Time stamp of the audit rows, fixed so that runs compare.
AT = datetime(2024, 5, 6, 23, 30)


@query("SELECT o_totalprice, o_orderkey, 'absent' AS missing FROM orders")
def include_projection(spark, d):
    kept, missing = cols.keep_columns(load(spark, d, "orders"), ["o_totalprice", "absent", "o_orderkey"])
    return kept.withColumn("missing", F.lit(", ".join(missing)))


@query("SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate FROM orders")
def exclude_projection(spark, d):
    return cols.drop_columns(load(spark, d, "orders"), ["O_TOTALPRICE", "o_orderpriority", "absent"])


@query("""SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem""")
def numeric_projection(spark, d):
    return cols.numeric_only(load(spark, d, "lineitem"))


@query("""SELECT c_custkey AS "entity_contact_c_custkey", c_name AS "sql_c_name", c_nationkey AS "sql_c_nationkey",
                 c_acctbal AS "sql_c_acctbal", c_mktsegment AS "sql_c_mktsegment" FROM customer""")
def prefixed_columns(spark, d):
    return cols.prefix_columns(load(spark, d, "customer"), "contact", "c_custkey")


@query("""SELECT *, CAST(NULL AS VARCHAR) AS note FROM customer""")
def null_text_column(spark, d):
    return cols.add_null_text(load(spark, d, "customer"), ["c_name", "note"])


@query("""SELECT "DEAL_ID", "UF_CRM_1611039011", "UF_CRM_1691245430" FROM crm_deal_uf_raw""", "crm_deal_uf_raw")
def removed_columns(spark, d):
    before = crm_deal_uf_raw(spark, d)
    removed, added = cols.schema_diff(before, crm_deal_uf(spark, d))
    assert not added
    return before.select("DEAL_ID", *removed)


@query("""SELECT * FROM crm_deal WHERE try_cast("CATEGORY_ID" AS INTEGER) = 42""", "crm_deal")
def category_filter(spark, d):
    return filters.by_category(crm_deal(spark, d), 42)


@query("SELECT * FROM orders WHERE o_totalprice > 250000")
def greater_filter(spark, d):
    return filters.greater_than(load(spark, d, "orders"), "o_totalprice", 250000)


@query("""SELECT "ID", CASE WHEN regexp_full_match("CONTACT_ID", '-?[0-9]+') THEN "CONTACT_ID" END AS "CONTACT_ID", "SOURCE_ID"
          FROM crm_lead""", "crm_lead")
def foreign_key_nulls(spark, d):
    return filters.null_nonint(crm_lead(spark, d), "CONTACT_ID")


@query("""SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, CAST(NULL AS DOUBLE) AS s_rank, CAST(NULL AS VARCHAR) AS s_note
          FROM customer
          UNION ALL SELECT s_suppkey, s_name, NULL, s_acctbal, NULL, CAST(s_nationkey AS DOUBLE), 'n' || s_nationkey FROM supplier""")
def additive_union(spark, d):
    stored = load(spark, d, "customer")
    s = load(spark, d, "supplier")
    arriving = s.select(F.col("s_suppkey").cast("string").alias("C_CUSTKEY"), F.col("s_name").alias("c_name"),
                        F.lit("none").alias("c_nationkey"), F.col("s_acctbal").alias("c_acctbal"),
                        F.col("s_nationkey").alias("s_rank"), F.concat(F.lit("n"), "s_nationkey").alias("s_note"))
    return stored.unionByName(loading.align_additive(arriving, stored.schema), allowMissingColumns=True)


@query(raw("""SELECT id, nullif(closed, '0000-00-00 00:00:00') AS closed, CASE WHEN large THEN NULL ELSE 1.5::DOUBLE END AS ratio FROM raw"""))
def normalised_nulls(spark, d):
    r = raw_orders(spark, d)
    ratio = F.when(F.col("large"), F.lit(float("nan"))).otherwise(F.lit(1.5))
    return loading.normalise_nulls(r.select("id", "closed", ratio.alias("ratio")))


@query("""SELECT "ID", CAST("CREATED_RAW"[1:19] AS TIMESTAMP) AS "CREATED_RAW", "OPPORTUNITY_RAW" FROM crm_deal""", "crm_deal")
def date_retype(spark, d):
    from martloom.functions import local_timestamp_text

    raw_deals = crm_deal(spark, d).select("ID", "CREATED_RAW", "OPPORTUNITY_RAW")
    found = quality.date_columns(raw_deals)
    cleaned = raw_deals.withColumns({c: local_timestamp_text(F.col(c)) for c in found})
    return loading.retype_dates(cleaned, found)


@query("""SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY ALL HAVING count(*) > 1""")
def key_violations(spark, d):
    return quality.check_key(load(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("""SELECT try_cast("ID" AS BIGINT) AS "ID", count(*) AS n_rows FROM crm_lead GROUP BY 1
          HAVING count(*) > 1 OR try_cast("ID" AS BIGINT) IS NULL""", "crm_lead")
def int_key_violations(spark, d):
    return quality.check_int_key(crm_lead(spark, d), "ID")


@query("""SELECT CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS n_ids, CAST(sum(n - 1) AS BIGINT) AS n_repeats
          FROM (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1)""")
def distinct_ids(spark, d):
    return quality.distinct_ids(load(spark, d, "lineitem"), "l_orderkey")


_SOURCE_OF = {
    "crm_contact": "customer", "crm_contact_uf": "customer", "entity_contact": "customer", "crm_deal": "orders",
    "crm_deal_uf": "orders", "entity_deal": "orders", "crm_lead": "events", "crm_lead_uf": "events",
    "entity_lead": "events", "crm_company": "part", "crm_company_uf": "part", "entity_company": "part",
}


def _reconcile_sql(name: str = "table_name", pattern: str = "{t}") -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{pattern.format(t=t)}' AS {name}, l.n AS n_loaded, s.n AS n_source, s.n - l.n AS gap"
        f" FROM (SELECT count(*) AS n FROM {t}) l, (SELECT count(*) AS n FROM {s}) s" for t, s in _SOURCE_OF.items())


def _declared(spark, d):
    out = None
    for table, source in _SOURCE_OF.items():
        one = load(spark, d, source).agg(F.count(F.lit(1)).alias("n_source")).select(F.lit(table).alias("table_name"), "n_source")
        out = one if out is None else out.unionByName(one)
    return out


@query(_reconcile_sql(), *CRM_TABLES)
def sync_reconcile(spark, d):
    """Rows of each CRM table against the rows of the table its records come from."""
    return quality.reconcile(crm_tables(spark, d), _declared(spark, d))


@query("SELECT 'lineitem' AS table_name, count(*) AS n_loaded FROM lineitem")
def row_count(spark, d):
    return quality.row_count(load(spark, d, "lineitem"), "lineitem")


@query("""SELECT TIMESTAMP '2024-05-06 23:30:00' AS timestamp, 'main' AS database_name, table_name,
                 CAST(n_loaded AS BIGINT) AS db_entry_count, CAST(n_source AS BIGINT) AS crm_entry_count,
                 CAST(NULL AS VARCHAR) AS error_message
          FROM (""" + _reconcile_sql() + """)
          UNION ALL SELECT TIMESTAMP '2024-05-06 23:30:00', 'main', 'entity_broken', 0, NULL, 'no answer'""", *CRM_TABLES)
def sync_log(spark, d):
    root = work_dir(spark, "log")
    counts = quality.reconcile(crm_tables(spark, d), _declared(spark, d))
    entries = counts.select(F.lit(str(AT)).cast("timestamp_ntz").alias("timestamp"), F.lit("main").alias("database_name"), "table_name",
                            F.col("n_loaded").alias("db_entry_count"), F.col("n_source").alias("crm_entry_count"),
                            F.lit(None).cast("string").alias("error_message"))
    loading.reset_log(spark, root, "main")
    loading.log_sync(entries, root, "main")
    loading.log_sync(audit_row(spark, AT, "main", "entity_broken", 0, None, "no answer"), root, "main")
    return load_table(spark, root, loading.SYNC_LOG, "main")


@query("\nUNION ALL ".join(
    f"""SELECT '{c}' AS column_name, '{kind}' AS sql_type, count(nullif(CAST("{c}" AS VARCHAR), '')) AS n_values FROM crm_deal"""
    for c, kind in {"ID": "INTEGER", "CATEGORY_ID": "INTEGER", "LEAD_ID": "TEXT", "SOURCE_NAME": "TEXT", "SOURCE_DESCRIPTION": "TEXT",
                    "OPPORTUNITY_RAW": "TEXT", "CREATED_RAW": "DATETIME"}.items()), "crm_deal")
def infer_types_fixed(spark, d):
    return quality.infer_types(crm_deal(spark, d))


def _vote_sql(table: str, *names: str) -> str:
    number = "'\\s*[+-]?(\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?\\s*'"
    date = "'\\d{4}-\\d\\d-\\d\\d|\\d{4}-\\d\\d-\\d\\dT\\d\\d:\\d\\d:\\d\\d(\\.\\d+)?(Z|[+-]\\d\\d:\\d\\d)'"
    parts = []
    for c in names:
        v = f"nullif(CAST({c} AS VARCHAR), '')"
        parts.append(f"""SELECT '{c}' AS column_name,
            CASE WHEN count({v}) = 0 THEN 'TEXT'
                 WHEN any_value(typeof({c})) IN ('DATE', 'TIMESTAMP', 'TIMESTAMP WITH TIME ZONE') OR bool_and(regexp_full_match({v}, {date})) THEN 'DATETIME'
                 WHEN bool_or(starts_with({v}, '0') AND length({v}) > 1) OR NOT bool_and(regexp_full_match({v}, {number})) THEN 'TEXT'
                 WHEN bool_and(regexp_full_match({v}, '-?[0-9]+')) THEN 'INTEGER' ELSE 'FLOAT' END AS sql_type,
            count({v}) AS n_values FROM {table}""")
    return "\nUNION ALL ".join(parts)


LINEITEM = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")


@query(_vote_sql("lineitem", *LINEITEM))
def infer_types(spark, d):
    return quality.infer_types(load(spark, d, "lineitem"))


@query(_vote_sql("lineitem", *LINEITEM))
def voted_types(spark, d):
    """The same after two loads, each of which had only its own files voted on."""
    path, rows = table_path(work_dir(spark, "votes"), "lineitem"), load(spark, d, "lineitem")
    first = F.col("l_linenumber") == 1
    for part, add in ((rows.where(first), False), (rows.where(~first), True)):
        loaded = write_version(part, path, "load", add=add)
        voted = votes.keep_votes(spark, path)
        assert {e.file for e in voted} <= {e.file for e in loaded.files}
    assert not votes.keep_votes(spark, path)
    return votes.voted_types(spark, path)


@query("\nUNION ALL ".join(
    f"SELECT '{c}' AS column_name, 'TEXT' AS sql_type, count({c}) AS n_values FROM orders"
    for c in ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")))
def infer_types_in_effect(spark, d):
    return quality.infer_types(load(spark, d, "orders"), mode="reference")


@query("""SELECT * FROM orders o WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o.o_orderkey)""")
def new_rows(spark, d):
    known = load(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return rows_not_in(load(spark, d, "orders"), known, "o_orderkey")


@query("SELECT max(o_orderkey) AS max_id FROM orders")
def max_id(spark, d):
    return quality.max_id(load(spark, d, "orders"), "o_orderkey")


def _stored(spark, d):
    """The twelve CRM tables written below a new root."""
    root = work_dir(spark, "tables")
    for name, view in VIEWS.items():
        loading.replace_table(view(spark, d), table_path(root, name, "main"))
    return root


@query(_reconcile_sql(pattern="{t}_transform").replace(", s.n AS n_source, s.n - l.n AS gap", ", l.n AS n_source, 0::BIGINT AS gap"),
       *CRM_TABLES)
def snapshot_counts(spark, d):
    root = _stored(spark, d)
    loading.snapshot(spark, root, CRM_TABLES, database="main")
    copies = {f"{t}_transform": load_table(spark, root, f"{t}_transform", "main") for t in CRM_TABLES}
    declared = None
    for t in CRM_TABLES:
        one = quality.row_count(load_table(spark, root, t, "main"), f"{t}_transform").withColumnRenamed("n_loaded", "n_source")
        declared = one if declared is None else declared.unionByName(one)
    return quality.reconcile(copies, declared)


@query("SELECT * FROM orders")
def snapshot_roundtrip(spark, d):
    root = work_dir(spark, "snapshot")
    loading.replace_table(load(spark, d, "orders"), table_path(root, "orders"))
    loading.snapshot(spark, root, ["orders"])
    return load_table(spark, root, "orders_transform")


@query("""SELECT c_custkey, c_name, CAST(NULL AS INTEGER) AS c_nationkey, c_acctbal, CAST(NULL AS VARCHAR) AS c_mktsegment,
                 CAST(c_nationkey AS DOUBLE) AS c_rank FROM customer""")
def refresh_keeps_schema(spark, d):
    """A second load without two columns and with a new one: old columns stay, as NULL."""
    path, c = table_path(work_dir(spark, "refresh"), "customer"), load(spark, d, "customer")
    loading.full_refresh(c, path)
    loading.full_refresh(c.select("c_custkey", "c_name", "c_acctbal", F.col("c_nationkey").alias("c_rank")), path)
    return read_stored(spark, path)


@query("SELECT c_custkey, c_nationkey AS c_rank FROM customer")
def replace_drops_schema(spark, d):
    path, c = table_path(work_dir(spark, "replace"), "customer"), load(spark, d, "customer")
    loading.full_refresh(c, path)
    loading.replace_table(c.select("c_custkey", F.col("c_nationkey").alias("c_rank")), path)
    return read_stored(spark, path)


@query("SELECT * FROM customer")
def refresh_empty_skip(spark, d):
    path, c = table_path(work_dir(spark, "skip"), "customer"), load(spark, d, "customer")
    assert loading.load_if_nonempty(c, path)
    assert not loading.load_if_nonempty(c.where("c_custkey is null"), path)
    return read_stored(spark, path)


@query("SELECT o_orderkey, o_custkey, o_orderpriority FROM orders")
def append_only_new(spark, d):
    """Orders that have line items first, then all of them: the rest is added once."""
    path = work_dir(spark, "append")
    o = load(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    items = load(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    loading.append_new(o.join(items, "o_orderkey", "left_semi"), path, "o_orderkey")
    loading.append_new(o, path, "o_orderkey")
    loading.append_new(o, path, "o_orderkey")
    return read_stored(spark, path)


@query("SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders")
def mart_write(spark, d):
    path = work_dir(spark, "mart")
    o = load(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    loading.write_mart(o, path, ["o_orderkey"], by="o_orderstatus")
    return read_stored(spark, path)


@query("""SELECT 'entity_item' AS table_name, n AS stored, CAST(n AS BIGINT) AS db_entry_count,
                 (SELECT CAST(max(o_orderkey) + 2 AS BIGINT) FROM orders) AS crm_entry_count, n_values
          FROM (SELECT 2 * count(*) AS n, count(DISTINCT o_orderstatus) + count(DISTINCT o_orderpriority) AS n_values
                FROM orders WHERE o_orderstatus <> 'P')""")
def entity_refresh(spark, d):
    """Landed pages to a cleaned, stored and audited table."""
    root = work_dir(spark, "entity")
    loading.reset_log(spark, root, "main")
    pages = order_pages(spark, d).select(F.col("page").alias("value"))
    assert refresh_entity(pages, root, "item", AT, "main")
    log = load_table(spark, root, loading.SYNC_LOG, "main").drop("timestamp", "error_message", "database_name")
    stored = load_table(spark, root, "entity_item", "main").agg(
        F.count(F.lit(1)).alias("stored"), F.count_distinct("VALUE").alias("n_values"), F.lit("entity_item").alias("table_name"))
    return log.join(stored, "table_name")


@query("""SELECT CAST(c_custkey AS VARCHAR) AS "ID", c_name AS "NAME", CASE WHEN c_acctbal >= 0 THEN c_mktsegment END AS "SEGMENT" FROM customer
          UNION ALL SELECT CAST(c_custkey AS VARCHAR), NULL, 'again' FROM customer WHERE c_acctbal >= 0""")
def connector_refresh(spark, d):
    root = work_dir(spark, "connector")
    assert refresh_connector(customer_matrices(spark, d).withColumnRenamed("doc", "value"), root, "crm_contact", "main")
    return load_table(spark, root, "crm_contact", "main")


@query("""SELECT CAST(o_orderkey AS VARCHAR) AS "ID", 'priority' AS "KIND", o_orderpriority AS "VALUE" FROM orders WHERE o_orderstatus <> 'P'""")
def stream_new_rows(spark, d):
    """Pages land twice and are ingested twice; every id is stored once."""
    root = work_dir(spark, "stream")
    pages = order_pages(spark, d).select("page")
    for _ in range(2):
        pages.write.mode("append").text(f"{root}/landed")
        stream(spark, f"{root}/landed", f"{root}/stored", f"{root}/checkpoint", ["ID", "KIND", "VALUE"])
    return read_stored(spark, f"{root}/stored")


@query("SELECT * FROM customer")
def older_version(spark, d):
    """The first version, read after two more loads and from a snapshot that was taken before them."""
    root = work_dir(spark, "versions")
    path, c = table_path(root, "customer"), load(spark, d, "customer")
    loading.full_refresh(c, path)
    loading.snapshot(spark, root, ["customer"])
    loading.full_refresh(c.withColumn("c_name", F.lit("changed")), path)
    loading.replace_table(c.select("c_custkey"), path)
    first, copy = read_version(spark, path, 1), load_table(spark, root, "customer_transform")
    return first.join(copy, c.columns, "left_semi")


@query("""SELECT v AS version, operation, (SELECT count(*) FROM customer) AS n_rows, name AS column_name, kind AS column_type, lost AS n_nulled
          FROM (VALUES (1, 'refresh', 'c_custkey', 'bigint', 0), (1, 'refresh', 'c_nationkey', 'int', 0), (2, 'refresh', 'c_custkey', 'bigint', 0),
                       (2, 'refresh', 'c_nationkey', 'int', 1), (2, 'refresh', 'c_name', 'string', 0), (3, 'replace', 'c_name', 'string', 0)) t(v, operation, name, kind, low)
          JOIN (SELECT 0 AS low, 0::BIGINT AS lost UNION ALL SELECT 1, count(*) FROM customer WHERE c_acctbal < 0) USING (low)""")
def version_history(spark, d):
    """Columns of every version, and the values that the stored type could not hold, without opening a data file."""
    path, c = table_path(work_dir(spark, "history"), "customer"), load(spark, d, "customer")
    nation = F.when(F.col("c_acctbal") < 0, "none").otherwise(F.col("c_nationkey").cast("string"))
    loading.full_refresh(c.select("c_custkey", "c_nationkey"), path)
    loading.full_refresh(c.select("c_custkey", nation.alias("c_nationkey"), "c_name"), path)
    loading.replace_table(c.select("c_name"), path)
    return history(spark, path)


@query("SELECT o_orderkey, o_custkey, o_orderpriority FROM orders")
def append_interleaved(spark, d):
    """Batches of interleaved ids, repeated in part: unseen ids are told from bitmaps."""
    path = work_dir(spark, "interleaved")
    o = load(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    for rest in (0, 1, 2):
        loading.append_new(o.where(F.col("o_orderkey") % 3 <= rest), path, "o_orderkey")
    return read_stored(spark, path)


@query("""SELECT "ID", "SOURCE_ID" FROM crm_lead""", "crm_lead")
def append_text_ids(spark, d):
    """Ids that are integers, and ids that are text."""
    path, leads = work_dir(spark, "text-ids"), crm_lead(spark, d).select("ID", "SOURCE_ID")
    loading.append_new(leads.where("SOURCE_ID in ('error', 'view')"), path, "ID")
    loading.append_new(leads, path, "ID")
    return read_stored(spark, path)


@query("""SELECT CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS n_ids, CAST(sum(n - 1) AS BIGINT) AS n_repeats
          FROM (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1)""")
def distinct_stored_ids(spark, d):
    path = table_path(work_dir(spark, "ids"), "lineitem")
    loading.replace_table(load(spark, d, "lineitem").select("l_orderkey", "l_linenumber"), path, "l_orderkey")
    return loading.distinct_stored_ids(spark, path, "l_orderkey")


@query("SELECT l_orderkey AS id, count(*) AS n_rows FROM lineitem GROUP BY l_orderkey HAVING count(*) > 1")
def repeated_stored_ids(spark, d):
    path = table_path(work_dir(spark, "repeats"), "lineitem")
    loading.replace_table(load(spark, d, "lineitem").select("l_orderkey", "l_linenumber"), path, "l_orderkey")
    return loading.repeated_stored_ids(spark, path)


@query("""WITH landed AS (SELECT DISTINCT o_orderpriority AS source, o_orderkey // 5 AS page FROM orders WHERE o_orderstatus = 'F'),
               wanted AS (SELECT source, unnest(range(0, n)) AS page FROM (SELECT o_orderpriority AS source, CAST(ceil(max(o_orderkey) / 5) AS BIGINT) AS n FROM orders GROUP BY 1)),
               missing AS (SELECT source, page, page - row_number() OVER (PARTITION BY source ORDER BY page) AS run FROM wanted ANTI JOIN landed USING (source, page))
          SELECT source, min(page) AS first, max(page) AS last, count(*) AS n_missing FROM missing GROUP BY source, run""")
def missing_pages(spark, d):
    """Pages of five records of which none has landed, as runs, by the declared totals."""
    o = load(spark, d, "orders").withColumnRenamed("o_orderpriority", "source")
    pages = o.where("o_orderstatus = 'F'").select("source", (F.floor(F.col("o_orderkey") / 5) * 5).alias("start"))
    return gaps.missing_pages(pages, o.groupBy("source").agg(F.max("o_orderkey").alias("n_source")), "source", size=5)
