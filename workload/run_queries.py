"""Whole runs: landed pages of every kind to stored, audited tables, and bucketed copies to a mart."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from martloom import settings as S
from martloom.functions.cleaning import zero_fill
from martloom.operators.loading import SYNC_LOG, snapshot_bucketed
from martloom.plans import marts as M
from martloom.plans.daily import Source, run_source
from martloom.session import shuffle_width, work_dir
from martloom.sources import load_table
from workload.load_queries import AT
from workload.registry import query
from workload.views import crm_tables, load


def _page(total, *fields, payload=None):
    """One page with one record."""
    records = F.array(F.struct(*fields))
    body = records if payload is None else F.struct(records.alias(payload))
    return F.to_json(F.struct(body.alias("result"), total.alias("total")))


def _land(spark, d, folder):
    """Pages of every kind from the whole tables."""
    def put(name, df, page):
        df.select(page.alias("value")).write.text(f"{folder}/main/{name}")

    part, orders, customer = load(spark, d, "part"), load(spark, d, "orders"), load(spark, d, "customer")
    color = F.struct(F.col("p_brand").alias("value"), F.col("p_size").alias("valueId"))
    put("product", part, _page(F.col("p_partkey") + 1, F.col("p_partkey").alias("ID"), color.alias("PROPERTY_5")))
    put("productsection", part.unionByName(part), _page(F.col("p_partkey") + 1, F.col("p_partkey").alias("ID"), F.col("p_type").alias("NAME")))

    segment = F.col("c_mktsegment")
    put("lists", customer.select("c_mktsegment").distinct(),
        _page(F.lit(5), F.concat(F.lit("seg="), segment).alias("ID"), F.concat(F.lit("seg "), segment).alias("NAME")))
    pages = customer.select(segment.alias("seg"), _page(
        F.col("c_custkey") + 1, F.col("c_custkey").alias("ID"), F.create_map(F.col("c_nationkey").cast("string"), "c_name").alias("PROPERTY_9")).alias("value"))
    pages.write.partitionBy("seg").text(f"{folder}/main/list")

    put("types", orders, _page(F.lit(1), F.lit(140).alias("entityTypeId"), payload="types"))
    worth = F.when(F.col("o_orderstatus") == "P", 0).otherwise(F.col("o_totalprice"))
    at = F.concat(F.col("o_orderdate").cast("date").cast("string"), F.lit("T01:02:03+01:00"))
    item = _page(F.col("o_orderkey") + 1, F.col("o_orderkey").alias("id"), worth.alias("opportunity"), at.alias("createdTime"), payload="items")
    put("item/140", orders, item)
    put("item/31", orders, item)
    put("productrow", load(spark, d, "lineitem"), _page(
        F.lit(None).cast("bigint"), F.col("l_orderkey").alias("ownerId"), F.lit("T8c").alias("ownerType"), F.col("l_partkey").alias("productId"),
        payload="productRows"))

    fields = F.create_map("n_name", F.struct(F.lit("string").alias("type")), F.lit("UF_REL"), F.struct(F.lit("crm").alias("type")))
    nation = load(spark, d, "nation")
    for entity, table, key in (("deal", orders, "o_orderkey"), ("contact", customer, "c_custkey"),
                               ("lead", load(spark, d, "events"), "event_id"), ("company", load(spark, d, "supplier"), "s_suppkey")):
        put(f"fields/{entity}", nation, F.to_json(F.struct(fields.alias("result"))))
        put(entity, table, _page(F.col(key) + 1, F.col(key).alias("ID"), F.col(key).alias("UF_REL"), F.lit("t").alias("TITLE")))
    for name in S.CONNECTOR_TABLES:
        head, row = F.array(F.lit(S.TABLE_KEYS[name]), F.lit("V")), F.array(F.col("c_custkey").cast("string"), "c_name")
        put(f"connector/{name}", customer, F.to_json(F.array(head, row)))


def _run(spark, d, connector):
    root = work_dir(spark, "run")
    _land(spark, d, f"{root}/landed")
    source = Source("main", product_sections=True, product_rows={"entity_140": "T8c"}, connector=connector)
    failed = run_source(spark, f"{root}/landed", f"{root}/tables", source, AT)
    assert not failed, failed
    return f"{root}/tables"


_COUNTS = {
    "entity_product": "SELECT count(*) AS n, max(p_partkey) + 1 AS m FROM part",
    "entity_productsection": "SELECT count(DISTINCT p_partkey) AS n, max(p_partkey) + 1 AS m FROM part",
    "entity_140": "SELECT count(*) AS n, max(o_orderkey) + 1 AS m FROM orders",
    "entity_31": "SELECT count(*) AS n, max(o_orderkey) + 1 AS m FROM orders",
    "entity_product_entity_140": """SELECT count(*) AS n, NULL AS m FROM lineitem WHERE l_orderkey IN
                                    (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P' AND o_totalprice > 0)""",
    "entity_deal": "SELECT count(*) AS n, max(o_orderkey) + 1 AS m FROM orders",
    "entity_contact": "SELECT count(*) AS n, max(c_custkey) + 1 AS m FROM customer",
    "entity_lead": "SELECT count(*) AS n, max(event_id) + 1 AS m FROM events",
    "entity_company": "SELECT count(*) AS n, max(s_suppkey) + 1 AS m FROM supplier",
}
_RUN_SQL = "\nUNION ALL ".join(
    [f"SELECT '{t}' AS table_name, CAST(n AS BIGINT) AS db_entry_count, CAST(m AS BIGINT) AS crm_entry_count FROM ({q})" for t, q in _COUNTS.items()]
    + ["SELECT 'entity_seg_' || c_mktsegment, CAST(count(*) AS INTEGER), CAST(max(c_custkey) + 1 AS INTEGER) FROM customer GROUP BY c_mktsegment"])


@query(_RUN_SQL)
def daily_run(spark, d):
    """The audit table of a run over landed pages of every kind."""
    return load_table(spark, _run(spark, d, False), SYNC_LOG).select("table_name", "db_entry_count", "crm_entry_count")


@query("""SELECT 'entity_product' AS table_name, CAST(p_partkey AS VARCHAR) AS id, p_brand AS cell FROM part
          UNION ALL SELECT 'entity_productsection', CAST(p_partkey AS VARCHAR), p_type FROM part
          UNION ALL SELECT 'entity_140', CAST(o_orderkey AS VARCHAR), CAST(CAST(o_orderdate AS DATE) AS VARCHAR) || ' 01:02:03' FROM orders
          UNION ALL SELECT 'entity_product_entity_140', CAST(l_orderkey AS VARCHAR), CAST(l_partkey AS VARCHAR) FROM lineitem
            WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P' AND o_totalprice > 0)
          UNION ALL SELECT 'entity_company', CAST(s_suppkey AS VARCHAR), CAST(s_suppkey AS VARCHAR) FROM supplier
          UNION ALL SELECT 'crm_deal_uf', CAST(c_custkey AS VARCHAR), c_name FROM customer
          UNION ALL SELECT 'entity_seg_' || c_mktsegment, CAST(c_custkey AS VARCHAR), c_name FROM customer""")
def daily_run_cells(spark, d):
    """The cells that a run with connector tables has stored, of a table of each kind."""
    root, out = _run(spark, d, True), None
    segments = [f"entity_seg_{r[0]}" for r in load(spark, d, "customer").select("c_mktsegment").distinct().collect()]
    cells = [("entity_product", "ID", "PROPERTY_5"), ("entity_productsection", "ID", "NAME"), ("entity_140", "id", "createdTime"),
             ("entity_product_entity_140", "ownerId", "productId"), ("entity_company", "ID", "UF_REL"), ("crm_deal_uf", S.TABLE_KEYS["crm_deal_uf"], "V"),
             *[(name, "ID", "PROPERTY_9") for name in segments]]
    for name, key, cell in cells:
        one = load_table(spark, root, name).select(F.lit(name).alias("table_name"), F.col(key).cast("string").alias("id"), F.col(cell).cast("string").alias("cell"))
        out = one if out is None else out.unionByName(one)
    return out


@query("SELECT * FROM deal_chain", "deal_chain")
def deals_from_buckets(spark, d):
    """The deal chain over bucketed copies, which needs no shuffle."""
    tables = crm_tables(spark, d)
    names = ["crm_deal", "crm_deal_uf", "entity_deal"]
    copies = snapshot_bucketed({n: tables[n] for n in names}, S.TABLE_KEYS, shuffle_width(spark),
                               f"_{uuid.uuid4().hex}", work_dir(spark, "buckets"))
    return M.entity_chain(copies, "deal")


@query("SELECT o_orderkey, coalesce(CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END, 0) AS total, o_orderpriority FROM orders")
def zero_filled(spark, d):
    o = load(spark, d, "orders")
    return zero_fill(o.select("o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("total"), "o_orderpriority"))
