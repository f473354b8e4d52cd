"""Scans: landed pages and matrices, stored tables, catalogues."""

from __future__ import annotations

from pyspark.sql import functions as F

from martloom import sources as src
from martloom.functions.cleaning import clean_entity
from martloom.operators.columns import fields_of_type
from martloom.operators.loading import replace_table
from martloom.operators.ordering import top_page
from martloom.operators.quality import max_id
from martloom.session import work_dir
from martloom.sources.matrices import read_document
from workload.registry import query
from workload.views import load


def order_pages(spark, d):
    """A page per order with two records of it; orders in state P have a page without records."""
    o = load(spark, d, "orders")
    text = F.col("o_orderkey").cast("string")
    records = F.array(
        F.struct(text.alias("ID"), F.lit("status").alias("KIND"), F.col("o_orderstatus").alias("VALUE")),
        F.struct(text.alias("ID"), F.lit("priority").alias("KIND"), F.col("o_orderpriority").alias("VALUE")))
    result = F.when(F.col("o_orderstatus") != "P", records)
    page = F.to_json(F.struct(result.alias("result"), (F.col("o_orderkey") + 2).alias("total")))
    nested = F.to_json(F.struct(F.struct(result.alias("items")).alias("result"), (F.col("o_orderkey") + 2).alias("total")))
    return o.select("o_orderkey", "o_orderpriority", page.alias("page"), nested.alias("nested"))


_ENVELOPE = """SELECT CAST(o_orderkey AS VARCHAR) AS "ID", kind AS "KIND",
                      CASE kind WHEN 'status' THEN o_orderstatus ELSE o_orderpriority END AS "VALUE", o_orderkey + 2 AS total
               FROM orders JOIN (VALUES ('status'), ('priority')) k(kind) ON o_orderstatus <> 'P'"""


def _columns(rows):
    cells = [F.col("row")[c].alias(c) for c in ("ID", "KIND", "VALUE")]
    return rows.select(*cells, "total")


@query(_ENVELOPE)
def envelope_rows(spark, d):
    return _columns(src.read_envelope(order_pages(spark, d), "page"))


@query(_ENVELOPE)
def envelope_nested_rows(spark, d):
    return _columns(src.read_envelope(order_pages(spark, d), "nested", items="items"))


@query("""SELECT CAST(o_orderkey AS VARCHAR) AS "ID", kind AS "KIND",
                 CASE kind WHEN 'status' THEN o_orderstatus ELSE o_orderpriority END AS "VALUE"
          FROM orders JOIN (VALUES ('status'), ('priority')) k(kind) ON o_orderstatus <> 'P'""")
def envelope_fields_found(spark, d):
    rows = src.read_envelope(order_pages(spark, d), "page")
    return src.spread_map(rows, src.field_names(rows))


@query("""SELECT CAST(o_orderkey AS VARCHAR) AS "ID", o_orderstatus || ', ' || o_orderpriority AS "TAGS",
                 CASE WHEN o_totalprice > 100000 THEN '1' ELSE '0' END AS "LARGE", '[' || o_orderstatus || ']' AS "NOTE",
                 CAST(o_custkey AS VARCHAR) AS "OWNER" FROM orders""")
def typed_cells(spark, d):
    o = load(spark, d, "orders")
    record = F.struct(
        F.col("o_orderkey").alias("ID"), F.array("o_orderstatus", "o_orderpriority").alias("TAGS"),
        (F.col("o_totalprice") > 100000).alias("LARGE"), F.concat(F.lit("["), "o_orderstatus", F.lit("]")).alias("NOTE"),
        F.col("o_custkey").alias("OWNER"))
    pages = o.select(F.to_json(F.struct(F.array(record).alias("result"))).alias("page"))
    rows = src.read_envelope(pages, "page", row_schema=src.TYPED_ROWS)
    return clean_entity(src.spread_map(rows, ["ID", "TAGS", "LARGE", "NOTE", "OWNER"]))


@query("SELECT o_orderpriority, max(o_orderkey) + 2 AS n_source FROM orders GROUP BY o_orderpriority")
def declared_totals(spark, d):
    return src.page_totals(order_pages(spark, d), "page", "o_orderpriority")


def customer_matrices(spark, d):
    """A document per customer, the columns in either order, one of two segments without SEGMENT."""
    c = load(spark, d, "customer")
    key, name = F.col("c_custkey").cast("string"), F.col("c_name")
    full = F.array(F.array(F.lit("ID"), F.lit("NAME"), F.lit("SEGMENT")), F.array(key, name, F.col("c_mktsegment")),
                   F.array(key, F.lit(None).cast("string"), F.lit("again")))
    short = F.array(F.array(F.lit("NAME"), F.lit("ID")), F.array(name, key))
    return c.select(F.to_json(F.when(F.col("c_acctbal") < 0, short).otherwise(full), {"ignoreNullFields": "false"}).alias("doc"))


_MATRIX = """SELECT CAST(c_custkey AS VARCHAR) AS "ID", c_name AS "NAME",
                    CASE WHEN c_acctbal >= 0 THEN c_mktsegment END AS "SEGMENT" FROM customer
             UNION ALL SELECT CAST(c_custkey AS VARCHAR), NULL, 'again' FROM customer WHERE c_acctbal >= 0"""


@query(_MATRIX)
def matrix_rows(spark, d):
    return src.read_matrix(customer_matrices(spark, d), "doc", ["ID", "NAME", "SEGMENT"])


@query(_MATRIX)
def matrix_columns_found(spark, d):
    docs = customer_matrices(spark, d)
    return src.read_matrix(docs, "doc", src.matrix_columns(docs, "doc"))


@query("SELECT * FROM orders WHERE o_orderkey > 100 ORDER BY o_orderkey LIMIT 50")
def keyset_page(spark, d):
    return src.keyset_scan(load(spark, d, "orders"), "o_orderkey", 100, limit=50)


@query("""SELECT * FROM lineitem WHERE l_orderkey > (SELECT max(l_orderkey) // 4 FROM lineitem)
                                   AND l_orderkey <= (SELECT max(l_orderkey) // 4 * 3 FROM lineitem)""")
def keyset_rows(spark, d):
    """The middle half of the ids."""
    items = load(spark, d, "lineitem")
    quarter = max_id(items, "l_orderkey").first().max_id // 4
    return src.keyset_scan(items, "l_orderkey", quarter, upto=3 * quarter)


@query("SELECT * FROM orders ORDER BY o_orderkey LIMIT 50")
def first_page(spark, d):
    return top_page(load(spark, d, "orders"), "o_orderkey", 50)


@query("""SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 2 END AS page, o_orderpriority FROM orders""")
def dedupe_pages(spark, d):
    o = load(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    first = o.select("o_orderkey", F.when(F.col("o_orderstatus") == "F", 1).otherwise(2).alias("page"), "o_orderpriority")
    again = o.select("o_orderkey", F.lit(3).alias("page"), F.lit("repeated").alias("o_orderpriority"))
    return src.dedupe_pages(again.unionByName(first), "o_orderkey", "page")


@query("SELECT DISTINCT o_orderkey, o_custkey FROM orders")
def dedupe_pages_any(spark, d):
    o = load(spark, d, "orders").select("o_orderkey", "o_custkey")
    return src.dedupe_pages(o.unionByName(o), "o_orderkey")


@query("SELECT c_custkey FROM customer WHERE c_acctbal > 0")
def positive_ids(spark, d):
    return src.positive_ids(load(spark, d, "customer"), "c_custkey", "c_acctbal")


@query("""SELECT * FROM orders WHERE o_orderstatus = 'O' AND o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)""")
def owner_rows(spark, d):
    owners = src.positive_ids(load(spark, d, "customer"), "c_custkey", "c_acctbal")
    return src.rows_for_owners(load(spark, d, "orders"), owners, "o_custkey", "c_custkey", "o_orderstatus", "O")


@query("""SELECT * FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_totalprice > 0)""")
def product_rows_of_deals(spark, d):
    owners = src.positive_ids(load(spark, d, "orders"), "o_orderkey", "o_totalprice")
    return src.rows_for_owners(load(spark, d, "lineitem"), owners, "l_orderkey", "o_orderkey")


@query("""SELECT regexp_replace(replace(p_name, ' ', '_'), '[^A-Za-z0-9_]', '', 'g') AS name, max(p_partkey) AS list_id
          FROM part GROUP BY 1""")
def list_catalogue(spark, d):
    return src.list_catalogue(load(spark, d, "part"), "p_name", "p_partkey", "p_partkey")


@query("SELECT s_suppkey AS entity_type_id FROM supplier UNION ALL SELECT CAST(31 AS BIGINT)")
def entity_types(spark, d):
    return src.entity_type_ids(load(spark, d, "supplier"), "s_suppkey")


@query("SELECT p_name AS field, p_type AS type FROM part UNION ALL SELECT p_brand, 'brand' FROM part")
def field_catalogue(spark, d):
    p = load(spark, d, "part")
    fields = F.create_map("p_name", F.struct(F.col("p_type").alias("type")), "p_brand", F.struct(F.lit("brand").alias("type")))
    return src.field_catalogue(p.select(F.to_json(F.struct(fields.alias("result"))).alias("doc")), "doc")


@query("SELECT o_custkey, o_orderkey FROM orders")
def fields_of_type_columns(spark, d):
    """The catalogue here is derived from the orders: two of its fields are declared as relations."""
    o = load(spark, d, "orders")
    pair = (F.when(F.col("o_orderstatus") == "F", F.struct(F.lit("o_orderkey").alias("field"), F.lit("crm").alias("type")))
            .when(F.col("o_orderstatus") == "O", F.struct(F.lit("o_custkey").alias("field"), F.lit("iblock_element").alias("type")))
            .otherwise(F.struct(F.lit("o_totalprice").alias("field"), F.lit("double").alias("type"))))
    return o.select(*fields_of_type(o.select(pair.alias("f")).select("f.*")))


@query("SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, database_name FROM customer, (VALUES ('east'), ('west')) v(database_name)")
def stored_table(spark, d):
    """Two sources store the table; it is read for each of them and as a whole."""
    root = work_dir(spark, "stored")
    for database in ("east", "west"):
        path = src.table_path(root, "customer", database)
        assert not src.has_table(spark, path)
        replace_table(load(spark, d, "customer"), path)
        assert src.has_table(spark, path) and src.has_column(src.load_table(spark, root, "customer", database), "C_CUSTKEY")
    return src.load_sources(spark, root, "customer").select(*src.column_names(spark, path), "database_name")


@query("""SELECT CAST(c_custkey AS VARCHAR) AS "ID", c_name AS "NAME", CAST(c_acctbal AS VARCHAR) AS "BALANCE" FROM customer""")
def matrix_document(spark, d):
    """One matrix document per market segment, each a file that many tasks read; names hold brackets and quotes on the way."""
    folder, c = work_dir(spark, "documents"), load(spark, d, "customer")
    line = lambda at, text: F.struct(F.lit(at).alias("at"), text.alias("value"))
    cells = F.array(F.col("c_custkey").cast("string"), F.concat(F.lit('["'), "c_name", F.lit('"],[')), F.col("c_acctbal").cast("string"))
    body = c.select("c_mktsegment", F.col("c_custkey").alias("key"), line(1, F.concat(F.lit(","), F.to_json(cells))).alias("line"))
    ends = F.explode(F.array(line(0, F.lit('[["ID","NAME","BALANCE"]')), line(2, F.lit("]")))).alias("line")
    lines = body.unionByName(c.select("c_mktsegment").distinct().select("c_mktsegment", F.lit(0).cast("bigint").alias("key"), ends))
    lines = lines.repartition("c_mktsegment").sortWithinPartitions("c_mktsegment", "line.at", "key")
    lines.select("c_mktsegment", "line.value").write.partitionBy("c_mktsegment").text(folder)
    rows = read_document(spark, [folder])
    return rows.withColumn("NAME", F.replace(F.replace("NAME", F.lit('["'), F.lit("")), F.lit('"],['), F.lit("")))
