"""Scalar functions and the cleaning recipes, on whole tables and whole texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from martloom import functions as fn
from martloom.functions.cleaning import clean_connector, clean_entity
from workload.registry import query
from workload.views import crm_deal, load

_STAMP = "'^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}\\+[0-9]{2}:[0-9]{2}$'"

# Order rows with cells as the CRM delivers them.
_RAW_SQL = """
SELECT o_orderkey AS id,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'non sélectionné' WHEN '2-HIGH' THEN '  '
            WHEN '3-MEDIUM' THEN chr(65279) || o_orderstatus WHEN '4-NOT SPECIFIED' THEN 'Non sélectionné'
            ELSE '' END AS label,
       CASE o_orderstatus WHEN 'P' THEN '-' ELSE '' END || CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR)
           || CASE o_orderpriority WHEN '5-LOW' THEN '|USD' ELSE '|EUR' END AS amount,
       CAST(CAST(o_orderdate AS DATE) AS VARCHAR) || CASE o_orderpriority WHEN '1-URGENT' THEN 'T10:11:12+03:00'
            WHEN '2-HIGH' THEN 'T10:11:12-03:00' WHEN '3-MEDIUM' THEN 'T25:11:12+03:00'
            WHEN '4-NOT SPECIFIED' THEN 'T10:11:12.5+03:00' ELSE 'T10:11:12Z' END AS created,
       CASE WHEN o_orderpriority = '5-LOW' THEN '0000-00-00 00:00:00' ELSE CAST(o_orderdate AS VARCHAR) END AS closed,
       o_totalprice > 100000 AS large,
       [o_orderstatus, CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END] AS tags
FROM orders"""


def raw_orders(spark, d):
    o = load(spark, d, "orders")
    priority, status = F.col("o_orderpriority"), F.col("o_orderstatus")

    def pick(*values):
        kinds = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED"]
        out = F.when(priority == kinds[0], values[0])
        for kind, value in zip(kinds[1:], values[1:]):
            out = out.when(priority == kind, value)
        return out.otherwise(values[4])

    return o.select(
        F.col("o_orderkey").alias("id"),
        pick(F.lit("non sélectionné"), F.lit("  "), F.concat(F.lit("\ufeff"), status), F.lit("Non sélectionné"),
             F.lit("")).alias("label"),
        F.concat(F.when(status == "P", "-").otherwise(""), F.col("o_totalprice").cast("decimal(18,2)").cast("string"),
                 F.when(priority == "5-LOW", "|USD").otherwise("|EUR")).alias("amount"),
        F.concat(F.col("o_orderdate").cast("date").cast("string"),
                 pick(*map(F.lit, ["T10:11:12+03:00", "T10:11:12-03:00", "T25:11:12+03:00", "T10:11:12.5+03:00",
                                   "T10:11:12Z"]))).alias("created"),
        F.when(priority == "5-LOW", "0000-00-00 00:00:00").otherwise(F.col("o_orderdate").cast("string")).alias("closed"),
        (F.col("o_totalprice") > 100000).alias("large"),
        F.array(status, F.when(priority != "5-LOW", priority)).alias("tags"),
    )


def raw(sql: str) -> str:
    """SQL over ``raw``, the order rows above."""
    return f"WITH raw AS ({_RAW_SQL})\n{sql}"


@query(raw("""SELECT id, nullif(label, 'non sélectionné') AS chosen,
                     CASE WHEN NOT regexp_full_match(label, '\\s*') THEN label END AS filled,
                     nullif(closed, '0000-00-00 00:00:00') AS closed_at FROM raw"""))
def blank_sentinel_null(spark, d):
    return raw_orders(spark, d).select(
        "id", fn.sentinel_to_null(F.col("label")).alias("chosen"), fn.blank_to_null(F.col("label")).alias("filled"),
        fn.zero_date_to_null(F.col("closed")).alias("closed_at"))


@query(raw("""SELECT id, CASE WHEN contains(amount, '|EUR') THEN regexp_replace(amount, '[^0-9.]', '', 'g')
                     ELSE amount END AS amount_text,
                     try_cast(CASE WHEN contains(amount, '|EUR') THEN regexp_replace(amount, '[^0-9.]', '', 'g')
                     ELSE amount END AS DECIMAL(18,2)) AS amount FROM raw"""))
def money_clean(spark, d):
    text = fn.money_text(F.col("amount"))
    return raw_orders(spark, d).select("id", text.alias("amount_text"), text.try_cast("decimal(18,2)").alias("amount"))


@query(raw(f"""SELECT id, CASE WHEN regexp_matches(created, {_STAMP}) THEN try_cast(created[1:19] AS TIMESTAMP) END AS local_at,
                      CASE WHEN regexp_matches(created, {_STAMP})
                           THEN strftime(try_cast(created[1:19] AS TIMESTAMP), '%Y-%m-%d %H:%M:%S')
                           ELSE created END AS local_text FROM raw"""))
def iso_timestamps(spark, d):
    return raw_orders(spark, d).select("id", fn.local_timestamp(F.col("created")).alias("local_at"),
                                       fn.local_timestamp_text(F.col("created")).alias("local_text"))


@query("""SELECT o_orderkey, CASE WHEN CAST(y AS INTEGER) BETWEEN 1677 AND 2262
                                  THEN CAST(y || substr(CAST(o_orderdate AS VARCHAR), 5) AS TIMESTAMP) END AS in_range
          FROM (SELECT *, CASE o_orderpriority WHEN '1-URGENT' THEN '1676' WHEN '2-HIGH' THEN '1677'
                               WHEN '3-MEDIUM' THEN '2262' WHEN '4-NOT SPECIFIED' THEN '2263'
                               ELSE CAST(year(o_orderdate) AS VARCHAR) END AS y
                FROM orders WHERE strftime(o_orderdate, '%m-%d') <> '02-29'
                UNION ALL SELECT *, CAST(year(o_orderdate) AS VARCHAR) FROM orders
                WHERE strftime(o_orderdate, '%m-%d') = '02-29')""")
def year_limits(spark, d):
    o, priority = load(spark, d, "orders"), F.col("o_orderpriority")
    year = (F.when(F.date_format("o_orderdate", "MM-dd") == "02-29", F.year("o_orderdate").cast("string"))
            .when(priority == "1-URGENT", "1676").when(priority == "2-HIGH", "1677").when(priority == "3-MEDIUM", "2262")
            .when(priority == "4-NOT SPECIFIED", "2263").otherwise(F.year("o_orderdate").cast("string")))
    moved = F.concat(year, F.substr(F.col("o_orderdate").cast("string"), F.lit(5)))
    return o.select("o_orderkey", fn.year_in_range(moved.cast("timestamp_ntz")).alias("in_range"))


@query(raw("""SELECT id, tags[1] || ', ' || coalesce(tags[2], 'None') AS joined,
                     '["' || tags[1] || '",' || coalesce('"' || tags[2] || '"', 'null') || ']' AS as_json FROM raw"""))
def list_join(spark, d):
    return raw_orders(spark, d).select("id", fn.join_list(F.col("tags")).alias("joined"),
                                       fn.json_list(F.col("tags")).alias("as_json"))


@query("SELECT doc_id, length(replace(t, chr(65279), '')) AS n, md5(replace(t, chr(65279), '')) AS digest"
       " FROM (SELECT doc_id, chr(65279) || replace(text, ' ', chr(65279) || ' ') AS t FROM documents)")
def bom_strip(spark, d):
    t = load(spark, d, "documents")
    marked = F.concat(F.lit("\ufeff"), F.replace("text", F.lit(" "), F.lit("\ufeff ")))
    clean = fn.strip_marks(marked)
    return t.select("doc_id", F.length(clean).cast("bigint").alias("n"), F.md5(clean).alias("digest"))


@query(raw("SELECT id, CAST(large AS INTEGER) AS large FROM raw"))
def bool_to_int(spark, d):
    return raw_orders(spark, d).select("id", fn.bool_to_int(F.col("large")).alias("large"))


@query("""SELECT p_partkey, regexp_replace(replace(n, ' ', '_'), '[^A-Za-z0-9_]', '', 'g') AS name
          FROM (SELECT p_partkey, p_name || ' (' || p_size || ') d''' || p_brand AS n FROM part)""")
def clean_names(spark, d):
    p = load(spark, d, "part")
    name = F.concat("p_name", F.lit(" ("), F.col("p_size").cast("string"), F.lit(") d'"), "p_brand")
    return p.select("p_partkey", fn.clean_name(name).alias("name"))


@query("""SELECT l_orderkey, l_linenumber, l_partkey,
                 CASE WHEN l_tax = 0 THEN NULL ELSE l_tax END AS tax, coalesce(CASE WHEN l_tax > 0 THEN l_tax END, 0) AS tax_or_zero,
                 coalesce(CASE WHEN l_returnflag <> 'N' THEN l_returnflag END, '') AS flag FROM lineitem""")
def null_conventions(spark, d):
    i = load(spark, d, "lineitem")
    tax = F.when(F.col("l_tax") == 0, F.lit(float("nan"))).otherwise(F.col("l_tax"))
    return i.select(
        "l_orderkey", "l_linenumber", "l_partkey", fn.nan_to_null(tax).alias("tax"),
        fn.zero_if_null(F.when(F.col("l_tax") > 0, F.col("l_tax"))).alias("tax_or_zero"),
        fn.null_to_empty(F.when(F.col("l_returnflag") != "N", F.col("l_returnflag"))).alias("flag"))


@query("""SELECT event_id, regexp_full_match(t, '-?[0-9]+') AS whole, try_cast(t AS BIGINT) AS id,
                 CASE WHEN try_cast(t AS HUGEINT) IS NOT NULL
                      THEN CAST(greatest(least(try_cast(t AS HUGEINT), 2147483647), -2147483648) AS INTEGER) END AS clamped,
                 CAST(nullif(regexp_extract(t, '^(-?[0-9]+)', 1), '') AS BIGINT) AS leading
          FROM (SELECT event_id, CASE event_type WHEN 'error' THEN 'X' || event_id WHEN 'view' THEN '-' || event_id || '000000'
                WHEN 'click' THEN event_id || '0000000' WHEN 'signup' THEN '' ELSE CAST(event_id AS VARCHAR) END AS t FROM events)""")
def integer_cells(spark, d):
    e, kind = load(spark, d, "events"), F.col("event_type")
    key = F.col("event_id").cast("string")
    text = (F.when(kind == "error", F.concat(F.lit("X"), key)).when(kind == "view", F.concat(F.lit("-"), key, F.lit("000000")))
            .when(kind == "click", F.concat(key, F.lit("0000000"))).when(kind == "signup", "").otherwise(key))
    t = F.col("t")
    return e.select("event_id", text.alias("t")).select(
        "event_id", fn.is_integer(t).alias("whole"), fn.to_id(t).alias("id"), fn.clamp_int(t).alias("clamped"),
        fn.first_id(t).alias("leading"))


@query("""SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_quantity AS DOUBLE) AS l_quantity,
                 CAST(l_suppkey AS DOUBLE) AS l_suppkey, l_returnflag FROM lineitem""")
def retyped_columns(spark, d):
    i = load(spark, d, "lineitem")
    new = [fn.retyped(F.col(c), i.schema[c].dataType).alias(c) for c in ("l_quantity", "l_suppkey", "l_returnflag")]
    return i.select("l_orderkey", "l_linenumber", "l_partkey", *new)


@query(raw("""SELECT id, try_cast(closed AS TIMESTAMP) AS closed_at,
                     regexp_full_match(created, '\\d{4}-\\d\\d-\\d\\dT\\d\\d:\\d\\d:\\d\\d(\\.\\d+)?(Z|[+-]\\d\\d:\\d\\d)') AS created_shape,
                     regexp_full_match(substr(closed, 1, 10), '\\d{4}-\\d\\d-\\d\\d') AS day_shape,
                     starts_with(amount, '0') AND length(amount) > 1 AS leading_zero,
                     try_cast(split_part(amount, '|', 1) AS DOUBLE) IS NOT NULL AS number FROM raw"""))
def value_tests(spark, d):
    return raw_orders(spark, d).select(
        "id", fn.to_datetime(F.col("closed")).alias("closed_at"), fn.has_date_shape(F.col("created")).alias("created_shape"),
        fn.has_date_shape(F.substring("closed", 1, 10)).alias("day_shape"),
        fn.has_leading_zero(F.col("amount")).alias("leading_zero"),
        fn.is_number(F.split_part("amount", F.lit("|"), F.lit(1))).alias("number"))


@query(raw(f"""SELECT id, nullif(CASE WHEN regexp_full_match(l, '\\s*') THEN NULL ELSE l END, 'non sélectionné') AS label,
                      CASE WHEN contains(amount, '|EUR') THEN regexp_replace(amount, '[^0-9.]', '', 'g') ELSE amount END AS amount,
                      CASE WHEN regexp_matches(created, {_STAMP}) THEN strftime(try_cast(created[1:19] AS TIMESTAMP), '%Y-%m-%d %H:%M:%S')
                           ELSE created END AS created,
                      closed, CAST(large AS INTEGER) AS large, tags[1] || ', ' || coalesce(tags[2], 'None') AS tags
               FROM (SELECT *, replace(label, chr(65279), '') AS l FROM raw)"""))
def clean_entity_rows(spark, d):
    return clean_entity(raw_orders(spark, d))


_CONNECTOR = raw("""SELECT id, {wrap}nullif(CASE WHEN regexp_full_match(label, '\\s*') THEN NULL ELSE label END, 'non sélectionné'){end} AS label,
                           amount, created, nullif(closed, '0000-00-00 00:00:00') AS closed, large,
                           tags[1] || ', ' || coalesce(tags[2], 'None') AS tags FROM raw""")


@query(_CONNECTOR.replace("{wrap}", "").replace("{end}", ""))
def clean_connector_rows(spark, d):
    return clean_connector(raw_orders(spark, d))


@query(_CONNECTOR.replace("{wrap}", "coalesce(").replace("{end}", ", '')"))
def clean_connector_empty(spark, d):
    return clean_connector(raw_orders(spark, d), empty_for_null=True)


@query("""SELECT p_partkey, p_name AS "PROPERTY_1", p_brand AS "PROPERTY_2", p_type AS "OTHER" FROM part""")
def unwrap_first_value(spark, d):
    from martloom.sources import unwrap_first

    p = load(spark, d, "part")
    return unwrap_first(p.select(
        "p_partkey", F.create_map(F.col("p_partkey").cast("string"), "p_name", F.lit("x"), "p_type").alias("PROPERTY_1"),
        F.to_json(F.create_map(F.col("p_partkey").cast("string"), "p_brand")).alias("PROPERTY_2"), F.col("p_type").alias("OTHER")))


@query("""SELECT event_id, json_extract_string(props, '$.k') AS "PROPERTY_1",
                 CASE WHEN event_type = 'view' THEN '{"id":"view"}' ELSE event_type END AS "PROPERTY_2",
                 CASE WHEN event_type = 'view' THEN 'plain' ELSE event_type END AS "PROPERTY_3" FROM events""")
def unwrap_value_key(spark, d):
    from martloom.sources import unwrap_key

    e, view = load(spark, d, "events"), F.col("event_type") == "view"
    return unwrap_key(e.select(
        "event_id", F.col("props").alias("PROPERTY_1"),
        F.when(view, F.create_map(F.lit("id"), "event_type")).otherwise(F.create_map(F.lit("k"), "event_type")).alias("PROPERTY_2"),
        F.when(view, "plain").otherwise(F.to_json(F.create_map(F.lit("k"), "event_type"))).alias("PROPERTY_3")), key="k")


@query("""SELECT b."ID", CASE WHEN b."LEAD_ID" = '' THEN NULL ELSE b."LEAD_ID" END AS "LEAD_ID",
                 regexp_replace(b."OPPORTUNITY_RAW", '[^0-9.]', '', 'g') AS "OPPORTUNITY_RAW",
                 strftime(CAST(b."CREATED_RAW"[1:19] AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS "CREATED_RAW"
          FROM crm_deal b""", "crm_deal")
def clean_entity_deals(spark, d):
    return clean_entity(crm_deal(spark, d).select("ID", "LEAD_ID", "OPPORTUNITY_RAW", "CREATED_RAW"))
