"""CRM tables derived from the given ones.

Every view reads the whole of its tables. Joins miss where the tables themselves differ: few
customers have events, some orders have no line items, few leads have a document and few
companies are a supplier.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType


_SCHEMAS: dict[str, StructType] = {}


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; its schema is read from the file once per process."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def crm_contact(spark, d):
    c = load(spark, d, "customer")
    return c.select(
        F.col("c_custkey").alias("ID"), F.col("c_name").alias("NAME"),
        F.concat(F.lower(F.replace("c_name", F.lit("#"), F.lit("."))), F.lit("@x.example")).alias("EMAIL"),
        F.col("c_mktsegment").alias("SOURCE_DESCRIPTION"),
    )


def crm_contact_uf(spark, d):
    def flag(kind):
        return F.max(F.when((F.col("event_type") == kind) & (F.col("value") > 150), F.col("event_id")))

    e = load(spark, d, "events")
    return e.groupBy(F.col("user_id").alias("CONTACT_ID")).agg(
        F.max("event_type").alias("NAME"), flag("error").alias("UF_CRM_1643183509"),
        flag("click").alias("UF_CRM_1606994316"), flag("view").alias("UF_CRM_1606994331"),
        flag("purchase").alias("UF_CRM_1604401780"), flag("signup").alias("UF_CRM_1604401811"),
    )


def entity_contact(spark, d):
    o = load(spark, d, "orders")
    return o.groupBy(F.col("o_custkey").alias("entity_contact_ID")).agg(
        F.max("o_orderkey").alias("sql_LAST_DEAL"), F.max("o_orderstatus").alias("SOURCE_DESCRIPTION"))


def crm_deal(spark, d):
    o = load(spark, d, "orders")
    priority, status = F.col("o_orderpriority"), F.col("o_orderstatus")
    category = (F.when(priority == "1-URGENT", "8").when(priority == "2-HIGH", "4")
                .when(priority == "3-MEDIUM", "10").when(priority == "4-NOT SPECIFIED", "42").otherwise("20"))
    lead = (F.when(priority == "5-LOW", "").when(status == "P", F.concat(F.lit("L"), F.col("o_orderkey")))
            .otherwise(F.col("o_custkey").cast("string")))
    return o.select(
        F.col("o_orderkey").alias("ID"), category.alias("CATEGORY_ID"), lead.alias("LEAD_ID"),
        status.alias("SOURCE_NAME"), priority.alias("SOURCE_DESCRIPTION"),
        F.concat(F.col("o_totalprice").cast("decimal(18,2)").cast("string"), F.lit("|EUR")).alias("OPPORTUNITY_RAW"),
        F.concat(F.col("o_orderdate").cast("date").cast("string"), F.lit("T10:11:12+03:00")).alias("CREATED_RAW"),
    )


def crm_deal_uf_raw(spark, d):
    i = load(spark, d, "lineitem")
    return i.groupBy(F.col("l_orderkey").alias("DEAL_ID")).agg(
        F.max("l_returnflag").alias("SOURCE_NAME"),
        F.sum("l_quantity").cast("bigint").cast("string").alias("UF_CRM_5E5634910DD58"),
        F.max("l_linenumber").cast("string").alias("UF_CRM_1591275382"),
        F.count(F.lit(1)).cast("string").alias("UF_CRM_5FA697664B231"),
        F.min("l_suppkey").cast("string").alias("UF_CRM_6341774C87D94"),
        F.min("l_linenumber").cast("string").alias("UF_CRM_1611039011"),
        F.min("l_partkey").cast("string").alias("UF_CRM_1691245430"),
    )


def crm_deal_uf(spark, d):
    return crm_deal_uf_raw(spark, d).drop("UF_CRM_1611039011", "UF_CRM_1691245430")


def entity_deal(spark, d):
    o = load(spark, d, "orders")
    cust = F.col("o_custkey").cast("string")
    return o.select(
        F.col("o_orderkey").alias("entity_deal_ID"), cust.alias("sql_UF_CRM_1589207602"),
        F.concat(cust, F.lit(", "), F.floor(F.col("o_orderkey") / 10).cast("string")).alias("sql_UF_CRM_1588240383"),
        F.when(F.col("o_orderstatus") != "P", cust).alias("sql_UF_CRM_1602495367"),
        F.when(F.col("o_orderpriority") == "2-HIGH", "").otherwise(cust).alias("sql_UF_CRM_1591262278"),
    )


def _lead_id():
    text = F.col("event_id").cast("string")
    return F.when(F.col("event_type") == "error", F.concat(F.lit("X"), text)).otherwise(text)


def crm_lead(spark, d):
    e = load(spark, d, "events")
    user, kind = F.col("user_id").cast("string"), F.col("event_type")
    contact = F.when(kind == "view", "").when(kind == "click", F.concat(F.lit("C"), user)).otherwise(user)
    return e.select(_lead_id().alias("ID"), contact.alias("CONTACT_ID"), kind.alias("SOURCE_ID"))


def crm_lead_uf(spark, d):
    t = load(spark, d, "documents")
    text = F.col("doc_id").cast("string")
    return t.select(
        F.when(F.col("lang") == "fr", F.concat(F.lit("X"), text)).otherwise(text).alias("LEAD_ID"),
        F.col("source").alias("SOURCE_ID"), F.col("lang").alias("UF_LANG"), F.col("n_chars").alias("UF_SIZE"),
    )


def entity_lead(spark, d):
    e = load(spark, d, "events")
    return e.select(_lead_id().alias("entity_lead_ID"), F.col("user_id").alias("sql_USER"))


def crm_company(spark, d):
    return load(spark, d, "part").select(F.col("p_partkey").alias("ID"), F.col("p_name").alias("TITLE"),
                                         F.col("p_brand").alias("BRAND"))


def crm_company_uf(spark, d):
    i = load(spark, d, "lineitem")
    return i.groupBy(F.col("l_partkey").alias("COMPANY_ID")).agg(
        F.max("l_returnflag").alias("TITLE"), F.count(F.lit(1)).alias("UF_ORDERS"))


def entity_company(spark, d):
    s = load(spark, d, "supplier")
    key = F.col("s_suppkey").cast("string")
    return s.select(
        F.col("s_suppkey").alias("entity_company_ID"), key.alias("sql_UF_CRM_1589375441"),
        F.col("s_nationkey").cast("string").alias("sql_UF_CRM_1589375694"),
        F.when(F.col("s_acctbal") < 0, "").otherwise(key).alias("sql_UF_CRM_1589355778"),
    )


VIEWS = {f.__name__: f for f in (
    crm_contact, crm_contact_uf, entity_contact, crm_deal, crm_deal_uf, entity_deal,
    crm_lead, crm_lead_uf, entity_lead, crm_company, crm_company_uf, entity_company,
)}


class CrmTables(Mapping):
    """The twelve CRM tables by name, each set up when it is asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self._spark, self._sf_dir = spark, sf_dir
        self._made: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            self._made[name] = VIEWS[name](self._spark, self._sf_dir)
        return self._made[name]

    def __iter__(self) -> Iterator[str]:
        return iter(VIEWS)

    def __len__(self) -> int:
        return len(VIEWS)


def crm_tables(spark: SparkSession, sf_dir: str) -> CrmTables:
    return CrmTables(spark, sf_dir)
