"""What the physical plans look like."""

import pytest
from pyspark.sql import functions as F

from martloom import settings as S
from martloom import sources as src
from martloom.operators import joins as J
from martloom.operators.loading import snapshot_bucketed
from martloom.plans import marts as M
from workload import ORACLE, QUERIES
from workload.views import crm_tables, load

# these run jobs of their own while they are built
_WRITES = {n for n, q in QUERIES.items() if "work_dir" in q.__code__.co_names} | {"snapshot_counts", "daily_run", "daily_run_cells", "keyset_rows"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


def test_no_python_in_any_plan_and_no_products(spark, sf_dir):
    for name, query in QUERIES.items():
        if name in _WRITES:
            continue
        text = plan(query(spark, sf_dir))
        for node in ("PythonUDF", "ArrowEvalPython", "BatchEvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert node not in text, f"{node} in {name}"


def test_flag_filter_turns_left_joins_into_inner(spark, sf_dir, no_broadcast):
    text = plan(M.build_mart(crm_tables(spark, sf_dir), "emergency_contact"))
    assert "SortMergeJoin [ID" in text and ", Inner" in text
    family = plan(M.contacts_by_flags(M.entity_chain(crm_tables(spark, sf_dir), "contact")))
    assert ", Inner" in family


def test_chain_shuffles_each_table_once(spark, sf_dir, no_broadcast):
    text = plan(M.build_mart(crm_tables(spark, sf_dir), "contacts", ordered=False))
    assert text.count("Exchange hashpartitioning") == 3


def test_bucketed_tables_are_not_shuffled(spark, sf_dir, tmp_path, no_broadcast):
    tables = crm_tables(spark, sf_dir)
    names = ["crm_deal", "crm_deal_uf", "entity_deal"]
    for name in names:
        spark.sql(f"drop table if exists {name}_test")
    copies = snapshot_bucketed({n: tables[n] for n in names}, S.TABLE_KEYS, 4, "_test", str(tmp_path))
    try:
        text = plan(M.entity_chain(copies, "deal"))
        assert "SortMergeJoin" in text and "Exchange" not in text
        assert len(list((tmp_path / "crm_deal_test").glob("*.parquet"))) <= 4
    finally:
        for name in names:
            spark.sql(f"drop table if exists {name}_test")


def test_first_match_is_decided_before_the_shuffle(spark, sf_dir, no_broadcast):
    deals = crm_tables(spark, sf_dir)["crm_deal"]
    text = plan(J.one_per_key(deals, "LEAD_ID", ["ID"]))
    assert "row_number(), 1, Partial" in text
    assert text.index("Exchange") < text.index("Partial")


def test_relation_is_counted_before_the_shuffle(spark, sf_dir, no_broadcast):
    text = plan(J.role_counts(crm_tables(spark, sf_dir)["entity_deal"], {"x": "sql_UF_CRM_1589207602"}))
    assert "partial_count" in text


def test_roles_of_one_relation_take_one_join(spark, sf_dir, no_broadcast):
    tables = crm_tables(spark, sf_dir)
    roles = {"a": "sql_UF_CRM_1589207602", "b": "sql_UF_CRM_1602495367"}
    text = plan(J.rows_by_roles(tables["crm_contact"], tables["entity_deal"], roles))
    assert text.count("SortMergeJoin") == 1


def test_enrichment_joins_deals_without_another_shuffle_of_the_leads(spark, sf_dir, no_broadcast):
    tables = crm_tables(spark, sf_dir)
    text = plan(M.enriched_leads(tables))
    # lead, lead_uf, entity_lead; deal and deal_uf by deal, deals by lead; leads and contacts by contact
    assert text.count("Exchange hashpartitioning") == 8


def test_keyset_bounds_and_columns_reach_the_scan(spark, sf_dir):
    df = src.keyset_scan(load(spark, sf_dir, "orders"), "o_orderkey", 10, upto=20).select("o_orderkey", "o_custkey")
    text = plan(df)
    assert "GreaterThan(o_orderkey,10)" in text and "LessThanOrEqual(o_orderkey,20)" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in text


def test_measure_filter_reaches_the_scan(spark, sf_dir):
    text = plan(src.positive_ids(load(spark, sf_dir, "customer"), "c_custkey", "c_acctbal"))
    assert "GreaterThan(c_acctbal,0.0)" in text


def test_owner_rows_use_plain_shuffles_that_adaptive_skew_handling_can_split(spark, sf_dir, no_broadcast):
    owners = src.positive_ids(load(spark, sf_dir, "orders"), "o_orderkey", "o_totalprice")
    text = plan(src.rows_for_owners(load(spark, sf_dir, "lineitem"), owners, "l_orderkey", "o_orderkey"))
    assert "LeftSemi" in text and text.count("Exchange hashpartitioning") == 2 and "Aggregate" not in text


def test_reconcile_reads_no_columns(spark, sf_dir):
    text = plan(load(spark, sf_dir, "lineitem").agg(F.count(F.lit(1))))
    assert "ReadSchema: struct<>" in text


def test_copies_of_role_marts_are_not_shuffled(spark, sf_dir, no_broadcast):
    # the plan reads from the result down: nothing is exchanged above the copies, sorted or not
    text = plan(M.build_mart(crm_tables(spark, sf_dir), "tutor"))
    copies = text.index("Generate explode(array_repeat")
    assert "Exchange" not in text[:copies] and "rangepartitioning" in text[copies:]
    chained = M.entity_chain(crm_tables(spark, sf_dir), "contact")
    family = plan(M.contacts_by_roles(chained, crm_tables(spark, sf_dir)["entity_deal"], S.DEAL_ROLES))
    copies = family.index("Generate explode(array_repeat")
    assert "Exchange" not in family[:copies] and family.index("Union") > copies
