import pytest
from pyspark.sql import functions as F

from martloom import settings as S
from martloom.plans import marts as M
from tests.conftest import rows
from workload.views import crm_tables


@pytest.fixture(scope="module")
def tables(spark, sf_dir):
    return crm_tables(spark, sf_dir)


def test_the_list_is_complete():
    kinds = {e: [m.name for m in M.MARTS if m.entity == e] for e in M.ENTITIES}
    assert {e: len(n) for e, n in kinds.items()} == {"contact": 13, "deal": 6, "lead": 1, "company": 1}
    assert len({m.table for m in M.MARTS} | {M.ENRICHED_LEADS[1]}) == 22
    assert len(M.BY_NAME) == 21


@pytest.mark.parametrize("entity", M.ENTITIES)
def test_columns_are_distinct(tables, entity):
    names = [c.lower() for c in M.entity_chain(tables, entity).columns]
    assert len(names) == len(set(names))


def test_left_chain_keeps_every_contact_once(spark, tables):
    assert M.build_mart(tables, "contacts").count() == tables["crm_contact"].count()


def test_families_equal_the_single_marts(tables):
    chained = M.entity_chain(tables, "contact")
    family = M.contacts_by_roles(chained, tables["entity_deal"], S.DEAL_ROLES)
    for name in S.DEAL_ROLES:
        assert rows(family.where(F.col("mart") == name).drop("mart", "_slice")) == rows(M.build_mart(tables, name, ordered=False))
    flags = M.contacts_by_flags(chained)
    for name in S.CONTACT_FLAGS:
        assert rows(flags.where(F.col("mart") == name).drop("mart")) == rows(M.build_mart(tables, name, ordered=False))


def test_enriched_leads_keep_every_integer_lead_once(tables):
    out = M.enriched_leads(tables, tables["crm_lead"])
    expected = tables["crm_lead"].where(F.col("ID").rlike("^-?[0-9]+$"))
    assert out.count() == expected.count() == out.select("ID").distinct().count()


@pytest.mark.parametrize("clean, ranged", [(True, True), (False, False)])
def test_written_marts_equal_built_ones(spark, tables, tmp_path, clean, ranged):
    root = str(tmp_path)
    names = M.write_all(spark, tables, root, clean=clean, ranged=ranged)
    assert len(names) == 22
    used = M.clean_ids(tables) if clean else tables
    for name in ("contacts", "tutor", "payer_1", "recruiter", "deals_funding", "leads", "companies"):
        stored = M.read_mart(spark, root, name)
        built = M.build_mart(used, name, ordered=False)
        assert stored.columns == built.columns
        assert rows(stored) == rows(built), name
    stored = M.read_mart(spark, root, "Prospects_TC")
    assert rows(stored) == rows(M.enriched_leads(tables))


def test_marts_come_in_order(tables):
    ids = [r.ID for r in M.build_mart(tables, "deals").select("ID").collect()]
    assert ids == sorted(ids)
    keys = [r.CONTACT_ID for r in M.build_mart(tables, "accountant").select("CONTACT_ID").collect()]
    assert keys == sorted(keys, key=lambda k: (k is not None, k))


def test_read_tables(spark, tables, tmp_path):
    for name in M.TABLES:
        tables[name].write.parquet(f"{tmp_path}/{name}_transform/database_name=main")
    back = M.read_tables(spark, str(tmp_path), "main", "_transform")
    assert set(back) == set(M.TABLES)
    assert M.build_mart(back, "companies").count() == M.build_mart(tables, "companies").count()
