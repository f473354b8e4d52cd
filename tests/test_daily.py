import json
from datetime import datetime

from pyspark.sql import functions as F

from martloom import settings as S
from martloom.operators.loading import SYNC_LOG
from martloom.plans import marts
from martloom.plans.daily import Source, daily_jobs, run_source
from martloom.sources import load_table
from tests.conftest import rows

AT = datetime(2024, 5, 6, 23, 30)


def land(folder, name, *docs):
    path = folder / "main" / name
    path.mkdir(parents=True, exist_ok=True)
    (path / "page.json").write_text("\n".join(json.dumps(d) for d in docs) + "\n")


def test_a_whole_run(spark, tmp_path):
    landing, root = tmp_path / "landing", str(tmp_path / "tables")
    land(landing, "product", {"result": [{"ID": "1", "PROPERTY_5": {"value": "red", "valueId": 3}}], "total": 1})
    land(landing, "productsection", {"result": [{"ID": "1", "NAME": "a"}]}, {"result": [{"ID": "1", "NAME": "a"}, {"ID": "2", "NAME": "b"}], "total": 2})
    land(landing, "lists", {"result": [{"ID": "20", "NAME": "Villes (2)"}, {"ID": "21", "NAME": "Motifs d'arrêt"}]})
    land(landing, "list/20", {"result": [{"ID": "7", "PROPERTY_9": {"88": "Nord"}}], "total": 1})
    land(landing, "list/21", {"result": [], "total": 0})
    land(landing, "types", {"result": {"types": [{"entityTypeId": 140}, {"entityTypeId": 160}]}})
    land(landing, "item/140", {"result": {"items": [{"id": 1, "opportunity": 5, "at": "2024-05-06T10:11:12+03:00"}, {"id": 2, "opportunity": 0}]}, "total": 2})
    # 160 has not landed
    land(landing, "item/31", {"result": {"items": [{"id": 4, "title": "t", "other": "x"}]}, "total": 1})
    land(landing, "productrow", {"result": {"productRows": [
        {"id": 1, "ownerId": 1, "ownerType": "T8c"}, {"id": 2, "ownerId": 1, "ownerType": "T8c"},
        {"id": 3, "ownerId": 2, "ownerType": "T8c"}, {"id": 4, "ownerId": 1, "ownerType": "Ta0"}]}})
    for entity in S.RECREATED:
        land(landing, f"fields/{entity}", {"result": {"COMPANY_ID": {"type": "crm_company"}, "UF_A": {"type": "crm"}, "TITLE": {"type": "string"}}})
        land(landing, entity, {"result": [{"ID": "1", "UF_A": "[12]", "TITLE": "t"}, {"ID": "2", "UF_A": " "}], "total": 3})
    for table in S.CONNECTOR_TABLES:
        land(landing, f"connector/{table}", [[S.TABLE_KEYS[table], "V"], ["1", "v"], ["2", "non sélectionné"]])

    source = Source("main", product_sections=True, product_rows={"entity_140": "T8c"}, invoice_columns=S.INVOICE_COLUMNS)
    assert run_source(spark, str(landing), root, source, AT) == ["entity_160"]

    def stored(name):
        return load_table(spark, root, name)

    assert rows(stored("entity_product")) == [("1", "red")]
    assert rows(stored("entity_productsection")) == [("1", "a"), ("2", "b")]
    assert rows(stored("entity_Villes_2")) == [("7", "Nord")]
    assert rows(stored("entity_140")) == [(None, "2", "0"), (datetime(2024, 5, 6, 10, 11, 12), "1", "5")]
    assert stored("entity_31").columns == ["id", "title"]
    assert rows(stored("entity_product_entity_140").select("id")) == [("1",), ("2",)]
    assert stored("entity_deal").columns == ["ID", "UF_A"]
    assert rows(stored("entity_deal")) == [("1", "[12]"), ("2", None)]
    assert rows(stored("crm_lead")) == [("1", "v"), ("2", None)]
    log = {r.table_name: (r.db_entry_count, r.crm_entry_count, r.error_message is None) for r in stored(SYNC_LOG).collect()}
    assert log["entity_deal"] == (2, 3, True)
    assert log["entity_productsection"] == (2, 2, True)
    assert log["entity_160"] == (0, None, False)
    assert "entity_Motifs_darrêt" not in log and "crm_lead" not in log
    assert [name for name, _ in daily_jobs(spark, str(landing), root, source, AT)][:2] == ["entity_product", "entity_productsection"]


def test_from_landed_pages_to_marts(spark, tmp_path):
    landing, root, out = tmp_path / "landing", str(tmp_path / "tables"), str(tmp_path / "marts")
    land(landing, "lists", {"result": []})
    land(landing, "types", {"result": {"types": []}})
    relation = {"deal": S.DEAL_ROLES["tutor"], "company": S.COMPANY_ROLES["director"], "contact": "sql_UF_X", "lead": "sql_UF_X"}
    for entity in S.RECREATED:
        field = relation[entity].removeprefix("sql_")
        land(landing, f"fields/{entity}", {"result": {field: {"type": "crm"}}})
        land(landing, entity, {"result": [{"ID": "1", field: "2"}, {"ID": "2", field: ["2", "1"]}, {"ID": "3", field: ""}]})
    flag = S.CONTACT_FLAGS["payer_1"]
    docs = {
        "crm_contact": [["ID", "EMAIL", "SOURCE_DESCRIPTION"], ["1", "a@x.example", "s1"], ["2", "b@x.example", "s2"], ["x", "c@x.example", "s3"]],
        "crm_contact_uf": [["CONTACT_ID", "EMAIL", *S.CONTACT_FLAGS.values()], ["2", "dropped", *("yes" if f == flag else "" for f in S.CONTACT_FLAGS.values())]],
        "crm_deal": [["ID", "CATEGORY_ID", "LEAD_ID", "SOURCE_NAME", "SOURCE_DESCRIPTION"], ["1", "8", "5", "web", "late"], ["2", "42", "L5", "web", None], ["10", "8", "5", "fair", None]],
        "crm_deal_uf": [["DEAL_ID", "UF_CRM_5E5634910DD58", "UF_CRM_1591275382", "UF_CRM_5FA697664B231", "UF_CRM_6341774C87D94"], ["1", "u", None, None, None]],
        "crm_lead": [["ID", "CONTACT_ID"], ["5", "2"], ["6", ""], ["X7", "1"]],
        "crm_lead_uf": [["LEAD_ID", "UF_L"], ["5", "l"], ["6", "l"], ["X7", "l"]],
        "crm_company": [["ID", "TITLE"], ["1", "c"]],
        "crm_company_uf": [["COMPANY_ID", "TITLE"], ["1", "dropped"]],
    }
    for table, doc in docs.items():
        land(landing, f"connector/{table}", doc)
    # relation rows of the leads use the leads' ids
    land(landing, "lead", {"result": [{"ID": "5", "UF_X": "1"}, {"ID": "6", "UF_X": "1"}]})
    failed = run_source(spark, str(landing), root, Source("main"), AT)
    assert sorted(failed) == ["entity_31", "entity_product"]  # they have not landed

    tables = marts.read_tables(spark, root)
    assert tables["entity_deal"].columns == ["entity_deal_ID", S.DEAL_ROLES["tutor"]]
    needed = {c: F.lit(None).cast("string") for c in S.DEAL_ROLES.values() if c not in tables["entity_deal"].columns}
    tables["entity_deal"] = tables["entity_deal"].withColumns(needed)
    needed = {c: F.lit(None).cast("string") for c in S.COMPANY_ROLES.values() if c not in tables["entity_company"].columns}
    tables["entity_company"] = tables["entity_company"].withColumns(needed)
    marts.write_all(spark, tables, out)

    def mart(name, *columns):
        return rows(marts.read_mart(spark, out, name).select(*columns))

    assert mart("contacts", "ID", "EMAIL", "CONTACT_ID") == [(1, "a@x.example", None), (2, "b@x.example", "2")]
    assert mart("payer_1", "ID") == [(2,)]
    assert mart("tutor", "ID") == [(2,), (2,)]
    assert mart("deals_apprentice", "ID") == [("1",), ("10",)]
    assert mart("companies", "ID", "TITLE") == [("1", "c")]
    assert mart("leads_enriched", "ID", "Contacts_EMAIL", "Transactions_SOURCE_NAME", "UF_CRM_5E5634910DD58") == [
        (5, "b@x.example", "web", "u"), (6, None, None, None)]
