"""Versions, id bitmaps, schema history, marts kept up to date, missing pages."""

import json
import os

import pytest
from pyspark.sql import functions as F

from martloom import settings as S
from martloom.functions import whole_characters
from martloom.operators import gaps, loading
from martloom.plans import marts as M
from martloom.plans import upkeep
from martloom.plans.refresh import refresh_connector, refresh_entity
from martloom.sources import history, load_table, read_stored, read_version, table_path, version
from martloom.sources import versions as V
from martloom.sources.pages import LANDED, landing_order
from martloom.streaming import arrivals
from tests.conftest import rows
from tests.test_operators import AT, landed
from workload.views import VIEWS


def files(folder):
    return {os.path.join(d, f) for d, _, names in os.walk(folder) for f in names if f.endswith(".parquet")}


def test_a_load_that_stops_before_its_manifest_changes_nothing(spark, tmp_path, monkeypatch):
    path = table_path(str(tmp_path), "t")
    loading.replace_table(spark.range(3), path)
    opened = read_stored(spark, path)

    def stopped(*_):
        raise RuntimeError("lost before the manifest")

    monkeypatch.setattr(V, "publish", stopped)
    with pytest.raises(RuntimeError):
        loading.replace_table(spark.range(9), path)
    monkeypatch.undo()
    assert read_stored(spark, path).count() == 3 and len(files(path)) > version(spark, path).rows
    loading.replace_table(spark.range(7), path)
    # a reader keeps the version it has opened
    assert opened.count() == 3 and read_stored(spark, path).count() == 7 and V.numbers(spark, path) == [1, 2]


def test_a_manifest_that_is_being_written_is_passed_over_and_a_taken_number_fails(spark, tmp_path):
    path = table_path(str(tmp_path), "t")
    loading.replace_table(spark.range(3), path)
    half = tmp_path / "t" / "database_name=main" / "_versions" / "000000000002.json"
    half.write_text((half.parent / "000000000001.json").read_text()[:-5])
    assert version(spark, path).number == 1 and read_stored(spark, path).count() == 3
    with pytest.raises(Exception, match="exist"):
        loading.replace_table(spark.range(1), path)


def test_a_snapshot_moves_no_rows_and_outlives_later_loads(spark, tmp_path):
    root = str(tmp_path)
    path = table_path(root, "t")
    loading.replace_table(spark.range(3), path, id_col="id")
    before = files(root)
    loading.snapshot(spark, root, ["t"])
    assert files(root) == before
    loading.replace_table(spark.range(8), path)
    loading.replace_table(spark.range(9), path)
    assert load_table(spark, root, "t_transform").count() == 3
    assert version(spark, table_path(root, "t_transform")).ids.distinct == 3
    loading.append_new(spark.range(5), table_path(root, "t_transform"), "id")
    assert load_table(spark, root, "t_transform").count() == 5
    # version 2 of t goes, what the snapshot names stays
    assert V.expire(spark, root, keep=1) > 0
    assert load_table(spark, root, "t_transform").count() == 5 and load_table(spark, root, "t").count() == 9
    with pytest.raises(ValueError):
        read_version(spark, path, 1)


def test_plain_folders_are_taken_over(spark, tmp_path):
    path = str(tmp_path / "plain")
    spark.range(4).write.parquet(path)
    assert version(spark, path).number == 0 and read_stored(spark, path).count() == 4
    loading.append_new(spark.range(2, 6), path, "id")
    assert rows(read_stored(spark, path)) == [(i,) for i in range(6)]


def test_interleaved_ids_are_looked_up_in_bitmaps(spark, tmp_path):
    path = str(tmp_path / "t")
    loading.append_new(spark.range(0, 200_000, 2).toDF("k"), path, "k")
    stored = files(path)
    batch = spark.range(-5, 100_001).toDF("k")
    found = version(spark, path)
    opened = loading.unseen(batch, path, "k", found).inputFiles()
    assert opened and all("/_ids/" in f for f in opened)
    loading.append_new(batch, path, "k")
    assert stored < files(path)
    made = read_stored(spark, path)
    assert made.count() == made.distinct().count() == 5 + 50_000 + 100_000
    assert loading.append_new(batch, path, "k") is None
    assert rows(loading.distinct_stored_ids(spark, path, "k")) == [(150_005, 150_005, 0)]
    loading.replace_table(made.union(spark.createDataFrame([(7,), (7,), (-3,), (None,)], "k long")), path, id_col="k")
    assert rows(loading.distinct_stored_ids(spark, path, "k")) == [(150_008, 150_005, 3)]
    assert rows(loading.repeated_stored_ids(spark, path)) == [(-3, 2), (7, 3)]
    assert version(spark, path).ids.odd == 1


def test_ids_that_are_no_integers_are_compared_as_text(spark, tmp_path):
    path = str(tmp_path / "t")
    make = lambda *ids: spark.createDataFrame([(i,) for i in ids], "k string")
    loading.append_new(make("1", "X1", "2", "9999999999999999999"), path, "k")
    loading.append_new(make("X1", "3", "X2", "2", "9999999999999999999"), path, "k")
    assert rows(read_stored(spark, path)) == [("1",), ("2",), ("3",), ("9999999999999999999",), ("X1",), ("X2",)]


def test_values_that_do_not_fit_are_counted(spark, tmp_path):
    path = table_path(str(tmp_path), "t")
    loading.full_refresh(spark.createDataFrame([(1, 5)], "ID int, n int"), path)
    made = loading.load_if_nonempty(spark.createDataFrame([("1", "x", "new"), ("2", "7", None), ("2", None, None)], "ID string, n string, more string"), path, id_col="ID")
    assert made.nulled == {"ID": 0, "n": 1} and loading.key_faults(made) == "1 rows repeat an ID; 1 values of n do not fit its type"
    assert rows(history(spark, path)) == [
        (1, "refresh", 1, "ID", "int", 0), (1, "refresh", 1, "n", "int", 0),
        (2, "refresh", 3, "ID", "int", 0), (2, "refresh", 3, "more", "string", 0), (2, "refresh", 3, "n", "int", 1)]


def test_faulty_keys_are_in_the_audit(spark, tmp_path):
    root = str(tmp_path)
    pages = landed(spark, '{"result": [{"ID": "1"}, {"ID": "1"}, {"ID": "x"}]}')
    assert refresh_entity(pages, root, "deal", AT, fields=["ID"], recreate=True)
    assert refresh_connector(landed(spark, '[["ID", "V"], ["1", "v"], ["1", "w"]]'), root, "crm_lead", at=AT)
    log = {r.table_name: r.error_message for r in load_table(spark, root, loading.SYNC_LOG).collect()}
    assert log == {"entity_deal": "1 rows without an integer ID; 1 rows repeat an ID", "crm_lead": "1 rows repeat an ID"}
    assert load_table(spark, root, "entity_deal").count() == 3


def test_a_torn_page_stops_the_recreated_tables_too(spark, tmp_path):
    root = str(tmp_path)
    good = landed(spark, '{"result": [{"ID": "1"}, {"ID": "2"}], "total": "4"}', '{"result": [{"ID": "3"}, {"ID": "4"}]}')
    assert refresh_entity(good, root, "deal", AT, fields=["ID"], recreate=True)
    torn = landed(spark, '{"result": [{"ID": "1"}, {"ID": "2"}], "total": 4}', '{"result": [{"ID": "3"}, {"I')
    with pytest.raises(ValueError, match="1 landed pages"):
        refresh_entity(torn, root, "deal", AT, fields=["ID"], recreate=True)
    assert load_table(spark, root, "entity_deal").count() == 4
    assert rows(load_table(spark, root, loading.SYNC_LOG).select("db_entry_count", "crm_entry_count")) == [(4, 4)]


def test_a_torn_page_of_a_stream_is_set_aside(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.json").write_text('{"result": [{"ID": "1", "V": "x"}]}\n{"result": [{"ID": "2"\n\n')
    args = (spark, str(folder), str(tmp_path / "t"), str(tmp_path / "c"), ["ID", "V"])
    assert arrivals.stream_new_rows(*args) == 1
    (folder / "b.json").write_text('{"result": [{"ID": "1", "V": "late"}, {"ID": "2", "V": "y"}]}\n')
    assert arrivals.stream_new_rows(*args) == 0
    assert rows(read_stored(spark, str(tmp_path / "t"))) == [("1", "x"), ("2", "y")]
    bad = spark.read.json(str(tmp_path / "t" / "_quarantine" / "*")).collect()
    assert [(r.value, r.file.rpartition("/")[2]) for r in bad] == [('{"result": [{"ID": "2"', "a.json")]


def test_pages_count_in_the_order_in_which_they_landed(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    page = lambda v, more: json.dumps({"result": [{"ID": "1", "V": v}, {"ID": "1", "V": "twice"}], "pad": "x" * more})
    # later pages are larger, so Spark takes them first; 10 comes after 9
    for number, more in ((2, 10), (9, 3000), (10, 90_000)):
        (folder / f"page-{number}.json").write_text(page(f"p{number}", more) + "\n" + page("second line", 5) + "\n")
    pages = spark.read.text(str(folder)).select("value", landing_order().alias(LANDED))
    assert refresh_entity(pages, str(tmp_path / "r"), "x", AT, once_by="ID")
    assert rows(load_table(spark, str(tmp_path / "r"), "entity_x")) == [("1", "p2")]
    order = [r.name.rpartition("/")[2].lstrip("page-0") for r in pages.select(f"{LANDED}.name", LANDED).orderBy(LANDED).collect()]
    assert order == ["2.json"] * 2 + ["9.json"] * 2 + ["10.json"] * 2


def test_half_characters_go(spark, one):
    text = r'{"a": "x\ud800y 😀 \\ud800 \udc00z \uD83D"}'
    clean = lambda c: whole_characters(F.col(c))
    cleaned = one(clean, text)
    assert json.loads(cleaned)["a"] == "xy \U0001f600 \\ud800 z "
    assert one(clean, "plain") == "plain"
    from martloom.sources import read_envelope
    got = read_envelope(landed(spark, r'{"result": [{"a": "x\ud800y"}]}'), "value").first().row
    assert got == {"a": "xy"}


def test_names_are_padded_per_file_and_not_per_page(spark, tmp_path):
    (tmp_path / "p").mkdir()
    for name in ("a7", "a10", "a007", "b" + "9" * 25):
        (tmp_path / "p" / f"{name}.txt").write_text("x\ny\n")
    pages = spark.read.text(str(tmp_path / "p")).select(landing_order().alias(LANDED))
    assert "regexp" not in pages._jdf.queryExecution().toString()
    found = [(r.name.rpartition("/")[2], r.file.rpartition("/")[2]) for r in pages.select(f"{LANDED}.*").orderBy("name", "file").collect()][::2]
    assert found == [(f"a{7:020}.txt", "a007.txt"), (f"a{7:020}.txt", "a7.txt"), (f"a{10:020}.txt", "a10.txt"), ("b" + "9" * 20 + ".txt", "b" + "9" * 25 + ".txt")]


def test_missing_pages(spark):
    pages = spark.createDataFrame([("a", p * 50) for p in (0, 1, 4, 9)] + [("a", 50), ("b", 0), ("a", 999_950), ("d", 0)], "t string, start long")
    totals = spark.createDataFrame([("a", 1_000_000), ("b", 49), ("c", 120), ("d", 50), ("e", 0), ("f", None)], "t string, n_source long")
    assert rows(gaps.missing_pages(pages, totals, "t")) == [("a", 10, 19998, 19989), ("a", 2, 3, 2), ("a", 5, 8, 4), ("c", 0, 2, 3)]
    one_block = gaps.missing_ranges(pages.selectExpr("t", "start div 50 as k"), totals.selectExpr("t", "0L as low", "20L as high"), "t", "k", block=1_000_000)
    many = gaps.missing_ranges(pages.selectExpr("t", "start div 50 as k"), totals.selectExpr("t", "0L as low", "20L as high"), "t", "k", block=3)
    assert rows(one_block) == rows(many)


@pytest.fixture(scope="module")
def kept(spark, sf_dir, tmp_path_factory):
    """All tables stored, marts written, a few rows changed, marts brought up."""
    root, out = str(tmp_path_factory.mktemp("tables")), str(tmp_path_factory.mktemp("marts"))
    for name, view in VIEWS.items():
        loading.replace_table(view(spark, sf_dir), table_path(root, name))
    first = upkeep.keep_up(spark, root, out, bits=6)
    before = {name: files(f"{out}/{name}") for name in first}
    again = upkeep.keep_up(spark, root, out, bits=6)

    def change(name, make):
        loading.replace_table(make(load_table(spark, root, name)), table_path(root, name))

    change("crm_contact", lambda t: t.withColumn("EMAIL", F.when(F.col("ID") == 17, "new@x.example").otherwise(F.col("EMAIL"))).where("ID <> 140"))
    change("entity_deal", lambda t: t.where("entity_deal_ID <> 33"))
    change("crm_deal", lambda t: t.withColumn("SOURCE_NAME", F.when(F.col("ID") == 5, None).otherwise(F.col("SOURCE_NAME"))))
    change("crm_company_uf", lambda t: t.withColumn("UF_ORDERS", F.when(F.col("COMPANY_ID") == 3, -1).otherwise(F.col("UF_ORDERS"))))
    return root, out, first, before, again, upkeep.keep_up(spark, root, out, bits=6)


def test_marts_kept_up_equal_a_full_build(spark, kept):
    root, out, *_ = kept
    tables = M.clean_ids(M.read_tables(spark, root))
    for name in (*M.BY_NAME, M.ENRICHED_LEADS[0]):
        want = M.enriched_leads(tables) if name == M.ENRICHED_LEADS[0] else M.build_mart(tables, name, ordered=False)
        got = M.read_mart(spark, out, name)
        assert sorted(got.columns) == sorted(want.columns) and rows(got.select(*want.columns)) == rows(want), name


def test_untouched_blocks_keep_their_files(spark, kept):
    root, out, first, before, again, second = kept
    assert set(first) == {f.name for f in upkeep.FAMILIES} and set(first.values()) == {-1} and again == {}
    assert second["contacts"] == 2 and second["deals"] <= 3 and second["companies"] == 1 and "leads" not in second
    for name in second:
        now = version(spark, f"{out}/{name}")
        assert now.rows == M.read_version(spark, f"{out}/{name}").count(), name
        new = {e.part for e in now.files if f"{out}/{name}/{e.file}" not in before[name]}
        assert len({V.divided_by(p)["_block"] for p in new}) <= second[name]
    for name in ("contacts", "deals", "deals_by_category", "leads_enriched"):
        blocks = {V.divided_by(e.part)["_block"] for e in version(spark, f"{out}/{name}").files}
        assert len(blocks) > second[name] and any(f"{out}/{name}/{e.file}" in before[name] for e in version(spark, f"{out}/{name}").files), name
    # roles: only the contacts that the lost relation row named, and the changed ones
    assert 0 < second["contacts_by_deal_role"] <= 4


def test_changed_columns_and_lost_versions_build_anew(spark, kept):
    root, out, *_ = kept
    loading.replace_table(load_table(spark, root, "crm_company").withColumn("MORE", F.lit("m")), table_path(root, "crm_company"))
    assert upkeep.keep_up(spark, root, out, bits=6) == {"companies": -1}
    assert set(M.read_mart(spark, out, "Entreprise").select("MORE").distinct().collect()) == {("m",)}
    with pytest.raises(ValueError):
        upkeep.keep_up(spark, str(out), out)
    assert S.TABLE_KEYS["crm_company"] == "ID"


def test_many_ids_widen_the_blocks(spark, sf_dir, tmp_path, monkeypatch):
    ids = spark.range(1000).union(spark.createDataFrame([(10 ** 15,)], "id long")).selectExpr("CAST(id AS string) AS id").union(spark.createDataFrame([("X1",)], "id string"))
    monkeypatch.setattr(upkeep, "MAX_BLOCKS", 10)
    assert upkeep.block_width(F.col("id"), ids, 4) == 7 and upkeep.block_width(F.col("id"), ids, 8) == 8
    assert upkeep.block_width(F.col("id"), ids.where("false"), 4) == 4
    monkeypatch.setattr(upkeep, "FAMILIES", [f for f in upkeep.FAMILIES if f.name in ("deals", "companies")])
    root, out = str(tmp_path / "tables"), str(tmp_path / "marts")
    for name, view in VIEWS.items():
        loading.replace_table(view(spark, sf_dir), table_path(root, name))
    monkeypatch.setattr(upkeep, "MAX_BLOCKS", 1000)
    assert set(upkeep.keep_up(spark, root, out, bits=4).values()) == {-1}
    monkeypatch.setattr(upkeep, "MAX_BLOCKS", 8)
    assert upkeep.keep_up(spark, root, out, bits=4) == {}  # marts of present versions stay
    changed = load_table(spark, root, "crm_deal").withColumn("SOURCE_NAME", F.when(F.col("ID") == 5, "new").otherwise(F.col("SOURCE_NAME")))
    loading.replace_table(changed, table_path(root, "crm_deal"))
    assert upkeep.keep_up(spark, root, out, bits=4) == {"deals": -1}  # outgrown: written with wider blocks
    blocks = {V.divided_by(e.part)["_block"] for e in version(spark, f"{out}/deals").files}
    assert 4 <= len(blocks) <= 9
    loading.replace_table(changed.withColumn("SOURCE_NAME", F.when(F.col("ID") == 6, "newer").otherwise(F.col("SOURCE_NAME"))), table_path(root, "crm_deal"))
    assert upkeep.keep_up(spark, root, out, bits=4) == {"deals": 1}  # the wide blocks are kept up
    want = M.build_mart(M.clean_ids(M.read_tables(spark, root)), "deals", ordered=False)
    assert rows(M.read_mart(spark, out, "deals").select(*want.columns)) == rows(want)
