import json

import pytest
from pyspark.sql import functions as F

from martloom import sources as src
from martloom.operators import loading
from martloom.sources.pages import TYPED_ROWS, matrix_columns, read_envelope, spread_map, survey_pages
from martloom.sources.tables import load_table
from tests.conftest import rows


def pages(spark, *docs):
    return spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(docs)], "page int, value string")


def test_envelope_with_and_without_result(spark):
    df = pages(spark, {"result": [{"ID": "1"}], "total": 9}, {"total": 9}, {"result": [], "total": 9})
    out = src.read_envelope(df, "value")
    assert [(r.row, r.total) for r in out.collect()] == [({"ID": "1"}, 9)]


def test_envelope_payload_and_items(spark):
    df = pages(spark, {"result": {"items": [{"id": 3}, {"id": 4}]}, "total": 2})
    assert [r.row["id"] for r in src.read_envelope(df, "value", items="items").collect()] == ["3", "4"]
    df = pages(spark, {"productRows": [{"ownerId": 3}]})
    assert [r.row["ownerId"] for r in src.read_envelope(df, "value", payload="productRows").collect()] == ["3"]


def test_typed_rows_keep_lists_and_booleans(spark):
    df = pages(spark, {"result": [{"ID": 1, "ok": False, "tags": ["a", None]}]})
    out = src.read_envelope(df, "value", row_schema="struct<ID: bigint, ok: boolean, tags: array<string>>").select("row.*")
    assert tuple(out.first()) == (1, False, ["a", None])


def test_fields_found_and_spread(spark):
    df = src.read_envelope(pages(spark, {"result": [{"ID": 1, "b": "x"}, {"ID": 2, "a": "y"}]}), "value")
    assert src.field_names(df) == ["ID", "a", "b"]
    assert rows(src.spread_map(df, ["b", "ID", "missing"])) == [(None, "2", None), ("x", "1", None)]


def test_typed_cells(spark):
    df = pages(spark, {"result": [{"list": ["2", None, 1], "none": [], "no": False, "yes": True, "text": "[12]", "word": "false",
                                   "n": 12, "f": 1.5, "null": None, "map": {"7": "a"}}]})
    names = ["list", "none", "no", "yes", "text", "word", "n", "f", "null", "map", "absent"]
    out = src.spread_map(src.read_envelope(df, "value", row_schema=src.TYPED_ROWS), names)
    assert tuple(out.first()) == ("2, None, 1", "", "0", "1", "[12]", "false", "12", "1.5", None, '{"7":"a"}', None)


def test_survey_is_names_and_total_in_one_pass(spark):
    df = pages(spark, {"result": [{"b": 1}, {"a": 2}], "total": 2}, {"result": [], "total": 7}, {"total": 9})
    assert src.survey_pages(df, "value") == (["a", "b"], 9)
    assert src.survey_pages(pages(spark, {"result": {"items": [{"c": 1}]}}), "value", items="items") == (["c"], None)


def test_earliest_page_wins(spark):
    df = pages(spark, {"result": [{"ID": "1", "v": "a"}, {"ID": "2", "v": "b"}]}, {"result": [{"ID": "2", "v": "c"}, {"ID": "3", "v": "d"}]})
    flat = src.read_envelope(df, "value", keep=["page"]).select("page", F.col("row")["ID"].alias("ID"), F.col("row")["v"].alias("v"))
    assert rows(src.dedupe_pages(flat, "ID", "page").select("ID", "v")) == [("1", "a"), ("2", "b"), ("3", "d")]
    assert src.dedupe_pages(flat, "ID").count() == 3


def test_matrix(spark):
    df = pages(spark, [["ID", "N"], ["1", None], ["2", "x"]], [["N", "ID"], ["y", "3"]], [["ID", "N"]], [])
    assert src.matrix_columns(df, "value") == ["ID", "N"]
    assert rows(src.read_matrix(df, "value", ["ID", "N", "Z"])) == [("1", None, None), ("2", "x", None), ("3", "y", None)]


def test_matrix_row_shorter_than_header(spark):
    assert rows(src.read_matrix(pages(spark, [["ID", "N"], ["1"]]), "value", ["ID", "N"])) == [("1", None)]


def test_unwrap(spark):
    df = spark.createDataFrame([(1, '{"7":"a","8":"b"}', '{"9":"c"}', '{"9":"c"}'), (2, "{}", "plain", None)],
                               "ID int, PROPERTY_1 string, PROPERTY_2 string, OTHER string")
    df = df.withColumn("PROPERTY_1", F.from_json("PROPERTY_1", "map<string,string>"))
    assert rows(src.unwrap_first(df)) == [(1, "a", "c", '{"9":"c"}'), (2, None, "plain", None)]
    df = spark.createDataFrame([(1, {"value": "a"}, '{"value":"c"}'), (2, {"id": "x"}, '{"id":"y"}')],
                               "ID int, PROPERTY_1 map<string,string>, PROPERTY_2 string")
    assert rows(src.unwrap_key(df)) == [(1, "a", "c"), (2, '{"id":"x"}', '{"id":"y"}')]


def test_keyset_pages_cover_the_table(spark):
    df = spark.range(1, 12).withColumnRenamed("id", "ID")
    seen, after = [], 0
    while page := [r.ID for r in src.keyset_scan(df, "ID", after, limit=4).collect()]:
        seen, after = seen + page, page[-1]
    assert seen == list(range(1, 12))
    assert rows(src.keyset_scan(df, "ID", 3, upto=5)) == [(4,), (5,)]


def test_list_catalogue_last_name_wins(spark):
    df = spark.createDataFrame([(0, "A b", 7), (1, "A'b", 8), (2, "A (b)", 9)], "pos int, NAME string, ID int")
    assert rows(src.list_catalogue(df, "NAME", "ID", "pos")) == [("A_b", 9), ("Ab", 8)]


def test_entity_types_and_fields(spark):
    df = spark.createDataFrame([(140,), (160,)], "entityTypeId int")
    assert rows(src.entity_type_ids(df, "entityTypeId")) == [(140,), (160,), (31,)]
    doc = pages(spark, {"result": {"COMPANY_ID": {"type": "crm_company"}, "UF_X": {"type": "crm"}}})
    assert rows(src.field_catalogue(doc, "value")) == [("COMPANY_ID", "crm_company"), ("UF_X", "crm")]


def test_rows_for_owners_keeps_every_row_of_an_owner(spark):
    lines = spark.createDataFrame([(1, "T8c"), (1, "T8c"), (2, "T8c"), (1, "Ta0"), (None, "T8c")], "ownerId int, ownerType string")
    owners = src.positive_ids(spark.createDataFrame([(1, 5.0), (1, 3.0), (2, 0.0), (3, None)], "id int, opportunity double"),
                              "id", "opportunity")
    assert rows(src.rows_for_owners(lines, owners, "ownerId", "id", "ownerType", "T8c")) == [(1, "T8c"), (1, "T8c")]


def test_stored_tables(spark, tmp_path):
    path = src.table_path(str(tmp_path), "crm_deal", "main")
    assert path == f"{tmp_path}/crm_deal/database_name=main"
    assert not src.has_table(spark, path)
    df = spark.createDataFrame([(1, "a_b")], "ID int, my_col string")
    df.write.parquet(path)
    assert src.has_table(spark, path)
    assert src.column_names(spark, path) == ["ID", "my_col"]
    stored = src.load_table(spark, str(tmp_path), "crm_deal", "main")
    assert src.has_column(stored, "MY_COL")
    # an underscore is a character here, not a wildcard
    assert not src.has_column(stored, "myXcol")


def test_declared_totals(spark):
    df = spark.createDataFrame([("a", '{"total": 3}'), ("a", '{"total": 5}'), ("b", "{}")], "name string, value string")
    assert rows(src.page_totals(df, "value", "name")) == [("a", 5), ("b", None)]


def test_read_envelope_rejects_nothing(spark):
    df = spark.createDataFrame([("not json",), (None,)], "value string")
    assert src.read_envelope(df, "value").count() == 0


@pytest.mark.parametrize("owner_type", ["T8c", "Ta0"])
def test_owner_type_is_a_filter(spark, owner_type):
    lines = spark.createDataFrame([(1, "T8c"), (1, "Ta0")], "ownerId int, ownerType string")
    owners = spark.createDataFrame([(1,)], "id int")
    assert rows(src.rows_for_owners(lines, owners, "ownerId", "id", "ownerType", owner_type)) == [(1, owner_type)]


def test_null_records_and_corrupt_pages(spark):
    pages = spark.createDataFrame([('{"result":[null,{"a":1,"b":2}],"total":5}',)], "value string")
    assert survey_pages(pages, "value") == (["a", "b"], 5)
    assert [r.row for r in read_envelope(pages, "value").collect()] == [{"a": "1", "b": "2"}]
    torn = pages.union(spark.createDataFrame([('{"result":[{"a":1',)], "value string"))
    with pytest.raises(ValueError, match="1 landed pages"):
        survey_pages(torn, "value")
    matrices = spark.createDataFrame([('[["x"],["1"]]',), ('[["x"],["2"',)], "value string")
    with pytest.raises(ValueError, match="1 landed documents"):
        matrix_columns(matrices, "value")


def test_files_with_different_columns_are_read_whole(spark, tmp_path):
    path = str(tmp_path / "t" / "database_name=main")
    loading.append_new(spark.createDataFrame([(1, "x")], "id int, a string"), path, "id")
    loading.append_new(spark.createDataFrame([(1, "x", "no"), (2, "y", "new")], "id int, a string, b string"), path, "id")
    assert rows(load_table(spark, str(tmp_path), "t")) == [(1, "x", None), (2, "y", "new")]


def test_booleans_in_lists_are_spelled_and_text_is_not(spark):
    pages = spark.createDataFrame([('{"result":[{"a":[true,false,null,"true",3]}]}',)], "value string")
    out = spread_map(read_envelope(pages, "value", row_schema=TYPED_ROWS), ["a"])
    assert out.first().a == "True, False, None, true, 3"
