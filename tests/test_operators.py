from datetime import datetime

import pytest
from pyspark.sql import functions as F

from martloom import settings as S
from martloom.operators import columns as C
from martloom.operators import filters, loading, ordering, quality
from martloom.plans.refresh import audit_row, refresh_connector, refresh_entity, run_all
from martloom.sources import load_sources, load_table, read_part, read_stored, table_path, unwrap_first
from tests.conftest import rows


def test_include_and_exclude(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    kept, missing = C.keep_columns(df, ["c", "x", "a"])
    assert kept.columns == ["c", "a"] and missing == ["x"]
    assert C.drop_columns(df, ["B", "x"]).columns == ["a", "c"]
    assert len(S.INVOICE_COLUMNS) == len(set(S.INVOICE_COLUMNS))


def test_numeric_only_and_switch(spark):
    df = spark.createDataFrame([(1, "x", 2.0)], "a int, b string, c double")
    assert C.numeric_only(df).columns == ["a", "c"]
    assert C.numeric_only(df, active=False) is df


def test_fields_of_type(spark):
    fields = spark.createDataFrame([("B", "crm"), ("A", "iblock_element"), ("C", "string"), ("D", "crm_entity")], "field string, type string")
    assert C.fields_of_type(fields) == ["A", "B", "D"]


def test_drop_shared_leaves_disjoint_columns(spark):
    a = spark.createDataFrame([(1, 2, 3)], "ID int, Name int, x_y int")
    b = spark.createDataFrame([(1, 2, 3, 4, 5)], "id int, NAME int, xzy int, DEAL_ID int, X_Y int")
    assert C.drop_shared(a, b).columns == ["xzy", "DEAL_ID"]
    assert C.drop_shared(a, b, keep=["ID"]).columns == ["id", "xzy", "DEAL_ID"]
    assert C.schema_diff(a, b) == ([], ["xzy", "DEAL_ID"])


def test_prefix_and_null_text(spark):
    df = spark.createDataFrame([(1, 2)], "ID int, UF_CRM_1 int")
    assert C.prefix_columns(df, "deal").columns == ["entity_deal_ID", "sql_UF_CRM_1"]
    out = C.add_null_text(df, ["id", "note"])
    assert out.columns == ["ID", "UF_CRM_1", "note"] and out.schema["note"].dataType.simpleString() == "string"


def test_id_filters(spark):
    df = spark.createDataFrame([("12", "7"), ("-3", ""), ("X12", "1"), ("", "1"), (None, "C2")], "ID string, FK string")
    assert rows(filters.delete_nonint_ids(df, "ID").select("ID")) == [(None,), ("-3",), ("12",)]
    assert rows(filters.null_nonint(df, "FK").select("FK")) == [(None,), (None,), ("1",), ("1",), ("7",)]
    assert rows(filters.int_ids(df, "ID", ("FK",))) == [(None, None), (-3, None), (12, 7)]
    big = spark.createDataFrame([("99999999999",)], "ID string")
    assert filters.int_ids(big, "ID").first().ID == 99999999999
    assert filters.int_ids(big, "ID", clamp=True).first().ID == 2147483647


def test_category_text_never_raises(spark):
    df = spark.createDataFrame([("8",), ("8x",), ("",), (None,), ("08",)], "CATEGORY_ID string")
    assert rows(filters.by_category(df, 8)) == [("08",), ("8",)]


def test_sort_puts_nulls_first(spark):
    df = spark.createDataFrame([(2, 1), (None, 3), (1, 2), (None, 1)], "k int, ID int")
    assert [tuple(r) for r in ordering.sort_mart(df, ["k"], ["ID"]).collect()] == [(None, 1), (None, 3), (1, 2), (2, 1)]


def test_range_order_cuts_inside_a_hot_key(spark):
    df = spark.range(4000).selectExpr("if(id % 3 = 0, null, id) as k", "id as ID").repartition(4)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        parts = ordering.sort_mart(df, ["k"], ["ID"]).select("k", F.spark_partition_id().alias("p")).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len({r.p for r in parts if r.k is None}) > 1


def test_checks(spark):
    df = spark.createDataFrame([("1",), ("1",), ("2",), (None,), ("x",)], "ID string")
    assert rows(quality.check_key(df, "ID")) == [(None, 1), ("1", 2)]
    assert rows(quality.check_int_key(df, "ID")) == [(None, 2), (1, 2)]
    assert not loading.key_is_clean(df, "ID")
    assert loading.key_is_clean(df.where("ID = '2'"), "ID")
    assert tuple(quality.distinct_ids(df, "ID").first()) == (4, 3, 1)
    assert tuple(quality.distinct_ids(df.limit(0), "ID").first()) == (0, 0, 0)
    assert quality.max_id(df.where("ID <> 'x'"), "ID").first().max_id == "2"


def test_reconcile(spark):
    declared = spark.createDataFrame([("a", 5)], "table_name string, n_source bigint")
    out = quality.reconcile({"a": spark.range(3), "b": spark.range(2)}, declared)
    assert rows(out) == [("a", 3, 5, 2), ("b", 2, None, None)]


@pytest.mark.parametrize("values, verdict", [
    (["1", "2"], "INTEGER"), (["1", "2.5"], "FLOAT"), (["1", "x"], "TEXT"), (["0.5", "1.5"], "TEXT"), (["0", "1"], "INTEGER"),
    (["2024-05-06", "2024-05-06T01:02:03Z"], "DATETIME"), (["2024-05-06", "1"], "TEXT"), (["0001-05-06"], "DATETIME"),
    (["", None], "TEXT"), (["", "4"], "INTEGER"), (["1d"], "TEXT"), (["-1e3"], "FLOAT"),
])
def test_type_votes(spark, values, verdict):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    n = sum(bool(v) for v in values)
    assert rows(quality.infer_types(df)) == [("v", verdict, n)]
    assert rows(quality.infer_types(df, mode="reference")) == [("v", "TEXT", n)]


def test_date_columns_need_every_value(spark):
    df = spark.createDataFrame([
        ("2024-05-06T10:11:12+03:00", "2024-05-06T10:11:12+03:00", None, "2263-05-06T10:11:12+03:00", "2024-05-06T10:11:12+03:00"),
        (None, "", None, None, "2024-02-30T10:11:12+03:00")], "a string, b string, c string, d string, e string")
    assert quality.date_columns(df) == ["a", "e"]
    assert quality.date_columns(spark.range(1)) == []


def test_align_additive(spark):
    stored = spark.createDataFrame([], "ID int, NAME string, OLD double").schema
    df = spark.createDataFrame([("x", "5", True, 3)], "name string, id string, flag boolean, n int")
    out = loading.align_additive(df, stored)
    assert out.dtypes == [("ID", "int"), ("NAME", "string"), ("OLD", "double"), ("flag", "string"), ("n", "double")]
    assert tuple(out.first()) == (5, "x", None, "true", 3.0)
    assert loading.align_additive(df.withColumn("id", F.lit("no")), stored).first().ID is None


def test_loads(spark, tmp_path):
    path = table_path(str(tmp_path), "t")
    loading.full_refresh(spark.createDataFrame([(1, "a")], "ID int, v string"), path)
    loading.full_refresh(spark.createDataFrame([(2, 1.5)], "ID int, w double"), path)
    assert rows(read_stored(spark, path)) == [(2, None, 1.5)]
    assert not loading.load_if_nonempty(spark.createDataFrame([], "ID int"), path)
    assert rows(read_stored(spark, path)) == [(2, None, 1.5)]
    loading.append_new(spark.createDataFrame([(2, 9.0), (3, 4.0)], "ID int, w double"), path, "ID")
    assert rows(read_stored(spark, path)) == [(2, None, 1.5), (3, None, 4.0)]
    loading.replace_table(spark.createDataFrame([(4,)], "ID int"), path)
    assert read_stored(spark, path).columns == ["ID"]


def test_a_table_can_be_refreshed_from_itself(spark, tmp_path):
    path = table_path(str(tmp_path), "t")
    loading.replace_table(spark.range(3), path)
    loading.full_refresh(read_stored(spark, path).where("id > 0"), path)
    assert rows(read_stored(spark, path)) == [(1,), (2,)]
    loading.replace_table(read_stored(spark, path).where("id > 9"), path)
    assert read_stored(spark, path).columns == ["id"] and read_stored(spark, path).isEmpty()


def test_a_failed_load_keeps_the_old_contents_and_other_sources(spark, tmp_path):
    here, there = table_path(str(tmp_path), "t", "here"), table_path(str(tmp_path), "t", "there")
    loading.replace_table(spark.range(3), here)
    loading.replace_table(spark.range(5), there)
    broken = spark.range(4).select(F.when(F.col("id") == 3, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).cast("bigint").alias("id"))
    with pytest.raises(Exception, match="lost"):
        loading.replace_table(broken, here)
    loading.replace_table(spark.range(1), there)
    assert read_stored(spark, here).count() == 3
    assert rows(load_sources(spark, str(tmp_path), "t").groupBy("database_name").count()) == [("here", 3), ("there", 1)]


def test_write_mart_orders_files_and_drops_ties(spark, tmp_path):
    df = spark.range(100).selectExpr("99 - id as ID", "id % 2 as part", "id as _slice")
    loading.write_mart(df, str(tmp_path / "m"), ["ID"], by="part", ties=["_slice"])
    back = read_part(spark, str(tmp_path / "m"), part="1")
    assert back.columns == ["ID"] and back.count() == 50
    loading.write_mart(df.drop("part"), str(tmp_path / "n"), ["ID"], ties=["_slice"], ranged=False)
    files = read_stored(spark, str(tmp_path / "n")).select("ID", F.input_file_name().alias("f")).collect()
    for name in {r.f for r in files}:
        ids = [r.ID for r in files if r.f == name]
        assert ids == sorted(ids)


def test_snapshot(spark, tmp_path):
    loading.replace_table(spark.range(3), table_path(str(tmp_path), "crm_deal", "main"))
    assert loading.snapshot(spark, str(tmp_path), ["crm_deal"], database="main") == [f"{tmp_path}/crm_deal_transform/database_name=main"]
    assert load_table(spark, str(tmp_path), "crm_deal_transform", "main").count() == 3


AT = datetime(2024, 5, 6, 23, 30)


def landed(spark, *docs):
    return spark.createDataFrame([(d,) for d in docs], "value string")


def test_entity_run(spark, tmp_path):
    root = str(tmp_path)
    loading.reset_log(spark, root, "main")
    docs = landed(
        spark,
        '{"result": [{"ID": "1", "AMOUNT": "5|EUR", "AT": "2024-05-06T10:11:12+03:00", "PROPERTY_7": {"10": "red"}, "SKIP": "s"}], "total": 3}',
        '{"result": [{"ID": "2", "AMOUNT": " ", "AT": null, "PROPERTY_7": {}, "SKIP": "s"}], "total": 3}')
    assert refresh_entity(docs, root, "product", AT, "main", reshape=unwrap_first, exclude=["SKIP"], find_dates=True)
    stored = load_table(spark, root, "entity_product", "main")
    assert rows(stored.select("ID", "AMOUNT", "AT", "PROPERTY_7")) == [
        ("1", "5", datetime(2024, 5, 6, 10, 11, 12), "red"), ("2", None, None, None)]
    assert "SKIP" not in stored.columns
    log = load_table(spark, root, loading.SYNC_LOG, "main")
    assert log.schema == loading.SYNC_SCHEMA
    assert rows(log) == [(AT, "main", "entity_product", 2, 3, None)]
    # nothing landed: the table stays and no audit row is written
    assert not refresh_entity(landed(spark, '{"total": 0}'), root, "product", AT, "main", fields=["ID"])
    assert load_table(spark, root, "entity_product", "main").count() == 2
    assert load_table(spark, root, loading.SYNC_LOG, "main").count() == 1


def test_invoices_keep_the_listed_columns(spark, tmp_path):
    docs = landed(spark, '{"result": {"items": [{"title": "t", "id": "1", "extra": "e"}]}}')
    assert refresh_entity(docs, str(tmp_path), str(S.INVOICE_TYPE), AT, items="items", include=S.INVOICE_COLUMNS, recreate=True)
    assert load_table(spark, str(tmp_path), "entity_31").columns == ["id", "title"]


def test_connector_run_drops_the_excluded_columns(spark, tmp_path):
    docs = landed(spark, '[["DEAL_ID", "UF_CRM_1611039011", "V"], ["1", "x", "non sélectionné"]]')
    assert refresh_connector(docs, str(tmp_path), "crm_deal_uf")
    assert rows(load_table(spark, str(tmp_path), "crm_deal_uf")) == [("1", None)]


def test_a_failed_job_is_logged_and_the_others_go_on(spark, tmp_path):
    done = []

    def broken():
        raise RuntimeError("no answer")

    failed = run_all(spark, [("entity_a", broken), ("entity_b", lambda: done.append(1) or True)], str(tmp_path), AT, "main")
    assert failed == ["entity_a"] and done == [1]
    assert rows(load_table(spark, str(tmp_path), loading.SYNC_LOG, "main")) == [(AT, "main", "entity_a", 0, None, "no answer")]


def test_audit_row_types(spark):
    row = audit_row(spark, AT, "main", "t", 1, None)
    assert row.dtypes == [(f.name, f.dataType.simpleString()) for f in loading.SYNC_SCHEMA]
    assert tuple(row.first()) == (AT, "main", "t", 1, None, None)


def test_append_reads_stored_ids_near_the_batch_only(spark, tmp_path):
    path = str(tmp_path / "t" / "database_name=main")
    loading.append_new(spark.range(1000).withColumnRenamed("id", "k"), path, "k")
    loading.append_new(spark.range(990, 1010).withColumnRenamed("id", "k"), path, "k")
    loading.append_new(spark.createDataFrame([(None,), (5000,)], "k bigint"), path, "k")
    loading.append_new(spark.createDataFrame([], "k bigint"), path, "k")
    stored = read_stored(spark, path)
    assert stored.count() == 1012 and stored.distinct().count() == 1012
    plan = stored.where("k between 2000 and 3000")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(k,2000)" in plan
