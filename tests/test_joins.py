from collections import Counter

from hypothesis import HealthCheck, given, settings, strategies as st
import pytest
from pyspark.sql import functions as F

from martloom.operators import joins as J
from tests.conftest import rows


def left_join(left, right):
    out = []
    for k, v in left:
        hits = [w for r, w in right if r == k and k is not None]
        out += [(k, v, k, w) for w in hits] or [(k, v, None, None)]
    return Counter(out)


KEYS = st.one_of(st.none(), st.integers(0, 3))


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(left=st.lists(st.tuples(KEYS, st.integers(0, 50)), max_size=25), right=st.lists(st.tuples(KEYS, st.integers(0, 5)), max_size=6))
def test_spread_join_equals_brute_force(spark, left, right):
    a = spark.createDataFrame(left, "k int, v int")
    b = spark.createDataFrame(right, "k2 int, w int")
    got = J.spread_join(a, b, "k", "k2", "left")
    assert Counter(map(tuple, got.collect())) == left_join(left, right)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_spread_join_equals_plain_join(spark, how):
    a = spark.createDataFrame([(None if i % 3 == 0 else i % 2, i) for i in range(60)], "k int, v int")
    b = spark.createDataFrame([(1, "x"), (1, "y"), (7, "z"), (None, "n")], "k2 int, w string")
    assert rows(J.spread_join(a, b, "k", "k2", how)) == rows(J.equi_join(a, b, "k", "k2", how))


def test_frequent_and_missing_keys_go_to_many_tasks(spark, tmp_path):
    a = spark.range(60_000).selectExpr("case when id % 3 = 0 then 42 when id % 3 = 1 then null else id end as k", "cast(id % 7 as string) as v", "repeat('x', 50) as pad")
    b = spark.range(60_000).selectExpr("id as k2", "id * 2 as w")
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5", "spark.sql.shuffle.partitions": "40"}
    was = spark.conf.get("spark.sql.shuffle.partitions")
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        before = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
        joined = J.spread_join(a.repartition(16), b.repartition(16), "k", "k2", "left")
        assert spark.sparkContext.statusTracker().getJobIdsForGroup(None) == before  # nothing runs while the plan is made
        joined.write.format("noop").mode("overwrite").save()
        assert joined.count() == 60_000 and joined.where("w is not null").count() == 40_000
        joined.collect()
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for key in conf:
            spark.conf.unset(key)
        spark.conf.set("spark.sql.shuffle.partitions", was)
    assert "skew=true" in plan


def test_text_keys_meet_numbers_without_errors(spark):
    a = spark.createDataFrame([("12, 15",), ("",), ("X",), ("7",)], "k string")
    b = spark.createDataFrame([(12,), (7,), (0,)], "n bigint")
    assert rows(J.equi_join(a, b, "k", "n", "inner")) == [("7", 7)]
    assert rows(J.equi_join(b, a, "n", "k", "left")) == [(0, None), (12, None), (7, "7")]


def test_chain_drops_shared_columns_and_keeps_all_base_rows(spark):
    base = spark.createDataFrame([(1, "a"), (2, "b")], "ID int, NAME string")
    uf = spark.createDataFrame([(1, "other", "u")], "CONTACT_ID int, name string, UF_X string")
    entity = spark.createDataFrame([(2, "v", "e")], "entity_ID int, uf_x string, sql_Y string")
    out = J.chain(base, [(uf, "CONTACT_ID"), (entity, "entity_ID")])
    assert out.columns == ["ID", "NAME", "CONTACT_ID", "UF_X", "entity_ID", "sql_Y"]
    assert rows(out) == [(1, "a", 1, "u", None, None), (2, "b", None, None, 2, "e")]
    assert J.chain(base, [(uf, "CONTACT_ID"), (entity, "entity_ID")], how="inner").count() == 0
    assert rows(J.chain(base, [(uf, "CONTACT_ID")], spread=True)) == rows(J.chain(base, [(uf, "CONTACT_ID")]))


def test_enrich_takes_the_first_match_and_never_multiplies(spark):
    leads = spark.createDataFrame([(1, "old"), (2, "old"), (None, "old")], "ID bigint, S string")
    deals = spark.createDataFrame([(30, 1, "late"), (10, 1, "first"), (20, 1, None), (5, None, "nobody")],
                                  "ID int, LEAD_ID bigint, SOURCE string")
    for spread in (False, True):
        out = J.enrich_left(leads, deals, ("ID", "LEAD_ID"), {"SOURCE": "S"}, spread=spread)
        assert rows(out) == [(None, None), (1, "first"), (2, None)]


def test_roles(spark):
    contacts = spark.createDataFrame([(0, "z"), (1, "a"), (2, "b"), (3, "c")], "ID bigint, NAME string")
    deals = spark.createDataFrame([("1, 2", "1"), ("1", ""), ("", None), ("x", "3"), ("1, 1", "9")], "tutor string, boss string")
    by = J.rows_by_roles(contacts, deals, {"T": "tutor", "B": "boss"}).drop("_slice")
    assert rows(by) == [(1, "a", "B"), (1, "a", "T"), (1, "a", "T"), (1, "a", "T"), (3, "c", "B")]
    every = J.role_by_relation(contacts, deals, "tutor", multi="explode")
    assert rows(every) == [(1, "a")] * 4 + [(2, "b")]
    assert rows(J.role_by_relation(contacts, deals, "tutor", dedupe=True)) == [(1, "a")]
    with pytest.raises(ValueError):
        J.role_counts(deals, {"T": "tutor"}, multi="all")


def test_dedupe_is_the_distinct_of_the_faithful_rows(spark):
    contacts = spark.range(20).selectExpr("id as ID", "cast(id as string) as NAME")
    deals = spark.range(200).selectExpr("cast(id % 7 as string) as boss")
    faithful = J.role_by_relation(contacts, deals, "boss")
    assert faithful.count() == 200
    assert rows(faithful.distinct()) == rows(J.role_by_relation(contacts, deals, "boss", dedupe=True))


def test_copies_are_cut_into_slices(spark):
    rows_, named = spark.range(1, 5).selectExpr("id as ID", "id % 2 as ODD"), spark.createDataFrame([(str(i),) for i in [1] + [2] * 7 + [3] * 10], "who string")
    out = J.rows_by_roles(rows_, named, {"r": "who"}, copies_per_slice=3).collect()
    assert Counter(r.ID for r in out) == {1: 1, 2: 7, 3: 10}
    per_slice = Counter((r.ID, r._slice) for r in out)
    assert max(per_slice.values()) == 3 and len(per_slice) == 1 + 3 + 4
    ordered = J.rows_by_roles(rows_, named, {"r": "who"}, copies_per_slice=3, order=[F.col("ODD").asc(), F.col("ID").asc()])
    assert [r.ID for r in ordered.collect()] == [2] * 7 + [1] + [3] * 10


def test_flags_in_one_pass(spark):
    df = spark.createDataFrame([(1, "x", None), (2, "x", 5), (3, None, None)], "ID int, A string, B int")
    assert rows(J.rows_by_flags(df, {"a": "A", "b": "B"}).select("ID", "flag")) == [(1, "a"), (2, "a"), (2, "b")]


def test_new_rows(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "id int, v string")
    b = spark.createDataFrame([("w", 1)], "v string, id int")
    assert rows(J.new_rows(a, b, "id")) == [(2, "y")]
