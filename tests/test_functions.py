import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from martloom import functions as fn
from martloom.functions.cleaning import clean_connector, clean_entity
from tests.conftest import rows


@pytest.mark.parametrize("function, value, expected", [
    (fn.sentinel_to_null, "non sélectionné", None),
    (fn.sentinel_to_null, "Non sélectionné", "Non sélectionné"),
    (fn.sentinel_to_null, " non sélectionné", " non sélectionné"),
    (fn.sentinel_to_null, None, None),
    (fn.blank_to_null, "", None),
    (fn.blank_to_null, "  ", None),
    (fn.blank_to_null, "\t\n", None),
    (fn.blank_to_null, "\u00a0", None),
    (fn.blank_to_null, " \x1c\x85", None),
    (fn.blank_to_null, " a", " a"),
    (fn.blank_to_null, "\u00a0é", "\u00a0é"),
    (fn.blank_to_null, "é", "é"),
    (fn.blank_to_null, None, None),
    (fn.null_to_empty, None, ""),
    (fn.null_to_empty, "a", "a"),
    (fn.strip_marks, "\ufeffabc", "abc"),
    (fn.strip_marks, "a\ufeffb\ufeff", "ab"),
    (fn.money_text, "12.50|EUR", "12.50"),
    (fn.money_text, "-12.50|EUR", "12.50"),
    (fn.money_text, "1 200.50|EUR, 3|EUR", "1200.503"),
    (fn.money_text, "12.50|USD", "12.50|USD"),
    (fn.money_text, "EUR 3", "EUR 3"),
    (fn.clean_name, "Année d'inscr (2)", "Année_dinscr_2"),
    (fn.clean_name, "a-b c", "ab_c"),
    (fn.local_timestamp_text, "2024-05-06T10:11:12+03:00", "2024-05-06 10:11:12"),
    (fn.local_timestamp_text, "2024-05-06T10:11:12-03:00", "2024-05-06T10:11:12-03:00"),
    (fn.local_timestamp_text, "2024-05-06T10:11:12Z", "2024-05-06T10:11:12Z"),
    (fn.local_timestamp_text, "2024-05-06T10:11:12.5+03:00", "2024-05-06T10:11:12.5+03:00"),
    (fn.local_timestamp_text, "2024-02-30T10:11:12+03:00", None),
    (fn.local_timestamp_text, "2024-05-06T25:11:12+03:00", None),
    (fn.local_timestamp_text, "2263-01-01T00:00:00+00:00", None),
    (fn.local_timestamp_text, "1676-12-31T00:00:00+00:00", None),
    (fn.local_timestamp_text, "2262-12-31T00:00:00+00:00", "2262-12-31 00:00:00"),
    (fn.local_timestamp_text, "1677-01-01T00:00:00+00:00", "1677-01-01 00:00:00"),
    (fn.local_timestamp_text, "0000-01-01T00:00:00+00:00", None),
    (fn.local_timestamp_text, "text", "text"),
    (fn.local_timestamp, "2024-05-06T10:11:12+03:00", datetime(2024, 5, 6, 10, 11, 12)),
    (fn.local_timestamp, "2024-03-31T02:30:00+01:00", datetime(2024, 3, 31, 2, 30)),
    (fn.local_timestamp, "text", None),
    (fn.zero_date_to_null, "0000-00-00 00:00:00", None),
    (fn.zero_date_to_null, "2024-05-06 00:00:00", "2024-05-06 00:00:00"),
    (fn.to_datetime, "2024-05-06 10:11:12", datetime(2024, 5, 6, 10, 11, 12)),
    (fn.to_datetime, "no date", None),
    (fn.has_date_shape, "2024-05-06", True),
    (fn.has_date_shape, "2024-05-06T10:11:12Z", True),
    (fn.has_date_shape, "2024-05-06T10:11:12.25-03:00", True),
    (fn.has_date_shape, "2024-05-06 10:11:12", False),
    (fn.has_date_shape, "12", False),
    (fn.has_leading_zero, "0.5", True),
    (fn.has_leading_zero, "0", False),
    (fn.has_leading_zero, "10", False),
    (fn.is_number, "1e3", True),
    (fn.is_number, "-.5", True),
    (fn.is_number, "1d", False),
    (fn.is_number, "1,5", False),
    (fn.is_integer, "-3", True),
    (fn.is_integer, "X12", False),
    (fn.is_integer, "", False),
    (fn.is_integer, None, None),
    (fn.to_id, "12", 12),
    (fn.to_id, "12, 15", None),
    (fn.clamp_int, "99999999999", 2147483647),
    (fn.clamp_int, "-99999999999999999999999", -2147483648),
    (fn.clamp_int, "17", 17),
    (fn.clamp_int, "X", None),
    (fn.first_id, "12, 15", 12),
    (fn.first_id, " 7", 7),
    (fn.first_id, "", None),
    (fn.first_id, "X1", None),
    (fn.id_list, "12, 15,x", [12, 15]),
    (fn.id_list, "", []),
    (fn.value_in_text, '{"value":"5"}', "5"),
    (fn.value_in_text, '{"value":null}', None),
    (fn.value_in_text, '{"id":1}', '{"id":1}'),
    (fn.value_in_text, "plain", "plain"),
    (fn.first_in_text, '{"77":"a","78":"b"}', "a"),
    (fn.first_in_text, "plain", "plain"),
])
def test_text_cells(one, function, value, expected):
    assert one(function_of(function), value) == expected


def function_of(function):
    return lambda name: function(F.col(name))


@pytest.mark.parametrize("function, value, dtype, expected", [
    (fn.join_list, ["1", None, "a"], "array<string>", "1, None, a"),
    (fn.join_list, [], "array<string>", ""),
    (fn.join_list, [1, 2], "array<int>", "1, 2"),
    (fn.json_list, ["1", None, "a"], "array<string>", '["1",null,"a"]'),
    (fn.bool_to_int, False, "boolean", 0),
    (fn.bool_to_int, True, "boolean", 1),
    (fn.nan_to_null, math.nan, "double", None),
    (fn.nan_to_null, 1.5, "double", 1.5),
    (fn.nan_to_null, None, "double", None),
    (fn.zero_if_null, None, "double", 0.0),
    (fn.first_value, {"77": "a", "78": "b"}, "map<string,string>", "a"),
    (fn.first_value, {}, "map<string,string>", None),
    (fn.value_under, {"value": "5"}, "map<string,string>", "5"),
    (fn.value_under, {"value": None}, "map<string,string>", None),
    (fn.value_under, {"id": "1"}, "map<string,string>", '{"id":"1"}'),
])
def test_typed_cells(one, function, value, dtype, expected):
    assert one(function_of(function), value, dtype) == expected


def test_booleans_in_a_list_are_spelled_as_words(spark):
    df = spark.createDataFrame([([True, False, None],)], "v array<boolean>")
    assert df.select(fn.join_list(F.col("v"), df.schema["v"].dataType)).first()[0] == "True, False, None"


MIXED = "label string, amount string, at string, zero string, ok boolean, tags array<string>, n double"


def test_clean_entity_runs_all_steps_and_is_idempotent(spark):
    df = spark.createDataFrame([
        ("\ufeffnon sélectionné", "-5|EUR", "2024-05-06T10:11:12+03:00", "0000-00-00 00:00:00", False, ["a", None], math.nan),
        ("\u00a0", "x", "2263-05-06T10:11:12+03:00", None, True, [], 1.0),
    ], MIXED)
    first = clean_entity(df)
    expected = [
        (None, "5", "2024-05-06 10:11:12", "0000-00-00 00:00:00", 0, "a, None", math.nan),
        (None, "x", None, None, 1, None, 1.0),
    ]
    assert [str(tuple(r)) for r in first.collect()] == [str(r) for r in expected]
    assert [str(r) for r in clean_entity(first).collect()] == [str(r) for r in first.collect()]


def test_clean_connector_leaves_money_and_dates(spark):
    df = spark.createDataFrame([
        ("non sélectionné", "-5|EUR", "2024-05-06T10:11:12+03:00", "0000-00-00 00:00:00", False, ["a", None], math.nan),
        ("  ", None, None, None, True, [], 1.0),
    ], MIXED)
    assert rows(clean_connector(df)) == [
        (None, None, None, None, True, "", 1.0),
        (None, "-5|EUR", "2024-05-06T10:11:12+03:00", None, False, "a, None", None),
    ]
    assert rows(clean_connector(df, empty_for_null=True)) == [
        ("", "", "", "", True, "", 1.0),
        ("", "-5|EUR", "2024-05-06T10:11:12+03:00", None, False, "a, None", None),
    ]
