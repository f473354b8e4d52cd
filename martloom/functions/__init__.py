"""Column expressions. Every function takes and returns a Column; none is a Python UDF."""

from martloom.functions.keys import clamp_int, first_id, id_list, is_integer, to_id
from martloom.functions.nested import first_in_text, first_value, typed_text, value_in_text, value_under
from martloom.functions.numbers import (
    bool_to_int, has_leading_zero, is_number, nan_to_null, retyped, zero_if_null,
)
from martloom.functions.text import (
    blank_to_null, clean_name, join_list, json_list, money_text, null_to_empty, sentinel_to_null,
    strip_marks, whole_characters,
)
from martloom.functions.times import (
    has_date_shape, is_offset_timestamp, local_timestamp, local_timestamp_text, to_datetime,
    year_in_range, zero_date_to_null,
)

__all__ = [
    "blank_to_null", "bool_to_int", "clamp_int", "clean_name", "first_id", "first_in_text", "first_value",
    "has_date_shape", "has_leading_zero", "id_list", "is_integer", "is_number",
    "is_offset_timestamp", "join_list", "json_list", "local_timestamp", "local_timestamp_text",
    "money_text", "nan_to_null", "null_to_empty", "retyped", "sentinel_to_null", "strip_marks",
    "to_datetime", "to_id", "typed_text", "value_in_text", "value_under", "whole_characters", "year_in_range", "zero_date_to_null", "zero_if_null",
]
