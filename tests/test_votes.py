"""Type votes that are stored by file and added up."""

import random

import pytest
from pyspark.sql import functions as F

from martloom.operators import quality, votes
from martloom.sources.versions import copy_version, read_version, version, write_version

SCHEMA = "id long, whole string, number string, day string, at string, zero string, odd string, none string, `a.b c` string"


def rows(start, n, **other):
    def row(k):
        r = {"id": k, "whole": str(k), "number": f"{k}.5", "day": "2024-05-06", "at": f"2024-05-06T01:02:{k % 60:02d}+01:00", "zero": str(k),
             "odd": "", "none": None, "a.b c": str(k)}
        return tuple((r | other).values())
    return [row(k) for k in range(start, start + n)]


def told(df):
    return {tuple(r) for r in df.collect()}


def same(spark, path, number=None):
    found = read_version(spark, path, number)
    assert told(votes.voted_types(spark, path, number)) == told(quality.infer_types(found))
    assert votes.voted_dates(spark, path, number) == quality.date_columns(found)


def test_votes_add_up_to_those_of_all_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    write_version(spark.createDataFrame(rows(1, 50), SCHEMA), path, "load")
    same(spark, path)
    # a second load changes the type of some columns, and only its files are read
    old = {e.file for e in version(spark, path).files}
    write_version(spark.createDataFrame(rows(51, 50, whole="1.5", day="x", zero="007", at="later"), SCHEMA), path, "load", add=True)
    new = {e.file for e in votes.keep_votes(spark, path)}
    assert new and not new & old
    same(spark, path)
    same(spark, path, 1)  # the older version keeps its own verdict
    assert votes.keep_votes(spark, path) == []


def test_old_files_are_not_opened_again(spark, tmp_path):
    path = str(tmp_path / "t")
    first = write_version(spark.createDataFrame(rows(1, 20), SCHEMA), path, "load")
    votes.keep_votes(spark, path)
    write_version(spark.createDataFrame(rows(21, 20), SCHEMA), path, "load", add=True)
    want = told(quality.infer_types(read_version(spark, path)))
    for e in first.files:  # what cannot be read cannot have been read
        (tmp_path / "t" / e.file).write_bytes(b"no parquet")
        (tmp_path / "t" / e.file).with_name("." + (tmp_path / "t" / e.file).name + ".crc").unlink(missing_ok=True)
    assert told(votes.voted_types(spark, path)) == want


def test_new_columns_empty_tables_and_replaced_tables(spark, tmp_path):
    path = str(tmp_path / "t")
    write_version(spark.createDataFrame([], SCHEMA), path, "load")
    same(spark, path)
    write_version(spark.createDataFrame([(1, "2")], "id long, whole string"), path, "load")
    same(spark, path)
    # nothing of the replaced files is left in the votes
    write_version(spark.createDataFrame([("x", None)], "id string, whole string"), path, "load")
    same(spark, path)
    with pytest.raises(ValueError):
        votes.keep_votes(spark, str(tmp_path / "absent"))


def test_a_file_without_a_row_is_voted_on_once(spark, tmp_path):
    path = str(tmp_path / "t")
    # the first of four tasks has no row and leaves an empty file all the same
    df = spark.range(0, 40, 1, 4).where("id >= 10").select("id", F.col("id").cast("string").alias("whole"))
    loaded = write_version(df, path, "load")
    assert len(loaded.files) == 4
    assert len(votes.keep_votes(spark, path)) == 4 and votes.keep_votes(spark, path) == []
    same(spark, path)


def test_votes_of_divided_and_copied_tables(spark, tmp_path):
    path, copy = str(tmp_path / "t"), str(tmp_path / "copy")
    df = spark.createDataFrame(rows(1, 60), SCHEMA).withColumn("kind", F.when(F.col("id") % 3 > 0, F.concat(F.lit("a+b %"), F.col("id") % 3)))
    df = df.withColumn("_block", F.col("id") % 2)
    write_version(df, path, "load", by=["kind", "_block"])
    same(spark, path)
    copy_version(spark, path, copy)
    same(spark, copy)


def test_random_loads_equal_the_vote_of_all_rows(spark, tmp_path):
    rng, path = random.Random(7), str(tmp_path / "t")
    kinds = ["1", "-2", "0", "01", "1.5", "x", "", None, "2024-05-06", "2024-05-06T01:02:03+01:00", "0001-01-01"]
    for k in range(4):
        some = [rng.sample(kinds, rng.randrange(1, 4)) for _ in range(4)]
        part = [tuple(rng.choice(s) for s in some) for _ in range(10)]
        write_version(spark.createDataFrame(part, "a string, b string, c string, d string"), path, "load", add=k > 0)
        if k != 1:  # one load is voted on with the next
            same(spark, path)
