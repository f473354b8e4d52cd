"""One matrix document read by many tasks."""

import json
import random

import pytest

from martloom.sources import matrices
from martloom.sources.pages import read_matrix


@pytest.fixture
def pieces(spark):
    """A function that sets the bytes of a file that one task reads."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = {n: spark.conf.get(n) for n in names}

    def cut(size):
        for n in names:
            spark.conf.set(n, str(size))
    yield cut
    for n, v in old.items():
        spark.conf.set(n, v)


def land(tmp_path, name, text):
    (tmp_path / name).write_text(text, encoding="utf-8")
    return str(tmp_path / name)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


CELLS = ["plain", 'a "quoted" one', "back\\slash", 'ends with \\', "]", "[", '],["', "[[\"", "", None, 7, 1.5, True, ["x", "]"], [], "日本]語", "line\nend", '\\"', "{}", "a,b"]


def test_cells_of_any_kind_in_pieces_of_any_size(spark, tmp_path, pieces):
    rng = random.Random(11)
    matrix = [["ID", "a b", "x"], *[[k, rng.choice(CELLS), rng.choice(CELLS)] for k in range(300)]]
    for name, text in (("tight", json.dumps(matrix, separators=(",", ":"))), ("wide", json.dumps(matrix, indent=1, ensure_ascii=False) + "\n")):
        path = land(tmp_path, name, text)
        want = rows(read_matrix(spark.createDataFrame([(text,)], "doc string"), "doc", ["ID", "a b", "x"]))
        for size in (97, 1000, 1 << 20):
            pieces(size)
            got = matrices.read_document(spark, [path])
            assert got.columns == ["ID", "a b", "x"] and rows(got) == want
            if size == 1000:
                assert spark.read.option("lineSep", "]").text(path).rdd.getNumPartitions() > 5


def test_a_text_over_many_pieces_and_rows_over_many_blocks(spark, tmp_path, pieces):
    long = "]" * 500 + '"' + "[" * 500
    matrix = [["ID", "x"], ["1", long], ["2", "b"], ["3", long]]
    pieces(100)
    path = land(tmp_path, "long", json.dumps(matrix))
    assert rows(matrices.read_document(spark, [path])) == [("1", long), ("2", "b"), ("3", long)]
    # no header, header only, nothing but blanks around
    for k, (text, want) in enumerate([("[]", []), ('[["ID","x"]]', []), (' [ ["x"] ,\n ["1"] ] \n', [("1",)])]):
        assert rows(matrices.read_document(spark, [land(tmp_path, f"s{k}", text)])) == want


def test_every_file_has_its_own_header(spark, tmp_path, pieces):
    pieces(64)
    a = land(tmp_path, "a", json.dumps([["ID", "x"], *[[k, f"x{k}"] for k in range(20)]]))
    b = land(tmp_path, "b", json.dumps([["y", "ID"], *[[f"y{k}", k] for k in range(20)], ["short"]]))
    got = rows(matrices.read_document(spark, [a, b], ["ID", "x", "y"]))
    assert got == sorted([*[(str(k), f"x{k}", None) for k in range(20)], *[(str(k), None, f"y{k}") for k in range(20)], (None, None, "short")], key=repr)


@pytest.mark.parametrize("text", ['[["ID"],["1"]', '[["ID"],["1', '[["ID"],["1"]]\n[["ID"],["2"]]'])
def test_incomplete_or_several_documents_raise_an_error(spark, tmp_path, text):
    with pytest.raises(ValueError):
        matrices.read_document(spark, [land(tmp_path, "bad", text)])
