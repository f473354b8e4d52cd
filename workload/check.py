"""Compare every registered query with its SQL: ``python -m workload.check <sf_dir> [name...]``."""

from __future__ import annotations

import glob
import math
import sys
import time
from collections import Counter
from decimal import Decimal

import duckdb
from pyspark.sql import DataFrame

from workload import ORACLE, QUERIES


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = path.rsplit("/", 1)[1].removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if isinstance(value, list):
        return tuple(_plain(v) for v in value)
    if isinstance(value, dict):
        return tuple((k, _plain(v)) for k, v in value.items())
    if isinstance(value, Decimal):
        return (value, "decimal")
    return value


def _rows(table, columns: list[str]) -> Counter:
    picked = [[_plain(v) for v in table.column(c).to_pylist()] for c in columns]
    return Counter(zip(*picked)) if picked else Counter()


def _type(arrow_type) -> str:
    text = str(arrow_type)
    return {"large_string": "string", "string_view": "string"}.get(text, text).split("[")[0]


def compare(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> tuple[int, list[str]]:
    """Number of Spark rows and the differences: names, types, values."""
    mine = df.toArrow()
    theirs = con.execute(sql).to_arrow_table()
    names = sorted(mine.column_names)
    if names != sorted(theirs.column_names):
        return mine.num_rows, [f"columns {names} != {sorted(theirs.column_names)}"]
    faults = [f"{c}: {mine.schema.field(c).type} != {theirs.schema.field(c).type}" for c in names
              if _type(mine.schema.field(c).type) != _type(theirs.schema.field(c).type)]
    a, b = _rows(mine, names), _rows(theirs, names)
    if a != b:
        faults.append(f"{mine.num_rows} rows, {sum((a - b).values())} only in Spark {list((a - b))[:2]};"
                      f" {theirs.num_rows} rows, {sum((b - a).values())} only in SQL {list((b - a))[:2]}")
    return mine.num_rows, faults


def main(argv: list[str]) -> int:
    from martloom.session import build_session

    sf_dir, names = argv[0], argv[1:] or list(QUERIES)
    spark = build_session("check", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", "spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = duck(sf_dir), 0
    for name in names:
        start = time.time()
        try:
            n, faults = compare(QUERIES[name](spark, sf_dir), con, ORACLE[name])
        except Exception as e:  # noqa: BLE001 - report and go on
            n, faults = 0, [f"{type(e).__name__}: {str(e)[:1500]}"]
        bad += bool(faults)
        print(f"{'FAIL' if faults else 'ok  '} {name:32s} {n:8d} rows {time.time() - start:6.2f} s", *faults, sep="\n     " if faults else " ", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]) > 0)
