"""Runs each query and its SQL on the same parquet files and compares the rows."""

import math
import time
from pathlib import Path

import duckdb
import pyarrow as pa


def sql_engine(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"create view {file.stem} as select * from read_parquet('{file}')")
    return con


def _plain_type(kind: pa.DataType) -> str:
    text = str(kind)
    return "string" if text in ("large_string", "string_view") else text


def _rows(table: pa.Table) -> list[tuple]:
    names = sorted(table.column_names)
    rows = zip(*[table.column(name).to_pylist() for name in names])
    return sorted(rows, key=lambda row: tuple((v is None, str(v)) for v in row))


def _same(a, b) -> bool:
    if isinstance(a, float) and isinstance(b, float):
        return a == b or (math.isnan(a) and math.isnan(b))
    return type(a) is type(b) and a == b


def compare(spark, con, query, sql: str, sf_dir: str) -> dict:
    start = time.perf_counter()
    ours = query(spark, sf_dir).toArrow()
    seconds = time.perf_counter() - start
    theirs = con.sql(sql).to_arrow_table()
    types = [{f.name: _plain_type(f.type) for f in t.schema} for t in (ours, theirs)]
    a, b = _rows(ours), _rows(theirs)
    same = len(a) == len(b) and all(len(x) == len(y) and all(map(_same, x, y)) for x, y in zip(a, b))
    return {
        "rows": len(a),
        "sql_rows": len(b),
        "types_match": types[0] == types[1],
        "types": types,
        "values_match": same,
        "first_difference": next(((x, y) for x, y in zip(a, b) if not all(map(_same, x, y))), None),
        "seconds": seconds,
    }
