"""Run a query and its SQL twin and compare columns, types and rows."""

from __future__ import annotations

import glob
import math
import os
from collections import Counter

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _kind(type_name: str) -> str:
    return str(type_name).replace("large_string", "string").replace("dictionary", "string")


def _cell(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "NaN"
        return value + 0.0
    return value


def _rows(table) -> Counter:
    names = sorted(table.column_names)
    columns = [[_cell(v) for v in table.column(n).to_pylist()] for n in names]
    return Counter(zip(*columns, strict=True))


def differences(df, con, sql: str) -> list[str]:
    """What differs; empty if nothing does."""
    got = df.toArrow()
    want = con.sql(sql).to_arrow_table()
    found = []
    if sorted(got.column_names) != sorted(want.column_names):
        return [f"columns {sorted(got.column_names)} != {sorted(want.column_names)}"]
    for name in sorted(got.column_names):
        left, right = _kind(got.schema.field(name).type), _kind(want.schema.field(name).type)
        if left != right and not ("timestamp" in left and "timestamp" in right):
            found.append(f"type of {name}: {left} != {right}")
    if got.num_rows != want.num_rows:
        found.append(f"rows {got.num_rows} != {want.num_rows}")
    left, right = _rows(got), _rows(want)
    if left != right:
        found.append(f"values: only ours {list((left - right))[:2]}, only theirs {list((right - left))[:2]}")
    return found
