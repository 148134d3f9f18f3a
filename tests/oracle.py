"""Compare Spark results with DuckDB running the equivalent SQL on the same tables."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, float):
        return v + 0.0  # -0.0 -> 0.0
    if isinstance(v, list):
        return tuple(_plain(x) for x in v)
    return v


def _rows(columns: list[str], data) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    rows = [tuple(_plain(r[i]) for i in order) for r in data]
    rows.sort(key=lambda r: tuple((x is not None, str(type(x)), x) if not isinstance(x, tuple) else (True, "", x) for x in r))
    return [columns[i] for i in order], rows


TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "float": "FLOAT",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
    "date": "DATE",
}


def compare(spark_df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when names, types, rows and values agree, else a description."""
    table = spark_df.toArrow()
    cols = table.column_names
    data = list(zip(*[c.to_pylist() for c in table.columns])) if table.num_rows else []
    got_cols, got = _rows(cols, data)
    rel = con.sql(sql)
    want_cols, want = _rows(rel.columns, rel.fetchall())
    if got_cols != want_cols:
        return f"columns {got_cols} != {want_cols}"
    types = {f.name: TYPES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in spark_df.schema.fields}
    wrong = [f"{c}: {types[c]} != {t}" for c, t in zip(rel.columns, map(str, rel.types)) if types[c] != t]
    if wrong:
        return "types " + ", ".join(wrong)
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    return f"{len(bad)} rows differ of {len(got)}, first {bad[0]}" if bad else None
