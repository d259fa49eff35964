"""Run a registered query and its SQL check and compare types and values."""

from __future__ import annotations

import decimal
import math

import duckdb
import pyarrow as pa

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _kind(t: pa.DataType) -> str:
    if pa.types.is_timestamp(t):
        return "timestamp" if t.tz is None else f"timestamp[{t.tz}]"
    if pa.types.is_string(t) or pa.types.is_large_string(t):
        return "string"
    return str(t)


def _value(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v + 0.0
    if isinstance(v, decimal.Decimal):
        return float(v)
    return v


def _rows(t: pa.Table, names: list[str]) -> list[tuple]:
    columns = [t.column(n).to_pylist() for n in names]
    rows = [tuple(map(_value, r)) for r in zip(*columns)]
    return sorted(rows, key=repr)


def differences(spark_table: pa.Table, sql_table: pa.Table) -> list[str]:
    a, b = sorted(spark_table.column_names), sorted(sql_table.column_names)
    if a != b:
        return [f"columns differ: {sorted(set(a) ^ set(b))}"]
    out = []
    for n in a:
        x, y = _kind(spark_table.schema.field(n).type), _kind(sql_table.schema.field(n).type)
        if x != y:
            out.append(f"{n}: {x} against {y}")
    if spark_table.num_rows != sql_table.num_rows:
        out.append(f"rows: {spark_table.num_rows} against {sql_table.num_rows}")
        return out
    left, right = _rows(spark_table, a), _rows(sql_table, a)
    bad = [(x, y) for x, y in zip(left, right) if x != y]
    if bad:
        x, y = bad[0]
        first = {n: (p, q) for n, p, q in zip(a, x, y) if p != q}
        out.append(f"{len(bad)} rows differ, first: {first} in {x[:4]}")
    return out
