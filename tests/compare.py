"""Run catalog queries and their SQL on the same tables and compare all values."""

import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        if Path(f"{sf_dir}/{t}.parquet").exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _value(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    return repr(v)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_value(r[i]) for i in order) for r in rows)


def differences(df, con, sql: str, show: int = 3) -> str:
    """Empty when both sides have the same columns and the same rows."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    expected = _rows(names, result.fetchall())
    found = _rows(df.columns, df.collect())
    if found == expected:
        return ""
    a, b = set(found), set(expected)
    return (
        f"{len(found)} rows against {len(expected)}\n"
        f"  only Spark:  {sorted(a - b)[:show]}\n  only SQL:    {sorted(b - a)[:show]}"
    )
