"""Run a query and its SQL side by side, as the driver does."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb


def _plain(x):
    if x is None or (isinstance(x, float) and math.isnan(x)):
        return None
    if isinstance(x, float):
        return round(x, 9)
    if isinstance(x, (list, tuple)):
        return tuple(map(_plain, x))
    if isinstance(x, dict):
        return tuple((k, _plain(v)) for k, v in x.items())
    if hasattr(x, "asDict"):
        return _plain(x.asDict())
    if isinstance(x, (bytearray, memoryview)):
        return bytes(x)
    return x


def duck_rows(sql: str, sf_dir: str) -> tuple[list[str], Counter]:
    con = duckdb.connect()
    for p in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p if p.is_file() else f'{p}/*.parquet'}')")
    got = con.sql(sql)
    names = got.columns
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(names), Counter(tuple(_plain(r[i]) for i in order) for r in got.fetchall())


def spark_rows(df) -> tuple[list[str], Counter]:
    names = sorted(df.columns)
    return names, Counter(tuple(_plain(r[c]) for c in names) for r in df.collect())


def differences(df, sql: str, sf_dir: str) -> str:
    """Empty if both sides give the same columns and rows."""
    a, x = spark_rows(df)
    b, y = duck_rows(sql, sf_dir)
    if a != b:
        return f"columns {a} and {b}"
    if x != y:
        return f"{sum(x.values())} and {sum(y.values())} rows; only here {list((x - y).items())[:3]}; only in SQL {list((y - x).items())[:3]}"
    return ""
