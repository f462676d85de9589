"""Compare the Spark form of queries with their SQL form in DuckDB."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

from leasewise.plans.bindings import TABLES


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _plain(v):
    if isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, float):
        return 0.0 if v == 0 else v
    return v


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = [tuple(_plain(r[i]) for i in order) for r in rows]
    return [names[i] for i in order], sorted(plain, key=lambda r: tuple((v is not None, str(v)) for v in r))


def difference(df, con, sql: str) -> str | None:
    """None when both give the same rows, else a short description."""
    names, got = _rows(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    other, want = _rows([d[0] for d in cur.description], cur.fetchall())
    if names != other:
        return f"columns {names} / {other}"
    if len(got) != len(want):
        extra = sorted(set(got) - set(want), key=str)[:2], sorted(set(want) - set(got), key=str)[:2]
        return f"rows {len(got)} / {len(want)}; spark only, sql only: {extra}"
    if got != want:
        left, right = Counter(got) - Counter(want), Counter(want) - Counter(got)
        first = lambda c: sorted(c, key=str)[:2]
        return f"{sum(left.values())} rows differ in {names}; spark: {first(left)}; sql: {first(right)}"
    return None
