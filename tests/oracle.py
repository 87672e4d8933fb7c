"""Compares registered queries with their SQL, as the driver does."""

from __future__ import annotations

import math
import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path}/*.parquet'" if os.path.isdir(path) else f"CREATE VIEW {t} AS SELECT * FROM '{path}'")
    return con


def _plain(x):
    if isinstance(x, float):
        return None if math.isnan(x) else float(repr(x + 0.0))
    if isinstance(x, (list, tuple)):
        return tuple(map(_plain, x))
    if isinstance(x, dict):
        return tuple(sorted((k, _plain(v)) for k, v in x.items()))
    if type(x).__name__ == "Decimal":
        return float(x)
    return x


def rows(columns: list[str], found) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in found), key=repr)


def same(a: tuple, b: tuple) -> bool:
    """Equal, but for doubles that fell on two sides of a rounding step."""
    return all(x == y or isinstance(x, float) and isinstance(y, float) and abs(x - y) <= 2e-9 * max(1, abs(x)) for x, y in zip(a, b, strict=True))


def compare(df, con, sql: str) -> str:
    """'' if the rows agree, else what differs."""
    got = rows(df.columns, df.collect())
    query = con.execute(sql)
    names = [d[0] for d in query.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} and {sorted(names)}"
    want = rows(names, query.fetchall())
    if len(got) != len(want):
        return f"{len(got)} and {len(want)} rows, such as {got[:2]} and {want[:2]}"
    bad = [(a, b) for a, b in zip(got, want, strict=True) if not same(a, b)]
    return f"{len(bad)} of {len(got)} rows, such as {bad[:2]}" if bad else ""
