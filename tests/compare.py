"""Run registered queries on both engines and compare rows."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = Path(sf_dir) / f"{t}.parquet"
        if path.exists():
            con.execute(f"create view {t} as select * from '{path}'")
    return con


def _plain(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return 0.0 if v == 0 else v
    return v


def _rows(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr)


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    return sorted(df.columns), _rows(df.columns, df.collect())


def duck_rows(con, sql: str) -> tuple[list[str], list[tuple]]:
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    return sorted(names), _rows(names, cur.fetchall())


def kinds(rows: list[tuple]) -> list[set]:
    """Python types by column, without nulls."""
    if not rows:
        return []
    return [{type(r[i]).__name__ for r in rows if r[i] is not None} for i in range(len(rows[0]))]


def difference(df, con, sql: str) -> str | None:
    """None if equal, else what differs."""
    names, ours = spark_rows(df)
    other_names, theirs = duck_rows(con, sql)
    if names != other_names:
        return f"columns {names} / {other_names}"
    if len(ours) != len(theirs):
        return f"rows {len(ours)} / {len(theirs)}"
    if kinds(ours) != kinds(theirs):
        bad = [
            (n, a, b) for n, a, b in zip(names, kinds(ours), kinds(theirs), strict=True) if a != b
        ]
        return f"types {bad}"
    pairs = [(a, b) for a, b in zip(ours, theirs, strict=True) if a != b]
    if pairs:
        return f"{len(pairs)} of {len(ours)} rows differ, first {pairs[0]}, columns {names}"
    return None
