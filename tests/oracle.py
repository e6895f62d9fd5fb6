"""Exact comparison of a Spark result with a DuckDB result: columns sorted by
name, rows compared as multisets of exact values."""

from __future__ import annotations

import math

import duckdb

from tidemark.sources.tables import TABLES


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float) and math.isnan(v):
        return "NaN"
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def canonical(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


def same_result(df, con, sql) -> tuple[bool, str]:
    srows, snames = df.collect(), df.columns
    res = con.execute(sql)
    dnames = [d[0] for d in res.description]
    drows = res.fetchall()
    if sorted(snames) != sorted(dnames):
        return False, f"columns differ: {sorted(snames)} vs {sorted(dnames)}"
    a, b = canonical(snames, srows), canonical(dnames, drows)
    if a != b:
        return False, f"rows differ: spark={len(a)} duck={len(b)}; e.g. {[r for r in a if r not in b][:2]}"
    return True, ""
