"""Rows of a query against those of its SQL, as the order of columns and rows doesn't matter."""

from __future__ import annotations

import decimal
import math
import os

NAMES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    if isinstance(value, decimal.Decimal):
        return round(float(value), 9)
    if isinstance(value, list | tuple):
        return [plain(v) for v in value]
    return value


def rows(columns: list[str], data) -> list[str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr([plain(r[i]) for i in order]) for r in data)


def difference(spark, sf_dir: str, run, sql: str) -> str | None:
    """None if both have the same columns and rows, else the first that differ."""
    import duckdb

    con = duckdb.connect()
    for n in NAMES:
        if os.path.exists(f"{sf_dir}/{n}.parquet"):
            con.execute(f"CREATE VIEW {n} AS SELECT * FROM '{sf_dir}/{n}.parquet'")
    df = run(spark, sf_dir)
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} and {sorted(names)}"
    a, b = rows(df.columns, [tuple(r) for r in df.collect()]), rows(names, cur.fetchall())
    if a == b:
        return None
    x, y = [r for r in a if r not in set(b)], [r for r in b if r not in set(a)]
    return f"{len(a)} and {len(b)} rows; only here {x[:3]}; only in SQL {y[:3]}"
