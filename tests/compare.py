"""Rows of a query and of its SQL, in a form that can be compared."""

from __future__ import annotations

from collections import Counter
from decimal import Decimal

import duckdb

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def _plain(x):
    if isinstance(x, Decimal):
        x = float(x)
    return round(x, 9) if isinstance(x, float) else x


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def sql_rows(sf_dir, sql):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    got = con.execute(sql)
    return rows_of([d[0] for d in got.description], got.fetchall())
