"""Exact, order-free comparison of a Spark result with a DuckDB result."""

import datetime
import math

import duckdb

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def connect(folder):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def _cell(v):
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, datetime.date):
        return v.isoformat()
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    return repr(v)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def differences(df, con, sql):
    """Empty when equal, else a short text."""
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    types = {c[0]: str(c[1]) for c in cur.description}
    loose = {n: t for n, t in types.items() if t.startswith("DECIMAL") or t == "HUGEINT"}
    if loose:
        return f"SQL result types to cast: {loose}"
    if sorted(names) != sorted(df.columns):
        return f"columns: only spark {set(df.columns) - set(names)}, only sql {set(names) - set(df.columns)}"
    expected, found = _rows(names, cur.fetchall()), _rows(df.columns, df.collect())
    if expected == found:
        return "" if expected else "both sides are empty"
    a, b = set(map(tuple, expected)), set(map(tuple, found))
    return (f"rows sql {len(expected)} spark {len(found)}; cols {sorted(names)}; "
            f"only sql {list(a - b)[:2]}; only spark {list(b - a)[:2]}")
