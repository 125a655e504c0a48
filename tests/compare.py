"""Compare a Spark result with DuckDB's answer to the check SQL."""

import math
from collections import Counter

import duckdb

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def connect(sf_dir):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return repr(value)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_cell(r[i]) for i in order) for r in rows)


def differences(df, con, sql):
    """An empty text if both agree in columns, types and rows."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    expected, actual = _rows(names, cursor.fetchall()), _rows(df.columns, df.collect())
    if expected == actual:
        return ""
    return (
        f"{sum(actual.values())} rows against {sum(expected.values())}; "
        f"only Spark: {list((actual - expected).items())[:3]}; "
        f"only check: {list((expected - actual).items())[:3]}"
    )
