"""Compare a Spark result with its SQL oracle, value by value and in any order."""

import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def differences(con, sql: str, df) -> list[str]:
    """Human-readable differences, empty when both results are identical."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    expected = _rows(names, result.fetchall())
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    actual = _rows(df.columns, [tuple(row) for row in df.collect()])
    if len(actual) != len(expected):
        return [f"{len(actual)} rows != {len(expected)}"]
    return [f"{a} != {b}" for a, b in zip(actual, expected) if repr(a) != repr(b)][:3]
