"""Compare a query with its SQL, run by DuckDB on the same files."""

from __future__ import annotations

from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        path = Path(folder) / f"{table}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}')")
    return con


def _order(row):
    return tuple((value is None, type(value).__name__, str(value)) for value in row)


def rows_of_frame(df):
    names = sorted(df.columns)
    table = df.select(*[f"`{n}`" for n in names]).toArrow()
    return names, [tuple(r[n] for n in names) for r in table.to_pylist()]


def rows_of_sql(con, sql):
    table = con.execute(sql).to_arrow_table()
    names = sorted(table.column_names)
    return names, [tuple(r[n] for n in names) for r in table.to_pylist()]


def difference(df, con, sql) -> str | None:
    """None when both give the same columns and the same multiset of rows."""
    left_names, left = rows_of_frame(df)
    right_names, right = rows_of_sql(con, sql)
    if left_names != right_names:
        return f"columns {left_names} != {right_names}"
    if len(left) != len(right):
        return f"{len(left)} rows != {len(right)}"
    left, right = sorted(left, key=_order), sorted(right, key=_order)
    wrong = [(a, b) for a, b in zip(left, right) if a != b or [type(x) for x in a] != [type(x) for x in b]]
    return f"{len(wrong)} rows differ, first {wrong[0]}" if wrong else None
