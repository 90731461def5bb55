"""Tables and comparisons for tests."""

from __future__ import annotations

import os

import duckdb

SF = "/root/testdata/sf0.001"


def connection(folder: str = SF) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in os.listdir(folder):
        path = f"{folder}/{name}"
        con.execute(f"CREATE VIEW {name[:-8]} AS SELECT * FROM '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    return con


def normal(frame) -> list[str]:
    """Rows as sorted text, columns by name."""
    frame = frame.reindex(sorted(frame.columns), axis=1).astype(object)
    rows = frame.where(frame.notna(), None).itertuples(index=False, name=None)
    return sorted(repr([int(x) if isinstance(x, float) and x.is_integer() else x for x in r]) for r in rows)


def same(spark, query, sql: str, folder: str = SF) -> None:
    ours, theirs = query(spark, folder).toPandas(), connection(folder).execute(sql).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert normal(ours) == normal(theirs)
