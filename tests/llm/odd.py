"""Comparison of registered queries with their DuckDB statements."""

import duckdb

from chartframes.llm import queries


def against_duckdb(spark, name, folder):
    base = duckdb.connect()
    for table in ("documents", "benchmark", "labels", "embeddings", "conversations"):
        base.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    got = queries.QUERIES[name](spark, folder)
    want = base.execute(queries.ORACLES[name])
    columns = [c[0] for c in want.description]
    assert sorted(got.columns) == sorted(columns)
    rows = [tuple(r) for r in got.select(*columns).collect()]
    assert sorted(rows, key=str) == sorted(want.fetchall(), key=str)
    return rows
