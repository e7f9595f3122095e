"""Rows of a Spark query and of its SQL in DuckDB, in a common form."""

import os

import duckdb

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")
SMALL = "/root/testdata/sf0.001"


def _rows(table):
    names = sorted(table.column_names)
    columns = [table.column(n).to_pylist() for n in names]
    return names, sorted(repr(tuple(round(x, 6) + 0.0 if isinstance(x, float) else x for x in row)) for row in zip(*columns))


def oracle(sql, sf_dir=SMALL):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p if os.path.isfile(p) else p + '/*.parquet'}')")
    found = con.sql(sql).arrow()
    return _rows(found if hasattr(found, "column_names") else found.read_all())


def of_spark(df):
    return _rows(df.toArrow())
