"""Compares a query with its SQL, on whole tables."""

import glob
import os

from cowrie.llm.queries import ORACLES, QUERIES

TABLES = "/root/testdata/sf0.01"


def same_as_sql(spark, name):
    import duckdb

    connection = duckdb.connect()
    for path in glob.glob(f"{TABLES}/*.parquet"):
        view = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {view} AS SELECT * FROM '{path}'")
    result = QUERIES[name](spark, TABLES)
    expected = connection.execute(ORACLES[name])
    names = [d[0] for d in expected.description]
    columns = sorted(names)
    at = [names.index(c) for c in columns]
    assert sorted(result.columns) == columns
    got = sorted(repr(list(r)) for r in result.select(*columns).collect())
    assert got == sorted(repr([r[i] for i in at]) for r in expected.fetchall())
