"""The operators that SQL can express, against DuckDB on the smallest tables."""

import os

import duckdb
import pytest

from refectory.llm import registry

from ..conftest import DATA
from ..test_queries import parted


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_operator_equals_sql(spark, name):
    c = duckdb.connect()
    for table in ("documents", "embeddings"):
        c.sql(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    df, want = registry.queries()[name](spark, DATA), c.sql(registry.oracle_sql()[name])
    cols = sorted(df.columns)
    assert cols == sorted(want.columns)
    at = [want.columns.index(x) for x in cols]
    got, expected = parted([r[x] for x in cols] for r in df.collect()), parted([x[i] for i in at] for x in want.fetchall())
    assert [k for k, _ in got] == [k for k, _ in expected]
    assert all(abs(a - b) <= 1e-6 * max(1, abs(b)) for (_, x), (_, y) in zip(got, expected, strict=True) for a, b in zip(x, y, strict=True))
