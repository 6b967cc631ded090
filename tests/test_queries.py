"""Every registered query with SQL is compared with DuckDB on the smallest tables."""

import datetime
import decimal
import math
import os

import duckdb
import pytest

from refectory import registry

from .conftest import DATA

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    c.sql("SET TimeZone='UTC'")
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return c


def shown(v):
    return v.isoformat() if isinstance(v, (datetime.date, datetime.datetime)) else str(v)


def is_float(v):
    return isinstance(v, (float, decimal.Decimal))


def parted(rows):
    """Rows as (exact values, floats), sorted by the exact ones first."""
    out = [(tuple("" if is_float(v) else shown(v) for v in r), tuple(float(v) for v in r if is_float(v))) for r in rows]
    return sorted(out)


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    df = registry.queries()[name](spark, DATA)
    want = duck.sql(registry.oracle_sql()[name])
    cols = sorted(df.columns)
    assert cols == sorted(want.columns)
    at = [want.columns.index(c) for c in cols]
    got, expected = parted([r[c] for c in cols] for r in df.collect()), parted([x[i] for i in at] for x in want.fetchall())
    assert [k for k, _ in got] == [k for k, _ in expected]
    # sums of floats depend on the order of addition, and a rounded one on its last digit
    assert all(math.isclose(a, b, rel_tol=2e-5, abs_tol=1e-6) for (_, x), (_, y) in zip(got, expected, strict=True) for a, b in zip(x, y, strict=True))
