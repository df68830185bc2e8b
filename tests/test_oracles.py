"""Every query that has SQL gives the same rows as DuckDB on the smallest tables."""

import math
import os

import duckdb
import pytest

from tidewatch import plans

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if v is None or v != v:
        return None
    if hasattr(v, "isoformat"):
        return v.isoformat()[:19]
    if isinstance(v, bool):
        return v
    if isinstance(v, (int, float)) or type(v).__name__ == "Decimal":
        return round(float(v), 6)
    return v


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return sorted((tuple(plain(r[k]) for k in order) for r in data), key=repr)


@pytest.fixture(scope="session")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(plans.oracle_sql()))
def test_same_as_sql(spark, duck, name):
    df = plans.queries()[name](spark, SF)
    got = rows(df.columns, df.collect())
    cur = duck.execute(plans.oracle_sql()[name])
    want = rows([d[0] for d in cur.description], cur.fetchall())
    assert sorted(df.columns) == sorted(d[0] for d in cur.description)
    assert len(got) == len(want)
    for a, b in zip(got, want):
        assert all(x == y or (isinstance(x, float) and isinstance(y, float) and math.isclose(x, y, rel_tol=1e-5, abs_tol=2e-6)) for x, y in zip(a, b)), (a, b)


@pytest.mark.parametrize("name", sorted(set(plans.queries()) - set(plans.oracle_sql())))
def test_without_sql_runs_twice_alike(spark, name):
    f = plans.queries()[name]
    one, two = (rows(d.columns, d.collect()) for d in (f(spark, SF), f(spark, SF)))
    assert one and one == two


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 9
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
