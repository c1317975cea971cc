"""Every registered query against its SQL oracle on the smallest driver scale."""

import datetime as dt
import os
from collections import Counter

import pytest

import __spark_entry__ as entry
from clickwave.plans.catalog import ORACLES, QUERIES
from tests.conftest import SF_SMALL

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_SMALL), reason="driver tables not present")


def _norm(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    def v(x):
        if isinstance(x, float):
            return round(x, 6)
        if isinstance(x, dt.datetime):
            return x.replace(tzinfo=None)
        return x
    return [cols[i] for i in order], Counter(tuple(v(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    import duckdb
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{SF_SMALL}/events.parquet')")
    return con


def test_registry_complete():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["item_id", "window_end", "cnt", "rank"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF_SMALL)
    s_cols, s_rows = _norm(df.columns, df.collect())
    res = duck.execute(entry.oracle_sql()[name])
    o_cols, o_rows = _norm([d[0] for d in res.description], res.fetchall())
    assert s_cols == o_cols
    assert s_rows == o_rows


@pytest.fixture(scope="module")
def empty_dir(spark):
    import shutil
    import tempfile
    d = tempfile.mkdtemp(prefix="clickwave-empty-")
    spark.read.parquet(f"{SF_SMALL}/events.parquet").limit(0).coalesce(1).write.parquet(f"{d}/_w")
    part = [f for f in os.listdir(f"{d}/_w") if f.endswith(".parquet")][0]
    shutil.copy(f"{d}/_w/{part}", f"{d}/events.parquet")
    return d


def test_queries_on_an_empty_table(spark, empty_dir):
    import duckdb
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{empty_dir}/events.parquet')")
    for name in QUERIES:
        df = entry.queries()[name](spark, empty_dir)
        res = con.execute(entry.oracle_sql()[name])
        assert sorted(df.columns) == sorted(d[0] for d in res.description), name
        assert df.count() == 0 == len(res.fetchall()), name
