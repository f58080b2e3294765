"""Every registered query against its SQL counterpart on the smallest test folder."""

import duckdb
import pytest

import __spark_entry__ as entry
from check import TABLES, canonical, family

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", entry.queries())
def test_query(spark, oracle, name):
    df = entry.queries()[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    rows = [tuple(r) for r in df.collect()]
    if name not in entry.oracle_sql():
        assert rows
        return
    result = oracle.execute(entry.oracle_sql()[name])
    columns, types = [d[0] for d in result.description], {d[0]: str(d[1]) for d in result.description}
    assert sorted(columns) == sorted(df.columns)
    assert {c: family(k) for c, k in df.dtypes} == {c: family(k) for c, k in types.items()}
    assert canonical(df.columns, rows) == canonical(columns, result.fetchall())


def test_entry_is_the_feature_table(spark):
    got = entry.entry(spark)
    assert got.count() > 1000 and {"heartrate_mean", "hematocrit_max", "mingcs", "exclusion_age"} <= set(got.columns)


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
