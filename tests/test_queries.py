import duckdb
import pytest

import __spark_entry__ as entry
from check_queries import TABLES, bag
from mailloom.plans.oracle import ORACLE_SQL
from mailloom.plans.queries import all_queries

SF = "/root/testdata/sf0.001"
# Plans that hold a row-pair operator would compare all rows with all rows.
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin")
# The walk over open elements is the only Python function; it is in the plans that read data attributes.
WALK = "of(CASE WHEN"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def test_every_query_has_sql():
    assert set(all_queries()) == set(ORACLE_SQL)
    assert set(all_queries()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query_equals_sql(spark, con, name):
    df = all_queries()[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [f for f in FORBIDDEN if f in plan]
    assert plan.count("ArrowEvalPython") == plan.count("ArrowEvalPython [" + WALK) and "BatchEvalPython" not in plan
    cur = con.execute(ORACLE_SQL[name])
    theirs, columns = cur.fetchall(), [d[0] for d in cur.description]
    mine = df.collect()
    assert sorted(df.columns) == sorted(columns)
    assert bag(mine, df.columns) == bag(theirs, columns)
    assert mine


def test_entry(spark):
    assert entry.entry(spark).count() > 0
