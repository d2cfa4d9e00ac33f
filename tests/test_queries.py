"""Every registered query beside its SQL, on the smallest tables."""

import pytest
from oracle import connect, differences

from __spark_entry__ import entry, oracle_sql, queries

FOLDER = "/root/testdata/sf0.001"
SQLS = oracle_sql()


@pytest.fixture(scope="module")
def db():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, db, name):
    df = queries()[name](spark, FOLDER)
    if name in SQLS:
        assert differences(df, db, SQLS[name]) == ""
    else:
        assert df.count() > 0


def test_entry(spark):
    assert entry(spark).count() > 0


def test_facets_shuffle_once(spark):
    plan = queries()["filter_not"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    counted = queries()["facets_parts"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    # One exchange of partial counts, one more to choose the spelling of a keyword.
    assert counted.count("Exchange hashpartitioning") == 2
