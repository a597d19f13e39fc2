"""Every registered query against its SQL twin; queries without one must at least run.

Set ORACLE_SF to run on another scale (the default keeps the suite short).
"""

import os

import pytest

import __spark_entry__ as entry
from tidemark.plans import tree_queries
from oracle import compare, duck

SF = os.environ.get("ORACLE_SF", "/root/testdata/sf0.001")
QUERIES, ORACLE = entry.plans.collect("QUERIES"), entry.plans.collect("ORACLE")
LARGER = "/root/testdata/sf0.01"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are not here")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


#: Fits that SQL cannot state; ``test_trees.py`` holds their operators against plain Python versions.
FITTED = set(tree_queries.QUERIES)


def test_every_query_has_a_twin():
    assert set(ORACLE) == set(QUERIES) - FITTED


@pytest.mark.parametrize("name", sorted(FITTED))
def test_fitted_query_runs(spark, name):
    rows = QUERIES[name](spark, SF).collect()
    assert all(r[c] is None or r[c] == r[c] for r in rows for c in r.asDict()) and rows


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, con, name):
    found = compare(QUERIES[name](spark, SF), con, ORACLE[name])
    if found == "EMPTY":  # too few rows here: an empty result proves nothing
        found = compare(QUERIES[name](spark, LARGER), duck(LARGER), ORACLE[name])
    assert found == ""


def test_flagship(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "bar" and len(df.columns) == 21
    assert df.count() > 0
