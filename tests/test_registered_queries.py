"""Every registered query against its DuckDB twin on the small driver tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry_mod  # noqa: E402
from oracle_check import compare, duck  # noqa: E402

from kestrel.plans import catalog  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"
QUERIES = catalog.queries()
ORACLE = catalog.oracle_sql()


def test_every_query_has_an_oracle():
    assert set(ORACLE) == set(QUERIES)
    assert set(QUERIES) <= set(entry_mod.queries())


def test_entry_runs(spark):
    df = entry_mod.entry(spark)
    assert df.columns == ["entity_name", "entity_count", "avg_measure_fmt"]
    assert df.count() > 0


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    res = compare(spark, name, QUERIES[name], ORACLE.get(name), SF_DIR, con)
    assert res["cols_match"], res
    assert res["spark_rows"] == res["oracle_rows"], res
    assert res["values_match"], res
