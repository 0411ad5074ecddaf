"""Every registered query against its DuckDB oracle on the sf0.001 driver tables."""

import os
import re
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.join(ROOT, "tools"))
SF = os.environ.get("CITYLAKE_TEST_SF", "/root/testdata/sf0.001")

import __spark_entry__ as E  # noqa: E402
from check_oracle import duck, rows_of  # noqa: E402

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")

QUERIES = E.queries()
SQL = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    """All but the optional training-data queries, which have tests of their own."""
    own = {n for n in QUERIES if n != "pipeline" and not re.match(r"op\d+_", n)}
    assert own <= set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    s = QUERIES[name](spark, SF).toPandas()
    d = con.execute(SQL[name]).df()
    assert sorted(s.columns) == sorted(d.columns)
    assert len(s) == len(d)
    assert rows_of(s) == rows_of(d)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and "agg_id" in df.columns
