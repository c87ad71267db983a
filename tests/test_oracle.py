"""Every registered query against its DuckDB SQL (sf0.001), plus the
driver contract of ``__spark_entry__``."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
from conftest import SF_SMALL  # noqa: E402
from fadeclust.plans.queries import QUERIES  # noqa: E402
from oracle_check import duck, rows_of  # noqa: E402

NAMES = sorted(QUERIES)   # the optional training-data queries have tests of their own


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["batch_id", "label", "dim", "center", "weight"]


def test_every_query_has_sql_or_is_listed():
    assert set(QUERIES) <= set(entry.queries())
    no_sql = set(QUERIES) - set(entry.oracle_sql())
    assert no_sql == set(), no_sql


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, con, name):
    got = entry.queries()[name](spark, SF_SMALL).toPandas()
    exp = con.sql(entry.oracle_sql()[name]).df()
    gc, gr = rows_of(got)
    ec, er = rows_of(exp)
    assert gc == ec
    assert len(gr) == len(er)
    assert gr == er
