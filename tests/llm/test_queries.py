import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
from oracle import duckdb_rows, rows_of  # noqa: E402

from fadeclust.llm.queries import ORACLE, QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    frame = QUERIES[name](spark, SF).toPandas()
    columns, rows = duckdb_rows(ORACLE[name], SF)
    assert sorted(frame.columns) == columns
    got = rows_of(frame)
    assert len(got) == len(rows) and got == rows
