"""The queries that SQL can express, beside their SQL at sf0.01."""

from __future__ import annotations

import oracle
import pytest
from conftest import SF01

from metalake.llm.queries import ORACLE, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_its_sql(spark, name):
    con, df = oracle.duck(SF01), QUERIES[name](spark, SF01)
    assert oracle.type_mismatches(df, con, ORACLE[name]) == {}
    report = oracle.compare(df, con, ORACLE[name])
    assert report["ok"] and report["spark_rows"] >= 1, report
