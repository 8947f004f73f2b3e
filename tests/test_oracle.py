"""Every driver query against its DuckDB SQL at sf0.01 (the driver's gate),
plus the entry smoke check at sf0.001."""

from __future__ import annotations

import importlib.util
import os

import pytest
from conftest import ROOT, SF01

import oracle

spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
entry_mod = importlib.util.module_from_spec(spec)
spec.loader.exec_module(entry_mod)

from metalake.registry import ORACLE as SQL  # noqa: E402
from metalake.registry import QUERIES as BASE  # noqa: E402

QUERIES = {name: fn for name, fn in entry_mod.queries().items() if name in BASE}


@pytest.fixture(scope="module")
def con():
    return oracle.duck(SF01)


def test_every_query_has_oracle():
    assert set(SQL) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF01)
    assert oracle.type_mismatches(df, con, SQL[name]) == {}
    report = oracle.compare(df, con, SQL[name])
    assert report["ok"], report
    assert report["spark_rows"] >= 1


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert df.count() > 0
    assert df.schema == entry_mod.entry(spark).schema
