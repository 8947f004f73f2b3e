from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

from metalake.session import build_session  # noqa: E402

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    # Scratch output goes under the session's spark.checkpoint.dir; when the
    # session names none, metalake.session registers a private temp folder.
    s = build_session("local[4]", shuffle_partitions=4)
    yield s


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="metalake-t-")


def rows(df, *cols):
    """Collected rows as tuples (optionally only ``cols``)."""
    if cols:
        df = df.select(*cols)
    return [tuple(r) for r in df.collect()]


def one(df, col):
    """Single value of ``col`` from a one-row DataFrame."""
    return df.select(col).collect()[0][0]
