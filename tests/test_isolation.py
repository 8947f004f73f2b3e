"""The driver contract works from any working directory: Python workers get
the package (title UDF, footer reader) through the entry module."""

from __future__ import annotations

import os
import subprocess
import sys
import tempfile

import pytest
from conftest import ROOT

SCRIPT = """
import importlib.util
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
spec = importlib.util.spec_from_file_location("e", {entry!r})
m = importlib.util.module_from_spec(spec); spec.loader.exec_module(m)
q = m.queries()
n1 = len(q["q07_title_unescape"](spark, "/root/testdata/sf0.001").collect())
n2 = len(q["q35_shard_report"](spark, "/root/testdata/sf0.001").collect())
print("OK", n1, n2)
"""


def test_entry_from_foreign_cwd():
    cwd = tempfile.mkdtemp(prefix="metalake-cwd-")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT.format(entry=os.path.join(ROOT, "__spark_entry__.py"))],
                         cwd=cwd, env=env, capture_output=True, text=True, timeout=600)
    assert "OK" in out.stdout, out.stderr[-2000:]


BLOCKED = """
import importlib.util, sys, warnings
class Without:
    def find_spec(self, name, path=None, target=None):
        if name.split(".")[0] in {blocked!r} or name in {blocked!r}:
            raise ModuleNotFoundError(f"No module named {{name!r}}", name=name)
sys.meta_path.insert(0, Without())
spec = importlib.util.spec_from_file_location("e", {entry!r})
m = importlib.util.module_from_spec(spec)
with warnings.catch_warnings(record=True) as said:
    warnings.simplefilter("always")
    spec.loader.exec_module(m)
print(len(m.queries()), len(m.oracle_sql()), [str(w.message) for w in said if "training-data" in str(w.message)])
"""


@pytest.mark.parametrize("blocked, warned", [(["xxhash"], True), (["corpus_pipeline"], False), (["metalake.llm"], False)])
def test_entry_without_the_optional_part(blocked, warned):
    from metalake.registry import ORACLE, QUERIES
    out = subprocess.run([sys.executable, "-c", BLOCKED.format(blocked=blocked, entry=os.path.join(ROOT, "__spark_entry__.py"))],
                         capture_output=True, text=True, timeout=120)
    assert out.stdout.startswith(f"{len(QUERIES)} {len(ORACLE)} ["), out.stderr[-2000:]
    assert ("xxhash" in out.stdout) == warned


def test_scratch_is_cleared(spark):
    from metalake.session import clear_scratch, kept, local_path, scratch_root
    app = scratch_root(spark)
    df = kept(spark.range(5), "x")
    assert df.count() == 5 and os.path.isdir(local_path(app))
    clear_scratch(spark)
    assert not os.path.exists(local_path(app)) and kept(spark.range(3), "y").count() == 3
