"""Benchmark the headline queries.

Runs at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` (default 8). Every run forces the full result through
the ``noop`` sink. One warm-up pass, then the median of ``$BENCH_RUNS``
(default 3) timed runs per query. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from metalake.registry import QUERIES  # noqa: E402
from metalake.session import build_session  # noqa: E402

HEADLINE = [
    "q01_flatten_records",
    "q12_dedup_richest",
    "q12b_dedup_records",
    "q20_label_server_name",
    "q26_unify_shards",
    "q29_completeness",
    "q32_growth_surge",
    "q37_stream_ingest",
]


def run_once(spark, name: str, sf_dir: str) -> float:
    t0 = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = build_session(f"local[{cpus}]", shuffle_partitions=max(cpus * 2, 8),
                          extra={"spark.driver.memory": "16g"})
    out = {}
    for name in names:
        run_once(spark, name, sf_dir)  # warm-up
        out[name] = round(statistics.median(run_once(spark, name, sf_dir) for _ in range(runs)), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "sum_median_sec_headline_queries", "value": round(sum(out.values()), 3),
                      "unit": "sec", "queries": out, "sf": sf, "cpus": cpus, "runs": runs}))
    spark.stop()


if __name__ == "__main__":
    main()
