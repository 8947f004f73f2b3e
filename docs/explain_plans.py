"""Print the executed physical plan (after AQE) of the headline queries.

Usage: python docs/explain_plans.py [sf_dir]  -> operator skeleton per query.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from metalake.registry import QUERIES  # noqa: E402
from metalake.session import build_session  # noqa: E402

NAMES = ["q01_flatten_records", "q12b_dedup_records", "q16_new_clients", "q20_label_server_name",
         "q26_unify_shards", "q29_completeness", "q31_doi_join", "q32_growth_surge", "q34_page_chain"]
KEEP = re.compile(r"(Exchange|BroadcastExchange|BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|"
                  r"HashAggregate|SortAggregate|ObjectHashAggregate|WindowGroupLimit|Window |"
                  r"ArrowEvalPython|FileScan|Scan |Generate|Union|AQEShuffleRead|Expand)")


def skeleton(df) -> list[str]:
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().executedPlan().toString()
    out = []
    for line in plan.split("\n"):
        if KEEP.search(line):
            line = re.sub(r"#\d+L?", "", line)
            line = re.sub(r"\[plan_id=\d+\]", "", line)
            out.append(line[:150])
    return out


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", 16)
    for name in NAMES:
        print(f"## {name}\n```")
        print("\n".join(skeleton(QUERIES[name](spark, sf))))
        print("```\n")


if __name__ == "__main__":
    main()
