"""Write the physical plans of key registered queries to docs/PLANS.md."""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from statlake.plans.registry import QUERIES  # noqa: E402
from statlake.session import get_spark  # noqa: E402

KEY = ["filter_codes", "cube_pages_tidy", "pivot_wide", "prefer_language", "fresh_metadata",
       "range_rollup", "page_gaps"]


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_spark("local[8]")
    out = ["# Physical plans of key queries", "",
           f"Generated by `tools/dump_plans.py` at `{sf}` (local[8], AQE on; plans before AQE re-planning).", ""]
    for name in KEY:
        df = QUERIES[name](spark, sf)
        plan = df._jdf.queryExecution().executedPlan().toString()
        out += [f"## {name}", "", "```", plan.strip(), "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "docs", "PLANS.md"),
              "w", encoding="utf-8") as f:
        f.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
