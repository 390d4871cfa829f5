"""Print the executed physical plan (after AQE) of registered queries, reduced
to the operator tree, for review:

    python tests/dump_plans.py /root/testdata/sf0.1 species_multipoint layer_tiles ...
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

KEEP = ("Exchange", "Join", "Aggregate", "Scan", "Broadcast", "Sort", "Window", "Generate", "Union",
        "TakeOrdered", "Limit", "Expand", "AQEShuffleRead", "Filter")


def tree(df) -> list[str]:
    plan = df._jdf.queryExecution().executedPlan().toString()
    out = []
    for line in plan.splitlines():
        if not any(k in line for k in KEEP):
            continue
        line = re.sub(r"#\d+L?", "", line)
        line = re.sub(r", \[plan_id=\d+\]", "", line)
        line = re.sub(r"Location: InMemoryFileIndex\([^)]*\)\[[^\]]*\]", "Location: ...", line)
        out.append(line[:200])
    return out


def main() -> None:
    from occurrence_lake.config import build_session
    from occurrence_lake.plans.driver_queries import QUERIES
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    names = sys.argv[2:] or ["species_multipoint", "scientific_names", "vernacular_names", "layer_tiles",
                             "acquire_polygon"]
    spark = build_session("local[8]")
    for name in names:
        df = QUERIES[name](spark, sf)
        df.write.format("noop").mode("overwrite").save()
        print(f"### {name}\n")
        print("```")
        print("\n".join(tree(df)))
        print("```\n")


if __name__ == "__main__":
    main()
