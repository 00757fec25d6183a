"""Write PLANS.md: the final (post-AQE) physical plan of each headline query.

    python tests/plan_report.py [sf_dir]

Each query runs into the ``noop`` sink first so the adaptive plan is final
(join strategies chosen from runtime sizes, shuffle reads coalesced).
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from bench import HEADLINE  # noqa: E402
from ladle.plans import queries  # noqa: E402
from ladle.session import build_session  # noqa: E402

_ID = re.compile(r"#\d+L?")


def final_plan(df) -> str:
    df.collect()  # runs this DataFrame's own QueryExecution, so the plan is final
    text = df._jdf.queryExecution().executedPlan().toString()
    if "== Initial Plan ==" in text:
        text = text.split("+- == Initial Plan ==")[0]
    lines = []
    for line in text.splitlines():
        line = _ID.sub("", line)
        if len(line) > 150:
            line = line[:147] + "..."
        lines.append(line)
    return "\n".join(lines)


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[*]", 8)
    qs = queries()
    out = ["# Final physical plans of the headline queries", "",
           f"Generated by `tests/plan_report.py` at `{sf}` (8 shuffle partitions, AQE on).",
           "Plans of the Q7 and ALS queries start from checkpointed or materialised tables, so",
           "their earlier stages appear as `Scan ExistingRDD` / `Scan parquet` of those tables.", ""]
    for name in HEADLINE:
        out += [f"## {name}", "", "```", final_plan(qs[name](spark, sf)), "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
