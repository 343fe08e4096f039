"""Write docs/PLANS.md: static physical plans (AQE off) of the headline queries at sf0.01."""

from __future__ import annotations

import os
import sys

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from bench import HEADLINE  # noqa: E402
from tidemark.catalog import QUERIES  # noqa: E402
from tidemark.session import local_session  # noqa: E402

SF = os.environ.get("PLANS_SF_DIR", "/root/testdata/sf0.01")


def main() -> None:
    spark = local_session()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    out = ["# Physical plans of the headline queries", "",
           f"Static plans (AQE off, so no runtime re-planning is shown) at `{SF}`, from `explain_plans.py`.",
           "Scans show `PushedFilters` / `ReadSchema`; `Exchange` marks each shuffle.",
           "Ordered per-key operators read the rows with their bucket from a written table, so their plans",
           "start at that table; the range exchange that fills it has run before.",
           "`incremental_sync` and `retention_delete` do their work in writes; their plans show the read-back.",
           ""]
    for name in HEADLINE:
        df = QUERIES[name](spark, SF)
        plan = df._jdf.queryExecution().executedPlan().toString()
        lines = [ln if len(ln) < 220 else ln[:217] + "..." for ln in plan.splitlines()]
        ex = [ln for ln in lines if "Exchange" in ln and "Reused" not in ln and "Broadcast" not in ln]
        assert not any("RoundRobinPartitioning" in ln for ln in ex), name
        out += [f"## {name}", "", f"Shuffle exchanges: {len(ex)}", "",
                "```", *lines, "```", ""]
    with open(os.path.join(ROOT, "docs", "PLANS.md"), "w") as fh:
        fh.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
