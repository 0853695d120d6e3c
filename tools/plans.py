"""Write PLANS.md: the physical plans of both jobs as planned at scale
(broadcasts disabled, as when no side is small), expression ids stripped.

  python tools/plans.py [sf_dir]
"""

from __future__ import annotations

import os
import re
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from namewright.operators.docs import bundled_docs  # noqa: E402
from namewright.plans import jobs  # noqa: E402
from namewright.sinks import writers  # noqa: E402
from namewright.session import local_session  # noqa: E402
from namewright.sources import fixture_views as fv  # noqa: E402


def clean(plan: str) -> str:
    plan = re.sub(r"#\d+L?", "", plan)
    plan = re.sub(r", \[plan_id=\d+\]", "", plan)
    plan = re.sub(r"Location: InMemoryFileIndex\(1 paths\)\[[^\]]*\]", "Location: <table>", plan)
    return "\n".join(line[:220] for line in plan.splitlines())


def _depth(line: str) -> int:
    m = re.search(r"[A-Za-z*(]", line)
    return m.start() if m else len(line)


def fold_cached(plan: str) -> str:
    """Print each cached relation's own plan once, elsewhere: drop the lines
    nested under an ``InMemoryRelation``."""
    out, skip_below = [], None
    for line in plan.splitlines():
        d = _depth(line)
        if skip_below is not None:
            if d > skip_below:
                continue
            skip_below = None
        if "InMemoryRelation" in line:
            out.append(line + "  <per-curve result, below>")
            skip_below = d
            continue
        out.append(line)
    return "\n".join(out)


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8, 16, extra={"spark.sql.autoBroadcastJoinThreshold": "-1",
                                        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"})
    d = tempfile.mkdtemp(prefix="namewright-plans-", dir="/tmp")
    for name, df in fv.all_views(spark, sf).items():
        df.write.parquet(f"{d}/{name}")
    t = lambda n: spark.read.parquet(f"{d}/{n}")
    run = jobs.stage(t("object_meta"), t("load_set_curve"), t("curve_dict"), t("curve_rule"), persist=True)
    flags = run.flags
    stage_plan = clean(run.staged._jdf.queryExecution().executedPlan().toString())
    # the persisted per-curve result is printed once, on its own
    cached = clean(flags._jdf.queryExecution().executedPlan().toString())
    stage_plan = fold_cached(stage_plan)
    docs = writers.framed(bundled_docs(t("object_meta"), t("load_set_curve"), t("curve_name"), 8), 64 << 20)
    docs_plan = clean(docs._jdf.queryExecution().executedPlan().toString())
    run.release()
    one = jobs.stage(t("object_meta"), t("load_set_curve"), t("curve_dict"), t("curve_rule"), load_set_ids=[1])
    one_plan = clean(one.flags._jdf.queryExecution().executedPlan().toString())
    out = ["# Physical plans (broadcasts disabled, as at scale)", "",
           "Generated by `tools/plans.py`; expression ids stripped. AQE re-plans at run time",
           "(coalescing, runtime broadcast when a side is measured small).", "",
           "## JOB1 staged rows (`run_staging`), above the persisted per-curve result", "", "```",
           stage_plan, "```", "", "## JOB1 per-curve result (persisted once)", "", "```", cached, "```", "",
           "## JOB1 per-curve result of one load set (other sets' rows go at the scan, by the broadcast bits)", "", "```",
           one_plan, "```", "", "## JOB2 framed documents on 8 bundles (`run_export`)", "", "```", docs_plan, "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
