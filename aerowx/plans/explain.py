"""Write the final plans of two headline queries (PLANS.md).

``python -m aerowx.plans.explain [sf_dir] [out.md]`` — broadcasts are off, so
the plans show the shuffle path that large inputs take; they are taken after
execution and so show AQE's choices.
"""

from __future__ import annotations

import re
import sys
from collections import Counter

from aerowx.operators.packed import widen_packed
from aerowx.plans import preprocess as PP
from aerowx.session import get_spark
from aerowx.sources import fixtures as FX


def final_plan(df) -> tuple[int, str]:
    """Run ``df`` through its own query execution (so the adaptive plan is
    finalized) and return (rows, final plan)."""
    rows = df._jdf.queryExecution().toRdd().count()  # counted on the executors
    plan = df._jdf.queryExecution().executedPlan().toString()
    return rows, plan.split("\n+- == Initial Plan ==")[0]  # subqueries have one of their own


def operators(plan: str) -> str:
    names = re.findall(r"^[\s:+\-*()\d]*([A-Z]\w+)", plan, re.M)
    return ", ".join(f"{n} {k}" for k, n in Counter(names).most_common() if re.search("Join|Exchange|Agg|Sort|Scan|Read|Window", k))


def main(sf_dir: str = "/root/testdata/sf0.01", out: str = "PLANS.md") -> None:
    off = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    spark = get_spark("aerowx-explain", master="local[8]", shuffle_partitions=16,
                      conf={"spark.ui.showConsoleProgress": "false", "spark.sql.maxMetadataStringLength": "80",
                            "spark.sql.debug.maxToStringFields": "12"} | off)
    p = PP.prepare(FX.flights(spark, sf_dir), FX.weather(spark, sf_dir), FX.stations(spark, sf_dir))
    items = [
        ("hourly observations", p.observations),
        ("learning table: lists stored in buckets, hash tables per partition",
         widen_packed(PP.packed_windows(p, colocate=True, persist_lists=True))),
        ("learning table: hot keys spread", widen_packed(PP.packed_windows(p, hot_share=0.002))),
    ]
    parts = [f"# Final plans, broadcasts off ({sf_dir})\n\nGenerated by `python -m aerowx.plans.explain`.\n"]
    for title, df in items:
        rows, plan = final_plan(df)
        plan = "\n".join(line[:160] for line in plan.splitlines())
        parts.append(f"\n## {title} ({rows} rows)\n\n{operators(plan)}\n\n```\n{plan}\n```\n")
    with open(out, "w") as fh:
        fh.write("".join(parts))
    spark.stop()


if __name__ == "__main__":
    main(*sys.argv[1:])
