"""Write PLANS.md: the physical plan of each job's main write, for review.

Usage: python tests/dump_plans.py [sf_dir]   (default /root/testdata/sf0.01)
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def _plan(df) -> str:
    text = df._jdf.queryExecution().executedPlan().toString()
    text = re.sub(r"#\d+L?", "", text)                       # expression ids
    text = re.sub(r"\[plan_id=\d+\]", "", text)
    text = re.sub(r"file:[^\]\s,]+", "<path>", text)
    return "\n".join(line[:220] for line in text.splitlines())


def main() -> None:
    from ledgerlake.operators import bronze as B
    from ledgerlake.operators import gold as G
    from ledgerlake.operators import monitor as M
    from ledgerlake.operators import quality as Q
    from ledgerlake.plans.lakehouse import Lakehouse
    from ledgerlake.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", extra={"spark.sql.shuffle.partitions": "8",
                                              "spark.sql.adaptive.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    lake = Lakehouse.of(spark, sf)
    p = "local"
    bronze = lake.bronze(p)
    valid, invalid = Q.split(Q.validate(bronze, p), p)
    sections = [
        ("ingest: topic -> bronze (no exchange)", B.bronze(lake.topic(), prefix="kafka")),
        ("quality: quarantine (no exchange)", Q.shape_quarantine(invalid, p)),
        ("quality: silver = dedup (one exchange, partial + final aggregate)",
         Q.shape_silver(Q.dedup(valid, ["transaction_id"], Q.survivor_order(p)), p)),
        ("gold: all five metric tables (by day, by merchant, and the small grain that three tables are added up from)",
         G.rolled_up_metrics(lake.risk_rows(p), p)),
        ("gold: one sorted table split out of the combined result",
         G.metric_from_all(lake.gold_all(p), "country", p)),
        ("monitor: the reconciliation record (footer counts, no payload read)",
         M.monitoring_record(lake.bronze(p), lake.silver(p), lake.quarantine(p),
                             lake.risk_rows(p))),
    ]
    out = ["# Physical plans", "",
           "Generated by `python tests/dump_plans.py` (AQE off so the static plan is "
           "shown; at run time AQE only coalesces post-shuffle partitions). "
           "`*(n)` marks whole-stage-codegen spans.", ""]
    for title, df in sections:
        out += [f"## {title}", "", "```", _plan(df), "```", ""]
    with open(os.path.join(ROOT, "PLANS.md"), "w") as fh:
        fh.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
