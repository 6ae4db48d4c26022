"""Condensed executed plans for review::

    python -m editstream.plans.explain /root/testdata/sf0.1 > PLANS.md

Each query is run once (on the JVM) so the adaptive plan is final; only the
operators that matter for scale are kept (exchanges, aggregates, joins,
limits, window limits, scans with their pushed filters and read schema).
"""

from __future__ import annotations

import re
import sys

KEEP = ("Exchange", "Aggregate", "Join", "TakeOrderedAndProject", "WindowGroupLimit", "Window ",
        "BroadcastExchange", "Subquery", "ReusedExchange", "FileScan", "Union", "Sort [", "Limit")


def condensed(df) -> list[str]:
    # Execute this DataFrame's own plan on the JVM (rows are counted there, not
    # returned), so the adaptive plan printed below is the final one.
    executed = df._jdf.queryExecution().executedPlan()
    executed.execute().count()
    plan = executed.toString()
    final = plan.split("+- == Initial Plan ==")[0]
    out = []
    for line in final.split("\n"):
        if not any(k in line for k in KEEP):
            continue
        line = re.sub(r"#\d+L?", "", line)
        line = re.sub(r"\[plan_id=\d+\]", "", line)
        if "FileScan" in line:
            keep = [m.group(0) for m in re.finditer(r"(PushedFilters: \[[^\]]*\]|ReadSchema: \S+)", line)]
            head = line.split("FileScan")[0] + "FileScan parquet"
            line = head + " " + ", ".join(keep)
        out.append(line.rstrip()[:220])
    return out


def main(argv: list[str]) -> int:
    import os

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
    from editstream.plans.catalog import BATCH_QUERIES
    from editstream.session import build_session

    spark = build_session("local[8]", shuffle_partitions=8)
    print(f"# Executed plans ({os.path.basename(sf_dir.rstrip('/'))}, local[8], AQE final)\n")
    print("Generated by `python -m editstream.plans.explain`. Operators kept: exchanges, aggregates,")
    print("joins, limits, window limits, subqueries, scans (pushed filters, read schema).\n")
    for name, q in BATCH_QUERIES.items():
        print(f"## {name}\n\n```")
        print("\n".join(condensed(q(spark, sf_dir))))
        print("```\n")
    spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
