"""Plan report: the physical shape of every registered query.

``python -m barlab.plans.report [sf_dir] > PLANS.md`` builds each query on
the given tables (planning only, nothing is executed) and lists its shuffle
exchanges, broadcasts, joins, windows, sorts, aggregation kinds and Python
stages, from Spark's own executed-plan text.
"""

from __future__ import annotations

import re
import sys

from barlab.plans.catalog import QUERIES
from barlab.plans.inspect import physical_plan


def summarize(plan: str) -> dict[str, str]:
    exchanges = [re.sub(r"#\d+", "", e) for e in re.findall(r"Exchange (hashpartitioning\([^)]*\)|SinglePartition|rangepartitioning\([^)]*\))", plan)]
    # Plan text lists the root first: reverse to execution order.
    exchanges = [re.sub(r", \d+\)$", ")", e) for e in reversed(exchanges)]
    return {
        "shuffles": "; ".join(exchanges) or "-",
        "broadcasts": str(plan.count("BroadcastExchange")),
        "joins": ", ".join(sorted(set(re.findall(r"(\w+Join)\b", plan)))) or "-",
        "windows": str(len(re.findall(r"\bWindow \[", plan))),
        "sorts": str(len(re.findall(r"\bSort \[", plan))),
        "aggregates": ", ".join(
            f"{k}×{n}"
            for k in ("HashAggregate", "ObjectHashAggregate", "SortAggregate")
            if (n := len(re.findall(rf"(?<![A-Za-z]){k}\(", plan)))
        )
        or "-",
        "python": ", ".join(sorted(set(re.findall(r"\b(MapInPandas|FlatMapGroupsInPandas|ArrowEvalPython|BatchEvalPython)\b", plan))))
        or "-",
        "top-k": ", ".join(sorted(set(re.findall(r"\b(TakeOrderedAndProject|WindowGroupLimit)\b", plan)))) or "-",
    }


def main(sf_dir: str = "/root/testdata/sf0.01") -> None:
    from barlab.session import local_session

    spark = local_session(8, shuffle_partitions=8, app="barlab-plans")
    cols = ["shuffles", "broadcasts", "joins", "windows", "sorts", "aggregates", "python", "top-k"]
    print("# Physical plans of the registered queries\n")
    print(f"Generated by `python -m barlab.plans.report` on `{sf_dir}` (local[8], 8 shuffle partitions, AQE's")
    print("initial plan).  Every query scans only the columns it uses; the first shuffle is the")
    print("partial-aggregated tick-to-bar exchange on (ticker, date), the second moves bars by ticker.")
    print("Shuffles are listed in execution order.\n")
    print("| query | " + " | ".join(cols) + " |")
    print("|---" * (len(cols) + 1) + "|")
    for name, query in QUERIES.items():
        s = summarize(physical_plan(query(spark, sf_dir)))
        print(f"| {name} | " + " | ".join(s[c] for c in cols) + " |")
    spark.stop()


if __name__ == "__main__":
    main(*sys.argv[1:])
