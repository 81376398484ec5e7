"""Count shuffles, broadcasts and windows in each registered query's plan.

Usage: python tools/plan_review.py [sf_dir]
Prints a markdown table (initial physical plans; AQE may reuse identical
exchanges or switch joins to broadcast at run time).
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.plans.catalog import QUERIES  # noqa: E402
from tidemark.session import build_session  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[4]", shuffle_partitions=8)
    print("| query | shuffles | broadcasts | windows | explode | top-n | group limit |")
    print("|---|---|---|---|---|---|---|")
    for name, build in QUERIES.items():
        df = build(spark, sf_dir)
        text = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")
        shuffles = len(re.findall(r"Exchange (?:hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)", text))
        broadcasts = len(re.findall(r"BroadcastExchange", text))
        windows = len(re.findall(r"\bWindow \[", text))
        flags = ["yes" if cond else "" for cond in ("explode" in text, "TakeOrderedAndProject" in text, "WindowGroupLimit" in text)]
        print(f"| {name} | {shuffles} | {broadcasts} | {windows} | " + " | ".join(flags) + " |")
    spark.stop()


if __name__ == "__main__":
    main()
