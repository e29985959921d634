"""Summarise the executed physical plan of every registered query.

usage: python tools/plan_summary.py [sf_dir] [--formatted name]
Counts shuffles (Exchange), broadcasts, joins, generators and Python stages
after running each query once (AQE final plans).
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from dossier.plans.catalog import QUERIES  # noqa: E402
from dossier.session import get_session  # noqa: E402


def final_plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    qe = df._jdf.queryExecution()
    s = qe.executedPlan().toString()
    return s.split("== Initial Plan ==")[0]


def main():
    args = [a for a in sys.argv[1:] if not a.startswith("--")]
    sf = args[0] if args else "/root/testdata/sf0.01"
    spark = get_session("local[8]", shuffle_partitions=8, extra={"spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    if "--formatted" in sys.argv:
        name = sys.argv[sys.argv.index("--formatted") + 1]
        QUERIES[name](spark, sf).explain("formatted")
        return
    print(f"| query | shuffles | broadcast | joins | window | python |")
    print("| --- | --- | --- | --- | --- | --- |")
    for name, q in QUERIES.items():
        p = final_plan(q(spark, sf))
        ex = len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|RoundRobinPartitioning|SinglePartition)", p))
        rr = len(re.findall(r"Exchange RoundRobinPartitioning", p))
        bc = len(re.findall(r"BroadcastExchange", p))
        joins = re.findall(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|BroadcastNestedLoopJoin|CartesianProduct)", p)
        win = len(re.findall(r"\bWindow \[", p))
        py = len(re.findall(r"MapInPandas|ArrowEvalPython|BatchEvalPython|FlatMapGroupsInPandas", p))
        jtxt = ", ".join(sorted(set(joins))) or "-"
        print(f"| {name} | {ex} ({rr} spread) | {bc} | {jtxt} | {win} | {py} |", flush=True)


if __name__ == "__main__":
    main()
