"""Print, per registered query, the shuffle count and plan features that
matter at scale (single-partition exchanges, nested-loop joins, windows,
Python evaluation). Usage: python tools/plan_audit.py [sf_dir]"""
import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from mercato.plans.registry import Inputs, queries  # noqa: E402
from mercato.session import build_session  # noqa: E402


def features(plan: str) -> dict[str, int]:
    return {
        "exch": len(re.findall(r"Exchange hashpartitioning|Exchange rangepartitioning|Exchange RoundRobin", plan)),
        "single": len(re.findall(r"Exchange SinglePartition", plan)),
        "bcast": len(re.findall(r"BroadcastExchange", plan)),
        "bnlj": len(re.findall(r"BroadcastNestedLoopJoin", plan)),
        "cart": len(re.findall(r"CartesianProduct", plan)),
        "window": len(re.findall(r"\bWindow\b", plan)),
        "smj": len(re.findall(r"SortMergeJoin", plan)),
        "python": len(re.findall(r"ArrowEvalPython|BatchEvalPython|FlatMapGroupsInPandas", plan)),
        "topk": len(re.findall(r"TakeOrderedAndProject", plan)),
    }


def main(sf):
    spark = build_session("local[8]", shuffle_partitions=8)
    Inputs(spark, sf).prepare()
    for k, fn in queries().items():
        df = fn(spark, sf)
        df.write.format("noop").mode("overwrite").save()
        plan = df._jdf.queryExecution().executedPlan().toString()
        print(f"{k:34s} " + " ".join(f"{n}={v}" for n, v in features(plan).items() if v))


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01")
