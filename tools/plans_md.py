"""Regenerate PLANS.md: plan features of every query and the final adaptive
plans of a few representative ones. Usage: python tools/plans_md.py [sf_dir]"""
import io
import contextlib
import os
import re
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from mercato.plans.registry import Inputs, queries  # noqa: E402
from mercato.session import build_session  # noqa: E402
from tools.plan_audit import features  # noqa: E402

SHOWN = ["diner_last_before_join", "pizza_b2_pickup_avg", "pizza_d4_order_summary",
         "bank_a5_realloc_percentiles", "mart_bonus_region_fixed", "diner_favourite_item", "diner_first_item", "bank_b5_growth_pct"]

HEAD = """# PLANS — physical plans at {sf}

Produced by `tools/plans_md.py` after the derived tables are written. Automatic broadcast joins are off, so these are the sort-merge plans that large tables get, AQE splitting skewed partitions. Only the explicit one-row broadcasts are left.

Legend: `exch` = hash or range shuffles; `single` = exchanges to one partition, all of them global aggregates carrying one partial row per task; `bcast` = broadcast exchanges; `bnlj` = nested-loop joins, all against a one-row broadcast side; `window` = window operators, all over bounded groups; `smj` = sort-merge joins; `topk` = TakeOrderedAndProject. No query has a cartesian product or Python evaluation.

| query | plan features |
| --- | --- |
"""


def main(sf):
    # Broadcast off: these are the sort-merge plans that large tables get.
    spark = build_session("local[8]", shuffle_partitions=8, extra={
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.checkpoint.dir": tempfile.mkdtemp(prefix="mercato-plans-")})
    Inputs(spark, sf).prepare()
    out = [HEAD.format(sf=os.path.basename(sf.rstrip("/")))]
    shown = []
    for k, fn in queries().items():
        df = fn(spark, sf)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        feats = features(plan.split("+- == Initial Plan ==")[0])
        out.append(f"| `{k}` | {' '.join(f'{n}={v}' for n, v in feats.items() if v) or '(scan of a written table)'} |\n")
        if k in SHOWN:
            final = plan.split("+- == Initial Plan ==")[0]
            final = re.sub(r"file:/[^\]]*", "file:...", final)
            buf = io.StringIO()
            with contextlib.redirect_stdout(buf):
                df.explain("formatted")
            scans = [b for b in buf.getvalue().split("\n\n") if b.split("\n")[0].endswith("Scan parquet ")]
            keep = ["\n".join(l for l in b.split("\n") if l.startswith(("(", "PushedFilters", "PartitionFilters",
                                                                     "ReadSchema"))) for b in scans]
            shown.append(f"### `{k}`\n\nFinal adaptive plan:\n\n```\n{final.strip()}\n```\n\nScans:\n\n```\n"
                         + "\n".join(keep) + "\n```\n")
    out.append("\n## Representative plans\n\n" + "\n".join(shown))
    open(os.path.join(ROOT, "PLANS.md"), "w").write("".join(out))


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1")
