"""Summarise the final (post-AQE) physical plan of every registered query.

usage: python scripts/plan_summary.py [sf_dir] > docs/plans.md
Each query runs once through the ``noop`` sink; the executed plan is then
counted: shuffle exchanges (hash / range / round-robin / single), broadcast
exchanges, exchanges reused by AQE, Python nodes and file scans.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from colloquy.plans.registry import load_all  # noqa: E402
from colloquy.session import get_session  # noqa: E402

def _seq(x):
    return [x.apply(i) for i in range(x.size())]


def walk(node, out):
    """Collect the class names of every executed node (stages, subqueries
    and nested adaptive plans included; reused exchanges not descended)."""
    cls = node.getClass().getSimpleName()
    out.append((cls, node))
    if cls == "AdaptiveSparkPlanExec":
        walk(node.executedPlan(), out)
        return
    if cls.endswith("QueryStageExec"):
        walk(node.plan(), out)
        return
    if cls == "ReusedExchangeExec":
        return
    for sub in _seq(node.subqueries()):
        walk(sub, out)
    for child in _seq(node.children()):
        walk(child, out)


def counts(df) -> dict[str, int]:
    nodes: list = []
    walk(df._jdf.queryExecution().executedPlan(), nodes)
    c = {"hash": 0, "range": 0, "rr": 0, "single": 0, "broadcast": 0, "reused": 0, "python": 0, "scans": 0}
    for cls, node in nodes:
        if cls == "ShuffleExchangeExec":
            part = node.outputPartitioning().getClass().getSimpleName()
            key = {"HashPartitioning": "hash", "RangePartitioning": "range",
                   "RoundRobinPartitioning": "rr", "SinglePartition$": "single"}.get(part, "hash")
            c[key] += 1
        elif cls == "BroadcastExchangeExec":
            c["broadcast"] += 1
        elif cls == "ReusedExchangeExec":
            c["reused"] += 1
        elif "Python" in cls or "InPandas" in cls or "InArrow" in cls:
            c["python"] += 1
        elif cls in ("FileSourceScanExec", "RDDScanExec", "BatchScanExec", "ExistingRDD"):
            c["scans"] += 1
    return c


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = get_session("local[8]", shuffle_partitions=16)
    queries, oracles = load_all()
    print(f"# Final physical plans at {os.path.basename(sf.rstrip('/'))}\n")
    print("Counts from the executed (post-AQE) plan of each registered query. `rr` is the "
          "round-robin spread of single-split test inputs (absent on large inputs); "
          "`single` is a one-partition exchange, used only over bounded rows (top-k, "
          "per-partition counts, global aggregates). Reused = exchanges AQE served "
          "from an earlier stage.\n")
    print("| query | hash | range | rr | single | broadcast | reused | python | scans | oracle |")
    print("| --- | ---: | ---: | ---: | ---: | ---: | ---: | ---: | ---: | --- |")
    for name, fn in queries.items():
        df = fn(spark, sf)
        df.collect()
        c = counts(df)
        print(f"| {name} | {c['hash']} | {c['range']} | {c['rr']} | {c['single']} | {c['broadcast']} | "
              f"{c['reused']} | {c['python']} | {c['scans']} | {'sql' if name in oracles else 'rows'} |")
    spark.stop()


if __name__ == "__main__":
    main()
