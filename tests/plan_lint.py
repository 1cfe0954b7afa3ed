"""Scan the physical plans of registered queries for patterns that do not scale.

Usage: python tests/plan_lint.py [sf_dir] [name ...]
"""

from __future__ import annotations

import re
import sys

FLAGS = {
    "single_partition": re.compile(r"Exchange SinglePartition"),
    "nested_loop": re.compile(r"BroadcastNestedLoopJoin"),
    "cartesian": re.compile(r"CartesianProduct"),
    "sort_aggregate": re.compile(r"SortAggregate"),
    "python_row_udf": re.compile(r"BatchEvalPython"),
}


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def lint(df) -> dict:
    txt = plan_text(df)
    out = {k: len(p.findall(txt)) for k, p in FLAGS.items()}
    out["exchanges"] = len(re.findall(r"Exchange hashpartitioning|Exchange rangepartitioning", txt))
    out["broadcasts"] = len(re.findall(r"BroadcastExchange", txt))
    return {k: v for k, v in out.items() if v}


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    sys.path.insert(0, ".")
    from tidecast.plans.registry import all_queries
    from tidecast.session import get_spark
    spark = get_spark("plan-lint", {"spark.sql.shuffle.partitions": "8"}, master="local[8]")
    spark.sparkContext.setLogLevel("ERROR")
    for name, (fn, _sql) in all_queries().items():
        if names and name not in names:
            continue
        try:
            print(name, lint(fn(spark, sf_dir)), flush=True)
        except Exception as e:
            print(name, "ERROR", type(e).__name__, str(e)[:200])


if __name__ == "__main__":
    main(sys.argv)
