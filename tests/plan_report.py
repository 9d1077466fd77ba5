"""Summarise the final (adaptive) physical plan of every registered query.

Usage: python tests/plan_report.py [sf_dir] > PLANS.md

Each query is executed once; the summary is read from ``explain`` after the
run (so AQE's runtime decisions - broadcast conversion, coalescing, reused
stages - are visible).
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from hearthlake.plans.queries import registry  # noqa: E402
from hearthlake.session import build_session  # noqa: E402



def final_plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="simple")
    text = buf.getvalue()
    if "== Final Plan ==" in text:
        text = text.split("== Final Plan ==", 1)[1].split("== Initial Plan ==", 1)[0]
    return text


def scans(df, widths: dict) -> str:
    """'table read/total' for every parquet scan (column pruning at the source), from the formatted plan."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    seen = {}
    for block in re.findall(r"\(\d+\) Scan parquet.*?ReadSchema: struct<[^\n]*>", buf.getvalue(), re.S):
        location = re.search(r"Location: \w+ \[([^\]]+)\]", block)
        schema = re.search(r"ReadSchema: struct<([^\n]*)>", block)
        if not location or not schema:
            continue
        table = os.path.basename(location.group(1).rstrip("/")).removesuffix(".parquet")
        n = len(re.findall(r"(?:^|,)\w+:", schema.group(1)))
        seen[table] = max(seen.get(table, 0), n)
    return ", ".join(f"{t} {n}/{widths.get(t, '?')}" for t, n in sorted(seen.items()))


def summarise(text: str) -> dict:
    count = lambda pat: len(re.findall(pat, text))
    return {
        "shuffles": count(r"Exchange hashpartitioning|Exchange RoundRobin|Exchange SinglePartition"),
        "reused": count(r"ReusedExchange"),
        "broadcast joins": count(r"BroadcastHashJoin"),
        "sort-merge joins": count(r"SortMergeJoin"),
        "partial aggs": count(r"HashAggregate\(keys=\[[^\]]*\], functions=\[partial_"),
        "window group limits": count(r"WindowGroupLimit"),
        "cartesian / nested loop": count(r"CartesianProduct|BroadcastNestedLoopJoin"),
        "python": count(r"BatchEvalPython|ArrowEvalPython|MapInPandas|FlatMapGroupsInPandas"),
    }


def main(argv) -> int:
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    queries = registry()
    cols = ["shuffles", "reused", "broadcast joins", "sort-merge joins", "partial aggs", "window group limits",
            "cartesian / nested loop", "python"]
    import pyarrow.parquet as pq
    widths = {f[:-8]: len(pq.read_schema(os.path.join(sf_dir, f)).names)
              for f in os.listdir(sf_dir) if f.endswith(".parquet")}
    print("# Final physical plans of the registered queries\n")
    print(f"Generated by `python tests/plan_report.py {sf_dir}` (local[8], 8 shuffle partitions, AQE on). Counts are")
    print("operators in the final adaptive plan after one execution (inside scalar subqueries too). `reused` = shuffle")
    print("or broadcast stages served from an identical earlier stage. `columns read` = columns in each parquet scan's")
    print("ReadSchema / columns of the table. Model-training keys are not listed.\n")
    print("| query | rows | sec | " + " | ".join(cols) + " | columns read / table width |")
    print("| --- | ---: | ---: | " + " | ".join("---:" for _ in cols) + " | --- |")
    for key, fn in queries.items():
        df = fn(spark, sf_dir)
        start = time.perf_counter()
        rows = len(df.collect())
        secs = time.perf_counter() - start
        plan = final_plan(df)
        s = summarise(plan)
        print(f"| `{key}` | {rows} | {secs:.1f} | " + " | ".join(str(s[c]) for c in cols)
              + f" | {scans(df, widths)} |", flush=True)
    spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
