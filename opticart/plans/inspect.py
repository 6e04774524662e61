"""Summaries of physical plans, used by tests and by the plan review script.

Checks work on the text of ``explain("formatted")`` / the executed plan
string, the same output a Spark user reads.
"""

from __future__ import annotations

import contextlib
import io
import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """The text ``df.explain(mode)`` prints (captured instead of printed)."""
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode=mode)
    return out.getvalue()


def files_read(df: DataFrame) -> dict[str, int]:
    """Files that each scanned folder gave to ``df``, which is run for it (to the driver:
    for small results). Pruned partitions, also those pruned at run time, do not count."""
    df.collect()
    found: dict[str, int] = {}
    todo = [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name.startswith("AdaptiveSparkPlan"):
            todo.append(node.executedPlan())
        elif "QueryStage" in name:
            todo.append(node.plan())
        elif name.startswith("Scan parquet"):
            root = node.relation().location().rootPaths().head().getName()
            found[root] = found.get(root, 0) + node.metrics().apply("numFiles").value()
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return found


@dataclass
class PlanSummary:
    exchanges: int = 0
    single_partition: int = 0
    nested_loop: int = 0
    cartesian: int = 0
    python_udf: int = 0
    joins: dict[str, int] = field(default_factory=dict)
    scans: list[str] = field(default_factory=list)


def summarize(text: str, simple: str | None = None) -> PlanSummary:
    """Summarise a plan: ``text`` is the formatted explain (for the scans),
    ``simple`` the one-line-per-node explain (for operators)."""
    s = PlanSummary()
    head = simple if simple is not None else text
    s.exchanges = len(re.findall(r"Exchange hashpartitioning|Exchange rangepartitioning|"
                                 r"Exchange SinglePartition|Exchange RoundRobin", head))
    # A single partition that only takes the partial results of a global
    # aggregate gets one row per task and is not counted.
    s.single_partition = len(re.findall(
        r"Exchange SinglePartition(?![^\n]*\n[^\n]*HashAggregate\(keys=\[\], "
        r"functions=\[(?:partial_|merge_))", head))
    s.nested_loop = len(re.findall(r"BroadcastNestedLoopJoin", head))
    s.cartesian = len(re.findall(r"CartesianProduct", head))
    s.python_udf = len(re.findall(r"BatchEvalPython|ArrowEvalPython|FlatMapGroupsInPandas", head))
    for j in re.findall(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin)", head):
        s.joins[j] = s.joins.get(j, 0) + 1
    for block in re.findall(r"Scan parquet[^\n]*\n(?:[^\n]*\n){0,12}", text):
        pushed = re.search(r"PushedFilters: (\[.*?\])", block)
        schema = re.search(r"ReadSchema: (struct<.*?>)", block)
        s.scans.append(f"pushed={pushed.group(1) if pushed else '-'} "
                       f"schema={schema.group(1) if schema else '-'}")
    return s
