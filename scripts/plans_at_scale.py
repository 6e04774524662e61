"""Write PLANS.md: the physical plan shape of every product as it would run
on large inputs (size-based broadcasts off; only the hinted, proven-bound
broadcasts remain), from explain() on the sf0.01 tables.

usage: python scripts/plans_at_scale.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import re
import sys
from collections import Counter

sys.path.insert(0, ".")

from opticart import registry  # noqa: E402
from opticart.plans.inspect import plan_text  # noqa: E402
from opticart.session import build_session  # noqa: E402


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session(extra={"spark.ui.showConsoleProgress": "false",
                                 "spark.sql.autoBroadcastJoinThreshold": "-1",
                                 "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"})
    print("# PLANS — physical plan shape per product at scale\n")
    print("Generated by `scripts/plans_at_scale.py` from `explain()` with size-based broadcasts")
    print("switched off, so joins plan as they would on large inputs. Only the hinted")
    print("broadcasts of proven-bound inputs remain: nation/region, the option catalogue")
    print("(nation x region in the fixture) and the ranking offsets.")
    print("Exchange keys show what each shuffle moves. `single` counts single-partition")
    print("exchanges; each sits on a bounded input (see tests/test_plans.py). Counts are")
    print("from the plan before execution: a subtree used twice (e.g. one aggregate feeding")
    print("two branches) is listed twice and shuffled once, when AQE reuses its exchange.")
    print("Most `product_id, version`, `card_number` and `c_custkey` shuffles are the fixture's")
    print("derivations of VERSIONS, SELECTED, CREDIT_CARDS and the order country. With real")
    print("tables, or with `sources/bucketed.materialize`, they are not part of the products.\n")
    for name, fn in registry.queries().items():
        text = plan_text(fn(spark, sf_dir), "simple")
        reused = len(re.findall(r"ReusedExchange", text))
        own = "\n".join(line for line in text.splitlines() if "ReusedExchange" not in line)
        keys = Counter(re.findall(r"Exchange hashpartitioning\(([^)]*?), \d+\)", own))
        keys = Counter(re.sub(r"#\d+L?", "", k) for k in keys.elements())
        joins = Counter(re.findall(r"(SortMergeJoin|BroadcastHashJoin|ShuffledHashJoin|"
                                   r"BroadcastNestedLoopJoin|CartesianProduct)", text))
        ranges = len(re.findall(r"Exchange rangepartitioning", own))
        single = len(re.findall(r"Exchange SinglePartition", own))
        print(f"## {name}\n")
        print(f"- joins: {dict(joins) or '-'}")
        print(f"- hash exchanges: {sum(keys.values())}, range exchanges: {ranges}, "
              f"single: {single}, reused exchanges: {reused}")
        for k, n in sorted(keys.items()):
            print(f"  - `{k}`" + (f" x{n}" if n > 1 else ""))
        print()


if __name__ == "__main__":
    main()
