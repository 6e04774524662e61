"""Print a short plan summary per registered query (explain("formatted"))."""

from __future__ import annotations

import sys

sys.path.insert(0, ".")

from opticart import registry  # noqa: E402
from opticart.plans.inspect import plan_text, summarize  # noqa: E402
from opticart.session import build_session  # noqa: E402


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = build_session()
    for name, fn in registry.queries().items():
        if names and name not in names:
            continue
        df = fn(spark, sf_dir)
        text = plan_text(df)
        s = summarize(text, plan_text(df, "simple"))
        print(f"== {name}: exchanges={s.exchanges} single={s.single_partition} "
              f"bnlj={s.nested_loop} cartesian={s.cartesian} py={s.python_udf} joins={s.joins}")
        for scan in s.scans:
            print("   ", scan[:220])
        if len(names) == 1:
            print(text)


if __name__ == "__main__":
    main()
