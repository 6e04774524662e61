"""Command line: list the data products or run one into a snapshot.

    python -m opticart list
    python -m opticart run customer_intake ... --out /shared/intake   (one table of routed
        rows; the new customers and the error log are views on it, sql.register_intake)
    python -m opticart run products_overview --data /data/retail \
        --out /shared/products_overview --version 2001-08-01 [--as-of 2001-08-01]
    python -m opticart run low_seller_discounts ... --param lower_discount=0.1 \
        --param upper_discount=0.5 --param years=1999,2000,2001 \
        [--stored-discounts /shared/discounts/version=2001-07-01]

Under spark-submit the submitted settings (master, shuffle partitions,
checkpoint folder) stay; without a configured master a local session is
built.
"""

from __future__ import annotations

import argparse
import dataclasses
import datetime as dt
import sys

from opticart import registry
from opticart.operators.intake import write_intake
from opticart.params import DEFAULT, Params
from opticart.sources.sinks import write_snapshot


def parse_params(pairs: list[str], as_of: dt.date | None = None) -> Params:
    """Params from ``key=value`` strings, converted by the field's default type."""
    fields = {f.name: getattr(DEFAULT, f.name) for f in dataclasses.fields(Params)}
    values = {}
    for pair in pairs:
        key, _, raw = pair.partition("=")
        if key not in fields:
            raise SystemExit(f"unknown parameter {key!r}; known: {', '.join(sorted(fields))}")
        default = fields[key]
        if isinstance(default, dt.date):
            values[key] = dt.date.fromisoformat(raw)
        elif isinstance(default, tuple):
            kind = type(default[0]) if default else str
            values[key] = tuple(kind(x) for x in raw.split(",") if x)
        else:
            values[key] = type(default)(raw)
    if as_of is not None:
        values["as_of"] = as_of
    return dataclasses.replace(DEFAULT, **values)


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="opticart")
    sub = ap.add_subparsers(dest="cmd", required=True)
    sub.add_parser("list", help="list the data products")
    run = sub.add_parser("run", help="run one product into a versioned snapshot")
    run.add_argument("product", choices=sorted(registry.PRODUCTS))
    run.add_argument("--data", required=True, help="folder of the source tables")
    run.add_argument("--out", required=True, help="snapshot root (shared storage)")
    run.add_argument("--version", required=True, help="snapshot version, e.g. a run date")
    run.add_argument("--as-of", type=dt.date.fromisoformat, default=None,
                     help="the date that replaces the clock (default: Params.as_of)")
    run.add_argument("--param", action="append", default=[], metavar="KEY=VALUE",
                     help="any other Params field, e.g. year=2000 or years=1999,2000")
    run.add_argument("--stored-discounts", default=None, metavar="PATH",
                     help="snapshot with product_id and discount, which products that do not "
                          "qualify keep")
    args = ap.parse_args(argv)

    if args.cmd == "list":
        for key, fn in registry.PRODUCTS.items():
            first = (fn.__doc__ or "").strip().splitlines()[0] if fn.__doc__ else ""
            print(f"{key:30s} {first}")
        return 0

    from opticart.session import job_session
    spark = job_session()
    params = parse_params(args.param, args.as_of)
    df = registry.queries(params, args.stored_discounts)[args.product](spark, args.data)
    write = write_intake if args.product == "customer_intake" else write_snapshot
    path = write(df, args.out, args.version)
    print(path)
    return 0


if __name__ == "__main__":
    sys.exit(main())
