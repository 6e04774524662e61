"""Time the products over the materialised, order-bucketed conformed layer.

usage: python scripts/bench_materialized.py [sf_dir] [runs] [buckets]
Writes the conformed layer once (timed separately) under the shared
checkpoint folder, then times every product that reads only conformed
tables; prints one JSON line.
"""

from __future__ import annotations

import json
import statistics
import sys
import time

sys.path.insert(0, ".")

from opticart import registry  # noqa: E402
from opticart.session import build_session, shared_path  # noqa: E402
from opticart.sources.bucketed import materialize  # noqa: E402
from opticart.sources.conform import Tables  # noqa: E402

NEEDS_FIXTURE = ("apply_line_deltas", "apply_custom_line_deltas", "delete_latest_order_lines",
                 "stream_order_totals", "customer_intake_stream")


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    runs = int(sys.argv[2]) if len(sys.argv) > 2 else 3
    buckets = int(sys.argv[3]) if len(sys.argv) > 3 else 8
    spark = build_session(extra={"spark.ui.showConsoleProgress": "false"})
    t0 = time.perf_counter()
    bt = materialize(Tables(spark, sf_dir), shared_path(spark, "warehouse"), buckets, "bench")
    load = time.perf_counter() - t0
    times = {}
    for name, fn in registry.PRODUCTS.items():
        if name in NEEDS_FIXTURE:
            continue
        samples = []
        for i in range(runs + 1):
            s = time.perf_counter()
            fn(bt, registry.DEFAULT).write.format("noop").mode("overwrite").save()
            if i:
                samples.append(time.perf_counter() - s)
        times[name] = round(statistics.median(samples), 3)
    print(json.dumps({"sf_dir": sf_dir, "buckets": buckets, "load_sec": round(load, 2),
                      "total_sec": round(sum(times.values()), 2), "queries": times}))


if __name__ == "__main__":
    main()
