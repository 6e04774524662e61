"""Benchmark: every registered data product on one scale factor.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (warm runs per query, default 3), BENCH_QUERIES (comma list),
BENCH_EVENT_LOG (a scratch folder: write Spark's event log there for
stage and task times).
Each query runs in full through the ``noop`` sink (nothing is collected to
the driver); the per-query time is the median of the warm runs after one
warm-up. Prints one JSON line on stdout.
"""

from __future__ import annotations

import gc
import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from opticart import registry  # noqa: E402
from opticart.session import build_session  # noqa: E402


# Forms that first build the state they then keep up to date: their time is mostly that
# of the set-up. Timed only when named in BENCH_QUERIES.
SET_UP = ("totals_kept_in_place", "products_overview_kept", "product_annual_stats_kept",
          "revenue_of_stored_totals")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    wanted = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    extra = {"spark.ui.showConsoleProgress": "false"}
    if os.environ.get("BENCH_EVENT_LOG"):
        extra.update({"spark.eventLog.enabled": "true",
                      "spark.eventLog.dir": os.environ["BENCH_EVENT_LOG"]})
    spark = build_session(master=f"local[{cpus}]", app="opticart-bench",
                          shuffle_partitions=cpus, extra=extra)
    queries = registry.queries()
    times: dict[str, float | None] = {}
    errors: dict[str, str] = {}
    for name, fn in queries.items():
        if name not in wanted if wanted else name in SET_UP:
            continue
        samples = []
        try:
            for i in range(runs + 1):
                t0 = time.perf_counter()
                fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
                if i:  # the first run warms the JVM and the file cache
                    samples.append(time.perf_counter() - t0)
            times[name] = round(statistics.median(samples), 3)
        except Exception as exc:  # report and go on: one failure must not hide the rest
            times[name] = None
            errors[name] = f"{type(exc).__name__}: {str(exc)[:300]}"
        # Drop the Python handles of this query's plans so Spark's cleaner can
        # release their shuffle files and broadcasts before the next one.
        gc.collect()
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "total_median_query_sec",
        "value": round(sum(v for v in times.values() if v is not None), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
        "runs": runs,
        "spark": spark.version,
    }
    if errors:
        out["errors"] = errors
    spark.stop()
    print(json.dumps(out))


if __name__ == "__main__":
    main()
