"""bench.py keeps its contract: one JSON line with the agreed keys."""

import json
import os
import subprocess
import sys

from tests.conftest import ROOT, SMALL


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SMALL, BENCH_RUNS="1", BENCH_QUERIES="rating_gap",
               BENCH_CPUS="2")
    out = subprocess.run([sys.executable, "bench.py"], cwd=ROOT, env=env, capture_output=True,
                         text=True, timeout=600)
    lines = [line for line in out.stdout.splitlines() if line.strip()]
    assert out.returncode == 0 and len(lines) == 1, out.stderr[-2000:]
    d = json.loads(lines[0])
    assert {"metric", "value", "unit", "queries", "sf"} <= set(d)
    assert d["unit"] == "sec" and d["sf"] == 0.001 and set(d["queries"]) == {"rating_gap"}
