"""Summarise a Spark event log: per stage duration, tasks, shuffle read and
task-time skew (slowest task / median task). Use with BENCH_EVENT_LOG.

usage: python scripts/eventlog_summary.py <event log dir or file> [top]
"""

from __future__ import annotations

import glob
import io
import json
import os
import statistics
import sys


def lines(path: str):
    files = sorted(glob.glob(os.path.join(path, "**", "events_*"), recursive=True)) \
        if os.path.isdir(path) else [path]
    for f in files:
        with open(f, "rb") as fh:
            if f.endswith(".zstd"):
                import zstandard
                stream = io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(fh),
                                          encoding="utf-8")
            else:
                stream = io.TextIOWrapper(fh, encoding="utf-8")
            for line in stream:
                yield json.loads(line)


def main():
    path, top = sys.argv[1], int(sys.argv[2]) if len(sys.argv) > 2 else 15
    stages, tasks = {}, {}
    for e in lines(path):
        ev = e["Event"]
        if ev == "SparkListenerTaskEnd" and e.get("Task Info"):
            info, metrics = e["Task Info"], e.get("Task Metrics") or {}
            key = (e["Stage ID"], e["Stage Attempt ID"])
            read = metrics.get("Shuffle Read Metrics", {})
            tasks.setdefault(key, []).append(
                (info["Finish Time"] - info["Launch Time"],
                 read.get("Remote Bytes Read", 0) + read.get("Local Bytes Read", 0)))
        elif ev == "SparkListenerStageCompleted":
            si = e["Stage Info"]
            stages[(si["Stage ID"], si["Stage Attempt ID"])] = (
                si.get("Completion Time", 0) - si.get("Submission Time", 0), si["Stage Name"])
    rows = []
    for key, (dur, name) in stages.items():
        ts = tasks.get(key, [])
        times = [t for t, _ in ts] or [0]
        med = statistics.median(times) or 1
        rows.append((dur, key[0], len(ts), sum(b for _, b in ts), max(times) / med, name[:40]))
    print(f"stages {len(rows)}  total stage ms {sum(r[0] for r in rows)}")
    print(f"{'stage':>6} {'ms':>7} {'tasks':>6} {'shuffle MB':>10} {'max/med':>8}  name")
    for dur, sid, n, read, skew, name in sorted(rows, reverse=True)[:top]:
        print(f"{sid:>6} {dur:>7} {n:>6} {read / 2**20:>10.2f} {skew:>8.1f}  {name}")


if __name__ == "__main__":
    main()
