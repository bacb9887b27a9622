"""Summarise a Spark event log: jobs and stages with durations and task counts.

usage: python tools/eventlog_summary.py <event-log dir> [--stages]

The event log is written by a session with ``spark.eventLog.enabled=true``
and ``spark.eventLog.dir=<scratch folder>`` (e.g. ``BENCH_EVENTLOG_DIR`` for
bench.py); rolling (v2) and zstd-compressed logs are read.  No UI or REST
endpoint is used.
"""

from __future__ import annotations

import glob
import io
import json
import sys


def events(path: str):
    files = sorted(glob.glob(f"{path}/eventlog_v2_*/events*")) or sorted(glob.glob(f"{path}/*"))
    for f in files:
        data = open(f, "rb").read()
        if f.endswith(".zstd"):
            import zstandard
            with zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True) as r:
                data = r.read()
        for line in data.decode().splitlines():
            if line.strip():
                yield json.loads(line)


def main() -> None:
    path, show_stages = sys.argv[1], "--stages" in sys.argv
    jobs, stages = {}, {}
    for e in events(path):
        ev = e["Event"]
        if ev == "SparkListenerJobStart":
            desc = (e.get("Properties") or {}).get("spark.job.description", "")
            jobs[e["Job ID"]] = [e["Submission Time"], None, [s["Stage ID"] for s in e["Stage Infos"]], desc]
        elif ev == "SparkListenerJobEnd":
            jobs[e["Job ID"]][1] = e["Completion Time"]
        elif ev == "SparkListenerStageCompleted":
            si = e["Stage Info"]
            stages[si["Stage ID"]] = (si.get("Submission Time"), si.get("Completion Time"),
                                      si["Number of Tasks"], si["Stage Name"][:60])
    if not jobs:
        print("no jobs found")
        return
    t0 = min(v[0] for v in jobs.values())
    for j, (s, c, st, d) in sorted(jobs.items()):
        print(f"job {j:4d} at {s - t0:7d} ms  {(c or s) - s:6d} ms  stages {len(st)}  {d[:50]}")
        if show_stages:
            for sid in st:
                if sid in stages and stages[sid][0]:
                    ss, sc, nt, name = stages[sid]
                    print(f"      stage {sid:4d} {sc - ss:6d} ms  tasks {nt:4d}  {name}")
    end = max((v[1] or v[0]) for v in jobs.values())
    print(f"{len(jobs)} jobs, {len(stages)} completed stages, span {end - t0} ms")
    groups: dict[str, list] = {}
    for s, c, st, d in jobs.values():
        g = groups.setdefault(d or "-", [0, 0, s, c or s])
        g[0] += 1
        g[1] += (c or s) - s
        g[2], g[3] = min(g[2], s), max(g[3], c or s)
    print("by description: jobs, busy ms, wall ms")
    for d, (n, busy, first, last) in sorted(groups.items(), key=lambda kv: kv[1][2]):
        print(f"  {d[:40]:40s} {n:4d} {busy:7d} {last - first:7d}")


if __name__ == "__main__":
    main()
