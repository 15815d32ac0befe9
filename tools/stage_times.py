"""Print per-stage wall time and task run/CPU times from a Spark event log folder.

    python tools/stage_times.py <eventlog dir or file>
"""

import glob
import io
import json
import os
import sys

import zstandard


def lines(path):
    files = sorted(glob.glob(os.path.join(path, "events_*"))) if os.path.isdir(path) else [path]
    for f in files:
        raw = open(f, "rb").read()
        if f.endswith(".zstd"):
            raw = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)).read()
        yield from raw.decode("utf-8").splitlines()


def main(path):
    stages, tasks, jobs = {}, {}, {}
    for line in lines(path):
        e = json.loads(line)
        ev = e["Event"]
        if ev == "SparkListenerJobStart":
            props = e.get("Properties") or {}
            for sid in e.get("Stage IDs", []):
                jobs[sid] = props.get("spark.job.description", "")
        elif ev == "SparkListenerStageCompleted":
            si = e["Stage Info"]
            stages[si["Stage ID"]] = (si["Stage Name"][:40], si["Number of Tasks"], si["Completion Time"] - si["Submission Time"])
        elif ev == "SparkListenerTaskEnd":
            m = e.get("Task Metrics") or {}
            tasks.setdefault(e["Stage ID"], []).append((m.get("Executor Run Time", 0), m.get("Executor CPU Time", 0) // 1_000_000))
    for sid in sorted(stages):
        name, n, ms = stages[sid]
        ts = tasks.get(sid, [])
        run = sum(t[0] for t in ts)
        cpu = sum(t[1] for t in ts)
        mx = max((t[0] for t in ts), default=0)
        print(f"stage {sid:4d} {jobs.get(sid, '')[:12]:12s} tasks={n:4d} wall={ms:6d}ms run={run:7d}ms cpu={cpu:7d}ms max_task={mx:6d}ms  {name}")


if __name__ == "__main__":
    main(sys.argv[1])
