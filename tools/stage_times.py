"""Job and stage timeline of a Spark event log (plain or zstd-compressed).

    BENCH_EVENT_LOG=$(mktemp -d /tmp/run-XXXXXX) python bench.py sales_cube
    python tools/stage_times.py /tmp/run-XXXXXX [last_n_jobs]

Prints, per job: start offset (ms), duration (ms), and per stage the task
count and duration. Reads the log only; starts nothing.
"""

from __future__ import annotations

import glob
import json
import os
import sys


def _lines(path: str):
    if path.endswith(".zstd"):
        import zstandard
        with open(path, "rb") as f:
            data = zstandard.ZstdDecompressor().stream_reader(f).read()
        return data.decode().splitlines()
    with open(path) as f:
        return f.read().splitlines()


def timeline(log_dir: str, last: int = 30) -> list[str]:
    files = sorted(glob.glob(os.path.join(log_dir, "**", "events*"), recursive=True)
                   + glob.glob(os.path.join(log_dir, "local-*")))
    stages, jobs = {}, {}
    for path in files:
        for line in _lines(path):
            e = json.loads(line)
            kind = e["Event"]
            if kind == "SparkListenerStageCompleted":
                si = e["Stage Info"]
                stages[si["Stage ID"]] = (si["Number of Tasks"],
                                          si["Completion Time"] - si["Submission Time"])
            elif kind == "SparkListenerJobStart":
                jobs[e["Job ID"]] = [e["Submission Time"], None, e["Stage IDs"]]
            elif kind == "SparkListenerJobEnd":
                jobs[e["Job ID"]][1] = e["Completion Time"]
    ids = sorted(jobs)[-last:]
    if not ids:
        return []
    t0 = jobs[ids[0]][0]
    out = []
    for j in ids:
        start, end, stage_ids = jobs[j]
        parts = [f"{stages[s][0]} tasks {stages[s][1]} ms" for s in stage_ids if s in stages]
        out.append(f"job {j:4d} +{start - t0:6d} ms  {(end or start) - start:5d} ms  "
                   + "; ".join(parts))
    return out


if __name__ == "__main__":
    print("\n".join(timeline(sys.argv[1], int(sys.argv[2]) if len(sys.argv) > 2 else 30)))
