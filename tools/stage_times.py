"""Summarise a Spark event log: slowest stages with task counts and shuffle bytes.

    BENCH_EVENT_LOG=$(mktemp -d /tmp/run-XXXXXX) python bench.py
    python tools/stage_times.py <event log file or folder> [top]

Reads SparkListenerStageCompleted / TaskEnd events (JSON lines); no UI, no server.
"""

from __future__ import annotations

import json
import os
import sys
from collections import defaultdict


def _files(path: str) -> list[str]:
    """Event files under ``path`` (rolling logs are folders of ``events_*`` files)."""
    if not os.path.isdir(path):
        return [path]
    out = []
    for root, _, names in os.walk(path):
        out += [os.path.join(root, n) for n in names if not n.startswith(".") and not n.startswith("appstatus")]
    return sorted(out)


def _lines(name: str):
    if name.endswith(".zstd"):
        import io

        import zstandard

        with open(name, "rb") as raw:
            reader = zstandard.ZstdDecompressor().stream_reader(raw)
            yield from io.TextIOWrapper(reader, encoding="utf-8")
    else:
        with open(name) as f:
            yield from f


def summarise(path: str, top: int = 15) -> list[dict]:
    tasks = defaultdict(lambda: {"n": 0, "max_ms": 0, "sum_ms": 0, "shuffle_read": 0, "shuffle_write": 0})
    stages = {}
    job_of: dict = {}
    for name in _files(path):
        for line in _lines(name):
            ev = json.loads(line)
            kind = ev.get("Event")
            if kind == "SparkListenerTaskEnd":
                info, metrics = ev.get("Task Info", {}), ev.get("Task Metrics") or {}
                key = (ev.get("Stage ID"), ev.get("Stage Attempt ID"))
                ms = info.get("Finish Time", 0) - info.get("Launch Time", 0)
                t = tasks[key]
                t["n"] += 1
                t["max_ms"] = max(t["max_ms"], ms)
                t["sum_ms"] += ms
                t["shuffle_read"] += (metrics.get("Shuffle Read Metrics") or {}).get("Remote Bytes Read", 0) + (
                    metrics.get("Shuffle Read Metrics") or {}).get("Local Bytes Read", 0)
                t["shuffle_write"] += (metrics.get("Shuffle Write Metrics") or {}).get("Shuffle Bytes Written", 0)
            elif kind == "SparkListenerJobStart":
                label = (ev.get("Properties") or {}).get("spark.job.description")
                for sid in ev.get("Stage IDs", []):
                    job_of[sid] = label
            elif kind == "SparkListenerStageCompleted":
                si = ev["Stage Info"]
                key = (si["Stage ID"], si.get("Stage Attempt ID", 0))
                stages[key] = {
                    "stage": si["Stage ID"],
                    "name": si.get("Stage Name", "")[:60],
                    "ms": si.get("Completion Time", 0) - si.get("Submission Time", 0),
                }
    rows = []
    for key, st in stages.items():
        t = tasks.get(key, {"n": 0, "max_ms": 0, "sum_ms": 0, "shuffle_read": 0, "shuffle_write": 0})
        mean = t["sum_ms"] / t["n"] if t["n"] else 0
        rows.append({**st, "query": job_of.get(st["stage"]), "tasks": t["n"], "max_task_ms": t["max_ms"],
                     "skew": round(t["max_ms"] / mean, 1) if mean else 0,
                     "shuffle_read_mb": round(t["shuffle_read"] / 2**20, 1),
                     "shuffle_write_mb": round(t["shuffle_write"] / 2**20, 1)})
    return sorted(rows, key=lambda r: -r["ms"])[:top]


def main(argv):
    for row in summarise(argv[1], int(argv[2]) if len(argv) > 2 else 15):
        print(json.dumps(row))


if __name__ == "__main__":
    main(sys.argv)
