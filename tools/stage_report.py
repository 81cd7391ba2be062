"""Summarise a Spark event log: per job group, task time, shuffle bytes, spill.

Usage: python tools/stage_report.py <event log file or folder>

The bench writes one with BENCH_EVENT_LOG_DIR=<folder>. Reads only the
listener events (JSON lines); the web UI stays off.
"""

from __future__ import annotations

import json
import os
import sys
from collections import defaultdict


def _files(path: str) -> list[str]:
    """Event log files under ``path`` (Spark 4 writes a folder of rolling
    files per application)."""
    if not os.path.isdir(path):
        return [path]
    out = []
    for root, _, names in os.walk(path):
        out += [os.path.join(root, n) for n in sorted(names) if n.startswith("events")]
    return out


def _lines(name: str):
    """Lines of one event log file; Spark 4 compresses them with zstd."""
    if name.endswith(".zstd"):
        import io

        import zstandard

        with open(name, "rb") as raw:
            reader = zstandard.ZstdDecompressor().stream_reader(raw)
            yield from io.TextIOWrapper(reader, encoding="utf-8")
    else:
        with open(name, encoding="utf-8") as f:
            yield from f


def summarise(path: str) -> dict:
    totals = defaultdict(int)
    per_stage = defaultdict(lambda: defaultdict(int))
    for name in _files(path):
        for line in _lines(name):
            ev = json.loads(line)
            if ev.get("Event") != "SparkListenerTaskEnd":
                continue
            m = ev.get("Task Metrics") or {}
            sid = ev["Stage ID"]
            sr = m.get("Shuffle Read Metrics", {})
            sw = m.get("Shuffle Write Metrics", {})
            row = {
                "tasks": 1,
                "run_ms": m.get("Executor Run Time", 0),
                "shuffle_read": sr.get("Remote Bytes Read", 0) + sr.get("Local Bytes Read", 0),
                "shuffle_write": sw.get("Shuffle Bytes Written", 0),
                "spill_memory": m.get("Memory Bytes Spilled", 0),
                "spill_disk": m.get("Disk Bytes Spilled", 0),
            }
            for k, v in row.items():
                per_stage[sid][k] += v
                totals[k] += v
    return {"totals": dict(totals), "stages": {k: dict(v) for k, v in per_stage.items()}}


def main(argv: list[str]) -> None:
    s = summarise(argv[0])
    t = s["totals"]
    print(json.dumps(t))
    worst = sorted(s["stages"].items(), key=lambda kv: -kv[1]["run_ms"])[:5]
    for sid, row in worst:
        print(f"stage {sid}: {row}")


if __name__ == "__main__":
    main(sys.argv[1:])
