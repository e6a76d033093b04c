"""Summarise a Spark event log: the slowest stages with task counts.

usage: python tools/stage_times.py <event-log file or folder> [top]
"""

from __future__ import annotations

import io
import json
import os
import sys


def _lines(path):
    """Lines of an event log: a file, or a rolling-log folder of files;
    zstd-compressed parts are decompressed."""
    files = ([os.path.join(path, f) for f in sorted(os.listdir(path)) if f.startswith("events")]
             if os.path.isdir(path) else [path])
    for f in files:
        if f.endswith(".zstd"):
            import zstandard
            with open(f, "rb") as raw:
                text = io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(raw),
                                        encoding="utf-8")
                yield from text
        else:
            with open(f, encoding="utf-8") as fh:
                yield from fh


def main() -> None:
    path = sys.argv[1]
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 15
    stages = {}
    for line in _lines(path):
        ev = json.loads(line)
        if ev.get("Event") == "SparkListenerStageCompleted":
            info = ev["Stage Info"]
            start, end = info.get("Submission Time"), info.get("Completion Time")
            if start and end:
                stages[(info["Stage ID"], info["Stage Attempt ID"])] = (
                    end - start, info["Number of Tasks"], info["Stage Name"][:70])
    total = sum(v[0] for v in stages.values())
    print(f"{len(stages)} stages, {total / 1000:.1f} s of stage time")
    for (sid, att), (ms, tasks, name) in sorted(stages.items(), key=lambda kv: -kv[1][0])[:top]:
        print(f"stage {sid:5d}.{att} {ms / 1000:7.2f}s {tasks:5d} tasks  {name}")


if __name__ == "__main__":
    main()
