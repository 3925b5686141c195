"""Summarise a Spark event log (rolling, possibly zstd-compressed):
jobs and stages with task counts and wall times.

    python tools/stage_times.py <event-log-dir> [--last-half]
"""

from __future__ import annotations

import glob
import io
import json
import sys


def _lines(path: str):
    if path.endswith(".zstd"):
        import zstandard

        with open(path, "rb") as fh:
            reader = zstandard.ZstdDecompressor().stream_reader(fh)
            yield from io.TextIOWrapper(reader, encoding="utf-8")
    else:
        with open(path, encoding="utf-8") as fh:
            yield from fh


def main() -> None:
    root = sys.argv[1]
    files = sorted(f for f in glob.glob(f"{root}/**/events_*", recursive=True))
    files.sort(key=lambda f: int(f.rsplit("/", 1)[1].split("_")[1]))
    stages = []
    for f in files:
        for line in _lines(f):
            e = json.loads(line)
            if e["Event"] == "SparkListenerStageCompleted":
                si = e["Stage Info"]
                stages.append((si["Stage ID"], si["Number of Tasks"],
                               si["Completion Time"] - si["Submission Time"], si["Stage Name"][:60]))
    if "--last-half" in sys.argv:
        stages = stages[len(stages) // 2:]
    total = 0
    for s in stages:
        total += s[2]
        print(f"stage {s[0]:4d} tasks {s[1]:4d} {s[2]:6d} ms  {s[3]}")
    print(f"{len(stages)} stages, {total} ms summed")


if __name__ == "__main__":
    main()
