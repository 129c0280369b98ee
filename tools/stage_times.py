"""Per-stage task-time spread from a Spark event log (a skew check).

    BENCH_EVENT_LOG=1 python bench.py          # prints the event log folder
    python tools/stage_times.py <event-log-file-or-folder> [top]

For every stage: tasks, total task seconds, median and max task time, and
max/median (a large ratio means one task carried much more than the others).
Reads only the JSON lines Spark writes; nothing is served or fetched.
"""

from __future__ import annotations

import json
import os
import statistics
import sys


def _event_files(path: str) -> list[str]:
    if not os.path.isdir(path):
        return [path]
    out = []
    for root, _, files in os.walk(path):
        out += [os.path.join(root, f) for f in sorted(files)
                if not f.startswith(".") and not f.startswith("appstatus")]
    return out


def _lines(path: str):
    if path.endswith(".zstd"):
        import io
        import zstandard
        with open(path, "rb") as fh:
            reader = zstandard.ZstdDecompressor().stream_reader(fh, read_across_frames=True)
            yield from io.TextIOWrapper(reader, encoding="utf-8")
    else:
        with open(path) as fh:
            yield from fh


def stage_stats(path: str) -> list[dict]:
    tasks: dict[tuple[int, int], list[float]] = {}
    names: dict[tuple[int, int], str] = {}
    for f in _event_files(path):
        for line in _lines(f):
            ev = json.loads(line)
            kind = ev.get("Event")
            if kind == "SparkListenerTaskEnd":
                info = ev["Task Info"]
                key = (ev["Stage ID"], ev["Stage Attempt ID"])
                dur = (info["Finish Time"] - info["Launch Time"]) / 1000.0
                tasks.setdefault(key, []).append(dur)
            elif kind == "SparkListenerStageCompleted":
                si = ev["Stage Info"]
                names[(si["Stage ID"], si["Stage Attempt ID"])] = si.get("Stage Name", "")
    out = []
    for key, durs in tasks.items():
        med = statistics.median(durs)
        out.append({"stage": key[0], "attempt": key[1], "name": names.get(key, "")[:60],
                    "tasks": len(durs), "task_sec": round(sum(durs), 3),
                    "median": round(med, 3), "max": round(max(durs), 3),
                    "skew": round(max(durs) / med, 1) if med > 0 else None})
    return sorted(out, key=lambda r: -r["task_sec"])


def main(argv) -> None:
    rows = stage_stats(argv[1])
    top = int(argv[2]) if len(argv) > 2 else 20
    print("| stage | tasks | task sec | median | max | max/median | name |")
    print("| --- | --- | --- | --- | --- | --- | --- |")
    for r in rows[:top]:
        print(f"| {r['stage']}.{r['attempt']} | {r['tasks']} | {r['task_sec']} | {r['median']} | "
              f"{r['max']} | {r['skew']} | {r['name']} |")


if __name__ == "__main__":
    main(sys.argv)
