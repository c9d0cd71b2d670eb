"""Summarise a Spark event log: the slowest stages and the job count.

Usage: python scripts/eventlog_stages.py EVENT_LOG_DIR [top_n]
Reads every event file under the folder (as written by ``spark.eventLog``)
and prints one line per stage: duration, tasks, and the call site Spark
recorded for it.
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys


def _lines(path: str):
    """Lines of an event file; Spark 4 compresses event logs with zstd by default."""
    if path.endswith(".zstd") or path.endswith(".zst"):
        import zstandard

        with open(path, "rb") as raw, zstandard.ZstdDecompressor().stream_reader(raw) as reader:
            yield from io.TextIOWrapper(reader, encoding="utf-8", errors="replace")
    else:
        with open(path, encoding="utf-8", errors="replace") as fh:
            yield from fh


def main() -> None:
    folder = sys.argv[1]
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 15
    stages, jobs = [], 0
    stage_job: dict[int, str] = {}
    for path in glob.glob(os.path.join(folder, "**", "*"), recursive=True):
        if os.path.isdir(path):
            continue
        for line in _lines(path):
            try:
                ev = json.loads(line)
            except json.JSONDecodeError:
                continue
            if not isinstance(ev, dict):
                continue
            if ev.get("Event") == "SparkListenerJobStart":
                jobs += 1
                desc = (ev.get("Properties") or {}).get("spark.job.description") or ""
                for sid in ev.get("Stage IDs", []):
                    stage_job[sid] = desc
            if ev.get("Event") == "SparkListenerStageCompleted":
                info = ev["Stage Info"]
                start, end = info.get("Submission Time"), info.get("Completion Time")
                if start and end:
                    stages.append((end - start, info.get("Number of Tasks"),
                                   stage_job.get(info.get("Stage ID"), "") or info.get("Stage Name", "")))
    total = sum(s[0] for s in stages)
    print(f"jobs={jobs} stages={len(stages)} stage_ms_total={total}")
    by_desc: dict[str, int] = {}
    for ms, _, name in stages:
        by_desc[name] = by_desc.get(name, 0) + ms
    for name, ms in sorted(by_desc.items(), key=lambda kv: -kv[1])[:top]:
        print(f"{ms:7d} ms  (all stages)  {name[:110]}")
    print("slowest stages:")
    for ms, tasks, name in sorted(stages, reverse=True)[:top]:
        print(f"{ms:7d} ms  tasks={tasks:<4} {name[:110]}")


if __name__ == "__main__":
    main()
