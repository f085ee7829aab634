"""Summarise a Spark event log: wall time per job and the slowest stages.

    python scripts/stage_times.py <event-log-file> [top]
"""

import json
import sys


def main():
    import glob
    import os

    path = sys.argv[1]
    if os.path.isdir(path):  # rolling event log folder (eventlog_v2_*)
        files = sorted(glob.glob(os.path.join(path, "events_*")))
    else:
        files = [path]
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 15
    stages, jobs = {}, {}
    def lines(p):
        if p.endswith(".zstd"):
            import io

            import zstandard
            with open(p, "rb") as fh:
                yield from io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(fh), encoding="utf-8")
        else:
            yield from open(p)

    for line in (ln for p in files for ln in lines(p)):
        if True:
            e = json.loads(line)
            ev = e.get("Event")
            if ev == "SparkListenerStageCompleted":
                si = e["Stage Info"]
                dur = si.get("Completion Time", 0) - si.get("Submission Time", 0)
                stages[si["Stage ID"]] = (dur, si["Number of Tasks"], si["Stage Name"][:90])
            elif ev == "SparkListenerJobStart":
                jobs[e["Job ID"]] = [e["Submission Time"], None, len(e.get("Stage IDs", []))]
            elif ev == "SparkListenerJobEnd":
                jobs[e["Job ID"]][1] = e["Completion Time"]
    print(f"jobs: {len(jobs)}  total job wall ms: {sum((b - a) for a, b, _ in jobs.values() if b)}")
    for sid, (dur, n, name) in sorted(stages.items(), key=lambda kv: -kv[1][0])[:top]:
        print(f"stage {sid:4d} {dur:6d} ms tasks={n:4d} {name}")


if __name__ == "__main__":
    main()
