"""Per-stage timings and the formatted plan of registered queries.

    python scripts/profile_query.py [--sf DIR] [--plan] name [name ...]

Runs each query twice with the ``noop`` sink and an event log in a fresh
scratch folder, then prints (stage id, tasks, ms, name) for the second run.
A local development tool: it builds its own ``local[8]`` session and keeps the
event log in a machine-local temporary folder, which is not for cluster use.
"""

from __future__ import annotations

import argparse
import glob
import io
import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def read_events(folder: str) -> list[dict]:
    import zstandard

    out = []
    for f in sorted(glob.glob(f"{folder}/*/events*")) + sorted(glob.glob(f"{folder}/events*")):
        with open(f, "rb") as fh:
            if f.endswith(".zstd"):
                text = io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(fh, read_across_frames=True)).read()
            else:
                text = fh.read().decode()
        out += [json.loads(line) for line in text.splitlines() if line.strip()]
    return out


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.1")
    ap.add_argument("--plan", action="store_true")
    ap.add_argument("names", nargs="+")
    a = ap.parse_args()
    from pyspark.sql import SparkSession

    from marquee.plans.queries import QUERIES
    from marquee.session import ADAPTIVE_CONF, ensure_checkpoint_dir

    log_dir = tempfile.mkdtemp(prefix="marquee-evlog-")
    b = SparkSession.builder.master("local[8]").config("spark.eventLog.enabled", "true")
    b = b.config("spark.eventLog.dir", log_dir).config("spark.ui.enabled", "false")
    b = b.config("spark.ui.showConsoleProgress", "false").config("spark.sql.shuffle.partitions", "16")
    for k, v in ADAPTIVE_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    walls = {}
    for n in a.names:
        df = QUERIES[n](spark, a.sf)
        if a.plan:
            df.explain("formatted")
        df.write.format("noop").mode("overwrite").save()
        spark.sparkContext.setJobGroup(n, n)
        t0 = time.perf_counter()
        QUERIES[n](spark, a.sf).write.format("noop").mode("overwrite").save()
        walls[n] = time.perf_counter() - t0
        spark.sparkContext.setJobGroup("", "")
    spark.stop()
    events = read_events(log_dir)
    stage_group, stages = {}, {}
    for e in events:
        if e["Event"] == "SparkListenerJobStart":
            g = e.get("Properties", {}).get("spark.jobGroup.id")
            for s in e["Stage IDs"]:
                stage_group[s] = g
        if e["Event"] == "SparkListenerStageCompleted":
            s = e["Stage Info"]
            stages[s["Stage ID"]] = (s["Number of Tasks"], s["Completion Time"] - s["Submission Time"], s["Stage Name"][:40])
    for n in a.names:
        print(f"== {n}: {walls[n]:.2f}s wall")
        for sid, (tasks, ms, name) in sorted(stages.items()):
            if stage_group.get(sid) == n:
                print(f"   stage {sid:4d} tasks {tasks:4d} {ms:6d} ms  {name}")


if __name__ == "__main__":
    main()
