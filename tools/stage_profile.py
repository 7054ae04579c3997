"""Per-query job / stage / task counts and wall time from Spark's event log
(written to a fresh scratch folder).

    python tools/stage_profile.py sf_dir query [query ...]
"""

import glob
import io
import json
import os
import sys
import tempfile
import time

import zstandard

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def main(argv):
    sf, names = argv[1], argv[2:]
    d = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    from clickforge.session import build_session
    from clickforge.plans import queries as q
    spark = build_session(shuffle_partitions=16, extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": d})
    q.ingested(spark, sf)
    q.QUERIES["count_by_key"](spark, sf).write.format("noop").mode("overwrite").save()
    walls = {}
    for n in names:
        spark.sparkContext.setJobGroup(n, n)
        df = q.QUERIES[n](spark, sf)
        t = time.time()
        df.write.format("noop").mode("overwrite").save()
        walls[n] = time.time() - t
    spark.stop()
    f = glob.glob(d + "/*/events_*")[0]
    text = io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(open(f, "rb")), encoding="utf-8")
    jobs, group, stage_job, stages, run_ms, snames = {}, {}, {}, {}, {}, {}
    cpu_ms, gc_ms = {}, {}
    for line in text:
        e = json.loads(line)
        ev = e["Event"]
        if ev == "SparkListenerJobStart":
            group[e["Job ID"]] = (e.get("Properties") or {}).get("spark.jobGroup.id")
            for s in e["Stage IDs"]:
                stage_job[s] = e["Job ID"]
        elif ev == "SparkListenerStageCompleted":
            si = e["Stage Info"]
            stages[si["Stage ID"]] = (si["Number of Tasks"], si.get("Completion Time", 0) - si.get("Submission Time", 0))
            snames[si["Stage ID"]] = si.get("Details", "").split("\n")[0][:60]
        elif ev == "SparkListenerTaskEnd":
            m = e.get("Task Metrics") or {}
            run_ms[e["Stage ID"]] = run_ms.get(e["Stage ID"], 0) + m.get("Executor Run Time", 0)
            cpu_ms[e["Stage ID"]] = cpu_ms.get(e["Stage ID"], 0) + m.get("Executor CPU Time", 0) / 1e6
            gc_ms[e["Stage ID"]] = gc_ms.get(e["Stage ID"], 0) + m.get("JVM GC Time", 0)
    for n in names:
        js = [j for j, g in group.items() if g == n]
        ss = [v for s, v in stages.items() if group.get(stage_job.get(s)) == n]
        sids = [s for s in stages if group.get(stage_job.get(s)) == n]
        print(f"{n:24s} wall {walls[n]:6.2f}s  jobs {len(js):4d}  stages {len(ss):4d}  tasks {sum(t for t, _ in ss):5d}  "
              f"stage-sec {sum(x for _, x in ss) / 1000:7.1f}  task-run-sec {sum(run_ms.get(s, 0) for s in sids) / 1000:7.1f}  "
              f"cpu-sec {sum(cpu_ms.get(s, 0) for s in sids) / 1000:6.1f}  gc-sec {sum(gc_ms.get(s, 0) for s in sids) / 1000:5.1f}")
        if os.environ.get("PROFILE_DETAIL"):
            for s in sorted(sids, key=lambda s: -stages[s][1])[:12]:
                print(f"    stage {s:4d} tasks {stages[s][0]:3d} dur {stages[s][1]:6d}ms run {run_ms.get(s, 0):6d}ms "
                      f"cpu {cpu_ms.get(s, 0):8.0f}ms gc {gc_ms.get(s, 0):5d}ms")


if __name__ == "__main__":
    main(sys.argv)
