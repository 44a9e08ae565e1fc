"""Stage timings of one query from Spark's event log (written to a scratch
folder; no UI/REST).  python tests/stage_times.py <scratch> <sf_dir> <query>"""

import glob
import json
import sys
import time

sys.path.insert(0, ".")

import __spark_entry__ as E  # noqa: E402
from rxlake.session import get_spark  # noqa: E402


def main():
    scratch, sf, name = sys.argv[1:4]
    spark = get_spark(master="local[8]", shuffle_partitions=8, extra={
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": scratch,
        "spark.eventLog.compress": "false", "spark.eventLog.rolling.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    E.queries()["d7_kpi_active_trials"](spark, sf).write.format("noop").mode("overwrite").save()  # warm-up
    t0 = time.time()
    E.queries()[name](spark, sf).write.format("noop").mode("overwrite").save()
    wall = time.time() - t0
    spark.stop()
    stages = []
    import os

    for path in [p for p in glob.glob(f"{scratch}/**", recursive=True) if os.path.isfile(p)]:
        for line in open(path):
            ev = json.loads(line)
            if ev.get("Event") == "SparkListenerStageCompleted":
                info = ev["Stage Info"]
                if info.get("Submission Time", 0) / 1000 >= t0:
                    stages.append(((info["Completion Time"] - info["Submission Time"]) / 1000,
                                   info["Number of Tasks"], info["Stage Name"][:60]))
    print(f"{name}: wall {wall:.2f}s, {len(stages)} stages, stage-time sum {sum(s[0] for s in stages):.2f}s")
    for dur, tasks, sname in sorted(stages, reverse=True)[:6]:
        print(f"  {dur:6.2f}s  tasks={tasks:3d}  {sname}")


if __name__ == "__main__":
    main()
