"""Latest-and-largest readings on a skewed input: window form vs the library's
aggregate + join-back form.  A third of the readings are moved into one
(meter, period) group; prints wall time and the longest single task.

    python tools/skew_probe.py [sf_dir]
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from meterbill.operators.readings import latest_max_reading  # noqa: E402
from meterbill.session import get_session  # noqa: E402
from meterbill.sources.standins import Standins  # noqa: E402


def window_form(ci):
    w = Window.partitionBy("cd_cntr_kid", "bl_bill_id")
    return (ci.withColumn("_d", F.max("date_ind_take").over(w)).withColumn("_v", F.max("value").over(w))
            .filter((F.col("date_ind_take") == F.col("_d")) & (F.col("value") == F.col("_v")))
            .drop("_d", "_v"))


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    logdir = tempfile.mkdtemp(prefix="meterbill-skew-")
    spark = get_session("local[8]", shuffle_partitions=16, extra={
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": logdir,
        "spark.eventLog.compress": "false", "spark.eventLog.rolling.enabled": "false"})
    ci = Standins.of(spark, sf_dir).cd_indication
    hot = F.abs(F.hash("cd_cntr_kid", "date_ind_take", "value")) % 3 == 0
    skewed = (ci.withColumn("cd_cntr_kid", F.when(hot, F.lit(0)).otherwise(F.col("cd_cntr_kid")))
              .withColumn("bl_bill_id", F.when(hot, F.lit(199901)).otherwise(F.col("bl_bill_id"))))
    marks = {}
    for name, fn in (("window", window_form), ("aggregate+join", latest_max_reading)):
        times = []
        for run in range(4):
            spark.sparkContext.setJobGroup(f"{name}#{run}", name)
            t0 = time.time()
            fn(skewed).write.format("noop").mode("overwrite").save()
            times.append(time.time() - t0)
        marks[name] = statistics.median(times[1:])
    spark.stop()
    longest = {}
    for path in glob.glob(os.path.join(logdir, "**"), recursive=True):
        if not os.path.isfile(path):
            continue
        group_of_stage = {}
        for line in open(path, encoding="utf-8"):
            ev = json.loads(line)
            if ev["Event"] == "SparkListenerStageSubmitted":
                props = ev.get("Properties") or {}
                group_of_stage[ev["Stage Info"]["Stage ID"]] = props.get("spark.jobGroup.id")
            if ev["Event"] == "SparkListenerTaskEnd":
                g = group_of_stage.get(ev["Stage ID"])
                info = ev["Task Info"]
                dur = info["Finish Time"] - info["Launch Time"]
                if g:
                    longest[g] = max(longest.get(g, 0), dur)
    for name in marks:
        warm = [longest.get(f"{name}#{run}", 0) for run in range(1, 4)]
        print(f"{name:15s} median wall {marks[name]:.2f}s, longest task per run (warm) "
              f"{statistics.median(warm):.0f} ms")


if __name__ == "__main__":
    main()
