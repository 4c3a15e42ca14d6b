"""Input records that queries read, against one full pass over the service lines.

usage: python tools/pass_count.py [sf_dir] [name ...]
Runs each query with Spark's event log on, written to a scratch folder, and
sums the records that tasks read from files and from checkpoints.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

NAMES = ["alert_ranking", "next_best_offer", "campaign_target_list", "capacity_schedule", "audit_status", "standardized_features",
         "association_rules", "frequent_itemsets", "value_score", "weekly_demand", "customer_rollup"]


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or NAMES
    folder = tempfile.mkdtemp(prefix="events-")
    os.environ["PYSPARK_SUBMIT_ARGS"] = f"--conf spark.eventLog.enabled=true --conf spark.eventLog.dir=file://{folder} --conf spark.eventLog.compress=false pyspark-shell"
    from servicelens.plans.registry import QUERIES
    from servicelens.session import local_session

    spark = local_session(4)
    for name in ["visit_rollup", *names]:
        spark.sparkContext.setJobGroup(name, name)
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    spark.stop()
    group, jobs, read, shared = {}, {}, {}, {}
    for root, _, files in os.walk(folder):
        for f in sorted(files):
            for line in open(os.path.join(root, f), errors="replace"):
                if not line.startswith("{"):
                    continue
                e = json.loads(line)
                if e["Event"] == "SparkListenerJobStart":
                    name = (e.get("Properties") or {}).get("spark.jobGroup.id")
                    jobs[name] = jobs.get(name, 0) + 1
                    group.update({s: name for s in e["Stage IDs"]})
                elif e["Event"] == "SparkListenerTaskEnd" and e.get("Task Metrics"):
                    name = group.get(e["Stage ID"])
                    m = e["Task Metrics"]
                    read[name] = read.get(name, 0) + m["Input Metrics"]["Records Read"]
                    shared[name] = shared.get(name, 0) + m["Shuffle Read Metrics"]["Total Records Read"]
    one = read["visit_rollup"]
    for name in ["visit_rollup", *names]:
        print(f"{name:24s} jobs={jobs.get(name, 0):4d} records={read.get(name, 0):9d} ({read.get(name, 0) / one:.1f}x) shuffled={shared.get(name, 0)}")


if __name__ == "__main__":
    main()
