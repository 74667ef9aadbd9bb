"""Shuffle volume and task skew of the foreign-key plans, from Spark's event log.

The child is lineitem with about a third of its rows moved onto one key
that has no parent (the hot-key case), and broadcasts are switched off so the
parent behaves as if it were too large to broadcast; partition coalescing is
off so that one reduce task reads one hash partition. Each plan runs under
its own job group; the event log (written to a fresh scratch folder) gives
shuffle bytes written and the most records one reduce task read.

Usage: python tools/skew_report.py [sf_dir]
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
import time
from collections import defaultdict

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

import sluice as S  # noqa: E402


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    logs = tempfile.mkdtemp(prefix="sluice-eventlog-")
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "16")
        .config("spark.sql.autoBroadcastJoinThreshold", "-1")
        .config("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "false")
        .config("spark.eventLog.enabled", "true")
        .config("spark.eventLog.dir", logs)
        .config("spark.eventLog.compress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="sluice-ckpt-"))
    line = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    child = line.select(
        "l_orderkey", "l_linenumber",
        F.when(F.col("l_linenumber") <= 2, F.lit(-7)).otherwise(F.col("l_orderkey")).alias("fk"),
    )
    parent = spark.read.parquet(f"{sf_dir}/orders.parquet")
    plans = {
        "direct": {"strategy": "direct"},
        "auto": {"strategy": "auto"},
        # Parent over the broadcast bound: the two-phase plan with hot-key split.
        "auto-big": {"strategy": "auto", "max_broadcast_keys": 1000, "hot_key_rows": 20_000},
        "keys": {"strategy": "keys"},
    }
    walls, counts = {}, {}
    spark.sparkContext.setJobGroup("warmup", "warmup")
    for kw in plans.values():
        S.orphans(child, parent, "fk", parent_key="o_orderkey", **kw).count()
    for name, kw in plans.items():
        spark.sparkContext.setJobGroup(name, name)
        t0 = time.perf_counter()
        df = S.foreign_key_issues(child, parent, "fk", ["l_orderkey", "l_linenumber"], "lineitem",
                                  parent_key="o_orderkey", **kw)
        counts[name] = df.count()
        walls[name] = time.perf_counter() - t0
    # Dedup on (key, line number): lineitem's own rare duplicates (~4 % of rows),
    # then with ~29 % of rows moved onto two hot duplicated keys.
    cases = {
        "natural": line.withColumn("k", F.col("l_orderkey")),
        "hot": line.withColumn("k", F.when(F.col("l_linenumber") <= 2, F.lit(-1)).otherwise(F.col("l_orderkey"))),
    }
    dedups = {}
    for case, frame in cases.items():
        for label, strategy in [("full", "shuffle"), ("dup-only", "duplicated")]:
            name = f"dedup {case} {label}"
            spark.sparkContext.setJobGroup("warmup", "warmup")
            counts[name] = S.dedup(frame, ["k", "l_linenumber"], strategy=strategy).count()
            spark.sparkContext.setJobGroup(name, name)
            t0 = time.perf_counter()
            S.dedup(frame, ["k", "l_linenumber"], strategy=strategy).write.format("noop").mode("overwrite").save()
            walls[name] = time.perf_counter() - t0
            dedups[name] = {}
    plans.update(dedups)

    # Lookup of the order's status for every line item, with ~29 % of the rows
    # on one hot order key; the parent is forced over the broadcast bound.
    orders_s = parent.select("o_orderkey", "o_orderstatus")
    hot_child = line.select("l_orderkey", "l_linenumber").withColumn(
        "l_orderkey", F.when(F.col("l_linenumber") <= 2, F.lit(7)).otherwise(F.col("l_orderkey")))
    lookups = {"lookup plain join": None, "lookup hot-key split": {"max_broadcast_rows": 1000, "hot_key_rows": 20_000}}
    for name, kw in lookups.items():
        def run():
            if kw is None:
                return hot_child.join(orders_s.withColumnRenamed("o_orderkey", "l_orderkey"), "l_orderkey", "left")
            return S.lookup_first(hot_child, orders_s, "l_orderkey", ["o_orderstatus"], parent_key="o_orderkey", **kw)
        spark.sparkContext.setJobGroup("warmup", "warmup")
        counts[name] = run().count()
        spark.sparkContext.setJobGroup(name, name)
        t0 = time.perf_counter()
        run().write.format("noop").mode("overwrite").save()
        walls[name] = time.perf_counter() - t0
        plans[name] = {}
    spark.sparkContext.setJobGroup("done", "done")
    app_id = spark.sparkContext.applicationId
    spark.stop()

    stage_group, shuffle_bytes, max_read = {}, defaultdict(int), defaultdict(int)
    paths = [p for p in glob.glob(os.path.join(logs, f"*{app_id}*", "*")) + glob.glob(os.path.join(logs, f"*{app_id}*"))
             if os.path.isfile(p)]
    for path in sorted(paths):
        with open(path) as fh:
            for raw in fh:
                ev = json.loads(raw)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    group = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                    for sid in ev.get("Stage IDs", []):
                        stage_group[sid] = group
                elif kind == "SparkListenerTaskEnd":
                    group = stage_group.get(ev.get("Stage ID"))
                    m = ev.get("Task Metrics") or {}
                    shuffle_bytes[group] += (m.get("Shuffle Write Metrics") or {}).get("Shuffle Bytes Written", 0)
                    rm = m.get("Shuffle Read Metrics") or {}
                    max_read[group] = max(max_read[group], rm.get("Total Records Read", 0))
    print(f"event log: {logs}")
    print(f"{'plan':22s} {'rows out':>9s} {'wall s':>7s} {'shuffle MB':>11s} {'max records/reduce task':>24s}")
    for s in plans:
        print(f"{s:22s} {counts[s]:9d} {walls[s]:7.2f} {shuffle_bytes[s] / 1e6:11.2f} {max_read[s]:24d}")


if __name__ == "__main__":
    main()
