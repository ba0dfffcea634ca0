"""Per-task load when one key holds a large share of the rows.

1. Writes `lineitem` (classified by the lineitem spec, whose fallback label
   holds a third of the rows) with a plain `repartition(label)` and with
   `write_partitioned`; reports records written per task.
2. Computes marginal statistics over (l_returnflag, brand, l_orderkey), where
   `brand` is null on every row, with one window per column and with
   `count_statistics`; reports shuffle records read per task.

Numbers come from the Spark event log. Usage:
python tools/skew_check.py OUT_DIR [SF_DIR]. OUT_DIR must not exist.
"""

from __future__ import annotations

import collections
import glob
import io
import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402


def task_metrics(out: str, metric: tuple[str, str]) -> dict[str, list[int]]:
    import zstandard

    stage_group: dict[int, str] = {}
    recs: dict[str, list[int]] = collections.defaultdict(list)
    for ev in sorted(glob.glob(f"{out}/events/*/events_*")):
        raw = open(ev, "rb")
        stream = zstandard.ZstdDecompressor().stream_reader(raw) if ev.endswith(".zstd") else raw
        for line in io.TextIOWrapper(stream, encoding="utf-8"):
            e = json.loads(line)
            if e["Event"] == "SparkListenerJobStart":
                for s in e["Stage IDs"]:
                    stage_group[s] = (e.get("Properties") or {}).get("spark.jobGroup.id")
            elif e["Event"] == "SparkListenerTaskEnd":
                w = ((e.get("Task Metrics") or {}).get(metric[0]) or {}).get(metric[1], 0)
                if w:
                    recs[stage_group.get(e["Stage ID"])].append(w)
    return recs


def main() -> None:
    out = sys.argv[1]
    sf_dir = sys.argv[2] if len(sys.argv) > 2 else "/root/testdata/sf0.1"
    os.makedirs(f"{out}/events")
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.eventLog.enabled", "true")
        .config("spark.eventLog.dir", f"{out}/events")
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    from tallyrule.operators.classify import classify
    from tallyrule.plans.table_queries import LINEITEM_SPEC
    from tallyrule.sources import write_partitioned

    # Many input splits stand in for a many-file scan; skew splitting works
    # along map tasks.
    lab = classify(spark.read.parquet(f"{sf_dir}/lineitem.parquet").repartition(32), LINEITEM_SPEC)
    spark.sparkContext.setJobGroup("repartition", "repartition by label")
    lab.repartition("brands_part").write.mode("overwrite").partitionBy("brands_part").csv(f"{out}/repartition")
    spark.sparkContext.setJobGroup("rebalance", "write_partitioned")
    write_partitioned(lab, f"{out}/rebalance", ["brands_part"])

    # Small partitions stand in for data far larger than a partition.
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "16k")
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from tallyrule.operators.stats import count_statistics

    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet").repartition(32)
    li = li.withColumn("brand", F.lit(None).cast("string"))
    keys = ["l_returnflag", "brand", "l_orderkey"]
    joint = li.groupBy(*keys).count()
    windows = joint.select(
        *keys, *[F.sum("count").over(Window.partitionBy(c)).alias(f"{c}_count") for c in keys]
    ).orderBy(*[F.col(f"{c}_count").desc() for c in keys])
    spark.sparkContext.setJobGroup("windows", "one window per column")
    a = sorted(map(tuple, windows.collect()))
    spark.sparkContext.setJobGroup("count_statistics", "count_statistics")
    b = sorted(map(tuple, count_statistics(li, *keys).collect()))
    spark.stop()
    assert a == b
    metrics = {**task_metrics(out, ("Output Metrics", "Records Written"))}
    reads = task_metrics(out, ("Shuffle Read Metrics", "Total Records Read"))
    for group in ("windows", "count_statistics"):
        metrics[group] = reads[group]
    for group, r in metrics.items():
        r = sorted(r)
        print(json.dumps({"run": group, "tasks": len(r), "max": r[-1], "median": r[len(r) // 2], "total": sum(r)}))


if __name__ == "__main__":
    main()
