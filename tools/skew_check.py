"""Measure how the grouping steps handle a hot row / hot key.

Usage: python -m tools.skew_check [sf_dir]

Writes Spark's event log to a fresh folder under ``/tmp`` (this is a local
measurement tool, not a job) and prints, per shuffle-reading stage, the
records read in total and by the busiest task.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile

import zstandard
from pyspark.sql import functions as F


def reduce_side(logdir: str) -> dict[int, list[int]]:
    stages: dict[int, list[int]] = {}
    for path in glob.glob(os.path.join(logdir, "*", "events_*")):
        with open(path, "rb") as fh:
            data = fh.read()
        text = (zstandard.ZstdDecompressor().stream_reader(data).read() if path.endswith(".zstd") else data)
        for line in text.decode("utf-8", "ignore").splitlines():
            event = json.loads(line)
            if event.get("Event") != "SparkListenerTaskEnd":
                continue
            read = (event.get("Task Metrics") or {}).get("Shuffle Read Metrics") or {}
            if read.get("Total Records Read"):
                stages.setdefault(event["Stage ID"], []).append(read["Total Records Read"])
    return stages


def main(argv):
    sys.path.insert(0, ".")
    from sluice.operators.upsert import keyed_upsert
    from sluice.plans.admissions import admissions_clean
    from sluice.session import build_session
    from sluice.sources.fixtures import admissions_raw

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    logdir = tempfile.mkdtemp(prefix="sluice-events-")
    spark = build_session(
        "local[8]", app_name="sluice-skew", shuffle_partitions=16,
        extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": "file://" + logdir},
    )
    raw = admissions_raw(spark, sf_dir)
    n = raw.count()
    hot = raw.limit(1).withColumn("_c", F.explode(F.sequence(F.lit(1), F.lit(n // 2)))).drop("_c")
    clean = admissions_clean(raw.unionByName(hot)).count()  # the hot row: a third of the input
    print(f"dedup: {n + n // 2} rows in, one row {n // 2 + 1} times; {clean} clean rows out")

    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    existing = orders.selectExpr("o_orderkey AS key", "o_totalprice AS amount", "CAST(1 AS BIGINT) AS batch")
    len_hot = orders.count() // 2
    hot_key = spark.range(len_hot).selectExpr(
        "CAST(1 AS BIGINT) AS key", "CAST(id AS DOUBLE) AS amount", "CAST(id % 3 + 1 AS BIGINT) AS batch"
    )
    batch = orders.where("o_orderpriority = '1-URGENT'").selectExpr(
        "o_orderkey AS key", "o_totalprice * 2 AS amount", "CAST(2 AS BIGINT) AS batch"
    )
    merged = keyed_upsert(existing.unionByName(hot_key), batch, ["key"], "batch").count()
    print(f"upsert: key 1 carries {len_hot} versions; {merged} keys out")
    spark.stop()
    for stage, records in sorted(reduce_side(logdir).items()):
        print(f"stage {stage:3d}: {len(records):3d} reduce tasks, {sum(records):8d} records, busiest {max(records):8d}")


if __name__ == "__main__":
    main(sys.argv)
