"""Skew probe: inputs where a third of all rows share one value, are copies of
one row, or fall in one year; reports, per operator, the largest share of
shuffle records any single task read, over every stage that reads a shuffle,
and the shuffle records read in total.

    python tools/skew_probe.py [/root/testdata/sf0.1] [copies]

``copies`` repeats every lineitem row that many times (default 1) to probe
larger inputs.

Reads Spark's event log from a fresh scratch folder. Input is derived from
``lineitem`` (every row kept); nothing here is part of the library.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
from collections import defaultdict

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from strata import catalogue as C  # noqa: E402
from strata.operators import global_rank, resolve_codes, yearly_trend  # noqa: E402
from strata.session import build_session  # noqa: E402


def skewed_films(lineitem, copies: int = 1):
    """Film-shaped rows: a third share one popularity value, a third are
    copies of one row (key columns and codes), a third fall in 1995."""
    if copies > 1:
        lineitem = lineitem.select(
            "*", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("_copy"))
    else:
        lineitem = lineitem.withColumn("_copy", F.lit(0))
    k = (F.col("l_orderkey") * 8 + F.col("l_linenumber")) * copies + F.col("_copy")
    third = F.pmod(F.xxhash64(k), F.lit(3))
    copy = third == 1
    return lineitem.select(
        F.when(copy, F.lit("copy")).otherwise(k.cast("string")).alias(C.FILM_ID),
        F.lit("t").alias(C.TITLE), F.lit("o").alias(C.ORIGINAL_TITLE),
        F.lit(None).cast("date").alias(C.RELEASE_DATE),
        F.when(third == 2, F.lit(1995)).when(copy, F.lit(1990))
         .otherwise(F.year(F.col("l_shipdate").cast("date"))).alias(C.RELEASE_YEAR),
        F.when(third == 0, F.lit(100.0))
         .when(copy, F.lit(7.0)).otherwise(F.round(F.col("l_extendedprice"), 2)).alias(C.POPULARITY),
        F.lit(5.0).alias(C.RATING), F.lit(20).alias(C.VOTES),
        F.lit("it").alias(C.LANGUAGE), F.lit("d").alias(C.OVERVIEW),
        F.when(copy, F.lit("18,35")).otherwise(F.lit("28")).alias(C.CODES),
    )


MIN_STAGE_RECORDS = 10_000   # smaller stages carry pre-aggregated rows only


def task_shares(log_dir: str) -> dict[str, tuple[float, float, int]]:
    """Per job group: the largest share of shuffle records and of shuffle
    bytes read by one task (over stages that read at least MIN_STAGE_RECORDS
    shuffle records), and the shuffle records read in total."""
    stage_group, per_stage = {}, defaultdict(list)
    files = [p for p in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True)
             if os.path.isfile(p) and "appstatus" not in os.path.basename(p)]
    for path in sorted(files):
        with open(path) as log:
            for line in log:
                event = json.loads(line)
                if event.get("Event") == "SparkListenerJobStart":
                    group = (event.get("Properties") or {}).get("spark.jobGroup.id")
                    for stage in event.get("Stage IDs", []):
                        stage_group[stage] = group
                elif event.get("Event") == "SparkListenerTaskEnd":
                    read = ((event.get("Task Metrics") or {}).get("Shuffle Read Metrics") or {})
                    records = int(read.get("Total Records Read", 0))
                    size = int(read.get("Remote Bytes Read", 0)) + int(read.get("Local Bytes Read", 0))
                    if records:
                        per_stage[event["Stage ID"]].append((records, size))
    worst_records: dict[str, float] = defaultdict(float)
    worst_bytes: dict[str, float] = defaultdict(float)
    total: dict[str, int] = defaultdict(int)
    for stage, tasks in per_stage.items():
        group = stage_group.get(stage)
        if not group:
            continue
        records = [r for r, _ in tasks]
        sizes = [b for _, b in tasks]
        total[group] += sum(records)
        if len(tasks) > 1 and sum(records) >= MIN_STAGE_RECORDS:
            worst_records[group] = max(worst_records[group], max(records) / sum(records))
            if sum(sizes):
                worst_bytes[group] = max(worst_bytes[group], max(sizes) / sum(sizes))
    return {g: (worst_records[g], worst_bytes[g], total[g]) for g in total}


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    copies = int(sys.argv[2]) if len(sys.argv) > 2 else 1
    log_dir = tempfile.mkdtemp(prefix="strata-skew-events-")
    # AQE splits skewed join partitions above these sizes; scaled down from
    # the defaults (256 MB / 64 MB) to the probe's data size.
    spark = build_session("local[8]", 16, extra={
        "spark.eventLog.enabled": "true", "spark.eventLog.compress": "false",
        "spark.eventLog.dir": log_dir, "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256KB",
        # no size-based broadcasts, so the shuffle join path really runs
        # (the library's explicit, size-checked broadcasts still apply)
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"})
    # The test file is one row group, i.e. one map task; real inputs arrive
    # from many (AQE splits a skewed partition along map-output boundaries).
    films = skewed_films(spark.read.parquet(f"{sf_dir}/lineitem.parquet"), copies) \
        .repartition(16 * copies).checkpoint()
    codes = spark.createDataFrame([("18", "Drama"), ("35", "Comedia"), ("28", "Azione")],
                                  "genero_id string, genero_nombre string")
    rows = films.count()
    runs = {
        "rank_distributed": lambda: global_rank(films, C.POPULARITY),
        "rank_distributed_shuffle_join": lambda: global_rank(films, C.POPULARITY,
                                                                  broadcast_rows=0),
        "resolve_codes": lambda: resolve_codes(films, codes),
        "yearly_trend": lambda: yearly_trend(films),
    }
    for name, build in runs.items():
        spark.sparkContext.setJobGroup(name, name)
        build().write.format("noop").mode("overwrite").save()
    spark.stop()
    shares = task_shares(log_dir)
    print(json.dumps({
        "rows": rows, "hot_share_of_input": round(1 / 3, 4),
        "largest_task_share_of_shuffle_records": {
            k: round(shares.get(k, (0.0, 0.0, 0))[0], 4) for k in runs},
        "largest_task_share_of_shuffle_bytes": {
            k: round(shares.get(k, (0.0, 0.0, 0))[1], 4) for k in runs},
        "shuffle_records_read": {k: shares.get(k, (0.0, 0.0, 0))[2] for k in runs},
    }))


if __name__ == "__main__":
    main()
