"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR   folder of the tables (default /root/testdata/sf0.1)
BENCH_CPUS     threads of local Spark (default 4)
BENCH_QUERIES  comma-separated names, or 'all' (default: the headline queries)
BENCH_RUNS     timed runs after one warm-up; the median is reported (default 3)
"""

from __future__ import annotations

import json
import os
import statistics
import time
from pathlib import Path

from pyspark.sql import SparkSession

from tallybook.plans import QUERIES

HEADLINE = [
    "cumulative_step",
    "cumulative_backfill",
    "scd2_full",
    "scd2_incremental",
    "scd2_asof",
    "merge_upsert",
    "additivity_check",
    "additive_rollup",
    "player_vertices",
    "plays_in_edges",
    "player_pair_edges",
    "opponent_stats",
    "graph_integrity",
    "fact_dedup",
    "fact_denormalize",
    "raw_logs_to_facts",
]


def timed(spark: SparkSession, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "4")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if chosen == "all" else chosen.split(",") if chosen else HEADLINE

    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tallybook-bench")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in names:
        timed(spark, name, sf_dir)
        times[name] = round(statistics.median(timed(spark, name, sf_dir) for _ in range(runs)), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total of median query times",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": Path(sf_dir).name.removeprefix("sf"),
                "cpus": cpus,
            }
        )
    )


if __name__ == "__main__":
    main()
