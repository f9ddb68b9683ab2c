"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the folder of Parquet tables, BENCH_CPUS the local cores.
Every query runs in full into a sink that discards the rows.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from stratacast.plans.queries import QUERIES  # noqa: E402

HEADLINE = (
    "panel_long",
    "lag_features",
    "rolling_features",
    "feature_table",
    "level_aggregate",
    "wrmsse_levels",
    "top_down",
    "mintrace_coherent",
    "mintrace_incoherent",
    "store_report",
    "leaderboard",
    "column_profile",
    "hierarchy_cardinality",
    "horizon_template",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        start = time.time()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - start, 3)
    spark.stop()
    total = round(sum(seconds.values()), 3)
    sf = Path(folder).name.removeprefix("sf")
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": seconds, "sf": sf}))


if __name__ == "__main__":
    main()
