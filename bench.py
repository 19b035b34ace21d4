"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the tables and BENCH_CPUS the local cores. Every query is run to its last row
into Spark's no-op sink, three times; the fastest run counts, so the first ones serve as warm-up.
The insurance inputs are derived from the test tables and stored before the clock starts.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from checks.queries import TYPED
from spelltide.plans import bridge
from spelltide.session import apply_settings
from spelltide.sources.scratch import drop_path, scratch_path
from spelltide.sources.tables import located

HEADLINE = [
    "triangle_month",
    "triangle_report",
    "dq_triangle_suite",
    "fx_wide",
    "fx_convert",
    "membership_months",
    "membership_months_late",
    "membership_with_residence",
    "best_spell_per_month",
    "membership_report",
    "membership_report_late",
    "membership_medical",
    "residence_overlap_join",
    "spell_snapshot",
    "cover_pivot",
    "scan_distinct",
    "write_roundtrip_partitioned",
]
RUNS = 3


INPUTS = ["claims", "exchange_rates", "eligibility", "residences"]


def store_inputs(spark: SparkSession, sf_dir: str) -> str:
    """Write the derived inputs once and let the queries read them; returns the folder."""
    root = scratch_path(spark, "bench")
    for name in INPUTS:
        getattr(bridge, name)(spark, sf_dir).write.parquet(f"{root}/{name}")
        setattr(bridge, name, lambda spark, _, path=f"{root}/{name}": spark.read.parquet(path))
    bridge.placed_eligibility = lambda spark, sf: located(bridge.eligibility(spark, sf))
    return root


def seconds(spark: SparkSession, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    TYPED[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    apply_settings(spark)
    root = store_inputs(spark, sf_dir)
    times = {}
    try:
        for name in sys.argv[1:] or HEADLINE:
            times[name] = round(min(seconds(spark, name, sf_dir) for _ in range(RUNS)), 3)
    finally:
        drop_path(spark, root)
    spark.stop()
    label = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "total_query_time", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": label}))


if __name__ == "__main__":
    main()
