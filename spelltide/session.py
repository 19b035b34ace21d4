"""Session settings the reports rely on."""

from __future__ import annotations

import math
import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    # Overflowing amounts raise instead of turning null.
    "spark.sql.ansi.enabled": "true",
    "spark.sql.parquet.datetimeRebaseModeInRead": "CORRECTED",
    "spark.sql.parquet.datetimeRebaseModeInWrite": "CORRECTED",
    "spark.sql.parquet.int96RebaseModeInRead": "CORRECTED",
    "spark.sql.parquet.int96RebaseModeInWrite": "CORRECTED",
    "spark.sql.legacy.timeParserPolicy": "CORRECTED",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Spells are few bytes each and expand to many months, so small partitions are worth a task.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "128k",
}

PARTITION_BYTES = 128 << 20
MOST_PARTITIONS = 50_000


def shuffle_partitions(shuffled_bytes: int, cores: int) -> int:
    """Partitions of about 128 MB each, at least two per core and at most 50 000."""
    return max(2 * cores, min(MOST_PARTITIONS, math.ceil(shuffled_bytes / PARTITION_BYTES)))


def apply_settings(spark: SparkSession, shuffled_bytes: int | None = None, overrides: dict[str, str] | None = None) -> SparkSession:
    """Set the run-time options.

    With the expected size of the largest shuffle given, shuffles start with enough partitions for
    it; AQE merges those that turn out small.
    """
    settings = dict(SETTINGS)
    if shuffled_bytes is not None:
        wanted = shuffle_partitions(shuffled_bytes, spark.sparkContext.defaultParallelism)
        settings["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] = str(wanted)
    for key, value in {**settings, **(overrides or {})}.items():
        spark.conf.set(key, value)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors' Python, once per application, as a zip file through Spark."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parent
    archive = shutil.make_archive(str(Path(tempfile.mkdtemp()) / package.name), "zip", package.parent, package.name)
    context.addPyFile(archive)
    _SHIPPED.add(context.applicationId)
