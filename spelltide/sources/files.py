"""File scans and sinks."""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from spelltide.operators.conform import mirror_column
from spelltide.sources.scratch import drop_path, file_system, hadoop_path, scratch_path
from spelltide.sources.staging import publish, staging_path

__all__ = ["drop_path", "output_path", "read_files", "scratch_path", "write_frame", "write_reports"]

log = logging.getLogger(__name__)

TEXT_FORMATS = {"txt": "csv", "csv": "csv"}
FORMATS = {**TEXT_FORMATS, **{kind: kind for kind in ("json", "parquet", "orc", "text", "xml", "avro")}}
REPORT_NAME_LENGTH = 30


def read_files(
    spark: SparkSession,
    paths: str | list[str],
    file_format: str = "parquet",
    schema: StructType | str | None = None,
    options: dict | None = None,
) -> DataFrame:
    """Read one or several paths of a format; delimited text has a header unless told otherwise.

    An unknown format is logged and gives an empty frame with the given schema.
    """
    kind = FORMATS.get(file_format.lower())
    if kind is None:
        log.error("unknown file format %s, expected one of %s", file_format, sorted(FORMATS))
        return spark.createDataFrame([], schema or StructType([]))
    reader = spark.read.format(kind).options(**({"header": "true"} if kind == "csv" else {}))
    if options:
        reader = reader.options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(paths)


def output_path(bucket: str, prefix: str, name: str, output_format: str | None = None, scheme: str = "s3a") -> str:
    """`scheme://bucket/prefix/[format/]name/`."""
    parts = [bucket, prefix, output_format, name]
    return f"{scheme}://" + "/".join(p.strip("/") for p in parts if p) + "/"


def write_frame(
    df: DataFrame,
    path: str,
    file_format: str = "parquet",
    mode: str = "overwrite",
    files: int | None = None,
    partition_by: list[str] | None = None,
    mirror: str | None = None,
    cluster: bool = False,
    skip_empty: bool = True,
    check: Callable[[DataFrame, int], None] | None = None,
    staging: str | None = None,
    direct: bool = False,
    **options: str,
) -> int:
    """Write a frame and return how many rows went out, counted by the write itself.

    The frame is computed once: it is written to a hidden folder beside the target (or to `staging`, in the same
    store), and published by renames. An empty frame leaves the target as it was (`skip_empty`), and so does a failed write and
    an error of `check`, which gets the staged rows and their count. A frame may read the path that it
    overwrites. `partitionOverwriteMode="dynamic"`, as an option or as the session's setting, replaces only the partitions that the frame has.

    `files` deals the output to so many files, by a shuffle so that the work before it keeps its tasks.
    `cluster` shuffles rows to their partition value first, which avoids a small file per task and value; AQE
    splits a value that is too large. `direct` leaves the write to Spark's committers, for stores
    where a rename is a copy; emptiness is then a job of its own, and there is no check.
    """
    spark = df.sparkSession
    if mirror:
        df = mirror_column(df, mirror)
    columns = [c for c in partition_by or [] if c.strip()]
    kind = FORMATS.get(file_format, file_format)
    if mode in ("ignore", "error", "errorifexists"):
        if file_system(spark, path).exists(hadoop_path(spark, path)):
            df.write.format(kind).mode(mode).save(path)  # raises, or does nothing
            return 0
        mode = "overwrite"
    if direct and skip_empty and df.isEmpty():
        log.info("nothing to write to %s", path)
        return 0
    if cluster and columns:
        df = df.hint("rebalance", *columns)
    if files:
        df = df.repartition(files)
    asked = {k.lower(): k for k in options}.get("partitionoverwritemode")
    way = (options.get(asked) if asked else spark.conf.get("spark.sql.sources.partitionOverwriteMode")).lower()
    dynamic = mode == "overwrite" and bool(columns) and way == "dynamic"
    counted = Observation()
    writer = df.observe(counted, F.count(F.lit(1)).alias("rows")).write.format(kind).partitionBy(*columns)
    if direct:
        writer.mode(mode).options(**options).save(path)
        return counted.get["rows"]

    place = staging or staging_path(path)
    try:
        writer.mode("errorifexists").options(**{k: v for k, v in options.items() if k != asked}).save(place)
        rows = counted.get["rows"]
        if check:
            check(spark.read.format(kind).options(**options).schema(df.schema).load(place), rows)
        if rows or not skip_empty:
            publish(spark, place, path, mode, dynamic)
    finally:
        drop_path(spark, place)
    log.info("wrote %d rows to %s", rows, path)
    return rows


def write_reports(reports: dict[str, DataFrame], root: str, file_format: str = "parquet", **options: str) -> dict[str, str]:
    """Write each report to a folder named after it, cut to 30 characters; returns the paths by report."""
    paths = {name: f"{root.rstrip('/')}/{name[:REPORT_NAME_LENGTH]}" for name in reports}
    if len(set(paths.values())) < len(paths):
        raise ValueError(f"report names collide when cut to {REPORT_NAME_LENGTH} characters: {sorted(paths)}")
    for name, df in reports.items():
        write_frame(df, paths[name], file_format, skip_empty=False, **options)
    return paths
