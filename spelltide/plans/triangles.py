"""The triangle report job: read, build, check, write."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from spelltide.errors import PreValidationError
from spelltide.operators.conform import conform_schema, mirror_column
from spelltide.operators.quality import FX_RULE, Check, RowCounts, enforce, fx_suite, require_passed, triangle_suite, validate
from spelltide.operators.triangles import triangle_report
from spelltide.schemas import CLAIMS, EXCHANGE_RATE, TRIANGLE
from spelltide.session import apply_settings
from spelltide.sources.files import write_frame
from spelltide.sources.tables import TableSpec, require_rows, scan_table

CLAIMS_TABLE = TableSpec(name="claims", schema=CLAIMS)
RATES_TABLE = TableSpec(name="exchangerate", schema=EXCHANGE_RATE)


def run_triangles(
    spark: SparkSession,
    path: str,
    claims: TableSpec = CLAIMS_TABLE,
    rates: TableSpec = RATES_TABLE,
    partition_by: list[str] | None = None,
    strict: bool = False,
    as_written: bool = False,
    csv_path: str | None = None,
    scratch: str | None = None,
    shuffled_bytes: int | None = None,
    pre: Mapping[str, Sequence[Check]] | None = None,
    post: Sequence[Check] = (),
) -> list:
    """Build the report, check it and write it; returns the check results.

    The claims are read once. The report is written beside its target (or to `scratch`, in the same store), what was
    written is checked, and then it is published by a rename. The rows before and after the FX join are counted
    by the same job. With `strict` a failed rule stops before anything is published.

    `pre` holds checks of the "claims" and "rates" tables, which run before anything else, `post` checks of the
    report besides the fixed rules; a broken one of severity "error" raises PreValidationError or
    PostValidationError, and the target stays as it was. An empty input raises TableNotFoundError; it is only looked for
    when the report is empty or has no conversions.
    """
    apply_settings(spark, shuffled_bytes)
    inputs = {"claims": scan_table(spark, claims, force=True, probe=False), "rates": scan_table(spark, rates, force=True, probe=False)}
    for name, checks in (pre or {}).items():
        validate(inputs[name], checks, name, PreValidationError)
    counts = RowCounts()
    report = triangle_report(inputs["claims"], inputs["rates"], as_written, counts)
    results = []

    def check(kept: DataFrame, rows: int) -> None:
        if not rows:
            require_rows(**inputs)
        results.extend(enforce(triangle_suite(kept).unionByName(fx_suite(counts)), "DQ", strict=False))
        if not all(r.passed for r in results if r.name == FX_RULE):
            require_rows(**inputs)
        if strict:
            require_passed(results)
        results.extend(validate(kept, post, "triangle report"))

    report = mirror_column(conform_schema(report, TRIANGLE), "triangle_report_type")
    rows = write_frame(report, path, partition_by=partition_by, check=check, staging=scratch)
    if csv_path and rows:
        write_frame(spark.read.schema(report.schema).parquet(path), csv_path, file_format="csv", partition_by=partition_by)
    return results
