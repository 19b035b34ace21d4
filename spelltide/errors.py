"""What a job can fail with, besides Spark's own errors."""

from __future__ import annotations

from collections.abc import Sequence


class TableNotFoundError(Exception):
    """A required table is missing or has no matching rows."""


class ColumnNotFoundError(Exception):
    """A table lacks columns that were asked for."""

    def __init__(self, table: str, columns: Sequence[str]):
        self.table, self.columns = table, tuple(columns)
        super().__init__(f"{table} has no columns: {', '.join(self.columns)}")


class InvalidTableSchemaError(Exception):
    """A table's columns differ from its contract: (column, expected type, actual type), None for no such column."""

    def __init__(self, table: str, differences: Sequence[tuple[str, str | None, str | None]]):
        self.table, self.differences = table, tuple(differences)
        listed = "; ".join(f"{c}: {want or 'not in the contract'}, found {have or 'none'}" for c, want, have in self.differences)
        super().__init__(f"{table} departs from its contract: {listed}")


class DataQualityError(Exception):
    """A suite run with strict=True found a failing rule."""


class ThresholdError(DataQualityError):
    """Rules were broken by more rows than allowed; `failed` holds their result rows."""

    when = "validation"

    def __init__(self, label: str, failed: Sequence):
        self.label, self.failed = label, tuple(failed)
        lines = (f"{r.name}: {r.failed_rows} of {r.total_rows} rows, {r.allowed_rows} allowed ({r.details})" for r in failed)
        super().__init__(f"{self.when} of {label} failed\n" + "\n".join(lines))


class PreValidationError(ThresholdError):
    """A source table broke its rules, so nothing was computed from it."""

    when = "pre-validation"


class PostValidationError(ThresholdError):
    """A result broke its rules, so it was not published."""

    when = "post-validation"
