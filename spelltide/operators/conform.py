"""Column selection, renaming and schema conformance."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType, StructType

log = logging.getLogger(__name__)


def _name(column: str):
    return F.col("`" + column.replace("`", "``") + "`")


def lenient_select(df: DataFrame, keep: list[str]) -> DataFrame:
    """Select the wanted columns that exist, whatever their case, in the wanted order."""
    have = {c.lower() for c in df.columns}
    return df.select(*[_name(c) for c in keep if c.lower() in have])


def rename_columns(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    for missing in missing_names(list(mapping), df.columns):
        log.warning("no column %s to rename", missing)
    return df.withColumnsRenamed({old: new for old, new in mapping.items() if old in df.columns})


def translate_names(df: DataFrame, characters: dict[str, str]) -> DataFrame:
    """Replace characters in every column name, then lower-case it."""
    return _renamed(df, [c.translate(str.maketrans(characters)).lower() for c in df.columns])


def underscore_names(df: DataFrame) -> DataFrame:
    """Spaces in column names become underscores."""
    return _renamed(df, [c.replace(" ", "_") for c in df.columns])


def _renamed(df: DataFrame, names: list[str]) -> DataFrame:
    if len(set(names)) < len(names):
        raise ValueError(f"column names collide after renaming: {sorted(names)}")
    return df.toDF(*names)


def _cast(df: DataFrame, column: str, kind: DataType):
    return _name(column) if df.schema[column].dataType == kind else _name(column).try_cast(kind)


def conform_schema(df: DataFrame, schema: StructType) -> DataFrame:
    """Exactly the schema's columns, in order: cast where present, typed null where absent.

    Values that cannot be cast become null.
    """
    have = {c.lower(): c for c in df.columns}
    return df.select(
        *[
            (_cast(df, have[f.name.lower()], f.dataType) if f.name.lower() in have else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema
        ]
    )


def cast_to_schema(df: DataFrame, schema: StructType) -> DataFrame:
    """Cast the columns the schema names and leave the others alone."""
    kinds = {f.name: f.dataType for f in schema}
    return df.select(*[_cast(df, c, kinds[c]).alias(c) if c in kinds else _name(c) for c in df.columns])


def align_frames(frames: list[DataFrame]) -> list[DataFrame]:
    """Pad every frame to the sorted union of all columns, with nulls of the type seen elsewhere."""
    kinds: dict[str, DataType] = {}
    for df in frames:
        for field in df.schema:
            kinds.setdefault(field.name, field.dataType)
    return [
        df.select(*[_name(c) if c in df.columns else F.lit(None).cast(kinds[c]).alias(c) for c in sorted(kinds)])
        for df in frames
    ]


def align_union(frames: list[DataFrame]) -> DataFrame:
    """All rows of all frames over the union of their columns."""
    first, *rest = align_frames(frames)
    for df in rest:
        first = first.unionByName(df)
    return first


def schema_types(schema: StructType) -> dict[str, DataType]:
    return {f.name: f.dataType for f in schema}


def table_types(spark: SparkSession, table: str) -> dict[str, str]:
    """Lower-cased column names of a catalog table, partition columns included, with their types."""
    return {f.name.lower(): f.dataType.simpleString() for f in spark.table(table).schema}


def missing_names(wanted: list[str], have: list[str]) -> list[str]:
    return [name for name in wanted if name not in have]


def schema_differences(have: StructType, want: StructType) -> list[tuple[str, str | None, str | None]]:
    """(column, expected, actual) of every column that is missing, extra or of another type; names in any case."""
    actual = {f.name.lower(): f.dataType.simpleString() for f in have}
    expected = {f.name.lower(): f.dataType.simpleString() for f in want}
    named = {f.name.lower(): f.name for f in (*have, *want)}
    return [(named[c], expected.get(c), actual.get(c)) for c in sorted({*expected, *actual}) if expected.get(c) != actual.get(c)]


def schema_drift(df: DataFrame, schema: StructType) -> DataFrame:
    """One row (column, expected, actual) per column that is missing, extra or of another type."""
    expected = {f.name: f.dataType.simpleString() for f in schema}
    actual = {f.name: f.dataType.simpleString() for f in df.schema}
    rows = [
        (name, expected.get(name), actual.get(name))
        for name in sorted({*expected, *actual})
        if expected.get(name) != actual.get(name)
    ]
    return df.sparkSession.createDataFrame(rows, "column string, expected string, actual string")


def matches_schema(df: DataFrame, schema: StructType) -> bool:
    """Same fields with the same types, order and nullability."""
    return df.schema == schema


def to_date_columns(df: DataFrame, columns: list[str], pattern: str = "yyyy-MM-dd") -> DataFrame:
    """Turn the columns into dates; text that does not follow the pattern becomes null."""

    def as_date(column):
        if isinstance(df.schema[column].dataType, StringType):
            return F.try_to_date(column, pattern)
        return F.col(column).cast("date")

    return df.withColumns({c: as_date(c) for c in columns})


def mirror_column(df: DataFrame, column: str) -> DataFrame:
    """Copy a partition column to `<column>_val`, so its value stays in the data files."""
    return df.withColumn(f"{column}_val", F.col(column))
