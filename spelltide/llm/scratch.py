"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from spelltide.sources.staging import staged as stored

__all__ = ["extended", "placed", "quoted", "stored", "unused"]


def unused(name: str, df: DataFrame) -> str:
    """The name, with as many underscores behind it as make it none of the frame's columns."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def quoted(name: str) -> str:
    """A column's name as Spark takes it, whatever characters it has."""
    return f"`{name.replace('`', '``')}`"


def extended(df: DataFrame, ddl: str) -> StructType:
    """The frame's schema, whatever its names and types, and further columns given as DDL."""
    return StructType([*df.schema.fields, *StructType.fromDDL(ddl).fields])


def placed(df: DataFrame, *more: Column, names: list[str] | None = None) -> DataFrame:
    """The frame's columns, or those named, and further ones, called by their place: so no name can clash or needs quotes."""
    names = df.columns if names is None else names
    return df.select(*[c.alias(f"_{i}") for i, c in enumerate([*(F.col(quoted(n)) for n in names), *more])])
