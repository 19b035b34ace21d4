"""Scans of catalog tables, views, partitioned paths and SQL text."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from spelltide.errors import ColumnNotFoundError, InvalidTableSchemaError, TableNotFoundError
from spelltide.operators.conform import schema_differences, underscore_names
from spelltide.operators.filters import conjunctive_filter, normalise_predicate, split_conditions

log = logging.getLogger(__name__)


#: How much of a table must agree with its schema: columns asked for are there; the contract's columns have
#: its types; there are no other columns.
CONTRACTS = ("names", "types", "exact")

@dataclass(frozen=True)
class TableSpec:
    """What to read: a table or several, its contract, and the rows wanted.

    `predicate` takes comma-separated conditions. `columns` defaults to the schema's fields. `contract` says what
    is checked against the schema while the plan is built: that the wanted columns exist ("names"), that the
    schema's columns have its types too ("types"), or that the table has no others besides ("exact").
    """

    name: str = ""
    database: str | None = None
    schema: StructType | None = None
    columns: tuple[str, ...] = ()
    predicate: str = ""
    distinct: bool = False
    tables: tuple[str, ...] = ()
    key_columns: tuple[str, ...] = ()
    partition_columns: tuple[str, ...] = field(default=())
    contract: str = "names"

    def __post_init__(self):
        if self.contract not in CONTRACTS:
            raise ValueError(f"no such contract: {self.contract}")

    def qualified(self, name: str | None = None) -> str:
        parts = [p for p in (self.database, name or self.name) if p]
        return ".".join(f"`{p}`" for p in parts)

    @property
    def wanted(self) -> list[str]:
        return list(self.columns) or (self.schema.fieldNames() if self.schema else ["*"])


def partition_names(text: str | None) -> list[str]:
    """Names of a comma-separated list, without blanks."""
    return [name.strip() for name in (text or "").split(",") if name.strip()]


def _absent(spark: SparkSession, spec: TableSpec, name: str, force: bool) -> DataFrame | None:
    if force:
        raise TableNotFoundError(f"{name} is missing or empty")
    log.warning("no rows from %s", name)
    return spark.createDataFrame([], spec.schema or StructType([]))


def register_table(
    spark: SparkSession, path: str, name: str, database: str | None = None, partition_by: Sequence[str] = (), file_format: str = "parquet"
) -> str:
    """Enter the files at a path in the catalog, with the partitions found there; returns the qualified name.

    A scan of the table then lists only the partitions that its predicate names. A table of that name is
    replaced; its files and those at the path stay as they are.
    """
    table = TableSpec(name=name, database=database).qualified()
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    text = spark.read.format(file_format).load(path).schema.toDDL()
    parts = ", ".join(f"`{c}`" for c in partition_by)
    place = path.replace("'", "\\'")
    spark.sql(f"CREATE TABLE {table} ({text}) USING {file_format} {f'PARTITIONED BY ({parts})' if parts else ''} LOCATION '{place}'")
    if parts:
        spark.catalog.recoverPartitions(table)
    return table


def check_contract(have: StructType, spec: TableSpec, table: str) -> None:
    """Raise where a table's columns break the spec's contract. Looks at schemas alone, so no job runs.

    Names are compared as Spark does, in any case; of columns that the schema does not tell, only the names count.
    """
    names = {f.name.lower() for f in have}
    # Paths into structs and the star are left to Spark.
    lacking = [c for c in spec.wanted if c.isidentifier() and c.lower() not in names]
    if lacking:
        raise ColumnNotFoundError(table, lacking)
    if spec.schema is None or spec.contract == "names":
        return
    differences = schema_differences(have, spec.schema)
    if spec.contract == "types":
        differences = [d for d in differences if d[1] is not None]
    if differences:
        raise InvalidTableSchemaError(table, differences)


def _scan(spark: SparkSession, spec: TableSpec, name: str, distinct: bool, force: bool, probe: bool = True) -> DataFrame:
    table = spec.qualified(name)
    if not spark.catalog.tableExists(table):
        return _absent(spark, spec, table, force)
    df = spark.table(table)
    check_contract(df.schema, spec, table)
    if spec.predicate:
        df = df.where(normalise_predicate(spec.predicate))
    df = df.select(*spec.wanted)
    if force and probe and df.isEmpty():
        return _absent(spark, spec, table, force)
    return df.distinct() if distinct else df


def scan_table(spark: SparkSession, spec: TableSpec, force: bool = False, probe: bool = True) -> DataFrame:
    """The wanted columns and rows of one table.

    A missing table gives an empty frame with the contract's columns; with `force`, a missing or
    empty one raises. Looking for a first row is a job; without `probe` it is left out, and a job that finds its result
    empty calls `require_rows` for its inputs. A table that breaks its contract raises while the plan is
    built.
    """
    return _scan(spark, spec, spec.name, spec.distinct, force, probe)


def require_rows(**frames: DataFrame) -> None:
    """Raise for the first input without rows; called by jobs whose result came out empty."""
    for name, df in frames.items():
        if df.isEmpty():
            raise TableNotFoundError(f"{name} is missing or empty")


#: Columns that tell a row's place in a table of files.
LOCATOR = ["_file", "_place"]


def located(df: DataFrame) -> DataFrame:
    """A scan of Parquet files, with filters and projections at most, and each row's file and place in it.

    Operators that choose one of many rows need only carry these two through their shuffles, and fetch the other columns
    for the chosen rows afterwards.
    """
    return df.withColumns({LOCATOR[0]: F.col("_metadata.file_path"), LOCATOR[1]: F.col("_metadata.row_index")})


def scan_tables(spark: SparkSession, spec: TableSpec, force: bool = False) -> DataFrame:
    """The rows of every table of the list, matched by column name.

    A missing table is left out with a warning; with `force` it raises.
    """
    frames = []
    for name in spec.tables:
        if force or spark.catalog.tableExists(spec.qualified(name)):
            frames.append(_scan(spark, spec, name, False, force))
        else:
            log.warning("no table %s", spec.qualified(name))
    if not frames:
        return _absent(spark, spec, ", ".join(spec.tables), force)
    df = reduce(DataFrame.unionByName, frames)
    return df.distinct() if spec.distinct else df


def scan_path(
    spark: SparkSession, root: str, predicate: str = "", columns: list[str] | None = None, distinct: bool = False
) -> DataFrame:
    """Parquet under a table's root path, limited to partitions given as `k=v and k=v`.

    The partition columns stay in the result and only the named partitions are read.
    """
    df = spark.read.option("basePath", root).parquet(root)
    df = conjunctive_filter(df, split_conditions(predicate, " and "))
    df = df.select(*columns) if columns else df
    return df.distinct() if distinct else df


def scan_view(
    spark: SparkSession, view: str, filters: str = "", columns: list[str] | None = None, distinct: bool = False
) -> DataFrame:
    """A view with comma-separated SQL conditions."""
    df = spark.table(view)
    if filters:
        df = df.where(normalise_predicate(filters))
    df = df.select(*columns) if columns else df
    return df.distinct() if distinct else df


def run_sql(spark: SparkSession, query: str, **frames: DataFrame) -> DataFrame:
    """Run SQL text; frames given by name can be used in it as {name}."""
    return spark.sql(query, **frames)


def run_sql_clean(spark: SparkSession, query: str, **frames: DataFrame) -> DataFrame:
    """Run SQL text and put underscores for spaces in its column names."""
    return underscore_names(run_sql(spark, query, **frames))
