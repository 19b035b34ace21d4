"""Row filters and labels of claim lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Risk arrangement, source systems, legal entities and book labels.
FULLY_INSURED = "FULLY INSURED"
BOOK_BY_SOURCE = {"1": "IOH", "8": "GIH"}
AMERICAS_SOURCES = ["5"]
AMERICAS_BOOK_BY_ENTITY = {"82813": "CGIC Qatar", "53154": "GHB Bahrain NA", "53134": "GHB Czech NA"}
AMERICAS_BOOK = "CGIC NA"
EUROPE_SOURCES = ["2", "3", "4"]
EUROPE_BOOK_BY_ENTITY = {
    "82440": "GHB Singapore",
    "82810": "GHB Africa",
    "82811": "GHB Africa",
    "82812": "GHB Africa",
}
EUROPE_BOOK = "GHB Europe"


def _lookup(key: Column, table: dict[str, str]) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for pair in table.items() for x in pair]), key)


def book_label(source: Column, entity: Column) -> Column:
    """Book of business of a source system and legal entity; null for an unknown source."""

    def by_entity(table, other):
        return F.coalesce(_lookup(entity, table), F.lit(other))

    return (
        F.when(source.isin(AMERICAS_SOURCES), by_entity(AMERICAS_BOOK_BY_ENTITY, AMERICAS_BOOK))
        .when(source.isin(EUROPE_SOURCES), by_entity(EUROPE_BOOK_BY_ENTITY, EUROPE_BOOK))
        .otherwise(_lookup(source, BOOK_BY_SOURCE))
    )


def book_of_business(df: DataFrame) -> DataFrame:
    return df.withColumn("book_of_business", book_label(F.col("sourcesystemid"), F.col("legalentityid")))


def fully_insured(df: DataFrame) -> DataFrame:
    return df.where(F.upper("claimsriskarrangement") == FULLY_INSURED)


def dates_in_order(df: DataFrame, start_col: str, end_col: str) -> DataFrame:
    """Keep rows whose start is not after their end; a null date drops the row."""
    return df.where(F.col(start_col) <= F.col(end_col))
