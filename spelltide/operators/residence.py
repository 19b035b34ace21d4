"""Country of residence: current row per customer and its attachment to spells."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from spelltide.functions.coverage import FROM, TO
from spelltide.sources.staging import staged

KEYS = ["customerid", "sourcesystemid"]
TYPE = "countryofresidencetypecode"
CODE = "countryofresidencecode"
START = "countryofresidencestartdate"
END = "countryofresidenceenddate"

# Dates that stand for an open start, an open end, and an open end in the overlap test.
OPEN_START = "1900-01-01"
OPEN_END = "9999-12-31"
OVERLAP_END = "9999-01-01"


def _day(text: str) -> Column:
    return F.lit(text).cast("timestamp")


def open_interval_defaults(df: DataFrame) -> DataFrame:
    """Null starts become 1900-01-01 and null ends 9999-12-31."""
    return df.withColumns(
        {
            END: F.coalesce(F.col(END).cast("timestamp"), _day(OPEN_END)),
            START: F.coalesce(F.col(START).cast("timestamp"), _day(OPEN_START)),
        }
    )


def residence_current(df: DataFrame) -> DataFrame:
    """One row per customer and source system: lowest type code, then the latest end, open ends first.

    Start and country settle what is still equal.
    """
    df = df.withColumns(
        {
            START: F.col(START).cast("timestamp"),
            END: F.coalesce(F.col(END).cast("timestamp"), _day(OPEN_END)),
        }
    )
    order = W.partitionBy(*KEYS).orderBy(F.col(TYPE), F.col(END).desc(), F.col(START), F.col(CODE))
    return (
        df.withColumn("_row", F.row_number().over(order))
        .where("_row = 1")
        .drop("_row")
        .withColumnsRenamed({"etlchecksum": "cor_checksum"})
    )


def residence_lookup(df: DataFrame) -> DataFrame:
    """`residence_current`, stored, so that a join with it has two inputs that come straight from an exchange of
    their own: AQE can then split the rows of a customer that has very many spells. It also knows the size of the table, and
    broadcasts it only where it is small."""
    return staged(residence_current(df), "residence")


def overlaps(spell_start: Column, spell_end: Column, start: Column, end: Column) -> Column:
    """The spell starts during the residence, or the residence starts during the spell."""
    start = F.coalesce(start, _day(OPEN_START))
    end = F.coalesce(end, _day(OVERLAP_END))
    return spell_start.between(start, end) | start.between(spell_start, spell_end)


def residence_overlap_join(spells: DataFrame, current: DataFrame) -> DataFrame:
    """Attach the current residence of a spell's customer where the two intervals overlap.

    Every input row stays once, as `current` has at most one row per customer. It is a plain left join on
    the keys, so their types are brought together as Spark does, and size and skew are left to AQE, which
    splits a hot customer if `current` is a stored table (`residence_lookup`). Residence columns replace those
    of the spells; of any other name that both have, the spell's column stays.
    """
    bare = spells.drop(TYPE, CODE, START, END)
    taken = {c.lower() for c in bare.columns} - set(KEYS)
    current = current.drop(*[c for c in current.columns if c.lower() in taken])
    residual = overlaps(F.col(FROM), F.col(TO), F.col(START), F.col(END))
    placed = current.withColumnsRenamed({k: f"_{k}" for k in KEYS})
    for key in KEYS:
        residual = residual & (F.col(key) == F.col(f"_{key}"))
    return bare.join(placed, residual, "left").drop(*[f"_{k}" for k in KEYS])


def with_residence(spells: DataFrame, current: DataFrame) -> DataFrame:
    """The overlap join with open intervals written as dates."""
    return open_interval_defaults(residence_overlap_join(spells, current))
