"""Eligibility spells: cover override, month expansion, cover pivot and snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from spelltide.functions.coverage import FROM, MONTH, TO, eligible_flag, touches_month
from spelltide.functions.periods import as_of_date
from spelltide.sources.staging import staged
from spelltide.sources.tables import LOCATOR

SPELL = ["memberid", FROM, TO]
CODE = "lineofcovercode"
LOADED = "sysbatchdttm"


def as_dates(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("date") for c in (FROM, TO)})


def cover_override(df: DataFrame) -> DataFrame:
    """Rows of source system 1 are medical cover, whatever their own code says."""
    medical = F.col("sourcesystemid") == "1"
    return df.withColumns(
        {
            "lineofcover": F.when(medical, "Medical").otherwise(F.col("lineofcover")),
            CODE: F.when(medical, "MED").otherwise(F.col(CODE)),
        }
    )


def covered(df: DataFrame) -> DataFrame:
    """Drop rows whose cover code is null or blank."""
    return df.where(F.trim(CODE) != "")


def eligibility_source(df: DataFrame) -> DataFrame:
    """Spells of positive length with a cover code of their own, then the override."""
    return cover_override(covered(as_dates(df).where(F.col(TO) > F.col(FROM))))


def month_cutoff(df: DataFrame, as_of=None) -> DataFrame:
    return df.where(F.col(MONTH) <= F.trunc(as_of_date(as_of), "MM"))


def month_range(as_of=None, cut_off: bool = True) -> tuple[Column, Column]:
    """First and last month of a spell's whole calendar years, the last one cut at `as_of`."""
    first = F.make_date(F.year(FROM), F.lit(1), F.lit(1))
    last = F.make_date(F.year(TO), F.lit(12), F.lit(1))
    return first, (F.least(last, F.trunc(as_of_date(as_of), "MM")) if cut_off else last)


def month_expand(df: DataFrame, as_of=None, cut_off: bool = True) -> DataFrame:
    """One row per month of the calendar years a spell touches.

    The cut-off bounds the generated range itself, so an open-ended spell never expands past it.
    A spell that ends in a year before it starts gives no rows.
    """
    first, last = month_range(as_of, cut_off)
    return df.where(first <= last).withColumn(MONTH, F.explode(F.sequence(first, last, F.expr("INTERVAL 1 MONTH"))))


def discover_codes(df: DataFrame, as_of=None, cut_off: bool = True) -> list[str]:
    """The cover codes in use, sorted: one narrow job."""
    first, last = month_range(as_of, cut_off)
    most = int(df.sparkSession.conf.get("spark.sql.pivotMaxValues"))
    found = covered(df).where(first <= last).select(F.trim(CODE)).distinct().limit(most + 1).collect()
    if len(found) > most:
        raise ValueError(f"more than {most} cover codes; pass the codes to report")
    return sorted(row[0] for row in found)


def held_columns(codes: list[str]) -> list[str]:
    """Names of the columns that tell which covers a spell holds."""
    if len({c.lower() for c in codes}) < len(codes):
        raise ValueError(f"cover codes differ only in case: {codes}")
    return [f"_held_{i}" for i in range(len(codes))]


def is_located(df: DataFrame) -> bool:
    """Whether the rows tell their place in a table, as `located` adds it."""
    return set(LOCATOR) <= set(df.columns)


def _keyed(df: DataFrame) -> DataFrame:
    return df.where(F.col("memberid").isNotNull() & F.col(FROM).isNotNull() & F.col(TO).isNotNull())


def _held(codes: list[str]) -> list[Column]:
    return [F.max(F.when(F.trim(CODE) == c, 1)).alias(h) for c, h in zip(codes, held_columns(codes))]


def spell_covers(df: DataFrame, codes: list[str], carry: list[str] | None = None) -> DataFrame:
    """One row per spell that has a cover: a 1-or-null column per code and, with `carry`, the
    first-loaded row's values of those columns.

    Both come from one aggregate with partial sums before its shuffle. The snapshot looks at every
    row of the spell, also those without a cover code; the smallest values settle equal load times. Rows that
    tell their place (`located`) are materialised late instead, see `first_places`.
    """
    rows = _keyed(df)
    if carry is None:
        return covered(rows).groupBy(*SPELL).agg(F.count("*").alias("_rows"), *_held(codes)).drop("_rows")
    if is_located(df):
        return fetched(df, first_places(df, codes).where("_covered").drop("_covered"), [LOADED, *carry])
    measures = [*_held(codes), F.min(F.struct(LOADED, *carry)).alias("_first")]
    return (
        rows.groupBy(*SPELL)
        .agg(F.max(F.trim(CODE) != "").alias("_covered"), *measures)
        .where("_covered")
        .select(*SPELL, *held_columns(codes), "_first.*")
    )


def first_places(df: DataFrame, codes: list[str] | None = None, carry: list[str] | None = None) -> DataFrame:
    """One row per spell: where its first-loaded row lies, and with `codes`, its held-cover columns and whether it has a cover.

    Only keys, load time, cover code, place and the few columns of `carry` are read, aggregated and shuffled, whatever the
    width of the table. Of rows loaded at the same time the first in the table counts. The result is
    stored, so Spark knows its size when it joins the other columns.
    """
    choice = F.min(F.struct(LOADED, *LOCATOR, *(carry or []))).alias("_first")
    marks = [] if codes is None else [F.max(F.trim(CODE) != "").alias("_covered"), *_held(codes)]
    found = _keyed(df).groupBy(*SPELL).agg(*marks, choice)
    kept = [] if codes is None else ["_covered", *held_columns(codes)]
    return staged(found.select(*SPELL, *kept, *[f"_first.{c}" for c in (*LOCATOR, *(carry or []))]), "first-places")


def fetched(df: DataFrame, places: DataFrame, columns: list[str]) -> DataFrame:
    """The places' columns but for the place itself, with the given columns of the rows that lie there.

    A join on the place: places that Spark sees to be small are broadcast, and the wide rows are then not
    shuffled at all; else they are shuffled once, unsorted by anything but their place.
    """
    taken = [c for c in places.columns if c not in LOCATOR]
    wide = df.select(*LOCATOR, *[c for c in columns if c not in taken])
    return wide.join(places, LOCATOR).select(*taken, *[c for c in columns if c not in taken])


def flag_covers(df: DataFrame, codes: list[str], absent: int | None = 0) -> DataFrame:
    """Turn the spell's held-cover columns into month flags named by code, and add `eligible`."""
    held = held_columns(codes)
    taken = {c.lower() for c in df.columns}.intersection(c.lower() for c in codes)
    if taken:
        raise ValueError(f"cover codes have the names of other columns: {sorted(taken)}")
    months = df.withColumn("_active", touches_month(F.col(MONTH), F.col(FROM), F.col(TO)))
    flags = [
        F.when(F.col(h) == 1, F.col("_active")).otherwise(F.lit(absent).cast("int")).alias(c)
        for c, h in zip(codes, held)
    ]
    return eligible_flag(months.select(*[c for c in df.columns if c not in held], *flags), codes)


def cover_pivot(
    df: DataFrame, codes: list[str] | None = None, as_of=None, cut_off: bool = True, absent: int | None = 0
) -> DataFrame:
    """Month flags per spell, one column per cover code; codes are discovered when not given.

    Spells are pivoted before they are expanded, so the shuffle carries spells and not months.
    """
    df = as_dates(df)
    codes = codes or discover_codes(df, as_of, cut_off)
    months = month_expand(spell_covers(df, codes), as_of, cut_off)
    return flag_covers(months, codes, absent).select(*SPELL, MONTH, "eligible", *[F.col(f"`{c}`") for c in codes])


def spell_snapshot(df: DataFrame) -> DataFrame:
    """The first-loaded row of each spell, its key columns renamed to `<name>_source`.

    Rows that tell their place (`located`) are chosen by it and fetched afterwards; spells with a null key are
    left out then, as they match no months. Others are ranked in full, one candidate per task before the shuffle.
    """
    df = as_dates(df)
    others = [c for c in df.columns if c not in SPELL and c not in LOCATOR and c != LOADED]
    if is_located(df):
        first = fetched(df, first_places(df), [LOADED, *others])
        return first.withColumnsRenamed({c: f"{c}_source" for c in SPELL})
    order = W.partitionBy(*SPELL).orderBy(LOADED, *others)
    return (
        df.withColumn("_row", F.row_number().over(order))
        .where("_row = 1")
        .drop("_row")
        .withColumnsRenamed({c: f"{c}_source" for c in SPELL})
    )


def spell_snapshot_join(months: DataFrame, snapshot: DataFrame) -> DataFrame:
    """Attach each spell's snapshot to its months, on member and day.

    The join is a shuffled hash join by hint, with the snapshot, one row per spell, as the side that is kept: months outgrow
    the size Spark estimates for them, so they must neither be broadcast nor sorted, but only pass.
    """
    a = as_dates(months)
    b = snapshot.withColumns({f"{c}_source": F.col(f"{c}_source").cast("date") for c in (FROM, TO)})
    on = F.lit(True)
    for c in SPELL:
        on = on & (F.col(c) == F.col(f"{c}_source"))
    return a.join(b.hint("shuffle_hash"), on, "inner")


def with_source_key(df: DataFrame) -> DataFrame:
    """Repeat the spell key as the `_source` columns of the report, its dates as text."""
    return df.withColumns(
        {
            "memberid_source": F.col("memberid"),
            f"{FROM}_source": F.col(FROM).cast("string"),
            f"{TO}_source": F.col(TO).cast("string"),
        }
    )


def best_spell_per_month(df: DataFrame) -> DataFrame:
    """One row per member and month: eligible spells first, then the start nearest to the month.

    The earlier start and then the earlier end settle what is still equal.
    """
    df = as_dates(df).withColumn(MONTH, F.col(MONTH).cast("date"))
    order = W.partitionBy("memberid", MONTH).orderBy(
        F.col("eligible").desc(), F.abs(F.datediff(MONTH, FROM)), F.col(FROM), F.col(TO)
    )
    return df.withColumn("_row", F.row_number().over(order)).where("_row = 1").drop("_row")
