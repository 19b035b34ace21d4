"""Month flags and coverage measures of an eligibility spell."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MONTH = "eligible_month_dt_key"
FROM = "eligibilityfromdate"
TO = "eligibilitytodate"


def flag(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0)


def touches_month(month: Column, start: Column, end: Column) -> Column:
    """1 when the month lies between the spell's first and last calendar month."""
    return flag((month >= F.trunc(start, "MM")) & (month <= F.last_day(end)))


def month_eligible_flag(df: DataFrame) -> DataFrame:
    return df.withColumn("is_eligible", touches_month(F.col(MONTH), F.col(FROM), F.col(TO)))


def eligible_flag(df: DataFrame, cover_columns: list[str]) -> DataFrame:
    """1 when any cover column is 1; nulls do not count."""
    held = [F.coalesce(F.col(f"`{c}`").cast("int") == 1, F.lit(False)) for c in cover_columns]
    return df.withColumn("eligible", flag(reduce(or_, held, F.lit(False))))


def coverage_measures(df: DataFrame) -> DataFrame:
    """Add the end-of-month and mid-month flags, the days covered and their share of the month.

    Values that several measures need are columns of their own, so they are worked out once.
    """
    month, start, end, last = (F.col(c) for c in (MONTH, FROM, TO, "_last"))
    middle = F.date_add(F.trunc(month, "MM"), 14)
    apart = (month > end) | (last < start)
    days = F.datediff(F.least(last, end), F.greatest(month, start)) + 1
    return (
        df.withColumns({c: F.col(c).cast("date") for c in (MONTH, FROM, TO)})
        .withColumn("_last", F.last_day(month))
        .withColumns(
            {
                "eligibility_eom": flag(last.between(start, end)),
                "eligibility_15th": flag(middle.between(start, end)),
                "eligible_days": F.when(apart, 0).otherwise(days),
            }
        )
        .withColumn("pro_rata_membership", F.col("eligible_days") / F.dayofmonth(last))
        .drop("_last")
    )
