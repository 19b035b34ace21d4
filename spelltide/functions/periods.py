"""Period labels, development lags and relative-period filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MONTH_CAP = 59
LAG_CEILING = 99


def month_number(day: Column) -> Column:
    """Months since year 0, so that two of them subtract to a calendar-month lag."""
    return F.year(day) * 12 + F.month(day) - 1


def year_of(month: Column) -> Column:
    return F.floor(month / 12).cast("int")


def quarter_number(month: Column) -> Column:
    return F.floor(month / 3).cast("int")


def year_label(month: Column) -> Column:
    return F.lpad(year_of(month).cast("string"), 4, "0")


def quarter_label(month: Column) -> Column:
    return F.concat(year_label(month), F.lit("Q"), (quarter_number(month) % 4 + 1).cast("string"))


def month_label(month: Column) -> Column:
    return F.concat(year_label(month), F.lpad((month % 12 + 1).cast("string"), 2, "0"))


def month_lag(start: Column, end: Column, cap: int = MONTH_CAP, ceiling: int = LAG_CEILING) -> Column:
    """Lag in calendar months between two month numbers; beyond the cap all fall in one bucket."""
    lag = end - start
    return F.when(lag > cap, ceiling).otherwise(lag).cast("int")


def quarter_lag(start: Column, end: Column, ceiling: int = LAG_CEILING) -> Column:
    lag = quarter_number(end) - quarter_number(start)
    return F.when(lag > ceiling, ceiling).otherwise(lag).cast("int")


def year_lag(start: Column, end: Column, ceiling: int = LAG_CEILING) -> Column:
    lag = year_of(end) - year_of(start)
    return F.when(lag > ceiling, ceiling).otherwise(lag).cast("int")


def period_labels(df: DataFrame, date_col: str) -> DataFrame:
    """Add year_month (yyyyMM), year_quarter (yyyyQn) and year_only (yyyy)."""
    month = month_number(F.col(date_col))
    return df.withColumns(
        {
            "year_month": month_label(month),
            "year_quarter": quarter_label(month),
            "year_only": year_label(month),
        }
    )


def lag_buckets(
    df: DataFrame,
    start_col: str,
    end_col: str,
    month_cap: int = MONTH_CAP,
    cap_value: int = LAG_CEILING,
) -> DataFrame:
    """Add paid_lag_months, paid_lag_quarters and paid_lag_years between two dates."""
    start, end = month_number(F.col(start_col)), month_number(F.col(end_col))
    return df.withColumns(
        {
            "paid_lag_months": month_lag(start, end, month_cap, cap_value),
            "paid_lag_quarters": quarter_lag(start, end, cap_value),
            "paid_lag_years": year_lag(start, end, cap_value),
        }
    )


def as_of_date(as_of=None) -> Column:
    """A date column from a date, a yyyy-MM-dd text, or today when none is given."""
    return F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")


def days_before(as_of=None, days: int = 30) -> Column:
    return F.date_sub(as_of_date(as_of), days)


def month_before(as_of=None, months: int = 1) -> Column:
    """yyyyMM label of the month this many months before."""
    return F.date_format(F.add_months(F.trunc(as_of_date(as_of), "MM"), -months), "yyyyMM")


def year_before(as_of=None, years: int = 1) -> Column:
    """yyyy label of the year this many years before."""
    return F.date_format(F.add_months(F.trunc(as_of_date(as_of), "YEAR"), -12 * years), "yyyy")


def relative_period_filter(df: DataFrame, date_col: str, as_of=None, *, days=None, months=None, years=None) -> DataFrame:
    """Keep rows dated on or after the relative day, month or year given; several combine with and.

    Each bound is a date that folds to a literal, so the comparison on the bare column reaches the scan.
    """
    today, day = as_of_date(as_of), F.col(date_col)
    if days is not None:
        df = df.where(day >= F.date_sub(today, days))
    if months is not None:
        df = df.where(day >= F.add_months(F.trunc(today, "MM"), -months))
    if years is not None:
        df = df.where(day >= F.add_months(F.trunc(today, "YEAR"), -12 * years))
    return df
