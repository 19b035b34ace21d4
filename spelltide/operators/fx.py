"""Exchange rates: choice of rate, one row per base currency and day, conversion of amounts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spelltide.functions.claims import book_of_business

# Preferred rate source, and target currency by name of its amount column.
PREFERRED_SOURCE = "OAB"
TARGETS = {"usd": "USD", "gbp": "GBP", "euro": "EUR", "chf": "CHF"}

# Six decimals, and few enough digits that a product with a summed amount stays exact.
RATE = "decimal(14,6)"

BASE = "basecurrencycode"
DAY = "exchangeratedate"


def _preference() -> Column:
    """Orders rows by source, the preferred one first, then by rate."""
    priority = F.when(F.col("exchangeratesourcecode") == PREFERRED_SOURCE, 1).otherwise(2)
    return F.struct(priority.alias("priority"), F.col("exchangerate").alias("rate"))


def _inverse(rate: Column) -> Column:
    return F.round(F.try_divide(F.lit(1), rate), 6).cast(RATE)


def fx_preferred_rate(fx: DataFrame) -> DataFrame:
    """The rate into each target currency per base currency and day."""
    return (
        fx.where(F.col("exchangeratecurrencyfromcode").isin(list(TARGETS.values())))
        .groupBy(
            F.col("exchangeratecurrencyfromcode").alias("newcurrencycode"),
            F.col("exchangeratecurrencytocode").alias(BASE),
            DAY,
        )
        .agg(F.min(_preference()).alias("best"))
        .select("newcurrencycode", BASE, DAY, _inverse(F.col("best.rate")).alias("exchangerate"))
    )


def fx_wide(fx: DataFrame) -> DataFrame:
    """One row per base currency and day: a rate column per target, 0 where it is not quoted, and
    the number of targets quoted."""
    source = F.col("exchangeratecurrencyfromcode")
    best = {name: F.min(F.when(source == code, _preference())).alias(name) for name, code in TARGETS.items()}
    grouped = (
        fx.where(source.isin(list(TARGETS.values())))
        .groupBy(F.col("exchangeratecurrencytocode").alias(BASE), F.col(DAY).cast("date").alias(DAY))
        .agg(*best.values())
    )
    rates = [
        F.when(F.col(name).isNull(), F.lit(0).cast(RATE)).otherwise(_inverse(F.col(f"{name}.rate"))).alias(f"exchangerate_{name}")
        for name in TARGETS
    ]
    quotes = sum((F.col(name).isNotNull().cast("int") for name in TARGETS), F.lit(0)).alias("quotes")
    return grouped.select(BASE, DAY, *rates, quotes)


def join_rates(df: DataFrame, wide: DataFrame, currency_col: str, date_col: str) -> DataFrame:
    """Left join the rates of a row's currency and day; AQE broadcasts them when they turn out small."""
    keyed = wide.withColumnsRenamed({BASE: "_base", DAY: "_day"})
    on = (F.col(currency_col) == F.col("_base")) & (F.col(date_col) == F.col("_day"))
    return df.join(keyed, on, "left").drop("_base", "_day")


def converted(amount: Column) -> dict[str, Column]:
    """The amount in each target currency, given the joined rate columns."""
    return {f"amount_{name}": amount * F.col(f"exchangerate_{name}") for name in TARGETS}


def fx_convert(
    claims: DataFrame,
    fx: DataFrame,
    date_col: str = "reporteddate",
    currency_col: str = "productcurrencycode",
    amount_col: str = "productcurrencypaymentamount",
) -> DataFrame:
    """Add the amount in four currencies and the book of business; every claim stays one row.

    A claim without any rate for its currency and day gets nulls. A target that is quoted with a null or
    zero rate is null too, and 0 where it is not quoted. Nothing runs while the plan is built.
    """
    joined = join_rates(claims, fx_wide(fx), currency_col, date_col)
    return book_of_business(joined.withColumns(converted(F.col(amount_col))))
