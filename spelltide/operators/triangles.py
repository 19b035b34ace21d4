"""Claims development triangles."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spelltide.functions import periods as P
from spelltide.functions.claims import book_label, fully_insured
from spelltide.operators.fx import converted, fx_wide, join_rates
from spelltide.operators.quality import RowCounts
from spelltide.schemas import TRIANGLE


@dataclass(frozen=True)
class Leg:
    """One pair of dates and one currency side of the claims."""

    report: str
    metric: str
    currency: str
    amount: str
    start: str
    end: str


# Report names, metric names and the columns each leg reads.
DATE_PAIRS = {
    "Incurred to Received": ("servicedate", "claiminvoicereceiveddate"),
    "Incurred to Paid": ("servicedate", "paymentdate"),
    "Received to Paid": ("claiminvoicereceiveddate", "paymentdate"),
}
SIDES = {
    "Productcurrency": ("productcurrencycode", "productcurrencypaymentamount"),
    "Paymentcurrency": ("paymentcurrencycode", "paymentcurrencypaymentamount"),
}
GRAINS = ("YEAR", "QUARTER", "MONTH")

LEGS = [
    Leg(report, metric, currency, amount, start, end)
    for report, (start, end) in DATE_PAIRS.items()
    for metric, (currency, amount) in SIDES.items()
]


def _literal(leg: Leg) -> Leg:
    if leg.metric != "Paymentcurrency" or leg.report == "Incurred to Received":
        return leg
    leg = replace(leg, amount="productcurrencypaymentamount")
    return replace(leg, report="Incurred to Received") if leg.report == "Incurred to Paid" else leg


# Compatibility variant: the payment side of two date pairs takes the product amount, and one of
# them carries another pair's report name.
LEGS_AS_WRITTEN = [_literal(leg) for leg in LEGS]

DIMENSIONS = ["leg", "metric_value", "legal_entity_name", "legal_entity_id", "book_of_business"]
SUMS = ["base_currency", "usd", "gbp", "euro", "chf"]


def _leg_rows(claims: DataFrame, legs: list[Leg]) -> DataFrame:
    """One row per fully-insured claim and leg whose dates are in order, from one pass over the claims."""
    sides = F.array(
        *[
            F.struct(
                F.lit(i).alias("leg"),
                F.col(leg.currency).alias("metric_value"),
                F.col(leg.amount).cast("decimal(17,2)").alias("amount"),
                F.col(leg.start).cast("date").alias("start_date"),
                F.col(leg.end).cast("date").alias("end_date"),
            )
            for i, leg in enumerate(legs)
        ]
    )
    labelled = fully_insured(claims).select(
        F.col("legalentityname").alias("legal_entity_name"),
        F.col("legalentityid").alias("legal_entity_id"),
        book_label(F.col("sourcesystemid"), F.col("legalentityid")).alias("book_of_business"),
        sides.alias("sides"),
    )
    return (
        labelled.select(*DIMENSIONS[2:], F.inline("sides"))
        .where("start_date <= end_date")
        .select(*DIMENSIONS, "amount", "start_date", P.month_number(F.col("end_date")).alias("end_month"))
    )


def _month_sums(claims: DataFrame, fx: DataFrame, legs: list[Leg], fanout: bool, counts: RowCounts | None = None) -> DataFrame:
    """Sums by start month and end month, the finest grain all three periods and lags follow from.

    Claims are added up per currency and day before the rates are joined, at any size: the join then
    carries cells and not claims, and no currency-day is hot in it. A cell's amount may have 21 digits
    before the point; more raise an overflow.
    """
    rows = _leg_rows(claims, legs).groupBy(*DIMENSIONS, "start_date", "end_month")
    cells = rows.agg(F.sum("amount").cast("decimal(23,2)").alias("amount"))
    joined = join_rates(counts.before(cells) if counts else cells, fx_wide(fx), "metric_value", "start_date")
    if counts:
        joined = counts.after(joined)
    base = F.col("amount")
    if fanout:
        base = base * F.greatest(F.coalesce("quotes", F.lit(1)), F.lit(1))
    amounts = {"base_currency": base, **{k.removeprefix("amount_"): v for k, v in converted(F.col("amount")).items()}}
    return joined.groupBy(*DIMENSIONS, P.month_number(F.col("start_date")).alias("start_month"), "end_month").agg(
        *[F.sum(amounts[s]).alias(s) for s in SUMS]
    )


def development_triangle(
    claims: DataFrame,
    fx: DataFrame,
    legs: list[Leg] | None = None,
    grains: tuple[str, ...] = GRAINS,
    fanout: bool = False,
    counts: RowCounts | None = None,
) -> DataFrame:
    """Amounts by incurred period and development lag, for the given legs and period grains.

    Claims are read once. The first aggregate leaves one row per month pair; the period grains are
    rolled up from that small result, with capped lags falling together. `counts` takes the cells before and
    after the rates are joined.
    """
    legs = LEGS if legs is None else legs
    start, end = F.col("start_month"), F.col("end_month")
    cells = {
        "YEAR": (P.year_label(start), P.year_lag(start, end)),
        "QUARTER": (P.quarter_label(start), P.quarter_lag(start, end)),
        "MONTH": (P.month_label(start), P.month_lag(start, end)),
    }
    by_grain = F.array(
        *[
            F.struct(
                F.lit(grain).alias("incurred_period_type"),
                cells[grain][0].alias("incurred_period"),
                cells[grain][1].alias("paid_lag_value"),
            )
            for grain in grains
        ]
    )
    names = F.array(*[F.struct(F.lit(leg.report).alias("report"), F.lit(leg.metric).alias("metric")) for leg in legs])
    return (
        _month_sums(claims, fx, legs, fanout, counts)
        .select(*DIMENSIONS, *SUMS, F.inline(by_grain))
        .groupBy(*DIMENSIONS, "incurred_period_type", "incurred_period", "paid_lag_value")
        .agg(*[F.sum(s).alias(f"sum_amount_{s}") for s in SUMS])
        .withColumn("_names", F.get(names, F.col("leg")))
        .withColumns({"triangle_report_type": F.col("_names.report"), "metric_type": F.col("_names.metric")})
        .select(*[F.col(f.name).cast(f.dataType) for f in TRIANGLE])
    )


def report_legs(report: str, legs: list[Leg] = LEGS) -> list[Leg]:
    """The legs of one date pair."""
    start, end = DATE_PAIRS[report]
    return [leg for leg in legs if (leg.start, leg.end) == (start, end)]


def triangle_report(claims: DataFrame, fx: DataFrame, as_written: bool = False, counts: RowCounts | None = None) -> DataFrame:
    """All three triangles, both currency sides, all grains.

    `as_written` uses the compatibility legs and counts a claim's base amount once per quoted target.
    """
    return development_triangle(claims, fx, LEGS_AS_WRITTEN if as_written else LEGS, fanout=as_written, counts=counts)
