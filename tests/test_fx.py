from datetime import date
from decimal import Decimal as D

import pytest
from support import day, rows, same

from spelltide.operators import fx as X
from spelltide.operators import triangles as T
from spelltide.plans import bridge as B
from spelltide.schemas import EXCHANGE_RATE

CLAIM = """claimlineid string, productcurrencycode string, reporteddate date, productcurrencypaymentamount decimal(17,2),
    sourcesystemid string, legalentityid string"""
ON = "2024-05-07"


def rates(spark, *entries):
    return spark.createDataFrame([(f, t, day(d), s, r) for f, t, d, s, r in entries], EXCHANGE_RATE)


def claims(spark, *entries):
    return spark.createDataFrame([(i, c, day(d), None if a is None else D(a), "8", "1") for i, c, d, a in entries], CLAIM)


@pytest.fixture(scope="module")
def eur(spark):
    return rates(
        spark,
        ("USD", "EUR", ON, "OAB", 1.1),
        ("USD", "EUR", ON, "ECB", 1.0),
        ("GBP", "EUR", ON, "ECB", 0.9),
        ("GBP", "EUR", ON, "IMF", 0.8),
        ("CHF", "EUR", ON, "OAB", 0.95),
        ("AUD", "EUR", ON, "OAB", 2.0),
        ("USD", "GBP", ON, "OAB", 0.5),
    )


def test_preferred_rate(eur):
    assert rows(X.fx_preferred_rate(eur).where("basecurrencycode = 'EUR'"), "newcurrencycode", "exchangerate") == [
        ("CHF", D("1.052632")),
        ("GBP", D("1.250000")),
        ("USD", D("0.909091")),
    ]


def test_wide_rates(eur):
    got = X.fx_wide(eur).where("basecurrencycode = 'EUR'").first()
    assert (got.exchangerate_usd, got.exchangerate_gbp, got.exchangerate_euro, got.exchangerate_chf, got.quotes) == (
        D("0.909091"),
        D("1.250000"),
        D("0"),
        D("1.052632"),
        3,
    )
    assert got.exchangeratedate == date(2024, 5, 7)


def test_conversion(spark, eur):
    df = claims(spark, ("a", "EUR", ON, "100.00"), ("b", "JPY", ON, "100.00"), ("c", "EUR", "2024-05-08", "1.00"), ("d", "EUR", ON, None))
    got = {r.claimlineid: r for r in X.fx_convert(df, eur).collect()}
    assert len(got) == 4
    a = got["a"]
    assert (a.amount_usd, a.amount_gbp, a.amount_chf, a.amount_euro) == (D("90.9091"), D("125"), D("105.2632"), D("0"))
    for other in "bcd":
        assert (got[other].amount_usd, got[other].amount_euro) == (None, None)
    assert a.book_of_business == "GIH"


def test_zero_and_missing_rates(spark):
    fx = rates(spark, ("USD", "EUR", ON, "OAB", 0.0), ("USD", "EUR", ON, "ECB", 2.0), ("GBP", "EUR", ON, "OAB", None), ("GBP", "EUR", ON, "ECB", 2.0))
    got = X.fx_wide(fx).first()
    assert (got.exchangerate_usd, got.exchangerate_gbp, got.quotes) == (None, None, 2)


def test_equal_rates_of_two_sources_count_once(spark):
    fx = rates(spark, ("USD", "EUR", ON, "ECB", 2.0), ("USD", "EUR", ON, "IMF", 2.0))
    assert X.fx_preferred_rate(fx).count() == 1
    assert X.fx_wide(fx).first().quotes == 1


def test_no_rates_at_all(spark):
    got = X.fx_convert(claims(spark, ("a", "EUR", ON, "100.00")), spark.createDataFrame([], EXCHANGE_RATE)).first()
    assert (got.amount_usd, got.book_of_business) == (None, "GIH")


def test_wide_holds_the_preferred_rates(spark, sf):
    fx = B.exchange_rates(spark, sf)
    wide = X.fx_wide(fx)
    assert wide.groupBy("basecurrencycode", "exchangeratedate").count().where("count > 1").isEmpty()
    usd = wide.where("exchangerate_usd > 0").selectExpr("basecurrencycode", "exchangeratedate", "exchangerate_usd AS exchangerate")
    want = X.fx_preferred_rate(fx).where("newcurrencycode = 'USD'").select(*usd.columns)
    assert same(usd, want)


def test_claims_stay_one_row(spark, sf):
    c, fx = B.claims(spark, sf), B.exchange_rates(spark, sf)
    assert X.fx_convert(c, fx, "servicedate").count() == c.count()


@pytest.mark.parametrize("threshold", ["-1", "10m"])
def test_join_kind_does_not_change_results(spark, sf, threshold):
    c, fx = B.claims(spark, sf), B.exchange_rates(spark, sf)
    columns = ["claimlineid", "amount_usd", "amount_gbp", "amount_euro", "amount_chf", "book_of_business"]
    want = X.fx_convert(c, fx, "servicedate").select(*columns)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        assert same(X.fx_convert(c, fx, "servicedate").select(*columns), want)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def jobs_of(spark, build):
    """How many jobs start while `build` runs."""
    context = spark.sparkContext
    context.setJobGroup("counted", "building a plan")
    try:
        build()
        return len(context.statusTracker().getJobIdsForGroup("counted"))
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)


def test_building_starts_no_job(spark, sf):
    c, fx = B.claims(spark, sf), B.exchange_rates(spark, sf)
    assert jobs_of(spark, lambda: X.fx_convert(c, fx, "servicedate")) == 0
    assert jobs_of(spark, lambda: T.triangle_report(c, fx)) == 0
