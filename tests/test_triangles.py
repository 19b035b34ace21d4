import re
from decimal import Decimal as D

import pytest
from pyspark.errors import ArithmeticException
from support import day, plan_of, rows, same
from pyspark.sql import functions as F

from spelltide.operators import triangles as T
from spelltide.plans import bridge as B
from spelltide.plans.triangles import run_triangles
from spelltide.errors import PostValidationError, PreValidationError
from spelltide.operators import quality as Q
from spelltide.operators.quality import DataQualityError
from spelltide.schemas import EXCHANGE_RATE, TRIANGLE
from spelltide.sources.tables import TableNotFoundError, TableSpec

CLAIM = """servicedate date, claiminvoicereceiveddate date, paymentdate date, productcurrencycode string,
    paymentcurrencycode string, productcurrencypaymentamount decimal(17,2), paymentcurrencypaymentamount decimal(17,2),
    legalentityid string, legalentityname string, sourcesystemid string, claimsriskarrangement string"""


def claim(service, received, paid, product="EUR", payment="USD", a="100.00", b="60.00", risk="Fully Insured"):
    return (day(service), day(received), day(paid), product, payment, D(a), D(b), "82813", "LE", "5", risk)


@pytest.fixture(scope="module")
def fx(spark):
    quotes = [("USD", "EUR", 0.5), ("GBP", "EUR", 0.8), ("GBP", "USD", 0.25)]
    return spark.createDataFrame([(f, t, day("2018-01-01"), "OAB", r) for f, t, r in quotes], EXCHANGE_RATE)


def test_cells_of_one_claim(spark, fx):
    claims = spark.createDataFrame([claim("2018-01-01", "2018-03-31", "2023-01-01")], CLAIM)
    got = T.triangle_report(claims, fx)
    assert got.schema.simpleString() == TRIANGLE.simpleString()
    assert got.count() == 18
    cells = {
        (r.triangle_report_type, r.metric_type, r.incurred_period_type): (
            r.metric_value, r.incurred_period, r.paid_lag_value, r.sum_amount_base_currency, r.sum_amount_usd, r.sum_amount_gbp,
        )
        for r in got.collect()
    }
    product = ("EUR", D("100.00"), D("200"), D("125"))
    payment = ("USD", D("60.00"), D("0"), D("240"))

    def cell(kind, period, lag):
        return (kind[0], period, lag, *kind[1:])

    assert cells["Incurred to Received", "Productcurrency", "MONTH"] == cell(product, "201801", 2)
    assert cells["Incurred to Received", "Paymentcurrency", "MONTH"] == cell(payment, "201801", 2)
    assert cells["Incurred to Paid", "Productcurrency", "MONTH"] == cell(product, "201801", 99)
    assert cells["Incurred to Paid", "Productcurrency", "QUARTER"] == cell(product, "2018Q1", 20)
    assert cells["Incurred to Paid", "Paymentcurrency", "YEAR"] == cell(payment, "2018", 5)
    # The rate day of the last pair is the day of receipt, on which nothing is quoted.
    assert cells["Received to Paid", "Productcurrency", "MONTH"] == ("EUR", "201803", 58, D("100.00"), None, None)


def test_filters(spark, fx):
    claims = spark.createDataFrame(
        [
            claim("2018-02-01", "2018-01-01", "2018-03-01"),
            claim("2018-01-01", None, "2018-03-01"),
            claim("2018-01-01", "2018-01-01", "2018-01-01", risk="ASO"),
        ],
        CLAIM,
    )
    got = T.development_triangle(claims, fx, grains=("YEAR",))
    assert rows(got.groupBy("triangle_report_type", "metric_type").agg(F.sum("sum_amount_base_currency").alias("s"))) == [
        ("Incurred to Paid", "Paymentcurrency", D("120.00")),
        ("Incurred to Paid", "Productcurrency", D("200.00")),
        ("Received to Paid", "Paymentcurrency", D("60.00")),
        ("Received to Paid", "Productcurrency", D("100.00")),
    ]


def test_lags_past_the_cap_fall_into_one_cell(spark, fx):
    claims = spark.createDataFrame([claim("2010-01-01", "2016-01-01", None), claim("2010-01-31", "2017-01-01", None)], CLAIM)
    got = T.development_triangle(claims, fx, T.LEGS[:1], ("MONTH",))
    assert rows(got, "paid_lag_value", "sum_amount_base_currency") == [(99, D("200.00"))]


def test_compatibility_legs(spark, fx):
    claims = spark.createDataFrame([claim("2018-01-01", "2018-01-01", "2018-01-01")], CLAIM)
    got = T.triangle_report(claims, fx, as_written=True).where("incurred_period_type = 'MONTH'")
    assert rows(got, "triangle_report_type", "metric_type", "sum_amount_base_currency") == [
        ("Incurred to Paid", "Productcurrency", D("200.00")),
        ("Incurred to Received", "Paymentcurrency", D("100.00")),
        ("Incurred to Received", "Paymentcurrency", D("60.00")),
        ("Incurred to Received", "Productcurrency", D("200.00")),
        ("Received to Paid", "Paymentcurrency", D("100.00")),
        ("Received to Paid", "Productcurrency", D("200.00")),
    ]


def test_grains_sum_to_the_same(spark, sf):
    report = T.triangle_report(B.claims(spark, sf), B.exchange_rates(spark, sf))
    sums = [F.sum(f"sum_amount_{s}").alias(s) for s in T.SUMS]
    by_grain = report.groupBy("incurred_period_type", "triangle_report_type", "metric_type").agg(*sums)
    assert by_grain.drop("incurred_period_type").distinct().count() == 6


def test_no_cell_twice(spark, sf):
    report = T.triangle_report(B.claims(spark, sf), B.exchange_rates(spark, sf))
    keys = [c for c in report.columns if not c.startswith("sum_")]
    assert report.groupBy(*keys).count().where("count > 1").isEmpty()


@pytest.mark.parametrize("as_written", [False, True])
def test_join_kind_does_not_change_results(spark, sf, as_written):
    claims, rates = B.claims(spark, sf), B.exchange_rates(spark, sf)
    want = T.triangle_report(claims, rates, as_written)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert same(T.triangle_report(claims, rates, as_written), want)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hot_cell(spark, sf):
    """A third of the claims on one currency, entity and day."""
    claims = B.claims(spark, sf)
    hot = F.crc32("claimlineid") % 3 == 0
    changed = {"productcurrencycode": F.lit("EUR"), "servicedate": F.lit("1996-03-05").cast("date"), "legalentityid": F.lit("82440")}
    skewed = claims.withColumns({c: F.when(hot, v).otherwise(F.col(c)) for c, v in changed.items()})
    report = T.development_triangle(skewed, B.exchange_rates(spark, sf), T.LEGS[:1], ("YEAR",))
    want = skewed.where("upper(claimsriskarrangement) = 'FULLY INSURED' AND servicedate <= claiminvoicereceiveddate")
    assert report.agg(F.sum("sum_amount_base_currency")).first()[0] == want.agg(F.sum("productcurrencypaymentamount")).first()[0]


def test_plan_reads_claims_once(spark, sf, tmp_path, capsys):
    B.claims(spark, sf).write.parquet(str(tmp_path / "claims"))
    B.exchange_rates(spark, sf).write.parquet(str(tmp_path / "rates"))
    claims = spark.read.parquet(str(tmp_path / "claims"))
    plan = plan_of(T.triangle_report(claims, spark.read.parquet(str(tmp_path / "rates"))), capsys)
    tree = plan.split("\n(1)")[0]
    assert tree.count("Scan parquet") == 2
    assert len(re.findall("(?:BroadcastHash|SortMerge)Join", tree)) == 1
    schema = next(line for line in plan.splitlines() if "ReadSchema" in line and "claimsriskarrangement" in line)
    assert "claimlineid" not in schema and "memberid" not in schema


def test_report_job(spark, sf, tmp_path):
    B.claims(spark, sf).createOrReplaceTempView("job_claims")
    B.exchange_rates(spark, sf).createOrReplaceTempView("job_rates")
    out, csv = str(tmp_path / "report"), str(tmp_path / "csv")
    claims = TableSpec(name="job_claims", predicate="claimsriskarrangement is not null")
    rates = TableSpec(name="job_rates", schema=EXCHANGE_RATE)
    results = run_triangles(spark, out, claims, rates, ["triangle_report_type"], csv_path=csv)
    checks = {r.name: r.passed for r in results}
    assert checks["triangle_type_value_matches_partition"] and checks["paid_lag_sanity"]
    assert not checks["critical_fields_not_null"]
    back = spark.read.parquet(out)
    want = T.triangle_report(B.claims(spark, sf), B.exchange_rates(spark, sf))
    assert same(want, back)
    assert back.where("triangle_report_type <> triangle_report_type_val").isEmpty()
    assert spark.read.csv(csv).count() == back.count()
    strict = str(tmp_path / "strict")
    with pytest.raises(DataQualityError, match="critical_fields_not_null"):
        run_triangles(spark, strict, claims, rates, strict=True)
    assert not (tmp_path / "strict").exists()
    with pytest.raises(TableNotFoundError):
        run_triangles(spark, out, TableSpec(name="no_claims_here"), rates)
    scratch = tmp_path / "scratch"
    run_triangles(spark, out, claims, rates, scratch=str(scratch))
    assert not scratch.exists()


def test_report_job_in_another_session(spark, sf, tmp_path):
    """Neither the session's time zone nor its overflow rule changes the report."""
    B.claims(spark, sf).createOrReplaceTempView("other_claims")
    B.exchange_rates(spark, sf).createOrReplaceTempView("other_rates")
    claims, rates = TableSpec(name="other_claims"), TableSpec(name="other_rates", schema=EXCHANGE_RATE)
    paths = [str(tmp_path / n) for n in ("plain", "odd")]
    run_triangles(spark, paths[0], claims, rates)
    spark.conf.set("spark.sql.ansi.enabled", "false")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    run_triangles(spark, paths[1], claims, rates, shuffled_bytes=1 << 30)
    assert (spark.conf.get("spark.sql.ansi.enabled"), spark.conf.get("spark.sql.session.timeZone")) == ("true", "UTC")
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.initialPartitionNum")
    assert same(*map(spark.read.parquet, paths))
    huge = F.col("productcurrencypaymentamount").cast("decimal(38,2)") * F.lit("1e20").cast("decimal(21,0)")
    B.claims(spark, sf).withColumn("productcurrencypaymentamount", huge).createOrReplaceTempView("huge_claims")
    with pytest.raises(ArithmeticException):
        run_triangles(spark, str(tmp_path / "huge"), TableSpec(name="huge_claims"), rates)


def test_report_job_validates_before_and_after(spark, sf, tmp_path):
    B.claims(spark, sf).createOrReplaceTempView("valid_claims")
    B.exchange_rates(spark, sf).createOrReplaceTempView("valid_rates")
    claims, rates = TableSpec(name="valid_claims"), TableSpec(name="valid_rates", schema=EXCHANGE_RATE)
    out = str(tmp_path / "out")
    results = run_triangles(spark, out, claims, rates)
    counted = {r.name: r for r in results}[Q.ROWS_RULE]
    assert counted.passed and counted.details.split()[0] == counted.details.split()[-1] != "0"
    before = sorted(p.name for p in (tmp_path / "out").iterdir())
    euro = (Q.in_set("productcurrencycode", ["EUR"], "euro_only"), Q.Threshold(share=0.5))
    with pytest.raises(PreValidationError, match="claims.*\neuro_only"):
        run_triangles(spark, out, claims, rates, pre={"claims": [euro]})
    months = (Q.in_set("incurred_period_type", ["MONTH"], "months_only"), Q.Threshold(rows=3))
    with pytest.raises(PostValidationError, match="triangle report"):
        run_triangles(spark, out, claims, rates, post=[months])
    assert sorted(p.name for p in (tmp_path / "out").iterdir()) == before
    lenient = [(euro[0], Q.Threshold(severity="warning"))], [(months[0], Q.Threshold(share=1.0))]
    results = run_triangles(spark, out, claims, rates, pre={"claims": lenient[0], "rates": []}, post=lenient[1])
    assert results[-1].name == "months_only" and results[-1].passed
    assert not [p for p in tmp_path.iterdir() if p.name.startswith("_")]
    with pytest.raises(TableNotFoundError, match="claims"):
        run_triangles(spark, out, TableSpec(name="valid_claims", predicate="claimlineid is null"), rates)
    with pytest.raises(TableNotFoundError, match="rates"):
        run_triangles(spark, out, claims, TableSpec(name="valid_rates", schema=EXCHANGE_RATE, predicate="exchangerate < 0"))
    assert spark.read.parquet(out).count() > 0
