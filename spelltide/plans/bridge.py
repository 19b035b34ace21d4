"""Insurance inputs derived from the star-schema test tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spelltide.sources.staging import staged
from spelltide.sources.tables import located

CURRENCIES = ["USD", "EUR", "GBP", "CHF", "JPY"]
ENTITIES = ["82440", "82813", "82810", "53154", "82811", "53134", "82812", "99999"]
QUOTED = {"USD": 1, "EUR": 2, "GBP": 3, "CHF": 4, "AUD": 5}
QUOTING = {"USD": 1, "EUR": 2, "GBP": 3, "CHF": 4}
RATE_SOURCES = {"OAB": 1, "ECB": 2, "IMF": 3}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(values: list[str], key: Column) -> Column:
    return F.get(F.array(*map(F.lit, values)), (key % len(values)).cast("int"))


def _day(column: str) -> Column:
    return F.col(column).cast("date")


def claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A claim line per order line."""
    lines, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    risk = F.when(F.col("l_returnflag") == "A", "Fully Insured").when(F.col("l_returnflag") == "N", "FULLY INSURED")
    # Orders grow with the lines, so the join is shuffled however small the test data is.
    return lines.join(orders.hint("merge"), lines.l_orderkey == orders.o_orderkey).select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey").alias("claimlineid"),
        F.col("o_custkey").cast("string").alias("memberid"),
        _day("o_orderdate").alias("servicedate"),
        _day("l_shipdate").alias("claiminvoicereceiveddate"),
        F.date_add(_day("l_shipdate"), F.col("l_quantity").cast("int")).alias("paymentdate"),
        _pick(CURRENCIES, F.col("l_suppkey")).alias("productcurrencycode"),
        _pick(CURRENCIES, F.col("o_custkey")).alias("paymentcurrencycode"),
        F.col("l_extendedprice").cast("decimal(17,2)").alias("productcurrencypaymentamount"),
        (F.col("l_quantity") * 100).cast("decimal(17,2)").alias("paymentcurrencypaymentamount"),
        _pick(ENTITIES, F.col("l_suppkey")).alias("legalentityid"),
        F.concat(F.lit("LE-"), (F.col("l_suppkey") % 8).cast("string")).alias("legalentityname"),
        (F.col("l_suppkey") % 10).cast("string").alias("sourcesystemid"),
        risk.otherwise("ASO").alias("claimsriskarrangement"),
    )


def _options(values: dict[str, int]) -> Column:
    return F.array(*[F.struct(F.lit(c).alias("c"), F.lit(k).alias("k")) for c, k in values.items()])


def exchange_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates between the listed currencies for every day on which something was ordered or shipped."""
    ordered = table(spark, sf_dir, "orders").select(_day("o_orderdate").alias("d"))
    shipped = table(spark, sf_dir, "lineitem").select(_day("l_shipdate").alias("d"))
    days = ordered.unionAll(shipped).distinct()
    for name, values in (("f", QUOTED), ("t", QUOTING), ("s", RATE_SOURCES)):
        days = days.withColumn(name, F.explode(_options(values)))
    missing = (F.col("s.c") == "OAB") & (F.dayofmonth("d") % 4 == 0)
    step = (F.col("f.k") * 3 + F.col("t.k") * 5 + F.col("s.k") * 7 + F.dayofmonth("d")) % 16
    return days.where((F.col("f.c") != F.col("t.c")) & ~missing).select(
        F.col("f.c").alias("exchangeratecurrencyfromcode"),
        F.col("t.c").alias("exchangeratecurrencytocode"),
        F.col("d").alias("exchangeratedate"),
        F.col("s.c").alias("exchangeratesourcecode"),
        ((step + 1).cast("double") / 8).alias("exchangerate"),
    )


def eligibility(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A spell per order, every third one with a second, dental cover."""
    key, priority = F.col("o_orderkey"), F.col("o_orderpriority")
    versions = F.when(key % 3 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    orders = table(spark, sf_dir, "orders").withColumn("v", F.explode(versions))
    second = F.col("v") == 1
    code = (
        F.when(second, "DEN")
        .when(priority == "1-URGENT", "MED")
        .when(priority == "2-HIGH", "DEN")
        .when(priority == "3-MEDIUM", "VIS")
        .when(priority == "4-NOT SPECIFIED", "  ")
    )
    return orders.select(
        F.col("o_custkey").cast("string").alias("memberid"),
        F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("customerid"),
        (F.col("o_custkey") % 5 + 1).cast("string").alias("sourcesystemid"),
        _day("o_orderdate").alias("eligibilityfromdate"),
        F.date_add(_day("o_orderdate"), (key % 400).cast("int")).alias("eligibilitytodate"),
        F.when(second, "Dental").otherwise(priority).alias("lineofcover"),
        code.alias("lineofcovercode"),
        (key * 2 + F.col("v")).alias("sysbatchdttm"),
    )


def residences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three residence rows per customer, some with an open start or end, some from a system without spells."""
    versions = F.array(F.lit(0), F.lit(1), F.lit(2))
    rows = table(spark, sf_dir, "customer").withColumn("v", F.explode(versions))
    key, v = F.col("c_custkey"), F.col("v")
    offset = ((key * 7 + v * 400) % 2400).cast("int")
    origin = F.lit("1995-01-01").cast("date")
    return rows.select(
        F.concat(F.lit("C"), key.cast("string")).alias("customerid"),
        F.when(key % 7 == 0, "9").otherwise((key % 5 + 1).cast("string")).alias("sourcesystemid"),
        F.when(v == 2, "SEC").otherwise("PRI").alias("countryofresidencetypecode"),
        ((F.col("c_nationkey") + v) % 25).cast("string").alias("countryofresidencecode"),
        F.when(key % 11 != 0, F.date_add(origin, offset)).alias("countryofresidencestartdate"),
        F.when((key + v) % 3 != 0, F.date_add(origin, offset + 365)).alias("countryofresidenceenddate"),
    )


def placed_eligibility(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The spells as a table of files, each row with its place."""
    return located(staged(eligibility(spark, sf_dir), "eligibility"))
