from datetime import datetime

from support import day, rows

from spelltide.functions.coverage import FROM, TO
from spelltide.operators import residence as R

STAY = f"""customerid string, sourcesystemid string, {R.TYPE} string, {R.CODE} string, {R.START} date, {R.END} date,
    etlchecksum string"""


def stays(spark, *entries):
    return spark.createDataFrame([("C1", "1", t, c, day(a), day(b), c) for t, c, a, b in entries], STAY)


def spells(spark, *entries):
    schema = f"memberid string, customerid string, sourcesystemid string, {FROM} date, {TO} date"
    return spark.createDataFrame([("m", c, s, day(a), day(b)) for c, s, a, b in entries], schema)


def test_current_residence(spark):
    df = stays(
        spark,
        ("SEC", "1", "2020-01-01", None),
        ("PRI", "2", "2020-01-01", "2024-01-01"),
        ("PRI", "3", "2019-01-01", None),
        ("PRI", "4", "2018-01-01", None),
    )
    got = R.residence_current(df)
    assert "cor_checksum" in got.columns
    assert rows(got, R.CODE, R.END) == [("4", datetime(9999, 12, 31))]


def test_null_type_comes_first(spark):
    assert rows(R.residence_current(stays(spark, ("PRI", "1", None, None), (None, "2", None, "2020-01-01"))), R.CODE) == [("2",)]


def overlap(spark, start, end):
    placed = R.with_residence(
        spells(spark, ("C1", "1", "2024-01-01", "2024-06-30")), R.residence_current(stays(spark, ("PRI", "X", start, end)))
    )
    return rows(placed, R.CODE, R.START, R.END)


def test_overlap(spark):
    low, high = datetime(1900, 1, 1), datetime(9999, 12, 31)
    assert overlap(spark, "2023-01-01", "2024-01-01") == [("X", datetime(2023, 1, 1), datetime(2024, 1, 1))]
    assert overlap(spark, "2024-06-30", None) == [("X", datetime(2024, 6, 30), high)]
    assert overlap(spark, "2024-07-01", None) == [(None, low, high)]
    assert overlap(spark, "2023-01-01", "2023-12-31") == [(None, low, high)]
    assert overlap(spark, None, None) == [("X", low, high)]


def test_backward_intervals_follow_the_either_or_rule(spark):
    """A spell that ends before it starts still matches a residence around its start."""
    back = spells(spark, ("C1", "1", "2024-06-30", "2024-01-01"))
    current = R.residence_current(stays(spark, ("PRI", "X", "2024-06-01", None)))
    assert rows(R.residence_overlap_join(back, current), R.CODE) == [("X",)]


def test_other_source_and_missing_keys_do_not_match(spark):
    current = R.residence_current(stays(spark, ("PRI", "X", None, None)))
    df = spells(spark, ("C1", "2", "2024-01-01", "2024-02-01"), (None, "1", "2024-01-01", "2024-02-01"), ("C1", "1", "2024-01-01", "2024-02-01"))
    assert rows(R.residence_overlap_join(df, current), "customerid", "sourcesystemid", R.CODE) == [
        ("C1", "1", "X"),
        ("C1", "2", None),
        (None, "1", None),
    ]


def test_old_residence_columns_are_replaced(spark):
    from pyspark.sql import functions as F

    df = spells(spark, ("C1", "1", "2024-01-01", "2024-02-01")).withColumn(R.CODE, F.lit("old"))
    current = R.residence_current(stays(spark, ("PRI", "X", None, None)))
    assert rows(R.with_residence(df, current), R.CODE) == [("X",)]


def test_columns_both_sides_have(spark):
    from pyspark.sql import functions as F

    df = spells(spark, ("C1", "1", "2024-01-01", "2024-02-01")).withColumn("etlchecksum", F.lit("spell"))
    stay = stays(spark, ("PRI", "X", None, None)).withColumn("MemberId", F.lit("other"))
    got = R.with_residence(df, R.residence_current(stay))
    assert len({c.lower() for c in got.columns}) == len(got.columns)
    assert rows(got, "memberid", "etlchecksum", "cor_checksum") == [("m", "spell", "X")]


def test_a_customer_with_a_third_of_the_spells_is_split(spark):
    """The stored residences and the spells both come straight from an exchange, so AQE splits the hot customer."""
    days = [f"date_add(date'2020-01-01', cast(id % 900 as int)) AS {FROM}", f"date_add(date'2020-03-01', cast(id % 1100 as int)) AS {TO}"]
    who = "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('C', id % 5000) END"
    spells = spark.range(60_000).selectExpr("cast(id as string) AS memberid", f"{who} AS customerid", "'1' AS sourcesystemid", *days, "sha2(cast(id as string), 512) AS note")
    stay = [
        f"'PRI' AS {R.TYPE}", f"cast(id % 40 as string) AS {R.CODE}", f"date'2020-02-01' AS {R.START}",
        f"date_add(date'2021-01-01', cast(id % 700 as int)) AS {R.END}",
    ]
    homes = spark.range(5_000).selectExpr("CASE WHEN id = 0 THEN 'hot' ELSE concat('C', id) END AS customerid", "'1' AS sourcesystemid", *stay, "'x' AS etlchecksum")
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128k",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        plain = R.with_residence(spells.repartition(8), R.residence_current(homes))
        split = R.with_residence(spells.repartition(8), R.residence_lookup(homes))
        want, have = rows(plain, "memberid", R.CODE, R.START, R.END), rows(split, "memberid", R.CODE, R.START, R.END)
        plans = []
        for df in (plain, split):
            df.collect()
            plans.append(df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0])
    finally:
        for key in settings:
            spark.conf.unset(key)
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert want == have
    assert "skew=true" not in plans[0] and "SortMergeJoin(skew=true)" in plans[1]
