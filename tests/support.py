"""Helpers that tests share. Tests import from here, never from a conftest."""

from datetime import date

from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def day(text):
    return None if text is None else date.fromisoformat(text)


def rows(df, *columns):
    """The rows of a small result as sorted tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)


def same(a, b):
    """Whether two frames hold the same rows equally often, each computed once."""
    sides = a.withColumn("_n", F.lit(1)).unionByName(b.select(*a.columns).withColumn("_n", F.lit(-1)))
    return sides.groupBy(*a.columns).agg(F.sum("_n").alias("_n")).where("_n <> 0").isEmpty()


def plan_of(df, capsys):
    """The formatted physical plan as text."""
    capsys.readouterr()
    df.explain("formatted")
    return capsys.readouterr().out
