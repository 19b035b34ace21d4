"""Run every query next to its SQL and report row, column and value differences."""

from __future__ import annotations

import sys
import time
from collections import Counter

import duckdb
from pyspark.sql import DataFrame, SparkSession

from checks.oracles import SQL
from checks.queries import QUERIES

TABLES = """region nation customer supplier part orders lineitem events documents embeddings pages benchmark
labels conversations""".split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def rows_of(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(row[i] for i in order) for row in rows)


def difference(con, name: str, df: DataFrame) -> str | None:
    """What differs between a query's result and its SQL, or None."""
    have = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if name not in SQL:
        return None
    result = con.execute(SQL[name])
    columns = [d[0] for d in result.description]
    want = rows_of(columns, result.fetchall())
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} want {sorted(columns)}"
    if not want:
        return "the SQL gives no rows"
    if have != want:
        return f"{have.total()} rows, want {want.total()}; extra {list((have - want))[:2]}, missing {list((want - have))[:2]}"
    return None


def main(sf_dir: str, names: list[str]) -> int:
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, wrong = duck(sf_dir), 0
    for name in names or QUERIES:
        start = time.time()
        try:
            found = difference(con, name, QUERIES[name](spark, sf_dir))
        except Exception as error:  # one broken query must not hide the others
            found = f"{type(error).__name__}: {str(error)[:600]}"
        wrong += found is not None
        print(f"{name:32s} {time.time() - start:6.2f}s {'ok' if found is None else found}", flush=True)
    print(f"{wrong} of {len(names or QUERIES)} differ; without SQL: {sorted(set(QUERIES) - set(SQL))}")
    return wrong


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
