"""Shards that each match the corpus's mixture of sources, by proportional stratified interleaving."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from spelltide.llm.scratch import stored

ROWS_PER_RANGE = 200
MOST_RANGES = 65_536


def _ranges(rows: int) -> int:
    """A power of two: so many ranges of the hash that each holds a few hundred rows of a source."""
    return min(MOST_RANGES, 1 << max(4, (rows // ROWS_PER_RANGE).bit_length()))


def stratified_shards(
    df: DataFrame, stratum: str, key: str, shards: int, seed: int = 7, carry: dict[str, Column] | None = None
) -> DataFrame:
    """Deal rows to shards so that each holds its share of every stratum.

    Rows of a stratum are shuffled by a seeded hash of the key and ranked r = 1..n; all rows are then
    sorted by (2r - 1) / 2n and cut into shards whose row counts differ by one at most. A shard's
    share of a stratum is exact but for roundings, of which each stratum adds at most one at either end
    of the shard. Returns key, stratum
    and the columns of `carry`, with position (from 0), shard and slot (from 0 in each shard).

    Null strata form one stratum of their own; null keys hash alike. Rows that agree in the key's hash
    are ordered by the carried values, so only rows equal in all returned columns can change places.
    An empty table gives no rows. Other columns are dropped, whatever their names.

    Neither ranking sorts in one task, however hot a stratum is: rows are ranked within ranges of the
    hash, then of the fractional rank, and each range is shifted by the rows of the ranges before it.
    Those counts are at most 65 536 per stratum.
    """
    if shards < 1:
        raise ValueError("at least one shard")
    carry = carry or {}
    hashed = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col(key).cast("string"), F.lit("null"))))
    base = df.select(
        F.col(key).alias("_id"),
        F.col(stratum).alias("_stratum"),
        F.coalesce(F.concat(F.lit("s"), F.col(stratum).cast("string")), F.lit("null")).alias("_s"),
        hashed.alias("_hash"),
        *[column.alias(f"_c_{name}") for name, column in carry.items()],
    )
    base = stored(base, "interleave-rows")
    total = base.count()
    ranges = _ranges(total)
    shift = 32 - (ranges.bit_length() - 1)
    base = base.withColumn("_range", F.shiftright(F.conv(F.substring("_hash", 1, 8), 16, 10).cast("long"), shift))
    order = ["_hash", "_id", *[f"_c_{name}" for name in carry]]

    counts = base.groupBy("_s", "_range").agg(F.count(F.lit(1)).alias("_n"))
    whole = W.partitionBy("_s")
    before = whole.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    starts = counts.select(
        "_s", "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"), F.sum("_n").over(whole).alias("_of")
    )
    ranked = (
        base.withColumn("_rank", F.row_number().over(W.partitionBy("_s", "_range").orderBy(*order)))
        .join(starts.hint("merge"), ["_s", "_range"])
        .withColumn("_odd", 2 * (F.col("_start") + F.col("_rank")) - 1)
        .withColumn("_part", F.col("_odd").cast("double") / (2 * F.col("_of")).cast("double"))
        .withColumn("_slice", F.floor(F.col("_part") * ranges))
        .drop("_range", "_start", "_rank", "_odd", "_of")
    )
    ranked = stored(ranked, "interleave-ranked")
    slices = ranked.groupBy("_slice").agg(F.count(F.lit(1)).alias("_n"))
    before = W.orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    firsts = slices.select("_slice", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    place = F.col("_first") + F.row_number().over(W.partitionBy("_slice").orderBy("_part", "_s", *order)) - 1
    shard = F.expr(f"position * {shards}L div {max(total, 1)}L")
    first = F.expr(f"(shard * {max(total, 1)}L + {shards - 1}L) div {shards}L")
    return (
        ranked.join(firsts.hint("merge"), "_slice")
        .withColumn("position", place)
        .withColumn("shard", shard.cast("int"))
        .withColumn("slot", F.col("position") - first)
        .select(
            F.col("_id").alias(key),
            F.col("_stratum").alias(stratum),
            *[F.col(f"_c_{name}").alias(name) for name in carry],
            "position",
            "shard",
            "slot",
        )
    )
