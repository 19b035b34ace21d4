"""Membership-month reports."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spelltide.errors import PreValidationError
from spelltide.functions.coverage import FROM, MONTH, TO, coverage_measures, touches_month
from spelltide.operators import residence as R
from spelltide.operators import spells as S
from spelltide.operators.conform import lenient_select
from spelltide.operators.quality import Check, validate
from spelltide.schemas import MEMBERSHIP_LEADING, MEMBERSHIP_TRAILING
from spelltide.session import apply_settings
from spelltide.sources.files import write_frame
from spelltide.sources.staging import scratch_scope
from spelltide.sources.tables import LOCATOR, TableSpec, located, require_rows, scan_table


def _carried(df: DataFrame) -> list[str]:
    """Attribute columns of a spell, the residence keys first.

    The first-loaded row is the smallest of these values in order, so a plan that carries only the
    keys picks the same row as one that carries everything.
    """
    return R.KEYS + [c for c in df.columns if c not in {*S.SPELL, S.LOADED, *R.KEYS, *LOCATOR}]


def membership_months(eligibility: DataFrame, codes: list[str] | None = None, as_of=None, absent: int | None = 0) -> DataFrame:
    """Every spell by month up to `as_of`, with cover flags and the attributes of its first-loaded row."""
    rows = S.cover_override(S.as_dates(eligibility))
    codes = codes or S.discover_codes(rows, as_of)
    spells = S.spell_covers(rows, codes, carry=_carried(rows))
    return S.with_source_key(S.flag_covers(S.month_expand(spells, as_of), codes, absent))


def membership_with_residence(
    eligibility: DataFrame, residence: DataFrame, codes: list[str] | None = None, as_of=None, absent: int | None = 0
) -> DataFrame:
    """Membership months with the country of residence, attached per spell before months are expanded.

    The current residences are stored first, so building the plan runs a job; `scratch_scope` removes them.
    """
    rows = S.cover_override(S.as_dates(eligibility))
    codes = codes or S.discover_codes(rows, as_of)
    spells = S.spell_covers(rows, codes, carry=_carried(rows))
    placed = R.with_residence(spells, R.residence_lookup(residence))
    return S.with_source_key(S.flag_covers(S.month_expand(placed, as_of), codes, absent))


def order_columns(df: DataFrame, codes: list[str], strict: bool = False) -> DataFrame:
    """The report's column order; columns the input does not have are left out, or raise with `strict`."""
    wanted = MEMBERSHIP_LEADING + codes + MEMBERSHIP_TRAILING
    if strict:
        have = {c.lower() for c in df.columns}
        lacking = [c for c in wanted if c.lower() not in have]
        if lacking:
            raise ValueError(f"the report lacks columns: {lacking}")
    return lenient_select(df, wanted)


# Bits for a number of days, so that a preference fits a long; the end counts from so many days before 1970.
DAY_BITS = 30
DAY_ORIGIN = 1 << (DAY_BITS - 1)


def _preference(active: Column) -> Column:
    """One number that orders the spells of a member and month as `best_spell_per_month` does:
    eligible first, nearest start, earlier start, earlier end. The spell can be read off it, see `_preferred`."""
    distance = F.datediff(F.col(MONTH), F.col(FROM)).cast("bigint")
    later = F.when(distance < 0, 1).otherwise(0)
    end = F.datediff(F.col(TO), F.lit("1970-01-01").cast("date")) + DAY_ORIGIN
    return (((1 - active) * (1 << DAY_BITS) + F.abs(distance)) * 2 + later) * (1 << DAY_BITS) + end


def _preferred(preference: Column) -> tuple[Column, Column]:
    """Start and end of the spell that a preference was made of, in the row of its month."""
    days = lambda bits: F.shiftright(preference, bits).bitwiseAND((1 << DAY_BITS) - 1).cast("int")
    later = F.shiftright(preference, DAY_BITS).bitwiseAND(1) == 1
    start = F.date_sub(F.col(MONTH), F.when(later, -days(DAY_BITS + 1)).otherwise(days(DAY_BITS + 1)))
    return start, F.date_add(F.lit("1970-01-01").cast("date"), days(0) - DAY_ORIGIN)


def best_months(spells: DataFrame, codes: list[str], as_of=None) -> DataFrame:
    """The spell that counts for each member and month, as bare keys, of spells with their held covers.

    Only keys and dates are expanded to months and shuffled, and each task keeps its own best
    candidate per member and month before the shuffle. The preference is a plain number from which the spell can be read
    off, so both steps are hash aggregates of one long, nothing is sorted, and no spell is shuffled beside its preference.
    """
    held = F.coalesce(F.lit(None).cast("int"), *[F.col(c) for c in S.held_columns(codes)])
    active = F.when(held == 1, touches_month(F.col(MONTH), F.col(FROM), F.col(TO))).otherwise(0)
    best = S.month_expand(spells, as_of).groupBy("memberid", MONTH).agg(F.min(_preference(active)).alias("_preference"))
    start, end = _preferred(F.col("_preference"))
    return best.select("memberid", start.alias(FROM), end.alias(TO), MONTH)


def membership_report(
    eligibility: DataFrame, residence: DataFrame, codes: list[str] | None = None, as_of=None, absent: int | None = 0
) -> DataFrame:
    """One row per member and month with covers, coverage measures, attributes and residence.

    The wide attributes are shuffled once, by spell. Residence and the choice of spell per month are
    worked out on key columns alone and then joined to the spells, which already lie by spell. Both start
    from one narrow aggregate, whose exchange Spark reuses, so the table is read twice: once narrow, once
    wide. Rows that tell their place (`located`) are read once narrow, for keys, covers and the place of the first-loaded
    row, and their attributes are fetched from there. The joins are sort-merge by hint: months outgrow the size Spark estimates for them, which must
    not lead to a broadcast.
    """
    rows = S.cover_override(S.as_dates(eligibility))
    codes = codes or S.discover_codes(rows, as_of)
    stay = [R.TYPE, R.CODE, R.START, R.END]
    if S.is_located(rows):
        places = S.first_places(rows, codes, R.KEYS).where("_covered").drop("_covered")
        keys = places.drop(*LOCATOR)
        bare = S.fetched(rows, places.drop(*R.KEYS), [S.LOADED, *_carried(rows)]).drop(*stay)
        return _reported(keys, bare, residence, codes, as_of, absent)
    spells = S.spell_covers(rows, codes, carry=_carried(rows))
    # Both uses of the narrow aggregate must ask for the same, or they could not share its exchange: only
    # spells with months, and, by a condition that always holds, every column.
    first, last = S.month_range(as_of)
    used = [first <= last] + [F.coalesce(F.length(F.col(c).cast("string")), F.lit(0)) >= 0 for c in (*S.held_columns(codes), *R.KEYS)]
    keys = S.spell_covers(rows, codes, carry=R.KEYS).where(reduce(and_, used))
    return _reported(keys, spells.drop(*stay), residence, codes, as_of, absent)


def _reported(keys: DataFrame, bare: DataFrame, residence: DataFrame, codes: list[str], as_of, absent: int | None) -> DataFrame:
    """The report from narrow spells (keys and held covers) and from their attributes."""
    stay = [R.TYPE, R.CODE, R.START, R.END]
    placed = R.with_residence(keys.select(*S.SPELL, *R.KEYS), R.residence_lookup(residence)).select(*S.SPELL, *stay)
    months = (
        best_months(keys, codes, as_of)
        .join(bare.hint("merge"), S.SPELL)
        .join(placed.hint("merge"), S.SPELL)
    )
    return order_columns(coverage_measures(S.with_source_key(S.flag_covers(months, codes, absent))), codes)


def membership_medical(eligibility: DataFrame, as_of=None) -> DataFrame:
    """The medical-only report: every spell by month of its whole years, flagged for medical cover.

    With `as_of` no month after it is generated. Without it a spell that is open to 9999 has a row for
    every month until then.
    """
    codes = ["MED"]
    rows = S.eligibility_source(eligibility)
    spells = S.spell_covers(rows, codes, carry=_carried(rows))
    months = S.flag_covers(S.month_expand(spells, as_of, cut_off=as_of is not None), codes)
    return order_columns(coverage_measures(months), codes)


def run_medical(
    spark: SparkSession, table: TableSpec, path: str, as_of=None, shuffled_bytes: int | None = None, pre: Sequence[Check] = (), post: Sequence[Check] = ()
) -> int:
    """Read the eligibility table, build the medical report and overwrite it at the path.

    `pre` are checks of the eligibility table, `post` of the report before it is published. An empty table raises
    TableNotFoundError and leaves the target as it was.
    """
    apply_settings(spark, shuffled_bytes)
    rows = scan_table(spark, table, force=True, probe=False)
    validate(rows, pre, table.name, PreValidationError)
    with scratch_scope(spark):
        return _published(membership_medical(_placed(rows), as_of), path, "medical report", post, eligibility=rows)


def _placed(rows: DataFrame) -> DataFrame:
    """Rows with their place where they come from Parquet files; views over other things stay as they are."""
    try:
        return located(rows)
    except AnalysisException:
        return rows


def _published(report: DataFrame, path: str, label: str, post: Sequence[Check], **inputs: DataFrame) -> int:
    """Write the report, check what was written and publish it; an empty one is published if its inputs have rows."""

    def check(kept: DataFrame, rows: int) -> None:
        if not rows:
            require_rows(**inputs)
        validate(kept, post, label)

    return write_frame(report, path, skip_empty=False, check=check)


def run_membership(
    spark: SparkSession,
    eligibility: TableSpec,
    residence: TableSpec,
    path: str,
    codes: list[str] | None = None,
    as_of=None,
    shuffled_bytes: int | None = None,
    pre: Sequence[Check] = (),
    post: Sequence[Check] = (),
) -> int:
    """Read both tables, build the membership report and overwrite it at the path.

    `shuffled_bytes`, the size of the largest shuffle to expect, sets how many partitions shuffles start with. `pre` and
    `post` are as for `run_medical`.
    """
    apply_settings(spark, shuffled_bytes)
    rows = scan_table(spark, eligibility, force=True, probe=False)
    validate(rows, pre, eligibility.name, PreValidationError)
    with scratch_scope(spark):
        report = membership_report(_placed(rows), scan_table(spark, residence), codes=codes, as_of=as_of)
        return _published(report, path, "membership report", post, eligibility=rows)
