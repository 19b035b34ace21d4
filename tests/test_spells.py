import re
from datetime import date

import pytest
from support import day, plan_of, rows, same
from pyspark.sql import functions as F

from spelltide.functions.coverage import FROM, MONTH, TO
from spelltide.operators import spells as S
from spelltide.plans import bridge as B
from spelltide.plans import membership as M
from spelltide.sources import staging
from spelltide.sources.tables import located

SCHEMA = f"""memberid string, customerid string, sourcesystemid string, {FROM} date, {TO} date, lineofcover string,
    lineofcovercode string, sysbatchdttm bigint"""


def eligibility(spark, *entries):
    return spark.createDataFrame(
        [(m, f"C{m}", src, day(a), day(b), "x", code, loaded) for m, src, a, b, code, loaded in entries], SCHEMA
    )


def test_override_and_blank_codes(spark):
    df = eligibility(
        spark,
        ("1", "1", "2024-01-01", "2024-02-01", None, 1),
        ("2", "2", "2024-01-01", "2024-02-01", "  ", 2),
        ("3", "2", "2024-01-01", "2024-02-01", "DEN", 3),
        ("4", None, "2024-01-01", "2024-02-01", "DEN", 4),
    )
    after = S.covered(S.cover_override(df))
    assert rows(after, "memberid", "lineofcovercode") == [("1", "MED"), ("3", "DEN"), ("4", "DEN")]
    before = S.eligibility_source(df)
    assert rows(before, "memberid") == [("3",), ("4",)]


def test_whole_years_are_expanded(spark):
    df = eligibility(spark, ("1", "2", "2023-11-20", "2024-02-01", "DEN", 1))
    months = [r[0] for r in S.month_expand(df, cut_off=False).select(MONTH).orderBy(MONTH).collect()]
    assert (months[0], months[-1], len(months)) == (date(2023, 1, 1), date(2024, 12, 1), 24)
    assert S.month_expand(df, "2024-03-31").count() == 15
    assert S.month_cutoff(S.month_expand(df, cut_off=False), "2024-03-31").count() == 15
    assert S.month_expand(df, "2022-12-31").count() == 0


def test_open_ended_spell_expands_only_to_the_cut_off(spark):
    df = eligibility(spark, ("1", "2", "2024-05-05", "9999-12-31", "DEN", 1))
    assert S.month_expand(df, "2024-08-15").count() == 8


def test_spell_that_ends_before_it_starts(spark):
    df = eligibility(spark, ("1", "2", "2024-05-05", "2023-01-01", "DEN", 1), ("2", "2", None, "2023-01-01", "DEN", 2))
    assert S.month_expand(df, "2024-12-31").count() == 0


def test_pivot_flags(spark):
    df = eligibility(
        spark,
        ("1", "2", "2024-01-10", "2024-02-10", "DEN", 1),
        ("1", "2", "2024-01-10", "2024-02-10", " MED ", 2),
        ("1", "2", "2024-01-10", "2024-02-10", None, 0),
        ("2", "2", "2024-02-01", "2024-02-10", "DEN", 3),
    )
    got = S.cover_pivot(df, as_of="2024-03-01")
    assert got.columns == ["memberid", FROM, TO, MONTH, "eligible", "DEN", "MED"]
    assert rows(got.where("memberid = '1'"), F.month(MONTH), "DEN", "MED", "eligible") == [(1, 1, 1, 1), (2, 1, 1, 1), (3, 0, 0, 0)]
    assert rows(got.where("memberid = '2'"), F.month(MONTH), "DEN", "MED", "eligible") == [(1, 0, 0, 0), (2, 1, 0, 1), (3, 0, 0, 0)]
    nulls = S.cover_pivot(df, as_of="2024-03-01", absent=None).where("memberid = '2'")
    assert rows(nulls, F.month(MONTH), "DEN", "MED", "eligible") == [(1, 0, None, 0), (2, 1, None, 1), (3, 0, None, 0)]


def test_fixed_codes_keep_spells_without_them(spark):
    df = eligibility(spark, ("2", "2", "2024-02-01", "2024-02-10", "DEN", 3))
    assert rows(S.cover_pivot(df, ["MED"], "2024-02-01"), "MED", "eligible") == [(0, 0), (0, 0)]


def test_codes_with_odd_names(spark):
    df = eligibility(spark, ("1", "2", "2024-01-01", "2024-01-10", "A.B c", 3))
    assert S.cover_pivot(df, as_of="2024-01-01").columns[-1] == "A.B c"
    with pytest.raises(ValueError):
        S.cover_pivot(df, ["med", "MED"])
    with pytest.raises(ValueError):
        M.membership_months(df, ["CustomerId"])


def test_codes_of_spells_after_the_cut_off_are_not_discovered(spark):
    df = eligibility(spark, ("1", "2", "2024-01-01", "2024-01-10", "A", 1), ("1", "2", "2026-01-01", "2026-01-10", "B", 2))
    assert S.discover_codes(df, "2024-06-01") == ["A"]


def test_snapshot_takes_the_first_loaded_row_even_without_cover(spark):
    df = eligibility(
        spark,
        ("1", "3", "2024-01-10", "2024-02-10", "DEN", 5),
        ("1", "2", "2024-01-10", "2024-02-10", " ", 4),
        ("1", "4", "2024-01-10", "2024-02-10", "DEN", None),
    )
    assert rows(S.spell_snapshot(df), "sourcesystemid") == [("4",)]
    late = df.where("sysbatchdttm is not null")
    assert rows(S.spell_snapshot(late), "sourcesystemid", "lineofcovercode") == [("2", " ")]
    assert rows(M.membership_months(late, as_of="2024-01-01"), "sourcesystemid", "DEN") == [("2", 1)]


def test_member_without_id_is_left_out(spark):
    df = eligibility(spark, (None, "3", "2024-01-10", "2024-02-10", "DEN", 5))
    assert M.membership_months(df, ["DEN"], "2024-12-31").count() == 0


def test_one_aggregate_equals_pivot_plus_snapshot_join(spark, sf):
    rows_ = S.cover_override(B.eligibility(spark, sf))
    codes = ["DEN", "MED", "VIS"]
    months = S.cover_pivot(rows_, codes, "2001-12-31")
    joined = S.spell_snapshot_join(months, S.spell_snapshot(rows_))
    direct = M.membership_months(B.eligibility(spark, sf), codes, "2001-12-31")
    columns = [c for c in joined.columns if not c.endswith("_source")]
    a, b = joined.select(*columns), direct.select(*columns)
    assert same(a, b)


def test_snapshot_limits_each_group_before_the_shuffle(spark, sf, capsys):
    plan = plan_of(S.spell_snapshot(B.eligibility(spark, sf)), capsys)
    assert plan.count("WindowGroupLimit") >= 2


def test_best_spell(spark):
    schema = f"memberid string, {MONTH} date, {FROM} date, {TO} date, eligible int"
    df = spark.createDataFrame(
        [
            ("1", day("2024-03-01"), day("2024-03-01"), day("2024-03-02"), 0),
            ("1", day("2024-03-01"), day("2023-01-01"), day("2024-03-02"), 1),
            ("2", day("2024-03-01"), day("2024-02-20"), day("2024-03-02"), 1),
            ("2", day("2024-03-01"), day("2024-03-11"), day("2024-03-12"), 1),
            ("3", day("2024-03-01"), day("2024-02-20"), day("2024-03-09"), 1),
            ("3", day("2024-03-01"), day("2024-02-20"), day("2024-03-02"), 1),
        ],
        schema,
    )
    assert rows(S.best_spell_per_month(df), "memberid", FROM, TO) == [
        ("1", date(2023, 1, 1), date(2024, 3, 2)),
        ("2", date(2024, 2, 20), date(2024, 3, 2)),
        ("3", date(2024, 2, 20), date(2024, 3, 2)),
    ]


# --- late materialisation ---


@pytest.fixture(scope="module")
def stored_spells(spark, sf, tmp_path_factory):
    """Spells with wide attributes, in four files."""
    path = str(tmp_path_factory.mktemp("spells") / "table")
    wide = {f"attribute{i}": F.sha2(F.concat("memberid", F.lit(i)), 256) for i in range(8)}
    S.cover_override(B.eligibility(spark, sf)).withColumns(wide).repartition(4).write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("broadcast", ["10MB", "-1"])
def test_late_equals_early(spark, stored_spells, broadcast):
    codes = ["DEN", "MED", "VIS"]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        assert same(S.spell_snapshot(stored_spells), S.spell_snapshot(located(stored_spells)))
        early, late = (M.membership_months(x, codes, "2001-12-31") for x in (stored_spells, located(stored_spells)))
        assert sorted(early.columns) == sorted(late.columns) and same(early, late)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_late_plan_neither_sorts_nor_shuffles_wide_rows(stored_spells, capsys):
    for df in (S.spell_snapshot(located(stored_spells)), M.membership_months(located(stored_spells), ["DEN", "MED"], "2001-12-31")):
        plan = plan_of(df, capsys)
        assert "BroadcastHashJoin" in plan and not re.search(r"SortAggregate|Window|Sort\b|Exchange hashpartitioning", plan.split("\n(1)")[0])
    assert "Exchange" in plan_of(S.spell_snapshot(stored_spells), capsys)


def test_places_are_found_in_narrow_rows(spark, stored_spells, monkeypatch, capsys):
    plans = []
    monkeypatch.setattr(S, "staged", lambda df, label: plans.append(plan_of(df, capsys)) or staging.staged(df, label))
    S.first_places(located(stored_spells), ["MED"], ["customerid"])
    assert "attribute0" not in plans[0] and "lineofcovercode" in plans[0]


def test_of_rows_loaded_together_the_first_in_the_table_counts(spark, tmp_path):
    rows_ = [("1", "9", "2024-01-10", "2024-02-10", "DEN", 5), ("1", "2", "2024-01-10", "2024-02-10", "MED", 5), (None, "2", "2024-01-10", "2024-02-10", "MED", 5)]
    eligibility(spark, *rows_).coalesce(1).write.parquet(str(tmp_path / "t"))
    df = located(spark.read.parquet(str(tmp_path / "t")))
    assert rows(S.spell_snapshot(df), "sourcesystemid") == [("9",)]
    months = M.membership_months(df, as_of="2024-01-01")
    assert rows(months, "sourcesystemid", "DEN", "MED") == [("9", 1, 1)]
    assert M.membership_months(located(spark.read.parquet(str(tmp_path / "t")).where("false")), ["MED"], "2024-01-01").count() == 0


def test_months_are_not_sorted_for_their_snapshot(spark, sf, capsys):
    rows_ = S.cover_override(B.eligibility(spark, sf))
    plan = plan_of(S.spell_snapshot_join(S.cover_pivot(rows_, ["DEN", "MED", "VIS"], "2001-12-31"), S.spell_snapshot(rows_)), capsys)
    assert "ShuffledHashJoin" in plan and "BuildRight" in plan and "SortMergeJoin" not in plan
