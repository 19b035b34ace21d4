"""The composed reports against their step-by-step form."""

import re
from datetime import date
from pathlib import Path

import pytest
from support import plan_of, same
from pyspark.sql import functions as F

from spelltide.errors import PostValidationError, PreValidationError, TableNotFoundError
from spelltide.functions.coverage import FROM, MONTH, TO, coverage_measures
from spelltide.operators import quality as Q
from spelltide.operators import residence as R
from spelltide.operators import spells as S
from spelltide.plans import bridge as B
from spelltide.plans import membership as M
from spelltide.schemas import MEMBERSHIP_LEADING, MEMBERSHIP_TRAILING
from spelltide.sources.staging import scratch_scope
from spelltide.sources.tables import TableSpec, register_table

AS_OF = "2001-12-31"
CODES = ["DEN", "MED", "VIS"]


def step_by_step(spark, eligibility, residence, codes):
    months = M.membership_months(eligibility, codes, AS_OF)
    placed = R.with_residence(months, R.residence_current(residence))
    return M.order_columns(coverage_measures(S.best_spell_per_month(placed)), codes)


def test_report_equals_the_steps(spark, sf):
    e, r = B.eligibility(spark, sf), B.residences(spark, sf)
    assert same(M.membership_report(e, r, CODES, AS_OF), step_by_step(spark, e, r, CODES))
    assert same(M.membership_report(e, r, ["DEN"], AS_OF), step_by_step(spark, e, r, ["DEN"]))


def test_report_with_a_hot_member_and_ties(spark, sf):
    """A third of the rows on one member, with equal load times and repeated spells."""
    e = B.eligibility(spark, sf)
    hot = e.withColumn("memberid", F.when(F.col("sysbatchdttm") % 3 == 0, "hot").otherwise(F.col("memberid")))
    hot = hot.withColumn("sysbatchdttm", F.col("sysbatchdttm") % 2)
    r = B.residences(spark, sf)
    assert same(M.membership_report(hot, r, CODES, AS_OF), step_by_step(spark, hot, r, CODES))


def test_report_with_columns_both_tables_have(spark, sf):
    e = B.eligibility(spark, sf).withColumns({"etlchecksum": F.lit("e"), "cor_checksum": F.lit("e"), R.CODE: F.lit("old"), "segment": F.lit("s")})
    r = B.residences(spark, sf).withColumns({"etlchecksum": F.lit("r"), "segment": F.lit("other")})
    report = M.membership_report(e, r, CODES, AS_OF)
    assert same(report, step_by_step(spark, e, r, CODES))
    assert [x.segment for x in report.select("segment").distinct().collect()] == ["s"]


def test_empty_inputs(spark, sf):
    e, r = B.eligibility(spark, sf), B.residences(spark, sf)
    assert M.membership_report(e.where("false"), r, CODES, AS_OF).isEmpty()
    assert M.membership_report(e.where("false"), r, as_of=AS_OF).isEmpty()
    alone = M.membership_report(e, r.where("false"), CODES, AS_OF)
    assert alone.where(f"{R.CODE} is not null").isEmpty() and not alone.isEmpty()


def test_one_row_per_member_and_month(spark, sf):
    report = M.membership_report(B.eligibility(spark, sf), B.residences(spark, sf), CODES, AS_OF)
    assert report.groupBy("memberid", MONTH).count().where("count > 1").isEmpty()


def test_residence_before_or_after_expansion(spark, sf):
    e, r = B.eligibility(spark, sf), B.residences(spark, sf)
    early = M.membership_with_residence(e, r, CODES, AS_OF)
    late = R.with_residence(M.membership_months(e, CODES, AS_OF), R.residence_current(r))
    assert same(early, late)


def test_column_order(spark):
    names = ["segment", "MED", "memberid", "sourcesystemname", "other", "Eligible", "sourcesystemid"]
    df = spark.createDataFrame([tuple("x" * len(names))], names)
    assert M.order_columns(df, ["MED"]).columns == ["memberid", "eligible", "segment", "MED", "sourcesystemid", "sourcesystemname"]
    assert len(MEMBERSHIP_LEADING) == 54 and len(MEMBERSHIP_TRAILING) == 2


def test_report_plan_keeps_months_out_of_broadcasts(spark, sf, capsys):
    plan = plan_of(M.membership_report(B.eligibility(spark, sf), B.residences(spark, sf), CODES, AS_OF), capsys)
    assert plan.count("SortMergeJoin Inner") >= 2
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_jobs_write_what_they_build(spark, sf, tmp_path):
    B.eligibility(spark, sf).createOrReplaceTempView("job_eligibility")
    B.residences(spark, sf).createOrReplaceTempView("job_residence")
    spec, stays = TableSpec(name="job_eligibility"), TableSpec(name="job_residence")
    written = M.run_membership(spark, spec, stays, str(tmp_path / "report"), CODES, AS_OF)
    back = spark.read.parquet(str(tmp_path / "report"))
    assert written == back.count() > 0
    assert same(back, M.membership_report(B.eligibility(spark, sf), B.residences(spark, sf), CODES, AS_OF))
    assert M.run_medical(spark, spec, str(tmp_path / "medical")) == M.membership_medical(B.eligibility(spark, sf)).count()


def test_medical_keeps_the_covered_years_whole(spark, sf):
    report = M.membership_medical(B.eligibility(spark, sf))
    per_spell = report.groupBy("memberid", FROM, TO).agg(F.count("*").alias("n")).where(f"n <> 12 * (year({TO}) - year({FROM}) + 1)")
    assert per_spell.isEmpty()


def test_report_reads_eligibility_twice(spark, sf, tmp_path):
    B.eligibility(spark, sf).write.parquet(str(tmp_path / "eligibility"))
    B.residences(spark, sf).write.parquet(str(tmp_path / "residence"))
    rows, stays = (spark.read.parquet(str(tmp_path / n)) for n in ("eligibility", "residence"))
    report = M.membership_report(rows, stays, ["DEN", "MED", "VIS"], "2001-12-31")
    report.collect()
    plan = report._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert len(re.findall(r"FileScan parquet.*memberid", plan)) == 2


def test_order_can_be_strict(spark, sf):
    months = M.membership_months(B.eligibility(spark, sf), ["DEN"], "2001-12-31")
    with pytest.raises(ValueError, match="familyunitid"):
        M.order_columns(months, ["DEN"], strict=True)
    wide = months.withColumns({c: F.lit(None).cast("string") for c in M.MEMBERSHIP_LEADING + M.MEMBERSHIP_TRAILING if c not in months.columns})
    assert M.order_columns(wide, ["DEN"], strict=True).columns == M.MEMBERSHIP_LEADING + ["DEN"] + M.MEMBERSHIP_TRAILING


def test_medical_months_end_at_the_cut_off(spark):
    row = ("m", "c", "1", date(2020, 1, 5), date(9999, 12, 31), "Medical", "MED", 1)
    schema = "memberid string, customerid string, sourcesystemid string, eligibilityfromdate date, eligibilitytodate date, lineofcover string, lineofcovercode string, sysbatchdttm long"
    assert M.membership_medical(spark.createDataFrame([row], schema), "2021-03-15").count() == 15


def test_jobs_over_stored_tables_validate_and_clean_up(spark, sf, tmp_path):
    shared = Path(spark.conf.get("spark.checkpoint.dir"))
    rows, stays = tmp_path / "eligibility", tmp_path / "residence"
    B.eligibility(spark, sf).write.parquet(str(rows))
    B.residences(spark, sf).write.parquet(str(stays))
    register_table(spark, str(rows), "spells", "spelltide_tests")
    register_table(spark, str(stays), "homes", "spelltide_tests")
    spec, homes = (TableSpec(name=n, database="spelltide_tests") for n in ("spells", "homes"))
    before = set(shared.iterdir())
    report, medical = str(tmp_path / "report"), str(tmp_path / "medical")
    M.run_membership(spark, spec, homes, report, CODES, AS_OF)
    M.run_medical(spark, spec, medical, AS_OF)
    assert set(shared.iterdir()) == before
    with scratch_scope(spark):
        assert same(spark.read.parquet(report), M.membership_report(B.eligibility(spark, sf), B.residences(spark, sf), CODES, AS_OF))
    assert same(spark.read.parquet(medical), M.membership_medical(B.eligibility(spark, sf), AS_OF))
    blank = (Q.matches("lineofcovercode", "[A-Z]", "cover_written"), Q.Threshold(share=0.01))
    with pytest.raises(PreValidationError, match="cover_written"):
        M.run_membership(spark, spec, homes, report, CODES, AS_OF, pre=[blank])
    few = (Q.Rule("all_eligible", ("eligible",), F.col("eligible") != 1, "months without cover"), Q.Threshold(rows=5))
    for run in (lambda: M.run_membership(spark, spec, homes, report, CODES, AS_OF, post=[few]), lambda: M.run_medical(spark, spec, medical, AS_OF, post=[few])):
        with pytest.raises(PostValidationError, match="all_eligible"):
            run()
    with pytest.raises(TableNotFoundError, match="eligibility"):
        M.run_medical(spark, TableSpec(name="spells", database="spelltide_tests", predicate="memberid = 'nobody'"), medical, AS_OF)
    assert spark.read.parquet(report).count() > 0 < spark.read.parquet(medical).count()
    assert set(shared.iterdir()) == before and not [p for p in tmp_path.iterdir() if p.name.startswith("_")]


def test_best_months_shuffle_one_number_beside_their_key(spark, sf, capsys):
    keys = S.spell_covers(S.cover_override(S.as_dates(B.eligibility(spark, sf))), CODES)
    best = M.best_months(keys, CODES, AS_OF)
    assert "min_by" not in plan_of(best, capsys)
    assert best.schema == best.selectExpr("memberid", f"date({FROM}) {FROM}", f"date({TO}) {TO}", MONTH).schema


def test_spell_is_read_off_its_preference(spark):
    rows = [("2024-02-01", a, b) for a in ("0001-01-01", "1969-12-31", "2024-01-31", "2024-02-01", "2024-02-02", "9999-12-31") for b in ("0001-01-01", "1970-01-01", "9999-12-31")]
    df = spark.createDataFrame(rows, f"{MONTH} string, {FROM} string, {TO} string").select(*[F.col(c).cast("date").alias(c) for c in (MONTH, FROM, TO)])
    for active in (0, 1):
        start, end = M._preferred(M._preference(F.lit(active)))
        assert df.where((start != F.col(FROM)) | (end != F.col(TO)) | start.isNull() | end.isNull()).isEmpty()
