"""Scans, sinks, filters and conformance."""

from datetime import date
from pathlib import Path
from decimal import Decimal as D

import pytest
from support import plan_of, rows
from pyspark.sql import functions as F

from spelltide.errors import ColumnNotFoundError, InvalidTableSchemaError
from spelltide.operators import conform as N
from spelltide.operators import filters as L
from spelltide.plans import bridge as B
from spelltide.schemas import CLAIMS, EXCHANGE_RATE, columns
from spelltide.session import apply_settings, shuffle_partitions
from spelltide.sources import files as IO
from spelltide.sources import staging
from spelltide.sources import tables as TB


@pytest.fixture(scope="module")
def people(spark):
    spark.createDataFrame([(1, "a", "x"), (2, "b", "y"), (2, "b", "y")], "id int, name string, part string").createOrReplaceTempView("people")
    return columns("id integer, name string")


def test_scan_table(spark, people):
    spec = TB.TableSpec(name="people", schema=people)
    assert rows(TB.scan_table(spark, spec)) == [(1, "a"), (2, "b"), (2, "b")]
    assert TB.scan_table(spark, TB.TableSpec(name="people", schema=people, distinct=True)).count() == 2
    assert rows(TB.scan_table(spark, TB.TableSpec(name="people", columns=("part",), predicate="id=1,name in ('a','b')"))) == [("x",)]


def test_missing_or_empty_table(spark, people):
    missing = TB.TableSpec(name="nobody", schema=people)
    assert TB.scan_table(spark, missing).schema == people
    empty = TB.TableSpec(name="people", schema=people, predicate="id > 9")
    assert TB.scan_table(spark, empty).columns == ["id", "name"]
    for spec in (missing, empty):
        with pytest.raises(TB.TableNotFoundError):
            TB.scan_table(spark, spec, force=True)


def test_scan_tables(spark, people):
    spark.createDataFrame([("c", 3)], "name string, id int").createOrReplaceTempView("more_people")
    spec = TB.TableSpec(tables=("people", "nobody", "more_people"), schema=people, distinct=True)
    assert rows(TB.scan_tables(spark, spec)) == [(1, "a"), (2, "b"), (3, "c")]
    none = TB.TableSpec(tables=("nobody",), schema=people)
    assert TB.scan_tables(spark, none).schema == people
    with pytest.raises(TB.TableNotFoundError):
        TB.scan_tables(spark, spec, force=True)


def test_catalog_table_with_partitions(spark, people):
    spark.table("people").write.mode("overwrite").partitionBy("part").saveAsTable("people_table")
    assert N.table_types(spark, "people_table") == {"id": "int", "name": "string", "part": "string"}
    spec = TB.TableSpec(name="people_table", database="default", predicate="part='x'")
    assert TB.scan_table(spark, spec, force=True).count() == 1


def test_scan_path_prunes_partitions(spark, tmp_path, capsys):
    root = str(tmp_path / "t")
    spark.range(100).selectExpr("id", "id % 5 AS a", "date_add(date'2024-01-01', cast(id % 3 as int)) AS d").write.partitionBy("a", "d").parquet(root)
    df = TB.scan_path(spark, root, "a=2 and d=2024-01-02")
    assert df.columns == ["id", "a", "d"]
    assert rows(df.select("id")) == rows(spark.range(100).where("id % 5 = 2 and id % 3 = 1"))
    plan = plan_of(df, capsys)
    assert "PartitionFilters: [isnotnull(a" in plan and "(a#" in plan


def test_view_and_sql(spark, people):
    assert rows(TB.scan_view(spark, "people", "id > 1,name <> 'z'", ["id"], distinct=True)) == [(2,)]
    got = TB.run_sql_clean(spark, "SELECT id AS `the id`, name AS `a b c` FROM {p}", p=spark.table("people"))
    assert got.columns == ["the_id", "a_b_c"]


def test_partition_names():
    assert TB.partition_names(" a, b,,") == ["a", "b"]
    assert TB.partition_names("") == TB.partition_names(None) == []


def test_read_files(spark, tmp_path):
    df = spark.createDataFrame([(1, "a,b"), (2, None)], "id int, t string")
    for kind in ("csv", "json", "parquet", "orc"):
        path = str(tmp_path / kind)
        IO.write_frame(df, path, kind, **({"header": "true"} if kind == "csv" else {}))
        assert rows(IO.read_files(spark, path, kind.upper(), df.schema)) == rows(df)
    assert rows(IO.read_files(spark, str(tmp_path / "csv"), "txt", options={"inferSchema": "true"})) == rows(df)
    both = [str(tmp_path / "parquet")] * 2
    assert IO.read_files(spark, both).count() == 4
    lines = IO.read_files(spark, str(tmp_path / "csv"), "text")
    assert {r.value for r in lines.collect()} == {"id,t", '1,"a,b"', "2,"}
    unknown = IO.read_files(spark, "nowhere", "xlsx", df.schema)
    assert unknown.schema == df.schema and unknown.isEmpty()


def test_write_frame(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.range(10).selectExpr("id", "id % 2 AS p")
    assert IO.write_frame(df, path, partition_by=["p", " "], mirror="p", files=1) == 10
    back = spark.read.parquet(path)
    assert set(back.columns) == {"id", "p", "p_val"}
    assert IO.write_frame(df, path, mode="append", partition_by=["p"], mirror="p", cluster=True) == 10
    assert spark.read.parquet(path).count() == 20
    assert IO.write_frame(df.where("id < 0"), path) == 0
    assert spark.read.parquet(path).count() == 20
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        IO.write_frame(df, path, mode="errorifexists")


def test_overwrite_is_static_unless_asked(spark, tmp_path):
    path = str(tmp_path / "o")
    df = spark.range(4).selectExpr("id", "id % 2 AS p")
    IO.write_frame(df, path, partition_by=["p"])
    IO.write_frame(df.where("p = 1"), path, partition_by=["p"], partitionOverwriteMode="dynamic")
    assert spark.read.parquet(path).count() == 4
    IO.write_frame(df.where("p = 1"), path, partition_by=["p"])
    assert spark.read.parquet(path).count() == 2


def test_write_reports(spark, tmp_path):
    long = "a report with a rather long name, part one"
    paths = IO.write_reports({long: spark.range(2), "short": spark.range(3)}, str(tmp_path))
    assert paths[long].endswith("/" + long[:30])
    assert spark.read.parquet(paths["short"]).count() == 3
    with pytest.raises(ValueError):
        IO.write_reports({long: spark.range(2), long[:-3] + "two": spark.range(3)}, str(tmp_path))


def test_paths(spark):
    assert IO.output_path("b", "p/q", "name", "csv") == "s3a://b/p/q/csv/name/"
    assert IO.output_path("b", "p", "name") == "s3a://b/p/name/"
    first, second = IO.scratch_path(spark, "x"), IO.scratch_path(spark, "x")
    assert first != second and first.startswith(spark.conf.get("spark.checkpoint.dir"))


@pytest.mark.parametrize(
    "conditions, ids",
    [
        ("name='b'", [2, 2]),
        ("name=b", [2, 2]),
        ("name==b", [2, 2]),
        ("id=2,part=y", [2, 2]),
        ("id>=2", [2, 2]),
        ("id!=2", [1]),
        ("id<>2,id<=1", [1]),
        ("id<=>1", [1]),
        (["id = 1", "id = 1"], [1]),
        ("name in ('a','c'),id=1", [1]),
        ("", [1, 2, 2]),
        ("name='a,b'", []),
        ("name='b' or id = 1", [1, 2, 2]),
        ("name='it''s'", []),
        (["name = 'b' and id is not null"], [2, 2]),
    ],
)
def test_conjunctive_filter(spark, people, conditions, ids):
    assert sorted(r.id for r in L.conjunctive_filter(spark.table("people"), conditions).collect()) == ids


def test_conjunctive_filter_other_separator(spark, people):
    assert L.conjunctive_filter(spark.table("people"), "id=2;part=y", sep=";").count() == 2


def test_doubled_quotes(spark):
    df = spark.createDataFrame([("O'Brien",), ("NEW YORK",), ("a,b",)], "n string")
    assert L.conjunctive_filter(df, "n='O''Brien'").count() == 1
    assert L.parse_id_list("NEW YORK , 'a,b','O''Brien',,") == ["NEW YORK", "a,b", "O'Brien"]
    assert L.id_list_filter(df, "n", "NEW YORK, 'a,b'").count() == 2
    with pytest.raises(ValueError):
        L.parse_id_list("a'b")


@pytest.mark.parametrize("ids", [1, 1001])
def test_columns_stay_in_order(spark, ids):
    df = spark.range(2_000).selectExpr("id % 7 as a", "id as b")
    got = L.id_list_filter(df, "b", [str(i) for i in range(ids)])
    assert got.columns == ["a", "b"] and rows(got) == sorted([(i % 7, i) for i in range(ids)], key=repr)


def test_missing_tables_are_named(spark, people, caplog):
    TB.scan_tables(spark, TB.TableSpec(tables=("people", "no_such_people"), columns=("id",)))
    assert "no_such_people" in caplog.text


def test_id_lists(spark, people, monkeypatch):
    df = spark.table("people")
    assert L.parse_id_list("'1', 2") == ["1", "2"]
    for everything in ("ALL", "", " ", None):
        assert L.id_list_filter(df, "id", everything).count() == 3
    assert L.id_list_filter(df, "id", "1,7").count() == 1
    monkeypatch.setattr(L, "SHORT_LIST", 1)
    assert rows(L.id_list_filter(df, "id", ["1", "2", "2"]), "id") == [(1,), (2,), (2,)]


def test_select_and_rename(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, `B c` int, d int")
    assert N.lenient_select(df, ["x", "y", "D", "a"]).columns == ["D", "a"]
    assert N.rename_columns(df, {"a": "z", "nope": "q"}).columns == ["z", "B c", "d"]
    assert N.translate_names(df, {" ": "_"}).columns == ["a", "b_c", "d"]
    with pytest.raises(ValueError):
        N.translate_names(df.toDF("a", "A", "d"), {})


def test_conform(spark):
    df = spark.createDataFrame([("1", "x", "2024-01-01", 5)], "A string, b string, c string, extra int")
    schema = columns("c date, a integer, b integer, new decimal(9,2)")
    got = N.conform_schema(df, schema)
    assert got.schema == schema
    assert rows(got) == [(date(2024, 1, 1), 1, None, None)]
    cast = N.cast_to_schema(df, columns("c date, b integer, new string"))
    assert cast.columns == df.columns and rows(cast) == [("1", None, date(2024, 1, 1), 5)]


def test_align(spark):
    a = spark.createDataFrame([(1, "x")], "id int, b string")
    b = spark.createDataFrame([(2, D("1.50"))], "id int, a decimal(5,2)")
    first, second = N.align_frames([a, b])
    assert first.columns == second.columns == ["a", "b", "id"]
    assert first.schema["a"].dataType == b.schema["a"].dataType
    assert rows(N.align_union([a, b])) == [(D("1.50"), None, 2), (None, "x", 1)]
    assert N.align_frames([]) == []


def test_drift(spark):
    df = spark.createDataFrame([], "a int, b string, c date")
    schema = columns("a integer, b integer, d string")
    assert rows(N.schema_drift(df, schema)) == [("b", "int", "string"), ("c", None, "date"), ("d", "string", None)]
    assert N.schema_drift(df, df.schema).isEmpty()
    assert N.matches_schema(df, df.schema) and not N.matches_schema(df, schema)
    assert N.missing_names(["a", "z"], df.columns) == ["z"]
    assert N.schema_types(schema)["d"].simpleString() == "string"


def test_dates(spark):
    df = spark.createDataFrame([("2024-01-02", "2024-01-02 10:00:00"), ("02/01/2024", None), (None, None)], "a string, t string")
    got = N.to_date_columns(df.withColumn("t", F.col("t").cast("timestamp")), ["a", "t"])
    assert rows(got) == [(None, None), (None, None), (date(2024, 1, 2), date(2024, 1, 2))]


def test_contracts(spark, sf):
    assert len(CLAIMS) == 60 and len(EXCHANGE_RATE) == 5
    assert N.schema_drift(N.conform_schema(B.claims(spark, sf), CLAIMS), CLAIMS).isEmpty()
    assert N.schema_drift(B.exchange_rates(spark, sf), EXCHANGE_RATE).isEmpty()


def test_settings(spark):
    initial = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    apply_settings(spark, 10 << 30, {"spark.sql.adaptive.skewJoin.enabled": "false"})
    assert spark.conf.get("spark.sql.parquet.datetimeRebaseModeInRead") == "CORRECTED"
    assert spark.conf.get(initial) == "80"
    assert spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == "false"
    spark.conf.unset(initial)
    apply_settings(spark)
    assert shuffle_partitions(100 << 40, 4000) == 50_000
    assert shuffle_partitions(1, 4) == 8


# --- contracts, catalog tables, staged writes ---


def test_contract_is_checked_while_the_plan_is_built(spark, people):
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))
    with pytest.raises(ColumnNotFoundError, match="people.*nobody") as lacking:
        TB.scan_table(spark, TB.TableSpec(name="people", columns=("id", "NAME", "nobody")))
    assert lacking.value.columns == ("nobody",)
    retyped = columns("id long, name string")
    assert TB.scan_table(spark, TB.TableSpec(name="people", schema=retyped)).columns == ["id", "name"]
    with pytest.raises(InvalidTableSchemaError) as broken:
        TB.scan_table(spark, TB.TableSpec(name="people", schema=retyped, contract="types"))
    assert broken.value.differences == (("id", "bigint", "int"),)
    TB.scan_table(spark, TB.TableSpec(name="people", schema=columns("ID integer, name string"), contract="types"))
    with pytest.raises(InvalidTableSchemaError, match="part: not in the contract, found string"):
        TB.scan_table(spark, TB.TableSpec(name="people", schema=people, contract="exact"))
    with pytest.raises(ColumnNotFoundError):
        TB.scan_table(spark, TB.TableSpec(name="people", schema=columns("id integer, gone string"), contract="exact"))
    with pytest.raises(ValueError):
        TB.TableSpec(name="people", contract="loose")
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) == jobs


def test_scan_without_a_probe(spark, people):
    empty = TB.TableSpec(name="people", schema=people, predicate="id > 9")
    df = TB.scan_table(spark, empty, force=True, probe=False)
    with pytest.raises(TB.TableNotFoundError, match="people"):
        TB.require_rows(people=df)
    TB.require_rows(people=TB.scan_table(spark, TB.TableSpec(name="people"), force=True, probe=False))
    with pytest.raises(TB.TableNotFoundError):
        TB.scan_table(spark, TB.TableSpec(name="nobody"), force=True, probe=False)


def test_registered_table_prunes_partitions(spark, tmp_path, capsys):
    path = str(tmp_path / "it's")
    df = spark.range(60).selectExpr("id", "id % 3 AS a", "concat('x', id % 2) AS b")
    IO.write_frame(df, path, partition_by=["a", "b"])
    assert TB.register_table(spark, path, "registered", "spelltide_tests", ["a", "b"]) == "`spelltide_tests`.`registered`"
    assert N.table_types(spark, "spelltide_tests.registered") == {"id": "bigint", "a": "int", "b": "string"}
    spec = TB.TableSpec(name="registered", database="spelltide_tests", predicate="a = 1,b = 'x1',id > 10", columns=("id",))
    scan = TB.scan_table(spark, spec, force=True)
    assert rows(scan) == [(i,) for i in range(60) if i % 3 == 1 and i % 2 and i > 10]
    plan = plan_of(scan, capsys)
    assert "(a#" in plan.split("PartitionFilters:")[1].split("\n")[0] and "(b#" in plan.split("PartitionFilters:")[1].split("\n")[0]
    assert "ReadSchema: struct<id:bigint>" in plan
    assert all("/a=1/b=x1/" in f for f in scan.inputFiles())
    IO.write_frame(spark.range(2), str(tmp_path / "plain"))
    TB.register_table(spark, str(tmp_path / "plain"), "registered", "spelltide_tests")
    assert spark.table("spelltide_tests.registered").count() == 2 and spark.read.parquet(path).count() == 60


def jobs_of(spark, run):
    """How many jobs a call starts."""
    context, group = spark.sparkContext, f"g{id(run)}"
    context.setJobGroup(group, group)
    try:
        run()
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    return len(context.statusTracker().getJobIdsForGroup(group))


def leftovers(folder):
    return [p.name for p in folder.iterdir() if p.name.startswith("_staging")]


def test_write_is_one_job_and_keeps_the_target(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.range(20).selectExpr("id", "id % 2 AS p")
    assert jobs_of(spark, lambda: IO.write_frame(df, path)) == 1
    before = sorted(p.name for p in (tmp_path / "out").iterdir())
    assert IO.write_frame(df.where("id < 0"), path) == 0
    broken = df.select(F.when(F.col("id") < 19, F.col("id")).otherwise(F.raise_error(F.lit("no"))).cast("long").alias("id"), "p")
    for mode in ("overwrite", "append"):
        with pytest.raises(Exception, match="no"):
            IO.write_frame(broken, path, mode=mode)

    def refuse(kept, count):
        assert (kept.count(), count, set(kept.columns)) == (20, 20, {"id", "p"})
        raise ValueError("not this one")

    with pytest.raises(ValueError, match="not this one"):
        IO.write_frame(df, path, check=refuse)
    assert sorted(p.name for p in (tmp_path / "out").iterdir()) == before and not leftovers(tmp_path)
    assert IO.write_frame(df.where("id < 0"), path, skip_empty=False) == 0
    assert spark.read.parquet(path).count() == 0 and not leftovers(tmp_path)


def test_a_frame_may_overwrite_what_it_reads(spark, tmp_path):
    path = str(tmp_path / "self")
    IO.write_frame(spark.range(5), path)
    assert IO.write_frame(spark.read.parquet(path).where("id > 2"), path + "/") == 2
    assert rows(spark.read.parquet(path)) == [(3,), (4,)]


@pytest.mark.parametrize("by_setting", [True, False])
def test_dynamic_overwrite_leaves_other_partitions(spark, tmp_path, by_setting):
    path = str(tmp_path / "d")
    df = spark.range(12).selectExpr("id", "id % 3 AS a", "id % 2 AS b")
    IO.write_frame(df, path, partition_by=["a", "b"])
    kept = {p: p.stat().st_mtime_ns for p in (tmp_path / "d").rglob("*.parquet") if "a=1" not in str(p)}
    options = {} if by_setting else {"partitionOverwriteMode": "dynamic"}
    if by_setting:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        new = spark.createDataFrame([(100, 1, 0), (101, 7, 1)], "id long, a long, b long")
        assert IO.write_frame(new, path, partition_by=["a", "b"], **options) == 2
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    want = [r for r in rows(df) if not (r[1] == 1 and r[2] == 0)] + [(100, 1, 0), (101, 7, 1)]
    assert rows(spark.read.parquet(path), "id", "a", "b") == sorted(want, key=repr)
    assert {p: p.stat().st_mtime_ns for p in kept if p.exists()} == kept and not leftovers(tmp_path)


def test_failed_publishing_is_undone(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "u")
    df = spark.range(6).selectExpr("id", "id % 3 AS a")
    IO.write_frame(df, path, partition_by=["a"])
    move, moved = staging._Moves.move, []

    def once(self, source, target):
        if len(moved) == 3:
            raise OSError("store is gone")
        moved.append(source)
        move(self, source, target)

    monkeypatch.setattr(staging._Moves, "move", once)
    for options in ({"partitionOverwriteMode": "dynamic"}, {"mode": "append"}):
        moved.clear()
        with pytest.raises(OSError, match="store is gone"):
            IO.write_frame(df.repartition(4).selectExpr("id + 100 AS id", "a"), path, partition_by=["a"], **options)
        assert rows(spark.read.parquet(path)) == rows(df) and not leftovers(tmp_path)


def test_direct_and_ignored_writes(spark, tmp_path):
    path = str(tmp_path / "n")
    assert IO.write_frame(spark.range(0), path, direct=True) == 0 and not (tmp_path / "n").exists()
    assert IO.write_frame(spark.range(3), path, direct=True) == 3
    assert IO.write_frame(spark.range(9), path, mode="ignore") == 0
    assert IO.write_frame(spark.range(9), str(tmp_path / "m"), mode="ignore") == 9
    assert spark.read.parquet(path).count() == 3


def test_scratch_scope_removes_what_it_staged(spark):
    with pytest.raises(ValueError, match="stop"):
        with staging.scratch_scope(spark):
            df = staging.staged(spark.range(5), "scoped")
            folder = Path(df.inputFiles()[0].removeprefix("file:")).parent
            assert df.count() == 5 and folder.exists()
            raise ValueError("stop")
    assert not folder.exists()
    outside = staging.staged(spark.range(5), "unscoped")
    assert outside.count() == 5


@pytest.mark.parametrize(
    "target, start", [("out", "_staging-out-"), ("/out/", "/_staging-out-"), ("a/b", "a/_staging-b-"), ("s3a://bucket/x/y/", "s3a://bucket/x/_staging-y-"), ("s3a://bucket/x", "s3a://bucket/_staging-x-")]
)
def test_staging_lies_beside_the_target(target, start):
    assert staging.staging_path(target).startswith(start)


@pytest.mark.parametrize("target", ["s3a://bucket", "s3a://bucket/", "/", ""])
def test_the_root_of_a_store_is_no_target(target):
    with pytest.raises(ValueError, match="root"):
        staging.staging_path(target)
