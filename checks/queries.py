"""One query per operator, over the test tables or insurance inputs derived from them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, TimestampType

from spelltide.functions import claims as C
from spelltide.functions import coverage as V
from spelltide.functions import periods as P
from spelltide.operators import conform as N
from spelltide.operators import filters as L
from spelltide.operators import fx as X
from spelltide.operators import quality as Q
from spelltide.operators import residence as R
from spelltide.operators import spells as S
from spelltide.operators import triangles as T
from spelltide.plans import bridge as B
from spelltide.plans import membership as M
from spelltide.schemas import columns
from spelltide.sources import files as IO
from spelltide.sources import tables as TB

AS_OF = "2001-12-31"
TYPED: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def portable(df: DataFrame) -> DataFrame:
    """Dates, times and decimals as text at full scale, so both engines hash the same values."""

    def column(field):
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (DateType, TimestampType, DecimalType)):
            c = c.cast("string")
        return c.alias(field.name)

    return df.select(*[column(f) for f in df.schema])


def query(build):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return portable(build(spark, sf_dir))

    TYPED[build.__name__] = build
    QUERIES[build.__name__] = run
    return build


def view(spark, sf_dir, name, suffix="all", where="true") -> str:
    """Register a test table, or some of its rows, as a temporary view."""
    label = f"spelltide_{name}_{suffix}"
    B.table(spark, sf_dir, name).where(where).createOrReplaceTempView(label)
    return label


def stored(spark, df, label, **options) -> str:
    """Write a frame to a new folder and return its path."""
    path = IO.scratch_path(spark, label)
    IO.write_frame(df, path, **options)
    return path


# --- scans ---


@query
def scan_projected(spark, sf):
    spec = TB.TableSpec(
        name=view(spark, sf, "orders"),
        columns=("o_orderkey", "o_custkey", "o_totalprice"),
        predicate="o_orderstatus = 'F',o_orderpriority in ('1-URGENT','2-HIGH')",
    )
    return TB.scan_table(spark, spec, force=True)


@query
def scan_partition_pruned(spark, sf):
    orders = B.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus", "o_orderpriority")
    root = stored(spark, orders, "orders", partition_by=["o_orderstatus", "o_orderpriority"], cluster=True)
    return TB.scan_path(spark, root, "o_orderstatus=F and o_orderpriority=2-HIGH")


@query
def scan_catalog_partitions(spark, sf):
    """A catalog table with partitions, of which the predicate leaves some; the contract names and types its columns."""
    orders = B.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority", "o_orderstatus")
    path = stored(spark, orders, "catalog-orders", partition_by=["o_orderstatus", "o_orderpriority"], cluster=True)
    TB.register_table(spark, path, "orders_by_status", "spelltide_checks", ["o_orderstatus", "o_orderpriority"])
    schema = columns("o_orderkey long, o_custkey long, o_totalprice double, o_orderstatus string, o_orderpriority string")
    spec = TB.TableSpec(
        name="orders_by_status", database="spelltide_checks", schema=schema, contract="exact",
        predicate="o_orderstatus = 'F',o_orderpriority in ('1-URGENT','2-HIGH'),o_totalprice > 1000",
    )
    return TB.scan_table(spark, spec, force=True)


@query
def scan_distinct(spark, sf):
    spec = TB.TableSpec(name=view(spark, sf, "orders"), columns=("o_custkey", "o_orderpriority"), distinct=True)
    return TB.scan_table(spark, spec)


@query
def scan_union_tables(spark, sf):
    tables = (
        view(spark, sf, "orders", "open", "o_orderstatus <> 'F'"),
        view(spark, sf, "orders", "done", "o_orderstatus = 'F' or o_totalprice > 100000"),
    )
    spec = TB.TableSpec(tables=tables, columns=("o_orderkey", "o_orderstatus", "o_totalprice"), distinct=True)
    return TB.scan_tables(spark, spec)


@query
def scan_empty_fallback(spark, sf):
    schema = columns("c_custkey long, c_name string, c_nationkey integer")
    missing = TB.scan_table(spark, TB.TableSpec(name="spelltide_no_such_table", schema=schema))
    return missing.unionByName(TB.scan_table(spark, TB.TableSpec(name=view(spark, sf, "customer"), schema=schema)))


@query
def view_scan_filtered(spark, sf):
    B.table(spark, sf, "customer").where("c_acctbal is not null").createOrReplaceTempView("spelltide_customer_view")
    return TB.scan_view(
        spark, "spelltide_customer_view", "c_nationkey >= 5,c_acctbal > 0", ["c_nationkey", "c_mktsegment"], distinct=True
    )


@query
def file_scan(spark, sf):
    schema = "l_orderkey bigint, l_partkey bigint, l_quantity double, l_returnflag string"
    return IO.read_files(spark, f"{sf}/lineitem.parquet", "parquet", schema)


@query
def file_scan_csv(spark, sf):
    path = stored(spark, B.table(spark, sf, "customer"), "customer-csv", file_format="csv", header="true")
    return IO.read_files(spark, path, "txt", B.table(spark, sf, "customer").schema)


@query
def file_scan_csv_inferred(spark, sf):
    orders = B.table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    path = stored(spark, orders, "orders-csv", file_format="csv", header="true")
    return IO.read_files(spark, path, "csv", options={"inferSchema": "true"}).withColumn(
        "o_orderkey", F.col("o_orderkey").cast("bigint")
    )


@query
def file_scan_json(spark, sf):
    path = stored(spark, B.table(spark, sf, "conversations"), "conversations-json", file_format="json")
    return IO.read_files(spark, path, "json", B.table(spark, sf, "conversations").schema)


@query
def file_scan_many(spark, sf):
    parts = B.table(spark, sf, "part").select("p_partkey", "p_brand", "p_size")
    paths = [stored(spark, parts.where(c), "part") for c in ("p_size <= 20", "p_size > 20")]
    return IO.read_files(spark, paths)


@query
def sql_passthrough(spark, sf):
    text = """
        SELECT n.n_name, count(*) AS customers, max(c.c_acctbal) AS top_balance
        FROM {customer} c JOIN {nation} n ON c.c_nationkey = n.n_nationkey
        GROUP BY n.n_name
    """
    return TB.run_sql(spark, text, customer=B.table(spark, sf, "customer"), nation=B.table(spark, sf, "nation"))


@query
def sql_clean_names(spark, sf):
    text = "SELECT o_orderstatus AS `order status`, count(*) AS `order count` FROM {orders} GROUP BY o_orderstatus"
    return TB.run_sql_clean(spark, text, orders=B.table(spark, sf, "orders"))


# --- sinks ---


@query
def write_roundtrip_partitioned(spark, sf):
    lines = B.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_returnflag")
    return spark.read.parquet(stored(spark, lines, "lineitem", partition_by=["l_returnflag", ""], cluster=True))


@query
def partition_mirror(spark, sf):
    orders = B.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return spark.read.parquet(stored(spark, orders, "mirror", partition_by=["o_orderstatus"], mirror="o_orderstatus"))


@query
def write_dynamic_overwrite(spark, sf):
    """Orders by status, then the finished ones again with their priority left out: other partitions stay."""
    orders = B.table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice", "o_orderstatus")
    path = stored(spark, orders, "by-status", partition_by=["o_orderstatus"], cluster=True)
    again = orders.where("o_orderstatus = 'F' and o_totalprice > 1000").withColumn("o_orderpriority", F.lit("done"))
    IO.write_frame(again, path, partition_by=["o_orderstatus"], cluster=True, partitionOverwriteMode="dynamic")
    return spark.read.parquet(path)


@query
def multi_report_sink(spark, sf):
    orders = B.table(spark, sf, "orders")

    def count_by(column):
        return orders.groupBy(F.col(column).alias("key")).agg(F.count("*").alias("orders"))

    reports = {
        "number of orders by order status": count_by("o_orderstatus"),
        "orders by priority": count_by("o_orderpriority"),
    }
    paths = IO.write_reports(reports, IO.scratch_path(spark, "reports"))
    frames = [
        spark.read.parquet(path).withColumn("report", F.lit(path.rsplit("/", 1)[1])) for path in paths.values()
    ]
    return frames[0].unionByName(frames[1])


# --- filters and conformance ---


@query
def conjunctive_filter(spark, sf):
    orders = B.table(spark, sf, "orders").drop("o_orderdate")
    return L.conjunctive_filter(orders, "o_orderstatus='F',o_totalprice>=1000,o_orderpriority!='5-LOW'")


@query
def id_list_filter(spark, sf):
    lines = B.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag")
    return L.id_list_filter(lines, "l_returnflag", "'A', 'R'")


@query
def id_list_filter_long(spark, sf):
    lines = B.table(spark, sf, "lineitem").select("l_returnflag", "l_linenumber", "l_orderkey")
    return L.id_list_filter(lines, "l_orderkey", [str(i) for i in range(0, 6_000, 4)])


@query
def lenient_select(spark, sf):
    return N.lenient_select(B.table(spark, sf, "part"), ["P_PARTKEY", "no_such", "nor_this", "p_brand", "p_size"]).withColumnRenamed(
        "P_PARTKEY", "p_partkey"
    )


@query
def rename_columns(spark, sf):
    return N.rename_columns(
        B.table(spark, sf, "supplier"), {"s_suppkey": "supplier_id", "s_name": "supplier_name", "s_phone": "phone"}
    )


@query
def translate_names(spark, sf):
    customer = B.table(spark, sf, "customer").withColumnsRenamed({"c_name": "C Name", "c_acctbal": "c-AcctBal"})
    return N.translate_names(customer, {" ": "_", "-": "_"})


@query
def conform_schema(spark, sf):
    schema = columns(
        "l_orderkey string, l_quantity integer, l_shipdate date, l_tax decimal(4,2), l_returnflag integer, l_comment string"
    )
    return N.conform_schema(B.table(spark, sf, "lineitem"), schema)


@query
def cast_to_schema(spark, sf):
    return N.cast_to_schema(
        B.table(spark, sf, "orders"), columns("o_orderkey string, o_orderdate date, o_comment string")
    )


@query
def align_union(spark, sf):
    customer = B.table(spark, sf, "customer").selectExpr("c_custkey AS id", "c_name AS name", "c_mktsegment AS segment")
    supplier = B.table(spark, sf, "supplier").selectExpr("s_suppkey AS id", "s_name AS name", "s_acctbal AS balance")
    return N.align_union([customer, supplier])


@query
def to_date_columns(spark, sf):
    pattern = F.when(F.col("o_orderstatus") == "P", F.date_format("o_orderdate", "dd/MM/yyyy"))
    text = pattern.otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    return N.to_date_columns(B.table(spark, sf, "orders").select("o_orderkey", text.alias("as_text"), "o_orderdate"), ["as_text", "o_orderdate"])


@query
def relative_period_filter(spark, sf):
    claims = B.claims(spark, sf).select("claimlineid", "servicedate")
    return P.relative_period_filter(claims, "servicedate", "1998-06-15", months=18, years=1)


# --- claims and rates ---


@query
def fully_insured_filter(spark, sf):
    return C.fully_insured(B.claims(spark, sf)).select("claimlineid", "claimsriskarrangement")


@query
def date_order_filter(spark, sf):
    claims = C.dates_in_order(B.claims(spark, sf), "servicedate", "claiminvoicereceiveddate")
    return claims.select("claimlineid", "servicedate", "claiminvoicereceiveddate")


@query
def book_of_business(spark, sf):
    return C.book_of_business(B.claims(spark, sf)).select("claimlineid", "sourcesystemid", "legalentityid", "book_of_business")


@query
def period_labels(spark, sf):
    return P.period_labels(B.claims(spark, sf).select("claimlineid", "servicedate"), "servicedate")


@query
def lag_buckets(spark, sf):
    claims = B.claims(spark, sf).select("claimlineid", "servicedate", "claiminvoicereceiveddate", "paymentdate")
    return P.lag_buckets(claims, "claiminvoicereceiveddate", "paymentdate").select(
        "claimlineid", "paid_lag_months", "paid_lag_quarters", "paid_lag_years"
    )


@query
def fx_preferred_rate(spark, sf):
    return X.fx_preferred_rate(B.exchange_rates(spark, sf))


@query
def fx_wide(spark, sf):
    return X.fx_wide(B.exchange_rates(spark, sf))


@query
def fx_convert(spark, sf):
    claims = X.fx_convert(B.claims(spark, sf), B.exchange_rates(spark, sf), "servicedate")
    return claims.select(
        "claimlineid", "productcurrencycode", "productcurrencypaymentamount", "amount_usd", "amount_chf", "amount_gbp",
        "amount_euro", "book_of_business",
    )


# --- triangles ---


def _one_leg(spark, sf, grains):
    legs = [leg for leg in T.report_legs("Incurred to Received") if leg.metric == "Productcurrency"]
    return T.development_triangle(B.claims(spark, sf), B.exchange_rates(spark, sf), legs, grains)


@query
def triangle_year(spark, sf):
    return _one_leg(spark, sf, ("YEAR",))


@query
def triangle_quarter(spark, sf):
    return _one_leg(spark, sf, ("QUARTER",))


@query
def triangle_month(spark, sf):
    return _one_leg(spark, sf, ("MONTH",))


@query
def triangle_all_grains(spark, sf):
    return _one_leg(spark, sf, T.GRAINS)


def _pair(spark, sf, report):
    return T.development_triangle(B.claims(spark, sf), B.exchange_rates(spark, sf), T.report_legs(report))


@query
def triangle_incurred_received(spark, sf):
    return _pair(spark, sf, "Incurred to Received")


@query
def triangle_incurred_paid(spark, sf):
    return _pair(spark, sf, "Incurred to Paid")


@query
def triangle_received_paid(spark, sf):
    return _pair(spark, sf, "Received to Paid")


@query
def triangle_report(spark, sf):
    return T.triangle_report(B.claims(spark, sf), B.exchange_rates(spark, sf))


@query
def triangle_report_as_written(spark, sf):
    return T.triangle_report(B.claims(spark, sf), B.exchange_rates(spark, sf), as_written=True)


# --- spells ---


@query
def elig_source_filtered(spark, sf):
    return S.eligibility_source(B.eligibility(spark, sf))


@query
def cover_override(spark, sf):
    return S.cover_override(B.eligibility(spark, sf))


@query
def month_expand(spark, sf):
    return S.month_expand(S.covered(B.eligibility(spark, sf)), cut_off=False).select("sysbatchdttm", V.MONTH)


@query
def month_cutoff(spark, sf):
    months = S.month_expand(B.eligibility(spark, sf), cut_off=False)
    return S.month_cutoff(months, "1998-03-20").select("sysbatchdttm", V.MONTH)


@query
def month_eligible_flag(spark, sf):
    months = S.month_expand(B.eligibility(spark, sf), AS_OF)
    return V.month_eligible_flag(months).select("sysbatchdttm", V.MONTH, "is_eligible")


@query
def cover_pivot(spark, sf):
    return S.cover_pivot(S.cover_override(B.eligibility(spark, sf)), as_of=AS_OF).drop("eligible")


@query
def cover_pivot_fixed(spark, sf):
    return S.cover_pivot(S.eligibility_source(B.eligibility(spark, sf)), ["MED"], cut_off=False).drop("eligible")


@query
def eligible_flag(spark, sf):
    months = S.cover_pivot(S.cover_override(B.eligibility(spark, sf)), ["DEN", "MED", "VIS"], AS_OF, absent=None)
    return V.eligible_flag(months.drop("eligible"), ["DEN", "MED"]).select(*S.SPELL, V.MONTH, "eligible")


@query
def spell_snapshot(spark, sf):
    return S.spell_snapshot(S.cover_override(B.eligibility(spark, sf)))


@query
def spell_snapshot_join(spark, sf):
    rows = S.cover_override(B.eligibility(spark, sf))
    months = S.cover_pivot(rows, ["DEN", "MED", "VIS"], AS_OF)
    return S.spell_snapshot_join(months, S.spell_snapshot(rows)).select(
        *S.SPELL, V.MONTH, "eligible", "customerid", "lineofcovercode", "sysbatchdttm"
    )


@query
def membership_months(spark, sf):
    return M.membership_months(B.eligibility(spark, sf), as_of=AS_OF)


@query
def spell_snapshot_late(spark, sf):
    return S.spell_snapshot(S.cover_override(B.placed_eligibility(spark, sf)))


@query
def membership_months_late(spark, sf):
    return M.membership_months(B.placed_eligibility(spark, sf), as_of=AS_OF)


@query
def membership_report_late(spark, sf):
    return M.membership_report(B.placed_eligibility(spark, sf), B.residences(spark, sf), as_of=AS_OF)


# --- residence and coverage ---


@query
def residence_current(spark, sf):
    return R.residence_current(B.residences(spark, sf))


@query
def open_interval_defaults(spark, sf):
    return R.open_interval_defaults(B.residences(spark, sf))


@query
def residence_overlap_join(spark, sf):
    spells = B.eligibility(spark, sf).select(*S.SPELL, "customerid", "sourcesystemid", "sysbatchdttm")
    return R.residence_overlap_join(spells, R.residence_lookup(B.residences(spark, sf))).select(
        "memberid", "sysbatchdttm", R.TYPE, R.CODE, R.START, R.END
    )


@query
def membership_with_residence(spark, sf):
    months = M.membership_with_residence(B.eligibility(spark, sf), B.residences(spark, sf), as_of=AS_OF)
    return months.select(*S.SPELL, V.MONTH, "eligible", "customerid", "sourcesystemid", R.TYPE, R.CODE, R.START, R.END)


@query
def best_spell_per_month(spark, sf):
    months = M.membership_with_residence(B.eligibility(spark, sf), B.residences(spark, sf), as_of=AS_OF)
    return S.best_spell_per_month(months).select(*S.SPELL, V.MONTH, "eligible", "DEN", "MED", "VIS", R.CODE)


@query
def coverage_measures(spark, sf):
    months = S.cover_pivot(S.cover_override(B.eligibility(spark, sf)), ["DEN", "MED", "VIS"], AS_OF)
    return V.coverage_measures(months).drop("DEN", "MED", "VIS")


@query
def membership_columns(spark, sf):
    months = M.membership_months(B.eligibility(spark, sf), ["DEN", "MED", "VIS"], AS_OF)
    return M.order_columns(V.coverage_measures(months), ["DEN", "MED", "VIS"])


@query
def membership_report(spark, sf):
    return M.membership_report(B.eligibility(spark, sf), B.residences(spark, sf), as_of=AS_OF)


@query
def membership_medical(spark, sf):
    return M.membership_medical(B.eligibility(spark, sf))


@query
def membership_medical_as_of(spark, sf):
    rows = B.eligibility(spark, sf)
    open_ended = F.when(F.col("sysbatchdttm") % 97 == 0, F.lit("9999-12-31").cast("date")).otherwise(F.col(V.TO))
    return M.membership_medical(rows.withColumn(V.TO, open_ended), AS_OF)


# --- quality ---


def _rule(df, rule):
    return Q.check_rules(df, [rule])


@query
def dq_not_null(spark, sf):
    return _rule(B.eligibility(spark, sf), Q.not_null(["memberid", "lineofcovercode"], "cover_present"))


@query
def dq_in_set(spark, sf):
    return _rule(B.eligibility(spark, sf), Q.in_set("lineofcovercode", ["MED", "DEN"], "cover_known"))


@query
def dq_regex(spark, sf):
    return _rule(B.eligibility(spark, sf), Q.matches("lineofcovercode", "^[A-Z]{3}$", "cover_format"))


@query
def dq_no_nan(spark, sf):
    lines = B.table(spark, sf, "lineitem").select(
        F.when(F.col("l_tax") == 0, F.lit(float("nan"))).otherwise(F.col("l_tax")).alias("tax"),
        F.when(F.col("l_discount") == 0, F.lit(float("nan"))).otherwise(F.col("l_discount")).alias("discount"),
    )
    return _rule(lines, Q.no_nan(["tax", "discount"], "rates_are_numbers"))


@query
def dq_column_match(spark, sf):
    return _rule(B.claims(spark, sf), Q.columns_match("paymentcurrencycode", "productcurrencycode", "one_currency"))


@query
def dq_period_format(spark, sf):
    # Months of unfinished orders are written with a dash, which the rule must catch.
    month = F.when(F.col("o_orderstatus") == "P", F.date_format("o_orderdate", "yyyy-MM")).otherwise(
        F.date_format("o_orderdate", "yyyyMM")
    )
    kind = F.when(F.col("o_orderpriority") == "1-URGENT", "YEAR").when(F.col("o_orderpriority") == "2-HIGH", "QUARTER")
    periods = B.table(spark, sf, "orders").select(
        month.alias("incurred_period"), kind.otherwise("MONTH").alias("incurred_period_type")
    )
    return _rule(periods, Q.period_format())


@query
def dq_lag_sanity(spark, sf):
    # Uncapped lags, negative ones among them.
    lag = P.month_number(F.col("claiminvoicereceiveddate")) - P.month_number(F.col("servicedate"))
    claims = B.claims(spark, sf).select(lag.alias("paid_lag_value"), F.lit("MONTH").alias("incurred_period_type"))
    return _rule(claims, Q.lag_sanity())


@query
def dq_lag_without_period_type(spark, sf):
    lag = P.month_number(F.col("claiminvoicereceiveddate")) - P.month_number(F.col("servicedate"))
    return _rule(B.claims(spark, sf).select(lag.alias("paid_lag_value")), Q.lag_sanity())


@query
def dq_key_uniqueness_any_case(spark, sf):
    return Q.key_uniqueness(X.fx_preferred_rate(B.exchange_rates(spark, sf)), ("BaseCurrencyCode", "EXCHANGERATEDATE"))


@query
def dq_fx_missing(spark, sf):
    claims = X.fx_convert(B.claims(spark, sf), B.exchange_rates(spark, sf), "servicedate")
    amounts = ("amount_usd", "amount_gbp", "amount_euro", "amount_chf")
    return _rule(claims, Q.fx_present("productcurrencypaymentamount", amounts))


@query
def dq_fx_key_uniqueness(spark, sf):
    return Q.key_uniqueness(X.fx_preferred_rate(B.exchange_rates(spark, sf)))


@query
def dq_row_explosion(spark, sf):
    claims, rates = B.claims(spark, sf), X.fx_preferred_rate(B.exchange_rates(spark, sf))
    on = (F.col("productcurrencycode") == F.col("basecurrencycode")) & (F.col("servicedate") == F.col("exchangeratedate"))
    counts = Q.RowCounts()
    joined = counts.after(counts.before(claims).join(rates, on, "left"))
    stored(spark, joined.select("claimlineid", "newcurrencycode", "exchangerate"), "joined")
    return counts.result()


@query
def dq_fx_suite(spark, sf):
    claims, rates = B.claims(spark, sf), B.exchange_rates(spark, sf)
    counts = Q.RowCounts()
    converted = counts.after(X.fx_convert(counts.before(claims), rates, "servicedate"))
    stored(spark, converted.select("claimlineid", "amount_usd"), "converted")
    return Q.fx_suite(counts, X.fx_wide(rates))


@query
def dq_triangle_suite(spark, sf):
    report = T.triangle_report(B.claims(spark, sf), B.exchange_rates(spark, sf))
    return Q.triangle_suite(N.mirror_column(report, "triangle_report_type"))


@query
def dq_thresholds(spark, sf):
    currency = Q.in_set("productcurrencycode", ["USD", "EUR", "GBP", "CHF"], "currency_known")
    day = Q.not_null(["servicedate", "paymentdate"], "dates_present")
    checks = [
        (currency, Q.Threshold(share=0.35)),
        (currency, Q.Threshold(share=0.05, severity="warning")),
        (currency, Q.Threshold(rows=10)),
        (day, Q.Threshold()),
        (Q.not_null(["no_such_column"], "needs_a_missing_column"), Q.Threshold(rows=1_000_000, share=1.0)),
    ]
    return Q.check_thresholds(B.claims(spark, sf), checks)


@query
def dq_missing_column(spark, sf):
    rules = [
        Q.not_null(["memberid", "no_such_column"], "needs_a_missing_column"),
        Q.in_set("productcurrencycode", ["USD", "EUR", "GBP", "CHF"], "currency_known"),
    ]
    return Q.check_rules(B.claims(spark, sf), rules)
