"""The SQL each query is compared with, written for DuckDB over the same test tables."""

from __future__ import annotations

AS_OF_MONTH = "DATE '2001-12-01'"

CLAIMS = """
b_claims AS (
    SELECT CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) || '-' || CAST(l.l_partkey AS VARCHAR) AS claimlineid,
           CAST(o.o_custkey AS VARCHAR) AS memberid,
           CAST(o.o_orderdate AS DATE) AS servicedate,
           CAST(l.l_shipdate AS DATE) AS claiminvoicereceiveddate,
           CAST(l.l_shipdate AS DATE) + CAST(l.l_quantity AS INTEGER) AS paymentdate,
           CASE l.l_suppkey % 5 WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' WHEN 2 THEN 'GBP' WHEN 3 THEN 'CHF' ELSE 'JPY' END AS productcurrencycode,
           CASE o.o_custkey % 5 WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' WHEN 2 THEN 'GBP' WHEN 3 THEN 'CHF' ELSE 'JPY' END AS paymentcurrencycode,
           CAST(l.l_extendedprice AS DECIMAL(17,2)) AS productcurrencypaymentamount,
           CAST(l.l_quantity * 100 AS DECIMAL(17,2)) AS paymentcurrencypaymentamount,
           CASE l.l_suppkey % 8 WHEN 0 THEN '82440' WHEN 1 THEN '82813' WHEN 2 THEN '82810' WHEN 3 THEN '53154'
                WHEN 4 THEN '82811' WHEN 5 THEN '53134' WHEN 6 THEN '82812' ELSE '99999' END AS legalentityid,
           'LE-' || CAST(l.l_suppkey % 8 AS VARCHAR) AS legalentityname,
           CAST(l.l_suppkey % 10 AS VARCHAR) AS sourcesystemid,
           CASE l.l_returnflag WHEN 'A' THEN 'Fully Insured' WHEN 'N' THEN 'FULLY INSURED' ELSE 'ASO' END AS claimsriskarrangement
    FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
),
book AS (
    SELECT *, CASE WHEN sourcesystemid = '1' THEN 'IOH'
                   WHEN sourcesystemid = '5' AND legalentityid = '82813' THEN 'CGIC Qatar'
                   WHEN sourcesystemid = '5' AND legalentityid = '53154' THEN 'GHB Bahrain NA'
                   WHEN sourcesystemid = '5' AND legalentityid = '53134' THEN 'GHB Czech NA'
                   WHEN sourcesystemid = '5' THEN 'CGIC NA'
                   WHEN sourcesystemid = '8' THEN 'GIH'
                   WHEN sourcesystemid IN ('2','3','4') AND legalentityid = '82440' THEN 'GHB Singapore'
                   WHEN sourcesystemid IN ('2','3','4') AND legalentityid IN ('82810','82811','82812') THEN 'GHB Africa'
                   WHEN sourcesystemid IN ('2','3','4') THEN 'GHB Europe' END AS book_of_business
    FROM b_claims
)"""

RATES = """
b_fx AS (
    SELECT f.c AS exchangeratecurrencyfromcode, t.c AS exchangeratecurrencytocode, d.d AS exchangeratedate, s.c AS exchangeratesourcecode,
           CAST(1 + (f.k * 3 + t.k * 5 + s.k * 7 + EXTRACT(DAY FROM d.d)) % 16 AS DOUBLE) / 8 AS exchangerate
    FROM (SELECT CAST(o_orderdate AS DATE) AS d FROM orders UNION SELECT CAST(l_shipdate AS DATE) FROM lineitem) d
    CROSS JOIN (VALUES ('USD',1),('EUR',2),('GBP',3),('CHF',4),('AUD',5)) f(c,k)
    CROSS JOIN (VALUES ('USD',1),('EUR',2),('GBP',3),('CHF',4)) t(c,k)
    CROSS JOIN (VALUES ('OAB',1),('ECB',2),('IMF',3)) s(c,k)
    WHERE f.c <> t.c AND NOT (s.c = 'OAB' AND EXTRACT(DAY FROM d.d) % 4 = 0)
),
preferred AS (
    SELECT DISTINCT exchangeratecurrencyfromcode AS newcurrencycode, exchangeratecurrencytocode AS basecurrencycode, exchangeratedate,
           CAST(ROUND(1 / exchangerate, 6) AS DECIMAL(18,6)) AS exchangerate
    FROM (SELECT *, RANK() OVER (PARTITION BY exchangeratedate, exchangeratecurrencytocode, exchangeratecurrencyfromcode
                                 ORDER BY CASE WHEN exchangeratesourcecode = 'OAB' THEN 1 ELSE 2 END, exchangerate) AS r FROM b_fx)
    WHERE r = 1 AND exchangeratecurrencyfromcode IN ('USD','GBP','EUR','CHF')
),
wide AS (
    SELECT basecurrencycode, exchangeratedate,
           CAST(SUM(CASE WHEN newcurrencycode = 'USD' THEN exchangerate ELSE 0 END) AS DECIMAL(18,6)) AS exchangerate_usd,
           CAST(SUM(CASE WHEN newcurrencycode = 'GBP' THEN exchangerate ELSE 0 END) AS DECIMAL(18,6)) AS exchangerate_gbp,
           CAST(SUM(CASE WHEN newcurrencycode = 'EUR' THEN exchangerate ELSE 0 END) AS DECIMAL(18,6)) AS exchangerate_euro,
           CAST(SUM(CASE WHEN newcurrencycode = 'CHF' THEN exchangerate ELSE 0 END) AS DECIMAL(18,6)) AS exchangerate_chf,
           CAST(COUNT(*) AS INTEGER) AS quotes
    FROM preferred GROUP BY basecurrencycode, exchangeratedate
)"""

ELIGIBILITY = """
b_eligibility AS (
    SELECT CAST(o_custkey AS VARCHAR) AS memberid, 'C' || CAST(o_custkey AS VARCHAR) AS customerid,
           CAST(1 + o_custkey % 5 AS VARCHAR) AS sourcesystemid,
           CAST(o_orderdate AS DATE) AS eligibilityfromdate,
           CAST(o_orderdate AS DATE) + CAST(o_orderkey % 400 AS INTEGER) AS eligibilitytodate,
           CASE v.k WHEN 0 THEN o_orderpriority ELSE 'Dental' END AS lineofcover,
           CASE WHEN v.k = 1 THEN 'DEN' WHEN o_orderpriority = '1-URGENT' THEN 'MED' WHEN o_orderpriority = '2-HIGH' THEN 'DEN'
                WHEN o_orderpriority = '3-MEDIUM' THEN 'VIS' WHEN o_orderpriority = '4-NOT SPECIFIED' THEN '  ' END AS lineofcovercode,
           o_orderkey * 2 + v.k AS sysbatchdttm
    FROM orders CROSS JOIN (VALUES (0),(1)) v(k) WHERE v.k = 0 OR o_orderkey % 3 = 0
),
overridden AS (
    SELECT memberid, customerid, sourcesystemid, eligibilityfromdate, eligibilitytodate,
           CASE WHEN sourcesystemid = '1' THEN 'Medical' ELSE lineofcover END AS lineofcover,
           CASE WHEN sourcesystemid = '1' THEN 'MED' ELSE lineofcovercode END AS lineofcovercode, sysbatchdttm
    FROM b_eligibility
),
medical_source AS (
    SELECT memberid, customerid, sourcesystemid, eligibilityfromdate, eligibilitytodate,
           CASE WHEN sourcesystemid = '1' THEN 'Medical' ELSE lineofcover END AS lineofcover,
           CASE WHEN sourcesystemid = '1' THEN 'MED' ELSE lineofcovercode END AS lineofcovercode, sysbatchdttm
    FROM b_eligibility
    WHERE eligibilitytodate > eligibilityfromdate AND trim(lineofcovercode) <> '' AND lineofcovercode IS NOT NULL
)"""


def months(source: str, name: str, last: str | None = AS_OF_MONTH) -> str:
    """Rows of a relation by month of their whole calendar years, flagged."""
    cut = f"WHERE eligible_month_dt_key <= {last}" if last else ""
    return f"""
{name} AS (
    SELECT *, CASE WHEN eligible_month_dt_key >= date_trunc('month', eligibilityfromdate)
                    AND eligible_month_dt_key <= last_day(eligibilitytodate) THEN 1 ELSE 0 END AS is_eligible
    FROM (SELECT *, CAST(unnest(generate_series(make_date(year(eligibilityfromdate), 1, 1), make_date(year(eligibilitytodate), 12, 31),
                                                INTERVAL 1 MONTH)) AS DATE) AS eligible_month_dt_key FROM {source})
    {cut}
)"""


PIVOT = (
    months("(SELECT * FROM overridden WHERE trim(lineofcovercode) <> '')", "cover_months")
    + """,
pivoted AS (
    SELECT memberid, eligibilityfromdate, eligibilitytodate, eligible_month_dt_key,
           CAST(COALESCE(MAX(CASE WHEN trim(lineofcovercode) = 'DEN' THEN is_eligible END), 0) AS INTEGER) AS DEN,
           CAST(COALESCE(MAX(CASE WHEN trim(lineofcovercode) = 'MED' THEN is_eligible END), 0) AS INTEGER) AS MED,
           CAST(COALESCE(MAX(CASE WHEN trim(lineofcovercode) = 'VIS' THEN is_eligible END), 0) AS INTEGER) AS VIS,
           CAST(MAX(is_eligible) AS INTEGER) AS eligible
    FROM cover_months GROUP BY ALL
),
snapshot AS (
    SELECT memberid, eligibilityfromdate, eligibilitytodate, customerid, sourcesystemid, lineofcover, lineofcovercode, sysbatchdttm
    FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY memberid, eligibilityfromdate, eligibilitytodate ORDER BY sysbatchdttm) AS r FROM overridden)
    WHERE r = 1
),
attached AS (
    SELECT p.*, s.customerid, s.sourcesystemid, s.lineofcover, s.lineofcovercode, s.sysbatchdttm
    FROM pivoted p JOIN snapshot s
      ON p.memberid = s.memberid AND p.eligibilityfromdate = s.eligibilityfromdate AND p.eligibilitytodate = s.eligibilitytodate
)"""
)

MEDICAL = (
    months("medical_source", "medical_months", None)
    + """,
medical_pivot AS (
    SELECT memberid, eligibilityfromdate, eligibilitytodate, eligible_month_dt_key,
           CAST(COALESCE(MAX(CASE WHEN trim(lineofcovercode) = 'MED' THEN is_eligible END), 0) AS INTEGER) AS MED
    FROM medical_months GROUP BY ALL
),
medical AS (
    SELECT p.*, p.MED AS eligible, s.customerid, s.sourcesystemid
    FROM medical_pivot p
    JOIN (SELECT *, ROW_NUMBER() OVER (PARTITION BY memberid, eligibilityfromdate, eligibilitytodate ORDER BY sysbatchdttm) AS r
          FROM medical_source) s
      ON p.memberid = s.memberid AND p.eligibilityfromdate = s.eligibilityfromdate AND p.eligibilitytodate = s.eligibilitytodate AND s.r = 1
)"""
)

RESIDENCE = """
b_residence AS (
    SELECT 'C' || CAST(c_custkey AS VARCHAR) AS customerid,
           CASE WHEN c_custkey % 7 = 0 THEN '9' ELSE CAST(1 + c_custkey % 5 AS VARCHAR) END AS sourcesystemid,
           CASE v.k WHEN 0 THEN 'PRI' WHEN 1 THEN 'PRI' ELSE 'SEC' END AS countryofresidencetypecode,
           CAST((c_nationkey + v.k) % 25 AS VARCHAR) AS countryofresidencecode,
           CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE DATE '1995-01-01' + CAST((c_custkey * 7 + v.k * 400) % 2400 AS INTEGER) END AS countryofresidencestartdate,
           CASE WHEN (c_custkey + v.k) % 3 = 0 THEN NULL ELSE DATE '1995-01-01' + CAST((c_custkey * 7 + v.k * 400) % 2400 + 365 AS INTEGER) END AS countryofresidenceenddate
    FROM customer CROSS JOIN (VALUES (0),(1),(2)) v(k)
),
residence AS (
    SELECT customerid, sourcesystemid, countryofresidencetypecode, countryofresidencecode, countryofresidencestartdate,
           COALESCE(countryofresidenceenddate, DATE '9999-12-31') AS countryofresidenceenddate
    FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY customerid, sourcesystemid
                                       ORDER BY countryofresidencetypecode NULLS FIRST,
                                                COALESCE(countryofresidenceenddate, DATE '9999-12-31') DESC,
                                                countryofresidencestartdate NULLS FIRST, countryofresidencecode NULLS FIRST) AS r
          FROM b_residence)
    WHERE r = 1
)"""

PLACED = """
placed AS (
    SELECT a.*, r.countryofresidencetypecode, r.countryofresidencecode,
           COALESCE(r.countryofresidencestartdate, DATE '1900-01-01') AS countryofresidencestartdate,
           COALESCE(r.countryofresidenceenddate, DATE '9999-12-31') AS countryofresidenceenddate
    FROM attached a LEFT JOIN residence r
      ON a.customerid = r.customerid AND a.sourcesystemid = r.sourcesystemid
     AND a.eligibilityfromdate <= COALESCE(r.countryofresidenceenddate, DATE '9999-01-01')
     AND COALESCE(r.countryofresidencestartdate, DATE '1900-01-01') <= a.eligibilitytodate
),
best AS (
    SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY memberid, eligible_month_dt_key
                                                ORDER BY eligible DESC, abs(datediff('day', eligibilityfromdate, eligible_month_dt_key)),
                                                         eligibilityfromdate, eligibilitytodate) AS r FROM placed)
    WHERE r = 1
)"""

MEASURES = """
           CASE WHEN last_day(eligible_month_dt_key) BETWEEN eligibilityfromdate AND eligibilitytodate THEN 1 ELSE 0 END AS eligibility_eom,
           CASE WHEN eligible_month_dt_key + 14 BETWEEN eligibilityfromdate AND eligibilitytodate THEN 1 ELSE 0 END AS eligibility_15th,
           {days} AS eligible_days, {days} / day(last_day(eligible_month_dt_key)) AS pro_rata_membership""".replace(
    "{days}",
    """CAST(CASE WHEN eligible_month_dt_key > eligibilitytodate OR last_day(eligible_month_dt_key) < eligibilityfromdate THEN 0
                ELSE datediff('day', greatest(eligible_month_dt_key, eligibilityfromdate),
                              least(last_day(eligible_month_dt_key), eligibilitytodate)) + 1 END AS INTEGER)""",
)

SPELL = """memberid, CAST(eligibilityfromdate AS VARCHAR) AS eligibilityfromdate, CAST(eligibilitytodate AS VARCHAR) AS eligibilitytodate"""
MONTH = "CAST(eligible_month_dt_key AS VARCHAR) AS eligible_month_dt_key"
SPELL_MONTH = f"{SPELL}, {MONTH}"
SOURCE_KEY = """memberid AS memberid_source, CAST(eligibilityfromdate AS VARCHAR) AS eligibilityfromdate_source,
           CAST(eligibilitytodate AS VARCHAR) AS eligibilitytodate_source"""


def stamp(column: str) -> str:
    return f"strftime(CAST({column} AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS {column}"


STAY = f"""countryofresidencetypecode, countryofresidencecode, {stamp('countryofresidencestartdate')}, {stamp('countryofresidenceenddate')}"""
ELIGIBILITY_ROW = f"{SPELL}, customerid, sourcesystemid, lineofcover, lineofcovercode, sysbatchdttm"


def with_(ctes: list[str], select: str) -> str:
    return "WITH " + ",".join(ctes) + "\n" + select


def number(column: str, name: str | None = None) -> str:
    return f"CAST({column} AS VARCHAR) AS {name or column}"


# report, metric, currency, amount, start, end
LEGS = [
    ("Incurred to Received", "Productcurrency", "productcurrencycode", "productcurrencypaymentamount", "servicedate", "claiminvoicereceiveddate"),
    ("Incurred to Received", "Paymentcurrency", "paymentcurrencycode", "paymentcurrencypaymentamount", "servicedate", "claiminvoicereceiveddate"),
    ("Incurred to Paid", "Productcurrency", "productcurrencycode", "productcurrencypaymentamount", "servicedate", "paymentdate"),
    ("Incurred to Paid", "Paymentcurrency", "paymentcurrencycode", "paymentcurrencypaymentamount", "servicedate", "paymentdate"),
    ("Received to Paid", "Productcurrency", "productcurrencycode", "productcurrencypaymentamount", "claiminvoicereceiveddate", "paymentdate"),
    ("Received to Paid", "Paymentcurrency", "paymentcurrencycode", "paymentcurrencypaymentamount", "claiminvoicereceiveddate", "paymentdate"),
]
AS_WRITTEN = LEGS[:3] + [
    ("Incurred to Received", "Paymentcurrency", "paymentcurrencycode", "productcurrencypaymentamount", "servicedate", "paymentdate"),
    LEGS[4],
    ("Received to Paid", "Paymentcurrency", "paymentcurrencycode", "productcurrencypaymentamount", "claiminvoicereceiveddate", "paymentdate"),
]
GRAINS = {
    "YEAR": ("strftime(s, '%Y')", "least(year(e) - year(s), 99)"),
    "QUARTER": (
        "strftime(s, '%Y') || 'Q' || CAST(quarter(s) AS VARCHAR)",
        "least((year(e) - year(s)) * 4 + quarter(e) - quarter(s), 99)",
    ),
    "MONTH": (
        "strftime(s, '%Y%m')",
        "CASE WHEN (year(e) - year(s)) * 12 + month(e) - month(s) > 59 THEN 99 ELSE (year(e) - year(s)) * 12 + month(e) - month(s) END",
    ),
}


def triangle_ctes(legs, grains=tuple(GRAINS), fanout=False) -> list[str]:
    """Every leg and grain aggregated on its own, then stacked."""
    rates = "spread" if fanout else "wide"
    ctes = [CLAIMS, RATES]
    if fanout:
        ctes.append("""
spread AS (
    SELECT basecurrencycode, exchangeratedate,
           CASE WHEN newcurrencycode = 'USD' THEN exchangerate ELSE 0 END AS exchangerate_usd,
           CASE WHEN newcurrencycode = 'GBP' THEN exchangerate ELSE 0 END AS exchangerate_gbp,
           CASE WHEN newcurrencycode = 'EUR' THEN exchangerate ELSE 0 END AS exchangerate_euro,
           CASE WHEN newcurrencycode = 'CHF' THEN exchangerate ELSE 0 END AS exchangerate_chf
    FROM preferred
)""")
    parts = []
    for i, (report, metric, currency, amount, start, end) in enumerate(legs):
        ctes.append(f"""
leg{i} AS (
    SELECT c.{currency} AS metric_value, c.legalentityname AS legal_entity_name, c.legalentityid AS legal_entity_id, c.book_of_business,
           c.{start} AS s, c.{end} AS e, c.{amount} AS a, c.{amount} * r.exchangerate_usd AS usd, c.{amount} * r.exchangerate_gbp AS gbp,
           c.{amount} * r.exchangerate_euro AS euro, c.{amount} * r.exchangerate_chf AS chf
    FROM book c LEFT JOIN {rates} r ON c.{currency} = r.basecurrencycode AND c.{start} = r.exchangeratedate
    WHERE upper(c.claimsriskarrangement) = 'FULLY INSURED' AND c.{start} <= c.{end}
)""")
        for grain in grains:
            period, lag = GRAINS[grain]
            parts.append(f"""
    SELECT '{metric}' AS metric_type, metric_value, book_of_business, legal_entity_id, legal_entity_name, {period} AS incurred_period,
           '{grain}' AS incurred_period_type, CAST({lag} AS INTEGER) AS paid_lag_value, SUM(a) AS sum_amount_base_currency,
           SUM(usd) AS sum_amount_usd, SUM(gbp) AS sum_amount_gbp, SUM(euro) AS sum_amount_euro, SUM(chf) AS sum_amount_chf,
           '{report}' AS triangle_report_type
    FROM leg{i} GROUP BY ALL""")
    ctes.append("\ntriangle AS (" + " UNION ALL ".join(parts) + "\n)")
    return ctes


TRIANGLE_ROW = (
    "metric_type, metric_value, book_of_business, legal_entity_id, legal_entity_name, incurred_period, incurred_period_type, "
    "paid_lag_value, "
    + ", ".join(number(f"sum_amount_{c}") for c in ("base_currency", "usd", "gbp", "euro", "chf"))
    + ", triangle_report_type"
)


def triangle(legs, grains=tuple(GRAINS), fanout=False) -> str:
    return with_(triangle_ctes(legs, grains, fanout), f"SELECT {TRIANGLE_ROW} FROM triangle")


def rule(name: str, failed: str, details: str, source: str) -> str:
    text = details.replace("'", "''")
    return (
        f"SELECT '{name}' AS name, failed = 0 AS passed, CAST(failed AS BIGINT) AS failed_rows, '{text}' AS details "
        f"FROM (SELECT COUNT(*) FILTER (WHERE {failed}) AS failed FROM {source})"
    )


FX_SUMS = ["sum_amount_usd", "sum_amount_gbp", "sum_amount_euro", "sum_amount_chf"]
PERIOD_BROKEN = """(incurred_period_type = 'MONTH' AND NOT regexp_matches(incurred_period, '^[0-9]{6}$'))
    OR (incurred_period_type = 'YEAR' AND NOT regexp_matches(incurred_period, '^[0-9]{4}$'))
    OR (incurred_period_type = 'QUARTER' AND NOT regexp_matches(incurred_period, '^[0-9]{4}Q[1-4]$'))"""
LAG_BROKEN = "paid_lag_value < 0 OR paid_lag_value > 99 OR (incurred_period_type = 'MONTH' AND paid_lag_value > 59 AND paid_lag_value <> 99)"
LAG_DETAILS = "rows with a paid_lag_value below 0, above 99, or of months above 59 and not 99"
PERIOD_DETAILS = "rows whose incurred_period is not written as its incurred_period_type asks"
CRITICAL = [
    "metric_type", "metric_value", "book_of_business", "legal_entity_id", "legal_entity_name", "incurred_period",
    "incurred_period_type", "paid_lag_value", "triangle_report_type", "triangle_report_type_val",
]
REPORT_TYPES = ["Incurred to Received", "Incurred to Paid", "Received to Paid"]


def listed(values: list[str]) -> str:
    return ", ".join(f"'{v}'" for v in values)


def fx_claims(columns: str) -> str:
    return f"""(SELECT {columns} FROM book c
    LEFT JOIN wide r ON c.productcurrencycode = r.basecurrencycode AND c.servicedate = r.exchangeratedate)"""


AMOUNTS = """c.*, c.productcurrencypaymentamount * r.exchangerate_usd AS amount_usd, c.productcurrencypaymentamount * r.exchangerate_gbp AS amount_gbp,
    c.productcurrencypaymentamount * r.exchangerate_euro AS amount_euro, c.productcurrencypaymentamount * r.exchangerate_chf AS amount_chf"""


def suite() -> str:
    amounts = ["sum_amount_base_currency", *FX_SUMS]
    checks = [
        ("critical_fields_not_null", " OR ".join(f"{c} IS NULL" for c in CRITICAL), "rows without a value in one of: " + ", ".join(CRITICAL)),
        ("triangle_report_type_allowed", f"triangle_report_type NOT IN ({listed(REPORT_TYPES)})", "rows with a triangle_report_type other than: " + ", ".join(REPORT_TYPES)),
        (
            "incurred_period_type_allowed",
            "incurred_period_type NOT IN ('MONTH', 'QUARTER', 'YEAR')",
            "rows with a incurred_period_type other than: MONTH, QUARTER, YEAR",
        ),
        (
            "metric_type_allowed",
            "metric_type NOT IN ('Productcurrency', 'Paymentcurrency')",
            "rows with a metric_type other than: Productcurrency, Paymentcurrency",
        ),
        (
            "metric_value_currency_code_format",
            "NOT regexp_matches(metric_value, '^[A-Z]{3}$')",
            "rows with a metric_value unlike ^[A-Z]{3}$",
        ),
        ("incurred_period_format_by_type", PERIOD_BROKEN, PERIOD_DETAILS),
        ("paid_lag_sanity", LAG_BROKEN, LAG_DETAILS),
        ("no_nan_in_amounts", " OR ".join(f"isnan(CAST({c} AS DOUBLE))" for c in amounts), "rows with a NaN in one of: " + ", ".join(amounts)),
        (
            "fx_conversions_present_when_base_present",
            "sum_amount_base_currency IS NOT NULL AND sum_amount_base_currency <> 0 AND " + " AND ".join(f"{c} IS NULL" for c in FX_SUMS),
            "rows with a sum_amount_base_currency and none of: " + ", ".join(FX_SUMS),
        ),
        (
            "triangle_type_value_matches_partition",
            "triangle_report_type_val <> triangle_report_type",
            "rows where triangle_report_type_val and triangle_report_type differ",
        ),
    ]
    mirrored = "\nmirrored AS (SELECT *, triangle_report_type AS triangle_report_type_val FROM triangle)"
    return with_([*triangle_ctes(LEGS), mirrored], " UNION ALL ".join(rule(n, f, d, "mirrored") for n, f, d in checks))


ORDERS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority"
PAIRS = {report: [leg for leg in LEGS if leg[0] == report] for report in REPORT_TYPES}

OPEN_ENDED = """b_open AS (
    SELECT * REPLACE (CASE WHEN sysbatchdttm % 97 = 0 THEN DATE '9999-12-31' ELSE eligibilitytodate END AS eligibilitytodate) FROM b_eligibility
),
"""

SQL = {
    "scan_projected": "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority IN ('1-URGENT', '2-HIGH')",
    "scan_partition_pruned": f"SELECT {ORDERS} FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '2-HIGH'",
    "scan_catalog_partitions": """SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus, o_orderpriority FROM orders
        WHERE o_orderstatus = 'F' AND o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_totalprice > 1000""",
    "scan_distinct": "SELECT DISTINCT o_custkey, o_orderpriority FROM orders",
    "scan_union_tables": """SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus <> 'F'
        UNION SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus = 'F' OR o_totalprice > 100000""",
    "scan_empty_fallback": "SELECT c_custkey, c_name, c_nationkey FROM customer",
    "view_scan_filtered": """SELECT DISTINCT c_nationkey, c_mktsegment FROM customer
        WHERE c_acctbal IS NOT NULL AND c_nationkey >= 5 AND c_acctbal > 0""",
    "file_scan": "SELECT l_orderkey, l_partkey, l_quantity, l_returnflag FROM lineitem",
    "file_scan_csv": "SELECT * FROM customer",
    "file_scan_csv_inferred": "SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders",
    "file_scan_json": "SELECT * FROM conversations",
    "file_scan_many": "SELECT p_partkey, p_brand, p_size FROM part WHERE p_size IS NOT NULL",
    "sql_passthrough": """SELECT n.n_name, COUNT(*) AS customers, MAX(c.c_acctbal) AS top_balance
        FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey GROUP BY n.n_name""",
    "sql_clean_names": "SELECT o_orderstatus AS order_status, COUNT(*) AS order_count FROM orders GROUP BY o_orderstatus",
    "write_roundtrip_partitioned": "SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_returnflag FROM lineitem",
    "write_dynamic_overwrite": """SELECT o_orderkey, o_orderpriority, o_totalprice, o_orderstatus FROM orders WHERE o_orderstatus <> 'F'
        UNION ALL SELECT o_orderkey, 'done', o_totalprice, o_orderstatus FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 1000""",
    "partition_mirror": "SELECT o_orderkey, o_orderstatus, o_orderstatus AS o_orderstatus_val FROM orders",
    "multi_report_sink": """SELECT o_orderstatus AS key, COUNT(*) AS orders, 'number of orders by order stat' AS report FROM orders GROUP BY 1
        UNION ALL SELECT o_orderpriority, COUNT(*), 'orders by priority' FROM orders GROUP BY 1""",
    "conjunctive_filter": f"SELECT {ORDERS} FROM orders WHERE o_orderstatus = 'F' AND o_totalprice >= 1000 AND o_orderpriority <> '5-LOW'",
    "id_list_filter_long": """SELECT l_returnflag, l_linenumber, l_orderkey FROM lineitem
        WHERE l_orderkey < 6000 AND l_orderkey >= 0 AND l_orderkey % 4 = 0""",
    "id_list_filter": "SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag FROM lineitem WHERE l_returnflag IN ('A', 'R')",
    "lenient_select": "SELECT p_partkey, p_brand, p_size FROM part",
    "rename_columns": "SELECT s_suppkey AS supplier_id, s_name AS supplier_name, s_nationkey, s_acctbal FROM supplier",
    "translate_names": "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer",
    "conform_schema": """SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey, CAST(l_quantity AS INTEGER) AS l_quantity,
        CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS l_shipdate, CAST(CAST(l_tax AS DECIMAL(4,2)) AS VARCHAR) AS l_tax,
        TRY_CAST(l_returnflag AS INTEGER) AS l_returnflag, CAST(NULL AS VARCHAR) AS l_comment FROM lineitem""",
    "cast_to_schema": """SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_custkey, o_orderstatus, o_totalprice,
        CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS o_orderdate, o_orderpriority FROM orders""",
    "align_union": """SELECT CAST(NULL AS DOUBLE) AS balance, c_custkey AS id, c_name AS name, c_mktsegment AS segment FROM customer
        UNION ALL SELECT s_acctbal, s_suppkey, s_name, NULL FROM supplier""",
    "to_date_columns": """SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS as_text,
        CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS o_orderdate FROM orders""",
    "relative_period_filter": with_(
        [CLAIMS],
        """SELECT claimlineid, CAST(servicedate AS VARCHAR) AS servicedate FROM b_claims
        WHERE servicedate >= DATE '1996-12-01' AND servicedate >= DATE '1997-01-01'""",
    ),
    "fully_insured_filter": with_(
        [CLAIMS], "SELECT claimlineid, claimsriskarrangement FROM b_claims WHERE upper(claimsriskarrangement) = 'FULLY INSURED'"
    ),
    "date_order_filter": with_(
        [CLAIMS],
        """SELECT claimlineid, CAST(servicedate AS VARCHAR) AS servicedate, CAST(claiminvoicereceiveddate AS VARCHAR) AS claiminvoicereceiveddate
        FROM b_claims WHERE servicedate <= claiminvoicereceiveddate""",
    ),
    "book_of_business": with_([CLAIMS], "SELECT claimlineid, sourcesystemid, legalentityid, book_of_business FROM book"),
    "period_labels": with_(
        [CLAIMS],
        """SELECT claimlineid, CAST(servicedate AS VARCHAR) AS servicedate, strftime(servicedate, '%Y%m') AS year_month,
        strftime(servicedate, '%Y') || 'Q' || CAST(quarter(servicedate) AS VARCHAR) AS year_quarter, strftime(servicedate, '%Y') AS year_only
        FROM b_claims""",
    ),
    "lag_buckets": with_(
        [CLAIMS],
        "SELECT claimlineid, "
        + ", ".join(
            f"CAST({GRAINS[g][1]} AS INTEGER) AS paid_lag_{n}" for g, n in (("MONTH", "months"), ("QUARTER", "quarters"), ("YEAR", "years"))
        )
        + " FROM (SELECT claimlineid, claiminvoicereceiveddate AS s, paymentdate AS e FROM b_claims)",
    ),
    "fx_preferred_rate": with_(
        [RATES],
        f"SELECT newcurrencycode, basecurrencycode, CAST(exchangeratedate AS VARCHAR) AS exchangeratedate, {number('exchangerate')} FROM preferred",
    ),
    "fx_wide": with_(
        [RATES],
        "SELECT basecurrencycode, CAST(exchangeratedate AS VARCHAR) AS exchangeratedate, "
        + ", ".join(number(f"exchangerate_{c}") for c in ("usd", "gbp", "euro", "chf"))
        + ", quotes FROM wide",
    ),
    "fx_convert": with_(
        [CLAIMS, RATES],
        "SELECT claimlineid, productcurrencycode, "
        + ", ".join(number(c) for c in ("productcurrencypaymentamount", "amount_usd", "amount_chf", "amount_gbp", "amount_euro"))
        + f", book_of_business FROM {fx_claims(AMOUNTS)}",
    ),
    "triangle_year": triangle(LEGS[:1], ("YEAR",)),
    "triangle_quarter": triangle(LEGS[:1], ("QUARTER",)),
    "triangle_month": triangle(LEGS[:1], ("MONTH",)),
    "triangle_all_grains": triangle(LEGS[:1]),
    "triangle_incurred_received": triangle(PAIRS["Incurred to Received"]),
    "triangle_incurred_paid": triangle(PAIRS["Incurred to Paid"]),
    "triangle_received_paid": triangle(PAIRS["Received to Paid"]),
    "triangle_report": triangle(LEGS),
    "triangle_report_as_written": triangle(AS_WRITTEN, fanout=True),
    "elig_source_filtered": with_([ELIGIBILITY], f"SELECT {ELIGIBILITY_ROW} FROM medical_source"),
    "cover_override": with_([ELIGIBILITY], f"SELECT {ELIGIBILITY_ROW} FROM overridden"),
    "month_expand": with_(
        [ELIGIBILITY, months("(SELECT * FROM b_eligibility WHERE trim(lineofcovercode) <> '')", "m", None)],
        f"SELECT sysbatchdttm, {MONTH} FROM m",
    ),
    "month_cutoff": with_([ELIGIBILITY, months("b_eligibility", "m", "DATE '1998-03-01'")], f"SELECT sysbatchdttm, {MONTH} FROM m"),
    "month_eligible_flag": with_(
        [ELIGIBILITY, months("b_eligibility", "m")], f"SELECT sysbatchdttm, {MONTH}, CAST(is_eligible AS INTEGER) AS is_eligible FROM m"
    ),
    "cover_pivot": with_([ELIGIBILITY, PIVOT], f"SELECT {SPELL_MONTH}, DEN, MED, VIS FROM pivoted"),
    "cover_pivot_fixed": with_([ELIGIBILITY, MEDICAL], f"SELECT {SPELL_MONTH}, MED FROM medical_pivot"),
    "eligible_flag": with_([ELIGIBILITY, PIVOT], f"SELECT {SPELL_MONTH}, CASE WHEN DEN = 1 OR MED = 1 THEN 1 ELSE 0 END AS eligible FROM pivoted"),
    "spell_snapshot": with_(
        [ELIGIBILITY, PIVOT], f"SELECT {SOURCE_KEY}, customerid, sourcesystemid, lineofcover, lineofcovercode, sysbatchdttm FROM snapshot"
    ),
    "spell_snapshot_join": with_(
        [ELIGIBILITY, PIVOT], f"SELECT {SPELL_MONTH}, eligible, customerid, lineofcovercode, sysbatchdttm FROM attached"
    ),
    "membership_months": with_(
        [ELIGIBILITY, PIVOT],
        f"""SELECT {SPELL_MONTH}, eligible, DEN, MED, VIS, customerid, sourcesystemid, lineofcover, lineofcovercode, sysbatchdttm,
        {SOURCE_KEY} FROM attached""",
    ),
    "residence_current": with_([RESIDENCE], f"SELECT customerid, sourcesystemid, {STAY} FROM residence"),
    "open_interval_defaults": with_(
        [RESIDENCE],
        f"""SELECT customerid, sourcesystemid, {STAY} FROM (SELECT * REPLACE (
            COALESCE(countryofresidencestartdate, DATE '1900-01-01') AS countryofresidencestartdate,
            COALESCE(countryofresidenceenddate, DATE '9999-12-31') AS countryofresidenceenddate) FROM b_residence)""",
    ),
    "residence_overlap_join": with_(
        [ELIGIBILITY, RESIDENCE],
        f"""SELECT memberid, sysbatchdttm, {STAY} FROM (
        SELECT e.memberid, e.sysbatchdttm, r.* FROM b_eligibility e LEFT JOIN residence r
          ON e.customerid = r.customerid AND e.sourcesystemid = r.sourcesystemid
         AND e.eligibilityfromdate <= r.countryofresidenceenddate
         AND COALESCE(r.countryofresidencestartdate, DATE '1900-01-01') <= e.eligibilitytodate)""",
    ),
    "membership_with_residence": with_(
        [ELIGIBILITY, PIVOT, RESIDENCE, PLACED], f"SELECT {SPELL_MONTH}, eligible, customerid, sourcesystemid, {STAY} FROM placed"
    ),
    "best_spell_per_month": with_(
        [ELIGIBILITY, PIVOT, RESIDENCE, PLACED], f"SELECT {SPELL_MONTH}, eligible, DEN, MED, VIS, countryofresidencecode FROM best"
    ),
    "coverage_measures": with_([ELIGIBILITY, PIVOT], f"SELECT {SPELL_MONTH}, eligible, {MEASURES} FROM pivoted"),
    "membership_columns": with_(
        [ELIGIBILITY, PIVOT],
        f"SELECT {SPELL_MONTH}, {SOURCE_KEY}, customerid, eligible, {MEASURES}, DEN, MED, VIS, sourcesystemid FROM attached",
    ),
    "membership_report": with_(
        [ELIGIBILITY, PIVOT, RESIDENCE, PLACED],
        f"""SELECT {SPELL_MONTH}, {SOURCE_KEY}, customerid, countryofresidencecode, eligible, {MEASURES}, DEN, MED, VIS, sourcesystemid
        FROM best""",
    ),
    "membership_medical": with_(
        [ELIGIBILITY, MEDICAL], f"SELECT {SPELL_MONTH}, customerid, eligible, {MEASURES}, MED, sourcesystemid FROM medical"
    ),
    "membership_medical_as_of": with_(
        [
            ELIGIBILITY.replace("FROM b_eligibility", "FROM b_open").replace("overridden AS (", OPEN_ENDED + "overridden AS ("),
            MEDICAL,
        ],
        f"""SELECT {SPELL_MONTH}, customerid, eligible, {MEASURES}, MED, sourcesystemid FROM medical
        WHERE eligible_month_dt_key <= {AS_OF_MONTH}""",
    ),
    "dq_not_null": with_(
        [ELIGIBILITY],
        rule("cover_present", "memberid IS NULL OR lineofcovercode IS NULL", "rows without a value in one of: memberid, lineofcovercode", "b_eligibility"),
    ),
    "dq_in_set": with_(
        [ELIGIBILITY],
        rule("cover_known", "lineofcovercode NOT IN ('MED', 'DEN')", "rows with a lineofcovercode other than: MED, DEN", "b_eligibility"),
    ),
    "dq_regex": with_(
        [ELIGIBILITY],
        rule(
            "cover_format",
            "NOT regexp_matches(lineofcovercode, '^[A-Z]{3}$')",
            "rows with a lineofcovercode unlike ^[A-Z]{3}$",
            "b_eligibility",
        ),
    ),
    "dq_no_nan": rule("rates_are_numbers", "l_tax = 0 OR l_discount = 0", "rows with a NaN in one of: tax, discount", "lineitem"),
    "dq_column_match": with_(
        [CLAIMS],
        rule(
            "one_currency",
            "paymentcurrencycode <> productcurrencycode",
            "rows where paymentcurrencycode and productcurrencycode differ",
            "b_claims",
        ),
    ),
    "dq_period_format": rule(
        "incurred_period_format_by_type",
        PERIOD_BROKEN,
        PERIOD_DETAILS,
        """(SELECT CASE WHEN o_orderstatus = 'P' THEN strftime(o_orderdate, '%Y-%m') ELSE strftime(o_orderdate, '%Y%m') END AS incurred_period,
        CASE o_orderpriority WHEN '1-URGENT' THEN 'YEAR' WHEN '2-HIGH' THEN 'QUARTER' ELSE 'MONTH' END AS incurred_period_type FROM orders)""",
    ),
    "dq_lag_sanity": with_(
        [CLAIMS],
        rule(
            "paid_lag_sanity",
            LAG_BROKEN,
            LAG_DETAILS,
            """(SELECT (year(claiminvoicereceiveddate) - year(servicedate)) * 12 + month(claiminvoicereceiveddate) - month(servicedate)
            AS paid_lag_value, 'MONTH' AS incurred_period_type FROM b_claims)""",
        ),
    ),
    "dq_lag_without_period_type": with_(
        [CLAIMS],
        rule(
            "paid_lag_sanity",
            "lag < 0 OR lag > 99",
            LAG_DETAILS,
            """(SELECT (year(claiminvoicereceiveddate) - year(servicedate)) * 12 + month(claiminvoicereceiveddate) - month(servicedate)
            AS lag FROM b_claims)""",
        ),
    ),
    "dq_key_uniqueness_any_case": with_(
        [RATES],
        rule(
            "fx_join_keys_unique",
            "n > 1",
            "keys that occur again, by BaseCurrencyCode, EXCHANGERATEDATE",
            "(SELECT COUNT(*) AS n FROM preferred GROUP BY basecurrencycode, exchangeratedate)",
        ),
    ),
    "dq_fx_missing": with_(
        [CLAIMS, RATES],
        rule(
            "fx_conversions_present_when_base_present",
            "productcurrencypaymentamount <> 0 AND amount_usd IS NULL AND amount_gbp IS NULL AND amount_euro IS NULL AND amount_chf IS NULL",
            "rows with a productcurrencypaymentamount and none of: amount_usd, amount_gbp, amount_euro, amount_chf",
            fx_claims(AMOUNTS),
        ),
    ),
    "dq_fx_key_uniqueness": with_(
        [RATES],
        rule(
            "fx_join_keys_unique",
            "n > 1",
            "keys that occur again, by basecurrencycode, exchangeratedate",
            "(SELECT COUNT(*) AS n FROM preferred GROUP BY basecurrencycode, exchangeratedate)",
        ),
    ),
    "dq_row_explosion": with_(
        [CLAIMS, RATES],
        """SELECT 'no_row_explosion_after_fx_join' AS name, a = b AS passed, CAST(a - b AS BIGINT) AS failed_rows,
        CAST(b AS VARCHAR) || ' rows became ' || CAST(a AS VARCHAR) AS details
        FROM (SELECT (SELECT COUNT(*) FROM b_claims) AS b, (SELECT COUNT(*) FROM b_claims c LEFT JOIN preferred p
              ON c.productcurrencycode = p.basecurrencycode AND c.servicedate = p.exchangeratedate) AS a)""",
    ),
    "dq_fx_suite": with_(
        [CLAIMS, RATES],
        f"""SELECT 'no_row_explosion_after_fx_join' AS name, a = b AS passed, CAST(a - b AS BIGINT) AS failed_rows,
        CAST(b AS VARCHAR) || ' rows became ' || CAST(a AS VARCHAR) AS details
        FROM (SELECT (SELECT COUNT(*) FROM b_claims) AS b, (SELECT COUNT(*) FROM {fx_claims("c.claimlineid")}) AS a)
        UNION ALL """
        + rule(
            "fx_join_keys_unique",
            "n > 1",
            "keys that occur again, by basecurrencycode, exchangeratedate",
            "(SELECT COUNT(*) AS n FROM wide GROUP BY basecurrencycode, exchangeratedate)",
        ),
    ),
    "dq_thresholds": with_(
        [CLAIMS],
        """, n AS (SELECT COUNT(*) AS n, COUNT(*) FILTER (WHERE productcurrencycode NOT IN ('USD', 'EUR', 'GBP', 'CHF')) AS money,
            COUNT(*) FILTER (WHERE servicedate IS NULL OR paymentdate IS NULL) AS days FROM b_claims),
        r(name, severity, failed, allowed, n, details) AS (
            SELECT 'currency_known', 'error', money, floor(n * 0.35), n, 'rows with a productcurrencycode other than: USD, EUR, GBP, CHF' FROM n
            UNION ALL SELECT 'currency_known', 'warning', money, floor(n * 0.05), n, 'rows with a productcurrencycode other than: USD, EUR, GBP, CHF' FROM n
            UNION ALL SELECT 'currency_known', 'error', money, 10, n, 'rows with a productcurrencycode other than: USD, EUR, GBP, CHF' FROM n
            UNION ALL SELECT 'dates_present', 'error', days, 0, n, 'rows without a value in one of: servicedate, paymentdate' FROM n
            UNION ALL SELECT 'needs_a_missing_column', 'error', 0, greatest(n, 1000000), n, 'no such columns: no_such_column' FROM n
        )
        SELECT name, severity, failed <= allowed AND name <> 'needs_a_missing_column' AS passed, CAST(failed AS BIGINT) AS failed_rows,
            CAST(allowed AS BIGINT) AS allowed_rows, CAST(n AS BIGINT) AS total_rows, details FROM r""",
    ),
    "dq_triangle_suite": suite(),
    "dq_missing_column": with_(
        [CLAIMS],
        """SELECT 'needs_a_missing_column' AS name, FALSE AS passed, CAST(0 AS BIGINT) AS failed_rows,
        'no such columns: no_such_column' AS details UNION ALL """
        + rule(
            "currency_known",
            "productcurrencycode NOT IN ('USD', 'EUR', 'GBP', 'CHF')",
            "rows with a productcurrencycode other than: USD, EUR, GBP, CHF",
            "b_claims",
        ),
    ),
}

# The same results, from rows that are chosen by their place and fetched afterwards.
SQL |= {f"{name}_late": SQL[name] for name in ("spell_snapshot", "membership_months", "membership_report")}
