"""Column contracts of the input tables and of the two reports."""

import re

from pyspark.sql.types import StructType


def columns(text: str) -> StructType:
    """A schema from `name type, name type`; unlike DDL it needs no running session."""
    schema = StructType()
    for entry in re.split(r",\s+", text.strip()):
        schema.add(*entry.split())
    return schema


# Column names and types of the input tables.
CLAIMS = columns(
    """
    claimlineid string, claiminvoiceid string, memberid string, originalclaiminvoiceid string,
    partnerid string, productid string, policyid string, legalentityid string, claimchannel string,
    internaldiagnosis string, internaldiagnosiscode string, internalprocedurecode string,
    admissiontypecode string, deniedreason string, paymentcurrencycode string,
    productcurrencycode string, edw_businesslinedesc string, edw_producttreedesc string,
    edw_producttreekey string, edw_businessbook string, edw_businessline string, lineofcover string,
    market string, countryofassignment string, incurredcountry string, legalentityname string,
    partnername string, policyname string, bednight integer, benefitname string,
    billingprovidercompanyname string, ccs_lv2_desc string, claimexternalinvoicereference string,
    planname string, tds_claimage integer, tds_casetype string, claiminvoicestatuslevel1 string,
    claiminvoicestatuslevel2 string, claiminvoicestatuslevel3 string, claimlinestatuslevel1 string,
    claimlinestatuslevel2 string, claimlinestatuslevel3 string, claimpaymentstatuslevel1 string,
    claimpaymentstatuslevel2 string, claimpaymentstatuslevel3 string, claimsriskarrangement string,
    cignalinkspartnerindicator boolean, claiminvoicereceiveddate date, paymentdate date,
    reporteddate date, servicedate date, servicefromdate date, policystartdate date,
    policyenddate date, productcurrencybilledamount decimal(17,2),
    paymentcurrencypaymentamount decimal(17,2), productcurrencypaymentamount decimal(17,2),
    subscriberindicator boolean, sourcesystemid string, sourcesystemname string
    """
)

EXCHANGE_RATE = columns(
    """
    exchangeratecurrencyfromcode string, exchangeratecurrencytocode string, exchangeratedate date,
    exchangeratesourcecode string, exchangerate double
    """
)

RESIDENCE = columns(
    """
    customerid string, sourcesystemid string, countryofresidencetypecode string,
    countryofresidencecode string, countryofresidencestartdate timestamp,
    countryofresidenceenddate timestamp, etlchecksum string
    """
)

TRIANGLE = columns(
    """
    metric_type string, metric_value string, book_of_business string, legal_entity_id string,
    legal_entity_name string, incurred_period string, incurred_period_type string,
    paid_lag_value integer, sum_amount_base_currency decimal(27,2), sum_amount_usd decimal(38,8),
    sum_amount_gbp decimal(38,8), sum_amount_euro decimal(38,8), sum_amount_chf decimal(38,8),
    triangle_report_type string
    """
)

# Leading and trailing columns of the membership report. The line-of-cover
# columns, one per code, stand between the two.
MEMBERSHIP_LEADING = """
    memberid familyunitid familyunittype dateofbirth tds_currentage nationalitycode nationality
    gendercode relationshiptypecode clientstaffcategoryid clientstaffcategoryname
    medicalunderwritingcustomertypecode memberid_source customerid countryofresidencecode
    eligibilityfromdate eligibilitytodate eligibilityterminationdate memberterminationdate
    memberadditiondate eligible_month_dt_key eligible eligibility_eom eligibility_15th eligible_days
    pro_rata_membership eligibilityfromdate_source eligibilitytodate_source policyid
    policystatuscode policyname policystartdate policyenddate productid productname packageid
    packagename areaofcovercode claimsriskarrangement parentclientid clientid ancestorid clientlevel
    clientname clientcontractstartdate clientcontractenddate clientinceptiondate
    clientterminationdate legalentityid legalentityname lineofbusinessid lineofbusinessname segment
    market
""".split()
MEMBERSHIP_TRAILING = ["sourcesystemid", "sourcesystemname"]
