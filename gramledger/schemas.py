"""Fixed schemas of the landed feeds and of the tables built from them."""

from __future__ import annotations

from pyspark.sql import types as T

# Field names of the two public feeds and column names of the tables made from them.

PAYMENT_RECORD = T.StructType(
    [
        T.StructField("HCPCS_Cd", T.StringType()),
        T.StructField("HCPCS_Desc", T.StringType()),
        T.StructField("HCPCS_Drug_Ind", T.StringType()),
        T.StructField("Rndrng_Prvdr_Geo_Desc", T.StringType()),
        T.StructField("Place_Of_Srvc", T.StringType()),
        T.StructField("Tot_Rndrng_Prvdrs", T.StringType()),
        T.StructField("Tot_Srvcs", T.StringType()),
        T.StructField("Avg_Sbmtd_Chrg", T.StringType()),
        T.StructField("Avg_Mdcr_Alowd_Amt", T.StringType()),
        T.StructField("Avg_Mdcr_Pymt_Amt", T.StringType()),
    ]
)

BRONZE_PAYMENTS = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("ingested_at", T.StringType()),
        T.StructField("record", PAYMENT_RECORD),
    ]
)

BRONZE_RECALLS = T.StructType(
    [
        T.StructField("_id", T.StringType()),
        T.StructField("_ingested_at", T.StringType()),
        T.StructField("recall_number", T.StringType()),
        T.StructField("classification", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("recalling_firm", T.StringType()),
        T.StructField("reason_for_recall", T.StringType()),
        T.StructField("report_date", T.StringType()),
        T.StructField("distribution_pattern", T.StringType()),
        T.StructField(
            "openfda", T.StructType([T.StructField("generic_name", T.ArrayType(T.StringType()))])
        ),
    ]
)

INGEST_DATE = T.StructField("ingest_date", T.DateType())

SILVER_PAYMENTS = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("ingested_at", T.StringType()),
        T.StructField("hcpcs_code", T.StringType()),
        T.StructField("drug_desc", T.StringType()),
        T.StructField("geography", T.StringType()),
        T.StructField("total_providers", T.DoubleType()),
        T.StructField("total_services", T.DoubleType()),
        T.StructField("avg_submitted_charge", T.DoubleType()),
        T.StructField("avg_medicare_allowed", T.DoubleType()),
        T.StructField("avg_medicare_paid", T.DoubleType()),
        T.StructField("payment_gap_pct", T.DoubleType()),
        T.StructField("dollar_impact", T.DoubleType()),
        INGEST_DATE,
    ]
)

SILVER_RECALLS = T.StructType(
    [
        T.StructField("recall_number", T.StringType()),
        T.StructField("classification", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("recalling_firm", T.StringType()),
        T.StructField("reason_for_recall", T.StringType()),
        T.StructField("report_date", T.StringType()),
        T.StructField("distribution_pattern", T.StringType()),
        T.StructField("generic_name", T.StringType()),
        INGEST_DATE,
    ]
)

# Snapshot columns in file order; the file carries them in upper case.
SNAPSHOT = T.StructType(
    [
        T.StructField("HCPCS_CODE", T.StringType()),
        T.StructField("DRUG_DESC", T.StringType()),
        T.StructField("TOTAL_SERVICES", T.DoubleType()),
        T.StructField("AVG_SUBMITTED_CHARGE", T.DoubleType()),
        T.StructField("AVG_MEDICARE_PAID", T.DoubleType()),
        T.StructField("PAYMENT_GAP_PCT", T.DoubleType()),
        T.StructField("DOLLAR_IMPACT", T.DoubleType()),
        T.StructField("COST_RISK_TIER", T.StringType()),
        T.StructField("TOTAL_RECALLS", T.LongType()),
        T.StructField("ONGOING_RECALLS", T.LongType()),
        T.StructField("SAFETY_RISK_TIER", T.StringType()),
        T.StructField("COMBINED_RISK_SCORE", T.DoubleType()),
        T.StructField("AI_EXPLANATION", T.StringType()),
    ]
)


def envelope(row: T.StructType) -> T.StructType:
    """Schema of a page that carries its rows as an array under ``results``."""
    return T.StructType([T.StructField("results", T.ArrayType(row))])
