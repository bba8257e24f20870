"""Landed records to flat, typed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from gramledger.operators.flatten import add_gap_and_impact, explode_keep, flatten_fields

# Feed paths behind each column.
PAYMENT_TEXTS = {
    "hcpcs_code": "record.HCPCS_Cd",
    "drug_desc": "record.HCPCS_Desc",
    "geography": "record.Rndrng_Prvdr_Geo_Desc",
}
PAYMENT_NUMBERS = {
    "total_providers": "record.Tot_Rndrng_Prvdrs",
    "total_services": "record.Tot_Srvcs",
    "avg_submitted_charge": "record.Avg_Sbmtd_Chrg",
    "avg_medicare_allowed": "record.Avg_Mdcr_Alowd_Amt",
    "avg_medicare_paid": "record.Avg_Mdcr_Pymt_Amt",
}
RECALL_COLUMNS = (
    "recall_number",
    "classification",
    "status",
    "recalling_firm",
    "reason_for_recall",
    "report_date",
    "distribution_pattern",
)
RECALL_NAMES = "openfda.generic_name"


def silver_payments(bronze: DataFrame) -> DataFrame:
    flat = flatten_fields(bronze, ("id", "ingested_at"), PAYMENT_TEXTS, PAYMENT_NUMBERS)
    return add_gap_and_impact(flat)


def silver_recalls(bronze: DataFrame) -> DataFrame:
    """One row per recall and name; a recall without names stays, with a null name."""
    return explode_keep(bronze, RECALL_NAMES, "generic_name", RECALL_COLUMNS)
