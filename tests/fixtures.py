"""Hand-made payments and recalls, landed as JSON like the feeds, with the expected results."""

from __future__ import annotations

import json
from datetime import date
from pathlib import Path

# code, description, geography, providers, services, submitted, allowed, paid
PAYMENTS = [
    ("J0001", "Injection, rituximab, 10 mg", "National", 10, 100, 200, 100, 80),
    ("J0001", "Injection, rituximab, 10 mg", "National", 20, 300.5, 100, 60, 40),
    ("J0001", "Injection, rituximab, 10 mg", "Ohio", 5, 50, 900, 1, 1),
    ("J0002", "Injection, heparin sodium and dextrose, 1 unit", "National", 4, 10, 100, 50, 25),
    ("J0003", "Injection, alpha1 and beta22, 1 mg", "National", 4, 10, 100, 70, 60),
    ("J0004", "Injection, nomatch, 1 mg", "National", 1, 2, 100, 90, 70),
    ("J0005", "Injection, rituximab zero, 1 mg", "National", 1, 0, 100, 90, 70),
    ("J0006", "Injection, overpaid, 1 mg", "National", 1, 4, 50, 60, 55),
    ("J0007", "Infusion, zeta, 1 mg", "National", 3, 8, 10, 7, 5.5),
]

# number, class, status, firm, date, names
RECALLS = [
    ("D-1", "Class II", "Ongoing", "Firm A", "20240115", ["RITUXIMAB"]),
    ("D-2", "Class III", "Terminated", "Firm B", "20240301", [" rituximab ", "HEPARIN"]),
    ("D-3", "Class I", "Ongoing", "Firm A", "20240302", None),
    ("D-4", "Class I", "Ongoing", "Firm A", "20240303", []),
    ("D-5", "Class I", "Ongoing", "Firm C", "20231201", ["Heparin Sodium"]),
    ("D-6", "Class III", "Completed", "Firm A", "20240110", ["ALPHA1"]),
    ("D-7", "Class I", "Completed", "Firm A", "20240111", ["BETA22"]),
    ("D-8", "Not Yet Classified", "Ongoing", None, "20240112", ["ZETA"]),
]

SUMMARY = {
    "ALPHA1": (1, 3, date(2024, 1, 10), 0, 1),
    "BETA22": (1, 1, date(2024, 1, 11), 0, 1),
    "HEPARIN": (1, 3, date(2024, 3, 1), 0, 1),
    "HEPARIN SODIUM": (1, 1, date(2023, 12, 1), 1, 1),
    "RITUXIMAB": (2, 2, date(2024, 3, 1), 1, 2),
    "ZETA": (1, 4, date(2024, 1, 12), 1, 0),
}

# providers, services, submitted, allowed, paid, gap, impact, name, recalls, worst, ongoing, firms, cost, safety, score
SCORED = {
    "J0002": (4, 10, 100, 50, 25, 75, 750, "HEPARIN SODIUM", 1, 1, 1, 1, "High", "High", 145.0),
    "J0001": (30, 400.5, 124.968789, 69.987516, 49.987516, 60, 30030, "RITUXIMAB", 2, 2, 1, 2, "Medium", "Medium", 110.0),
    "J0003": (4, 10, 100, 70, 60, 40, 400, "BETA22", 1, 1, 0, 1, "Medium", "High", 100.0),
    "J0007": (3, 8, 10, 7, 5.5, 45, 36, "ZETA", 1, 4, 1, 0, "Medium", "Low", 55.0),
    "J0005": (1, 0, None, None, None, None, None, "RITUXIMAB", 2, 2, 1, 2, "Low", "Medium", 50.0),
    "J0004": (1, 2, 100, 90, 70, 30, 60, None, 0, None, 0, None, "Low", "None", 30.0),
    "J0006": (1, 4, 50, 60, 55, -10, -20, None, 0, None, 0, None, "Low", "None", -10.0),
}


def payment_documents() -> list[dict]:
    return [
        {
            "id": i,
            "ingested_at": "2024-02-01 00:00:00+00:00",
            "record": {
                "HCPCS_Cd": code,
                "HCPCS_Desc": text,
                "HCPCS_Drug_Ind": "Y",
                "Rndrng_Prvdr_Geo_Desc": geography,
                "Place_Of_Srvc": "F",
                "Tot_Rndrng_Prvdrs": str(providers),
                "Tot_Srvcs": str(services),
                "Avg_Sbmtd_Chrg": str(submitted),
                "Avg_Mdcr_Alowd_Amt": str(allowed),
                "Avg_Mdcr_Pymt_Amt": str(paid),
            },
        }
        for i, (code, text, geography, providers, services, submitted, allowed, paid) in enumerate(PAYMENTS)
    ]


def recall_documents() -> list[dict]:
    documents = []
    for number, severity, status, firm, day, names in RECALLS:
        documents.append(
            {
                "_id": f"id-{number}",
                "_ingested_at": "2024-02-01 00:00:00+00:00",
                "recall_number": number,
                "classification": severity,
                "status": status,
                "recalling_firm": firm,
                "reason_for_recall": "Label",
                "report_date": day,
                "distribution_pattern": "Nationwide",
                "openfda": {} if names is None else {"generic_name": names},
            }
        )
    return documents


def land_array(folder: Path, rows: list[dict]) -> str:
    folder.mkdir(parents=True)
    (folder / "part.json").write_text(json.dumps(rows))
    return str(folder)
