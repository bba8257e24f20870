"""The daily run, twice over the same day and once over the next."""

from __future__ import annotations

import json

import fixtures as X
import pytest

from gramledger.operators.serving import top_n
from gramledger.plans import daily
from gramledger.schemas import BRONZE_RECALLS, PAYMENT_RECORD, SILVER_PAYMENTS, SILVER_RECALLS
from gramledger.sources import bronze, snapshot


def land(root, day, recalls):
    for feed, rows in ((daily.PAYMENTS, X.payment_documents()), (daily.RECALLS, recalls)):
        folder = root / "raw" / feed / f"ingest_date={day}"
        folder.mkdir(parents=True)
        (folder / "part.json").write_text("\n".join(json.dumps(r) for r in rows))


def test_daily_run(spark, tmp_path, capsys):
    land(tmp_path, "2024-02-01", X.recall_documents())
    land(tmp_path, "2024-02-02", [])
    root = str(tmp_path)
    for _ in range(2):
        done = daily.to_silver(spark, root, "2024-02-01")
        assert {feed: d["rows"] for feed, d in done.items()} == {"payments": 9, "recalls": 9}
    silver = bronze.read_parts(spark, f"{root}/silver/payments", schema=SILVER_PAYMENTS)
    assert silver.count() == 9 and silver.schema == SILVER_PAYMENTS

    report = daily.to_gold(spark, root, "2024-02-01")
    assert report.where("passed").count() == 8
    assert spark.sql("SELECT count(*) FROM scored WHERE safety_risk_tier = 'None'").first()[0] == 2
    daily.to_texts(spark, root, "2024-02-01T00:00:00", n=2, pause=0)
    rows = top_n(snapshot.read_snapshot(spark, daily.to_snapshot(spark, root)), 3).collect()
    assert [r["hcpcs_code"] for r in rows] == ["J0002", "J0001", "J0003"]
    assert [r["ai_explanation"] is None for r in rows] == [False, False, True]

    daily.run(spark, root, "2024-02-02", pause=0)
    assert "recalls: 0 rows" in capsys.readouterr().out
    assert spark.read.parquet(f"{root}/gold/scored").where("total_recalls > 0").isEmpty()
    assert silver.where("ingest_date = '2024-02-01'").count() == 9


def test_feeds_land_flagged_and_newest_rows(spark, tmp_path):
    feed = [
        {"HCPCS_Cd": "J1", "HCPCS_Drug_Ind": "Y", "Tot_Srvcs": "2", "Avg_Sbmtd_Chrg": "0", "Avg_Mdcr_Pymt_Amt": "1"},
        {"HCPCS_Cd": "J2", "HCPCS_Drug_Ind": "N", "Tot_Srvcs": "2"},
        {"HCPCS_Cd": "J3", "HCPCS_Drug_Ind": None},
    ]
    documents = [
        {"recall_number": number, "report_date": day, "openfda": {"generic_name": names}}
        for number, day, names in (("D-1", "20240103", ["A", "B"]), ("D-2", "20240101", ["C"]), ("D-3", "soon", None))
    ]
    payments = spark.createDataFrame(feed, PAYMENT_RECORD)
    recalls = spark.createDataFrame(documents, BRONZE_RECALLS).drop("_ingested_at")
    root, day, stamp = str(tmp_path), "2024-02-01", "2024-02-01T00:00:00"
    for newest_rows, kept, names in ((None, 3, 4), (1, 1, 2)):
        done = daily.to_bronze(payments, recalls, root, day, stamp, newest_rows)
        assert {feed: d["rows"] for feed, d in done.items()} == {"payments": 1, "recalls": kept}
        assert {feed: d["rows"] for feed, d in daily.to_silver(spark, root, day).items()} == {
            "payments": 1,
            "recalls": names,
        }
    row = bronze.read_parts(spark, f"{root}/silver/payments", day, SILVER_PAYMENTS).first()
    assert (row["hcpcs_code"], row["ingested_at"], row["payment_gap_pct"]) == ("J1", stamp, None)


def test_declared_schema_fills_missing_columns(spark, tmp_path):
    path = str(tmp_path / "silver")
    spark.createDataFrame([("D-1",)], "recall_number string").write.parquet(f"{path}/ingest_date=2024-02-01")
    row = bronze.read_parts(spark, path, "2024-02-01", SILVER_RECALLS).first()
    assert row["recall_number"] == "D-1" and row["generic_name"] is None


@pytest.mark.parametrize("text", ["plain", "  spaced  "])
def test_template_text_has_no_head_line(text):
    from gramledger.plans.explain import template_text

    assert template_text(f"Explain.\nItem: {text}\nScore: 1") == f"Item: {text}; Score: 1"
