"""From landed JSON text to the scored table, its checks and the dashboard tables."""

from __future__ import annotations

from datetime import date

import fixtures as X
import pytest
from pyspark.sql import functions as F

from gramledger.operators.quality import run_checks
from gramledger.plans import board, explain, gold
from gramledger.plans.silver import silver_payments, silver_recalls
from gramledger.schemas import BRONZE_PAYMENTS, BRONZE_RECALLS
from gramledger.sources import bronze, snapshot


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("landed")
    payments = X.land_array(root / "payments", X.payment_documents())
    recalls = X.land_array(root / "recalls", X.recall_documents())
    silver_p = silver_payments(bronze.read_json_array(spark, payments, BRONZE_PAYMENTS))
    silver_r = silver_recalls(bronze.read_json_array(spark, recalls, BRONZE_RECALLS))
    staged_p, staged_r = gold.staged_payments(silver_p), gold.staged_recalls(silver_r)
    summary = gold.recall_summary(staged_r)
    return {
        "silver_payments": silver_p,
        "silver_recalls": silver_r,
        "staged_payments": staged_p,
        "staged_recalls": staged_r,
        "summary": summary,
        "scored": gold.scored_table(staged_p, summary),
    }


def test_row_counts(tables):
    assert tables["silver_payments"].count() == 9
    assert tables["silver_recalls"].count() == 9
    assert tables["staged_recalls"].count() == 7


def test_summary(tables):
    rows = {r[0]: tuple(r[1:]) for r in tables["summary"].collect()}
    assert rows == X.SUMMARY


def test_scored(tables):
    columns = (
        "total_providers total_services avg_submitted_charge avg_medicare_allowed avg_medicare_paid "
        "payment_gap_pct dollar_impact generic_name_clean total_recalls worst_severity_rank ongoing_recalls "
        "distinct_manufacturers cost_risk_tier safety_risk_tier combined_risk_score"
    ).split()
    rows = {r["hcpcs_code"]: [r[c] for c in columns] for r in tables["scored"].collect()}
    assert set(rows) == set(X.SCORED)
    for code, wanted in X.SCORED.items():
        for column, got, expected in zip(columns, rows[code], wanted, strict=True):
            if isinstance(expected, int | float):
                assert got == pytest.approx(expected, abs=1e-6), (code, column)
            else:
                assert got == expected, (code, column)
    latest = {r["hcpcs_code"]: r["most_recent_recall_date"] for r in tables["scored"].collect()}
    assert latest["J0001"] == date(2024, 3, 1) and latest["J0004"] is None
    assert len(tables["scored"].columns) == 18


def test_every_match_before_the_choice(tables):
    matched = gold.matched_payments(tables["staged_payments"], tables["summary"])
    per_code = {r[0]: r[1] for r in matched.groupBy("hcpcs_code").count().collect()}
    assert sum(per_code.values()) == 9
    assert per_code["J0002"] == per_code["J0003"] == 2


@pytest.mark.parametrize("strategy", ["scan", "grams", "shuffle"])
def test_strategies_score_alike(tables, strategy):
    other = gold.scored_table(tables["staged_payments"], tables["summary"], strategy)
    assert other.exceptAll(tables["scored"]).isEmpty() and tables["scored"].exceptAll(other).isEmpty()


def test_checks(tables):
    report = run_checks(tables, gold.CHECKS).collect()
    assert len(report) == 10
    failed = {(r["table_name"], r["column_name"], r["check_name"]): r["failures"] for r in report if not r["passed"]}
    assert failed == {
        ("staged_payments", "payment_gap_pct", "not_null"): 1,
        ("staged_recalls", "classification", "accepted_values"): 1,
    }


def test_repeated_codes_are_caught(tables):
    """Without the rollup, or without the choice of one match, codes repeat."""
    national = tables["silver_payments"].where("geography = 'National'")
    matched = gold.matched_payments(tables["staged_payments"], tables["summary"])
    for frame, failures in ((national, 1), (matched, 2)):
        unique = [c for c in gold.CHECKS if c.kind == "unique" and c.table == "scored"]
        assert run_checks({"scored": frame}, unique).first()["failures"] == failures


def test_services_are_conserved(tables):
    before = tables["silver_payments"].where("geography = 'National'").agg(F.sum("total_services")).first()[0]
    assert tables["staged_payments"].agg(F.sum("total_services")).first()[0] == before


def test_board_and_snapshot(spark, tables, tmp_path):
    texts = explain.explanations(tables["scored"], "2024-02-01T00:00:00", n=3, pause=0)
    path = str(tmp_path / "snapshot")
    snapshot.write_snapshot(explain.snapshot_rows(tables["scored"], texts), path)
    files = sorted(p for p in (tmp_path / "snapshot").iterdir() if p.suffix == ".csv")
    assert files[0].read_text().splitlines()[0].split(",")[0] == "HCPCS_CODE"
    ordered = [line.split(",")[0] for f in files for line in f.read_text().splitlines()[1:]]
    assert ordered == ["J0002", "J0001", "J0003", "J0007", "J0005", "J0004", "J0006"]

    snap = snapshot.read_snapshot(spark, path)
    page = board.board(snap)
    assert page["kpis"].first().asDict() == {
        "items": 7,
        "high_cost_items": 1,
        "items_with_recalls": 5,
        "total_impact": pytest.approx(31256),
    }
    assert [r[0] for r in page["cost_options"].collect()] == ["High", "Low", "Medium"]
    assert [r[0] for r in page["safety_options"].collect()] == ["High", "Low", "Medium", "None"]
    assert page["table"].count() == 7
    shown = [r["explanation"] for r in page["texts"].collect()]
    assert shown[0].startswith("Item: Injection, heparin") and shown[3].startswith("No AI explanation")
    labels = [r["short_label"] for r in page["chart"].collect()]
    assert labels[0] == "Injection, heparin sodium and ..." and labels[3] == "Infusion, zeta, 1 mg"
    some = board.board(snap, cost=["Low"], safety=["None"])
    assert [r[0] for r in some["chart"].collect()] == ["Injection, nomatch, 1 mg", "Injection, overpaid, 1 mg"]
    assert some["kpis"].first()["items"] == 7


def test_prompt_holds_the_figures(tables):
    prompts = {r["hcpcs_code"]: r["prompt"] for r in explain.with_prompts(tables["scored"]).collect()}
    assert "Money impact: $30,030" in prompts["J0001"] and "payment: 60.0%" in prompts["J0001"]
    assert "payment: n/a%" in prompts["J0005"] and "Score: 50.0" in prompts["J0005"]


def test_empty_nested_struct_everywhere(spark, tmp_path):
    rows = [{"recall_number": "D-1", "openfda": {}}, {"recall_number": "D-2"}]
    path = X.land_array(tmp_path / "recalls", rows)
    silver = silver_recalls(bronze.read_json_array(spark, path, BRONZE_RECALLS))
    assert [(r["recall_number"], r["generic_name"]) for r in silver.orderBy("recall_number").collect()] == [
        ("D-1", None),
        ("D-2", None),
    ]


def test_bad_numbers_and_zero_charge(spark, tmp_path):
    document = X.payment_documents()[0]
    bad = {**document, "record": {**document["record"], "Tot_Srvcs": "12x"}}
    zero = {**document, "record": {**document["record"], "Avg_Sbmtd_Chrg": "0"}}
    path = X.land_array(tmp_path / "payments", [bad, zero])
    rows = silver_payments(bronze.read_json_array(spark, path, BRONZE_PAYMENTS)).collect()
    assert rows[0]["total_services"] is None and rows[0]["dollar_impact"] is None
    assert rows[1]["payment_gap_pct"] is None and rows[1]["dollar_impact"] == pytest.approx(-8000)
