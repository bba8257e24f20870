"""Rollup, expressions, checks, enrichment and serving operators."""

from __future__ import annotations

import time

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from test_containment import plan_of

from gramledger.functions import columns as C
from gramledger.operators.enrich import enrich_rows
from gramledger.operators.flatten import explode_keep
from gramledger.operators.quality import ACCEPTED, NOT_NULL, UNIQUE, Check, run_checks
from gramledger.operators.rollup import history_summary, weighted_rollup
from gramledger.operators.serving import board_filter, newest, top_n, value_options


def test_weighted_rollup_equal_weights_is_the_average(spark):
    df = spark.createDataFrame([("a", 2.0, 1.0), ("a", 2.0, 4.0), ("b", 0.0, 9.0)], "k string, w double, v double")
    rows = {r["k"]: r["v"] for r in weighted_rollup(df, "k", "w", ["v"]).collect()}
    assert rows == {"a": 2.5, "b": None}


def test_weighted_rollup_null_measure(spark):
    df = spark.createDataFrame([("a", 1.0, None), ("a", 3.0, 8.0)], "k string, w double, v double")
    assert weighted_rollup(df, "k", "w", ["v"]).first()["v"] == 6.0
    assert weighted_rollup(df, "k", "w", ["v"], null_weight="drop").first()["v"] == 8.0


def test_weighted_rollup_carries_the_greatest_text(spark):
    rows = [("a", 1.0, 1.0, "x"), ("a", 1.0, 2.0, "y"), ("a", 2.0, 2.0, None), (None, 1.0, 5.0, "z")]
    df = spark.createDataFrame(rows, "k string, w double, v double, t string")
    out = {r["k"]: (r["w"], r["v"], r["t"]) for r in weighted_rollup(df, "k", "w", ["v"], ["w"], ["t"]).collect()}
    assert out == {"a": (4.0, 1.75, "y"), None: (1.0, 5.0, "z")}


def test_rollup_hashes_the_many_rows(spark):
    df = spark.createDataFrame([("a", 1.0, 1.0, "x")], "k string, w double, v double, t string")
    assert "SortAggregate" not in plan_of(weighted_rollup(df, "k", "w", ["v"], ["w"]))
    carried = plan_of(weighted_rollup(df, "k", "w", ["v"], ["w"], ["t"]))
    assert carried.index("SortAggregate") < carried.index("HashAggregate")


def test_repeated_name_in_one_recall_counts_twice(spark):
    df = spark.createDataFrame([("r1", ["x", " X "])], "n string, names array<string>")
    rows = explode_keep(df, "names", "name", ["n"]).select(
        C.clean_name(F.col("name")).alias("generic_name_clean"),
        F.lit(1).alias("severity_rank"),
        F.lit(None).cast("date").alias("report_date"),
        F.lit("Ongoing").alias("status"),
        F.lit("f").alias("recalling_firm"),
    )
    row = history_summary(rows).first()
    assert (row["total_recalls"], row["ongoing_recalls"], row["distinct_manufacturers"]) == (2, 2, 1)


def test_explode_keeps_null_and_empty(spark):
    df = spark.createDataFrame([(1, None), (2, []), (3, [None, "a"])], "k int, names array<string>")
    rows = sorted((r["k"], r["n"] or "") for r in explode_keep(df, "names", "n", ["k"]).collect())
    assert rows == [(1, ""), (2, ""), (3, ""), (3, "a")]


@pytest.mark.parametrize(
    ("text", "wanted"), [("20240115", "2024-01-15"), ("2024-01-15", "2024-01-15"), ("garbage", None), (None, None)]
)
def test_report_date(spark, text, wanted):
    got = spark.createDataFrame([(text,)], "d string").select(C.report_date(F.col("d"))).first()[0]
    assert (got and got.isoformat()) == wanted


def test_tiers_at_their_limits(spark):
    df = spark.createDataFrame([(75.0,), (74.999,), (40.0,), (39.999,), (None,)], "g double")
    assert [r[0] for r in df.select(C.tier_by_limit(F.col("g"))).collect()] == ["High", "Medium", "Medium", "Low", "Low"]


def test_score_grows_with_ongoing_recalls(spark):
    df = spark.range(5).select(
        C.risk_score(F.lit(10.0), F.lit(1), F.lit(2), F.col("id")).alias("s"), F.col("id")
    )
    scores = [r["s"] for r in df.orderBy("id").collect()]
    assert scores == [50.0, 60.0, 70.0, 80.0, 90.0]


@pytest.mark.parametrize(("length", "wanted"), [(29, 29), (30, 30), (31, 33)])
def test_short_label(spark, length, wanted):
    label = spark.createDataFrame([("é" * length,)], "t string").select(C.short_label(F.col("t"))).first()[0]
    assert len(label) == wanted and label.endswith("...") == (length > 30)


def test_checks_flag_exactly_the_bad_rows(spark):
    rows = [("a", "Low"), ("a", "Odd"), (None, None), (None, "High"), ("b", "Odd")]
    df = spark.createDataFrame(rows, "k string, t string")
    checks = [Check("t", "k", NOT_NULL), Check("t", "k", UNIQUE), Check("t", "t", ACCEPTED, ("Low", "High"))]
    got = {r["check_name"]: (r["failures"], r["passed"]) for r in run_checks({"t": df}, checks).collect()}
    assert got == {"not_null": (2, False), "unique": (1, False), "accepted_values": (2, False)}


def test_top_n_keeps_n_rows_per_task(spark):
    df = spark.range(1000).select(
        F.col("id").cast("string").alias("hcpcs_code"), (F.col("id") % 7).alias("combined_risk_score")
    )
    top = top_n(df, 3)
    assert [r["hcpcs_code"] for r in top.collect()] == ["104", "111", "118"]
    assert "TakeOrderedAndProject" in plan_of(top)


def test_newest_takes_whole_pages(spark):
    day = F.expr("date_add(date'2024-01-01', cast(id % 10 as int))")
    top = newest(spark.range(100).select(F.col("id").alias("k"), day.alias("d")), "d", "k", 20)
    assert top.count() == 20 and top.where("d < date'2024-01-09'").isEmpty()
    with pytest.raises(TypeError, match="date"):
        newest(spark.range(3), "id", "id", 2)


def test_filter_defaults_to_all_present_values(spark):
    df = spark.createDataFrame([("a", "x"), ("b", None), (None, "y")], "p string, q string")
    assert board_filter(df, {"p": None, "q": None}).count() == 1
    assert board_filter(df, {"p": ["b"]}).count() == 1
    assert [r[0] for r in value_options(df, "p").collect()] == ["a", "b"]


def test_enrichment_retries_and_isolates(spark, tmp_path):
    log = str(tmp_path / "calls")

    def shaky(prompt):
        with open(log, "a") as f:
            f.write(prompt + "\n")
        with open(log) as f:
            calls = f.read().split().count(prompt)
        if prompt == "quota" and calls < 3:
            raise RuntimeError("QUOTA spent")
        if prompt == "busy":
            raise RuntimeError("BUSY now")
        if prompt == "broken":
            raise ValueError("no such thing")
        return f" {prompt}! "

    df = spark.createDataFrame([("fine",), ("quota",), ("busy",), ("broken",)], "p string")
    out = enrich_rows(df, "p", shaky, quota_wait=0, busy_wait=0, pause=0)
    rows = {r["p"]: (r["ai_explanation"], r["status"], r["attempts"], r["error"]) for r in out.collect()}
    assert rows == {
        "fine": ("fine!", "ok", 1, None),
        "quota": ("quota!", "ok", 3, None),
        "busy": (None, "failed", 4, "BUSY now"),
        "broken": (None, "failed", 1, "no such thing"),
    }


def test_enrichment_paces_over_lanes(spark):
    df = spark.range(6).select(F.col("id").cast("string").alias("p"))
    start = time.time()
    assert enrich_rows(df, "p", lambda p: p, pause=0.1, lanes=2).count() == 6
    assert time.time() - start >= 0.5


@pytest.mark.parametrize("n", [1, 3, 5, 7, 8, 20])
def test_newest_with_missing_dates(spark, n):
    rows = [(i, day) for i, day in enumerate(["b", "a", None, "c", "b", "a", None, "c"])]
    days = {"a": "2024-01-01", "b": "2024-01-02", "c": "2024-01-03", None: None}
    df = spark.createDataFrame([(i, days[d]) for i, d in rows], "k int, d string")
    df = df.withColumn("d", F.col("d").cast("date"))
    got = [r["k"] for r in newest(df, "d", "k", n).collect()]
    assert got == [3, 7, 0, 4, 1, 5, 2, 6][:n]


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.tuples(
            st.sampled_from(["a", "b", None]),
            st.one_of(st.none(), st.integers(0, 9)),
            st.one_of(st.none(), st.integers(-9, 9)),
            st.sampled_from(["x", "y"]),
        ),
        min_size=1,
        max_size=30,
    )
)
def test_rollup_against_a_plain_loop(spark, rows):
    df = spark.createDataFrame(rows, "k string, w int, v int, t string")
    wanted = {}
    for key in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == key]
        weights = [w for _, w, _, _ in mine if w is not None]
        products = [w * v for _, w, v, _ in mine if w is not None and v is not None]
        average = sum(products) / sum(weights) if products and sum(weights) else None
        wanted[key] = (max(r[3] for r in mine), sum(weights) if weights else None, average)
    rolled = weighted_rollup(df, "k", "w", ["v"], ["w"], ["t"]).collect()
    assert {r["k"]: (r["t"], r["w"], r["v"]) for r in rolled} == wanted
