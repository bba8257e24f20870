"""Records that don't fit are kept apart with their text, and no record is lost."""

from __future__ import annotations

from pyspark.sql import types as T

from gramledger.sources import bronze

SCHEMA = T.StructType(
    [
        T.StructField("k", T.LongType()),
        T.StructField("v", T.DoubleType()),
        T.StructField("inner", T.StructType([T.StructField("d", T.DateType())])),
    ]
)
LINES = [
    '{"k": 1, "v": 1.5, "inner": {"d": "2024-01-01"}}',
    '{"k": 2, "v": "much", "inner": {"d": "2024-01-01"}}',
    '{"k": 3, "v": 1.5, "inner": {"d": "yesterday"}}',
    '{"k": 4, "v": 1.5',
    "no json at all",
    '{"k": null, "v": 2.0}',
    '{"v": 2.0, "more": "fields"}',
    '{"k": 5}',
    "",
    '{"k": 1, "v": 1.5, "inner": {"d": "2024-01-01"}}',
]


def landed(spark, tmp_path, day="2024-01-01", **options):
    target, quarantine = str(tmp_path / "landed"), str(tmp_path / "quarantine")
    counts = bronze.land_checked(spark, str(tmp_path / "in"), SCHEMA, target, quarantine, day, **options)
    good = sorted(((r["k"], r["v"]) for r in bronze.read_parts(spark, target, day).collect()), key=str)
    bad = [(r["reason"], r["raw"]) for r in bronze.read_parts(spark, quarantine, day).collect()]
    return counts, good, sorted(bad)


def write(spark, tmp_path, lines):
    spark.createDataFrame([(x,) for x in lines], "value string").repartition(3).write.mode("overwrite").text(str(tmp_path / "in"))


def test_good_and_quarantined_are_all(spark, tmp_path):
    write(spark, tmp_path, LINES)
    counts, good, bad = landed(spark, tmp_path, required=["k"])
    assert counts == {"came": 9, "landed": 3, "quarantined": 6}
    assert good == [(1, 1.5), (1, 1.5), (5, None)]
    assert [r for r, _ in bad] == ["missing"] * 2 + ["not_json"] * 2 + ["wrong_type"] * 2
    assert {raw for r, raw in bad if r != "missing"} == {LINES[i] for i in (1, 2, 3, 4)}
    assert {raw for r, raw in bad if r == "missing"} == {'{"v":2.0}'}


def test_mended_day_leaves_no_quarantine(spark, tmp_path):
    write(spark, tmp_path, LINES)
    landed(spark, tmp_path)
    landed(spark, tmp_path, day="2024-01-02")
    write(spark, tmp_path, LINES[:1])
    counts, good, bad = landed(spark, tmp_path)
    assert (counts, good, bad) == ({"came": 1, "landed": 1, "quarantined": 0}, [(1, 1.5)], [])
    assert bronze.read_parts(spark, str(tmp_path / "quarantine"), "2024-01-02").count() == 4


def test_array_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text("[" + LINES[0] + ",\n" + LINES[1] + "]")
    (tmp_path / "in" / "b.json").write_text("[" + LINES[0] + ",\n" + LINES[3])
    counts, good, bad = landed(spark, tmp_path, arrays=True)
    assert counts["came"] == counts["landed"] + counts["quarantined"] and good == [(1, 1.5)]
    assert {r for r, _ in bad} == {"wrong_type", "not_json"}


def test_empty_folder(spark, tmp_path):
    write(spark, tmp_path, [])
    assert landed(spark, tmp_path)[0] == {"came": 0, "landed": 0, "quarantined": 0}
