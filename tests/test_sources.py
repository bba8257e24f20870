"""Landing, pages, snapshot files and the incremental run."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from test_containment import plan_of

from gramledger.operators.enrich import written_explanations
from gramledger.schemas import BRONZE_RECALLS, SNAPSHOT
from gramledger.session import spread_small
from gramledger.sources import bronze, pages, snapshot
from gramledger.streaming.incremental import drop_repeats, land_new_files

ROW = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.StringType())])


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_replace_swaps_one_day_only(spark, tmp_path):
    path = str(tmp_path / "t")
    old = spark.createDataFrame([(1, "old"), (2, "old")], ROW)
    new = spark.createDataFrame([(3, "new")], ROW)
    assert bronze.write_dated(old, path, "2024-02-01")["rows"] == 2
    bronze.write_dated(old, path, "2024-02-02")
    done = bronze.write_dated(new, path, "2024-02-01")
    assert done == {"rows": 1, "schema": "struct<k:bigint,v:string>"}
    assert rows_of(bronze.read_parts(spark, path, "2024-02-01").select("k")) == [(3,)]
    assert bronze.read_parts(spark, path, "2024-02-02").count() == 2


def test_day_is_a_partition_filter(spark, tmp_path):
    path = str(tmp_path / "t")
    for day in ("2024-02-01", "2024-02-02"):
        bronze.write_dated(spark.createDataFrame([(1, "a")], ROW), path, day, fmt="json")
    df = bronze.read_dated_json(spark, path, ROW, "2024-02-01")
    assert df.count() == 1
    plan = plan_of(df)
    assert "PartitionFilters: [isnotnull(ingest_date" in plan.replace("\n", " ")


def test_append_repeats_and_newest_stays(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(1, "a"), (2, "b")], ROW)
    for stamp in ("2024-01-01", "2024-01-02"):
        bronze.write_dated(bronze.stamp_rows(rows, stamp), path, "2024-02-01", mode="append")
    landed = bronze.read_parts(spark, path).drop("ingest_date")
    assert landed.count() == 4
    kept = drop_repeats(landed, ["k"], "ingested_at")
    assert rows_of(kept) == [(1, "a", "2024-01-02"), (2, "b", "2024-01-02")]
    with pytest.raises(ValueError, match="mode"):
        bronze.write_dated(rows, path, "2024-02-01", mode="other")


def test_json_array_files(spark, tmp_path):
    folder = tmp_path / "t" / "ingest_date=2024-02-01"
    folder.mkdir(parents=True)
    (folder / "a.json").write_text(json.dumps([{"k": 1, "v": "a"}, {"k": 2}], indent=1))
    df = bronze.read_dated_json(spark, str(tmp_path / "t"), ROW, "2024-02-01", arrays=True)
    assert [tuple(r) for r in df.orderBy("k").select("k", "v").collect()] == [(1, "a"), (2, None)]


def test_parts_and_stack_match_by_name(spark, tmp_path):
    path = str(tmp_path / "t")
    a = spark.createDataFrame([(1, "a")], ROW)
    b = spark.createDataFrame([(2,), (2,)], "k long")
    a.write.parquet(path)
    b.write.mode("append").parquet(path)
    for df in (bronze.read_parts(spark, path), bronze.stack(a, b)):
        assert sorted((r["k"], r["v"]) for r in df.fillna("-").collect()) == [(1, "a"), (2, "-"), (2, "-")]


def test_run_date():
    assert bronze.run_date("2024-02-01") == "2024-02-01"
    assert len(bronze.run_date()) == 10
    with pytest.raises(ValueError):
        bronze.run_date("yesterday")


def page_files(tmp_path, sizes):
    first = 0
    for page, size in sizes.items():
        folder = tmp_path / "pages" / f"page={page}"
        folder.mkdir(parents=True)
        lines = [json.dumps({"k": first + i, "v": "Y"}) for i in range(size)]
        (folder / "a.json").write_text("\n".join(lines))
        first += size
    return str(tmp_path / "pages")


def test_pages_stop_at_the_first_empty_one(spark, tmp_path):
    path = page_files(tmp_path, {0: 5, 1: 3, 2: 0, 3: 4})
    assert pages.read_pages(spark, path, ROW).count() == 8
    assert pages.read_pages(spark, path, ROW, max_pages=1).count() == 5


def test_pages_without_a_first_page(spark, tmp_path):
    path = page_files(tmp_path, {0: 0, 1: 3})
    assert pages.read_pages(spark, path, ROW).count() == 0


def test_landed_pages(spark, tmp_path):
    df = spark.range(23).select(F.col("id").alias("k"), F.lit("Y").alias("v"))
    pages.land_pages(df, "k", str(tmp_path / "p"), page_size=10)
    back = pages.read_pages(spark, str(tmp_path / "p"), ROW)
    assert {r[0]: r[1] for r in back.groupBy("page").count().collect()} == {0: 10, 1: 10, 2: 3}


@pytest.mark.parametrize("lines", [True, False])
def test_envelopes(spark, tmp_path, lines):
    folder = tmp_path / "e"
    folder.mkdir()
    page = {"meta": {"total": 2}, "results": [{"recall_number": "D-1"}, {"recall_number": "D-2"}]}
    (folder / "a.json").write_text(json.dumps(page, indent=None if lines else 2))
    (folder / "b.json").write_text(json.dumps({"results": []}))
    df = pages.read_envelopes(spark, str(folder), BRONZE_RECALLS, lines=lines)
    assert [r[0] for r in df.select("recall_number").orderBy("recall_number").collect()] == ["D-1", "D-2"]


def test_live_feed_reads_a_page_per_task_and_filters_at_the_server(spark):
    def fetch(offset, size, wanted):
        kept = [(i, "Y") for i in range(25) if wanted.get("v", "Y") == "Y"]
        return kept[offset : offset + size]

    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(pages.paged_feed("test_feed", ROW, fetch))
    feed = spark.read.format("test_feed").options(pages=5, size=10).load()
    assert feed.rdd.getNumPartitions() == 5
    kept = pages.until_empty_page(feed)
    assert kept.count() == 25
    assert feed.where("v = 'Y'").count() == 25 and feed.where("v = 'N'").count() == 0


def test_snapshot_keeps_awkward_text(spark, tmp_path):
    text = 'two\nlines, "quoted" and a \\ slash'
    rows = [("A", None, 1.0, 1.5, None, None, -2.25, "Low", 0, 0, "None", 3.5, text)]
    rows += [("B", " ", 0.1, 1.0, 1.0, 1.0, 1e9, "High", 3, 1, "Low", 99.9, None)]
    df = spark.createDataFrame(rows, SNAPSHOT).toDF(*[c.lower() for c in SNAPSHOT.names])
    snapshot.write_snapshot(df, str(tmp_path / "s"))
    back = snapshot.read_snapshot(spark, str(tmp_path / "s"))
    assert [tuple(r) for r in back.orderBy("hcpcs_code").collect()] == rows


def test_table_and_view_names(spark, tmp_path):
    df = spark.createDataFrame([(1, "a")], ROW)
    snapshot.register_views(scored_view=df)
    assert spark.sql("SELECT v FROM scored_view WHERE K = 1").first()[0] == "a"
    spark.sql(f"CREATE DATABASE export LOCATION '{tmp_path}/db'")
    for _ in range(2):
        snapshot.save_table(df, "export.rows", upper_names=True)
    assert spark.table("export.rows").columns == ["K", "V"] and spark.table("export.rows").count() == 1


def test_incremental_run_takes_each_key_once(spark, tmp_path):
    source, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))

    def run():
        land_new_files(
            spark, source, ROW, lambda df: df.withColumn("v", F.upper("v")), ["k", "v"], target, state
        ).awaitTermination()
        return rows_of(spark.read.parquet(target))

    spark.createDataFrame([(1, "a"), (1, "A"), (2, None)], ROW).coalesce(1).write.json(source)
    assert sorted(map(str, run())) == ["(1, 'A')", "(2, None)"]
    assert len(run()) == 2
    spark.createDataFrame([(1, "a"), (2, None), (3, "c")], ROW).coalesce(1).write.mode("append").json(source)
    assert sorted(map(str, run())) == ["(1, 'A')", "(2, None)", "(3, 'C')"]


def test_spread_moves_only_rows_in_few_splits(spark, tmp_path):
    one, many = str(tmp_path / "one"), str(tmp_path / "many")
    spark.range(1000).coalesce(1).write.parquet(one)
    spark.range(1000).repartition(40).write.option("maxRecordsPerFile", 10).parquet(many)
    spread = spread_small(spark.read.parquet(one))
    assert spread.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert spread.count() == 1000
    assert "Exchange" not in plan_of(spread_small(spark.read.parquet(many)))


def test_document_ids_as_text(spark):
    df = bronze.documents_as_rows(spark.createDataFrame([(7, "a")], "_id long, v string"))
    assert df.dtypes[0] == ("_id", "string")


def test_explanations_replace_a_table(spark, tmp_path):
    spark.sql(f"CREATE DATABASE texts LOCATION '{tmp_path}/db'")
    rows = spark.createDataFrame(
        [("A", "desc", 3.5, " words ", "ok"), ("B", "desc", 2.5, None, "failed")],
        "hcpcs_code string, drug_desc string, combined_risk_score double, ai_explanation string, status string",
    )
    for stamp in ("2024-01-01T00:00:00", "2024-01-02T00:00:00"):
        snapshot.save_table(written_explanations(rows, stamp), "texts.explanations")
    table = spark.table("texts.explanations")
    assert [str(r["generated_at"]) for r in table.collect()] == ["2024-01-02 00:00:00"]
    assert table.dtypes[-1] == ("generated_at", "timestamp")


def test_incremental_run_leaves_the_session_as_it_was(spark, tmp_path):
    spark.createDataFrame([(1, "a")], ROW).write.json(str(tmp_path / "in"))
    names = ["spark.sql.shuffle.partitions", "spark.sql.streaming.stateStore.providerClass"]
    before = [spark.conf.get(n) for n in names]
    query = land_new_files(
        spark, str(tmp_path / "in"), ROW, lambda df: df, ["k"], str(tmp_path / "out"), str(tmp_path / "s"), partitions=3
    )
    query.awaitTermination()
    assert [spark.conf.get(n) for n in names] == before
    assert len(list((tmp_path / "s" / "state" / "0").glob("[0-9]*"))) == 3


def test_incremental_run_with_one_key_over_and_over(spark, tmp_path):
    source, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    rows = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id")).alias("k"), F.lit("x").alias("v")
    )
    rows.write.json(source)
    query = land_new_files(spark, source, ROW, lambda df: df, ["k"], target, state)
    query.awaitTermination()
    assert spark.read.parquet(target).count() == 6001
    deduplicated = next(s for p in query.recentProgress for s in p.stateOperators if s.numRowsUpdated)
    assert deduplicated.numRowsUpdated == 6001
    dropped = sum(s.customMetrics.get("numDroppedDuplicateRows", 0) for p in query.recentProgress for s in p.stateOperators)
    assert dropped < 100


def test_days_and_pages_are_not_scattered_over_files(spark, tmp_path):
    df = spark.range(0, 4000, 1, 8).select(
        F.col("id").alias("k"), F.expr("date_add(date'2024-01-01', cast(id % 5 as int))").alias("ingest_date")
    )
    bronze.write_dated(df, str(tmp_path / "days"))
    pages.land_pages(df.select("k"), "k", str(tmp_path / "pages"), page_size=1000)
    for folder, parts in (("days", 5), ("pages", 4)):
        files = list((tmp_path / folder).glob("*=*/part-*"))
        assert len(files) == parts
    assert bronze.read_parts(spark, str(tmp_path / "days")).count() == 4000


def test_landed_json_is_compressed_in_files_of_bounded_size(spark, tmp_path, monkeypatch):
    monkeypatch.setitem(bronze.LANDED_JSON, "maxRecordsPerFile", 300)
    rows = spark.range(0, 1000, 1, 2).select(F.col("id").alias("k"), F.lit("Y").alias("v"))
    for mode in ("replace", "append"):
        bronze.write_dated(rows, str(tmp_path / "days"), "2024-02-01", fmt="json", mode=mode)
    files = list((tmp_path / "days").glob("*=*/part-*"))
    text = sum(len(f'{{"k":{k},"v":"Y"}}\n') for k in range(1000))
    assert len(files) == 2 * 4 and all(f.name.endswith(".json.gz") for f in files)
    assert sum(f.stat().st_size for f in files) < 2 * text / 2
    back = bronze.read_dated_json(spark, str(tmp_path / "days"), ROW, "2024-02-01")
    assert sorted(r["k"] for r in back.collect()) == sorted([*range(1000)] * 2)


def test_landed_pages_are_compressed(spark, tmp_path):
    df = spark.range(2000).select(F.col("id").alias("k"), F.lit("Y").alias("v"))
    pages.land_pages(df, "k", str(tmp_path / "p"), page_size=1000)
    files = list((tmp_path / "p").glob("page=*/part-*"))
    assert len(files) == 2 and all(f.name.endswith(".json.gz") for f in files)
    assert sum(f.stat().st_size for f in files) < sum(len(f'{{"k":{k},"v":"Y"}}\n') for k in range(2000)) / 2
    assert pages.read_pages(spark, str(tmp_path / "p"), ROW).count() == 2000


def test_small_pages_share_folders(spark, tmp_path):
    rows = spark.range(1000).select(F.col("id").alias("k"), F.lit("Y").alias("v")).where("k not between 470 and 479")
    path = str(tmp_path / "p")
    pages.land_pages(rows, "k", path, page_size=10, folder_pages=25)
    assert len(list((tmp_path / "p").glob("pages=*/part-*"))) == 4
    found = pages.read_pages(spark, path, ROW, folder_pages=25)
    assert found.columns == ["k", "v", "page"]
    assert sorted((r["k"], r["page"]) for r in found.collect()) == [(k, k // 10) for k in range(470)]
    assert pages.read_pages(spark, path, ROW, max_pages=7, folder_pages=25).count() == 70
    assert pages.read_pages(spark, path, ROW, max_pages=30, folder_pages=25).count() == 300
