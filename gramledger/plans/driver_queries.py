"""One query per operator over the driver's tables. Each reads its tables whole."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gramledger.functions import columns as C
from gramledger.operators.best_match import best_match, longest_then_worst
from gramledger.operators.containment import best_contained, contains_join
from gramledger.operators.enrich import enrich_stored, read_store
from gramledger.operators.flatten import add_gap_and_impact, explode_keep, flatten_fields
from gramledger.operators.partials import history_partials, merge_histories, merge_rollups, rollup_partials
from gramledger.operators.quality import ACCEPTED, NOT_NULL, UNIQUE, Check, run_checks
from gramledger.operators.rollup import weighted_rollup
from gramledger.operators.serving import board_filter, kpi_row, newest, top_n, value_options
from gramledger.operators.uniqueness import key_states, repeated_keys
from gramledger.plans import board, daily, explain, gold
from gramledger.plans import driver_tables as D
from gramledger.plans.silver import silver_payments, silver_recalls
from gramledger.schemas import BRONZE_PAYMENTS, BRONZE_RECALLS, PAYMENT_RECORD
from gramledger.session import bounded_parts, fresh_path, materialize, parts_of, spread_small
from gramledger.sources import bronze, pages, snapshot
from gramledger.sources.published import publish_days, published_rows, read_published
from gramledger.streaming.incremental import drop_repeats, land_new_files, land_recent_files

RUN_TS = "2024-02-01T00:00:00"
DAY, OTHER_DAY = "2024-02-01", "2024-02-02"
FEED_PAGE = 500
BUCKETS = 16

ORDER_RECORD = T.StructType(
    [
        T.StructField("o_orderkey", T.LongType()),
        T.StructField("o_custkey", T.LongType()),
        T.StructField("o_orderstatus", T.StringType()),
        T.StructField("o_totalprice", T.DoubleType()),
        T.StructField("o_orderdate", T.StringType()),
        T.StructField("o_orderpriority", T.StringType()),
    ]
)
STAMPED_ORDER = T.StructType([*ORDER_RECORD.fields, T.StructField("ingested_at", T.StringType())])


def settled(df: DataFrame, **places: int) -> DataFrame:
    """Sums of doubles depend on the order of the rows in their last digits; round these off."""
    return df.withColumns({c: F.round(F.col(c), n) for c, n in places.items()})


def settled_scores(df: DataFrame) -> DataFrame:
    measures = [*gold.AVERAGES, "payment_gap_pct", "dollar_impact"]
    return settled(df, **{c: 6 for c in measures if c in df.columns})


def order_records(spark: SparkSession, folder: str) -> DataFrame:
    day = F.date_format("o_orderdate", "yyyyMMdd").alias("o_orderdate")
    others = [c for c in ORDER_RECORD.fieldNames() if c != "o_orderdate"]
    return D.table(spark, folder, "orders").select(*others, day).select(*ORDER_RECORD.fieldNames())


# Projections, generators, expressions


def flatten_json(spark: SparkSession, folder: str) -> DataFrame:
    """Event records; those of errors hold text where a number belongs."""
    k = F.from_json("props", "k string")["k"]
    said = F.when(F.col("event_type") == "error", F.concat(k, F.lit(" units"))).otherwise(k)
    parsed = D.table(spark, folder, "events").select("event_id", F.struct(said.alias("k")).alias("record"))
    return flatten_fields(parsed, ("event_id",), {"k_text": "record.k"}, {"k": "record.k"})


def row_gap_impact(spark: SparkSession, folder: str) -> DataFrame:
    return add_gap_and_impact(D.awkward_payments(spark, folder))


def explode_names(spark: SparkSession, folder: str) -> DataFrame:
    split = D.table(spark, folder, "part").select("p_partkey", F.split("p_name", " ").alias("names"))
    rows = explode_keep(split, "names", "name", ["p_partkey"])
    return rows.select("p_partkey", C.clean_name(F.col("name")).alias("name"))


def explode_outer_keep(spark: SparkSession, folder: str) -> DataFrame:
    named = F.col("p_type").isin("LARGE", "SMALL", "MEDIUM")
    none = F.when(F.col("p_type") == "PROMO", F.array().cast("array<string>"))
    arrays = D.table(spark, folder, "part").select(
        "p_partkey", F.when(named, F.split("p_name", " ")).otherwise(none).alias("names")
    )
    return explode_keep(arrays, "names", "name", ["p_partkey"])


def severity_case(spark: SparkSession, folder: str) -> DataFrame:
    rank = C.severity_rank(F.col("o_orderpriority"), D.PRIORITY_RANKS)
    return D.table(spark, folder, "orders").select(
        "o_orderkey", rank.cast("long").alias("severity_rank")
    )


def parse_date(spark: SparkSession, folder: str) -> DataFrame:
    """Eight-digit dates; urgent orders write theirs in ISO form, low ones write none that can be read."""
    digits, priority = F.col("o_orderdate"), F.col("o_orderpriority")
    iso = F.concat_ws("-", digits.substr(1, 4), digits.substr(5, 2), digits.substr(7, 2))
    text = F.when(priority == D.URGENT, iso).when(priority == "5-LOW", F.lit("unknown")).otherwise(digits)
    return order_records(spark, folder).select("o_orderkey", C.report_date(text).alias("report_date"))


def short_label(spark: SparkSession, folder: str) -> DataFrame:
    return D.table(spark, folder, "documents").select(
        "doc_id", C.short_label(F.col("text")).alias("short_label")
    )


def tiers(spark: SparkSession, folder: str) -> DataFrame:
    """Tiers and score per order line: discount as gap, later line numbers as recalls."""
    lines = D.table(spark, folder, "lineitem")
    orders = D.table(spark, folder, "orders")
    rank = C.severity_rank(F.col("o_orderpriority"), D.PRIORITY_RANKS)
    ongoing = F.when(F.col("o_orderstatus") == D.ONGOING_STATUS, 1).otherwise(0)
    rows = lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        "l_quantity",
        "l_extendedprice",
        (F.col("l_linenumber") - 1).alias("recalls"),
        rank.alias("worst"),
        ongoing.alias("ongoing"),
        F.try_divide(F.col("l_extendedprice"), F.col("l_quantity")).alias("unit"),
    )
    gap = F.col("unit") / 100
    return rows.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        "l_quantity",
        "l_extendedprice",
        C.tier_by_limit(gap).alias("cost_tier"),
        C.safety_tier(F.col("recalls"), F.col("worst")).alias("safety_tier"),
        C.risk_score(gap, F.col("recalls"), F.col("worst"), F.col("ongoing")).alias("score"),
    )


def render_prompt(spark: SparkSession, folder: str) -> DataFrame:
    return explain.with_prompts(settled_scores(D.scored(spark, folder))).select("hcpcs_code", "prompt")


# Aggregations


def weighted_rollup_query(spark: SparkSession, folder: str) -> DataFrame:
    """Every line, with its description carried through the rollup; some measures and weights are missing."""
    lines = D.awkward_payments(spark, folder).join(D.descriptions(spark, folder), "hcpcs_code")
    rolled = weighted_rollup(
        lines, "hcpcs_code", "total_services", gold.AVERAGES, gold.TOTALS, carry=("drug_desc",)
    )
    return settled_scores(add_gap_and_impact(rolled))


def rollup_by_days(spark: SparkSession, folder: str) -> DataFrame:
    """The same rollup from the states of three days; the second day was published with half its rows and replaced."""
    path = fresh_path(spark, "states")
    lines = D.awkward_payments(spark, folder).join(D.descriptions(spark, folder), "hcpcs_code")
    args = ("hcpcs_code", "total_services", gold.AVERAGES, gold.TOTALS, ("drug_desc",))
    day = F.pmod(F.xxhash64("hcpcs_code", "total_services"), F.lit(3))
    half = F.pmod(F.xxhash64("total_services", "hcpcs_code"), F.lit(2)) == 0
    deliveries = [(0, lines.where(day == 0)), (1, lines.where((day == 1) & half)), (2, lines.where(day == 2))]
    for n, rows in [*deliveries, (1, lines.where(day == 1))]:
        states = rollup_partials(rows, *args)
        publish_days(states, path, f"2024-02-0{n + 1}")
    merged = merge_rollups(read_published(spark, path, states.schema), *args)
    return settled_scores(add_gap_and_impact(merged))


def history_by_days(spark: SparkSession, folder: str) -> DataFrame:
    """The summary of all notices from the states of their years, of which the later ones were published twice."""
    path = fresh_path(spark, "states")
    staged = D.staged_notices(spark, folder)
    year = F.trunc("report_date", "year")
    dated = staged.withColumn(bronze.INGEST_DATE, F.coalesce(year, F.lit("1900-01-01").cast("date")))
    late = F.col(bronze.INGEST_DATE) >= "1996-01-01"
    day = [bronze.INGEST_DATE]
    ongoing = D.ONGOING_STATUS
    states = history_partials(dated.where(late), ongoing=ongoing, by=day)
    with bounded_parts(spark, D.table(spark, folder, "lineitem").count()):
        publish_days(history_partials(dated.where(~late | (F.col("status") != ongoing)), ongoing=ongoing, by=day), path)
        publish_days(states, path)
    parts = parts_of(published_rows(spark, path))
    return _wide_rank(merge_histories(read_published(spark, path, states.schema), parts=parts))


def staged_payments(spark: SparkSession, folder: str) -> DataFrame:
    return settled_scores(D.staged(spark, folder))


def staged_payments_carry(spark: SparkSession, folder: str) -> DataFrame:
    """The same with the text on every row, as the daily run has it."""
    rows = D.payments(spark, folder).join(D.descriptions(spark, folder), "hcpcs_code")
    return settled_scores(gold.staged_payments(rows, national=D.RANKED_GEOGRAPHY))


def staged_bucketed(spark: SparkSession, folder: str) -> DataFrame:
    """The same from tables that lie in buckets of the code, so that neither rollup nor join moves a row."""
    saved = {}
    for name, rows in (("payments", D.payments(spark, folder)), ("descriptions", D.descriptions(spark, folder))):
        path = fresh_path(spark, name)
        saved[name] = f"{name}_{path.rsplit('-', 1)[-1]}"
        snapshot.save_bucketed(rows, saved[name], "hcpcs_code", BUCKETS, path)
    tables = [spark.table(saved[name]) for name in ("payments", "descriptions")]
    return settled_scores(gold.staged_payments(*tables, national=D.RANKED_GEOGRAPHY))


def staged_recalls(spark: SparkSession, folder: str) -> DataFrame:
    staged = D.staged_notices(spark, folder)
    return staged.withColumn("severity_rank", F.col("severity_rank").cast("long"))


def history_summary(spark: SparkSession, folder: str) -> DataFrame:
    return _wide_rank(D.summary(spark, folder))


def _wide_rank(df: DataFrame) -> DataFrame:
    return df.withColumn("worst_severity_rank", F.col("worst_severity_rank").cast("long"))


# Containment and best match


def _words_in_documents(spark: SparkSession, folder: str, strategy: str) -> DataFrame:
    texts, words = D.document_texts(spark, folder), D.benchmark_words(spark, folder)
    joined = contains_join(texts, words, "doc_id", "text", "word", strategy=strategy)
    return joined.select("doc_id", "word", "first_item")


def contains_join_scan(spark: SparkSession, folder: str) -> DataFrame:
    return _words_in_documents(spark, folder, "auto")


def contains_join_grams(spark: SparkSession, folder: str) -> DataFrame:
    return _words_in_documents(spark, folder, "grams")


def contains_join_shuffle(spark: SparkSession, folder: str) -> DataFrame:
    return _words_in_documents(spark, folder, "shuffle")


def contains_passages(spark: SparkSession, folder: str) -> DataFrame:
    """Whole benchmark passages inside whole documents; documents without one are kept."""
    texts = D.document_texts(spark, folder)
    passages = D.table(spark, folder, "benchmark").select(
        "item_id", F.upper(D.plain(F.col("text"))).alias("passage")
    )
    joined = contains_join(texts, passages, "doc_id", "text", "passage")
    return joined.select("doc_id", "item_id", "passage")


def best_match_words(spark: SparkSession, folder: str) -> DataFrame:
    """Longest benchmark word in each document, then the earliest passage, then the word."""
    return best_match(
        _words_in_documents(spark, folder, "auto"), "doc_id", longest_then_worst("word", "first_item")
    )


def best_contained_words(spark: SparkSession, folder: str) -> DataFrame:
    """The same result with the choice made inside the scan."""
    texts, words = D.document_texts(spark, folder), D.benchmark_words(spark, folder)
    order = longest_then_worst("word", "first_item")
    best = best_contained(texts, words, "doc_id", "text", "word", order)
    return best.select("doc_id", "word", "first_item")


def matched_payments(spark: SparkSession, folder: str) -> DataFrame:
    matched = gold.matched_payments(D.staged(spark, folder), D.summary(spark, folder))
    return matched.select("hcpcs_code", "drug_desc", "generic_name_clean", "total_recalls")


def scored_table(spark: SparkSession, folder: str) -> DataFrame:
    return _wide_rank(settled_scores(D.scored(spark, folder)))


# Serving


def top_scores(spark: SparkSession, folder: str) -> DataFrame:
    rows = top_n(D.scored(spark, folder), explain.TOP_ITEMS)
    return rows.select("hcpcs_code", "drug_desc", "combined_risk_score")


def board_rows(spark: SparkSession, folder: str) -> DataFrame:
    chosen = {"cost_risk_tier": ["High", "Medium"], "safety_risk_tier": None}
    rows = board_filter(D.scored(spark, folder), chosen)
    return settled_scores(rows).select(
        "hcpcs_code", "drug_desc", "cost_risk_tier", "safety_risk_tier", "dollar_impact"
    )


def board_chart(spark: SparkSession, folder: str) -> DataFrame:
    chosen = {"cost_risk_tier": ["High", "Medium"], "safety_risk_tier": ["High", "None"]}
    return board.chart_rows(board_filter(D.scored(spark, folder), chosen))


def kpis(spark: SparkSession, folder: str) -> DataFrame:
    return settled(kpi_row(D.scored(spark, folder)), total_impact=0)


def tier_options(spark: SparkSession, folder: str) -> DataFrame:
    return value_options(D.scored(spark, folder), "safety_risk_tier")


def _explained(spark: SparkSession, folder: str) -> DataFrame:
    scored = materialize(settled_scores(D.scored(spark, folder)), "scored")
    texts = explain.explanations(scored, RUN_TS, pause=0)
    return explain.snapshot_rows(scored, texts)


def explained_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    return _explained(spark, folder)


def snapshot_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_path(spark, "snapshot")
    snapshot.write_snapshot(_explained(spark, folder), path)
    return snapshot.read_snapshot(spark, path)


def board_texts(spark: SparkSession, folder: str) -> DataFrame:
    return board.text_rows(_explained(spark, folder))


def enrich_isolated(spark: SparkSession, folder: str) -> DataFrame:
    """The generator refuses some items for good; the others still get their text."""

    def choosy(prompt: str) -> str:
        if "gizmo" in prompt or "widget" in prompt:
            raise RuntimeError("refused")
        return explain.template_text(prompt)

    scored = settled_scores(D.scored(spark, folder))
    rows = explain.enriched_top(scored, choosy, pause=0)
    return rows.select(
        "hcpcs_code", "status", F.col("attempts").cast("long").alias("attempts"), "error", "ai_explanation"
    )


def enrich_retries(spark: SparkSession, folder: str) -> DataFrame:
    """Parts described by a generator that is short of quota, busy, or refuses; a second run sends only what failed."""
    store = fresh_path(spark, "store")

    def moody(kinds: dict[int, tuple[str, int]]) -> Callable[[str], str]:
        tries: dict[str, int] = {}

        def generate(prompt: str) -> str:
            error, times = kinds.get(len(prompt) % 5, ("", 0))
            tries[prompt] = tries.get(prompt, 0) + 1
            if tries[prompt] <= times:
                raise RuntimeError(error)
            return f" about {prompt}"

        return generate

    prompt = F.concat_ws(" ", "p_name", "p_type").alias("prompt")
    rows = D.table(spark, folder, "part").select("p_partkey", prompt)
    kinds = {1: ("QUOTA", 1), 2: ("BUSY", 3), 3: ("QUOTA", 9), 4: ("refused", 9)}
    quick = {"most_calls": 200_000, "batch": 100_000, "quota_wait": 0.0, "busy_wait": 0.0, "pause": 0.0}
    enrich_stored(rows, "prompt", moody(kinds), store, **quick)
    found = enrich_stored(rows, "prompt", moody({4: ("refused", 9)}), store, **quick)
    sent = read_store(spark, store).groupBy("key").agg(F.count(F.lit(1)).alias("times_sent"))
    joined = found.join(sent, F.sha2(F.col("prompt").cast("binary"), 256) == F.col("key"))
    return joined.select(
        "p_partkey", "status", F.col("attempts").cast("long").alias("attempts"), "error", "ai_explanation", "times_sent"
    )


# Quality


def dq_report(spark: SparkSession, folder: str) -> DataFrame:
    tables = {
        "lineitem": D.table(spark, folder, "lineitem"),
        "orders": D.table(spark, folder, "orders"),
        "recalls": D.recalls(spark, folder),
    }
    checks = [
        Check("lineitem", "l_orderkey", NOT_NULL),
        Check("lineitem", "l_orderkey", UNIQUE),
        Check("lineitem", "l_returnflag", ACCEPTED, ("A", "N")),
        Check("orders", "o_orderkey", NOT_NULL),
        Check("orders", "o_orderkey", UNIQUE),
        Check("orders", "o_orderpriority", ACCEPTED, tuple(D.PRIORITY_RANKS)),
        Check("recalls", "generic_name", NOT_NULL),
    ]
    return run_checks(tables, checks)


def gold_checks(spark: SparkSession, folder: str) -> DataFrame:
    """The ten standing checks on the staged and scored tables."""
    tables = {
        "staged_payments": D.staged(spark, folder),
        "staged_recalls": D.staged_notices(spark, folder),
        "scored": materialize(D.scored(spark, folder), "scored"),
    }
    return run_checks(tables, gold.CHECKS)


# Sources, sinks, landing


def unique_by_days(spark: SparkSession, folder: str) -> DataFrame:
    """Are order keys unique over all ship days? From states by year; the first years were published short and replaced."""
    parts = []
    for table, column, date in (("lineitem", "l_orderkey", "l_shipdate"), ("orders", "o_orderkey", "o_orderdate")):
        path = fresh_path(spark, f"keys-{table}")
        rows = D.table(spark, folder, table)
        year = F.coalesce(F.trunc(F.col(date).cast("date"), "year"), F.lit("1900-01-01").cast("date"))
        dated = rows.select(F.col(column), year.alias(bronze.INGEST_DATE))
        early = F.col(bronze.INGEST_DATE) < "1997-01-01"
        publish_days(key_states(dated.where(~early | (F.col(column) % 2 == 0)), column, [bronze.INGEST_DATE]), path)
        states = key_states(dated.where(early), column, [bronze.INGEST_DATE])
        publish_days(states, path)
        merged = repeated_keys(read_published(spark, path, states.schema))
        parts.append(merged.select(F.lit(table).alias("table_name"), F.lit(column).alias("column_name"), "*"))
    return bronze.stack(*parts).withColumn("passed", F.col("repeated_keys") == 0)


def union_parts(spark: SparkSession, folder: str) -> DataFrame:
    lines = D.table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_tax", "l_linestatus")
    is_open = F.col("l_linestatus") == "O"
    return bronze.stack(lines.where(is_open), lines.where(~is_open).drop("l_tax"))


def parquet_parts(spark: SparkSession, folder: str) -> DataFrame:
    """A folder of parts of which some lack a column."""
    lines = D.table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_tax", "l_linestatus")
    path = fresh_path(spark, "parts")
    is_open = F.col("l_linestatus") == "O"
    lines.where(is_open).write.parquet(path)
    lines.where(~is_open).drop("l_tax").write.mode("append").parquet(path)
    return bronze.read_parts(spark, path, schema=lines.schema)


def date_slice(spark: SparkSession, folder: str) -> DataFrame:
    """Events landed by day, one day read back."""
    path = fresh_path(spark, "events")
    events = D.table(spark, folder, "events").select("event_id", "user_id", "event_type", "value", "ts")
    dated = events.withColumn(bronze.INGEST_DATE, F.to_date("ts")).drop("ts")
    bronze.write_dated(dated, path)
    day = bronze.run_date("2024-01-15")
    return bronze.read_parts(spark, path, day, dated.schema).drop(bronze.INGEST_DATE)


def bronze_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Orders landed twice for one day, replaced the second time, and once for another day."""
    path = fresh_path(spark, "bronze")
    rows = bronze.stamp_rows(order_records(spark, folder), RUN_TS)
    for day in (DAY, OTHER_DAY, DAY):
        bronze.write_dated(rows, path, day, fmt="json")
    return bronze.read_dated_json(spark, path, STAMPED_ORDER, DAY).drop(bronze.INGEST_DATE)


def append_then_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Appending the same delivery twice repeats every row; reading keeps the newest of each."""
    path = fresh_path(spark, "appended")
    rows = order_records(spark, folder)
    for stamp in (RUN_TS, "2024-02-02T00:00:00"):
        bronze.write_dated(bronze.stamp_rows(rows, stamp), path, DAY, fmt="json", mode="append")
    landed = bronze.read_dated_json(spark, path, STAMPED_ORDER, DAY).drop(bronze.INGEST_DATE)
    return drop_repeats(landed, ["o_orderkey"], newest_by="ingested_at")


def _payment_feed(spark: SparkSession, folder: str) -> DataFrame:
    """Lines as the payment feed hands them out, all values as text, with their order."""

    def text(c: Column) -> Column:
        return c.cast("string")

    price, discount = F.col("l_extendedprice"), F.col("l_discount")
    lines, parts = spread_small(D.table(spark, folder, "lineitem")), D.table(spark, folder, "part")
    return lines.join(parts, lines.l_partkey == parts.p_partkey).select(
        "l_orderkey",
        text(F.col("l_partkey")).alias("HCPCS_Cd"),
        F.col("p_name").alias("HCPCS_Desc"),
        F.col("l_returnflag").alias("HCPCS_Drug_Ind"),
        F.col("l_linestatus").alias("Rndrng_Prvdr_Geo_Desc"),
        text(F.col("l_linenumber")).alias("Tot_Rndrng_Prvdrs"),
        text(F.col("l_quantity")).alias("Tot_Srvcs"),
        text(price).alias("Avg_Sbmtd_Chrg"),
        text(price * (1 - discount)).alias("Avg_Mdcr_Alowd_Amt"),
        text(price * (1 - discount * 10)).alias("Avg_Mdcr_Pymt_Amt"),
    )


def bronze_to_silver_payments(spark: SparkSession, folder: str) -> DataFrame:
    """Lines as nested landed records with numbers as text, flattened again."""
    feed = _payment_feed(spark, folder)
    record = F.struct(*[c for c in feed.columns if c != "l_orderkey"])
    landed = feed.select(
        F.col("l_orderkey").alias("id"), F.lit(RUN_TS).alias("ingested_at"), record.alias("record")
    )
    path = fresh_path(spark, "payments")
    bronze.write_dated(landed, path, DAY, fmt="json")
    return silver_payments(bronze.read_dated_json(spark, path, BRONZE_PAYMENTS, DAY))


def bronze_to_silver_recalls(spark: SparkSession, folder: str) -> DataFrame:
    """Notices as landed documents with their names nested, exploded again."""
    rows = D.notices(spark, folder).withColumnRenamed("names", "generic_name")
    document = rows.withColumn("openfda", F.struct("generic_name")).drop("generic_name")
    path = fresh_path(spark, "recalls")
    bronze.write_dated(document, path, DAY, fmt="json")
    return silver_recalls(bronze.read_dated_json(spark, path, BRONZE_RECALLS, DAY))


def paged_landing(spark: SparkSession, folder: str) -> DataFrame:
    """Orders landed as pages; pages read up to the first empty one, the status filter at the scan."""
    path = fresh_path(spark, "pages")
    pages.land_pages(order_records(spark, folder), "o_orderkey", path)
    rows = pages.read_pages(spark, path, ORDER_RECORD)
    return rows.where(F.col("o_orderstatus") == "O")


def paged_stop(spark: SparkSession, folder: str) -> DataFrame:
    """Orders landed as small pages of which the middle one came empty: the pages ahead of it count.

    A folder holds as many of them as make a page of the usual size.
    """
    path, size = fresh_path(spark, "pages"), 250
    folder_pages = pages.PAYMENT_PAGE_SIZE // size
    orders = order_records(spark, folder)
    page = F.floor(F.col("o_orderkey") / size)
    middle = orders.agg(F.floor(F.floor(F.max("o_orderkey") / size) / 2)).scalar()
    pages.land_pages(orders.where(page != middle), "o_orderkey", path, size, folder_pages)
    return pages.read_pages(spark, path, ORDER_RECORD, folder_pages=folder_pages)


def _page_files(path: str, schema: T.StructType, rows_seen: int | None = None, folder_pages: int = 1) -> Callable:
    """``fetch`` of a feed whose pages are landed in folders of so many; shows the first ``rows_seen`` rows.

    The folder read last is kept, since a task asks for page after page.
    """
    held: dict[int, dict[int, list[dict]]] = {}

    def pages_of(folder: int) -> dict[int, list[dict]]:
        import json

        from pyarrow import fs

        if folder not in held:
            held.clear()
            found = held[folder] = {}
            files, root = fs.FileSystem.from_uri(path)
            part = pages.PAGE if folder_pages == 1 else pages.FOLDER
            for f in files.get_file_info(fs.FileSelector(f"{root}/{part}={folder}", allow_not_found=True)):
                if f.base_name.endswith((".json", ".json.gz")):  # opened by their ending
                    for line in files.open_input_stream(f.path).read().decode().splitlines():
                        row = json.loads(line)
                        found.setdefault(row.get(pages.PAGE, folder), []).append(row)
            for rows in found.values():
                rows.sort(key=lambda r: r["position"])
        return held[folder]

    def fetch(offset: int, size: int, wanted: dict) -> list[tuple]:
        size = size if rows_seen is None else max(0, min(size, rows_seen - offset))
        rows: list[tuple] = []
        for page in range(offset // FEED_PAGE, (offset + size - 1) // FEED_PAGE + 1 if size else 0):
            lines = pages_of(page // folder_pages).get(page, ())
            rows += [tuple(r.get(c) for c in schema.fieldNames()) for r in lines if r["position"] >= offset]
        return rows[:size]

    return fetch


def feed_followed(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as a live feed that is followed three times while it grows; each row landed once, with its page.

    A folder of the feed holds as many small pages as make a page of the usual size.
    """
    path, target, state = (fresh_path(spark, tag) for tag in ("feed", "followed", "state"))
    orders = order_records(spark, folder)
    folder_pages = pages.PAYMENT_PAGE_SIZE // FEED_PAGE
    pages.land_pages(orders.withColumn("position", F.col("o_orderkey")), "position", path, FEED_PAGE, folder_pages)
    n = orders.count()
    for seen in (n // 3, n // 3, None):
        fetch = _page_files(path, ORDER_RECORD, seen, folder_pages)
        spark.dataSource.register(pages.paged_feed("orders_feed", ORDER_RECORD, fetch))
        pages.follow_feed(spark, "orders_feed", target, state, batch_pages=100, size=FEED_PAGE)
    return spark.read.parquet(target)


def quarantined_records(spark: SparkSession, folder: str) -> DataFrame:
    """Orders landed as JSON lines of which some are cut short, hold text for a number, or lack their customer."""
    path, target, quarantine = (fresh_path(spark, tag) for tag in ("lines", "landed", "quarantine"))
    orders = order_records(spark, folder)
    urgent, pending = F.col("o_orderpriority").startswith("1"), F.col("o_orderstatus") == "P"
    priced = F.to_json(F.struct(*[F.lit("a lot").alias(c) if c == "o_totalprice" else F.col(c) for c in orders.columns]))
    whole = F.to_json(F.struct(*[c for c in orders.columns if c != "o_custkey"], F.when(~pending, F.col("o_custkey")).alias("o_custkey")))
    cut = F.left(whole, F.length(whole) - 1 - F.col("o_orderkey") % 40)
    line = F.when(urgent & pending, cut).when(urgent, priced).otherwise(whole)
    orders.select(line.alias("value")).write.text(path)
    for _ in range(2):  # the second time replaces the first
        bronze.land_checked(spark, path, ORDER_RECORD, target, quarantine, DAY, required=["o_orderkey", "o_custkey"])
    good = bronze.read_parts(spark, target).select("o_orderkey", F.lit("good").alias("reason"), "o_totalprice")
    key = F.regexp_extract("raw", '"o_orderkey":([0-9]+)', 1).cast("long").alias("o_orderkey")
    bad = bronze.read_parts(spark, quarantine).select(key, "reason", F.lit(None).cast("double").alias("o_totalprice"))
    return good.unionAll(bad)


def landing_to_silver(spark: SparkSession, folder: str) -> DataFrame:
    """Lines as feed pages; the flagged ones landed for a day and flattened."""
    root = fresh_path(spark, "landing")
    feed = _payment_feed(spark, folder).withColumn("position", F.col("l_orderkey")).drop("l_orderkey")
    pages.land_pages(feed, "position", f"{root}/pages")
    landed = pages.read_pages(spark, f"{root}/pages", PAYMENT_RECORD).drop(pages.PAGE)
    daily.land_payments(landed, root, DAY, RUN_TS, flag="A")
    flat = silver_payments(bronze.read_dated_json(spark, f"{root}/raw/{daily.PAYMENTS}", BRONZE_PAYMENTS, DAY))
    return flat.drop("id")


def envelope_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Orders wrapped a page at a time under ``results`` and unwrapped again."""
    path = fresh_path(spark, "envelopes")
    page = F.floor(F.col("o_orderkey") / pages.RECALL_PAGE_SIZE)
    row = F.struct(*ORDER_RECORD.fieldNames())
    wrapped = order_records(spark, folder).groupBy(page).agg(F.collect_list(row).alias("results"))
    wrapped.select("results").write.json(path)
    return pages.read_envelopes(spark, path, ORDER_RECORD)


def newest_capped(spark: SparkSession, folder: str) -> DataFrame:
    n = pages.RECALL_PAGES * pages.RECALL_PAGE_SIZE
    rows = newest(D.table(spark, folder, "orders"), "o_orderdate", "o_orderkey", n)
    return rows.select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("order_day"))


def incremental_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Two deliveries taken in by two runs of the stream: the second repeats, updates and adds documents."""
    source, target, state = (fresh_path(spark, tag) for tag in ("delivered", "taken", "state"))
    status, later = F.col("o_orderstatus"), F.lit("2024-02-02T00:00:00")
    rows = order_records(spark, folder).select(
        "o_orderkey", F.split("o_orderpriority", "-").alias("names"), "o_orderstatus"
    )
    updated = rows.select(
        "o_orderkey",
        "names",
        F.when(status == "O", F.lit("F")).otherwise(status).alias("o_orderstatus"),
        F.when(status == "F", F.lit(RUN_TS)).otherwise(later).alias("ingested_at"),
    )
    first = bronze.stamp_rows(rows.where(status != "P"), RUN_TS)

    def flat(documents: DataFrame) -> DataFrame:
        return explode_keep(documents, "names", "name", ["o_orderkey", "o_orderstatus", "ingested_at"])

    keys, schema = ["o_orderkey", "name"], updated.schema
    for delivery in (first, updated):
        delivery.write.mode("append").json(source)
        land_new_files(
            spark, source, schema, flat, keys, target, state, version="ingested_at"
        ).awaitTermination()
    return drop_repeats(spark.read.parquet(target), keys, newest_by="ingested_at")


def incremental_recent(spark: SparkSession, folder: str) -> DataFrame:
    """Four deliveries over two months, each order taken once in two weeks; what was taken, and when.

    The second delivery repeats finished orders in the same two weeks, the third open ones weeks later, the fourth all
    orders when only those of the third are still remembered.
    """
    source, target, state = (fresh_path(spark, tag) for tag in ("delivered", "taken", "state"))
    rows = order_records(spark, folder).select(
        "o_orderkey", F.split("o_orderpriority", "-").alias("names"), "o_orderstatus"
    )
    status = F.col("o_orderstatus")

    def flat(documents: DataFrame) -> DataFrame:
        return explode_keep(documents, "names", "name", ["o_orderkey", "o_orderstatus"])

    deliveries = [
        ("2024-01-05T00:00:00", rows.where(status != "P")),
        ("2024-01-10T00:00:00", rows.where(status != "O")),
        ("2024-02-20T00:00:00", rows.where(status == "O")),
        ("2024-02-23T00:00:00", rows),
    ]
    for at, delivery in deliveries:
        delivery.write.mode("append").json(source)
        land_recent_files(
            spark, source, rows.schema, flat, ["o_orderkey", "name"], target, state, at, days=14, count_keys=False
        ).awaitTermination()
    taken = spark.read.parquet(target)
    return taken.select("o_orderkey", "name", "o_orderstatus", F.to_date("taken_at").alias("taken_on"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "scored_table": scored_table,
    "flatten_json": flatten_json,
    "row_gap_impact": row_gap_impact,
    "explode_names": explode_names,
    "explode_outer_keep": explode_outer_keep,
    "severity_case": severity_case,
    "parse_date": parse_date,
    "short_label": short_label,
    "tiers": tiers,
    "weighted_rollup": weighted_rollup_query,
    "rollup_by_days": rollup_by_days,
    "history_by_days": history_by_days,
    "staged_payments": staged_payments,
    "staged_payments_carry": staged_payments_carry,
    "staged_bucketed": staged_bucketed,
    "staged_recalls": staged_recalls,
    "history_summary": history_summary,
    "contains_join_scan": contains_join_scan,
    "contains_join_grams": contains_join_grams,
    "contains_join_shuffle": contains_join_shuffle,
    "contains_passages": contains_passages,
    "best_match": best_match_words,
    "best_contained": best_contained_words,
    "matched_payments": matched_payments,
    "top_n": top_scores,
    "board_filter": board_rows,
    "board_chart": board_chart,
    "kpi_row": kpis,
    "tier_options": tier_options,
    "explained_snapshot": explained_snapshot,
    "snapshot_roundtrip": snapshot_roundtrip,
    "board_texts": board_texts,
    "render_prompt": render_prompt,
    "enrich_isolated": enrich_isolated,
    "enrich_retries": enrich_retries,
    "dq_report": dq_report,
    "gold_checks": gold_checks,
    "unique_by_days": unique_by_days,
    "union_parts": union_parts,
    "parquet_parts": parquet_parts,
    "date_slice": date_slice,
    "bronze_roundtrip": bronze_roundtrip,
    "append_then_dedup": append_then_dedup,
    "bronze_to_silver_payments": bronze_to_silver_payments,
    "bronze_to_silver_recalls": bronze_to_silver_recalls,
    "paged_landing": paged_landing,
    "paged_stop": paged_stop,
    "feed_followed": feed_followed,
    "quarantined_records": quarantined_records,
    "landing_to_silver": landing_to_silver,
    "envelope_pages": envelope_pages,
    "newest_capped": newest_capped,
    "incremental_dedup": incremental_dedup,
    "incremental_recent": incremental_recent,
}
