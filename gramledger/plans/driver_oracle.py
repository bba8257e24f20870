"""The same results as ANSI SQL over the driver's tables, for checking."""

from __future__ import annotations

PART_TEXT = "p_name || ', ' || p_brand || ', size ' || p_size"


def _payments(text: str = PART_TEXT, first: str = "") -> str:
    return f"""
payments AS (
  SELECT {first} CAST(l_partkey AS VARCHAR) AS hcpcs_code, {text} AS drug_desc, l_linestatus AS geography,
         CAST(l_linenumber AS DOUBLE) AS total_providers, l_quantity AS total_services,
         l_extendedprice AS avg_submitted_charge,
         l_extendedprice * (1 - l_discount) AS avg_medicare_allowed,
         l_extendedprice * (1 - l_discount * 10) AS avg_medicare_paid
  FROM lineitem JOIN part ON l_partkey = p_partkey
)"""


TOTALS = ("total_providers", "total_services")
AVERAGES = ("avg_submitted_charge", "avg_medicare_allowed", "avg_medicare_paid")
DERIVED = ("payment_gap_pct", "dollar_impact")

TOTAL_COLUMNS = ", ".join(f"sum({c}) AS {c}" for c in TOTALS)
AVERAGE_COLUMNS = ", ".join(
    f"sum({c} * total_services) / nullif(sum(total_services), 0) AS {c}" for c in AVERAGES
)

ROLLUP = f"""
  SELECT hcpcs_code, max(drug_desc) AS drug_desc, max(geography) AS geography, {TOTAL_COLUMNS}, {AVERAGE_COLUMNS}
  FROM payments {{where}} GROUP BY hcpcs_code"""

GAP_COLUMNS = """
         (avg_submitted_charge - avg_medicare_paid) / nullif(avg_submitted_charge, 0) * 100 AS payment_gap_pct,
         total_services * (avg_submitted_charge - avg_medicare_paid) AS dollar_impact"""

GAP = f"SELECT *, {GAP_COLUMNS} FROM rolled"

STAGED = f"""
{_payments()},
rolled AS ({ROLLUP.format(where="WHERE geography = 'O'")}),
staged AS ({GAP})"""

NOTICES = f"""
notices AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS recall_number, p_type AS classification,
         o_orderstatus AS status, CAST(l_suppkey AS VARCHAR) AS recalling_firm,
         CAST(NULL AS VARCHAR) AS reason_for_recall, strftime(o_orderdate, '%Y%m%d') AS report_date,
         CAST(NULL AS VARCHAR) AS distribution_pattern,
         [CASE WHEN length(first_word) <= 4 THEN first_word END,
          CASE WHEN length(second_word) <= 4 THEN
            CASE o_orderpriority WHEN '1-URGENT' THEN ' ' || lower(exact) || ' ' ELSE exact END END] AS names
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN (SELECT p_partkey, p_type, split_part(p_name, ' ', 1) AS first_word, split_part(p_name, ' ', 2) AS second_word,
               split_part(p_name, ' ', 2) || ', ' || p_brand || ', size ' || p_size AS exact FROM part)
    ON l_partkey = p_partkey
),
recalls AS (SELECT * EXCLUDE (names), unnest(names) AS generic_name FROM notices)"""

SEVERITY = """CASE {c} WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2 WHEN '3-MEDIUM' THEN 3 ELSE 4 END"""
TYPE_SEVERITY = "CASE classification WHEN 'PROMO' THEN 1 WHEN 'LARGE' THEN 2 WHEN 'MEDIUM' THEN 3 ELSE 4 END"

AWKWARD = f"""
{_payments()},
awkward AS (
  SELECT * REPLACE (CASE WHEN total_providers = 7 THEN 0 ELSE avg_submitted_charge END AS avg_submitted_charge,
                    CASE WHEN total_providers <> 6 THEN avg_medicare_paid END AS avg_medicare_paid,
                    CASE WHEN hcpcs_code LIKE '%9' THEN 0 ELSE total_services END AS total_services)
  FROM payments
)"""

STAGED_RECALLS = f"""
{NOTICES},
staged_recalls AS (
  SELECT recall_number, classification, CAST({TYPE_SEVERITY} AS BIGINT) AS severity_rank,
         status, recalling_firm, reason_for_recall,
         CAST(strptime(report_date, '%Y%m%d') AS DATE) AS report_date, distribution_pattern,
         upper(trim(generic_name)) AS generic_name_clean
  FROM recalls WHERE generic_name IS NOT NULL
)"""

SUMMARY = f"""
{STAGED_RECALLS},
summary AS (
  SELECT generic_name_clean, count(*) AS total_recalls, min(severity_rank) AS worst_severity_rank,
         max(report_date) AS most_recent_recall_date,
         CAST(sum(CASE WHEN status = 'O' THEN 1 ELSE 0 END) AS BIGINT) AS ongoing_recalls,
         count(DISTINCT recalling_firm) AS distinct_manufacturers
  FROM staged_recalls GROUP BY generic_name_clean
)"""

MATCHED = f"""
{STAGED},
{SUMMARY},
matched AS (
  SELECT staged.* EXCLUDE (geography), generic_name_clean, coalesce(total_recalls, 0) AS total_recalls,
         worst_severity_rank, most_recent_recall_date, coalesce(ongoing_recalls, 0) AS ongoing_recalls,
         distinct_manufacturers
  FROM staged LEFT JOIN summary ON contains(upper(drug_desc), generic_name_clean)
)"""

SCORED = f"""
{MATCHED},
best AS (
  SELECT DISTINCT ON (hcpcs_code) * FROM matched
  ORDER BY hcpcs_code, length(generic_name_clean) DESC NULLS LAST, worst_severity_rank NULLS LAST, generic_name_clean
),
scored AS (
  SELECT *,
         CASE WHEN payment_gap_pct >= 75 THEN 'High' WHEN payment_gap_pct >= 40 THEN 'Medium' ELSE 'Low' END
           AS cost_risk_tier,
         CASE WHEN total_recalls = 0 THEN 'None' WHEN worst_severity_rank = 1 THEN 'High'
              WHEN worst_severity_rank = 2 THEN 'Medium' ELSE 'Low' END AS safety_risk_tier,
         round(coalesce(payment_gap_pct, 0)
               + CASE WHEN total_recalls > 0 THEN (4 - worst_severity_rank) * 20 ELSE 0 END
               + coalesce(ongoing_recalls, 0) * 10, 1) AS combined_risk_score
  FROM best
)"""

SETTLED = "* REPLACE (" + ", ".join(f"round({c}, 6) AS {c}" for c in AVERAGES + DERIVED) + ")"

TOP = "ORDER BY combined_risk_score DESC, hcpcs_code LIMIT {n}"

FIGURES = """
figures AS (
  SELECT *, ['Item: ' || drug_desc,
             'Gap between charge and payment: ' || printf('%.1f', payment_gap_pct) || '%',
             'Money impact: $' || format('{:,}', CAST(round(dollar_impact) AS BIGINT)),
             'Cost tier: ' || cost_risk_tier,
             'Safety tier: ' || safety_risk_tier,
             'Recalls: ' || total_recalls || ', still ongoing: ' || ongoing_recalls,
             'Score: ' || printf('%.1f', combined_risk_score)] AS lines
  FROM scored """ + TOP.format(n=50) + ")"

HEAD = (
    "Explain in two or three plain sentences why this item is a review priority. "
    "Rely on the figures listed here and on nothing else."
)

EXPLAINED = f"""
{SCORED},
{FIGURES},
explained AS (
  SELECT s.hcpcs_code, s.drug_desc, s.total_services, round(s.avg_submitted_charge, 6) AS avg_submitted_charge,
         round(s.avg_medicare_paid, 6) AS avg_medicare_paid, round(s.payment_gap_pct, 6) AS payment_gap_pct,
         round(s.dollar_impact, 6) AS dollar_impact, s.cost_risk_tier, s.total_recalls, s.ongoing_recalls,
         s.safety_risk_tier, s.combined_risk_score, array_to_string(f.lines, '; ') AS ai_explanation
  FROM scored s LEFT JOIN figures f ON s.hcpcs_code = f.hcpcs_code
)"""

WORDS = """
words AS (
  SELECT word, min(item_id) AS first_item
  FROM (SELECT item_id, unnest(string_split(upper(replace(text, 'ß', 'ss')), ' ')) AS word FROM benchmark)
  GROUP BY word
),
texts AS (SELECT doc_id, upper(replace(text, 'ß', 'ss')) AS body FROM documents),
found AS (SELECT doc_id, word, first_item FROM texts LEFT JOIN words ON contains(body, word))"""

ORDER_RECORDS = """
records AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, strftime(o_orderdate, '%Y%m%d') AS o_orderdate,
         o_orderpriority
  FROM orders
)"""

FOUND = f"WITH {WORDS} SELECT doc_id, word, first_item FROM found"

BEST_WORD = f"""
    WITH {WORDS}
    SELECT DISTINCT ON (doc_id) doc_id, word, first_item FROM found
    ORDER BY doc_id, length(word) DESC NULLS LAST, first_item NULLS LAST, word"""

CHECK_COLUMNS = "table_name, column_name, check_name, failures, failures = 0 AS passed"


def _check(table: str, column: str, kind: str, source: str, values: tuple[str, ...] = ()) -> str:
    if kind == "not_null":
        count = f"SELECT count(*) FROM {source} WHERE {column} IS NULL"
    elif kind == "unique":
        repeated = f"SELECT {column} FROM {source} WHERE {column} IS NOT NULL GROUP BY {column} HAVING count(*) > 1"
        count = f"SELECT count(*) FROM ({repeated})"
    else:
        listed = ", ".join(f"'{v}'" for v in values)
        count = f"SELECT count(*) FROM {source} WHERE {column} NOT IN ({listed})"
    return (
        f"SELECT '{table}' AS table_name, '{column}' AS column_name, '{kind}' AS check_name, ({count}) AS failures"
    )


def _report(*checks: str) -> str:
    return f"SELECT {CHECK_COLUMNS} FROM ({' UNION ALL '.join(checks)})"


SEVERITY_TEXTS = ("Class I", "Class II", "Class III")

ORACLE: dict[str, str] = {
    "scored_table": f"WITH {SCORED} SELECT {SETTLED} FROM scored",
    "flatten_json": """
        SELECT event_id, k AS k_text, TRY_CAST(k AS DOUBLE) AS k
        FROM (SELECT event_id, json_extract_string(props, '$.k') || CASE event_type WHEN 'error' THEN ' units' ELSE '' END
                AS k FROM events)""",
    "row_gap_impact": f"""
        WITH {AWKWARD} SELECT * EXCLUDE (drug_desc), {GAP_COLUMNS} FROM awkward""",
    "explode_names": """
        SELECT p_partkey, upper(trim(unnest(string_split(p_name, ' ')))) AS name FROM part""",
    "explode_outer_keep": """
        SELECT p_partkey, unnest(string_split(p_name, ' ')) AS name FROM part
        WHERE p_type IN ('LARGE', 'SMALL', 'MEDIUM')
        UNION ALL
        SELECT p_partkey, NULL AS name FROM part WHERE p_type NOT IN ('LARGE', 'SMALL', 'MEDIUM')""",
    "severity_case": f"""
        SELECT o_orderkey, CAST({SEVERITY.format(c="o_orderpriority")} AS BIGINT) AS severity_rank FROM orders""",
    "parse_date": """
        SELECT o_orderkey, CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(o_orderdate AS DATE) END AS report_date
        FROM orders""",
    "short_label": """
        SELECT doc_id, substring(text, 1, 30) || CASE WHEN length(text) > 30 THEN '...' ELSE '' END AS short_label
        FROM documents""",
    "tiers": f"""
        WITH rows_ AS (
          SELECT *, l_extendedprice / nullif(l_quantity, 0) / 100 AS gap, l_linenumber - 1 AS recalls,
                 {SEVERITY.format(c="o_orderpriority")} AS worst,
                 CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END AS ongoing
          FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        )
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice,
               CASE WHEN gap >= 75 THEN 'High' WHEN gap >= 40 THEN 'Medium' ELSE 'Low' END AS cost_tier,
               CASE WHEN recalls = 0 THEN 'None' WHEN worst = 1 THEN 'High' WHEN worst = 2 THEN 'Medium'
                    ELSE 'Low' END AS safety_tier,
               round(coalesce(gap, 0) + CASE WHEN recalls > 0 THEN (4 - worst) * 20 ELSE 0 END + ongoing * 10, 1)
                 AS score
        FROM rows_""",
    "weighted_rollup": f"""
        WITH {AWKWARD}, rolled AS ({ROLLUP.format(where="").replace("FROM payments", "FROM awkward")}),
        staged AS ({GAP})
        SELECT {SETTLED.replace("* REPLACE", "* EXCLUDE (geography) REPLACE")} FROM staged""",
    "staged_payments": f"WITH {STAGED} SELECT {SETTLED} FROM staged",
    "staged_payments_carry": f"WITH {STAGED} SELECT {SETTLED} FROM staged",
    "staged_recalls": f"WITH {STAGED_RECALLS} SELECT * FROM staged_recalls",
    "history_summary": f"WITH {SUMMARY} SELECT * FROM summary",
    "contains_join_scan": FOUND,
    "contains_join_grams": FOUND,
    "contains_join_shuffle": FOUND,
    "contains_passages": """
        WITH passages AS (SELECT item_id, upper(replace(text, 'ß', 'ss')) AS passage FROM benchmark),
        texts AS (SELECT doc_id, upper(replace(text, 'ß', 'ss')) AS body FROM documents)
        SELECT doc_id, item_id, passage FROM texts LEFT JOIN passages ON contains(body, passage)""",
    "best_match": BEST_WORD,
    "best_contained": BEST_WORD,
    "matched_payments": f"""
        WITH {MATCHED} SELECT hcpcs_code, drug_desc, generic_name_clean, total_recalls FROM matched""",
    "top_n": f"""
        WITH {SCORED} SELECT hcpcs_code, drug_desc, combined_risk_score FROM scored {TOP.format(n=50)}""",
    "board_filter": f"""
        WITH {SCORED}
        SELECT hcpcs_code, drug_desc, cost_risk_tier, safety_risk_tier, round(dollar_impact, 6) AS dollar_impact
        FROM scored WHERE cost_risk_tier IN ('High', 'Medium') AND safety_risk_tier IS NOT NULL""",
    "board_chart": f"""
        WITH {SCORED}
        SELECT substring(drug_desc, 1, 30) || CASE WHEN length(drug_desc) > 30 THEN '...' ELSE '' END AS short_label,
               combined_risk_score
        FROM scored WHERE cost_risk_tier IN ('High', 'Medium') AND safety_risk_tier IN ('High', 'None')
        {TOP.format(n=15)}""",
    "kpi_row": f"""
        WITH {SCORED}
        SELECT count(*) AS items, count(*) FILTER (WHERE cost_risk_tier = 'High') AS high_cost_items,
               count(*) FILTER (WHERE total_recalls > 0) AS items_with_recalls,
               round(sum(dollar_impact), 0) AS total_impact
        FROM scored""",
    "tier_options": f"""
        WITH {SCORED}
        SELECT DISTINCT safety_risk_tier FROM scored WHERE safety_risk_tier IS NOT NULL ORDER BY 1""",
    "explained_snapshot": f"WITH {EXPLAINED} SELECT * FROM explained",
    "snapshot_roundtrip": f"WITH {EXPLAINED} SELECT * FROM explained",
    "board_texts": f"""
        WITH {EXPLAINED}
        SELECT drug_desc, combined_risk_score,
               coalesce(ai_explanation, 'No AI explanation generated for this drug yet.') AS explanation
        FROM explained {TOP.format(n=10)}""",
    "render_prompt": f"""
        WITH {SCORED}, {FIGURES}
        SELECT hcpcs_code, '{HEAD}' || chr(10) || array_to_string(lines, chr(10)) AS prompt FROM figures""",
    "enrich_isolated": f"""
        WITH {SCORED}, {FIGURES},
        judged AS (SELECT *, contains(drug_desc, 'gizmo') OR contains(drug_desc, 'widget') AS refused FROM figures)
        SELECT hcpcs_code, CASE WHEN refused THEN 'failed' ELSE 'ok' END AS status, CAST(1 AS BIGINT) AS attempts,
               CASE WHEN refused THEN 'refused' END AS error,
               CASE WHEN NOT refused THEN array_to_string(lines, '; ') END AS ai_explanation
        FROM judged""",
    "dq_report": f"WITH {NOTICES} "
    + _report(
        _check("lineitem", "l_orderkey", "not_null", "lineitem"),
        _check("lineitem", "l_orderkey", "unique", "lineitem"),
        _check("lineitem", "l_returnflag", "accepted_values", "lineitem", ("A", "N")),
        _check("orders", "o_orderkey", "not_null", "orders"),
        _check("orders", "o_orderkey", "unique", "orders"),
        _check("orders", "o_orderpriority", "accepted_values", "orders", ("1-URGENT", "2-HIGH", "3-MEDIUM")),
        _check("recalls", "generic_name", "not_null", "recalls"),
    ),
    "gold_checks": f"WITH {SCORED} "
    + _report(
        _check("staged_payments", "hcpcs_code", "not_null", "staged"),
        _check("staged_payments", "hcpcs_code", "unique", "staged"),
        _check("staged_payments", "payment_gap_pct", "not_null", "staged"),
        _check("staged_recalls", "recall_number", "not_null", "staged_recalls"),
        _check("staged_recalls", "classification", "accepted_values", "staged_recalls", SEVERITY_TEXTS),
        _check("scored", "hcpcs_code", "not_null", "scored"),
        _check("scored", "hcpcs_code", "unique", "scored"),
        _check("scored", "cost_risk_tier", "accepted_values", "scored", ("High", "Medium", "Low")),
        _check("scored", "safety_risk_tier", "accepted_values", "scored", ("High", "Medium", "Low", "None")),
        _check("scored", "combined_risk_score", "not_null", "scored"),
    ),
    "union_parts": """
        SELECT l_orderkey, l_linenumber, CASE WHEN l_linestatus = 'O' THEN l_tax END AS l_tax, l_linestatus
        FROM lineitem""",
    "parquet_parts": """
        SELECT l_orderkey, l_linenumber, CASE WHEN l_linestatus = 'O' THEN l_tax END AS l_tax, l_linestatus
        FROM lineitem""",
    "date_slice": """
        SELECT event_id, user_id, event_type, value FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-15'""",
    "bronze_roundtrip": f"WITH {ORDER_RECORDS} SELECT *, '2024-02-01T00:00:00' AS ingested_at FROM records",
    "append_then_dedup": f"WITH {ORDER_RECORDS} SELECT *, '2024-02-02T00:00:00' AS ingested_at FROM records",
    "bronze_to_silver_payments": f"""
        WITH {_payments("p_name", "l_orderkey AS id, '2024-02-01T00:00:00' AS ingested_at,")}
        SELECT *, {GAP_COLUMNS} FROM payments""",
    "bronze_to_silver_recalls": f"WITH {NOTICES} SELECT * FROM recalls",
    "paged_landing": f"""
        WITH {ORDER_RECORDS}
        SELECT *, o_orderkey // 5000 AS page FROM records WHERE o_orderstatus = 'O'""",
    "paged_stop": f"""
        WITH {ORDER_RECORDS}
        SELECT *, o_orderkey // 250 AS page FROM records
        WHERE o_orderkey // 250 < (SELECT max(o_orderkey) // 250 // 2 FROM records)""",
    "landing_to_silver": f"""
        WITH {_payments("p_name", "l_returnflag,")}
        SELECT * EXCLUDE (l_returnflag), '2024-02-01T00:00:00' AS ingested_at, {GAP_COLUMNS}
        FROM payments WHERE l_returnflag = 'A'""",
    "envelope_pages": f"WITH {ORDER_RECORDS} SELECT * FROM records",
    "newest_capped": """
        SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS order_day FROM orders
        ORDER BY o_orderdate DESC, o_orderkey LIMIT 10000""",
    "incremental_dedup": f"""
        WITH {ORDER_RECORDS}
        SELECT o_orderkey, unnest(string_split(o_orderpriority, '-')) AS name,
               CASE o_orderstatus WHEN 'O' THEN 'F' ELSE o_orderstatus END AS o_orderstatus,
               CASE o_orderstatus WHEN 'F' THEN '2024-02-01T00:00:00' ELSE '2024-02-02T00:00:00' END AS ingested_at
        FROM records""",
    "incremental_recent": f"""
        WITH {ORDER_RECORDS},
        runs AS (SELECT * FROM (VALUES (DATE '2024-01-05', 'P'), (DATE '2024-01-10', 'O'), (DATE '2024-02-20', 'PF'),
            (DATE '2024-02-23', '')) AS t(day, without)),
        came AS (SELECT o_orderkey, unnest(string_split(o_orderpriority, '-')) AS name, o_orderstatus, day
            FROM records JOIN runs ON NOT contains(without, o_orderstatus))
        SELECT o_orderkey, name, o_orderstatus, min(day) AS taken_on FROM came
        GROUP BY o_orderkey, name, o_orderstatus, (day - DATE '1970-01-01') // 14""",
    "feed_followed": f"""
        WITH {ORDER_RECORDS}
        SELECT o_orderkey // 500 AS page, records.* FROM records""",
    "quarantined_records": f"""
        WITH {ORDER_RECORDS},
        judged AS (SELECT *, CASE WHEN o_orderpriority LIKE '1%' AND o_orderstatus = 'P' THEN 'not_json'
            WHEN o_orderpriority LIKE '1%' THEN 'wrong_type' WHEN o_orderstatus = 'P' OR o_custkey IS NULL THEN 'missing'
            ELSE 'good' END AS reason FROM records)
        SELECT o_orderkey, reason, CASE WHEN reason = 'good' THEN o_totalprice END AS o_totalprice FROM judged""",
    "enrich_retries": """
        WITH prompts AS (SELECT p_partkey, concat_ws(' ', p_name, p_type) AS prompt FROM part),
        kinds AS (SELECT *, length(prompt) % 5 AS kind FROM prompts)
        SELECT p_partkey, CASE WHEN kind = 4 THEN 'failed' ELSE 'ok' END AS status,
               CASE kind WHEN 1 THEN 2 WHEN 2 THEN 4 ELSE 1 END::BIGINT AS attempts,
               CASE WHEN kind = 4 THEN 'refused' END AS error,
               CASE WHEN kind <> 4 THEN 'about ' || prompt END AS ai_explanation,
               CASE WHEN kind IN (3, 4) THEN 2 ELSE 1 END::BIGINT AS times_sent
        FROM kinds""",
}
_KEYS = """
    SELECT '{0}' AS table_name, '{1}' AS column_name, count(*) AS distinct_keys, count(*) FILTER (n > 1) AS repeated_keys,
           count(*) FILTER (n > 1) = 0 AS passed
    FROM (SELECT {1}, count(*) AS n FROM {0} WHERE {1} IS NOT NULL GROUP BY {1})"""
ORACLE["unique_by_days"] = f"{_KEYS.format('lineitem', 'l_orderkey')} UNION ALL {_KEYS.format('orders', 'o_orderkey')}"
# Merged from days, they are the same results.
ORACLE["rollup_by_days"] = ORACLE["weighted_rollup"]
ORACLE["history_by_days"] = ORACLE["history_summary"]
ORACLE["staged_bucketed"] = ORACLE["staged_payments"]
