"""URL filter: rules, and a path-template tree for the urls that no rule fits.

The tree of a host has a level per path segment. A branch keeps its own segment only if it has ``SUPPORT`` urls or more
and the labels below it differ from those of its siblings together (two-proportion test at ``Z`` standard errors, both
shares smoothed); all other branches merge into the wildcard, which makes numbers, names and dates one branch. What is
deeper than ``LEVELS`` is one tail. A leaf is a template; its purity is the share of bad urls among its labelled ones,
smoothed towards ``PRIOR`` by ``STRENGTH`` urls. Labels are the verdicts of the rules, so a template is rejected on the
evidence of urls like it.

Every level is a grouped count of what the level above kept, combined before the shuffle, and a join with the few
branches kept; a host with a third of all urls is never brought together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gramledger.llm.common import quoted, written

#: (verdict, host, beginning of the path); the name of a rule is host and path together.
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
LEVELS = 3
SUPPORT = 20
Z = 3.0
PRIOR = 0.25
STRENGTH = 4.0
REJECT = 0.5


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host in lower case and path of a url; both empty if it is null or has no ``://``."""
    at = F.coalesce(F.locate("://", url), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.translate(
        F.regexp_extract(rest, r"^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    )
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def best_rule(host: Column, path: Column, rules=RULES) -> Column:
    """Number of the longest rule that fits, or null."""
    found = F.lit(None).cast("int")
    for k in sorted(range(len(rules)), key=lambda k: (len(rules[k][1] + rules[k][2]), -k)):
        _, name, start = rules[k]
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        found = F.when(fits, F.lit(k)).otherwise(found)
    return found


def smoothed(bad: Column, labelled: Column) -> Column:
    return (bad + F.lit(PRIOR * STRENGTH)) / (labelled + F.lit(STRENGTH))


def judge(
    pages: DataFrame, url: str = "url", carry: tuple[str, ...] = ("page_id",), rules=RULES, levels: int = LEVELS
) -> DataFrame:
    """Carried columns with host, path, rule, verdict, template, labelled and purity.

    The verdict is the rule's; without a rule it is ``block`` if the template's purity reaches ``REJECT``, else
    ``allow``. A null url, or one without ``://``, has an empty host and path and is judged by the template of those.
    Repeated rows count each for itself. A rule's order among equally long ones decides ties.
    """
    n = len(carry)
    host, path = host_and_path(F.col("url"))
    rows = pages.select(
        *(F.col(quoted(c)).alias(f"c{i}") for i, c in enumerate(carry)), F.col(quoted(url)).alias("url")
    )
    rows = rows.select(*(f"c{i}" for i in range(n)), host.alias("host"), path.alias("path"))
    rows = rows.withColumn("rule", best_rule(F.col("host"), F.col("path"), rules))
    bad = F.lit(False)
    for k, rule in enumerate(rules):
        bad = F.when(F.col("rule") == k, F.lit(rule[0] == "block")).otherwise(bad)
    rows = rows.withColumns(
        {
            "labelled": F.col("rule").isNotNull().cast("int"),
            "bad": bad.cast("int"),
            "segments": F.filter(F.split("path", "/"), lambda s: s != ""),
            "template": F.lit(""),
        }
    )
    for level in range(levels):
        rows = written(_grown(rows, level, levels), "template")
    known = rows.groupBy("host", "template").agg(F.sum("labelled").alias("known"), F.sum("bad").alias("known_bad"))
    rows = rows.join(known.withColumn("purity", smoothed(F.col("known_bad"), F.col("known"))), ["host", "template"])
    verdict, name = F.when(F.col("purity") >= REJECT, "block").otherwise("allow"), F.lit(None).cast("string")
    for k, (word, host_of, start) in enumerate(rules):
        verdict = F.when(F.col("rule") == k, word).otherwise(verdict)
        name = F.when(F.col("rule") == k, host_of + start).otherwise(name)
    result = rows.select(
        *(f"c{i}" for i in range(n)), "host", "path", name.alias("rule"), verdict.alias("verdict"),
        "template", F.col("known").alias("labelled"), "purity",
    )
    return result.toDF(*carry, *result.columns[n:])


def _grown(rows: DataFrame, level: int, levels: int) -> DataFrame:
    """The template one segment longer: the url's own, or the wildcard."""
    rows = rows.withColumn("segment", F.get("segments", F.lit(level)))
    at = ["host", "template"]
    branch = rows.where(F.col("segment").isNotNull()).groupBy(*at, "segment").agg(
        F.count(F.lit(1)).alias("n"), F.sum("labelled").alias("l"), F.sum("bad").alias("b")
    )
    whole = branch.groupBy(*at).agg(F.sum("l").alias("all_l"), F.sum("b").alias("all_b"))
    rest_l, rest_b = F.col("all_l") - F.col("l"), F.col("all_b") - F.col("b")
    mine, others = smoothed(F.col("b"), F.col("l")), smoothed(rest_b, rest_l)
    pooled = smoothed(F.col("all_b"), F.col("all_l"))
    error = pooled * (1 - pooled) * (1 / (F.col("l") + STRENGTH) + 1 / (rest_l + STRENGTH))
    kept = (
        branch.where(F.col("n") >= SUPPORT)
        .join(whole, at)
        .where((mine - others) * (mine - others) > F.lit(Z * Z) * error)
        .select(*at, "segment", F.lit(True).alias("own"))
    )
    more = F.size("segments") > levels
    tail = F.when(more, "/**").otherwise("") if level == levels - 1 else F.lit("")
    step = F.when(F.col("segment").isNull(), "").otherwise(
        F.concat(F.lit("/"), F.when(F.col("own"), F.col("segment")).otherwise("*"), tail)
    )
    return (
        rows.join(kept, [*at, "segment"], "left")
        .withColumn("template", F.concat("template", step))
        .drop("segment", "own")
    )


def judge_sql(rules=RULES, levels: int = LEVELS) -> str:
    """The same over the table ``pages`` in DuckDB SQL."""
    rest = "CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END"
    lower = "translate(regexp_extract(r, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    order = sorted(range(len(rules)), key=lambda k: (-len(rules[k][1] + rules[k][2]), k))
    fits = " ".join(
        f"WHEN (host = '{rules[k][1]}' OR ends_with(host, '.{rules[k][1]}')) AND starts_with(path, '{rules[k][2]}') THEN {k}"
        for k in order
    )
    blocked = ", ".join(str(k) for k, r in enumerate(rules) if r[0] == "block")
    purity = lambda b, n: f"(({b}) + {PRIOR * STRENGTH}::DOUBLE) / (({n}) + {STRENGTH}::DOUBLE)"
    steps = [
        f"""WITH parts AS (SELECT page_id, {rest} AS r FROM pages),
    urls AS (SELECT page_id, {lower} AS host, regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM parts),
    ruled AS (SELECT *, CASE {fits} END AS rule FROM urls),
    t0 AS (SELECT *, (rule IS NOT NULL)::INT AS labelled, coalesce((rule IN ({blocked}))::INT, 0) AS bad,
           list_filter(string_split(path, '/'), lambda s: s <> '') AS segments, '' AS template FROM ruled)"""
    ]
    for k in range(levels):
        tail = f"CASE WHEN len(segments) > {levels} THEN '/**' ELSE '' END" if k == levels - 1 else "''"
        pooled = purity("all_b", "all_l")
        error = f"{pooled} * (1 - {pooled}) * (1 / (l + {STRENGTH}::DOUBLE) + 1 / (all_l - l + {STRENGTH}::DOUBLE))"
        gap = f"({purity('b', 'l')} - {purity('all_b - b', 'all_l - l')})"
        steps.append(
            f"""s{k} AS (SELECT *, segments[{k + 1}] AS segment FROM t{k}),
    b{k} AS (SELECT host, template, segment, count(*) AS n, sum(labelled) AS l, sum(bad) AS b FROM s{k}
             WHERE segment IS NOT NULL GROUP BY ALL),
    w{k} AS (SELECT host, template, sum(l) AS all_l, sum(b) AS all_b FROM b{k} GROUP BY ALL),
    k{k} AS (SELECT host, template, segment, true AS own FROM b{k} JOIN w{k} USING (host, template)
             WHERE n >= {SUPPORT} AND {gap} * {gap} > {Z * Z}::DOUBLE * ({error})),
    t{k + 1} AS (SELECT s{k}.* EXCLUDE (segment, template), s{k}.template || CASE WHEN segment IS NULL THEN ''
             ELSE '/' || CASE WHEN own THEN segment ELSE '*' END || {tail} END AS template
             FROM s{k} LEFT JOIN k{k} USING (host, template, segment))"""
        )
    names = " ".join(f"WHEN {k} THEN '{r[1]}{r[2]}'" for k, r in enumerate(rules))
    words = " ".join(f"WHEN {k} THEN '{r[0]}'" for k, r in enumerate(rules))
    return (
        ",\n    ".join(steps)
        + f""",
    p AS (SELECT host, template, sum(labelled)::BIGINT AS labelled, {purity('sum(bad)', 'sum(labelled)')} AS purity
          FROM t{levels} GROUP BY host, template)
    SELECT page_id, host, path, CASE rule {names} END AS rule,
           CASE rule {words} ELSE CASE WHEN purity >= {REJECT} THEN 'block' ELSE 'allow' END END AS verdict,
           template, p.labelled, purity FROM t{levels} JOIN p USING (host, template)"""
    )
