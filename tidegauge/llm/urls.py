"""URL filters: allow and block rules, and link-graph propagation for what no rule decides.

Rules are (verdict, "host/path-prefix"); a rule fits its host and all subdomains if the url's path starts with its
path, and the longest wins. The rule list is a parameter of the query (meant for up to a few hundred entries) and
becomes one CASE expression.

Hosts are joined by the absolute links of their pages and, both ways, to the host one label up if it has pages too (with
weight `hierarchy` each; 0 leaves these edges out). Scores are shares of all trust or distrust that is left, which is the same
as if what reaches a host without links went back to the seeds.
Trust is a personalised PageRank over these edges, seeded by each host's share of the pages that rules allow;
distrust is the same over the reversed edges, seeded by the blocked pages. At least `steps` power steps are taken, and
then as many as it needs until no further host is reached and no score moves by more than SETTLED of itself. A host
that distrust reaches is blocked if trust does not reach it or its distrust exceeds `ratio` times its trust, every other
one allowed; no absolute floor enters, so the verdict does not depend on the size of the table. All steps are DataFrame
joins and pre-aggregated sums over one row for each pair of hosts.

Cases: a null url or one without "://" has empty host and path, fits no rule and is allowed by default; null html
has no links; repeated rows are judged alike and count as pages; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.common import forget, stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The rules.
RULES = [
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
]
LINK = r"""(?i)\bhref\s*=\s*["']?\s*(?:https?:)?//([^/?#"'\s<>]+)"""
DAMPING, STEPS, RATIO, HIERARCHY = 0.5, 10, 1.0, 1.0
#: Kept clear of rounding: distrust has to exceed trust by more than this share of it.
MARGIN = 1e-6
#: Scores that move by no more than this share of themselves in a step have settled.
SETTLED = 1e-9


def split_url(url: Column) -> tuple[Column, Column]:
    has = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(has > 0, F.substr(url, has + 3)).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict, both null if none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for says, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):  # the longest comes last and is tested first
        h, _, p = text.partition("/")
        fits = ((host == h) | host.endswith("." + h)) & path.startswith("/" + p)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def judged(pages: DataFrame, rules=RULES) -> DataFrame:
    host, path = split_url(F.col("url"))
    split = pages.select("page_id", "html", host.alias("host"), path.alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    return split.select("*", rule.alias("rule"), verdict.alias("said"))


def host_edges(rows: DataFrame, hierarchy: float = HIERARCHY) -> DataFrame:
    """(src, dst, w): links between different hosts and steps up and down the host hierarchy."""
    links = rows.where("host <> ''").select(F.col("host").alias("src"), F.explode(F.regexp_extract_all("html", F.lit(LINK), F.lit(1))).alias("dst"))
    links = links.select("src", F.translate("dst", UPPER, LOWER).alias("dst"))
    hosts = rows.where("host <> ''").select("host").distinct()
    up = hosts.select(F.col("host").alias("src"), F.regexp_extract("host", r"^[^.]*\.(.*)$", 1).alias("dst")).where("dst <> ''")
    up = up.join(hosts.withColumnRenamed("host", "dst"), "dst", "left_semi").select("src", "dst")
    down = up.select(F.col("dst").alias("src"), F.col("src").alias("dst"))
    every = links.groupBy("src", "dst").agg(F.count("*").cast("double").alias("w"))
    if hierarchy:
        every = every.unionByName(up.union(down).withColumn("w", F.lit(float(hierarchy))))
    return every.where("src <> dst").groupBy("src", "dst").agg(F.sum("w").alias("w"))


def propagate(edges: DataFrame, seeds: DataFrame, damping: float = DAMPING, steps: int = STEPS) -> DataFrame:
    """edges (src, dst, w), seeds (host, good, bad: pages) -> (host, trust, distrust, trusted, distrusted: reached at all)."""
    total = seeds.agg(F.sum("good").alias("g"), F.sum("bad").alias("b")).first()
    share = lambda c, n: F.col(c) / F.lit(float(n)) if n else F.lit(0.0)
    start = stored(seeds.select("host", share("good", total.g).alias("t0"), share("bad", total.b).alias("d0")), "seeds")
    edges = stored(edges, "host-edges")
    out = edges.groupBy("src").agg(F.sum("w").alias("n"))
    into = edges.groupBy("dst").agg(F.sum("w").alias("n"))
    none, no = F.lit(0.0), F.lit(False)
    ahead = edges.join(out, "src").select(F.col("src").alias("host"), F.col("dst").alias("to"), (F.col("w") / F.col("n")).alias("t_share"), none.alias("d_share"))
    back = edges.join(into, "dst").select(F.col("dst").alias("host"), F.col("src").alias("to"), none.alias("t_share"), (F.col("w") / F.col("n")).alias("d_share"))
    ways = stored(ahead.union(back), "ways")
    reached = ((F.col("t0") > 0).alias("tr"), (F.col("d0") > 0).alias("dr"))
    base = start.select("host", (F.col("t0") * (1 - damping)).alias("t"), (F.col("d0") * (1 - damping)).alias("d"), *reached)
    now = start.select("host", F.col("t0").alias("t"), F.col("d0").alias("d"), *reached)
    result = ("host", F.col("t").alias("trust"), F.col("d").alias("distrust"), F.col("tr").alias("trusted"), F.col("dr").alias("distrusted"))
    if ways.isEmpty():
        return base.select(*result)
    new = (none.alias("t_old"), none.alias("d_old"), no.alias("tr_old"), no.alias("dr_old"))
    taken, moving = 0, True
    while taken < steps or moving:
        t, d = F.col("t") * F.col("t_share") * damping, F.col("d") * F.col("d_share") * damping
        sent = ways.join(now, "host").select(F.col("to").alias("host"), t.alias("t"), d.alias("d"), (F.col("tr") & (F.col("t_share") > 0)).alias("tr"), (F.col("dr") & (F.col("d_share") > 0)).alias("dr"), *new)
        old = now.select("host", none.alias("t"), none.alias("d"), no.alias("tr"), no.alias("dr"), F.col("t").alias("t_old"), F.col("d").alias("d_old"), F.col("tr").alias("tr_old"), F.col("dr").alias("dr_old"))
        sums = [F.sum(c).alias(c) for c in ("t", "d", "t_old", "d_old")] + [F.bool_or(c).alias(c) for c in ("tr", "dr", "tr_old", "dr_old")]
        after = stored(sent.union(base.select("*", *new)).union(old).groupBy("host").agg(*sums), "ranks")
        forget(now)
        now, taken = after.select("host", "t", "d", "tr", "dr"), taken + 1
        now._stored_at = after._stored_at
        if taken >= steps:
            shift = lambda c: F.abs(F.col(c) - F.col(f"{c}_old")) > F.col(c) * SETTLED
            moving = not after.where(shift("t") | shift("d") | (F.col("tr") != F.col("tr_old")) | (F.col("dr") != F.col("dr_old"))).isEmpty()
    return now.select(*result)


def filter_urls(pages: DataFrame, rules=RULES, damping: float = DAMPING, steps: int = STEPS, ratio: float = RATIO, hierarchy: float = HIERARCHY) -> DataFrame:
    """pages (page_id, url, html) -> page_id, host, path, rule, verdict, trust, distrust."""
    rows = judged(pages, rules)
    thin = stored(rows.drop("html"), "judged")
    said = thin.where("host <> ''").groupBy("host").agg(F.count_if(F.col("said") == "allow").alias("good"), F.count_if(F.col("said") == "block").alias("bad"))
    scores = stored(propagate(host_edges(rows, hierarchy), said, damping, steps), "host-scores")
    total = scores.agg(F.sum("trust").alias("t"), F.sum("distrust").alias("d")).first()
    trust, distrust = (F.coalesce(F.col(c) / F.lit(n or 1.0), F.lit(0.0)) for c, n in (("trust", total.t), ("distrust", total.d)))
    blocked = F.col("distrusted") & (~F.col("trusted") | (distrust > trust * (ratio + MARGIN)))
    verdict = F.coalesce("said", F.when(blocked, "block").otherwise("allow"))
    return thin.join(scores, "host", "left").select("page_id", "host", "path", "rule", verdict.alias("verdict"), trust.alias("trust"), distrust.alias("distrust"))


def op3_url_filter(spark, sf_dir: str) -> DataFrame:
    return filter_urls(spark.read.parquet(f"{sf_dir}/pages.parquet")).drop("trust", "distrust")


def oracle_sql(rules=RULES, damping: float = DAMPING, steps: int = 40, ratio: float = RATIO) -> str:
    """The same for DuckDB, with `steps` power steps written out: enough where no host lies further from a seed."""
    case_rule, case_said = "CASE", "CASE"
    for says, text in sorted(rules, key=lambda r: (-len(r[1]), r[1])):
        h, _, p = text.partition("/")
        fits = f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '/{p}')"
        case_rule, case_said = f"{case_rule} WHEN {fits} THEN '{text}'", f"{case_said} WHEN {fits} THEN '{says}'"
    link = LINK.replace("'", "''")
    lower = f"'{UPPER}', '{LOWER}'"
    ranks = "".join(
        f""", r{k} AS MATERIALIZED (SELECT host, sum(t) AS t, sum(d) AS d FROM (
            SELECT ways."to" AS host, t * t_share * {damping} AS t, d * d_share * {damping} AS d FROM ways JOIN r{k - 1} USING (host)
            UNION ALL SELECT host, t0 * {1 - damping}, d0 * {1 - damping} FROM r_start) GROUP BY host)"""
        for k in range(1, steps + 1)
    )
    return f"""
    WITH cut AS (SELECT page_id, html, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
    split AS (SELECT page_id, html, translate(regexp_extract(rest, '^[^/?#]*'), {lower}) AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
    judged AS MATERIALIZED (SELECT *, {case_rule} END AS rule, {case_said} END AS said FROM split),
    links AS (SELECT host AS src, translate(unnest(regexp_extract_all(html, '{link}', 1)), {lower}) AS dst FROM judged WHERE host <> ''),
    hosts AS (SELECT DISTINCT host FROM judged WHERE host <> ''),
    up AS (SELECT host AS src, regexp_extract(host, '^[^.]*\\.(.*)$', 1) AS dst FROM hosts),
    steps AS (SELECT src, dst FROM up WHERE dst IN (SELECT host FROM hosts)),
    edges AS MATERIALIZED (SELECT src, dst, sum(w)::DOUBLE AS w FROM (
        SELECT src, dst, count(*) AS w FROM links GROUP BY ALL UNION ALL SELECT src, dst, 1 FROM steps UNION ALL SELECT dst, src, 1 FROM steps)
        WHERE src <> dst GROUP BY ALL),
    seeds AS (SELECT host, count(*) FILTER (said = 'allow') AS good, count(*) FILTER (said = 'block') AS bad FROM judged WHERE host <> '' GROUP BY host),
    r_start AS MATERIALIZED (SELECT host, coalesce(good / nullif((SELECT sum(good) FROM seeds), 0)::DOUBLE, 0) AS t0, coalesce(bad / nullif((SELECT sum(bad) FROM seeds), 0)::DOUBLE, 0) AS d0 FROM seeds),
    ways AS MATERIALIZED (SELECT src AS host, dst AS "to", w / sum(w) OVER (PARTITION BY src) AS t_share, 0.0 AS d_share FROM edges
        UNION ALL SELECT dst, src, 0.0, w / sum(w) OVER (PARTITION BY dst) FROM edges),
    r0 AS (SELECT host, t0 AS t, d0 AS d FROM r_start){ranks}
    SELECT page_id, host, path, rule, coalesce(said, CASE WHEN coalesce(d, 0) > 0 AND d / (SELECT sum(d) FROM r{steps}) > coalesce(t / nullif((SELECT sum(t) FROM r{steps}), 0), 0) * {ratio + MARGIN} THEN 'block' ELSE 'allow' END) AS verdict
    FROM judged LEFT JOIN r{steps} USING (host)"""
