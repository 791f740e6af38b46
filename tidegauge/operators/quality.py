"""Data quality, drift and integrity checks as rows (check, metric, value), each family one batched aggregation."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidegauge.functions.gram import pairwise_correlations
from tidegauge.functions.quantiles import quantiles
from tidegauge.functions.tails import student_t_p
from tidegauge.functions.windows import by_date, col, scorr, shift


def as_rows(wide: DataFrame, check: str) -> DataFrame:
    """One row of metrics to rows."""
    pairs = ", ".join(f"'{c}', CAST(`{c}` AS DOUBLE)" for c in wide.columns)
    return wide.selectExpr(f"'{check}' AS check", f"stack({len(wide.columns)}, {pairs}) AS (metric, value)")


def _measure(df: DataFrame, check: str, metrics: dict[str, Column]) -> DataFrame:
    return as_rows(df.agg(*[c.alias(m) for m, c in metrics.items()]), check)


def completeness(df: DataFrame, xs: list[str]) -> DataFrame:
    return _measure(df, "completeness", {"rows": F.count("*")} | {f"null_pct_{x}": F.avg(col(x).isNull().cast("int")) * 100 for x in xs})


def ranges(df: DataFrame, limits: dict[str, tuple[float, float]]) -> DataFrame:
    m = {}
    for x, (lo, hi) in limits.items():
        m |= {f"out_{x}": F.count_if((col(x) < lo) | (col(x) > hi)), f"min_{x}": F.min(x), f"max_{x}": F.max(x), f"ok_{x}": (F.avg(F.when(col(x).isNotNull(), ((col(x) < lo) | (col(x) > hi)).cast("int"))) <= 0.01).cast("int")}
    return _measure(df, "ranges", m)


def outliers(df: DataFrame, xs: list[str], z: float = 4.0) -> DataFrame:
    """Counts beyond z population deviations and beyond 1.5 interquartile ranges; one row of statistics is broadcast."""
    stats = df.agg(*[F.struct(F.avg(x).alias("m"), F.stddev_pop(x).alias("s")).alias(f"_{x}") for x in xs])
    df = df.crossJoin(F.broadcast(stats)).crossJoin(F.broadcast(quantiles(df, xs, [0.25, 0.75])))
    m = {}
    for x in xs:
        s, q = col(f"_{x}"), col(f"_q_{x}")
        span = q[1] - q[0]
        m |= {f"z_{x}": F.count_if(F.abs(col(x) - s["m"]) > z * s["s"]), f"iqr_{x}": F.count_if((col(x) < q[0] - 1.5 * span) | (col(x) > q[1] + 1.5 * span))}
    return _measure(df, "outliers", m)


def duplicates(df: DataFrame, keys: list[str], xs: list[str]) -> DataFrame:
    """Rows beyond the first of each group. Groups are counted by pre-aggregated sums, not by a distinct struct."""
    by_key = df.groupBy(*keys).agg(F.count("*").alias("n")).agg(F.sum(F.col("n") - 1).alias("duplicate_keys"))
    by_row = df.groupBy(*keys, *xs).agg(F.count("*").alias("n")).agg(F.sum(F.col("n") - 1).alias("duplicate_rows"))
    return as_rows(by_key.crossJoin(by_row), "duplicates")


def gaps(df: DataFrame) -> DataFrame:
    """Every step between dates of a series with its length in days."""
    return df.select("series_id", shift("date", 1).alias("start"), F.col("date").alias("end")).where("start is not null").withColumn("gap_days", F.date_diff("end", "start"))


def time_integrity(df: DataFrame, extra: int = 5) -> DataFrame:
    """Usual step (the smallest of the most frequent), gaps longer than that by over `extra` days, longest gap, weekend share."""
    steps = gaps(df)
    usual = steps.groupBy("gap_days").count().orderBy(F.desc("count"), "gap_days").limit(1).select(F.col("gap_days").alias("usual"))
    of_steps = steps.crossJoin(F.broadcast(usual)).agg(F.first("usual").alias("usual_step"), F.count_if(F.col("gap_days") > F.col("usual") + extra).alias("gaps"), F.max("gap_days").alias("longest_gap"))
    of_days = df.agg(F.date_diff(F.max("date"), F.min("date")).alias("span_days"), (F.avg((F.weekday("date") >= 5).cast("int")) * 100).alias("weekend_pct"))
    return as_rows(of_steps.crossJoin(of_days), "time_integrity")


def correlation_matrix(df: DataFrame, xs: list[str], wide: int = 24) -> DataFrame:
    """(a, b, corr) of every pair of columns, pairwise complete: from one aggregation, or, beyond `wide` columns, whose pairs would
    not fit into a plan, from Gram sums by blocks of columns."""
    if len(xs) > wide:
        return pairwise_correlations(df, xs)
    pairs = [(a, b) for i, a in enumerate(xs) for b in xs[i + 1 :]]
    row = df.agg(*[scorr(a, b).alias(f"{a}|{b}") for a, b in pairs])
    stack = ", ".join(f"'{a}', '{b}', `{a}|{b}`" for a, b in pairs)
    return row.selectExpr(f"stack({len(pairs)}, {stack}) AS (a, b, corr)")


def autocorrelation(df: DataFrame, x: str) -> DataFrame:
    return df.withColumn("_l", shift(x, 1)).groupBy("series_id").agg(scorr(x, "_l").alias("autocorr_1"))


def _halves(df: DataFrame) -> DataFrame:
    n = F.count("*").over(Window.partitionBy("series_id"))
    return df.withColumn("_half", F.when(F.row_number().over(by_date()) <= F.floor(n / 2), 1).otherwise(2))


def halves_t_test(df: DataFrame, x: str) -> DataFrame:
    """Pooled two-sample t of the first against the second half of each series, its degrees of freedom, and the probability of a
    larger one (both sides)."""
    side = lambda f, k: f(F.when(col("_half") == k, col(x)))
    s = _halves(df).groupBy("series_id").agg(*[side(f, k).alias(f"{n}{k}") for f, n in ((F.count, "n"), (F.avg, "m"), (F.var_samp, "v")) for k in (1, 2)])
    pooled = ((col("n1") - 1) * col("v1") + (col("n2") - 1) * col("v2")) / (col("n1") + col("n2") - 2)
    t = F.try_divide(col("m1") - col("m2"), F.sqrt(pooled * (1 / col("n1") + 1 / col("n2"))))
    tested = s.where("n1 > 1 and n2 > 1").select("series_id", t.alias("t"), (col("n1") + col("n2") - 2).alias("df"))
    return tested.withColumn("p", student_t_p(col("t"), col("df")))


def _drifts(df: DataFrame, xs: list[str]) -> DataFrame:
    """series_id and the drift score of each column, from one aggregation."""
    def one(x, k):
        part = F.when(col("_half") == k, col(x))
        return F.struct(F.count(part).alias("n"), F.try_divide(F.stddev_samp(part), F.abs(F.avg(part))).alias("cv")).alias(f"_{k}_{x}")

    s = _halves(df).groupBy("series_id").agg(F.count("*").alias("_rows"), *[one(x, k) for x in xs for k in (1, 2)])
    scores = []
    for x in xs:
        a, b = col(f"_1_{x}"), col(f"_2_{x}")
        change = F.abs(F.coalesce(b["cv"], F.lit(0.0)) - F.coalesce(a["cv"], F.lit(0.0)))
        scores.append(F.when((col("_rows") >= 20) & (a["n"] + b["n"] > 10), F.coalesce(change, F.lit(0.0))).otherwise(0.0).alias(f"_score_{x}"))
    return s.select("series_id", *scores)


def drift(df: DataFrame, x: str, limit: float = 0.2) -> DataFrame:
    """Change of the coefficient of variation between the halves of each series; 0 for under 20 rows or under 11 values."""
    score = col(f"_score_{x}")
    return _drifts(df, [x]).select("series_id", score.alias("drift_score"), (score > limit).cast("int").alias("drifted"))


def business_rules(df: DataFrame, never_negative: list[str], percent: list[str], rates: list[str] = (), opposed: list[tuple[str, str]] = ()) -> DataFrame:
    """Counts of values that cannot be: below 0, outside 0 to 100, rates outside -1 to 100; and correlations of pairs that should
    not move together."""
    m = {f"negative_{x}": F.count_if(col(x) < 0) for x in never_negative} | {f"outside_{x}": F.count_if(~col(x).between(0, 100)) for x in percent}
    m |= {f"unreasonable_{x}": F.count_if(~col(x).between(-1, 100)) for x in rates} | {f"corr_{a}_{b}": scorr(a, b) for a, b in opposed}
    return _measure(df, "business_rules", m)


def correlations(df: DataFrame, xs: list[str], most: float = 0.95) -> DataFrame:
    """Mean and largest absolute correlation of the pairs of columns, how many pairs exceed `most`, and the mean over the whole
    matrix, its diagonal included (columns that are constant left out)."""
    size = F.abs("corr")
    k = (1 + F.sqrt(1 + 8 * F.count("corr"))) / 2  # so many columns make that number of pairs
    whole = F.when(F.count("corr") > 0, (2 * F.sum(size) + k) / (k * k)).alias("matrix_mean_abs_corr")
    return as_rows(correlation_matrix(df, xs).agg(F.avg(size).alias("mean_abs_corr"), F.max(size).alias("max_abs_corr"), F.count_if(size > most).alias("redundant_pairs"), whole), "correlations")


def types(df: DataFrame, numeric: list[str]) -> DataFrame:
    """How many of the columns that should be numeric are missing or are not."""
    bad = len(wrong_types(df, numeric)) + sum(x not in df.columns for x in numeric)
    return as_rows(df.limit(0).agg(F.count("*").alias("n")).select(F.lit(bad).alias("wrong_types")), "data_types")


def drifted_series(df: DataFrame, xs: list[str], limit: float = 0.2) -> DataFrame:
    """How many series drift, for each column."""
    return as_rows(_drifts(df, xs).agg(*[F.count_if(col(f"_score_{x}") > limit).alias(f"drifted_{x}") for x in xs]), "drift")


Row = tuple[str, str, float | None]


def isolated(checks: dict[str, Callable[[], DataFrame]]) -> list[Row]:
    """{name: () -> (check, metric, value)}: the rows of all checks, a few for each. A check that cannot be planned or fails while
    it runs gives one row with the metric `error` and leaves the others standing."""
    rows: list[Row] = []
    for name, build in checks.items():
        try:
            rows += [(r["check"], r["metric"], r["value"]) for r in build().select("check", "metric", "value").collect()]
        except (PySparkException, KeyError, ValueError):
            rows.append((name, "error", 1.0))
    return rows


def observed(df: DataFrame, metrics: dict[str, dict[str, Column]], write: Callable[[DataFrame], object]) -> list[Row]:
    """{check: {metric: aggregate}} measured while write(df) runs, so that df is computed once for both."""
    found = Observation()
    named = {f"{check}|{metric}": c.cast("double") for check, of in metrics.items() for metric, c in of.items()}
    write(df.observe(found, *[c.alias(name) for name, c in named.items()]))
    got = found.get
    return [(*name.split("|", 1), got[name]) for name in named]


def plain_metrics(df: DataFrame, xs: list[str], limits: dict[str, tuple[float, float]], percent: list[str], most: float = 0.95) -> dict[str, dict[str, Column]]:
    """The checks that one pass of aggregates can answer: completeness, ranges, business rules and correlations."""
    m: dict[str, dict[str, Column]] = {"completeness": {"rows": F.count(F.lit(1))} | {f"null_pct_{x}": F.avg(col(x).isNull().cast("int")) * 100 for x in xs}}
    m["ranges"] = {}
    for x, (lo, hi) in limits.items():
        out = F.when(col(x).isNotNull(), ((col(x) < lo) | (col(x) > hi)).cast("int"))
        m["ranges"] |= {f"out_{x}": F.coalesce(F.sum(out), F.lit(0)), f"min_{x}": F.min(x), f"max_{x}": F.max(x), f"ok_{x}": (F.avg(out) <= 0.01).cast("int")}
    m["business_rules"] = {f"negative_{x}": F.count_if(col(x) < 0) for x in xs} | {f"outside_{x}": F.count_if(~col(x).between(0, 100)) for x in percent}
    size = [F.abs(scorr(a, b)) for i, a in enumerate(xs) for b in xs[i + 1 :]]
    if size:
        there = [c for s in size for c in (F.coalesce(s, F.lit(0.0)), s.isNotNull().cast("int"))]
        total, n = reduce(lambda a, b: a + b, there[::2]), reduce(lambda a, b: a + b, there[1::2])
        over = reduce(lambda a, b: a + b, [F.coalesce((s > most).cast("int"), F.lit(0)) for s in size])
        m["correlations"] = {"mean_abs_corr": F.try_divide(total, n), "max_abs_corr": F.greatest(*size) if len(size) > 1 else size[0], "redundant_pairs": over}
        k = (1 + F.sqrt(1 + 8 * n)) / 2
        m["correlations"]["matrix_mean_abs_corr"] = F.when(n > 0, (2 * total + k) / (k * k))
    return m


def extreme_values(df: DataFrame, xs: list[str], k: float = 5.0) -> DataFrame:
    stats = df.agg(*[F.struct(F.avg(x).alias("m"), F.stddev_samp(x).alias("s")).alias(f"_{x}") for x in xs])
    df = df.crossJoin(F.broadcast(stats))
    return _measure(df, "extreme_values", {f"extreme_{x}": F.count_if(F.abs(col(x) - col(f"_{x}")["m"]) > k * col(f"_{x}")["s"]) for x in xs})


def cross_source(df: DataFrame, a: str, b: str) -> DataFrame:
    return _measure(df, "cross_source", {"mean_abs_pct_diff": F.avg(F.abs(F.try_divide(col(a) - col(b), col(b)))) * 100})


def summary(df: DataFrame, xs: list[str]) -> DataFrame:
    plain, ranked = [], []
    for x in xs:
        plain += [F.avg(x).alias(f"{x}_mean"), F.stddev_samp(x).alias(f"{x}_std"), F.min(x).alias(f"{x}_min"), F.max(x).alias(f"{x}_max")]
        ranked += [col(f"_q_{x}")[i].alias(f"{x}_{name}") for i, name in enumerate(("q25", "median", "q75"))]
    return as_rows(df.agg(*plain).crossJoin(quantiles(df, xs, [0.25, 0.5, 0.75]).select(*ranked)), "summary")


def source_checks(df: DataFrame, limits: dict[str, tuple[float, float]], today: Column | None = None) -> DataFrame:
    """For each column the share of rows inside its limits (a NULL is outside), its NULL share and its coverage; age of the newest row."""
    m = {}
    for x, (lo, hi) in limits.items():
        inside = F.coalesce(col(x).between(lo, hi), F.lit(False)).cast("int")
        m |= {f"valid_{x}": F.avg(inside), f"all_valid_{x}": F.min(inside), f"null_pct_{x}": F.avg(col(x).isNull().cast("int")) * 100, f"coverage_{x}": F.try_divide(F.count(x), F.count("*"))}
    newest = {"days_old": F.date_diff(F.current_date() if today is None else today, F.max("date"))}
    return _measure(df, "source", m | newest)


def expected_correlations(df: DataFrame, expected: dict[tuple[str, str], tuple[float, float]]) -> DataFrame:
    """Correlation of each named pair and whether it is where it is expected."""
    row = df.agg(*[scorr(a, b).alias(f"{a}|{b}") for a, b in expected])
    parts = ", ".join(f"'{a}', '{b}', `{a}|{b}`, `{a}|{b}` BETWEEN {lo} AND {hi}" for (a, b), (lo, hi) in expected.items())
    return row.selectExpr(f"stack({len(expected)}, {parts}) AS (a, b, corr, expected)").withColumn("expected", F.coalesce(F.col("expected"), F.lit(False)).cast("int"))


def redundant_pairs(df: DataFrame, xs: list[str], most: float = 0.95) -> DataFrame:
    """Pairs of columns whose absolute correlation exceeds `most`."""
    return correlation_matrix(df, xs).where(F.abs("corr") > most)


#: What to do about an issue, by a word in it.
ADVICE = {"null": "fill missing values", "duplicate": "drop duplicates", "z_": "winsorize outliers", "iqr_": "winsorize outliers", "extreme": "winsorize outliers", "gap": "align the calendar", "out_": "clip to the allowed range", "corr": "drop redundant columns"}


def recommendations(checks: DataFrame) -> DataFrame:
    """verdicts() rows -> (check, issue, advice) of every issue; the first word of ADVICE in it decides."""
    advice = F.lit("look at it by hand")
    for word, what in reversed(ADVICE.items()):
        advice = F.when(F.contains(F.col("issue"), F.lit(word)), what).otherwise(advice)
    return checks.select("check", F.explode("issues").alias("issue")).withColumn("advice", advice)


def wrong_types(df: DataFrame, numeric: list[str]) -> list[str]:
    """Columns that should be numeric and are not, from the schema alone."""
    kinds = dict(df.dtypes)
    return [x for x in numeric if x in kinds and not kinds[x].startswith(("tinyint", "smallint", "int", "bigint", "float", "double", "decimal"))]


def verdicts(rows: DataFrame, limits: dict[str, tuple[float | None, float | None]]) -> DataFrame:
    """(check, metric, value) rows to one row for each check: passed, issues, metrics."""
    bad = F.lit(None).cast("string")
    for metric, (lo, hi) in limits.items():
        out = (F.col("value") < lo if lo is not None else F.lit(False)) | (F.col("value") > hi if hi is not None else F.lit(False))
        bad = F.when((F.col("metric") == metric) & out, F.format_string("%s = %s", F.col("metric"), F.col("value"))).otherwise(bad)
    grouped = rows.withColumn("issue", bad).groupBy("check").agg(F.sort_array(F.collect_list("issue")).alias("issues"), F.map_from_entries(F.sort_array(F.collect_list(F.struct("metric", "value")))).alias("metrics"))
    return grouped.select("check", (F.size("issues") == 0).alias("passed"), "issues", "metrics")
