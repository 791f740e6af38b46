"""Source to sink in one lazy plan: align sources, clean, engineer features, validate, export; full and incremental."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidegauge.operators import cleaning, features, indicators, quality
from tidegauge.plans import sinks
from tidegauge.sources import files


@dataclass
class Settings:
    price: str = "close"
    numeric: list[str] = field(default_factory=lambda: ["open", "high", "low", "close"])
    ranges: dict[str, tuple[float, float]] = field(default_factory=dict)
    lags: tuple[int, ...] = (1, 2, 5, 10, 22, 44, 66)
    #: Policy rate and inflation here and abroad; long and short yield.
    rates: tuple[str, str, str, str] = ("policy_rate", "inflation", "policy_rate_us", "inflation_us")
    curve: tuple[str, str] = ("yield_long", "yield_short")
    index_weights: dict[str, float] = field(default_factory=dict)
    risk_weights: dict[str, float] = field(default_factory=dict)
    levels: dict[str, tuple[tuple[int, ...], tuple[float, ...]]] = field(default_factory=dict)
    others: list[str] = field(default_factory=list)
    rolled: list[str] = field(default_factory=list)
    pairs: list[tuple[str, str, str]] = field(default_factory=list)
    #: Rows that the longest windows look back: 252 and 66 on top of each other, 479 for the slowest recursive mean.
    look_back: int = 800


def engineer(df: DataFrame, s: Settings, keep_sparse: bool = False) -> DataFrame:
    """All feature stages in order: rates, their momentum and the yield curve, volatility, index, levels, risk score, carry, correlations, price
    action, calendar, lags, rolling statistics, interactions, cleaning. A stage whose columns are missing is left out."""
    has = lambda *xs: set(xs) <= set(df.columns)
    if has(*s.rates):
        df = features.real_rates(df, *s.rates)
    df = features.rate_momentum(df, [x for x in (s.rates[0], s.rates[2]) if has(x)])
    if has(*s.curve):
        df = features.yield_curve(df, *s.curve)
    df = features.returns_and_volatility(df, s.price)
    if has("high", "low"):
        df = features.parkinson(df)
    if has(*s.index_weights) and s.index_weights:
        df = features.weighted_index(df, s.index_weights)
    for x, (means, above) in s.levels.items():
        df = features.level_flags(df, x, means, above) if has(x) else df
    if any(has(x) for x in s.risk_weights):
        df = features.risk_score(df, s.risk_weights)
    if has("real_interest_differential"):
        df = features.carry(df)
    if others := [x for x in s.others if has(x)]:
        df = features.rolling_correlations(df, s.price, others)
    df = features.calendar_features(features.price_action(df, s.price))
    df = features.lag_features(df, [s.price], s.lags)
    df = features.rolling_features(df, [x for x in s.rolled if has(x)])
    df = features.interactions(df, s.pairs)
    return features.settle(df) if keep_sparse else features.drop_sparse(df)


def run(frames: list[DataFrame], s: Settings, out: str | None = None, kind: str = "parquet", dry_run: bool = False) -> tuple[DataFrame, dict | None]:
    """Frames keyed by series_id and date -> features, and what was written (nothing on a dry run)."""
    joined = cleaning.outer_join(frames, ["series_id", "date"])
    df = engineer(cleaning.clip_ranges(cleaning.fill(joined, s.numeric), s.ranges), s)
    return df, sinks.export(df, out, kind) if out and not dry_run else None


def incremental(history: DataFrame, s: Settings, since: date) -> DataFrame:
    """Features of the dates from `since` on, from a history cut to what their windows can see: of each series the last
    `look_back` rows before `since`, whatever its frequency. Cleaning is that of run(); no column goes as sparse, which a cut history cannot tell."""
    place = F.row_number().over(Window.partitionBy("series_id").orderBy(F.desc("date")))
    old = history.where(F.col("date") < F.lit(since)).withColumn("_place", place).where(F.col("_place") <= s.look_back).drop("_place")
    df = old.unionByName(history.where(F.col("date") >= F.lit(since)))
    return engineer(cleaning.clip_ranges(cleaning.fill(df, s.numeric), s.ranges), s, keep_sparse=True).where(F.col("date") >= F.lit(since))


def daily(history: DataFrame, s: Settings, since: date, target: str) -> dict:
    """Features from `since` on into a stored target, whose earlier dates stay: what a daily run or a backfill writes."""
    return sinks.replace_since(incremental(history, s, since), target, since)


def validate(df: DataFrame, s: Settings, limits: dict[str, tuple[float | None, float | None]], extra: int = 5) -> DataFrame:
    """One row for each check: passed, issues, metrics; see measured()."""
    return quality.verdicts(measured(df, s, extra), {"error": (None, 0), "wrong_types": (None, 0), **limits})


def measured(df: DataFrame, s: Settings, extra: int = 5) -> DataFrame:
    """(check, metric, value) of all checks. df is computed once: its keys and numeric columns are written to the shared folder while
    what one pass can tell is observed; checks that need statistics first read the columns written. A check that fails, in
    planning or while it runs, gives the metric `error` and leaves the others standing."""
    spark = df.sparkSession
    xs = [x for x in s.numeric if x in df.columns and not quality.wrong_types(df, [x])]
    ranges = {x: r for x, r in s.ranges.items() if x in xs} or dict.fromkeys(xs, (float("-inf"), float("inf")))
    percent = [x for x in ("risk_sentiment_score",) if x in df.columns]
    path = files.shared_path(spark, "checked")
    narrow = df.select(*dict.fromkeys(["series_id", "date", *xs, *percent]))
    rows = quality.observed(narrow, quality.plain_metrics(narrow, xs, ranges, percent), lambda d: d.write.parquet(path))
    kept = spark.read.schema(narrow.schema).parquet(path)
    absent = len(xs) < len(s.numeric)
    numeric = s.numeric if absent else xs  # a column that is not there fails the checks that need it, and no others
    if absent:
        rows = [r for r in rows if r[0] == "completeness"] + [(c, "error", 1.0) for c in ("ranges", "business_rules", "correlations")]
    rows += quality.isolated({
        "data_types": lambda: quality.types(df, s.numeric), "outliers": lambda: quality.outliers(kept, numeric),
        "duplicates": lambda: quality.duplicates(kept, ["series_id", "date"], numeric), "time_integrity": lambda: quality.time_integrity(kept, extra),
        "extreme_values": lambda: quality.extreme_values(kept, numeric), "drift": lambda: quality.drifted_series(kept, numeric),
    })
    return spark.createDataFrame(rows, "check string, metric string, value double")
