"""Feature families over series frames (series_id, date, ...): rates, volatility, correlation, composites, calendar, lags."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidegauge.functions.orders import Quantile, Rank, with_order_stats
from tidegauge.functions.windows import by_date, col, diff, ewm_std, ffill, flag, padded, pct, ratio, roll, rows, running, scorr, shift, stage

YEAR = 252**0.5
LAGS, WINDOWS = (1, 2, 5, 10, 22, 44, 66), (5, 10, 22, 44, 66)


def with_pct(df: DataFrame, x: str, periods: dict[str, int], scale: float = 1.0) -> DataFrame:
    """Changes over k rows, missing values carried forward first: {name: k}."""
    change = lambda k: pct("_pad", k) * scale if scale != 1 else pct("_pad", k)
    df = padded(df, {"_pad": x})
    return stage(df, max(periods.values()), lambda d: d.withColumns({name: change(k) for name, k in periods.items()})).drop("_pad")


def real_rates(df: DataFrame, policy="policy_rate", inflation="inflation", policy2="policy_rate_us", inflation2="inflation_us") -> DataFrame:
    df = df.withColumns({"real_rate": col(policy) - col(inflation), "us_real_rate": col(policy2) - col(inflation2)})
    df = df.withColumn("real_interest_differential", col("real_rate") - col("us_real_rate"))
    r = "real_interest_differential"
    means = lambda: {f"real_diff_ma_{n}": roll(F.avg, r, n) for n in (5, 22, 66)}
    return stage(df, 66, lambda d: d.withColumns(means() | {f"real_diff_change_{n}d": diff(r, n) for n in (5, 22)}))


def yield_curve(df: DataFrame, long: str = "yield_long", short: str = "yield_short") -> DataFrame:
    return df.withColumn("yield_curve_slope", col(long) - col(short)).withColumn("yield_curve_inverted", flag(col("yield_curve_slope") < 0))


def rate_momentum(df: DataFrame, rates: list[str], spans=(5, 22)) -> DataFrame:
    """Changes of rates over each span, missing values carried forward first."""
    for x in rates:
        df = with_pct(df, x, {f"{x}_momentum_{n}d": n for n in spans})
    return df


def returns_and_volatility(df: DataFrame, p: str = "close") -> DataFrame:
    df = with_pct(df, p, {"returns": 1})
    df = stage(df, 1, lambda d: d.withColumn("log_returns", F.ln(ratio(p, shift(p, 1)))))
    df = stage(df, 66, lambda d: d.withColumns({f"volatility_{n}d": roll(F.stddev_samp, "log_returns", n) * YEAR for n in WINDOWS}))
    df = ewm_std(df, "volatility_ewma", "log_returns", 22).withColumn("volatility_ewma", col("volatility_ewma") * YEAR)
    v = "volatility_22d"
    score = lambda: ratio(col(v) - roll(F.avg, v, 252), roll(F.stddev_samp, v, 252))
    df = stage(df, 252, lambda d: d.withColumns({"vol_of_vol": roll(F.stddev_samp, v, 22), "volatility_zscore": score()}))
    return df.withColumn("high_vol_regime", flag(col("volatility_zscore") > 1))


def parkinson(df: DataFrame, h: str = "high", low: str = "low") -> DataFrame:
    df = df.withColumn("_hl2", F.pow(F.ln(ratio(h, low)), 2))
    vol = lambda: F.sqrt(roll(F.avg, "_hl2", 22) * 252 / (4 * F.ln(F.lit(2.0))))
    return stage(df, 22, lambda d: d.withColumn("parkinson_vol", vol())).drop("_hl2")


def level_flags(df: DataFrame, x: str, means=(5, 22), above=(20, 30)) -> DataFrame:
    df = stage(df, max(means), lambda d: d.withColumns({f"{x}_ma_{n}": roll(F.avg, x, n) for n in means}))
    return df.withColumns({f"{x}_above_{k}": flag(col(x) > k) for k in above})


def first_valid(x: str) -> Column:
    return F.first(col(x), ignorenulls=True).over(by_date().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))


def weighted_index(df: DataFrame, weights: dict[str, float], name: str = "commodity_index") -> DataFrame:
    """Base-100 series weighted by what of the weights is there; NULL where any of them is."""
    there = {c: w for c, w in weights.items() if c in df.columns}
    total = sum(there.values())
    df = running(df, {f"_first_{c}": ("first", c) for c in there})
    parts = [ratio(c, f"_first_{c}") * 100 * (w / total) for c, w in there.items()]
    df = df.withColumn(name, reduce(lambda a, b: a + b, parts)).drop(*[f"_first_{c}" for c in there])
    return with_pct(df, name, {f"{name}_momentum_5d": 5, f"{name}_momentum_22d": 22})


def min_max_score(x: str, n: int = 252) -> Column:
    low, high = roll(F.min, x, n, n // 4), roll(F.max, x, n, n // 4)
    share = F.least(F.greatest((col(x) - low) / (high - low) * 100, F.lit(0.0)), F.lit(100.0))
    return F.when(col(x).isNotNull() & low.isNotNull() & (high > low), share)


def risk_score(df: DataFrame, weights: dict[str, float]) -> DataFrame:
    """Weighted rolling min-max percentiles of the components that are there, 0 to 100."""
    there = {c: w for c, w in weights.items() if c in df.columns}
    total = sum(there.values())
    df = stage(df, 252, lambda d: d.withColumns({f"_s_{c}": min_max_score(c) for c in there}))
    score = reduce(lambda a, b: a + b, [col(f"_s_{c}") * (w / total) for c, w in there.items()])
    bounded = F.when(score.isNotNull(), F.least(F.greatest(score, F.lit(0.0)), F.lit(100.0)))
    df = df.withColumn("risk_sentiment_score", bounded).drop(*[f"_s_{c}" for c in there])
    return df.withColumns({"risk_off": flag(col("risk_sentiment_score") > 60), "risk_on": flag(col("risk_sentiment_score") < 40)})


def carry(df: DataFrame, differential: str = "real_interest_differential", vol: str = "volatility_22d") -> DataFrame:
    def go(d):
        d = d.withColumn("carry_attractiveness", col("carry_return") / (roll(F.avg, vol, 22) + 0.01))
        above = flag(col("carry_attractiveness") > roll(F.avg, "carry_attractiveness", 66))
        return d.withColumns({"carry_momentum": diff("carry_attractiveness", 22), "carry_above_ma": above})

    return stage(df.withColumn("carry_return", col(differential) / 100), 22 + 66, go)


def rolling_correlations(df: DataFrame, p: str, others: list[str], spans=(22, 66)) -> DataFrame:
    xs = (p, *others)

    def go(d):
        d = d.withColumns({f"_r_{c}": pct(f"_pad_{c}", 1) for c in xs})
        d = d.withColumns({f"corr_{c}_{n}d": scorr(f"_r_{p}", f"_r_{c}", rows(n), n) for c in others for n in spans})
        return d.withColumn("correlation_stability", roll(F.stddev_samp, f"corr_{others[0]}_{spans[0]}d", 66))

    df = stage(padded(df, {f"_pad_{c}": c for c in xs}), 1 + max(spans) + 66, go)
    return df.drop(*[f"_{k}_{c}" for k in ("pad", "r") for c in xs])


def price_action(df: DataFrame, p: str = "close") -> DataFrame:
    def go(d):
        means = {n: roll(F.avg, p, n) for n in (5, 22, 50, 200)}
        far = {f"distance_from_ma_{n}": ratio(col(p) - m, m) for n, m in means.items()}
        d = d.withColumns(far | {"resistance_1m": roll(F.max, p, 22), "support_1m": roll(F.min, p, 22)})
        edges = {"distance_from_resistance": ratio(col("resistance_1m") - col(p), p), "distance_from_support": ratio(col(p) - col("support_1m"), p)}
        return d.withColumns(edges | {f"roc_{n}d": ratio(p, shift(p, n)) - 1 for n in (5, 10, 22)})

    return with_pct(stage(df, 200, go), p, {"price_momentum_5d": 5, "price_momentum_22d": 22})


def calendar_features(df: DataFrame) -> DataFrame:
    d, two_pi = col("date"), 2 * F.pi()
    month, day, week = F.month(d), F.day(d), F.weekday(d)
    add = {
        "year": F.year(d), "month": month, "day": day, "day_of_week": week, "day_of_year": F.dayofyear(d), "quarter": F.quarter(d), "week_of_year": F.weekofyear(d),
        "carnival": flag(month.isin(2, 3)), "year_end": flag((month >= 11) | (month <= 2)), "harvest": flag(month.between(3, 7)), "vacation": flag(month.isin(1, 7, 12)),
        "is_monday": flag(week == 0), "is_friday": flag(week == 4), "mid_month": flag(day.between(10, 20)), "late_month": flag(day >= 25),
        "is_month_end": flag(F.last_day(d) == d), "is_quarter_end": flag((F.last_day(d) == d) & (month % 3 == 0)),
    }
    for name, x, n in (("month", month, 12), ("day", day, 31), ("day_of_year", F.dayofyear(d), 365), ("weekday", week, 7)):
        add |= {f"{name}_sin": F.sin(two_pi * x / n), f"{name}_cos": F.cos(two_pi * x / n)}
    return df.withColumns(add)


def lag_features(df: DataFrame, xs: list[str], periods=LAGS) -> DataFrame:
    def go(d):
        add = {}
        for x in xs:
            for k in periods:
                add |= {f"{x}_lag_{k}": shift(x, k), f"{x}_return_{k}": pct(f"_pad_{x}", k), f"{x}_diff_{k}": diff(x, k)}
        return d.withColumns(add)

    return stage(padded(df, {f"_pad_{x}": x for x in xs}), max(periods), go).drop(*[f"_pad_{x}" for x in xs])


def rolling_features(df: DataFrame, xs: list[str], spans=WINDOWS) -> DataFrame:
    """Mean, deviation, extremes, z-score and percentile rank of each column over each span."""
    if not xs:
        return df

    def go(d):
        add = {}
        for x in xs:
            for n in spans:
                mean, sd = roll(F.avg, x, n), roll(F.stddev_samp, x, n)
                add |= {f"{x}_mean_{n}": mean, f"{x}_std_{n}": sd, f"{x}_min_{n}": roll(F.min, x, n), f"{x}_max_{n}": roll(F.max, x, n)}
                add[f"{x}_zscore_{n}"] = (col(x) - mean) / (sd + 1e-8)
        return with_order_stats(d.withColumns(add), {f"{x}_rank_{n}": Rank(x, n) for x in xs for n in spans})

    return stage(df, max(spans), go)


def interactions(df: DataFrame, pairs: list[tuple[str, str, str]]) -> DataFrame:
    """(a, b, multiply | divide | add | subtract) -> a_x_b."""
    ops = {"multiply": lambda a, b: a * b, "divide": lambda a, b: a / (b + 1e-8), "add": lambda a, b: a + b, "subtract": lambda a, b: a - b}
    return df.withColumns({f"{a}_x_{b}": ops[how](col(a), col(b)) for a, b, how in pairs if a in df.columns and b in df.columns})


def recession_score(df: DataFrame, parts: dict[str, tuple[Column, float]]) -> DataFrame:
    """Weighted flags, 0 to 1, and whether over a half."""
    score = reduce(lambda a, b: a + b, [flag(c) * w for c, w in parts.values()])
    return df.withColumn("recession_probability", F.least(F.greatest(score, F.lit(0.0)), F.lit(1.0))).withColumn("recession_warning", flag(col("recession_probability") > 0.5))


def rolling_quantiles(df: DataFrame, wanted: dict[str, tuple[str, float]], n: int = 252) -> DataFrame:
    """{out: (column, q)}: quantiles of the last n values, NULL until there are n."""
    return stage(df, n, lambda d: with_order_stats(d, {out: Quantile(x, n, q) for out, (x, q) in wanted.items()}))


def row_stat(xs: list[Column], what: str) -> Column:
    """mean, std (sample) or sum across columns of a row, nulls skipped; the sum of nothing is 0."""
    v = F.filter(F.array(*xs), lambda x: x.isNotNull())
    total = F.aggregate(v, F.lit(0.0), lambda s, x: s + x)
    if what == "sum":
        return total
    mean = F.try_divide(total, F.size(v))
    if what == "mean":
        return mean
    return F.when(F.size(v) > 1, F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + (x - mean) * (x - mean)) / (F.size(v) - 1)))


def stress_index(df: DataFrame, vix: str, em: str) -> DataFrame:
    def go(d):
        z = ratio(col(vix) - roll(F.avg, vix, 252), roll(F.stddev_samp, vix, 252))
        top = roll(F.max, em, 252)
        return d.withColumn("em_stress", z * F.abs(ratio(col(em) - top, top)))

    return stage(df, 252, go)


def importance(df: DataFrame, p: str, xs: list[str], ahead: int = 5) -> DataFrame:
    """Absolute correlation of each column with the change `ahead` rows later, all series together."""
    df = padded(df, {"_pad": p})
    df = stage(df, ahead, lambda d: d.withColumn("_c", pct("_pad", ahead)))
    df = stage(df, 0, lambda d: d.withColumn("_target", shift("_c", -ahead)), ahead=ahead)
    row = df.agg(*[F.abs(scorr(x, "_target")).alias(x) for x in xs])
    pairs = ", ".join(f"'{x}', `{x}`" for x in xs)
    return row.selectExpr(f"stack({len(xs)}, {pairs}) AS (feature, importance)").orderBy(F.desc("importance"), "feature")


def settle(df: DataFrame, keys=("series_id", "date"), limit: int = 5) -> DataFrame:
    """Infinities to NULL, then forward fill of at most `limit` rows."""
    xs = [c for c, t in df.dtypes if c not in keys and t in ("double", "float")]
    bad = lambda x: F.isnan(col(x)) | (F.abs(col(x)) == float("inf"))
    df = df.withColumns({x: F.when(~bad(x), col(x)) for x in xs})
    return stage(df, limit, lambda d: d.withColumns({x: ffill(x, limit) for x in xs}))


def drop_sparse(df: DataFrame, keys=("series_id", "date"), limit: int = 5, most: float = 0.5) -> DataFrame:
    """settle(), then columns with over half NULL go (one pass of counts)."""
    df = settle(df, keys, limit)
    xs = [c for c, t in df.dtypes if c not in keys and t in ("double", "float")]
    share = df.agg(*[F.avg(col(x).isNull().cast("int")).alias(x) for x in xs]).first()
    return df.drop(*[x for x in xs if share[x] is not None and share[x] > most])
