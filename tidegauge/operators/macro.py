"""What sources derive from their own series: growth rates, spreads, recession parts, cross-asset measures, time features."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.windows import col, diff, flag, pad, pct, ratio, roll, rows, scorr, shift
from tidegauge.operators.features import first_valid, rolling_quantiles, row_stat

#: The weights of the recession score.
RECESSION = {"inversion": 0.3, "unemployment": 0.2, "production": 0.15, "stress": 0.15, "spread": 0.1, "sentiment": 0.1}


def growth(df: DataFrame, x: str, year: int = 12, quarter: int = 3) -> DataFrame:
    """Percent changes of a series at its own frequency: a year, a row, and a quarter times four; steps and their mean over 3 rows."""
    df = df.withColumn("_pad", pad(x)).withColumn(f"{x}_change", diff(x, 1))
    add = {f"{x}_yoy": pct("_pad", year) * 100, f"{x}_mom": pct("_pad", 1) * 100, f"{x}_3m_annualized": pct("_pad", quarter) * 400, f"{x}_change_3_avg": roll(F.avg, f"{x}_change", 3)}
    return df.withColumns(add).drop("_pad")


def spreads(df: DataFrame, pairs: dict[str, tuple[str, str]]) -> DataFrame:
    """name -> (long, short): the difference and whether it is below zero."""
    df = df.withColumns({name: col(a) - col(b) for name, (a, b) in pairs.items()})
    return df.withColumns({f"{name}_inverted": flag(col(name) < 0) for name in pairs})


def recession(df: DataFrame, **series: str) -> DataFrame:
    """Weighted recession flags from those of inversion (a 0/1 column), unemployment, production, stress, spread and sentiment that are named."""
    unknown = set(series) - set(RECESSION)
    if unknown:
        raise ValueError(f"no such part: {sorted(unknown)}")
    if "production" in series:
        df = df.withColumn("_pad", pad(series["production"]))
    ranked = {part: 0.2 if part == "sentiment" else 0.8 for part in ("stress", "spread", "sentiment") if part in series}
    if ranked:
        df = rolling_quantiles(df, {f"_q_{part}": (series[part], q) for part, q in ranked.items()})
    flags: dict[str, Column] = {}
    for part, x in series.items():
        if part == "inversion":
            flags[part] = col(x) == 1
        elif part == "unemployment":
            flags[part] = roll(F.avg, x, 3) - roll(F.min, x, 12) > 0.5
        elif part == "production":
            flags[part] = pct("_pad", 12) < 0
        else:
            flags[part] = col(x) < col(f"_q_{part}") if part == "sentiment" else col(x) > col(f"_q_{part}")
    df = df.withColumns({f"_f_{part}": flag(c) for part, c in flags.items()})
    score = reduce(lambda a, b: a + b, [col(f"_f_{part}") * RECESSION[part] for part in flags])
    df = df.withColumn("recession_probability_score", F.least(F.greatest(score, F.lit(0.0)), F.lit(1.0)))
    return df.withColumn("recession_risk_high", flag(col("recession_probability_score") > 0.5)).drop("_pad", *[f"_{k}_{part}" for k in "fq" for part in flags])


def cross_asset(df: DataFrame, risk_on: list[str], risk_off: list[str], basket: list[str]) -> DataFrame:
    """Over columns of one wide frame: spread of mean changes, dispersion of changes a year, base-100 mean of the basket."""
    xs = list(dict.fromkeys([*risk_on, *risk_off, *basket]))
    df = df.withColumns({f"_pad_{x}": pad(x) for x in xs})
    df = df.withColumns({f"_r_{x}": pct(f"_pad_{x}", 1) for x in xs} | {f"_b_{x}": ratio(x, first_valid(x)) * 100 for x in basket})
    mean = lambda names: row_stat([col(f"_r_{x}") for x in names], "mean")
    df = df.withColumns({
        "risk_on_off": mean(risk_on) - mean(risk_off),
        "basket_volatility": row_stat([col(f"_r_{x}") for x in basket], "std") * 252**0.5,
        "basket": row_stat([col(f"_b_{x}") for x in basket], "mean"),
        "on_off_correlation": scorr(f"_r_{risk_on[0]}", f"_r_{risk_off[0]}", rows(66), 66),
    })
    return df.drop(*[f"_pad_{x}" for x in xs], *[f"_r_{x}" for x in xs], *[f"_b_{x}" for x in basket])


def day_range(df: DataFrame, p: str = "close", h: str = "high", low: str = "low") -> DataFrame:
    """The day's range over the price, and changes over a week and a month."""
    df = df.withColumn("_pad", pad(p))
    return df.withColumns({"range_volatility": ratio(col(h) - col(low), p), "momentum_5d": pct("_pad", 5), "momentum_22d": pct("_pad", 22)}).drop("_pad")


def temporal(df: DataFrame, lagged: list[str], rolled: list[str], lags=(1, 2, 5, 10, 22), spans=(5, 22, 66)) -> DataFrame:
    """Lags, rolling means and deviations, calendar columns and cycles, all in one window of a series."""
    d, two_pi = col("date"), 2 * F.pi()
    add = {f"{x}_lag_{k}": shift(x, k) for x in lagged for k in lags}
    for x in rolled:
        for n in spans:
            add |= {f"{x}_rolling_mean_{n}": roll(F.avg, x, n), f"{x}_rolling_std_{n}": roll(F.stddev_samp, x, n)}
    month_end = F.last_day(d) == d
    add |= {
        "day_of_week": F.weekday(d), "day_of_month": F.day(d), "month": F.month(d), "quarter": F.quarter(d),
        "is_month_end": flag(month_end), "is_quarter_end": flag(month_end & (F.month(d) % 3 == 0)),
        "month_sin": F.sin(two_pi * F.month(d) / 12), "month_cos": F.cos(two_pi * F.month(d) / 12),
        "day_of_week_sin": F.sin(two_pi * F.weekday(d) / 7), "day_of_week_cos": F.cos(two_pi * F.weekday(d) / 7),
    }
    return df.withColumns(add)
