"""Series split into blocks against whole ones, and rolling order statistics against numpy."""

from datetime import date, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidegauge.functions import windows as w
from tidegauge.functions.orders import Deviation, Quantile, Rank, Wavelet, with_order_stats
from tidegauge.operators import features, indicators

DAY = date(2000, 1, 1)


@pytest.fixture(scope="module")
def bars(spark):
    """Series of 1 to 700 rows, one without an id, with missing prices, leading ones too, and dates that come in bursts."""
    rng = np.random.default_rng(1)
    rows = []
    for name, n in (("a", 700), ("b", 333), (None, 150), ("d", 1), ("e", 64)):
        day = np.cumsum(np.where(rng.random(n) < 0.9, 1, rng.integers(20, 200, n)))
        price = 100 + np.cumsum(rng.standard_normal(n))
        for k in range(n):
            p = float(price[k])
            gone = rng.random() < 0.04 or (name == "b" and k < 30) or (name == "a" and 300 <= k < 420)
            high, low, volume = p + rng.random(), p - rng.random(), float(rng.integers(1, 50))
            rows.append((name, DAY + timedelta(days=int(day[k])), None if gone else p, high, low, volume if rng.random() < 0.95 else None))
    return spark.createDataFrame(rows, "series_id string, date date, close double, high double, low double, volume double").repartition(3).cache()


def features_all(df):
    df = features.carry(features.returns_and_volatility(features.real_rates(df.withColumn("r", F.col("high") - 90), "r", "low", "high", "close")))
    df = features.rolling_features(features.lag_features(features.price_action(features.parkinson(df)), ["close"]), ["close"], (5, 66))
    df = features.risk_score(features.weighted_index(df, {"close": 0.5, "low": 0.5}), {"close": 0.3, "low": 0.2})
    return features.rate_momentum(features.rolling_correlations(features.level_flags(df, "volume"), "close", ["low"]), ["high"])


def indicators_all(df):
    for family in (indicators.moving_averages, indicators.exponential_averages, indicators.bollinger, indicators.volume_indicators):
        df = family(df)
    return df


def indicators_more(df):
    for family in (indicators.macd, indicators.rsi, indicators.adx, indicators.ichimoku, indicators.oscillators, indicators.patterns):
        df = family(df)
    return df


@pytest.mark.parametrize("family,size", [(indicators_all, 50), (indicators_more, 256), (features_all, 100)])
def test_blocks_change_nothing(bars, family, size):
    keys = ["series_id", "date"]
    whole, split = (f.toPandas().sort_values(keys).reset_index(drop=True) for f in (family(bars), w.by_blocks(bars, family, size)))
    assert list(whole.columns) == list(split.columns) and len(whole) == len(split)
    for c in whole.columns[2:]:
        a, b = whole[c].astype(float), split[c].astype(float)
        assert np.allclose(a, b, rtol=1e-9, atol=1e-9, equal_nan=True), (c, np.flatnonzero(~np.isclose(a, b, rtol=1e-9, atol=1e-9, equal_nan=True))[:9])


def test_rest_of_the_indicators_in_blocks(bars):
    def family(df):
        return indicators.pivots(indicators.channels(indicators.atr(indicators.momentum(indicators.weighted_averages(df)))))

    whole, split = (f.orderBy("series_id", "date").toPandas() for f in (family(bars), w.by_blocks(bars, family, 100)))
    for c in whole.columns[2:]:
        assert np.allclose(whole[c].astype(float), split[c].astype(float), rtol=1e-9, atol=1e-9, equal_nan=True), c


def test_what_cannot_be_split_is_an_error(bars):
    for family in (lambda d: d.withColumn("y", w.roll(F.avg, "close", 3)), lambda d: w.stage(d, 3, lambda e: e.withColumn("y", w.pad("close"))), lambda d: w.stage(d, 3, lambda e: w.padded(e, {"y": "close"}))):
        with pytest.raises(RuntimeError):
            w.by_blocks(bars, family, 100)
    assert w.by_date() is not None  # the settings are back
    with pytest.raises(ValueError):
        w.by_blocks(bars, indicators.moving_averages, 0)


def test_a_long_series_is_many_groups(spark):
    n = 200_000
    df = spark.range(n).select(F.lit("one").alias("series_id"), F.timestamp_seconds(F.col("id")).alias("date"), F.sin("id").alias("close"))
    rows = w.blocks(df, 10_000)
    assert sorted((r["_block"], r["count"]) for r in rows.groupBy("_block").count().collect()) == [(k, 10_000) for k in range(20)]
    assert rows.where(F.col("_rn") != F.col("date").cast("long")).isEmpty()
    got = w.by_blocks(df, lambda d: w.running(d, {"total": ("sum", "close")}), 10_000).orderBy(F.desc("date")).first()
    assert abs(got.total - np.sin(np.arange(n)).sum()) < 1e-6


@pytest.mark.parametrize("seed", range(4))
def test_wavelet(seed):
    rng = np.random.default_rng(seed)
    values = np.round(rng.standard_normal(rng.integers(1, 300)), seed % 3)
    tree = Wavelet(values)
    start = rng.integers(0, len(values), 400)
    end = np.minimum(len(values), start + rng.integers(1, 90, 400))
    x = np.where(rng.random(400) < 0.5, rng.choice(values, 400), rng.standard_normal(400) * 2)
    k = (rng.random(400) * (end - start)).astype(int)
    parts = [values[a:b] for a, b in zip(start, end, strict=True)]
    for or_equal in (False, True):
        count, total = tree.below(start, end, x, or_equal)
        mine = [p[p <= v] if or_equal else p[p < v] for p, v in zip(parts, x, strict=True)]
        assert count.tolist() == [len(m) for m in mine] and np.allclose(total, [m.sum() for m in mine])
    assert tree.smallest(start, end, k).tolist() == [np.sort(p)[i] for p, i in zip(parts, k, strict=True)]
    assert np.allclose(tree.sum(start, end), [p.sum() for p in parts])


@pytest.mark.parametrize("batch", [7, 10_000])
def test_order_statistics(spark, bars, batch):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    wanted = {"rank": Rank("close", 20), "fifth": Quantile("close", 20, 0.2), "far": Deviation("close", 20, "high"), "one": Rank("volume", 1), "mid": Quantile("volume", 64, 0.5)}
    try:
        got = with_order_stats(bars, wanted).toPandas()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(got) == bars.count()
    for _, g in got.groupby("series_id", dropna=False):
        g = g.sort_values("date")
        x = g.close.rolling(20)
        both = (g.close.rolling(20).apply(lambda v: ((v < v.iloc[-1]).sum() + (v <= v.iloc[-1]).sum() + 1) / 40, raw=False))
        assert np.allclose(g["rank"], both, equal_nan=True) and np.allclose(g.fifth, x.quantile(0.2), equal_nan=True)
        assert np.allclose(g.mid, g.volume.rolling(64).median(), equal_nan=True) and np.allclose(g.one.dropna(), 1.0)
        far = [np.abs(g.close.iloc[k - 19 : k + 1] - g.high.iloc[k]).mean() if k >= 19 and g.close.iloc[k - 19 : k + 1].notna().all() else np.nan for k in range(len(g))]
        assert np.allclose(g.far, far, equal_nan=True)
    assert with_order_stats(bars.limit(0), wanted).count() == 0


def test_order_statistics_of_ties_and_constants(spark):
    df = spark.createDataFrame(pd.DataFrame({"series_id": "a", "date": pd.date_range("2020-01-01", periods=9), "x": [2.0] * 5 + [1.0, 3.0, 3.0, 2.0]}))
    got = with_order_stats(df, {"r": Rank("x", 4), "q": Quantile("x", 4, 0.5), "d": Deviation("x", 4, "x")}).orderBy("date").toPandas()
    assert got.r[3] == 0.625 and got.q[4] == 2.0 and got.d[4] == 0.0 and got.q[8] == 2.5 and got.r[:3].isna().all()


def test_correlations_of_four_hundred_columns(spark):
    from tidegauge.functions.gram import pairwise_correlations
    from tidegauge.operators import quality

    rng = np.random.default_rng(2)
    x = 1e6 + rng.standard_normal((300, 400)) @ (np.eye(400) + 0.1 * rng.standard_normal((400, 400)))
    x[rng.random(x.shape) < 0.1] = np.nan
    x[:, 7], x[:, 8] = 3.0, np.nan
    names = [f"c{k}" for k in range(400)]
    frame = pd.DataFrame(x, columns=names)
    df = spark.createDataFrame([tuple(None if np.isnan(v) else float(v) for v in r) for r in x], ", ".join(f"{c} double" for c in names)).repartition(5)
    got = quality.correlation_matrix(df, names).toPandas()
    assert len(got) == 400 * 399 // 2
    want = frame.corr(min_periods=2).to_numpy()
    want[7, :] = want[:, 7] = np.nan
    at = {c: k for k, c in enumerate(names)}
    assert np.allclose(got["corr"], want[got.a.map(at), got.b.map(at)], atol=1e-9, equal_nan=True)
    rows = {r.metric: r.value for r in quality.correlations(df, names).collect()}
    assert abs(rows["matrix_mean_abs_corr"] - np.nanmean(np.abs(want))) < 1e-9
    assert pairwise_correlations(df, names[:1]).count() == 0 and pairwise_correlations(df.limit(0), names[:3]).count() in (0, 3)
