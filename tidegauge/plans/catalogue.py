"""Registered queries over the test tables and their SQL. `out` names the result columns and their decimals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.operators import cleaning as cl
from tidegauge.operators import features as ft
from tidegauge.operators import indicators as ind
from tidegauge.operators import quality as qu
from tidegauge.plans import sql as s
from tidegauge.sources import tables as src

EPS = "1e-10"
QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def shown(df: DataFrame, out: dict[str, int | str | None], keys=("series_id", "date")) -> DataFrame:
    """Columns with their decimals; "9" (text) stands for nine significant digits, for values of any size."""

    def one(c: str, d):
        if d is None:
            return F.col(c)
        if isinstance(d, int):
            return F.round(F.col(c), d).alias(c)
        return F.when(F.col(c).isNotNull(), F.format_string(f"%.{int(d) - 1}e", F.col(c))).cast("double").alias(c)

    return df.select(*keys, *[one(c, d) for c, d in out.items()])


#: The result columns of the queries over bars.
OUTS: dict[str, dict] = {}


def register(name: str, build, steps: list | None, out: dict[str, int | str | None], **how) -> None:
    """build(bars) -> frame; steps as in sql.chain (None: no SQL)."""
    OUTS[name] = out
    QUERIES[name] = lambda spark, sf, b=build, o=out: shown(b(src.bars(spark, sf)), o)
    if steps is not None:
        ORACLES[name] = s.chain(steps, out, **how)


def gappy(df: DataFrame) -> DataFrame:
    return df.withColumn("gappy", F.when(F.day("date") % 7 != 0, F.col("close")))


# --- indicators
SMA = (5, 10, 21, 50, 200)
register("i01_sma", ind.moving_averages, [{f"sma_{n}": s.roll("avg", "close", n) for n in SMA}, {f"price_to_sma_{n}": f"(close - sma_{n}) / nullif(sma_{n}, 0) * 100" for n in SMA}],
         {f"sma_{n}": 4 if n in (21,) else 6 for n in SMA} | {f"price_to_sma_{n}": 4 for n in SMA})
register("i05_moving_average_cross", ind.moving_average_cross, [{f"sma_{n}": s.roll("avg", "close", n) for n in (50, 200)}, {"golden_cross": s.up("sma_50", "sma_200"), "death_cross": s.down("sma_50", "sma_200")}],
         {"close": None, "sma_50": 6, "sma_200": 6, "golden_cross": None, "death_cross": None})
register("i02_ema", ind.exponential_averages, [s.numbered(), s.ewm("close", 12, "ema_12"), s.ewm("close", 26, "ema_26"), {f"price_to_ema_{n}": f"(close - ema_{n}) / ema_{n} * 100" for n in (12, 26)}],
         {"ema_12": 2, "ema_26": 2, "price_to_ema_12": 4, "price_to_ema_26": 4})


def _wma(x: str, n: int) -> str:
    return "(" + " + ".join([f"{x} * {n}"] + [f"{s.lag(x, k)} * {n - k}" for k in range(1, n)]) + f") / {n * (n + 1) / 2}"


register("i03_wma_hma", ind.weighted_averages, [{"wma_10": _wma("close", 10), "wma_20": _wma("close", 20), "h9": f"2 * {_wma('close', 4)} - {_wma('close', 9)}", "h16": f"2 * {_wma('close', 8)} - {_wma('close', 16)}"}, {"hma_9": s.roll("avg", "h9", 3), "hma_16": s.roll("avg", "h16", 4)}],
         {"wma_10": 4, "wma_20": 4, "hma_9": 2, "hma_16": 2})
register("i06_macd", ind.macd, [
    s.numbered(), s.ewm("close", 12, "e12"), s.ewm("close", 26, "e26"), {"macd_line": "e12 - e26"}, s.ewm("macd_line", 9, "macd_signal"),
    {"macd_histogram": "macd_line - macd_signal", "macd_bullish_cross": f"CASE WHEN rn > 1 THEN {s.up('macd_line', 'macd_signal')} ELSE 0 END", "macd_bearish_cross": f"CASE WHEN rn > 1 THEN {s.down('macd_line', 'macd_signal')} ELSE 0 END",
     "macd_bearish_divergence": s.flag(f"close > {s.lag('close', 20)} AND macd_line < {s.lag('macd_line', 20)}"), "macd_bullish_divergence": s.flag(f"close < {s.lag('close', 20)} AND macd_line > {s.lag('macd_line', 20)}")}],
    {"macd_line": 2, "macd_signal": 2, "macd_histogram": 2, "macd_bullish_cross": None, "macd_bearish_cross": None, "macd_bearish_divergence": None, "macd_bullish_divergence": None})
register("i09_rsi", ind.rsi, [
    s.numbered() | {"gain": f"coalesce(greatest(close - {s.lag('close', 1)}, 0), 0)", "loss": f"coalesce(greatest({s.lag('close', 1)} - close, 0), 0)"}, s.wilder("gain", 14, "g"), s.wilder("loss", 14, "l"),
    {"rsi": f"100 - 100 / (1 + g / (l + {EPS}))"},
    {"rsi_oversold": s.flag("rsi < 30"), "rsi_overbought": s.flag("rsi > 70"), "rsi_bearish_divergence": s.flag(f"close > {s.lag('close', 14)} AND rsi < {s.lag('rsi', 14)}"), "rsi_bullish_divergence": s.flag(f"close < {s.lag('close', 14)} AND rsi > {s.lag('rsi', 14)}"),
     "stoch_rsi": f"(rsi - {s.roll('min', 'rsi', 14)}) / ({s.roll('max', 'rsi', 14)} - {s.roll('min', 'rsi', 14)} + {EPS})"}],
    {"rsi": 4, "rsi_oversold": None, "rsi_overbought": None, "rsi_bearish_divergence": None, "rsi_bullish_divergence": None, "stoch_rsi": 4})
register("i12_bollinger", ind.bollinger, [
    {"bb_middle": s.roll("avg", "close", 20), "sd": s.roll("stddev_samp", "close", 20)}, {"bb_upper": "bb_middle + 2 * sd", "bb_lower": "bb_middle - 2 * sd"}, {"bb_width": "bb_upper - bb_lower"},
    {"bb_ratio": "bb_width / bb_middle", "bb_position": f"(close - bb_lower) / (bb_width + {EPS})", "bb_squeeze": s.flag(f"bb_width < {s.roll('avg', 'bb_width', 120)} - {s.roll('stddev_samp', 'bb_width', 120)}"), "bb_upper_touch": s.flag("close >= bb_upper"), "bb_lower_touch": s.flag("close <= bb_lower")}],
    {"bb_middle": 6, "bb_upper": 1, "bb_lower": 1, "bb_ratio": 5, "bb_position": 5, "bb_squeeze": None, "bb_upper_touch": None, "bb_lower_touch": None})
register("i15_atr", ind.atr, [
    s.numbered() | {"true_range": s.tr()}, s.wilder("true_range", 14, "atr"), {"atr_percent": "atr / close * 100", "m": s.roll("avg", "atr", 100)}, {"high_volatility": s.flag("atr > 1.5 * m"), "low_volatility": s.flag("atr < 0.5 * m")}],
    {"true_range": 4, "atr": 2, "atr_percent": 3, "high_volatility": None, "low_volatility": None})
register("i18_oscillators", ind.oscillators, [
    {"hh": s.roll("max", "high", 14), "ll": s.roll("min", "low", 14), "tp": "(high + low + close) / 3"},
    {"stoch_k": f"100 * (close - ll) / (hh - ll + {EPS})", "williams_r": f"-100 * (hh - close) / (hh - ll + {EPS})", "tm": s.roll("avg", "tp", 20), "tps": f"list(tp) {s.over(20)}"},
    {"stoch_d": s.roll("avg", "stoch_k", 3), "cci": f"(tp - tm) / (0.015 * list_sum(list_transform(tps, lambda v: abs(v - tm))) / 20 + {EPS})"},
    {"stoch_oversold": s.flag("stoch_k < 20"), "stoch_overbought": s.flag("stoch_k > 80"), "stoch_bullish_cross": s.up("stoch_k", "stoch_d"), "stoch_bearish_cross": s.down("stoch_k", "stoch_d"), "williams_oversold": s.flag("williams_r < -80"), "williams_overbought": s.flag("williams_r > -20"), "cci_oversold": s.flag("cci < -100"), "cci_overbought": s.flag("cci > 100")}],
    {"stoch_k": 5, "stoch_d": 5, "williams_r": 5, "cci": 3, "stoch_oversold": None, "stoch_overbought": None, "stoch_bullish_cross": None, "stoch_bearish_cross": None, "williams_oversold": None, "williams_overbought": None, "cci_oversold": None, "cci_overbought": None})
register("i19_adx", ind.adx, [
    s.numbered() | {"u": f"CASE WHEN {s.lag('high', 1)} IS NOT NULL THEN greatest(high - {s.lag('high', 1)}, 0) END", "d": f"CASE WHEN {s.lag('low', 1)} IS NOT NULL THEN greatest({s.lag('low', 1)} - low, 0) END", "t": s.tr()},
    {"p": "CASE WHEN u < d THEN 0 ELSE u END"}, {"n": "CASE WHEN d < p THEN 0 ELSE d END"}, s.ewm("t", 14, "a"), s.ewm("p", 14, "sp", 2), s.ewm("n", 14, "sn", 2),
    {"plus_di": "100 * sp / a", "minus_di": "100 * sn / a"}, {"dx": f"100 * abs(plus_di - minus_di) / (plus_di + minus_di + {EPS})"}, s.ewm("dx", 14, "adx", 2),
    {"strong_trend": s.flag("adx > 25"), "weak_trend": s.flag("adx < 20"), "bullish_trend": s.flag("plus_di > minus_di AND adx > 25"), "bearish_trend": s.flag("minus_di > plus_di AND adx > 25")}],
    {"plus_di": 4, "minus_di": 4, "adx": 4, "strong_trend": None, "weak_trend": None, "bullish_trend": None, "bearish_trend": None})


def _mid(n: int) -> str:
    return f"({s.roll('max', 'high', n)} + {s.roll('min', 'low', n)}) / 2"


register("i22_ichimoku", ind.ichimoku, [
    {"ichimoku_tenkan": _mid(9), "ichimoku_kijun": _mid(26), "b": _mid(52)}, {"a": "(ichimoku_tenkan + ichimoku_kijun) / 2"}, {"ichimoku_senkou_a": s.lag("a", 26), "ichimoku_senkou_b": s.lag("b", 26), "ichimoku_chikou": s.lag("close", -26)},
    {"ichimoku_cloud_thickness": "abs(ichimoku_senkou_a - ichimoku_senkou_b)", "above_cloud": s.flag("close > ichimoku_senkou_a AND close > ichimoku_senkou_b"), "below_cloud": s.flag("close < ichimoku_senkou_a AND close < ichimoku_senkou_b")},
    {"in_cloud": "1 - greatest(above_cloud, below_cloud)"}],
    {f"ichimoku_{c}": 4 for c in ("tenkan", "kijun", "senkou_a", "senkou_b", "chikou", "cloud_thickness")} | {"above_cloud": None, "below_cloud": None, "in_cloud": None})
_donchian = {}
for _n in (20, 55):
    _donchian |= {f"donchian_upper_{_n}": s.roll("max", "close", _n), f"donchian_lower_{_n}": s.roll("min", "close", _n)}
register("i24_channels", lambda b: ind.channels(ind.atr(b)), [
    s.numbered() | {"true_range": s.tr()}, s.wilder("true_range", 14, "atr"), s.ewm("close", 20, "keltner_middle"), {"keltner_upper": "keltner_middle + 2 * atr", "keltner_lower": "keltner_middle - 2 * atr"} | _donchian,
    {"keltner_position": f"(close - keltner_lower) / (keltner_upper - keltner_lower + {EPS})", **{f"donchian_middle_{n}": f"(donchian_upper_{n} + donchian_lower_{n}) / 2" for n in (20, 55)}, **{f"donchian_breakout_up_{n}": s.flag(f"close >= donchian_upper_{n}") for n in (20, 55)}, **{f"donchian_breakout_down_{n}": s.flag(f"close <= donchian_lower_{n}") for n in (20, 55)}}],
    {"keltner_middle": 2, "keltner_upper": 2, "keltner_lower": 2, "keltner_position": 4} | {f"donchian_{k}_{n}": d for n in (20, 55) for k, d in (("upper", 4), ("lower", 4), ("middle", 4), ("breakout_up", None), ("breakout_down", None))})
register("i26_momentum", ind.momentum, [
    s.numbered(), s.ewm("close", 12, "e12"), s.ewm("close", 26, "e26"),
    {f"roc_{n}": f"(close - {s.lag('close', n)}) / nullif({s.lag('close', n)}, 0) * 100" for n in (10, 20)} | {f"momentum_{n}": f"close - {s.lag('close', n)}" for n in (10, 20)} | {"price_oscillator": "(e12 - e26) / e26 * 100"}],
    {"roc_10": 3, "roc_20": 3, "momentum_10": 3, "momentum_20": 3, "price_oscillator": 4})
_cum = f"OVER ({s.W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
register("i27_volume", ind.volume_indicators, [
    {"d": f"close - {s.lag('close', 1)}", "sv": s.roll("avg", "volume", 20), "vp": f"volume * {s.pct('close', 1)}"},
    {"obv": f"sum(coalesce(sign(d), 0) * volume) {_cum}", "vpt": f"CASE WHEN vp IS NOT NULL THEN sum(vp) {_cum} END", "volume_sma_20": "sv", "volume_ratio": "volume / sv", "i": "CASE WHEN d > 0 THEN close * volume ELSE 0 END", "o": "CASE WHEN d < 0 THEN close * volume ELSE 0 END"},
    {"obv_sma_20": s.roll("avg", "obv", 20), "mfi": f"100 - 100 / (1 + {s.roll('sum', 'i', 14)} / ({s.roll('sum', 'o', 14)} + {EPS}))"}],
    {"obv": 1, "obv_sma_20": 4, "volume_sma_20": 4, "volume_ratio": 5, "vpt": 3, "mfi": 4})
register("i31_pivots_strength", ind.pivots, [
    {"pivot_point": "(high + low + close) / 3", "span": "high - low", "pc": s.pct("close", 1), "dc": f"close - {s.lag('close', 1)}"},
    {"r1": "2 * pivot_point - low", "s1": "2 * pivot_point - high", "r2": "pivot_point + span", "s2": "pivot_point - span", "fib_r1": "pivot_point + 0.382 * span", "fib_s1": "pivot_point - 0.382 * span", "fib_r2": "pivot_point + 0.618 * span", "fib_s2": "pivot_point - 0.618 * span", "currency_strength": f"{s.roll('avg', 'pc', 14)} * 100", "rvi": f"{s.roll('avg', 'dc', 10)} / ({s.roll('avg', 'span', 10)} + {EPS})"},
    {"rvi_signal": s.roll("avg", "rvi", 4)}],
    {"pivot_point": 3, "r1": 3, "s1": 3, "r2": 3, "s2": 3, "fib_r1": 2, "fib_s1": 2, "fib_r2": 2, "fib_s2": 2, "currency_strength": 3, "rvi": "9", "rvi_signal": "9"})
_pat = ["higher_high", "higher_low", "lower_high", "lower_low", "uptrend", "downtrend", "consolidation", "breakout_up", "breakout_down", "gap_up", "gap_down"]
register("i34_patterns", ind.patterns, [
    {"h5": s.roll("max", "close", 5), "l5": s.roll("min", "close", 5), "sd": s.roll("stddev_samp", "close", 20), "mx": s.roll("max", "close", 20), "mn": s.roll("min", "close", 20)},
    {"q": f"CASE WHEN count(sd) {s.over(100)} >= 100 THEN quantile_cont(sd, 0.25) {s.over(100)} END"},
    {"higher_high": s.flag(f"h5 > {s.lag('h5', 5)}"), "higher_low": s.flag(f"l5 > {s.lag('l5', 5)}"), "lower_high": s.flag(f"h5 < {s.lag('h5', 5)}"), "lower_low": s.flag(f"l5 < {s.lag('l5', 5)}"), "consolidation": s.flag("sd < q"), "breakout_up": s.flag(f"close > {s.lag('mx', 1)}"), "breakout_down": s.flag(f"close < {s.lag('mn', 1)}"), "gap_up": s.flag(f"low > {s.lag('high', 1)}"), "gap_down": s.flag(f"high < {s.lag('low', 1)}")},
    {"uptrend": "higher_high * higher_low", "downtrend": "lower_high * lower_low"}], dict.fromkeys(_pat))

# --- features
register("f04_returns_volatility", lambda b: ft.parkinson(ft.returns_and_volatility(gappy(b).drop("close").withColumnRenamed("gappy", "close"))), [
    "SELECT series_id, date, high, low, CASE WHEN day(date) % 7 <> 0 THEN close END AS close FROM {prev}", {"pd": s.pad("close"), "lr": f"ln(close / {s.lag('close', 1)})", "hl": "power(ln(high / low), 2)"},
    {"returns": s.pct("pd", 1), "log_returns": "lr", "parkinson_vol": f"sqrt({s.roll('avg', 'hl', 22)} * 252 / (4 * ln(2)))"} | {f"volatility_{n}d": f"{s.roll('stddev_samp', 'lr', n)} * sqrt(252)" for n in (5, 10, 22, 44, 66)}],
    {"returns": 5, "log_returns": 5, "parkinson_vol": 5} | {f"volatility_{n}d": 5 for n in (5, 10, 22, 44, 66)})
register("f08_vol_regime", ft.returns_and_volatility, [
    {"lr": f"ln(close / {s.lag('close', 1)})"}, {"v": f"{s.roll('stddev_samp', 'lr', 22)} * sqrt(252)"},
    {"vol_of_vol": s.roll("stddev_samp", "v", 22), "volatility_zscore": f"(v - {s.roll('avg', 'v', 252)}) / {s.roll('stddev_samp', 'v', 252)}"}, {"high_vol_regime": s.flag("volatility_zscore > 1")}],
    {"vol_of_vol": 5, "volatility_zscore": 4, "high_vol_regime": None})
_assets = lambda b, spark, sf: b.join(src.asset2(spark, sf), "date", "left")
_asset_base = "joined AS (SELECT b.*, a.asset, a.rate FROM bars b LEFT JOIN asset a USING (date))"
_WITH_ASSET = {"ctes": (s.BARS, s.ASSET, _asset_base), "base": "joined"}


def register_assets(name: str, build, steps: list, out: dict[str, int | None]) -> None:
    QUERIES[name] = lambda spark, sf: shown(build(_assets(src.bars(spark, sf), spark, sf)), out)
    ORACLES[name] = s.chain(steps, out, **_WITH_ASSET)


register_assets("f13_rolling_correlation", lambda b: ft.rolling_correlations(b, "close", ["asset"]), [
    {"pc": s.pad("close"), "pa": s.pad("asset")}, {"rc": s.pct("pc", 1), "ra": s.pct("pa", 1)}, {"corr_asset_22d": s.scorr("rc", "ra", 22), "corr_asset_66d": s.scorr("rc", "ra", 66)}, {"correlation_stability": s.roll("stddev_samp", "corr_asset_22d", 66)}],
    {"corr_asset_22d": 5, "corr_asset_66d": 5, "correlation_stability": 5})
register("f14_price_action", ft.price_action, [
    {f"m{n}": s.roll("avg", "close", n) for n in (5, 22, 50, 200)} | {"resistance_1m": s.roll("max", "close", 22), "support_1m": s.roll("min", "close", 22)},
    {f"distance_from_ma_{n}": f"(close - m{n}) / m{n}" for n in (5, 22, 50, 200)} | {"distance_from_resistance": "(resistance_1m - close) / close", "distance_from_support": "(close - support_1m) / close"} | {f"roc_{n}d": s.pct("close", n) for n in (5, 10, 22)} | {f"price_momentum_{n}d": s.pct("close", n) for n in (5, 22)}],
    {f"distance_from_ma_{n}": 5 for n in (5, 22, 50, 200)} | {"resistance_1m": None, "support_1m": None, "distance_from_resistance": 5, "distance_from_support": 5, "roc_5d": 5, "roc_10d": 5, "roc_22d": 5, "price_momentum_5d": 5, "price_momentum_22d": 5})
_dow = "(isodow(date) - 1)::INTEGER"
_cal = {
    "year": "year(date)::INTEGER", "month": "month(date)::INTEGER", "day": "day(date)::INTEGER", "day_of_week": _dow, "day_of_year": "dayofyear(date)::INTEGER", "quarter": "quarter(date)::INTEGER", "week_of_year": "week(date)::INTEGER",
    "carnival": s.flag("month(date) IN (2, 3)"), "year_end": s.flag("month(date) >= 11 OR month(date) <= 2"), "harvest": s.flag("month(date) BETWEEN 3 AND 7"), "vacation": s.flag("month(date) IN (1, 7, 12)"),
    "is_monday": s.flag("isodow(date) = 1"), "is_friday": s.flag("isodow(date) = 5"), "mid_month": s.flag("day(date) BETWEEN 10 AND 20"), "late_month": s.flag("day(date) >= 25"),
    "is_month_end": s.flag("last_day(date) = date"), "is_quarter_end": s.flag("last_day(date) = date AND month(date) % 3 = 0"),
    "month_sin": "sin(2 * pi() * month(date) / 12)", "month_cos": "cos(2 * pi() * month(date) / 12)", "day_sin": "sin(2 * pi() * day(date) / 31)", "day_of_year_cos": "cos(2 * pi() * dayofyear(date) / 365)", "weekday_sin": "sin(2 * pi() * (isodow(date) - 1) / 7)",
}
register("f15_calendar", ft.calendar_features, [_cal], {c: 6 if c.endswith(("sin", "cos")) else None for c in _cal})
_lags = {}
for _k in (1, 2, 5, 10, 22, 44, 66):
    _lags |= {f"gappy_lag_{_k}": s.lag("gappy", _k), f"gappy_return_{_k}": s.pct("pd", _k), f"gappy_diff_{_k}": f"gappy - {s.lag('gappy', _k)}"}
register("f18_lags", lambda b: ft.lag_features(gappy(b), ["gappy"]), [s.GAPPY, {"pd": s.pad("gappy")}, _lags], {c: None if "_lag_" in c else 3 if "_diff_" in c else 5 for c in _lags})
_rolls, _ranks = {}, {}
for _n in ft.WINDOWS:
    _rolls |= {f"close_mean_{_n}": s.roll("avg", "close", _n), f"close_std_{_n}": s.roll("stddev_samp", "close", _n), f"close_min_{_n}": s.roll("min", "close", _n), f"close_max_{_n}": s.roll("max", "close", _n), f"c{_n}": f"count(*) {s.over(_n)}", f"l{_n}": f"list(close) {s.over(_n)}"}
    _ranks |= {f"close_zscore_{_n}": f"(close - close_mean_{_n}) / (close_std_{_n} + 1e-8)", f"close_rank_{_n}": f"CASE WHEN c{_n} >= {_n} THEN (len(list_filter(l{_n}, lambda v: v < close)) + len(list_filter(l{_n}, lambda v: v <= close)) + 1) * 50.0::DOUBLE / {_n} / 100 END"}
register("f19_rolling_stats", lambda b: ft.rolling_features(b, ["close"]), [_rolls, _ranks],
         {f"close_{k}_{n}": d for n in ft.WINDOWS for k, d in (("mean", 4), ("std", 3), ("min", None), ("max", None), ("zscore", 4), ("rank", 6))})
_first = f"first_value(close) OVER ({s.W} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)"
_lo, _hi = s.roll("min", "close", 252, 63), s.roll("max", "close", 252, 63)
register("f10_index_risk", lambda b: ft.risk_score(ft.weighted_index(b, {"close": 0.6, "high": 0.4, "absent": 0.3}), {"close": 0.3, "low": 0.2}), [
    {"commodity_index": f"close / {_first} * 60 + high / {_first.replace('close', 'high')} * 40", "sc": f"(close - {_lo}) / nullif({_hi} - {_lo}, 0) * 100", "sl": f"(low - {_lo.replace('close', 'low')}) / nullif({_hi.replace('close', 'low')} - {_lo.replace('close', 'low')}, 0) * 100"},
    {"commodity_index_momentum_5d": s.pct("commodity_index", 5), "commodity_index_momentum_22d": s.pct("commodity_index", 22), "risk_sentiment_score": "sc * 0.6 + sl * 0.4"}, {"risk_off": s.flag("risk_sentiment_score > 60"), "risk_on": s.flag("risk_sentiment_score < 40")}],
    {"commodity_index": 3, "commodity_index_momentum_5d": 4, "commodity_index_momentum_22d": 4, "risk_sentiment_score": 3, "risk_off": None, "risk_on": None})


def _rates(b: DataFrame) -> DataFrame:
    b = b.withColumns({"policy_rate": F.col("close") / 10000, "inflation": F.col("low") / 20000, "policy_rate_us": F.col("open") / 30000, "inflation_us": F.col("high") / 40000})
    b = ft.yield_curve(ft.real_rates(b), "policy_rate", "policy_rate_us")
    b = ft.carry(ft.returns_and_volatility(b))
    return ft.interactions(b, [("policy_rate", "inflation", "multiply"), ("policy_rate", "inflation_us", "divide")])


_R = "real_interest_differential"
register("f01_rates_carry", _rates, [
    {"real_rate": "close / 10000 - low / 20000", "us_real_rate": "open / 30000 - high / 40000", _R: "(close / 10000 - low / 20000) - (open / 30000 - high / 40000)", "yield_curve_slope": "close / 10000 - open / 30000", "lr": f"ln(close / {s.lag('close', 1)})", "policy_rate_x_inflation": "close / 10000 * (low / 20000)", "policy_rate_x_inflation_us": "close / 10000 / (high / 40000 + 1e-8)"},
    {"yield_curve_inverted": s.flag("yield_curve_slope < 0"), "carry_return": f"{_R} / 100", **{f"real_diff_ma_{n}": s.roll("avg", _R, n) for n in (5, 22, 66)}, **{f"real_diff_change_{n}d": f"{_R} - {s.lag(_R, n)}" for n in (5, 22)}, "v": f"{s.roll('stddev_samp', 'lr', 22)} * sqrt(252)"},
    {"carry_attractiveness": f"{_R} / 100 / ({s.roll('avg', 'v', 22)} + 0.01)"}, {"carry_momentum": f"carry_attractiveness - {s.lag('carry_attractiveness', 22)}", "carry_above_ma": s.flag(f"carry_attractiveness > {s.roll('avg', 'carry_attractiveness', 66)}")}],
    {"real_rate": 8, "us_real_rate": 8, _R: 8, "yield_curve_slope": 8, "yield_curve_inverted": None, **{f"real_diff_ma_{n}": 10 for n in (5, 22, 66)}, "real_diff_change_5d": 8, "real_diff_change_22d": 8, "carry_return": 11, "carry_attractiveness": 6, "carry_momentum": 6, "carry_above_ma": None, "policy_rate_x_inflation": 5, "policy_rate_x_inflation_us": 5})


def _stress(b: DataFrame) -> DataFrame:
    b = ft.with_pct(ft.stress_index(b, "close", "high"), "close", {"yoy": 12, "mom": 1}, 100)
    b = b.withColumns({"row_std": ft.row_stat([F.col("open"), F.col("high"), F.col("low"), F.col("close")], "std"), "row_mean": ft.row_stat([F.col("high"), F.col("low")], "mean")})
    b = ft.rolling_quantiles(b, {"q80": ("close", 0.8)})
    return ft.recession_score(b, {"high": (F.col("close") > F.col("q80"), 0.3), "falling": (F.col("yoy") < 0, 0.4)})


register("d04_stress_recession", _stress, [
    {"z": f"(close - {s.roll('avg', 'close', 252)}) / {s.roll('stddev_samp', 'close', 252)}", "top": s.roll("max", "high", 252), "yoy": f"{s.pct('close', 12)} * 100", "mom": f"{s.pct('close', 1)} * 100", "row_std": "list_aggregate([open, high, low, close], 'stddev_samp')", "row_mean": "(high + low) / 2", "q80": f"CASE WHEN count(close) {s.over(252)} >= 252 THEN quantile_cont(close, 0.8) {s.over(252)} END"},
    {"em_stress": "z * abs((high - top) / top)", "recession_probability": f"{s.flag('close > q80')} * 0.3::DOUBLE + {s.flag('yoy < 0')} * 0.4::DOUBLE"}, {"recession_warning": s.flag("recession_probability > 0.5")}],
    {"em_stress": 4, "yoy": 3, "mom": 3, "row_std": 2, "row_mean": 3, "q80": 3, "recession_probability": 3, "recession_warning": None})

# --- cleaning and joins
register("c01_fill", lambda b: cl.fill(gappy(b), ["gappy"]), [s.GAPPY, f"SELECT * EXCLUDE gappy, coalesce({s.pad('gappy')}, first_value(gappy IGNORE NULLS) OVER ({s.W} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS gappy FROM {{prev}}"], {"gappy": None})
register("c02_winsorize_clip", lambda b: cl.clip_ranges(cl.winsorize(b, ["close", "volume"]), {"volume": (1, 2)}), [
    "SELECT p.series_id, p.date, least(greatest(p.close, q1 - 1.5 * (q3 - q1)), q3 + 1.5 * (q3 - q1)) AS close, least(greatest(least(greatest(p.volume, v1 - 1.5 * (v3 - v1)), v3 + 1.5 * (v3 - v1)), 1), 2) AS volume FROM {prev} p, (SELECT quantile_cont(close, 0.25) q1, quantile_cont(close, 0.75) q3, quantile_cont(volume, 0.25) v1, quantile_cont(volume, 0.75) v3 FROM {prev})"],
    {"close": 3, "volume": 3})
register("c04_drop_same_values", lambda b: cl.drop_same_values(b.withColumn("rounded", F.floor(F.col("close") / 100000)), ["volume", "rounded"]), [
    "SELECT * FROM {prev} QUALIFY row_number() OVER (PARTITION BY series_id, volume, floor(close / 100000) ORDER BY date) = 1"], {"close": None, "volume": None})
_g = "CASE WHEN day(date) BETWEEN 5 AND 11 THEN NULL ELSE close END"
register("c06_fill_methods", lambda b: cl.fill_missing(cl.fill_missing(cl.fill_missing(b.withColumns({c: F.when(~F.day("date").between(5, 11), F.col("close")) for c in ("fwd", "bwd", "lin")}), ["fwd"]), ["bwd"], "backward_fill"), ["lin"], "interpolate"), [
    s.numbered() | {"g": _g}, {"nn": "CASE WHEN g IS NOT NULL THEN rn END"},
    {"pv": s.pad("g"), "nv": f"first_value(g IGNORE NULLS) OVER ({s.W} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)", "pr": s.pad("nn"), "nr": f"first_value(nn IGNORE NULLS) OVER ({s.W} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)",
     "fwd": f"last_value(g IGNORE NULLS) OVER ({s.W} ROWS BETWEEN 5 PRECEDING AND CURRENT ROW)", "bwd": f"first_value(g IGNORE NULLS) OVER ({s.W} ROWS BETWEEN CURRENT ROW AND 5 FOLLOWING)"},
    {"lin": "CASE WHEN g IS NOT NULL THEN g WHEN rn - pr BETWEEN 1 AND 5 THEN coalesce(pv + (nv - pv) * (rn - pr) / nullif(nr - pr, 0), pv) END"}], {"fwd": None, "bwd": None, "lin": 3})


def _outer(spark, sf):
    return cl.outer_join([src.bars(spark, sf).groupBy("date").agg(F.round(F.max("high"), 2).alias("high"), F.sum("volume").alias("volume")), src.table(spark, sf, "lineitem").groupBy(F.to_date("l_shipdate").alias("date")).agg(F.max("l_extendedprice").alias("asset"))], ["date"])


QUERIES["j01_outer_join"] = _outer
ORACLES["j01_outer_join"] = f"WITH {s.BARS}, a AS (SELECT CAST(l_shipdate AS DATE) AS date, max(l_extendedprice) AS asset FROM lineitem GROUP BY ALL), h AS (SELECT date, round(max(high), 2) AS high, sum(volume)::BIGINT AS volume FROM bars GROUP BY date) SELECT date, high, volume, asset FROM h FULL JOIN a USING (date)"
QUERIES["j04_align"] = lambda spark, sf: shown(cl.align(src.bars(spark, sf).select("series_id", "date", "close"), src.monthly(spark, sf), "low_freq"), {"close": None, "low_freq": 3})
ORACLES["j04_align"] = f"""WITH {s.BARS}, m AS (SELECT o_orderpriority AS series_id, CAST(date_trunc('month', o_orderdate) AS DATE) AS date, avg(o_totalprice) AS v FROM orders GROUP BY ALL),
    d AS (SELECT series_id, CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date FROM m GROUP BY series_id),
    f AS (SELECT d.series_id, d.date, last_value(v IGNORE NULLS) OVER (PARTITION BY d.series_id ORDER BY d.date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS low_freq FROM d LEFT JOIN m USING (series_id, date))
    SELECT series_id, date, close, round(low_freq, 3) AS low_freq FROM bars FULL JOIN f USING (series_id, date)"""

# --- aggregates
QUERIES["a01_daily_last"] = lambda spark, sf: src.daily_last(src.table(spark, sf, "events").withColumn("at", F.struct("ts", "event_id")), "at", "event_type", "value")
ORACLES["a01_daily_last"] = "SELECT event_type, CAST(ts AS DATE) AS date, arg_max(value, (ts, event_id)) AS value FROM events GROUP BY ALL"
_KINDS = ["click", "error", "purchase", "signup", "view"]
QUERIES["a02_pivot"] = lambda spark, sf: shown(src.wide(src.table(spark, sf, "events").select(F.to_date("ts").alias("date"), "event_type", "value"), "event_type", "value", _KINDS), dict.fromkeys(_KINDS, 4), ("date",))
ORACLES["a02_pivot"] = "SELECT CAST(ts AS DATE) AS date, " + ", ".join(f"round(avg(value) FILTER (event_type = '{k}'), 4) AS {k}" for k in _KINDS) + " FROM events GROUP BY ALL"
_m = lambda df, d=3: df.select("check", "metric", F.round("value", d).alias("value"))


def _metrics(check: str, cols: dict[str, str], source: str, d: int = 3) -> str:
    """One row of expressions unpivoted to (check, metric, value)."""
    return f"WITH {s.BARS}, {s.ASSET}, one AS (SELECT {', '.join(f'CAST({e} AS DOUBLE) AS {c}' for c, e in cols.items())} FROM {source}) " + " UNION ALL ".join(f"SELECT '{check}' AS \"check\", '{c}' AS metric, round({c}, {d}) AS value FROM one" for c in cols)


QUERIES["a04_summary"] = lambda spark, sf: _m(qu.summary(src.bars(spark, sf), ["close", "high"]), 2)
ORACLES["a04_summary"] = _metrics("summary", {f"{x}_{k}": e.format(x=x) for x in ("close", "high") for k, e in (("mean", "avg({x})"), ("std", "stddev_samp({x})"), ("min", "min({x})"), ("max", "max({x})"), ("q25", "quantile_cont({x}, 0.25)"), ("median", "quantile_cont({x}, 0.5)"), ("q75", "quantile_cont({x}, 0.75)"))}, "bars", 2)
QUERIES["a07_correlation_matrix"] = lambda spark, sf: qu.correlation_matrix(src.bars(spark, sf), ["open", "high", "low", "close"]).withColumn("corr", F.round("corr", 6))
ORACLES["a07_correlation_matrix"] = f"WITH {s.BARS} " + " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS corr FROM bars" for i, a in enumerate(("open", "high", "low", "close")) for b in ("open", "high", "low", "close")[i + 1 :])
QUERIES["a08_autocorrelation"] = lambda spark, sf: qu.autocorrelation(src.bars(spark, sf), "close").withColumn("autocorr_1", F.round("autocorr_1", 6))
ORACLES["a08_autocorrelation"] = f"WITH {s.BARS}, l AS (SELECT series_id, close, {s.lag('close', 1)} AS p FROM bars) SELECT series_id, round(corr(close, p), 6) AS autocorr_1 FROM l GROUP BY series_id"
_half = f"h AS (SELECT *, CASE WHEN row_number() OVER ({s.W}) <= floor(count(*) OVER (PARTITION BY series_id) / 2) THEN 1 ELSE 2 END AS k FROM bars)"
QUERIES["a09_halves_t_test"] = lambda spark, sf: qu.halves_t_test(src.bars(spark, sf), "close").withColumns({"t": F.round("t", 5), "p": F.round("p", 7)})
# The finite sums of Student's t for whole degrees of freedom: powers of cos(atan(t / sqrt(df))), by parity.
ORACLES["a09_halves_t_test"] = f"""WITH {s.BARS}, {_half}, g AS (SELECT series_id, count(*) FILTER (k = 1) AS n1, count(*) FILTER (k = 2) AS n2, avg(close) FILTER (k = 1) AS m1, avg(close) FILTER (k = 2) AS m2, var_samp(close) FILTER (k = 1) AS v1, var_samp(close) FILTER (k = 2) AS v2 FROM h GROUP BY series_id),
    r AS (SELECT series_id, (m1 - m2) / sqrt(((n1 - 1) * v1 + (n2 - 1) * v2) / (n1 + n2 - 2) * (1 / n1 + 1 / n2)) AS t, n1 + n2 - 2 AS df FROM g),
    a AS (SELECT *, atan(abs(t) / sqrt(df)) AS th, df % 2 AS odd FROM r),
    e AS (SELECT *, unnest(generate_series(0, ((df - 2 - odd) / 2)::BIGINT)) AS k FROM a),
    c AS (SELECT series_id, t, df, th, odd, sum(CASE WHEN odd = 0 THEN exp(lgamma(k + 0.5) - lgamma(k + 1) - 0.5 * ln(pi()) + 2 * k * ln(cos(th)))
        ELSE exp(lgamma(k + 1) - lgamma(k + 1.5) + 0.5 * ln(pi()) - ln(2) + (2 * k + 1) * ln(cos(th))) END) AS total FROM e GROUP BY ALL)
    SELECT series_id, round(t, 5) AS t, df, round(1 - CASE WHEN odd = 0 THEN sin(th) * total ELSE 2 / pi() * (th + sin(th) * total) END, 7) AS p FROM c"""
QUERIES["a14_importance"] = lambda spark, sf: ft.importance(src.bars(spark, sf), "close", ["open", "high", "low", "volume"]).withColumn("importance", F.round("importance", 6))
ORACLES["a14_importance"] = f"WITH {s.BARS}, c AS (SELECT *, {s.pct('close', 5)} AS r FROM bars), t AS (SELECT *, {s.lag('r', -5)} AS y FROM c) " + " UNION ALL ".join(f"SELECT '{x}' AS feature, round(abs(corr({x}, y)), 6) AS importance FROM t" for x in ("open", "high", "low", "volume"))

# --- quality
QUERIES["q01_completeness"] = lambda spark, sf: _m(qu.completeness(gappy(src.bars(spark, sf)), ["gappy", "close"]))
ORACLES["q01_completeness"] = _metrics("completeness", {"rows": "count(*)", "null_pct_gappy": "avg((gappy IS NULL)::INT) * 100", "null_pct_close": "avg((close IS NULL)::INT) * 100"}, f"({s.GAPPY})")
QUERIES["q03_ranges"] = lambda spark, sf: _m(qu.ranges(src.bars(spark, sf), {"close": (1000, 400000), "volume": (1, 3)}))
ORACLES["q03_ranges"] = _metrics("ranges", {f"{k}_{x}": e.format(c=f"({x} < {lo} OR {x} > {hi})", x=x) for x, lo, hi in (("close", 1000, 400000), ("volume", 1, 3)) for k, e in (("out", "count(*) FILTER ({c})"), ("min", "min({x})"), ("max", "max({x})"), ("ok", "(avg({c}::INT) <= 0.01)::INT"))}, "bars")
QUERIES["q04_outliers"] = lambda spark, sf: _m(qu.outliers(src.bars(spark, sf), ["close", "volume"], 2.0))
ORACLES["q04_outliers"] = _metrics("outliers", {f"{k}_{x}": e.format(x=x) for x in ("close", "volume") for k, e in (("z", "count(*) FILTER (abs({x} - m_{x}) > 2 * s_{x})"), ("iqr", "count(*) FILTER ({x} < a_{x} - 1.5 * (b_{x} - a_{x}) OR {x} > b_{x} + 1.5 * (b_{x} - a_{x}))"))}, "(SELECT * FROM bars, (SELECT " + ", ".join(f"avg({x}) m_{x}, stddev_pop({x}) s_{x}, quantile_cont({x}, 0.25) a_{x}, quantile_cont({x}, 0.75) b_{x}" for x in ("close", "volume")) + " FROM bars))")
QUERIES["q05_duplicates"] = lambda spark, sf: _m(qu.duplicates(src.table(spark, sf, "orders").select("o_custkey", F.to_date("o_orderdate").alias("date"), "o_orderstatus"), ["o_custkey", "date"], ["o_orderstatus"]))
ORACLES["q05_duplicates"] = "WITH o AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS date, o_orderstatus FROM orders) SELECT 'duplicates' AS \"check\", 'duplicate_keys' AS metric, (count(*) - count(DISTINCT (o_custkey, date)))::DOUBLE AS value FROM o UNION ALL SELECT 'duplicates', 'duplicate_rows', (count(*) - count(DISTINCT (o_custkey, date, o_orderstatus)))::DOUBLE FROM o"
QUERIES["q06_time_integrity"] = lambda spark, sf: _m(qu.time_integrity(src.bars(spark, sf), 1))
ORACLES["q06_time_integrity"] = f"""WITH {s.BARS}, g AS (SELECT date - {s.lag('date', 1)} AS d FROM bars), u AS (SELECT d FROM g WHERE d IS NOT NULL GROUP BY d ORDER BY count(*) DESC, d LIMIT 1),
    r AS (SELECT (SELECT d FROM u) AS usual_step, count(*) FILTER (d > (SELECT d FROM u) + 1) AS gaps, max(d) AS longest_gap FROM g), b AS (SELECT max(date) - min(date) AS span_days, avg((isodow(date) >= 6)::INT) * 100 AS weekend_pct FROM bars)
    """ + " UNION ALL ".join(f"SELECT 'time_integrity' AS \"check\", '{c}' AS metric, round({c}::DOUBLE, 3) AS value FROM r, b" for c in ("usual_step", "gaps", "longest_gap", "span_days", "weekend_pct"))  # fmt: skip
QUERIES["q09_business_rules"] = lambda spark, sf: _m(qu.business_rules(src.bars(spark, sf).withColumn("change", F.col("close") - F.col("open")), ["change", "volume"], ["volume", "close"]))
ORACLES["q09_business_rules"] = _metrics("business_rules", {"negative_change": "count(*) FILTER (close - open < 0)", "negative_volume": "count(*) FILTER (volume < 0)", "outside_volume": "count(*) FILTER (volume NOT BETWEEN 0 AND 100)", "outside_close": "count(*) FILTER (close NOT BETWEEN 0 AND 100)"}, "bars")
QUERIES["q10_cross_source"] = lambda spark, sf: _m(qu.cross_source(_assets(src.bars(spark, sf), spark, sf), "close", "asset"))
ORACLES["q10_cross_source"] = _metrics("cross_source", {"mean_abs_pct_diff": "avg(abs((close - asset) / asset)) * 100"}, "bars LEFT JOIN asset USING (date)")
QUERIES["q12_drift"] = lambda spark, sf: qu.drift(src.bars(spark, sf), "close").withColumn("drift_score", F.round("drift_score", 6))
ORACLES["q12_drift"] = f"""WITH {s.BARS}, {_half}, g AS (SELECT series_id, count(*) AS n, count(close) AS there, coalesce(stddev_samp(close) FILTER (k = 1) / nullif(abs(avg(close) FILTER (k = 1)), 0), 0) AS a, coalesce(stddev_samp(close) FILTER (k = 2) / nullif(abs(avg(close) FILTER (k = 2)), 0), 0) AS b FROM h GROUP BY series_id),
    r AS (SELECT series_id, CASE WHEN n >= 20 AND there > 10 THEN abs(b - a) ELSE 0 END AS score FROM g) SELECT series_id, round(score, 6) AS drift_score, (score > 0.2)::INTEGER AS drifted FROM r"""
QUERIES["q14_extreme_values"] = lambda spark, sf: _m(qu.extreme_values(src.bars(spark, sf), ["close", "volume"], 2.5))
ORACLES["q14_extreme_values"] = _metrics("extreme_values", {f"extreme_{x}": f"count(*) FILTER (abs({x} - m_{x}) > 2.5 * s_{x})" for x in ("close", "volume")}, "(SELECT * FROM bars, (SELECT " + ", ".join(f"avg({x}) m_{x}, stddev_samp({x}) s_{x}" for x in ("close", "volume")) + " FROM bars))")
QUERIES["c05_standardize"] = lambda spark, sf: cl.standardize(src.table(spark, sf, "events").withColumnRenamed("event_type", "series_id").withColumn("seq", F.struct("ts", "event_id")), "ts", "seq").select("series_id", "date", "event_id", "value")
ORACLES["c05_standardize"] = "SELECT event_type AS series_id, CAST(ts AS DATE) AS date, event_id, value FROM events QUALIFY row_number() OVER (PARTITION BY event_type, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) = 1"
QUERIES["a05_gaps"] = lambda spark, sf: qu.gaps(src.bars(spark, sf))
ORACLES["a05_gaps"] = f"WITH {s.BARS}, g AS (SELECT series_id, {s.lag('date', 1)} AS start, date AS \"end\" FROM bars) SELECT series_id, start, \"end\", (\"end\" - start)::INTEGER AS gap_days FROM g WHERE start IS NOT NULL"
