"""Technical indicators. Each takes a frame with series_id, date and prices and adds columns, in as few window stages
as its definitions allow; all stages share one partitioning and order, so there is one exchange and one sort. Each
family also runs within windows.by_blocks(), where a long series is cut into blocks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.orders import Deviation, Quantile, with_order_stats
from tidegauge.functions.windows import col, cross_down, cross_up, diff, ewm, flag, hull, padded, pct, ratio, roll, running, shift, stage, wilder, wma

EPS = 1e-10


def moving_averages(df: DataFrame, p: str = "close", spans=(5, 10, 21, 50, 200)) -> DataFrame:
    df = stage(df, max(spans), lambda d: d.withColumns({f"sma_{n}": roll(F.avg, p, n) for n in spans}))
    return df.withColumns({f"price_to_sma_{n}": ratio(col(p) - col(f"sma_{n}"), f"sma_{n}") * 100 for n in spans})


def moving_average_cross(df: DataFrame, p: str = "close", fast: int = 50, slow: int = 200) -> DataFrame:
    def go(d):
        d = d.withColumns({f"sma_{n}": roll(F.avg, p, n) for n in (fast, slow)})
        a, b = f"sma_{fast}", f"sma_{slow}"
        return d.withColumns({"golden_cross": cross_up(a, b), "death_cross": cross_down(a, b)})

    return stage(df, max(fast, slow) + 1, go)


def exponential_averages(df: DataFrame, p: str = "close", spans=(12, 26)) -> DataFrame:
    df = ewm(df, {f"ema_{n}": (p, n) for n in spans})
    return df.withColumns({f"price_to_ema_{n}": ratio(col(p) - col(f"ema_{n}"), f"ema_{n}") * 100 for n in spans})


def weighted_averages(df: DataFrame, p: str = "close") -> DataFrame:
    def go(d):
        d = d.withColumns({f"wma_{n}": wma(p, n) for n in (10, 20)})
        return hull(hull(d, p, 9, "hma_9"), p, 16, "hma_16")

    return stage(df, 20, go)


def macd(df: DataFrame, p: str = "close", fast: int = 12, slow: int = 26, signal: int = 9) -> DataFrame:
    df = ewm(df, {"_fast": (p, fast), "_slow": (p, slow)}).withColumn("macd_line", col("_fast") - col("_slow"))
    df = ewm(df, {"macd_signal": ("macd_line", signal)}).drop("_fast", "_slow")

    def go(d):
        line, before = col("macd_line"), shift("macd_line", 20)
        up, down = (col(p) > shift(p, 20)) & (line < before), (col(p) < shift(p, 20)) & (line > before)
        crosses = {"macd_bullish_cross": cross_up("macd_line", "macd_signal"), "macd_bearish_cross": cross_down("macd_line", "macd_signal")}
        return d.withColumns({"macd_histogram": line - col("macd_signal")} | crosses | {"macd_bearish_divergence": flag(up), "macd_bullish_divergence": flag(down)})

    return stage(df, 20, go)


def rsi(df: DataFrame, p: str = "close", n: int = 14) -> DataFrame:
    def moves(d):
        step = diff(p)
        return d.withColumns({"_gain": F.coalesce(F.when(step > 0, step), F.lit(0.0)), "_loss": F.coalesce(F.when(step < 0, -step), F.lit(0.0))})

    df = wilder(stage(df, 1, moves), {"_g": "_gain", "_l": "_loss"}, n, alike=True)
    df = df.withColumn("rsi", 100 - 100 / (1 + col("_g") / (col("_l") + EPS)))

    def go(d):
        d = d.withColumns({"_lo": roll(F.min, "rsi", n), "_hi": roll(F.max, "rsi", n)})
        before, strength = shift(p, n), shift("rsi", n)
        return d.withColumns({
            "rsi_oversold": flag(col("rsi") < 30), "rsi_overbought": flag(col("rsi") > 70),
            "rsi_bearish_divergence": flag((col(p) > before) & (col("rsi") < strength)),
            "rsi_bullish_divergence": flag((col(p) < before) & (col("rsi") > strength)),
            "stoch_rsi": (col("rsi") - col("_lo")) / (col("_hi") - col("_lo") + EPS),
        })

    return stage(df, n, go).drop("_gain", "_loss", "_g", "_l", "_lo", "_hi")


def bollinger(df: DataFrame, p: str = "close", n: int = 20, k: float = 2) -> DataFrame:
    def go(d):
        d = d.withColumns({"bb_middle": roll(F.avg, p, n), "_sd": roll(F.stddev_samp, p, n)})
        d = d.withColumns({"bb_upper": col("bb_middle") + k * col("_sd"), "bb_lower": col("bb_middle") - k * col("_sd")})
        d = d.withColumn("bb_width", col("bb_upper") - col("bb_lower"))
        return d.withColumns({"_wm": roll(F.avg, "bb_width", 120), "_ws": roll(F.stddev_samp, "bb_width", 120)})

    return stage(df, n + 120, go).withColumns({
        "bb_ratio": ratio("bb_width", "bb_middle"), "bb_position": (col(p) - col("bb_lower")) / (col("bb_width") + EPS),
        "bb_squeeze": flag(col("bb_width") < col("_wm") - col("_ws")),
        "bb_upper_touch": flag(col(p) >= col("bb_upper")), "bb_lower_touch": flag(col(p) <= col("bb_lower")),
    }).drop("_sd", "_wm", "_ws")


def synthetic_range(df: DataFrame, p: str = "close", n: int = 9) -> DataFrame:
    """High and low of the last n closes, for sources that have no range of their own."""
    return stage(df, n, lambda d: d.withColumns({"high": roll(F.max, p, n), "low": roll(F.min, p, n)}))


def true_range(h: str = "high", low: str = "low", c: str = "close"):
    return F.greatest(col(h) - col(low), F.abs(col(h) - shift(c, 1)), F.abs(col(low) - shift(c, 1)))


def atr(df: DataFrame, n: int = 14) -> DataFrame:
    """Seeded at the first row with n true ranges, so a warm-up without highs and lows does not spoil the series."""
    df = wilder(stage(df, 1, lambda d: d.withColumn("true_range", true_range())), {"atr": "true_range"}, n)
    df = stage(df, 100, lambda d: d.withColumns({"atr_percent": ratio("atr", "close") * 100, "_m": roll(F.avg, "atr", 100)}))
    return df.withColumns({"high_volatility": flag(col("atr") > 1.5 * col("_m")), "low_volatility": flag(col("atr") < 0.5 * col("_m"))}).drop("_m")


def oscillators(df: DataFrame, n: int = 14) -> DataFrame:
    """Stochastic %K and %D, Williams %R and the commodity channel index."""
    def go(d):
        typical = (col("high") + col("low") + col("close")) / 3
        d = d.withColumns({"_hh": roll(F.max, "high", n), "_ll": roll(F.min, "low", n), "_tp": typical})
        span = col("_hh") - col("_ll") + EPS
        d = d.withColumns({"stoch_k": 100 * (col("close") - col("_ll")) / span, "williams_r": -100 * (col("_hh") - col("close")) / span, "_tm": roll(F.avg, "_tp", 20)})
        d = with_order_stats(d, {"_md": Deviation("_tp", 20, "_tm")})
        d = d.withColumns({"stoch_d": roll(F.avg, "stoch_k", 3), "cci": (col("_tp") - col("_tm")) / (0.015 * col("_md") + EPS)})
        return d.withColumns({"stoch_bullish_cross": cross_up("stoch_k", "stoch_d"), "stoch_bearish_cross": cross_down("stoch_k", "stoch_d")})

    return stage(df, n + 4 + 20, go).withColumns({
        "stoch_oversold": flag(col("stoch_k") < 20), "stoch_overbought": flag(col("stoch_k") > 80),
        "williams_oversold": flag(col("williams_r") < -80), "williams_overbought": flag(col("williams_r") > -20),
        "cci_oversold": flag(col("cci") < -100), "cci_overbought": flag(col("cci") > 100),
    }).drop("_hh", "_ll", "_tp", "_tm", "_md")


def adx(df: DataFrame, n: int = 14) -> DataFrame:
    """Smoothed by the recursive mean of span n. The smaller directional move becomes 0; a tie keeps both."""
    def moves(d):
        zero, up, down = F.lit(0.0), diff("high"), -diff("low")
        one = {"_u": F.when(up.isNotNull(), F.greatest(up, zero)), "_d": F.when(down.isNotNull(), F.greatest(down, zero))}
        d = d.withColumns(one | {"_tr": true_range()})
        plus = F.when(col("_u") < col("_d"), zero).otherwise(col("_u"))
        return d.withColumn("_p", plus).withColumn("_n", F.when(col("_d") < col("_p"), zero).otherwise(col("_d")))

    df = ewm(stage(df, 1, moves), {"_a": ("_tr", n), "_sp": ("_p", n), "_sn": ("_n", n)}, alike=True)
    df = df.withColumns({"plus_di": 100 * ratio("_sp", "_a"), "minus_di": 100 * ratio("_sn", "_a")})
    strength = 100 * F.abs(col("plus_di") - col("minus_di")) / (col("plus_di") + col("minus_di") + EPS)
    df = ewm(df.withColumn("_dx", strength), {"adx": ("_dx", n)})
    strong = col("adx") > 25
    return df.withColumns({
        "strong_trend": flag(strong), "weak_trend": flag(col("adx") < 20), "bullish_trend": flag((col("plus_di") > col("minus_di")) & strong),
        "bearish_trend": flag((col("minus_di") > col("plus_di")) & strong),
    }).drop("_u", "_d", "_tr", "_p", "_n", "_a", "_sp", "_sn", "_dx")


def ichimoku(df: DataFrame, p: str = "close") -> DataFrame:
    """The lagging line looks 26 rows ahead, as its definition has it."""
    def go(d):
        mid = lambda n: (roll(F.max, "high", n) + roll(F.min, "low", n)) / 2
        d = d.withColumns({"ichimoku_tenkan": mid(9), "ichimoku_kijun": mid(26), "_b": mid(52)})
        d = d.withColumn("_a", (col("ichimoku_tenkan") + col("ichimoku_kijun")) / 2)
        return d.withColumns({"ichimoku_senkou_a": shift("_a", 26), "ichimoku_senkou_b": shift("_b", 26), "ichimoku_chikou": shift(p, -26)})

    df = stage(df, 52 + 26, go, ahead=26)
    a, b = col("ichimoku_senkou_a"), col("ichimoku_senkou_b")
    both = a.isNotNull() & b.isNotNull()
    sides = {"above_cloud": flag(both & (col(p) > F.greatest(a, b))), "below_cloud": flag(both & (col(p) < F.least(a, b)))}
    df = df.withColumns({"ichimoku_cloud_thickness": F.abs(a - b)} | sides)
    return df.withColumn("in_cloud", 1 - F.greatest("above_cloud", "below_cloud")).drop("_a", "_b")


def channels(df: DataFrame, p: str = "close") -> DataFrame:
    """Keltner (needs atr) and Donchian channels."""
    df = ewm(df, {"keltner_middle": (p, 20)})
    df = df.withColumns({"keltner_upper": col("keltner_middle") + 2 * col("atr"), "keltner_lower": col("keltner_middle") - 2 * col("atr")})
    df = df.withColumn("keltner_position", (col(p) - col("keltner_lower")) / (col("keltner_upper") - col("keltner_lower") + EPS))
    edges = lambda: {f"donchian_{k}_{n}": roll(f, p, n) for n in (20, 55) for k, f in (("upper", F.max), ("lower", F.min))}
    df = stage(df, 55, lambda d: d.withColumns(edges()))
    for n in (20, 55):
        top, low = col(f"donchian_upper_{n}"), col(f"donchian_lower_{n}")
        df = df.withColumns({f"donchian_middle_{n}": (top + low) / 2, f"donchian_breakout_up_{n}": flag(col(p) >= top), f"donchian_breakout_down_{n}": flag(col(p) <= low)})
    return df


def momentum(df: DataFrame, p: str = "close") -> DataFrame:
    def go(d):
        rates = {f"roc_{n}": ratio(col(p) - shift(p, n), shift(p, n)) * 100 for n in (10, 20)}
        return d.withColumns(rates | {f"momentum_{n}": diff(p, n) for n in (10, 20)})

    df = ewm(stage(df, 20, go), {"_fast": (p, 12), "_slow": (p, 26)})
    return df.withColumn("price_oscillator", ratio(col("_fast") - col("_slow"), "_slow") * 100).drop("_fast", "_slow")


def volume_indicators(df: DataFrame, p: str = "close", v: str = "volume") -> DataFrame:
    df = padded(df.withColumn("_v", col(v).cast("double")), {"_pad": p})

    def moves(d):
        move, zero = diff(p), F.lit(0.0)
        d = d.withColumns({"_flow": col(p) * col("_v"), "_signed": F.coalesce(F.signum(move), zero) * col("_v"), "_vp": col("_v") * pct("_pad"), "volume_sma_20": roll(F.avg, "_v", 20)})
        return d.withColumns({"_in": F.coalesce(F.when(move > 0, col("_flow")), zero), "_out": F.coalesce(F.when(move < 0, col("_flow")), zero)})

    df = running(stage(df, 20, moves), {"obv": ("sum", "_signed"), "vpt": ("sum", "_vp")})
    df = df.withColumns({"volume_ratio": ratio("_v", "volume_sma_20"), "vpt": F.when(col("_vp").isNotNull(), col("vpt"))})
    flow = lambda: 100 - 100 / (1 + roll(F.sum, "_in", 14) / (roll(F.sum, "_out", 14) + EPS))
    df = stage(df, 20, lambda d: d.withColumns({"obv_sma_20": roll(F.avg, "obv", 20), "mfi": flow()}))
    return df.drop("_pad", "_v", "_signed", "_vp", "_flow", "_in", "_out")


def pivots(df: DataFrame) -> DataFrame:
    h, low, c = col("high"), col("low"), col("close")
    df = df.withColumn("pivot_point", (h + low + c) / 3)
    p, span = col("pivot_point"), h - low
    df = df.withColumns({"r1": 2 * p - low, "s1": 2 * p - h, "r2": p + span, "s2": p - span})
    df = df.withColumns({f"fib_{side}{k}": p + sign * share * span for k, share in ((1, 0.382), (2, 0.618)) for side, sign in (("r", 1), ("s", -1))})
    df = padded(df.withColumn("_hl", span), {"_pad": "close"})

    def go(d):
        d = d.withColumns({"_pct": pct("_pad"), "_dc": diff("close")})
        d = d.withColumns({"currency_strength": roll(F.avg, "_pct", 14) * 100, "rvi": roll(F.avg, "_dc", 10) / (roll(F.avg, "_hl", 10) + EPS)})
        return d.withColumn("rvi_signal", roll(F.avg, "rvi", 4))

    return stage(df, 1 + 14 + 4, go).drop("_pad", "_pct", "_dc", "_hl")


def patterns(df: DataFrame, p: str = "close") -> DataFrame:
    def go(d):
        d = d.withColumns({"_hi": roll(F.max, p, 5), "_lo": roll(F.min, p, 5), "_sd": roll(F.stddev_samp, p, 20), "_mx": roll(F.max, p, 20), "_mn": roll(F.min, p, 20)})
        d = with_order_stats(d, {"_q": Quantile("_sd", 100, 0.25)})
        return d.withColumns({
            "higher_high": flag(col("_hi") > shift("_hi", 5)), "higher_low": flag(col("_lo") > shift("_lo", 5)), "lower_high": flag(col("_hi") < shift("_hi", 5)),
            "lower_low": flag(col("_lo") < shift("_lo", 5)), "consolidation": flag(col("_sd") < col("_q")), "breakout_up": flag(col(p) > shift("_mx", 1)),
            "breakout_down": flag(col(p) < shift("_mn", 1)), "gap_up": flag(col("low") > shift("high", 1)), "gap_down": flag(col("high") < shift("low", 1)),
        })

    df = stage(df, 20 + 100, go)
    return df.withColumns({"uptrend": col("higher_high") * col("higher_low"), "downtrend": col("lower_high") * col("lower_low")}).drop("_hi", "_lo", "_sd", "_mx", "_mn", "_q")


def all_indicators(df: DataFrame) -> DataFrame:
    """Every family in the order in which they build on each other; sources without a range of their own get one first."""
    if not {"high", "low"} <= set(df.columns):
        df = synthetic_range(df)
    if "volume" not in df.columns:
        df = df.withColumn("volume", F.lit(None).cast("double"))
    for step in (moving_averages, moving_average_cross, exponential_averages, weighted_averages, macd, adx, ichimoku, rsi, oscillators, momentum, bollinger, atr, channels, volume_indicators, pivots, patterns):
        df = df.transform(step)
    return df
