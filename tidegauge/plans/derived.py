"""More registered queries: sources, series derived by sources, time features, cleaning as a whole, checks and their verdicts."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.windows import by_blocks, shift
from tidegauge.operators import cleaning as cl
from tidegauge.operators import features as ft
from tidegauge.operators import indicators as ind
from tidegauge.operators import macro as ma
from tidegauge.operators import quality as qu
from tidegauge.plans import pipeline, sinks
from tidegauge.plans import sql as s
from tidegauge.plans.catalogue import ORACLES, OUTS, QUERIES, gappy, register, shown
from tidegauge.sources import files, panels
from tidegauge.sources import tables as src
from tidegauge.streaming.bars import windowed_bars

KINDS = ["click", "error", "purchase", "signup", "view"]


def table_query(name: str, build, sql: str | None) -> None:
    """build(spark, sf_dir) -> frame."""
    QUERIES[name] = build
    if sql is not None:
        ORACLES[name] = sql


def _events(spark, sf) -> DataFrame:
    return src.table(spark, sf, "events")


# --- sources
def _quotes(spark, sf):
    e = _events(spark, sf).withColumns({"at": F.struct("ts", "event_id"), "bid": F.col("value"), "ask": F.col("value") * 1.5})
    return shown(src.quote_spread(e, "at", "event_type", "bid", "ask"), {"bid": 4, "ask": 4, "mid": 4}, ("event_type", "date"))


table_query("s03_quote_spread", _quotes, "SELECT event_type, CAST(ts AS DATE) AS date, round(arg_max(value, (ts, event_id)), 4) AS bid, round(arg_max(value, (ts, event_id)) * 1.5, 4) AS ask, round(arg_max(value, (ts, event_id)) * 1.25, 4) AS mid FROM events GROUP BY ALL")


def _json_field(spark, sf):
    e = _events(spark, sf).select("event_id", F.from_json("props", "k string").alias("p"))
    return cl.to_numbers(e.select("event_id", F.col("p.k").alias("k")), ["k"])


table_query("c08_to_numbers", _json_field, "SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events")


def _flows(spark, sf):
    e = _events(spark, sf).select(F.to_date("ts").alias("date"), "event_type", "value")
    return shown(src.net_flows(e, "event_type", "value", KINDS), {c: 4 for c in (*KINDS, "net")}, ("date",))


table_query("s09_net_flows", _flows, "WITH w AS (SELECT CAST(ts AS DATE) AS date, " + ", ".join(f"avg(value) FILTER (event_type = '{k}') AS {k}" for k in KINDS) + " FROM events GROUP BY ALL) SELECT date, " + ", ".join(f"round({k}, 4) AS {k}" for k in KINDS) + ", round(" + " + ".join(f"coalesce({k}, 0)" for k in KINDS) + ", 4) AS net FROM w")


def _last_quote(spark, sf):
    q = src.table(spark, sf, "lineitem").select("l_suppkey", F.struct("l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice").alias("at"), F.col("l_tax").alias("regular"), F.col("l_discount").alias("plain"), F.col("l_extendedprice").alias("previous"))
    return src.last_quote(q, "l_suppkey", "at", ["regular", "plain", "previous"])


table_query("s16_last_quote", _last_quote, "WITH q AS (SELECT l_suppkey, arg_max({'r': l_tax, 'p': l_discount, 'e': l_extendedprice}, (l_shipdate, l_orderkey, l_linenumber, l_partkey, l_extendedprice)) AS q FROM lineitem GROUP BY ALL) SELECT l_suppkey, coalesce(nullif(q.r, 0), nullif(q.p, 0), nullif(q.e, 0)) AS price FROM q")


def _chain(spark, sf):
    li = src.table(spark, sf, "lineitem")
    calls = li.where("l_returnflag = 'A'").select("l_orderkey", "l_linenumber", F.col("l_extendedprice").alias("strike"), "l_discount")
    puts = li.where("l_returnflag = 'R'").select("l_orderkey", "l_linenumber", F.col("l_extendedprice").alias("strike"), "l_tax")
    return src.option_chain(calls, puts).groupBy("type").agg(F.count("*").alias("n"), F.count("l_discount").alias("n_discount"), F.count("l_tax").alias("n_tax"), F.max("strike").alias("highest"))


table_query("s17_option_chain", _chain, "SELECT type, count(*) AS n, count(l_discount) AS n_discount, count(l_tax) AS n_tax, max(l_extendedprice) AS highest FROM (SELECT 'call' AS type, l_extendedprice, l_discount, NULL AS l_tax FROM lineitem WHERE l_returnflag = 'A' UNION ALL SELECT 'put', l_extendedprice, NULL, l_tax FROM lineitem WHERE l_returnflag = 'R') GROUP BY ALL")
table_query("s20_stored_range", lambda spark, sf: src.stored_range(spark, f"{sf}/orders.parquet", "1997-01-01", "1997-06-30", "o_orderdate").select("o_orderkey", "o_totalprice"), "SELECT o_orderkey, o_totalprice FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1997-01-01' AND DATE '1997-06-30'")
table_query("s20_latest", lambda spark, sf: src.latest(spark, f"{sf}/orders.parquet", 90, "o_orderdate").select("o_orderkey", "o_totalprice"), "SELECT o_orderkey, o_totalprice FROM orders WHERE CAST(o_orderdate AS DATE) > (SELECT max(CAST(o_orderdate AS DATE)) - 90 FROM orders)")


def _spine(spark, sf):
    o = src.table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("date"))
    return src.spine(o).join(o.groupBy("date").count(), "date", "left").select("date", F.coalesce("count", F.lit(0)).alias("n"))


table_query("s21_calendar_spine", _spine, "WITH o AS (SELECT CAST(o_orderdate AS DATE) AS date, count(*) AS n FROM orders GROUP BY ALL) SELECT CAST(d AS DATE) AS date, coalesce(n, 0) AS n FROM (SELECT unnest(generate_series((SELECT min(date) FROM o)::TIMESTAMP, (SELECT max(date) FROM o)::TIMESTAMP, INTERVAL 1 DAY)) AS d) LEFT JOIN o ON o.date = CAST(d AS DATE)")


def _bars(spark, sf):
    return shown(windowed_bars(_events(spark, sf)).select("series_id", F.date_format("start", "yyyy-MM-dd HH:mm").alias("start"), "open", "high", "low", "close", "volume"), {c: None for c in ("open", "high", "low", "close", "volume")}, ("series_id", "start"))


table_query("st01_windowed_bars", _bars, "SELECT event_type AS series_id, strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M') AS start, arg_min(value, (ts, event_id)) AS open, max(value) AS high, min(value) AS low, arg_max(value, (ts, event_id)) AS close, count(*) AS volume FROM events GROUP BY ALL")


LINES = {1: "first", 2: "second", 3: "third", 4: "fourth"}
_PRICE = {"first": "l_extendedprice", "second": "l_extendedprice", "third": "l_quantity", "fourth": "l_tax", "lost": "l_absent"}


def _panel(spark, sf):
    """Four sources by line number and one whose column is not there; it alone fails."""
    number = {name: n for n, name in LINES.items()}

    def source(name):
        li = src.table(spark, sf, "lineitem").where(F.col("l_linenumber") == number.get(name, 1))
        return lambda: li.groupBy(F.col("l_returnflag").alias("series_id"), F.to_date("l_shipdate").alias("date")).agg(F.max(_PRICE[name]).alias("value"))

    long, failed = panels.scan({name: source(name) for name in _PRICE})
    out = panels.panel(long, [*LINES.values()]).withColumn("failed", F.lit(",".join(failed)))
    return shown(out, {name: 4 for name in LINES.values()} | {"failed": None})


_wide = ", ".join(f"(max({_PRICE[n]}) FILTER (l_linenumber = {m}))::DOUBLE AS {n}" for m, n in LINES.items())
table_query("s07_composite_panel", _panel, f"WITH w AS (SELECT l_returnflag AS series_id, CAST(l_shipdate AS DATE) AS date, {_wide} FROM lineitem WHERE l_linenumber IN (1, 2, 3, 4) GROUP BY ALL) SELECT series_id, date, "
            + ", ".join(f"round(last_value({n} IGNORE NULLS) OVER ({s.W} ROWS BETWEEN 5 PRECEDING AND CURRENT ROW), 4) AS {n}" for n in LINES.values()) + ", 'lost' AS failed FROM w")
TICKERS = {"1-URGENT": "urgent", "2-HIGH": "high", "3-MEDIUM": "medium", "5-LOW": "low"}
_market_out = {"urgent": 2, "urgent_high": 2, "urgent_low": 2, "urgent_volume": None, "high": 2, "high_return": 6, "medium": 2, "low": 2, "low_return": 6}


def _market(spark, sf):
    return shown(panels.market(src.bars(spark, sf), TICKERS, ["urgent"], ["high", "low"]), _market_out, ("date",))


_of = lambda t, c, name: f"max({c}) FILTER (series_id = '{t}') AS {name}"
_ticks = [_of(t, "close", n) for t, n in TICKERS.items()] + [_of("1-URGENT", c, f"urgent_{c}") for c in ("high", "low", "volume")] + [_of(t, "r", f"{TICKERS[t]}_return") for t in ("2-HIGH", "5-LOW")]
table_query("s13_market_scan", _market, f"WITH {s.BARS}, b AS (SELECT *, {s.pct('close', 1)} AS r FROM bars), w AS (SELECT date, {', '.join(_ticks)} FROM b WHERE series_id IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '5-LOW') GROUP BY ALL) SELECT date, {', '.join(s.shown(c, d) for c, d in _market_out.items())} FROM w")


def _concat(spark, sf):
    b = src.bars(spark, sf)
    keys = ["series_id", "date"]
    return shown(panels.concat([b.select(*keys, "close"), b.where("volume > 1").select(*keys, F.col("high").alias("close")), b.where("day(date) = 1").select(*keys, "close")], keys), {"close": 2, "close_2": 2, "close_3": 2})


table_query("j02_concat", _concat, f"WITH {s.BARS} SELECT series_id, date, round(close, 2) AS close, CASE WHEN volume > 1 THEN round(high, 2) END AS close_2, CASE WHEN day(date) = 1 THEN round(close, 2) END AS close_3 FROM bars")


def _sparse(spark, sf):
    b = gappy(src.bars(spark, sf)).withColumn("seldom", F.when(F.day("date") == 1, F.col("close")))
    out = ft.drop_sparse(b)
    return shown(out, {"gappy": 2} | ({"seldom": 2} if "seldom" in out.columns else {}))


table_query("c07_drop_sparse", _sparse, f"WITH {s.BARS}, g AS ({s.GAPPY}) SELECT series_id, date, round(last_value(gappy IGNORE NULLS) OVER ({s.W} ROWS BETWEEN 5 PRECEDING AND CURRENT ROW), 2) AS gappy FROM g")


def _narrowed(spark, sf):
    li = src.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_discount", F.when(F.col("l_tax") > 0.04, "1").otherwise("0").alias("taxed"))
    out = sinks.narrow_types(li)
    kinds = dict(out.dtypes)
    return out.select(F.col("l_orderkey").cast("long").alias("l_orderkey"), F.col("l_linenumber").cast("int").alias("l_linenumber"), F.round(F.col("l_discount").cast("double"), 2).alias("l_discount"), F.col("taxed").cast("int").alias("taxed"),
                      F.lit(",".join(kinds[c] for c in ("l_linenumber", "l_discount", "taxed"))).alias("types"))


table_query("k07_narrow_types", _narrowed, "SELECT l_orderkey::BIGINT AS l_orderkey, l_linenumber::INTEGER AS l_linenumber, round(l_discount::DOUBLE, 2) AS l_discount, (l_tax > 0.04)::INTEGER AS taxed, 'smallint,float,boolean' AS types FROM lineitem")


# --- series derived by sources
def _growth(spark, sf):
    return shown(ma.growth(src.monthly(spark, sf), "low_freq"), {f"low_freq_{c}": 3 for c in ("yoy", "mom", "3m_annualized", "change", "change_3_avg")})


table_query("d01_growth", _growth, s.chain(["SELECT o_orderpriority AS series_id, CAST(date_trunc('month', o_orderdate) AS DATE) AS date, avg(o_totalprice) AS x FROM orders GROUP BY ALL", {"low_freq_yoy": f"{s.pct('x', 12)} * 100", "low_freq_mom": f"{s.pct('x', 1)} * 100", "low_freq_3m_annualized": f"{s.pct('x', 3)} * 400", "low_freq_change": f"x - {s.lag('x', 1)}"}, {"low_freq_change_3_avg": s.roll("avg", "low_freq_change", 3)}], {f"low_freq_{c}": 3 for c in ("yoy", "mom", "3m_annualized", "change", "change_3_avg")}))
register("d02_spreads", lambda b: ma.spreads(b, {"day_move": ("close", "open"), "upper": ("high", "close")}), [{"day_move": "close - open", "upper": "high - close"}, {"day_move_inverted": s.flag("day_move < 0"), "upper_inverted": s.flag("upper < 0")}],
         {"day_move": 2, "upper": 2, "day_move_inverted": None, "upper_inverted": None})
_q = lambda x, q: f"CASE WHEN count({x}) {s.over(252)} >= 252 THEN quantile_cont({x}, {q}) {s.over(252)} END"
register("d04_recession_parts", lambda b: ma.recession(ma.spreads(b, {"move": ("close", "open")}), inversion="move_inverted", unemployment="volume", production="close", stress="high", spread="low", sentiment="open"), [
    {"a3": s.roll("avg", "volume", 3), "m12": s.roll("min", "volume", 12), "y": s.pct("close", 12), "qh": _q("high", 0.8), "ql": _q("low", 0.8), "qo": _q("open", 0.2)},
    {"recession_probability_score": f"least(1.0::DOUBLE, {s.flag('close < open')} * 0.3::DOUBLE + {s.flag('a3 - m12 > 0.5')} * 0.2::DOUBLE + {s.flag('y < 0')} * 0.15::DOUBLE + {s.flag('high > qh')} * 0.15::DOUBLE + {s.flag('low > ql')} * 0.1::DOUBLE + {s.flag('open < qo')} * 0.1::DOUBLE)"},
    {"recession_risk_high": s.flag("recession_probability_score > 0.5")}], {"recession_probability_score": 4})
register("d05_day_range", ma.day_range, [{"range_volatility": "(high - low) / close", "momentum_5d": s.pct("close", 5), "momentum_22d": s.pct("close", 22)}], {"range_volatility": 5, "momentum_5d": 5, "momentum_22d": 5})
_ba = {x: f"{x} / first_value({x}) OVER ({s.W} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) * 100" for x in ("open", "high", "low")}
register("d08_cross_asset", lambda b: ma.cross_asset(b, ["close", "high"], ["low", "open"], ["open", "high", "low"]), [
    {f"r_{x}": s.pct(x, 1) for x in ("open", "high", "low", "close")},
    {"risk_on_off": "(r_close + r_high) / 2 - (r_low + r_open) / 2", "basket_volatility": "list_aggregate([r_open, r_high, r_low], 'stddev_samp') * sqrt(252)", "basket": f"({' + '.join(_ba.values())}) / 3", "on_off_correlation": s.scorr("r_close", "r_low", 66)}],
    {"risk_on_off": 4, "basket_volatility": 4, "basket": 3, "on_off_correlation": 5})
register("f09_level_flags", lambda b: ft.level_flags(b, "volume", (5, 22), (1, 2)), [{f"volume_ma_{n}": s.roll("avg", "volume", n) for n in (5, 22)} | {f"volume_above_{k}": s.flag(f"volume > {k}") for k in (1, 2)}], {"volume_ma_5": 4, "volume_ma_22": 4, "volume_above_1": None, "volume_above_2": None})
_E = 2 / 23


def _ewm_std_sql() -> str:
    """Weights (1 - a) ** age over what is there, as sums of a self-join."""
    w = f"power({1 - _E!r}, x.rn - y.rn)"
    return f"""SELECT p.*, e.v AS volatility_ewma FROM {{prev}} p LEFT JOIN (SELECT x.series_id, x.rn, CASE WHEN count(y.lr) > 1 THEN
        sqrt((sum({w} * y.lr * y.lr) / sum({w}) - power(sum({w} * y.lr) / sum({w}), 2)) * power(sum({w}), 2) / (power(sum({w}), 2) - sum({w} * {w}))) * sqrt(252) END AS v
        FROM {{prev}} x JOIN {{prev}} y ON x.series_id = y.series_id AND y.rn BETWEEN x.rn - 424 AND x.rn AND y.lr IS NOT NULL GROUP BY ALL) e ON p.series_id = e.series_id AND p.rn = e.rn"""


register("f06_ewma_volatility", ft.returns_and_volatility, [s.numbered() | {"lr": f"ln(close / {s.lag('close', 1)})"}, _ewm_std_sql()], {"volatility_ewma": 4})
_temporal = {f"close_lag_{k}": s.lag("close", k) for k in (1, 2, 5, 10, 22)} | {f"close_rolling_{k}_{n}": s.roll(f, "close", n) for k, f in (("mean", "avg"), ("std", "stddev_samp")) for n in (5, 22, 66)} | {"day_of_week": "(isodow(date) - 1)::INTEGER", "day_of_month": "day(date)::INTEGER", "quarter": "quarter(date)::INTEGER", "is_month_end": s.flag("last_day(date) = date"), "is_quarter_end": s.flag("last_day(date) = date AND month(date) % 3 = 0"), "day_of_week_cos": "cos(2 * pi() * (isodow(date) - 1) / 7)", "month_sin": "sin(2 * pi() * month(date) / 12)"}
register("t04_temporal", lambda b: ma.temporal(b, ["close"], ["close"]), [_temporal], {c: 3 if "rolling" in c else 6 if c.endswith(("sin", "cos")) else None for c in _temporal})

# --- whole chains
_low = "least(greatest({x}, q_{x}[1] - 1.5 * (q_{x}[2] - q_{x}[1])), q_{x}[2] + 1.5 * (q_{x}[2] - q_{x}[1])) AS {x}"
register("c00_clean", lambda b: cl.clean(gappy(b).select("series_id", "date", F.floor(F.col("gappy") / 50000).alias("gappy"), F.col("volume").cast("double").alias("volume")), ["gappy", "volume"], {"gappy": (1, 8)}), [
    "SELECT series_id, date, floor(CASE WHEN day(date) % 7 <> 0 THEN close END / 50000) AS gappy, volume::DOUBLE AS volume FROM {prev}",
    f"SELECT series_id, date, volume, coalesce({s.pad('gappy')}, first_value(gappy IGNORE NULLS) OVER ({s.W} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS gappy FROM {{prev}}",
    f"SELECT series_id, date, {_low.format(x='gappy')}, {_low.format(x='volume')} FROM {{prev}}, (SELECT quantile_cont(gappy, [0.25, 0.75]) AS q_gappy, quantile_cont(volume, [0.25, 0.75]) AS q_volume FROM {{prev}})",
    "SELECT series_id, date, volume, least(greatest(gappy, 1), 8) AS gappy FROM {prev}",
    "SELECT * FROM {prev} QUALIFY row_number() OVER (PARTITION BY series_id, gappy, volume ORDER BY date) = 1"], {"gappy": 3, "volume": 3})
register("q16_repair", lambda b: cl.repair(gappy(b), ["missing values", "outliers"], ["gappy"])[0], [
    s.GAPPY, f"SELECT series_id, date, coalesce({s.pad('gappy')}, first_value(gappy IGNORE NULLS) OVER ({s.W} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS gappy FROM {{prev}}",
    f"SELECT series_id, date, {_low.format(x='gappy')} FROM {{prev}}, (SELECT quantile_cont(gappy, [0.25, 0.75]) AS q_gappy FROM {{prev}})"], {"gappy": 3})
_families = ["i01_sma", "i05_moving_average_cross", "i02_ema", "i03_wma_hma", "i06_macd", "i19_adx", "i22_ichimoku", "i09_rsi", "i18_oscillators", "i26_momentum", "i12_bollinger", "i15_atr", "i24_channels", "i27_volume", "i31_pivots_strength", "i34_patterns"]


def _side_by_side(families: list[str]) -> tuple[dict, list[str], str]:
    """Result columns of queries, each column once, and SQL that joins their oracles."""
    out, picked = {}, []
    for k, name in enumerate(families):
        new = {c: d for c, d in OUTS[name].items() if c not in out}
        out |= new
        picked += [f"o{k}.{c}" for c in new]
    return out, picked, s.joined([ORACLES[n] for n in families], picked)


_all_out, _, _all_sql = _side_by_side(_families)
table_query("i39_all_indicators", lambda spark, sf: shown(ind.all_indicators(src.bars(spark, sf)), _all_out), _all_sql)
register("f04_close_volatility", lambda b: ft.parkinson(ft.returns_and_volatility(b)), [
    {"log_returns": f"ln(close / {s.lag('close', 1)})", "returns": s.pct("close", 1), "hl": "power(ln(high / low), 2)"},
    {"parkinson_vol": f"sqrt({s.roll('avg', 'hl', 22)} * 252 / (4 * ln(2)))"} | {f"volatility_{n}d": f"{s.roll('stddev_samp', 'log_returns', n)} * sqrt(252)" for n in ft.WINDOWS}],
    {"returns": 5, "log_returns": 5, "parkinson_vol": 5} | {f"volatility_{n}d": 5 for n in ft.WINDOWS})
_close_lags = {}
for _k in ft.LAGS:
    _close_lags |= {f"close_lag_{_k}": s.lag("close", _k), f"close_return_{_k}": s.pct("close", _k), f"close_diff_{_k}": f"close - {s.lag('close', _k)}"}
register("f18_close_lags", lambda b: ft.lag_features(b, ["close"]), [_close_lags], {c: None if "_lag_" in c else 3 if "_diff_" in c else 5 for c in _close_lags})
OUTS["f13_rolling_correlation"] = {"corr_asset_22d": 5, "corr_asset_66d": 5, "correlation_stability": 5}


def _engineered(spark, sf) -> DataFrame:
    """Every stage, with stand-ins for the columns that the test tables lack."""
    b = src.bars(spark, sf).join(src.asset2(spark, sf), "date", "left")
    b = b.withColumns({"policy_rate": F.col("close") / 10000, "inflation": F.col("low") / 20000, "policy_rate_us": F.col("open") / 30000, "inflation_us": F.col("high") / 40000})
    settings = pipeline.Settings(curve=("policy_rate", "policy_rate_us"), index_weights={"close": 0.6, "high": 0.4}, risk_weights={"close": 0.3, "low": 0.2}, levels={"volume": ((5, 22), (1, 2))}, others=["asset"], rolled=["close"],
                                 pairs=[("policy_rate", "inflation", "multiply"), ("policy_rate", "inflation_us", "divide")])
    return pipeline.engineer(b, settings)


_momentum = {f"{x}_momentum_{n}d": s.pct(c, n) for x, c in (("policy_rate", "close"), ("policy_rate_us", "open")) for n in (5, 22)}
register("f03_rate_momentum", lambda b: ft.rate_momentum(b.withColumns({"policy_rate": F.col("close"), "policy_rate_us": F.col("open")}), ["policy_rate", "policy_rate_us"]), [_momentum], dict.fromkeys(_momentum, 5))
_stages = ["f01_rates_carry", "f03_rate_momentum", "f04_close_volatility", "f06_ewma_volatility", "f08_vol_regime", "f09_level_flags", "f10_index_risk", "f13_rolling_correlation", "f14_price_action", "f15_calendar", "f18_close_lags", "f19_rolling_stats"]
_engineered_out, _, _engineered_sql = _side_by_side(_stages)
_whole = {c for c, d in _engineered_out.items() if d is None and not ("_lag_" in c or c in ("resistance_1m", "support_1m") or c.startswith(("close_min_", "close_max_")))} | {c for c in _engineered_out if c.endswith(("_sin", "_cos"))}
_filled = ", ".join(c if c in _whole else f"last_value({c} IGNORE NULLS) OVER ({s.W} ROWS BETWEEN 5 PRECEDING AND CURRENT ROW) AS {c}" for c in _engineered_out)
table_query("f23_engineered", lambda spark, sf: shown(_engineered(spark, sf), _engineered_out), f"SELECT series_id, date, {_filled} FROM ({_engineered_sql})")


# --- joins in time, files
def _asof(spark, sf):
    """Each view of a user with the value of the user's last purchase, of at most five days before."""
    e = _events(spark, sf).withColumnsRenamed({"user_id": "series_id", "ts": "date"})
    bought = e.where("event_type = 'purchase'").select("series_id", "date", F.col("value").alias("last_value"), F.col("event_id").alias("last_id"))
    views = e.where("event_type = 'view'").select("series_id", "date", "event_id")
    out = cl.asof_join(views, bought, ["last_value", "last_id"], tie="last_id", tolerance=5 * 86400)
    return out.select("event_id", F.col("series_id").alias("user_id"), "last_id", "last_value")


table_query("j05_asof_join", _asof, """WITH p AS (SELECT user_id, ts, max(event_id) AS last_id, arg_max(value, event_id) AS last_value FROM events WHERE event_type = 'purchase' GROUP BY ALL),
    v AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'view'),
    n AS (SELECT v.event_id, p.last_id, p.last_value, row_number() OVER (PARTITION BY v.event_id ORDER BY p.ts DESC) AS k FROM v JOIN p ON v.user_id = p.user_id AND p.ts <= v.ts AND p.ts >= v.ts - INTERVAL 5 DAY)
    SELECT v.event_id, v.user_id, n.last_id, n.last_value FROM v LEFT JOIN n ON v.event_id = n.event_id AND n.k = 1""")


def _files(spark, sf):
    """Daily highs written as a file for each series and year, one more that is broken, and a stretch of them read again."""
    path = files.shared_path(spark, "series")
    o = src.table(spark, sf, "orders")
    days = o.groupBy(F.col("o_orderpriority").alias("series_id"), F.to_date("o_orderdate").alias("date")).agg(F.max("o_totalprice").alias("value"))
    files.write_series_files(days, path)
    broken = days.groupBy().agg(F.lit("broken").alias("series_id"), F.lit(1997).alias("year"), F.lit("{not a record").alias("record"))
    broken.write.mode("append").partitionBy("series_id", "year").text(path)
    got = files.series_files(spark, path).where("date >= '1996-07-01' and date < '1998-03-01'")
    return got.select("series_id", "date", F.round("value", 2).alias("value"), F.col("error").isNotNull().cast("int").alias("failed"))


table_query("s11_series_files", _files, "SELECT o_orderpriority AS series_id, CAST(o_orderdate AS DATE) AS date, round(max(o_totalprice), 2) AS value, 0 AS failed FROM orders WHERE CAST(o_orderdate AS DATE) >= DATE '1996-07-01' AND CAST(o_orderdate AS DATE) < DATE '1998-03-01' GROUP BY ALL UNION ALL SELECT 'broken', NULL, NULL, 1")

def _replaced(spark, sf):
    """Bars stored by year, then all from a date on written anew with another close; read back."""
    path, b = files.shared_path(spark, "bars"), src.bars(spark, sf).select("series_id", "date", "close")
    sinks.export(b, path, "parquet")
    since = date(1998, 5, 17)
    sinks.replace_since(b.where(F.col("date") >= F.lit(since)).withColumn("close", -F.col("close")), path, since)
    return spark.read.parquet(path).select("series_id", "date", "close", F.col("year").cast("int").alias("year"))


table_query("k02_replace_since", _replaced, f"WITH {s.BARS} SELECT series_id, date, CASE WHEN date >= DATE '1998-05-17' THEN -close ELSE close END AS close, year(date)::INTEGER AS year FROM bars")


def _csv(spark, sf):
    """Bars written as CSV with fixed decimals and read back."""
    path, b = files.shared_path(spark, "csv"), src.bars(spark, sf)
    sinks.export(b.select("series_id", "date", F.col("close") / 7, "volume").toDF("series_id", "date", "part", "volume"), path, "csv", compression="gzip")
    return spark.read.option("header", True).schema("series_id string, date date, part double, volume long").csv(path)


table_query("k01_csv_round_trip", _csv, f"WITH {s.BARS} SELECT series_id, date, round(close / 7, 6) AS part, volume FROM bars")
_daily_out = {"close_lag_66": None, "volatility_66d": 5, "volatility_ewma": 4, "distance_from_ma_50": 5, "roc_22d": 5}


def _daily(spark, sf):
    """Features of the whole history stored by year, then the last months anew from a cut history; read back."""
    path, b = files.shared_path(spark, "features"), src.bars(spark, sf).withColumn("volume", F.col("volume").cast("double"))
    picked = pipeline.Settings(lags=(66,))
    whole = pipeline.engineer(cl.fill(b, picked.numeric), picked)
    sinks.export(whole.where("date < '2001-04-01'"), path, "parquet")
    pipeline.daily(b, picked, date(2001, 2, 10), path)
    return shown(spark.read.parquet(path), _daily_out)


_fresh = {"lr": f"ln(close / {s.lag('close', 1)})"}
table_query("k13_daily_run", _daily, s.chain([s.numbered() | _fresh, _ewm_std_sql(), {"close_lag_66": s.lag("close", 66), "volatility_66d": f"{s.roll('stddev_samp', 'lr', 66)} * sqrt(252)", "distance_from_ma_50": f"(close - {s.roll('avg', 'close', 50)}) / {s.roll('avg', 'close', 50)}", "roc_22d": s.pct("close", 22)}, f"SELECT *, {', '.join(f'last_value({c} IGNORE NULLS) OVER ({s.W} ROWS BETWEEN 5 PRECEDING AND CURRENT ROW) AS f_{c}' for c in _daily_out)} FROM {{prev}}", f"SELECT series_id, date, {', '.join(f'f_{c} AS {c}' for c in _daily_out)} FROM {{prev}}"], _daily_out))

def _wide_correlations(spark, sf):
    """Thirty columns: prices and their lags, with missing values at the start of each series."""
    b = src.bars(spark, sf)
    xs = [f"{x}_{k}" for x in ("open", "high", "close") for k in range(10)]
    wide = b.select(*[shift(x, k).alias(f"{x}_{k}") for x in ("open", "high", "close") for k in range(10)])
    return qu.correlation_matrix(wide, xs).withColumn("corr", F.round("corr", 6))


_lagged = [f"{x}_{k}" for x in ("open", "high", "close") for k in range(10)]
table_query("a07_wide_correlations", _wide_correlations, f"WITH {s.BARS}, w AS (SELECT " + ", ".join(f"{s.lag(c.split('_')[0], int(c.split('_')[1]))} AS {c}" for c in _lagged) + " FROM bars), one AS (SELECT " + ", ".join(f"corr({a}, {b}) AS {a}__{b}" for i, a in enumerate(_lagged) for b in _lagged[i + 1 :]) + " FROM w) SELECT split_part(name, '__', 1) AS a, split_part(name, '__', 2) AS b, round(corr, 6) AS corr FROM (UNPIVOT one ON COLUMNS(*) INTO NAME name VALUE corr)")

# --- series in blocks
_split = ["i01_sma", "i02_ema", "i12_bollinger", "i27_volume", "f14_price_action", "f18_close_lags"]
_split_out, _, _split_sql = _side_by_side(_split)


def _in_blocks(df: DataFrame) -> DataFrame:
    for family in (ind.moving_averages, ind.exponential_averages, ind.bollinger, ind.volume_indicators, ft.price_action, lambda d: ft.lag_features(d, ["close"])):
        df = family(df)
    return df


table_query("w01_series_in_blocks", lambda spark, sf: shown(by_blocks(src.bars(spark, sf), _in_blocks, 500), _split_out), _split_sql)
_range = [{"high": s.roll("max", "close", 9), "low": s.roll("min", "close", 9)}]
register("i14_synthetic_range", lambda b: ind.synthetic_range(b.drop("high", "low")), ["SELECT series_id, date, close FROM {prev}", *_range], {"high": 2, "low": 2})


# --- checks
def _sources(spark, sf):
    return qu.source_checks(gappy(src.bars(spark, sf)), {"gappy": (5000, 450000), "volume": (1, 3)}, F.lit("2002-01-01").cast("date")).withColumn("value", F.round("value", 4))


_in = {"gappy": "(gappy BETWEEN 5000 AND 450000)", "volume": "(volume BETWEEN 1 AND 3)"}
_one = {}
for _x in _in:
    _one |= {f"valid_{_x}": f"avg({s.flag(_in[_x])})", f"all_valid_{_x}": f"min({s.flag(_in[_x])})", f"null_pct_{_x}": f"avg(({_x} IS NULL)::INT) * 100", f"coverage_{_x}": f"count({_x}) / count(*)"}
_one["days_old"] = "DATE '2002-01-01' - max(date)"
table_query("sv1_source_checks", _sources, f"WITH {s.BARS}, g AS ({s.GAPPY}), one AS (SELECT {', '.join(f'({e})::DOUBLE AS {m}' for m, e in _one.items())} FROM g) SELECT 'source' AS \"check\", metric, round(value, 4) AS value FROM (UNPIVOT one ON COLUMNS(*) INTO NAME metric VALUE value)")
_pairs = {("open", "close"): (0.5, 1.0), ("high", "volume"): (0.0, 1.0), ("low", "volume"): (0.0, 1.0)}
table_query("q07_expected_correlations", lambda spark, sf: qu.expected_correlations(src.bars(spark, sf), _pairs).withColumn("corr", F.round("corr", 6)), f"WITH {s.BARS} " + " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS corr, (corr({a}, {b}) BETWEEN {lo} AND {hi})::INTEGER AS expected FROM bars" for (a, b), (lo, hi) in _pairs.items()))
table_query("q07_redundant_pairs", lambda spark, sf: qu.redundant_pairs(src.bars(spark, sf), ["open", "high", "low", "close"], 0.6).withColumn("corr", F.round("corr", 6)), f"SELECT a, b, round(corr, 6) AS corr FROM (WITH {s.BARS} " + " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, corr({a}, {b}) AS corr FROM bars" for i, a in enumerate(("open", "high", "low", "close")) for b in ("open", "high", "low", "close")[i + 1 :]) + ") WHERE abs(corr) > 0.6")


def _verdict(spark, sf):
    b = gappy(src.bars(spark, sf))
    rows = qu.completeness(b, ["gappy", "close"]).unionByName(qu.ranges(b, {"close": (1000, 400000)}))
    return qu.recommendations(qu.verdicts(rows, {"rows": (100, None), "null_pct_gappy": (None, 5), "out_close": (None, 0)})).select("check", "advice")


table_query("q11_recommendations", _verdict, f"WITH {s.BARS}, g AS ({s.GAPPY}) SELECT 'completeness' AS \"check\", 'fill missing values' AS advice FROM g HAVING avg((gappy IS NULL)::INT) > 0.05 UNION ALL SELECT 'completeness', 'look at it by hand' FROM g HAVING count(*) < 100 UNION ALL SELECT 'ranges', 'clip to the allowed range' FROM g HAVING count(*) FILTER (close < 1000 OR close > 400000) > 0")


_limits = {"rows": (100, None), "longest_gap": (None, 30), "redundant_pairs": (None, 0), "duplicate_keys": (None, 0), "drifted_close": (None, 0)}
_checked = ["high", "close", "volume"]


def _combined(spark, sf):
    """Every metric of every check, whether the check passed, and its issues."""
    b = src.bars(spark, sf).withColumn("volume", F.col("volume").cast("double"))
    out = pipeline.validate(b, pipeline.Settings(numeric=_checked), _limits, 1)
    rows = out.select("check", F.col("passed").cast("int").alias("passed"), F.array_join("issues", "; ").alias("issues"), F.explode("metrics").alias("metric", "value"))
    return rows.withColumn("value", F.round("value", 3))


def _unpivot(check: str, metrics: dict[str, str], source: str) -> str:
    one = ", ".join(f"({e})::DOUBLE AS {m}" for m, e in metrics.items())
    return f"SELECT '{check}' AS \"check\", metric, value FROM (UNPIVOT (SELECT {one} FROM {source}) ON COLUMNS(*) INTO NAME metric VALUE value)"


def _each(**metrics: str) -> dict[str, str]:
    """{metric_x: expression of x} for every column checked."""
    return {f"{m}_{x}": e.format(x=x) for x in _checked for m, e in metrics.items()}


_of_all = ", ".join(f"avg({x}) AS m_{x}, stddev_pop({x}) AS p_{x}, stddev_samp({x}) AS s_{x}, quantile_cont({x}, 0.25) AS a_{x}, quantile_cont({x}, 0.75) AS b_{x}" for x in _checked)
_sizes = [f"abs(corr({a}, {b}))" for i, a in enumerate(_checked) for b in _checked[i + 1 :]]
_beyond = "({x} < '-infinity'::DOUBLE OR {x} > 'infinity'::DOUBLE)"
_cv = lambda x, k: f"coalesce(stddev_samp({x}) FILTER (k = {k}) / nullif(abs(avg({x}) FILTER (k = {k})), 0), 0)"
_moved = ", ".join(f"CASE WHEN count(*) >= 20 AND count({x}) > 10 THEN abs({_cv(x, 2)} - {_cv(x, 1)}) ELSE 0 END AS d_{x}" for x in _checked)
_half_sql = f"SELECT *, CASE WHEN row_number() OVER ({s.W}) <= floor(count(*) OVER (PARTITION BY series_id) / 2) THEN 1 ELSE 2 END AS k FROM b"
_parts = [
    _unpivot("completeness", {"rows": "count(*)"} | _each(null_pct="avg(({x} IS NULL)::INT) * 100"), "b"),
    _unpivot("data_types", {"wrong_types": " + ".join(f"(typeof(any_value({x})) <> 'DOUBLE')::INT" for x in _checked)}, "b"),
    _unpivot("ranges", _each(out=f"count(*) FILTER ({_beyond})", min="min({x})", max="max({x})", ok=f"(avg({_beyond}::INT) <= 0.01)::INT"), "b"),
    _unpivot("outliers", _each(z="count(*) FILTER (abs({x} - m_{x}) > 4 * p_{x})", iqr="count(*) FILTER ({x} < a_{x} - 1.5 * (b_{x} - a_{x}) OR {x} > b_{x} + 1.5 * (b_{x} - a_{x}))"), "b, st"),
    _unpivot("extreme_values", _each(extreme="count(*) FILTER (abs({x} - m_{x}) > 5 * s_{x})"), "b, st"),
    _unpivot("business_rules", _each(negative="count(*) FILTER ({x} < 0)"), "b"),
    _unpivot("correlations", {"mean_abs_corr": f"({' + '.join(_sizes)}) / {len(_sizes)}", "max_abs_corr": f"greatest({', '.join(_sizes)})", "redundant_pairs": " + ".join(f"({c} > 0.95)::INT" for c in _sizes), "matrix_mean_abs_corr": f"(2 * ({' + '.join(_sizes)}) + 3) / 9"}, "b"),
    _unpivot("duplicates", {"duplicate_keys": "count(*) - count(DISTINCT (series_id, date))", "duplicate_rows": f"count(*) - count(DISTINCT (series_id, date, {', '.join(_checked)}))"}, "b"),
    f"SELECT * FROM ({ORACLES['q06_time_integrity']})",
    _unpivot("drift", _each(drifted="count(*) FILTER (d_{x} > 0.2)"), "dr"),
]
_issue = " ".join(f"WHEN metric = '{m}' AND (value < {lo if lo is not None else '-1e300'} OR value > {hi if hi is not None else '1e300'}) THEN metric || ' = ' || value" for m, (lo, hi) in (_limits | {"wrong_types": (None, 0)}).items())
table_query("q15_combined_validation", _combined, f"""WITH {s.BARS}, b AS (SELECT * REPLACE (volume::DOUBLE AS volume) FROM bars), st AS (SELECT {_of_all} FROM b),
    h AS ({_half_sql}), dr AS (SELECT {_moved} FROM h GROUP BY series_id),
    m AS ({' UNION ALL '.join(_parts)}), i AS (SELECT *, CASE {_issue} END AS issue FROM m),
    g AS (SELECT "check", count(issue) AS n, coalesce(string_agg(issue, '; ' ORDER BY issue), '') AS issues FROM i GROUP BY "check")
    SELECT "check", (n = 0)::INT AS passed, issues, metric, round(value, 3) AS value FROM i JOIN g USING ("check")""")


def _rules(spark, sf):
    b = src.bars(spark, sf).withColumn("change", (F.col("close") - F.col("open")) / 1000)
    return qu.business_rules(b, ["change"], [], ["change"], [("close", "volume")]).unionByName(qu.correlations(b, ["open", "high", "low", "close"], 0.6)).unionByName(qu.types(b, ["open", "series_id", "absent"])).withColumn("value", F.round("value", 6))


_abs = [f"abs(corr({a}, {b}))" for i, a in enumerate(("open", "high", "low", "close")) for b in ("open", "high", "low", "close")[i + 1 :]]
table_query("q09_rules_and_correlations", _rules, f"""WITH {s.BARS}, one AS (SELECT (count(*) FILTER (close < open))::DOUBLE AS negative_change, (count(*) FILTER ((close - open) / 1000 NOT BETWEEN -1 AND 100))::DOUBLE AS unreasonable_change, corr(close, volume) AS corr_close_volume FROM bars),
    two AS (SELECT ({' + '.join(_abs)}) / 6 AS mean_abs_corr, greatest({', '.join(_abs)}) AS max_abs_corr, ({' + '.join(f'({x} > 0.6)::INT' for x in _abs)})::DOUBLE AS redundant_pairs, (2 * ({' + '.join(_abs)}) + 4) / 16 AS matrix_mean_abs_corr FROM bars)
    SELECT 'business_rules' AS "check", metric, round(value, 6) AS value FROM (UNPIVOT one ON COLUMNS(*) INTO NAME metric VALUE value)
    UNION ALL SELECT 'correlations', metric, round(value, 6) FROM (UNPIVOT two ON COLUMNS(*) INTO NAME metric VALUE value) UNION ALL SELECT 'data_types', 'wrong_types', 2.0::DOUBLE""")
