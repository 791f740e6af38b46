"""Window kernels against pandas, edge cases by hand, sinks, streaming, and queries against DuckDB."""

import json
import math
import os
from datetime import date, timedelta

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tidegauge.functions import windows as w
from tidegauge.functions.orders import Rank, with_order_stats
from tidegauge.functions.quantiles import quantiles
from tidegauge.functions.tails import ln_gamma, student_t_p
from tidegauge.operators import cleaning, features, indicators, quality
from tidegauge.plans import catalogue, pipeline, sinks
from tidegauge.sources import panels, tables
from tidegauge.streaming.bars import windowed_bars

SMALL = "/root/testdata/sf0.001"
DAY = date(2020, 1, 1)


def series(spark, values, name="a"):
    return spark.createDataFrame([(name, DAY + timedelta(days=i), v) for i, v in enumerate(values)], "series_id string, date date, x double")


def column(df, c):
    return [r[c] for r in df.orderBy("series_id", "date").select(c, "series_id", "date").collect()]


def close(a, b, tol=1e-9):
    return all((x is None and (y is None or math.isnan(y))) or (x is not None and abs(x - y) < tol) for x, y in zip(a, b, strict=True))


GAPS = [None, 1.0, None, 2.0, 4.0, None, None, None, None, None, None, 3.0, 5.0, 5.0, 5.0, 1.0, 0.5, 7.0, 2.0, 2.5]


@pytest.mark.parametrize("name,build,expect", [
    ("ewm", lambda d: w.ewm(d, {"y": ("x", 5)}), lambda s: s.ewm(span=5, adjust=False).mean()),
    ("std", lambda d: w.ewm_std(d, "y", "x", 5), lambda s: s.ewm(span=5).std()),
    ("roll", lambda d: d.withColumn("y", w.roll(F.avg, "x", 3)), lambda s: s.rolling(3).mean()),
    ("sd", lambda d: d.withColumn("y", w.roll(F.stddev_samp, "x", 3)), lambda s: s.rolling(3).std()),
    ("ffill", lambda d: d.withColumn("y", w.ffill("x", 5)), lambda s: s.ffill(limit=5)),
])
def test_kernels(spark, name, build, expect):
    got = column(build(series(spark, GAPS)), "y")
    assert close(got, expect(pd.Series(GAPS, dtype=float)).tolist(), 1e-8)


def test_recursions_over_many_blocks(spark):
    """Long series, long gaps and short spans: block-wise sums give what the recursion gives."""
    rng = np.random.default_rng(6)
    values = np.where(rng.random(6000) < 0.3, np.nan, 1000 + np.cumsum(rng.standard_normal(6000)))
    values[2000:3500] = np.nan
    s = pd.Series(values)
    df = series(spark, [None if np.isnan(v) else float(v) for v in values])
    got = w.ewm(df, {"a": ("x", 2), "b": ("x", 26), "c": ("x", 200)})
    got = w.smooth(got, {"d": ("x", 0.1)}, ages=False)
    got = w.ewm_std(w.wilder(got, {"e": "x"}, 14), "f", "x", 22).orderBy("date").toPandas()
    assert np.allclose(got.a, s.ewm(span=2, adjust=False).mean(), rtol=1e-10, equal_nan=True)
    assert np.allclose(got.b, s.ewm(span=26, adjust=False).mean(), rtol=1e-10, equal_nan=True)
    assert np.allclose(got.c, s.ewm(span=200, adjust=False).mean(), rtol=1e-10, equal_nan=True)
    assert np.allclose(got.d, s.ewm(alpha=0.1, adjust=False, ignore_na=True).mean(), rtol=1e-10, equal_nan=True)
    assert np.allclose(got.f.astype(float), s.ewm(span=22).std(), rtol=1e-6, equal_nan=True)
    there = s.dropna()
    want = pd.concat([pd.Series([there.iloc[:14].mean()], index=[there.index[13]]), there.iloc[14:]]).ewm(alpha=1 / 14, adjust=False).mean()
    assert np.allclose(got.e.astype(float).dropna(), want, rtol=1e-10) and got.e.notna().sum() == len(want)


def test_padded_change_and_rank(spark):
    df = series(spark, [1.0, None, 2.0, 4.0]).withColumn("p", w.pad("x")).withColumn("y", w.pct("p", 1))
    assert column(df, "y") == [None, 0.0, 1.0, 1.0]
    df = with_order_stats(series(spark, [1.0, 1.0, 2.0]), {"y": Rank("x", 3)})
    assert column(df, "y")[:2] == [None, None] and abs(column(df, "y")[2] - 1.0) < 1e-12


def test_constant_series(spark):
    df = series(spark, [2.0] * 30).withColumn("close", F.col("x")).withColumn("y", w.scorr("x", "close", w.rows(5), 5))
    assert set(column(df, "y")) == {None}
    assert column(indicators.rsi(df), "rsi")[-1] is not None


def test_two_series_alone_or_together(spark):
    rng = np.random.default_rng(0)
    a, b = series(spark, rng.random(60).tolist(), "a"), series(spark, rng.random(60).tolist(), "b")
    f = lambda d: column(w.ewm(d, {"y": ("x", 9)}), "y")
    assert f(a.union(b)) == f(a) + f(b)


def test_fills(spark):
    s = pd.Series(GAPS, dtype=float)
    got = {m: column(cleaning.fill_missing(series(spark, GAPS), ["x"], m), "x") for m in ("forward_fill", "backward_fill", "interpolate")}
    assert close(got["forward_fill"], s.ffill(limit=5).tolist()) and close(got["backward_fill"], s.bfill(limit=5).tolist()) and close(got["interpolate"], s.interpolate(limit=5).tolist())
    with pytest.raises(ValueError):
        cleaning.fill_missing(series(spark, GAPS), ["x"], "other")
    same = cleaning.drop_same_values(series(spark, [1.0, 1.0, None, None, 2.0]), ["x"])
    assert column(same, "x") == [1.0, None, 2.0]


def test_sparse_columns_go(spark):
    df = series(spark, [1.0, 2.0, 3.0, 4.0]).withColumns({"half": F.when(F.day("date") > 2, 1.0), "none": F.lit(None).cast("double"), "inf": F.lit(float("inf"))})
    assert features.drop_sparse(df).columns == ["series_id", "date", "x", "half"]


def test_p_values(spark):
    """Student's t against its known quantiles and closed forms, small and large degrees of freedom."""
    def sums(t, n):
        """Finite sums for whole degrees of freedom."""
        th, odd = math.atan(t / math.sqrt(n)), n % 2
        of = lambda k: math.lgamma(k + 1) - math.lgamma(k + 1.5) + math.log(math.pi) / 2 - math.log(2) if odd else math.lgamma(k + 0.5) - math.lgamma(k + 1) - math.log(math.pi) / 2
        total = math.sin(th) * sum(math.exp(of(k) + (2 * k + odd) * math.log(math.cos(th))) for k in range((n - 2 - odd) // 2 + 1))
        return 1 - (2 / math.pi * (th + total) if odd else total)

    cases = [(0.0, 10, 1.0), (2.228138852, 10, 0.05), (12.7062047362, 1, 0.05), (-12.7062047362, 1, 0.05), (3.0, 2, 1 - 3 / 11**0.5), (1.959963985, 10**7, 0.05)]
    cases += [(t, n, sums(t, n)) for t, n in ((40.0, 5), (0.5, 1700), (2.5, 33), (1.0, 4))]
    df = spark.createDataFrame(cases, "t double, df long, want double").withColumn("p", student_t_p(F.col("t"), F.col("df")))
    for r in df.collect():
        assert r.p == pytest.approx(r.want, rel=2e-4 if r.want < 1e-3 else 1e-6, abs=2e-7 if r.df > 10**6 else 1e-12), r
    assert spark.createDataFrame([(None, 3), (1.0, 0)], "t double, df long").select(student_t_p(F.col("t"), F.col("df")).alias("p")).where("p is not null").count() == 0
    g = spark.range(1, 60).select("id", ln_gamma(F.col("id") / 2).alias("g")).collect()
    assert all(abs(r.g - math.lgamma(r.id / 2)) <= 1e-12 * max(1, abs(r.g)) for r in g)


def test_a_check_that_fails_while_it_runs(spark):
    """Its rows say so, and the others stand."""
    bars = tables.bars(spark, SMALL)
    rows = quality.isolated({"fine": lambda: quality.completeness(bars, ["close"]), "late": lambda: quality.completeness(bars.withColumn("close", F.raise_error(F.lit("broken")).cast("double")), ["close"])})
    assert [(c, m) for c, m, _ in rows] == [("completeness", "rows"), ("completeness", "null_pct_close"), ("late", "error")]


def test_name_clash_is_an_error(spark):
    a = series(spark, [1.0])
    with pytest.raises(ValueError):
        cleaning.outer_join([a, a], ["series_id", "date"])


def test_sinks(spark, tmp_path):
    df = series(spark, [1.0, 2.5, None]).withColumn("n", F.lit(7))
    assert dict(sinks.narrow_types(df).dtypes)["n"] == "smallint" and dict(sinks.narrow_types(df).dtypes)["x"] == "float"
    sinks.export(df, str(tmp_path / "c"), "csv", single=True, compression="gzip")
    assert spark.read.csv(str(tmp_path / "c"), header=True).where("x = '2.500000'").count() == 1
    sinks.export(df, str(tmp_path / "p"), "parquet")
    assert tables.stored_range(spark, str(tmp_path / "p"), "2020-01-02").count() == 2
    assert json.loads(sinks.metadata(df))["nulls"]["x"] == 1
    for bad in (("hdf5", {}), ("csv", {"compression": "zip"})):
        with pytest.raises(ValueError):
            sinks.export(df, str(tmp_path / "x"), bad[0], **bad[1])


def test_pipeline_modes(spark):
    bars = tables.bars(spark, SMALL).withColumn("volume", F.col("volume").cast("double"))
    s = pipeline.Settings()
    full, written = pipeline.run([bars], s, out="unused", dry_run=True)
    assert written is None and full.count() == bars.count()
    checks = pipeline.validate(bars, s, {"rows": (100, None), "longest_gap": (None, 0)}).collect()
    passed = {r.check: r.passed for r in checks}
    assert len(passed) == 10 and not passed["time_integrity"] and passed["completeness"] and passed["data_types"]
    broken = {r.check: (r.passed, r.issues) for r in pipeline.validate(bars.drop("open"), s, {}).collect()}
    assert broken["outliers"] == (False, ["error = 1.0"]) and broken["data_types"][0] is False and broken["time_integrity"][0] and broken["duplicates"][0] is False


@pytest.mark.parametrize("n,spread", [(1, 3), (2, 9), (37, 5), (4000, 1 << 40), (4000, 7)])
def test_quantiles_are_exact(spark, n, spread):
    """Small and large columns, many ties, NULLs, a constant column and one without values, coarse sketches."""
    rng = np.random.default_rng(n + spread % 1000)
    rows = [(float(v) if k % 5 else None, 3.0, None) for k, v in enumerate(rng.integers(-spread, spread, n + 1))]
    df = spark.createDataFrame(rows, "a double, `b.c` double, d double").withColumnRenamed("b.c", "b")
    qs = [0.0, 0.1, 0.25, 0.5, 0.75, 1.0]
    got = quantiles(df, ["a", "b", "d"], qs, accuracy=50).first()
    there = [r[0] for r in rows if r[0] is not None]
    assert np.allclose(got["_q_a"], np.quantile(there, qs), rtol=1e-12) and got["_q_b"] == [3.0] * 6 and got["_q_d"] is None
    assert quantiles(df.limit(0), ["a"], qs).first()["_q_a"] is None


def test_panels(spark, tmp_path):
    one = lambda rows: spark.createDataFrame(rows, "series_id string, date date, value double")
    rows = [("a", DAY + timedelta(days=k), float(k)) for k in range(2)]
    later = one([("a", DAY + timedelta(days=k), -1.0) for k in range(10)])
    sources = {"x.y": lambda: one(rows + rows[:1]), "z": lambda: later, "gone": lambda: spark.read.parquet(str(tmp_path / "none")), "other": lambda: one(rows).drop("value"), "text": lambda: later.withColumn("value", F.lit("1.5"))}
    long, failed = panels.scan(sources)
    assert sorted(failed) == ["gone", "other"] and panels.scan({})[0] is None
    out = {r.date: (r["x.y"], r.z, r.text) for r in panels.panel(long, ["x.y", "z", "text"], 5).collect()}
    assert [out[DAY + timedelta(days=k)] for k in (0, 1, 6, 7)] == [(0.0, -1.0, 1.5), (1.0, -1.0, 1.5), (1.0, -1.0, 1.5), (None, -1.0, 1.5)]
    twice = panels.concat([one(rows), one(rows[:1]), one([])], ["series_id", "date"])
    assert twice.columns == ["series_id", "date", "value", "value_2", "value_3"] and {r.value_2 for r in twice.collect()} == {0.0, None}
    assert panels.missing_columns(twice, ["date", "close"]) == ["close"]


def test_narrow_text(spark):
    df = spark.createDataFrame([("0", "0", "0"), ("1", None, "2")], "a string, b string, c string")
    out = sinks.narrow_types(df)
    assert [t for _, t in out.dtypes] == ["boolean", "string", "string"] and [r.a for r in out.collect()] == [False, True]


def test_stream_equals_batch(spark, tmp_path):
    events = tables.table(spark, SMALL, "events")
    events.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(events.schema).parquet(str(tmp_path / "in"))
    q = windowed_bars(stream).writeStream.format("memory").queryName("bars_out").outputMode("complete").start()
    q.processAllAvailable()
    q.stop()
    got = {tuple(r) for r in spark.table("bars_out").collect()}
    assert got == {tuple(r) for r in windowed_bars(events).collect()} and got


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(SMALL):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SMALL}/{f}'")
    return con


@pytest.mark.parametrize("name", sorted(set(catalogue.ORACLES) - {"f23_engineered"}))  # too few rows here: sparse columns go
def test_queries_against_duckdb(spark, duck, name):
    got = entry.queries()[name](spark, SMALL)
    want = duck.sql(entry.oracle_sql()[name])
    cols = sorted(got.columns)
    assert sorted(want.columns) == cols
    a = pd.DataFrame([tuple(r) for r in got.select(*cols).collect()], columns=cols, dtype=object)
    b = pd.DataFrame(want.fetchall(), columns=want.columns, dtype=object)[cols]
    assert len(a) == len(b)
    keys = [c for c in ("series_id", "date", "start", "check", "metric", "advice", "a", "b", "feature", "event_type", "type", "event_id", "l_suppkey", "o_orderkey") if c in cols]
    a, b = (f.sort_values(keys, key=lambda s: s.astype(str)).reset_index(drop=True) for f in (a, b))
    for c in cols:
        for x, y in zip(a[c], b[c], strict=True):
            assert (x is None) == (y is None) and (x is None or x == y or abs(x - y) <= 2e-2 * max(1, 1e-6 * abs(y))), (c, x, y)


def test_repair_and_advice(spark):
    df = series(spark, [1.0, None, 2.0, 2.0, 3.0])
    fixed, left = cleaning.repair(df, ["missing values in x", "duplicate rows", "odd units"], ["x"])
    assert left == ["odd units"] and sorted(r.x for r in fixed.collect()) == [1.0, 2.0, 3.0]
    assert quality.wrong_types(df.withColumn("y", F.lit("a")), ["x", "y", "absent"]) == ["y"]
    checks = quality.verdicts(quality.completeness(df, ["x"]), {"null_pct_x": (None, 5)})
    assert [r.advice for r in quality.recommendations(checks).collect()] == ["fill missing values"]


def test_weighted_deviation_skips_nulls(spark):
    values, keep = [None, 1.0, 4.0, None, 2.0], 1 - 2 / 6
    got = column(w.ewm_std(series(spark, values), "sd", "x", 5), "sd")
    for i, sd in enumerate(got):
        pairs = [(keep ** (i - k), v) for k, v in enumerate(values[: i + 1]) if v is not None]
        if len(pairs) < 2:
            assert sd is None
            continue
        total, squares = sum(a for a, _ in pairs), sum(a * a for a, _ in pairs)
        mean = sum(a * v for a, v in pairs) / total
        assert sd == pytest.approx((sum(a * (v - mean) ** 2 for a, v in pairs) * total / (total * total - squares)) ** 0.5)


def test_row_deviation_needs_two_values(spark):
    df = spark.sql("SELECT double(null) a, double(null) b, double(1) c").select(features.row_stat([F.col("a"), F.col("b")], "std").alias("none"), features.row_stat([F.col("a"), F.col("c")], "std").alias("one"))
    assert tuple(df.first()) == (None, None)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
