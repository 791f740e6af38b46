"""Series files as a data source, and as-of joins against pandas."""

from datetime import date, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidegauge.operators import cleaning
from tidegauge.sources import files, tables

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = "file://" + str(tmp_path_factory.mktemp("series"))
    rows = [(name, date(1997 + k // 5, 1, 1) + timedelta(days=70 * (k % 5)), float(k)) for name in ("a", "b c", "d=é") for k in range(20)]
    files.write_series_files(spark.createDataFrame(rows, "series_id string, date date, value double"), path)
    for bad in (("a", 1998, "{not json"), ("b c", 2000, '[{"data": "31/12/2000", "valor": "x"}, {"data": "1/13/2000", "valor": "2.5"}]'), ("b c", 2000, "[3]")):
        one = spark.createDataFrame([bad], "series_id string, year int, record string")
        one.write.mode("append").partitionBy("series_id", "year").text(path)
    return path


def test_series_files(spark, folder):
    got = files.series_files(spark, folder)
    rows = got.where("error is null").collect()
    assert len(rows) == 62 and {r.series_id for r in rows} == {"a", "b c", "d=é"}
    assert {(r.date, r.value) for r in rows if r.value is None or r.date is None} == {(date(2000, 12, 31), None), (None, 2.5)}
    assert sorted(r.series_id for r in got.where("error is not null").collect()) == ["a", "b c"]


def test_filters_reach_the_files(spark, folder, capfd):
    some = files.series_files(spark, folder).where("date >= '1998-03-01' and date < '1999-07-01' and series_id in ('a', 'd=é')")
    rows = some.collect()
    want = sum(1 for k in range(20) if date(1998, 3, 1) <= date(1997 + k // 5, 1, 1) + timedelta(days=70 * (k % 5)) < date(1999, 7, 1))
    assert sum(r.error is None for r in rows) == 2 * want and [r.series_id for r in rows if r.error] == ["a"]
    assert some.rdd.getNumPartitions() == 4  # two series, two years
    assert "Filter (" not in some._jdf.queryExecution().executedPlan().toString()
    reader = files.SeriesReader(folder)
    assert list(reader.pushFilters([files.EqualTo(("date",), date(2000, 1, 1)), files.EqualTo(("value",), 3.0)])) == [files.EqualTo(("value",), 3.0)]
    assert {p.year for p in reader.partitions()} == {2000}


def test_an_empty_folder(spark, tmp_path):
    assert files.series_files(spark, f"file://{tmp_path}").count() == 0


@pytest.mark.parametrize("direction", ["backward", "forward", "nearest"])
@pytest.mark.parametrize("tolerance", [None, 40])
def test_asof_join(spark, direction, tolerance):
    rng = np.random.default_rng(3)
    times = lambda n: pd.to_datetime("2024-01-01") + pd.to_timedelta(np.sort(rng.choice(2000, n, replace=False)), unit="s")
    left = pd.concat([pd.DataFrame({"series_id": k, "date": times(60), "x": rng.random(60)}) for k in "abc"])
    right = pd.concat([pd.DataFrame({"series_id": k, "date": times(25), "y": rng.random(25)}) for k in "abd"])
    got = cleaning.asof_join(spark.createDataFrame(left), spark.createDataFrame(right), ["y"], direction=direction, tolerance=tolerance)
    limit = {} if tolerance is None else {"tolerance": pd.Timedelta(seconds=tolerance)}
    want = pd.merge_asof(left.sort_values("date"), right.sort_values("date"), on="date", by="series_id", direction=direction, **limit)
    merged = got.toPandas().merge(want, on=["series_id", "date", "x"], suffixes=("", "_want"))
    assert len(merged) == len(left) == got.count() and np.allclose(merged.y, merged.y_want, equal_nan=True)


def test_asof_join_cases(spark):
    """Ties, NULL keys and times, repeated rows, clashing names, and a span of centuries without a row for each day."""
    left = spark.sql("SELECT * FROM VALUES (null, DATE '1600-01-01', 1), (null, DATE '2024-01-01', 2), ('a', null, 3), ('a', DATE '2024-01-02', 4), ('a', DATE '2024-01-02', 4) AS t(series_id, date, y)")
    right = spark.sql("SELECT * FROM VALUES (null, DATE '1601-01-01', 7, 1), ('a', DATE '2024-01-02', 8, 1), ('a', DATE '2024-01-02', 9, 2), ('a', null, 5, 9) AS t(series_id, date, y, n)")
    got = cleaning.asof_join(left, right, ["y"], tie="n").collect()
    assert sorted((r.series_id or "", str(r.date), r.y or 0) for r in got) == [("", "1600-01-01", 0), ("", "2024-01-01", 7), ("a", "2024-01-02", 9), ("a", "2024-01-02", 9), ("a", "None", 0)]
    assert cleaning.asof_join(left.limit(0), right, ["y"]).count() == 0 and cleaning.asof_join(left, right.limit(0), ["y"]).where("y is not null").count() == 0
    with pytest.raises(ValueError):
        cleaning.asof_join(left, right, ["y"], direction="sideways")


def test_asof_join_is_align_on_days(spark):
    bars, monthly = tables.bars(spark, SMALL).select("series_id", "date", "close"), tables.monthly(spark, SMALL)
    daily = cleaning.align(bars, monthly, "low_freq").where("close is not null")
    last = monthly.groupBy("series_id").agg(F.max("date").alias("last"))
    asof = cleaning.asof_join(bars, monthly, ["low_freq"]).join(last, "series_id").where("date <= last").drop("last")
    both = daily.join(last, "series_id").where("date <= last").select(*asof.columns)
    assert asof.exceptAll(both).count() == 0 and both.exceptAll(asof).count() == 0
