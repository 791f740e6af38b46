"""Many series side by side: sources that fail alone, long to wide with a bounded forward fill, markets by ticker."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.windows import ffill, shift


def scan(sources: dict[str, Callable[[], DataFrame]]) -> tuple[DataFrame | None, dict[str, str]]:
    """{name: () -> (series_id, date, value)} to long rows (series_id, date, name, value), and the error of each source that cannot
    be read or has not these columns; such a one leaves the others standing."""
    parts, failed = [], {}
    for name, build in sources.items():
        try:
            rows = build().select(F.col("series_id").cast("string"), F.col("date").cast("date"), F.lit(name).alias("name"), F.col("value").cast("double"))
            rows.schema  # noqa: B018 (analyses the plan)
            parts.append(rows)
        except (PySparkException, OSError, KeyError, ValueError) as e:
            failed[name] = f"{type(e).__name__}: {str(e).splitlines()[0] if str(e) else ''}"
    return (reduce(DataFrame.unionByName, parts) if parts else None), failed


def panel(long: DataFrame, names: list[str], limit: int = 5) -> DataFrame:
    """(series_id, date, name, value) to one column for each name, each filled forward over at most `limit` rows.

    Of several values of a name and day the largest stays; a day is there if any name has it. The pivot is one aggregation, whatever
    the number of names.
    """
    wide = long.where(F.col("name").isin(names)).groupBy("series_id", "date").pivot("name", names).agg(F.max("value"))
    return wide.withColumns({n: ffill(F.col(f"`{n}`"), limit) for n in names})


def market(bars: DataFrame, tickers: dict[str, str], detailed: list[str] = (), returned: list[str] = ()) -> DataFrame:
    """Bars by ticker (series_id) to one row a day: the close of each ticker under its name, high, low and volume of those in
    `detailed`, and the change from the ticker's own last bar of those in `returned`."""
    some = bars.where(F.col("series_id").isin(list(tickers))).withColumn("return", F.try_divide("close", shift("close", 1)) - 1)
    one = lambda ticker, c: F.max(F.when(F.col("series_id") == ticker, F.col(c)))
    columns = []
    for ticker, name in tickers.items():
        columns.append(one(ticker, "close").alias(name))
        if name in detailed:
            columns += [one(ticker, c).alias(f"{name}_{c}") for c in ("high", "low", "volume")]
        if name in returned:
            columns.append(one(ticker, "return").alias(f"{name}_return"))
    return some.groupBy("date").agg(*columns)


def concat(frames: list[DataFrame], keys: list[str]) -> DataFrame:
    """Full outer join by key that allows a name in several frames: the second one becomes name_2, the third name_3."""
    seen: dict[str, int] = {}
    parts = []
    for f in frames:
        again = {}
        for c in f.columns:
            if c not in keys:
                seen[c] = seen.get(c, 0) + 1
                if seen[c] > 1:
                    again[c] = f"{c}_{seen[c]}"
        parts.append(f.withColumnsRenamed(again))
    return reduce(lambda a, b: a.join(b, keys, "full"), parts)


def missing_columns(df: DataFrame, required: list[str]) -> list[str]:
    """Required columns that a source does not have, in their order."""
    return [c for c in required if c not in df.columns]
