"""Cleaning and aligning: fills, winsorizing, range clips, value de-duplication, standardizing, joins by date."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidegauge.functions.quantiles import quantiles
from tidegauge.functions.windows import by_date, bfill, col, ffill, pad


def fill(df: DataFrame, xs: list[str]) -> DataFrame:
    """Forward without limit, then backward (which looks ahead)."""
    return df.withColumns({x: F.coalesce(pad(x), bfill(x)) for x in xs})


def winsorize(df: DataFrame, xs: list[str], k: float = 1.5) -> DataFrame:
    """Clip to the quartiles of the whole column widened by k interquartile ranges; one row of bounds is broadcast."""
    df = df.crossJoin(F.broadcast(quantiles(df, xs, [0.25, 0.75])))
    clip = {}
    for x in xs:
        q1, q3 = col(f"_q_{x}")[0], col(f"_q_{x}")[1]
        clip[x] = F.when(col(x).isNotNull(), F.least(F.greatest(col(x), q1 - k * (q3 - q1)), q3 + k * (q3 - q1)))
    return df.withColumns(clip).drop(*[f"_q_{x}" for x in xs])


def clip_ranges(df: DataFrame, ranges: dict[str, tuple[float, float]]) -> DataFrame:
    return df.withColumns({x: F.when(col(x) < lo, lo).when(col(x) > hi, hi).otherwise(col(x)) for x, (lo, hi) in ranges.items() if x in df.columns})


def drop_same_values(df: DataFrame, xs: list[str]) -> DataFrame:
    """Of the dates of a series with equal values the first stays."""
    first = Window.partitionBy("series_id", *xs).orderBy("date")
    return df.withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n")


def clean(df: DataFrame, xs: list[str], ranges: dict[str, tuple[float, float]] | None = None) -> DataFrame:
    df = winsorize(fill(df, xs), xs)
    return drop_same_values(clip_ranges(df, ranges or {}), xs)


def to_numbers(df: DataFrame, xs: list[str]) -> DataFrame:
    """Text to double; what does not parse is NULL."""
    return df.withColumns({x: F.col(x).try_cast("double") for x in xs})


def repair(df: DataFrame, issues: list[str], xs: list[str]) -> tuple[DataFrame, list[str]]:
    """Repairs by the words in issues: missing values are filled, outliers winsorized, duplicates dropped. Also what is left."""
    steps = {"missing": lambda d: fill(d, xs), "outlier": lambda d: winsorize(d, xs), "duplicate": lambda d: drop_same_values(d, xs)}
    wanted = dict.fromkeys(step for issue in issues for step in steps if step in issue.lower())
    left = [issue for issue in issues if not any(step in issue.lower() for step in steps)]
    for step in steps:
        df = steps[step](df) if step in wanted else df
    return df, left


def standardize(df: DataFrame, at: str, order: str, zone: str | None = None) -> DataFrame:
    """Dates from timestamps (of a zone, if named); of several rows a date the last by `order` stays."""
    when = F.from_utc_timestamp(at, zone) if zone else col(at)
    df = df.withColumn("date", F.to_date(when))
    last = Window.partitionBy("series_id", "date").orderBy(F.desc(order))
    return df.withColumn("_n", F.row_number().over(last)).where("_n = 1").drop("_n")


def fill_missing(df: DataFrame, xs: list[str], method: str = "forward_fill", limit: int = 5) -> DataFrame:
    if method == "forward_fill":
        return df.withColumns({x: ffill(x, limit) for x in xs})
    if method == "backward_fill":
        return df.withColumns({x: bfill(x, limit) for x in xs})
    if method == "drop":
        return df.na.drop("any", subset=xs)
    if method != "interpolate":
        raise ValueError(f"unknown method {method!r}")
    df = df.withColumn("_at", F.row_number().over(by_date()))
    there = {x: F.when(col(x).isNotNull(), col("_at")) for x in xs}
    df = df.withColumns({f"_p_{x}": F.last(there[x], True).over(by_date().rowsBetween(Window.unboundedPreceding, 0)) for x in xs} | {f"_n_{x}": F.first(there[x], True).over(by_date().rowsBetween(0, Window.unboundedFollowing)) for x in xs})
    out = {}
    for x in xs:
        before, after = pad(x), bfill(x)
        gap = col("_at") - col(f"_p_{x}")
        line = before + (after - before) * F.try_divide(gap, col(f"_n_{x}") - col(f"_p_{x}"))
        out[x] = F.when(col(x).isNotNull(), col(x)).when((gap >= 1) & (gap <= limit), F.coalesce(line, before))
    return df.withColumns(out).drop("_at", *[f"_p_{x}" for x in xs], *[f"_n_{x}" for x in xs])


def outer_join(frames: list[DataFrame], keys: list[str]) -> DataFrame:
    """Full outer join by key; columns of the same name in two frames are an error."""
    seen: set[str] = set()
    for f in frames:
        if twice := seen & (names := {c for c in f.columns if c not in keys}):
            raise ValueError(f"columns in more than one frame: {sorted(twice)}")
        seen |= names
    return reduce(lambda a, b: a.join(b, keys, "full"), frames)


def align(high: DataFrame, low: DataFrame, x: str, method: str = "ffill") -> DataFrame:
    """A low-frequency column on the dates of a high-frequency frame, filled within the span of its own dates."""
    span = low.groupBy("series_id").agg(F.min("date").alias("a"), F.max("date").alias("b"))
    days = span.select("series_id", F.explode(F.expr("sequence(a, b, interval 1 day)")).alias("date"))
    daily = days.join(low, ["series_id", "date"], "left")
    daily = daily.withColumn(x, pad(x) if method == "ffill" else bfill(x)) if method in ("ffill", "bfill") else fill_missing(daily, [x], "interpolate", 1 << 30)
    return high.join(daily.select("series_id", "date", x), ["series_id", "date"], "full")


def asof_join(left: DataFrame, right: DataFrame, x: list[str], by: str = "series_id", at: str = "date", tie: str | None = None,
              direction: str = "backward", tolerance: float | None = None) -> DataFrame:
    """left with columns x of the row of right that is next in time: the last at or before it (backward), the first at or
    after it (forward), or the nearer of both (nearest; the earlier of equally near ones). Beyond `tolerance` seconds: NULL.

    Both sides are stacked and the last right row is carried over the left ones by a window, so each row is shuffled once and
    nothing is made for the time between. `by` may be NULL, which is a key of its own; a NULL time meets nothing. Of right rows
    of one time the last by `tie` counts. Columns of right take the place of those of left with the same name.
    """
    if direction not in ("backward", "forward", "nearest"):
        raise ValueError(f"no such direction: {direction!r}")
    order = F.col(tie) if tie else F.lit(0)
    when = F.col(at).cast("timestamp").cast("double")
    found = F.when(when.isNotNull(), F.struct(when.alias("when"), *x))
    rows = left.select(F.col(by).alias("_by"), when.alias("_when"), F.struct(*left.columns).alias("_left"))
    rows = rows.unionByName(right.select(F.col(by).alias("_by"), when.alias("_when"), order.alias("_tie"), found.alias("_right")), allowMissingColumns=True)
    mine = F.col("_left").isNotNull()
    upto = (Window.unboundedPreceding, 0)
    # Right rows stand before left ones of the same time, in either direction; those of one time by tie.
    after = Window.partitionBy("_by").orderBy("_when", mine, "_tie").rowsBetween(*upto)
    ahead = Window.partitionBy("_by").orderBy(F.desc("_when"), mine, "_tie").rowsBetween(*upto)
    near = lambda w: F.when(F.col("_when").isNotNull(), F.last("_right", ignorenulls=True).over(w))
    if direction == "nearest":
        rows = rows.withColumns({"_a": near(after), "_b": near(ahead)})
        nearer = F.col("_b.when") - F.col("_when") < F.col("_when") - F.col("_a.when")
        rows = rows.withColumn("_right", F.when(F.col("_a").isNull() | nearer, F.coalesce("_b", "_a")).otherwise(F.col("_a")))
    else:
        rows = rows.withColumn("_right", near(after if direction == "backward" else ahead))
    if tolerance is not None:
        rows = rows.withColumn("_right", F.when(F.abs(F.col("_right.when") - F.col("_when")) <= tolerance, F.col("_right")))
    return rows.where(mine).select(*[F.col("_left")[c].alias(c) for c in left.columns if c not in x], *[F.col("_right")[c].alias(c) for c in x])
