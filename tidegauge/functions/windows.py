"""Ordered-window vocabulary: guarded rolling values, padded changes, fills, crossings and recursive smoothing.

Windows go over one series in date order. Missing is NULL, never NaN. Helpers that look back a bounded number of rows are
Columns; what depends on all rows before (carried values, sums, recursive means) takes a frame and gives one.

A long series need not be one task. by_blocks() numbers the rows of each series, cuts them into blocks of `size` rows and builds the
same families on those: stage() gives each block a copy of the rows that its frames look back (or ahead) to, and running()
adds what the blocks before amount to, from one row of totals for each block. Without by_blocks() both are plain windows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Rows of a block while series are split, else None; and the columns that windows are partitioned by (None: between stages).
_size: ContextVar[int | None] = ContextVar("block size", default=None)
_keys: ContextVar[tuple[str, ...] | None] = ContextVar("window keys", default=("series_id",))


def by_date():
    """The window of all helpers: each series, or each block of one, in date order."""
    keys = _keys.get()
    if keys is None:
        raise RuntimeError("while series are split into blocks, windows belong in a stage()")
    return Window.partitionBy(*keys).orderBy("date")


def window_keys() -> tuple[str, ...]:
    by_date()
    return _keys.get()


@contextmanager
def _set(var: ContextVar, value) -> Iterator[None]:
    token = var.set(value)
    try:
        yield
    finally:
        var.reset(token)


def _whole(what: str) -> None:
    if _size.get() is not None:
        raise RuntimeError(f"{what} needs all rows before: while series are split into blocks, use running()")


def _beside(df: DataFrame, other: DataFrame, keys: dict[str, str]) -> DataFrame:
    """df and the row of `other` with the same keys {df's: other's}, of which NULL is one; other's keys go."""
    on = [df[a].eqNullSafe(other[b]) for a, b in keys.items()]
    return df.join(other, on, "left").drop(*[other[b] for b in keys.values()])


def stage(df: DataFrame, back: int, build: Callable[[DataFrame], DataFrame], ahead: int = 0) -> DataFrame:
    """build(df), whose windows see at most `back` rows before and `ahead` rows after each row.

    While series are split, the rows at the edges of a block are copied to the blocks that see them, and go again afterwards.
    """
    size = _size.get()
    if size is None:
        return build(df)
    at = F.col("_rn")
    first, last = F.floor(F.greatest(at - ahead, F.lit(0)) / size), F.floor((at + back) / size)
    with _set(_keys, ("series_id", "_to")):
        out = build(df.withColumn("_to", F.explode(F.sequence(first, last))))
    return out.where("_to = _block").drop("_to")


_up_to, _before = (Window.unboundedPreceding, 0), (Window.unboundedPreceding, -1)
#: How running() goes on: within a window, and from the total of a window so far (NULL: none) and what came before it.
_RUNNING = {
    "sum": (F.sum, _up_to, lambda own, carry: F.coalesce(own + carry, own, carry)),
    "count": (F.count, _up_to, lambda own, carry: own + F.coalesce(carry, F.lit(0))),
    "last": (lambda x: F.last(x, True), _up_to, lambda own, carry: F.coalesce(own, carry)),
    "last_before": (lambda x: F.last(x, True), _before, lambda own, carry: F.coalesce(own, carry)),
    "first": (lambda x: F.first(x, True), _up_to, lambda own, carry: F.coalesce(carry, own)),
}


def _together(how: str, block: str, total: str, over) -> Column:
    """The totals of several blocks as one; NULL where there are none."""
    if how in ("sum", "count"):
        return F.sum(total).over(over)
    pick = F.min if how == "first" else F.max
    return pick(F.when(F.col(total).isNotNull(), F.struct(block, F.col(total).alias("x")))).over(over)["x"]


def running(df: DataFrame, wanted: dict[str, tuple[str, str | Column]]) -> DataFrame:
    """Columns {out: (how, column)} over all rows up to each one: sum, count, last or first value that is there; last_before
    leaves the row itself out.

    While series are split, the last row of a block sends its totals to all later blocks of its series: n / size rows for each of
    n / size blocks, so n / (2 * size * size) for each row there is.
    """
    over = lambda how, x, frame: _RUNNING[how][0](col(x)).over(by_date().rowsBetween(*frame))
    own = lambda: {out: over(how, x, _RUNNING[how][1]) for out, (how, x) in wanted.items()}
    if _size.get() is None:
        return df.withColumns(own())
    if _keys.get() is not None:
        raise RuntimeError("running() goes over whole blocks: it cannot stand in a stage()")
    with _set(_keys, ("series_id", "_block")):
        totals = {f"_total_{out}": over(how, x, _up_to) for out, (how, x) in wanted.items()}
        df = df.withColumns(own() | totals | {"_end": F.lead(F.lit(1)).over(by_date()).isNull()})
    block, later = F.col("_block"), F.col("_blocks") - 1
    sent = F.when(F.col("_end") & (block < later), F.sequence(block + 1, later)).otherwise(F.array().cast("array<bigint>"))
    df = df.withColumn("_to", F.explode(F.concat(F.array(block), sent)))
    message = F.col("_to") != block
    df = df.withColumns({f"_total_{out}": F.when(message, F.col(f"_total_{out}")) for out in wanted})
    there = Window.partitionBy("series_id", "_to")
    df = df.withColumns({f"_carry_{out}": _together(how, "_block", f"_total_{out}", there) for out, (how, _) in wanted.items()})
    both = {out: _RUNNING[how][2](F.col(out), F.col(f"_carry_{out}")) for out, (how, _) in wanted.items()}
    return df.where(~message).withColumns(both).drop("_end", "_to", *[f"_{k}_{out}" for k in ("total", "carry") for out in wanted])


def padded(df: DataFrame, wanted: dict[str, str | Column]) -> DataFrame:
    """{out: column} with missing values carried forward."""
    return running(df, {out: ("last", x) for out, x in wanted.items()})


def _numbered(df: DataFrame) -> DataFrame:
    """Adds _at, the row's number in its series."""
    return df.withColumn("_at", F.row_number().over(by_date()) if _size.get() is None else F.col("_rn") + 1)


def blocks(df: DataFrame, size: int) -> DataFrame:
    """Adds _rn, the row's number in its series from 0, and _block, `size` rows each, without sorting a series in one task.

    Rows fall into stretches of time of equal length, about `size` rows each if they come evenly; within a stretch they are
    numbered by a window, and the stretches before are counted.
    """
    at = F.col("date").cast("timestamp").cast("double")
    of_series = df.groupBy("series_id").agg(F.count("*").alias("_n"), F.min(at).alias("_from"), F.max(at).alias("_to"))
    df = _beside(df, of_series.withColumnRenamed("series_id", "_s"), {"series_id": "_s"})
    stretches = F.ceil(F.col("_n") / size)
    place = F.floor(F.try_divide(at - F.col("_from"), F.col("_to") - F.col("_from")) * stretches)
    df = df.withColumn("_stretch", F.coalesce(F.least(place, stretches - 1), F.lit(0)))
    df = df.withColumn("_blocks", stretches).drop("_n", "_from", "_to")
    before = Window.partitionBy("series_id").orderBy("_stretch").rowsBetween(*_before)
    counts = df.groupBy("series_id", "_stretch").agg(F.count("*").alias("_n"))
    counts = counts.select(F.col("series_id").alias("_s"), F.col("_stretch").alias("_t"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    df = _beside(df, counts, {"series_id": "_s", "_stretch": "_t"})
    within = F.row_number().over(Window.partitionBy("series_id", "_stretch").orderBy("date"))
    df = df.withColumn("_rn", F.col("_offset") + within - 1).drop("_stretch", "_offset")
    return df.withColumn("_block", F.floor(F.col("_rn") / size))


def by_blocks(df: DataFrame, family: Callable[[DataFrame], DataFrame], size: int = 1 << 16) -> DataFrame:
    """family(df) with every series cut into blocks of `size` rows, which are separate groups of rows for Spark.

    The result is that of family(df), but for the last bits of running sums. It takes one shuffle for each stage where family(df)
    takes one in all, so it is for series that are too long for a task. A family that looks beyond its stages is an error.
    """
    if size < 1:
        raise ValueError("a block holds at least one row")
    df = blocks(df, size)
    with _set(_size, size), _set(_keys, None):
        return family(df).drop("_rn", "_block", "_blocks")


def col(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def rows(n: int):
    return by_date().rowsBetween(-(n - 1), 0)


def roll(f, x, n: int, least: int | None = None) -> Column:
    """f over the last n rows, NULL until `least` (n) of them are not null."""
    x = col(x)
    return F.when(F.count(x).over(rows(n)) >= (n if least is None else least), f(x).over(rows(n)))


def shift(x, k: int) -> Column:
    return F.lag(col(x), k).over(by_date()) if k >= 0 else F.lead(col(x), -k).over(by_date())


def diff(x, k: int = 1) -> Column:
    return col(x) - shift(x, k)


def pad(x) -> Column:
    _whole("pad")
    return F.last(col(x), ignorenulls=True).over(by_date().rowsBetween(Window.unboundedPreceding, 0))


def ffill(x, limit: int) -> Column:
    return F.last(col(x), ignorenulls=True).over(by_date().rowsBetween(-limit, 0))


def bfill(x, limit: int | None = None) -> Column:
    if limit is None:
        _whole("bfill without a limit")
    return F.first(col(x), ignorenulls=True).over(by_date().rowsBetween(0, Window.unboundedFollowing if limit is None else limit))


def flag(c: Column) -> Column:
    return F.coalesce(c, F.lit(False)).cast("int")


def ratio(a, b) -> Column:
    return F.try_divide(col(a), col(b))


def pct(padded, k: int = 1) -> Column:
    """Change over k rows of a column already padded with pad()."""
    return ratio(padded, shift(padded, k)) - 1


def cross_up(a, b) -> Column:
    return flag((col(a) > col(b)) & (shift(a, 1) <= shift(b, 1)))


def cross_down(a, b) -> Column:
    return flag((col(a) < col(b)) & (shift(a, 1) >= shift(b, 1)))


def scorr(a, b, over=None, least: int = 2) -> Column:
    """Pearson correlation of complete pairs, NULL on a constant side; over a frame or as an aggregate."""
    both = col(a).isNotNull() & col(b).isNotNull()
    x, y = F.when(both, col(a)), F.when(both, col(b))
    at = (lambda c: c.over(over)) if over is not None else (lambda c: c)
    spread = at(F.stddev_pop(x)) * at(F.stddev_pop(y))
    return F.when(at(F.count(x)) >= least, F.try_divide(at(F.covar_pop(x, y)), F.when(spread > 1e-12, spread)))


#: Recursions run in spells over which a value decays by e ** -SPELL; what is older than a spell and a bit is below 1e-21.
#: Means whose decays differ by at most ALIKE share their spells, those of the fastest.
SPELL, MOST_DECAY, ALIKE = 200.0, 100.0, 4.0


def _carried(df: DataFrame, spells: dict[str, str], ends: list[tuple[str, str]]) -> DataFrame:
    """Adds carry columns [(column, carry)]: the column's value in the last row of the spell before, else 0. spells: {column: its
    spell's number}, which rises by one from spell to spell."""
    if _size.get() is None:
        df = df.withColumns({f"_end_{c}": F.when(F.lead(spells[c]).over(by_date()) != F.col(spells[c]), F.col(c)) for c, _ in ends})
        before = by_date().rowsBetween(*_before)
        carry = {name: F.coalesce(F.last(f"_end_{c}", True).over(before), F.lit(0.0)) for c, name in ends}
        return df.withColumns(carry).drop(*[f"_end_{c}" for c, _ in ends])
    for spell in dict.fromkeys(spells.values()):
        mine = {name: c for c, name in ends if spells[c] == spell}
        at = F.col(spell)
        end = F.lead(F.lit(1)).over(Window.partitionBy("series_id", spell).orderBy("date")).isNull()
        df = df.withColumn("_end", end).withColumn("_to", F.explode(F.when(F.col("_end"), F.array(at, at + 1)).otherwise(F.array(at))))
        message, there = F.col("_to") != at, Window.partitionBy("series_id", "_to")
        df = df.withColumns({name: F.coalesce(F.max(F.when(message, F.col(c))).over(there), F.lit(0.0)) for name, c in mine.items()})
        df = df.where(~message).drop("_end", "_to")
    return df


def _spells(wanted: list[tuple[str, float]], alike: bool) -> list[int]:
    """For each (column, alpha) whose spells it takes: those of the fastest mean of the same column (alike: of any) that is not too fast."""
    out: list[int] = []
    decay = [-math.log1p(-a) if a < 1 else math.inf for _, a in wanted]
    order = sorted(range(len(wanted)), key=lambda k: -decay[k])
    leaders: list[int] = []
    chosen = {}
    for k in order:
        fits = [m for m in leaders if (alike or wanted[m][0] == wanted[k][0]) and decay[m] <= ALIKE * decay[k]]
        chosen[k] = fits[0] if fits else k
        leaders += [] if fits else [k]
    out = [chosen[k] for k in range(len(wanted))]
    return out


def smooth(df: DataFrame, wanted: dict[str, tuple[str, float]], ages: bool = True, alike: bool = False) -> DataFrame:
    """Recursive means {out: (column, alpha)}: avg = r * avg + (1 - r) * x with r = w / (w + alpha), w = (1 - alpha) ** rows
    since the last value (`ages`; otherwise nulls don't count). A null row shows the mean so far. `alike`: the columns are
    null in the same rows, but for a few at the start.

    The recursion is solved by running sums: within a spell of rows, avg = exp(L) * sum((1 - r) * x * exp(-L)), L being the
    running sum of log r; the mean at the end of the spell before comes in with exp(L). Each row costs the same however
    long the series is, and nothing is folded row by row.
    """
    xs = list(dict.fromkeys(x for x, _ in wanted.values()))
    df = _numbered(df)
    there = {x: F.when(col(x).isNotNull(), col("_at")) for x in xs}
    df = running(df, {f"_last_{x}": ("last_before", there[x]) for x in xs} | {f"_n_{x}": ("count", x) for x in xs})
    step, weight = {}, {}
    for k, (x, a) in enumerate(wanted.values()):
        w = F.pow(F.lit(1 - a), (col("_at") - col(f"_last_{x}")) if ages else F.lit(1))
        later = col(x).isNotNull() & col(f"_last_{x}").isNotNull()
        step[f"_step{k}"] = F.when(later, F.greatest(F.ln(w / (w + a)), F.lit(-MOST_DECAY))).otherwise(0.0)
        weight[f"_w{k}"] = F.when(later, a / (w + a)).when(col(x).isNotNull(), 1.0).otherwise(0.0)
    df = df.withColumns(step | weight)
    of = _spells(list(wanted.values()), alike)
    df = running(df, {f"_spell{m}": ("sum", f"_step{m}") for m in dict.fromkeys(of)})
    df = df.withColumns({f"_spell{m}": F.floor(-col(f"_spell{m}") / SPELL) for m in dict.fromkeys(of)})
    for m in dict.fromkeys(of):
        inside = Window.partitionBy("series_id", f"_spell{m}").orderBy("date").rowsBetween(*_up_to)
        mine = [k for k in range(len(of)) if of[k] == m]
        df = df.withColumns({f"_l{k}": F.sum(f"_step{k}").over(inside) for k in mine})
        value = {k: F.coalesce(col(f"_w{k}") * col(x), F.lit(0.0)) * F.exp(-col(f"_l{k}")) for k, (x, _) in enumerate(wanted.values()) if k in mine}
        df = df.withColumns({f"_s{k}": F.exp(f"_l{k}") * F.sum(value[k]).over(inside) for k in mine})
    df = _carried(df, {f"_s{k}": f"_spell{of[k]}" for k in range(len(of))}, [(f"_s{k}", f"_c{k}") for k in range(len(of))])
    mean = {k: col(f"_s{k}") + F.exp(f"_l{k}") * col(f"_c{k}") for k in range(len(of))}
    df = df.withColumns({out: F.when(col(f"_n_{x}") > 0, mean[k]) for k, (out, (x, _)) in enumerate(wanted.items())})
    own = [f"_{t}{k}" for t in ("step", "w", "spell", "l", "s", "c") for k in range(len(of))]
    return df.drop("_at", *[f"_{t}_{x}" for t in ("last", "n") for x in xs], *own)


def ewm(df: DataFrame, wanted: dict[str, tuple[str, float]], alike: bool = False) -> DataFrame:
    """Recursive means {out: (column, span)} with alpha = 2 / (span + 1); a null only ages the state."""
    return smooth(df, {out: (x, 2 / (span + 1)) for out, (x, span) in wanted.items()}, alike=alike)


def wilder(df: DataFrame, wanted: dict[str, str], p: int, alike: bool = False) -> DataFrame:
    """{out: column} smoothed by s = (s * (p - 1) + x) / p from the mean of the first p values; NULL where x is."""
    xs = wanted.values()
    df = running(df, {f"_n_{x}": ("count", x) for x in xs} | {f"_t_{x}": ("sum", x) for x in xs})
    seed = {x: F.when((col(f"_n_{x}") == p) & col(x).isNotNull(), col(f"_t_{x}") / p) for x in xs}
    df = df.withColumns({f"_z_{x}": F.when(col(f"_n_{x}") > p, col(x)).otherwise(seed[x]) for x in xs})
    df = df.drop(*[f"_{t}_{x}" for t in ("n", "t") for x in xs])
    df = smooth(df, {out: (f"_z_{x}", 1 / p) for out, x in wanted.items()}, ages=False, alike=alike)
    return df.withColumns({out: F.when(col(x).isNotNull(), col(out)) for out, x in wanted.items()}).drop(*[f"_z_{x}" for x in xs])


def ewm_std(df: DataFrame, out: str, x: str, span: float) -> DataFrame:
    """Bias-corrected standard deviation with weights (1 - alpha) ** age over the values that are there.

    Running sums of the weights, their squares, the values and their squares, spell by spell as in smooth(); values
    are taken from the first of the series, so that little cancels.
    """
    keep = 1 - 2 / (span + 1)
    size = max(1, int(SPELL / -math.log(keep)))
    df = running(_numbered(df), {"_v": ("first", x), "_n": ("count", x)})
    df = df.withColumns({"_at": col("_at") - 1, "_v": col(x) - col("_v")})
    df = df.withColumns({"_spell": F.floor(col("_at") / size), "_age": F.pmod("_at", F.lit(size))})
    inside = Window.partitionBy("series_id", "_spell").orderBy("date").rowsBetween(*_up_to)
    parts = {"_w": (1, F.lit(1.0)), "_q": (2, F.lit(1.0)), "_b": (1, col("_v")), "_d": (1, col("_v") * col("_v"))}
    decay = lambda power, age: F.exp(age * (power * math.log(keep)))
    of_value = {c: F.when(col(x).isNotNull(), v * decay(k, -col("_age"))).otherwise(0.0) for c, (k, v) in parts.items()}
    df = df.withColumns({c: decay(k, col("_age")) * F.sum(of_value[c]).over(inside) for c, (k, _) in parts.items()})
    df = _carried(df, dict.fromkeys(parts, "_spell"), [(c, f"_carry{c}") for c in parts])
    df = df.withColumns({c: col(c) + decay(k, col("_age") + 1) * col(f"_carry{c}") for c, (k, _) in parts.items()})
    mean = ratio("_b", "_w")
    spread = F.greatest(ratio("_d", "_w") - mean * mean, F.lit(0.0))
    free = col("_w") * col("_w") - col("_q")
    now = F.when(col(x).isNotNull() & (col("_n") > 1) & (free > 1e-14 * col("_w") * col("_w")), F.sqrt(spread * col("_w") * col("_w") / free))
    # Nulls age all weights alike, which changes nothing: their rows show what the last value's row does.
    at_value = F.struct(F.when(col(x).isNotNull(), F.lit(1)).alias("there"), now.alias("sd"))
    df = running(df.withColumn("_sd", F.when(col(x).isNotNull(), at_value)), {"_sd": ("last", "_sd")}).withColumn(out, F.col("_sd.sd"))
    return df.drop("_sd", "_at", "_v", "_n", "_spell", "_age", *parts, *[f"_carry{c}" for c in parts])


def wma(x, n: int) -> Column:
    """Linearly weighted mean, NULL if any of the n values is."""
    return sum((shift(x, k) * (n - k) for k in range(1, n)), col(x) * n) / (n * (n + 1) / 2)


def hull(df, x: str, n: int, name: str):
    """Hull's moving average; one stage sees n + sqrt(n) rows back."""
    half = df.withColumn("_hull", 2 * wma(x, n // 2) - wma(x, n))
    return half.withColumn(name, roll(F.avg, "_hull", int(math.sqrt(n)))).drop("_hull")
