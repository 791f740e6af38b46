"""Rolling order statistics: ranks, quantiles and absolute deviations of the last n values, at the same cost for every n.

The values of a run of rows are put into a wavelet matrix: their ranks bit by bit, from the highest on, each level a stable partition of
the one before by its bit, with running counts of zeros and running sums of values. How many of the values in any stretch of rows are
below a given one, what they add up to, and which is the k-th smallest, is then read off in one step for each bit; all rows
and windows are read at once. Rows come through Arrow in batches, series by series in date order; the last rows of a batch
are kept for the next, so memory is bounded by a batch and the longest window.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tidegauge.functions.windows import by_date, window_keys


class Wavelet:
    """Order statistics of stretches of an array without NaN."""

    def __init__(self, values: np.ndarray):
        self.sorted, ranks = np.unique(values, return_inverse=True)
        self.bits = max(1, int(len(self.sorted) - 1).bit_length())
        self.zeros, self.sums = [], []  # at each level: zeros before each place; sums of the values as partitioned
        for bit in reversed(range(self.bits)):
            one = (ranks >> bit & 1).astype(bool)
            self.zeros.append(np.r_[0, np.cumsum(~one)])
            order = np.r_[np.flatnonzero(~one), np.flatnonzero(one)]
            ranks, values = ranks[order], values[order]
            self.sums.append(np.r_[0.0, np.cumsum(values)])

    def below(self, start: np.ndarray, end: np.ndarray, x: np.ndarray, or_equal: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """How many values in places start to end (without end) are below x, or at most x, and their sum."""
        target = np.searchsorted(self.sorted, x, "right" if or_equal else "left")
        all_ = target >= len(self.sorted)  # more than any: count everything
        target = np.minimum(target, len(self.sorted) - 1)
        left, right = start.copy(), end.copy()
        count, total = np.zeros(len(x), np.int64), np.zeros(len(x))
        whole_count, whole_sum = end - start, np.zeros(len(x))
        for level, (zeros, sums) in enumerate(zip(self.zeros, self.sums, strict=True)):
            one = (target >> (self.bits - 1 - level) & 1).astype(bool)
            low, high = zeros[left], zeros[right]
            # What goes to the zeros is smaller if the target goes to the ones.
            count += np.where(one, high - low, 0)
            total += np.where(one, sums[high] - sums[low], 0.0)
            if level == 0:
                ones = zeros[-1]
                whole_sum = sums[high] - sums[low] + sums[ones + end - high] - sums[ones + start - low]
            left, right = np.where(one, zeros[-1] + left - low, low), np.where(one, zeros[-1] + right - high, high)
        return np.where(all_, whole_count, count), np.where(all_, whole_sum, total)

    def sum(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return self.below(start, end, np.full(len(start), np.inf), True)[1]

    def smallest(self, start: np.ndarray, end: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The k-th smallest value (from 0) in places start to end."""
        left, right, k, rank = start.copy(), end.copy(), k.copy(), np.zeros(len(k), np.int64)
        for zeros in self.zeros:
            low, high = zeros[left], zeros[right]
            one = k >= high - low
            k -= np.where(one, high - low, 0)
            rank = 2 * rank + one
            left, right = np.where(one, zeros[-1] + left - low, low), np.where(one, zeros[-1] + right - high, high)
        return self.sorted[rank]


@dataclass(frozen=True)
class Rank:
    """Percentile rank of the row's value among the last n, 0 to 1: mean of the weak and the strict rank."""

    x: str
    n: int

    def of(self, tree: Wavelet, start, end, x, _) -> np.ndarray:
        low, upto = tree.below(start, end, x)[0], tree.below(start, end, x, True)[0]
        return (low + upto + 1) * 50.0 / self.n / 100


@dataclass(frozen=True)
class Quantile:
    """Linearly interpolated quantile of the last n values."""

    x: str
    n: int
    q: float

    def of(self, tree: Wavelet, start, end, x, _) -> np.ndarray:
        place = self.q * (self.n - 1)
        low, high = (np.full(len(start), int(f(place)), np.int64) for f in (np.floor, np.ceil))
        a, b = tree.smallest(start, end, low), tree.smallest(start, end, high)
        return np.where(a == b, a, (np.ceil(place) - place) * a + (place - np.floor(place)) * b)


@dataclass(frozen=True)
class Deviation:
    """Mean absolute deviation of the last n values from a column of the row."""

    x: str
    n: int
    centre: str

    def of(self, tree: Wavelet, start, end, _, centre) -> np.ndarray:
        count, total = tree.below(start, end, centre)
        # sum |v - c| = sum v - 2 * (sum of those below) + c * (2 * number below - n)
        return (tree.sum(start, end) - 2 * total + centre * (2 * count - self.n)) / self.n


Statistic = Rank | Quantile | Deviation


def _numbers(column: pa.ChunkedArray) -> np.ndarray:
    return column.cast(pa.float64()).to_numpy(zero_copy_only=False)


def with_order_stats(df: DataFrame, wanted: dict[str, Statistic]) -> DataFrame:
    """Adds {out: statistic} over the rows of each series in date order; NULL until n values in a row are there.

    Other columns pass through as Arrow data. The window that numbers the rows also deals and sorts them, so this adds no
    shuffle to a plan that has windows already.
    """
    keys = list(window_keys())
    df = df.withColumn("_place", F.row_number().over(by_date()))
    names = df.columns
    used = sorted({c for s in wanted.values() for c in (s.x, getattr(s, "centre", s.x))})
    back = max(s.n for s in wanted.values()) - 1

    def added(held: pa.Table, own: int) -> list[np.ndarray]:
        """The statistics of the rows from `own` on."""
        values = {c: _numbers(held[c]) for c in used}
        row = np.arange(own, held.num_rows)
        out = []
        ready: dict[str, tuple] = {}
        for s in wanted.values():
            if s.x not in ready:
                x = values[s.x]
                bad = np.isnan(x)
                shift = np.nanmean(x[np.isfinite(x)]) if np.isfinite(x).any() else 0.0  # keeps running sums small
                ready[s.x] = Wavelet(np.where(bad, 0.0, x - shift)), np.r_[0, np.cumsum(bad)], shift
            tree, missing, shift = ready[s.x]
            start, end = row - s.n + 1, row + 1
            full = start >= 0
            full[full] = missing[end[full]] == missing[start[full]]
            centre = values[getattr(s, "centre", s.x)][row]
            full &= ~np.isnan(centre)
            got = np.full(len(row), np.nan)
            if full.any():
                found = s.of(tree, start[full], end[full], values[s.x][row][full] - shift, centre[full] - shift)
                got[full] = found + shift if isinstance(s, Quantile) else found
            out.append(got)
        return out

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, last = None, 0
        for b in batches:
            if not b.num_rows:
                continue
            place = b.column(names.index("_place")).to_numpy()
            if place[0] != last + 1 or (np.diff(place) != 1).any():
                raise RuntimeError("rows of a series are out of order")
            last = int(place[-1])
            now = pa.Table.from_batches([b])
            own = 0 if held is None else held.num_rows
            held = now.select(used) if held is None else pa.concat_tables([held, now.select(used)])
            columns = [pa.array(v, from_pandas=True) for v in added(held, own)]
            yield pa.RecordBatch.from_arrays([*b.columns, *columns], [*names, *wanted])
            held = held.slice(max(0, held.num_rows - back)) if back else None

    schema = StructType([*df.schema.fields, *[StructField(out, DoubleType()) for out in wanted]])
    return df.groupBy(*keys).applyInArrow(go, schema).drop("_place")
