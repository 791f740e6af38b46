"""Tail probabilities as Columns: the gamma and beta functions that Spark lacks, and Student's t."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def ln_gamma(x: Column) -> Column:
    """Logarithm of the gamma function of x > 0: Stirling's series at x + 8, and the recurrence back to x."""
    y = x + 8
    inverse = 1 / (y * y)
    # Bernoulli numbers over 2k (2k - 1): 1/12, -1/360, 1/1260, -1/1680, 1/1188.
    series = (1 / 12 + inverse * (-1 / 360 + inverse * (1 / 1260 + inverse * (-1 / 1680 + inverse / 1188)))) / y
    back = x
    for k in range(1, 8):
        back = back * (x + k)
    return (y - 0.5) * F.ln(y) - y + 0.5 * math.log(2 * math.pi) + series - F.ln(back)


def _fraction(x: Column, a: Column, b: Column, steps: int) -> Column:
    """The continued fraction of the incomplete beta function, from the front (modified Lentz); settled rows stay as they are."""
    tiny, one = F.lit(1e-300), F.lit(1.0)
    safe = lambda v: F.when(v == 0, tiny).otherwise(v)
    state = lambda c, d, h: F.struct(c.alias("c"), d.alias("d"), h.alias("h"))

    def step(s: Column, m: Column) -> Column:
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        # Inner lambdas stand for local names: each value is computed once.
        half = F.transform(F.array(s), lambda t: state(safe(1 + even / t["c"]), 1 / safe(1 + even * t["d"]), t["h"]))
        half = F.transform(half, lambda t: state(t["c"], t["d"], t["h"] * t["c"] * t["d"]))
        whole = F.transform(half, lambda t: state(safe(1 + odd / t["c"]), 1 / safe(1 + odd * t["d"]), t["h"]))
        whole = F.transform(whole, lambda t: state(t["c"], t["d"], t["h"] * t["c"] * t["d"]))
        return F.when(F.abs(s["c"] * s["d"] - 1) < 1e-16, s).otherwise(whole[0])

    first = 1 / safe(1 - (a + b) * x / (a + 1))
    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), state(one, first, first), step, lambda s: s["h"])


def beta_share(x: Column, a: Column, b: Column, steps: int = 300) -> Column:
    """Regularized incomplete beta function I_x(a, b) for 0 <= x <= 1. The fraction needs about sqrt(max(a, b)) steps."""
    front = F.exp(ln_gamma(a + b) - ln_gamma(a) - ln_gamma(b) + a * F.ln(x) + b * F.ln(1 - x))
    low = front * _fraction(x, a, b, steps) / a
    high = 1 - front * _fraction(1 - x, b, a, steps) / b
    return F.when(x <= 0, 0.0).when(x >= 1, 1.0).when(x < (a + 1) / (a + b + 2), low).otherwise(high)


def student_t_p(t: Column, df: Column) -> Column:
    """Two-sided probability of Student's t beyond |t|; NULL where t or df is, or df is not positive."""
    n = df.cast("double")
    return F.when(n > 0, beta_share(n / (n + t * t), n / 2, F.lit(0.5)))
