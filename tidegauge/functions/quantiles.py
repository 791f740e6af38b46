"""Exact quantiles of whole columns without gathering a column's values in one task."""

from __future__ import annotations

from functools import reduce
from operator import add, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidegauge.functions.windows import col


def quantiles(df: DataFrame, xs: list[str], qs: list[float], accuracy: int = 100_000) -> DataFrame:
    """One row with an array `_q_{x}` for each column: its linearly interpolated quantiles, NULLs left out (all NULL: NULL).

    A mergeable sketch brackets each quantile within 2 / accuracy of all ranks. Values within a bracket are counted one by one,
    those between two brackets together (count, smallest, largest), so what is sorted for a column is a share of about
    4 * len(qs) / accuracy of its values and a few rows more; the ranks picked there are exact.
    """
    cells = df.select(F.explode(F.array(*[F.struct(F.lit(i).alias("x"), col(x).cast("double").alias("v")) for i, x in enumerate(xs)])).alias("c")).select("c.*").where("v is not null")
    k, slack = len(qs), 2 / accuracy
    marks = [max(0.0, q - slack) for q in qs] + [min(1.0, q + slack) for q in qs]
    about = cells.groupBy("x").agg(F.count("*").alias("n"), F.percentile_approx("v", marks, accuracy).alias("m"))
    v, m = F.col("v"), F.col("m")
    inside = reduce(or_, [v.between(m[i], m[k + i]) for i in range(k)])
    segment = reduce(add, [(m[i] < v).cast("int") for i in range(2 * k)])
    runs = cells.join(F.broadcast(about), "x").groupBy("x", "n", F.when(inside, v).alias("own"), F.when(~inside, segment).alias("segment"))
    runs = runs.agg(F.count("*").alias("c"), F.min("v").alias("a"), F.max("v").alias("b"))
    upto = F.sum("c").over(Window.partitionBy("x").orderBy("a").rowsBetween(Window.unboundedPreceding, 0))
    runs = runs.withColumn("last", upto - 1).withColumn("first", F.col("last") - F.col("c") + 1)

    def at(rank: Column) -> Column:
        value = F.when((F.col("a") == F.col("b")) | (rank == F.col("first")), F.col("a")).when(rank == F.col("last"), F.col("b"))
        return F.max(F.when(rank.between(F.col("first"), F.col("last")), value.otherwise(F.raise_error(F.lit("a quantile lies outside its bracket")).cast("double"))))

    places = [F.lit(q) * (F.col("n") - 1) for q in qs]
    ends = [end for p in places for end in (at(F.floor(p)), at(F.ceil(p)))]
    found = runs.groupBy("x", "n").agg(*[e.alias(f"e{i}") for i, e in enumerate(ends)])

    def between(i: int) -> Column:
        low, high, p = F.col(f"e{2 * i}"), F.col(f"e{2 * i + 1}"), places[i]
        return F.when(low == high, low).otherwise((F.ceil(p) - p) * low + (p - F.floor(p)) * high)

    found = found.select("x", F.array(*[between(i) for i in range(k)]).alias("q"))
    return found.agg(*[F.max(F.when(F.col("x") == i, F.col("q"))).alias(f"_q_{x}") for i, x in enumerate(xs)])
