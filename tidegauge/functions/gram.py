"""Correlations of hundreds of columns: pairwise-complete Gram sums in Arrow passes, merged block by block."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Columns of a block; a block's sums are six matrices of BLOCK rows.
BLOCK = 64


def _sums(x: np.ndarray, mine: slice) -> np.ndarray:
    """For the columns `mine` against all: how often both are there, sums of either, sums of the squares of either, and of products."""
    there = (~np.isnan(x)).astype(float)
    v = np.where(there > 0, x, 0.0)
    a, b = v[:, mine], there[:, mine]
    return np.stack([b.T @ there, a.T @ there, b.T @ v, (a * a).T @ there, b.T @ (v * v), a.T @ v])


def pairwise_correlations(df: DataFrame, xs: list[str], block: int = BLOCK) -> DataFrame:
    """(a, b, corr) of every pair of columns, over the rows where both are there; NULL where either is constant on them.

    Each task adds up one set of sums for each block of columns, whatever its rows, and sends it once; a block's sums are added
    one after the other. Values are taken from the columns' means, so that little cancels.
    """
    p, spark = len(xs), df.sparkSession
    means = df.agg(*[F.avg(F.col(x).cast("double")).alias(f"m{k}") for k, x in enumerate(xs)]).first()
    centre = np.array([m if m is not None and np.isfinite(m) else 0.0 for m in means])
    blocks = [slice(at, min(at + block, p)) for at in range(0, p, block)]

    def add(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: list = [None] * len(blocks)
        for b in stream:
            if b.num_rows:
                x = np.column_stack([c.to_numpy(zero_copy_only=False).astype(float) for c in b.columns]) - centre
                for k, mine in enumerate(blocks):
                    own = _sums(x, mine)
                    total[k] = own if total[k] is None else total[k] + own
        for k, sums in enumerate(total):
            if sums is not None:
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([sums.tobytes()], pa.binary())], ["block", "sums"])

    def merge(key: tuple[pa.Scalar, ...], stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = blocks[key[0].as_py()]
        total = np.zeros((6, mine.stop - mine.start, p))
        for b in stream:
            for raw in b.column(b.schema.get_field_index("sums")):
                total += np.frombuffer(raw.as_py(), float).reshape(total.shape)
        n, sa, sb, qa, qb, ab = total
        with np.errstate(divide="ignore", invalid="ignore"):
            var = np.maximum(qa / n - (sa / n) ** 2, 0) * np.maximum(qb / n - (sb / n) ** 2, 0)
            corr = np.where((n >= 2) & (np.sqrt(var) > 1e-12), (ab / n - sa * sb / n / n) / np.sqrt(var), np.nan)
        i, j = np.nonzero(np.arange(mine.start, mine.stop)[:, None] < np.arange(p)[None, :])
        yield pa.RecordBatch.from_arrays([pa.array((i + mine.start).astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(corr[i, j], from_pandas=True)], ["i", "j", "corr"])

    if p < 2:
        return spark.createDataFrame([], "a string, b string, corr double")
    sums = df.select(*[F.col(x).cast("double").alias(f"c{k}") for k, x in enumerate(xs)]).mapInArrow(add, "block int, sums binary")
    found = sums.groupBy("block").applyInArrow(merge, "i int, j int, corr double")
    name = F.array(*[F.lit(x) for x in xs])
    return found.select(F.element_at(name, F.col("i") + 1).alias("a"), F.element_at(name, F.col("j") + 1).alias("b"), "corr")
