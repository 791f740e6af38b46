"""Connected components of an edge table by alternating large-star and small-star steps; of a small one, in one task.

Cases: loops and repeated edges count once; edges that hold a null are left out; no edges, or only loops, give no rows; a hub
with any number of neighbours is pre-aggregated; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.common import batches, forget, rows_of, stored

#: Edges that one task walks at once (some 30 MB); more are walked by all tasks, in rounds.
FEW_EDGES = 1 << 17


def _walk(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All of a few edges (u, v) to (node, root), roots being the smallest nodes."""
    up: dict[int, int] = {}

    def top(x: int) -> int:
        while (above := up.get(x, x)) != x:
            up[x] = up.get(above, above)
            x = above
        return x

    for u, v in rows_of(stream):
        a, b = top(u), top(v)
        if a != b:
            up[max(a, b)] = min(a, b)
    yield from batches(((x, top(x)) for x in list(up)), pa.schema([("node", pa.int64()), ("root", pa.int64())]))


def _smallest(pairs: DataFrame, label: str) -> DataFrame:
    return stored(pairs.groupBy("u").agg(F.least("u", F.min("v")).alias("m")), label)


def _settled(edges: DataFrame) -> bool:
    """Whether edges (u > v) are stars round their smallest nodes: no u has two edges, no v is a u."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(edges.select("v", F.lit(0), F.lit(1)))
    of_node = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return of_node.where("up > 1 or (up > 0 and down > 0)").isEmpty()


def _named(edges: DataFrame, roots: DataFrame) -> DataFrame:
    """Both ends of each edge by the roots of their components."""
    for end in ("u", "v"):
        name = roots.select(F.col("node").alias(end), F.col("root").alias("_root"))
        edges = edges.join(name, end, "left").withColumn(end, F.coalesce("_root", end)).drop("_root")
    return edges


def components(edges: DataFrame, roots: DataFrame | None = None, rounds: int = 60, few_edges: int = FEW_EDGES) -> DataFrame:
    """edges (u long, v long) -> (node long, root long); root is the smallest node reachable.

    A row for every node that has a smaller one in its component; roots and lone nodes have none. `roots` is an earlier
    result: the edges are then added to its components, and only a graph of these components is walked. The smallest
    neighbour of each node is aggregated before the shuffle and stored, so the join on a hub is between two plain exchanges
    and can be split at run time. Steps go on until all components are stars (a logarithmic number of rounds); `rounds` only
    guards against a fault.
    """
    edges = edges.select("u", "v")
    edges = (_named(edges, roots) if roots is not None else edges).where("u <> v")
    now = stored(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    few = now.count() <= few_edges
    for _ in range(0 if few else rounds):
        if _settled(now):
            break
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = _smallest(both, "large")
        large = stored(both.where("v > u").join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large-star")
        low = _smallest(large, "small")
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b")).union(low.select(F.col("u").alias("a"), F.col("m").alias("b")))
        after = stored(small.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
        for old in (now, least, large, low):
            forget(old)
        now = after
    else:
        if not few:
            raise RuntimeError(f"components did not settle in {rounds} rounds")
    found = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    if few:
        found = stored(found.coalesce(1).mapInArrow(_walk, "node long, root long"), "walked")
        forget(now)
    if roots is None:
        return found
    moved = found.select(F.col("node").alias("root"), F.col("root").alias("_to"))
    older = roots.join(moved, "root", "left").select("node", F.coalesce("_to", "root").alias("root"))
    return stored(older.union(found), "roots")
