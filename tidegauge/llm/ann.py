"""Approximate nearest neighbours by a forest of random-projection trees.

The forest is fitted on a bounded sample (`sample` vectors, the first by hash of vec_id; a parameter): a node splits
by the hyperplane halfway between two of its sample vectors, at the median, `depth` levels deep. Every vector is then
dropped down every tree and dealt by (tree, leaf), and the vectors of each leaf are counted (one row for each leaf). A
query searches all trees through one shared priority queue, best bound first, until the leaves it has opened hold
`share` of the sampled vectors a tree and at least `k` + 1 vectors in one tree; so however small the table, k results are
found if there are that many candidates. The query is sent to these leaves, where inner products with all their vectors
are taken, and the best candidates are reranked by an exact double-precision product of the original vectors.

The largest inner product is not the least distance, by which trees bound, unless all vectors are of one length. So the forest
works on lifted vectors: with one component more, sqrt(M^2 - |x|^2), M being the longest length in the table, all
vectors have length M, and a query of length M with 0 there is nearest to those with the largest products.

Vectors and queries of a leaf meet in blocks of at most about `leaf_rows` and `query_rows`, so neither side of a group
grows with the table. Equal vectors are collapsed beforehand to their `k` + 1 smallest ids (no result can name another one
of them), and equal queries are searched once, for k + 1 results, from which each drops its own id.

Cases: vectors that are null, empty, zero or hold null or non-finite components take no part, nor do those of another
length than most have; ties go to the smaller vec_id; of several vectors of one id the smallest (component by component)
counts; with fewer candidates than k all of them are returned; an empty table gives an empty result; other columns are
not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tidegauge.llm.common import hash_sample, stored

K, TREES, DEPTH, SHARE, SAMPLE, SEED = 20, 4, 7, 0.3, 16384, 7
#: Vectors that a leaf holds on average before trees get shallower than DEPTH.
FEWEST = 16


def lifted(vectors: np.ndarray, longest: float, query: bool = False) -> np.ndarray:
    """Vectors of one length with the inner products of the given ones (queries: up to a factor)."""
    v = vectors.astype(np.float64)
    length = np.sqrt((v * v).sum(axis=1))
    if query:
        v, more = v * (longest / np.maximum(length, 1e-300))[:, None], np.zeros(len(v))
    else:
        more = np.sqrt(np.maximum(0.0, longest * longest - length * length))
    return np.c_[v, more]


class Forest:
    """Complete binary trees of hyperplanes; node i has children 2i + 1 and 2i + 2."""

    def __init__(self, sample: np.ndarray, trees: int, depth: int, seed: int):
        rng = np.random.default_rng(seed)
        self.trees, self.depth, inner = trees, depth, 2**depth - 1
        self.normal = np.zeros((trees, inner, sample.shape[1]), np.float32)
        self.offset = np.zeros((trees, inner), np.float32)
        self.held = np.zeros((trees, 2**depth))
        for t in range(trees):
            inside = [np.arange(len(sample))] + [None] * (2 * inner)
            for node in range(inner):
                rows = inside[node]
                a, b = sample[rng.choice(rows, 2, replace=len(rows) < 2)] if len(rows) else (rng.standard_normal(sample.shape[1]), 0 * sample[:1].sum(axis=0))
                way = a - b
                size = np.linalg.norm(way)
                way = way / size if size > 0 else rng.standard_normal(sample.shape[1]) / sample.shape[1] ** 0.5
                at = sample[rows] @ way
                cut = np.median(at) if len(rows) else 0.0
                self.normal[t, node], self.offset[t, node] = way, cut
                inside[2 * node + 1], inside[2 * node + 2] = rows[at < cut], rows[at >= cut]
            self.held[t] = [len(r) for r in inside[inner:]]
        self.held /= max(1, len(sample))

    def leaves(self, vectors: np.ndarray) -> np.ndarray:
        """(n, trees): the leaf of every vector in every tree."""
        out = np.zeros((len(vectors), self.trees), np.int64)
        for t in range(self.trees):
            node = np.zeros(len(vectors), np.int64)
            for _ in range(self.depth):
                right = np.einsum("ij,ij->i", vectors, self.normal[t, node]) >= self.offset[t, node]
                node = 2 * node + 1 + right
            out[:, t] = node - (2**self.depth - 1)
        return out

    def search(self, query: np.ndarray, share: float, held: np.ndarray, least: int) -> list[tuple[int, int]]:
        """(tree, leaf) in order of the shared queue until share of the sampled vectors a tree is opened, and in one
        tree leaves that hold `least` vectors by the counts `held`.

        A node's bound is the sum of the squared distances to the planes crossed to get there. A query that lies on a plane, up
        to rounding, stands on both of its sides: neither is left out, however much is opened already.
        """
        on = 1e-12 * float(query @ query)
        margin = self.normal @ query - self.offset
        inner, queue, found, opened = 2**self.depth - 1, [(0.0, t, 0) for t in range(self.trees)], [], 0.0
        there = [0] * self.trees
        while queue and (opened < share * self.trees or max(there) < least or queue[0][0] <= on):
            bound, t, node = heapq.heappop(queue)
            while node < inner:
                m = float(margin[t, node])
                near = 2 * node + 1 + (m >= 0)
                heapq.heappush(queue, (bound + m * m, t, 4 * node + 3 - near))
                node = near
            found.append((t, node - inner))
            opened += self.held[t, node - inner]
            there[t] += int(held[t, node - inner])
        return found


def usable(table: DataFrame) -> DataFrame:
    """vec_id, embedding of the vectors that take part; components other than floats are read as doubles."""
    v = F.col("embedding")
    fine = v.isNotNull() & F.coalesce(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))), F.lit(False)) & F.exists(v, lambda x: x != 0)
    kind = "array<float>" if dict(table.dtypes)["embedding"] == "array<float>" else "array<double>"
    rows = table.select(F.col("vec_id").cast("long").alias("vec_id"), v.cast(kind).alias("embedding")).where(fine & F.col("vec_id").isNotNull())
    most = rows.groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size("embedding") == (most.n if most else 0)).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _lists(m: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(np.arange(0, m.size + 1, m.shape[1], dtype=np.int32), pa.array(m.ravel()))


def _best(q: np.ndarray, v: np.ndarray, keep: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (row of q, row of v) of all that may be among the `keep` largest products, rounding allowed for."""
    s = q @ v.T
    if s.shape[1] <= keep:
        return np.nonzero(np.ones(s.shape, bool))
    least = np.partition(s, s.shape[1] - keep, axis=1)[:, s.shape[1] - keep, None]
    return np.nonzero(s >= least - 1e-9 * np.maximum(1, np.abs(least)))


def nearest(table: DataFrame, is_query, k: int = K, trees: int = TREES, depth: int | None = None, share: float = SHARE, sample: int = SAMPLE, leaf_rows: int = 65536, query_rows: int = 32768, seed: int = SEED) -> DataFrame:
    """The k nearest by inner product of every vector for which is_query(vec_id) holds: query_id, rank, vec_id, score.

    Without a depth, trees have DEPTH levels, or fewer where leaves would hold less than FEWEST vectors.
    """
    rows = stored(usable(table), "vectors")
    same = W.partitionBy(F.xxhash64("embedding"), "embedding").orderBy("vec_id")
    kept = stored(rows.withColumn("place", F.row_number().over(same)).where(F.col("place") <= k + 1).drop("place"), "distinct-vectors")
    asking = rows.where(is_query(F.col("vec_id")))
    # The smallest id of equal queries stands for all of them.
    named = stored(asking.select("vec_id", F.min("vec_id").over(W.partitionBy(F.xxhash64("embedding"), "embedding")).alias("stands")), "queries")
    queries = asking.join(named.where("vec_id = stands").select("vec_id"), "vec_id", "left_semi")
    got = hash_sample(kept, ["vec_id"], sample, seed)
    if not got:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    kind, width = dict(kept.dtypes)["embedding"], len(got[0].embedding)
    square = F.aggregate("embedding", F.lit(0.0), lambda total, x: total + x.cast("double") * x)
    table_size = kept.agg(F.count("*").alias("n"), F.max(square).alias("square")).first()
    longest = float(table_size.square) ** 0.5
    if depth is None:
        depth = max(2, min(DEPTH, (table_size.n // FEWEST).bit_length()))
    forest = Forest(lifted(np.array([r.embedding for r in got]), longest).astype(np.float32), trees, depth, seed)

    def drop(stream: Iterator[pa.RecordBatch]):
        for b in stream:
            ids, m = b.column(0).to_numpy(), _matrix(b.column(1), width)
            leaves = forest.leaves(lifted(m, longest))
            for t in range(trees):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), t, np.int32)), pa.array(leaves[:, t]), pa.array(ids), _lists(m)], ["tree", "leaf", "vec_id", "embedding"])

    dealt = kept.mapInArrow(drop, f"tree int, leaf long, vec_id long, embedding {kind}")
    held = np.zeros((trees, 2**depth), np.int64)
    for r in dealt.groupBy("tree", "leaf").count().collect():
        held[r.tree, r["leaf"]] = r["count"]

    def ask(stream: Iterator[pa.RecordBatch]):
        for b in stream:
            ids, m = b.column(0).to_numpy(), _matrix(b.column(1), width)
            up = lifted(m, longest, query=True)
            for part in range(0, len(ids), 64):
                picked = [(i, *x) for i in range(part, min(len(ids), part + 64)) for x in forest.search(up[i], share, held, k + 1)]
                if picked:
                    i, t, leaf = (np.array(c) for c in zip(*picked, strict=True))
                    yield pa.RecordBatch.from_arrays([pa.array(t.astype(np.int32)), pa.array(leaf.astype(np.int64)), pa.array(ids[i]), _lists(m[i])], ["tree", "leaf", "query_id", "asked"])

    # How many blocks a leaf's vectors and queries make; the queries of a leaf are at most all queries.
    most_asked = queries.count()
    v_blocks = F.element_at(F.lit((1 + held // leaf_rows).ravel().tolist()), (F.col("tree") * 2**depth + F.col("leaf") + 1).cast("int"))
    q_blocks = 1 + most_asked // query_rows
    block = lambda name, n: F.pmod(F.xxhash64(F.lit(seed), name), n).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    dealt = dealt.withColumn("block", block("vec_id", v_blocks)).withColumn("part", every(F.lit(q_blocks)))
    asked = queries.mapInArrow(ask, f"tree int, leaf long, query_id long, asked {kind}").withColumn("part", block("query_id", F.lit(q_blocks))).withColumn("block", every(v_blocks))

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        names, kinds = ["query_id", "vec_id", "score"], [pa.int64(), pa.int64(), pa.float64()]
        if not len(left) or not len(right):
            return pa.Table.from_arrays([pa.array([], t) for t in kinds], names)
        v, q = _matrix(left.column("embedding").combine_chunks(), width).astype(np.float64), _matrix(right.column("asked").combine_chunks(), width)
        ids, asks = left.column("vec_id").to_numpy(), right.column("query_id").to_numpy()
        out = [[], [], []]
        step = max(1, 2_000_000 // len(v))
        for part in range(0, len(q), step):
            some = q[part : part + step].astype(np.float64)
            i, j = _best(some, v, k + 1)
            for o, x in zip(out, (asks[part + i], ids[j], (some[i] * v[j]).sum(axis=1)), strict=True):
                o.append(x)
        return pa.Table.from_arrays([pa.array(np.concatenate(o), t) for o, t in zip(out, kinds, strict=True)], names)

    keys = ("tree", "leaf", "block", "part")
    found = dealt.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(meet, "query_id long, vec_id long, score double")
    best = lambda by: W.partitionBy(by).orderBy(F.desc("score"), "vec_id")
    # The same candidate from several trees has the same dense rank.
    few = found.withColumn("rank", F.dense_rank().over(best("query_id"))).where(F.col("rank") <= k + 1).dropDuplicates(["query_id", "vec_id"]).drop("rank")
    each = named.select(F.col("vec_id").alias("asks"), F.col("stands").alias("query_id")).join(few, "query_id").where(F.col("asks") != F.col("vec_id"))
    ranked = each.withColumn("rank", F.row_number().over(best("asks")).cast("int")).where(F.col("rank") <= k)
    return ranked.select(F.col("asks").alias("query_id"), "rank", "vec_id", "score")


def op10_ann(spark, sf_dir: str) -> DataFrame:
    return nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), lambda vec_id: vec_id % 20 == 0)
