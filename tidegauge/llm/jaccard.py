"""Near-duplicates by the Jaccard similarity of word shingles: SimHash links with an exact check, and an exact way for the rest.

64 bits cannot tell 0.8 from less (such pairs differ in about ten bits), so SimHash links alone would miss most of what
is wanted. Fingerprints of the shingle sets are linked by anchor-point covering (simhash.links) and each link is checked
on the whole sets; prefix filtering finds what SimHash does not.

A text becomes the set of hashes of its `width`-word shingles. All hashes stand in one order, the rare ones first; two
sets of at least the wanted similarity share a hash within the first n - ceil(similarity * n) + 1 of both, so only
these are shuffled, and sets that meet at one of them and fit by size and position are compared whole. Texts with
equal sets are collapsed first. The order comes from counts in BUCKETS hash buckets; it decides the work, not the result.

What is wanted are groups, not pairs, so a group of many near copies is not compared pair by pair. In the first round
each set is compared with a few pivots at each of its hashes (the PIVOTS smallest keys there),
and with those that SimHash links; the links found make groups. In the last round all sets of different groups that meet
are compared; a hash at which a single group meets has nothing left to compare. Pivots decide the work, not the result: every
link between two groups is found in the last round, and every pair within a group is linked already. Pairs that
cannot be near enough are left out of the join by a parity sketch of each set: as many bits as two sketches
differ in, as many hashes at least stand in one of the two sets only.

Many sets may meet at one hash although none of them fit: a frequent hash stands late in all their orders. So the sets of
a hash are put into classes by size and by how much of the set is still to come, and classes are joined before rows are; only
the rows of classes that may hold a fitting pair meet, and where none may, none do.

Cases: null or empty text has an empty set, linked to its like only; a text of fewer than `width` words is one shingle;
an empty table gives an empty result.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tidegauge.llm import simhash
from tidegauge.llm.common import forget, rows_of, space_words, stored
from tidegauge.llm.graph import components
from tidegauge.llm.simhash import BITS, grouped

WIDTH, SIMILARITY, PIVOTS = 5, 0.8, 8
#: Sizes within a factor, and shares of a set still to come within a step, are one class.
FACTOR, STEP = 1.1, 0.02
BUCKETS = 1 << 18
ODD = np.uint64(0x9E3779B97F4A7C15)


class Hashes(dict):
    """Hash of each word, remembering some."""

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh64_intdigest(word)
        if len(self) < 200_000:
            self[word] = h
        return h


def shingles(text: str | None, words: Hashes, width: int = WIDTH) -> np.ndarray:
    """The sorted set of a text's shingle hashes."""
    h = np.fromiter(map(words.__getitem__, space_words(text)), np.uint64)
    if not len(h):
        return h
    width = min(width, len(h))
    out = np.full(len(h) - width + 1, width, np.uint64)
    for k in range(width):
        out = (out ^ h[k : len(h) - width + 1 + k]) * ODD
        out ^= out >> np.uint64(29)
    return np.unique(out)


#: Sketches have 64 bits in each of these columns.
SKETCH = ("b0", "b1", "b2", "b3")


def sketch(hashes: np.ndarray) -> np.ndarray:
    """For each of 256 buckets whether it holds an odd number of the hashes, as four longs."""
    odd = np.bincount((hashes >> np.uint64(40)).astype(np.int64) % 256, minlength=256) % 2
    return np.packbits(odd.astype(bool), bitorder="little").view("<i8")


def _key(hashes: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(hashes.tobytes()) - (1 << 63)


def _least(n, similarity: float):
    return np.ceil(similarity * n - 1e-9).astype(np.int64)


def _bucket(hashes: np.ndarray) -> np.ndarray:
    return (hashes % np.uint64(BUCKETS)).astype(np.int64)


def _columns(names: list[str], *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)


def sketched(own: DataFrame, bits: int = BITS) -> DataFrame:
    """own (fp: set key, print; each once) -> pairs (u, v) of set keys: those of equal fingerprints with the smallest of them, and the
    smallest of fingerprints that SimHash links."""
    prints = stored(own.groupBy("print").agg(F.min("fp").alias("least")), "set-prints")
    equal = own.join(prints, "print").where("fp <> least").select(F.col("least").alias("u"), F.col("fp").alias("v"))
    named = lambda c, to: prints.select(F.col("print").alias(c), F.col("least").alias(to))
    near = simhash.links(prints.select(F.col("print").alias("fp")), bits).select(F.col("u").alias("a"), F.col("v").alias("b"))
    near = near.join(named("a", "x"), "a").join(named("b", "y"), "b").where("x <> y")
    return equal.union(near.select(F.least("x", "y").alias("u"), F.greatest("x", "y").alias("v")))


def groups(docs: DataFrame, own: DataFrame, width: int = WIDTH, similarity: float = SIMILARITY, bits: int = BITS) -> DataFrame:
    """(node, root) of set keys that links of at least the wanted similarity connect, as graph.components has it; own
    (doc_id, same, fp, print, sketch)."""
    texts = docs.select(F.col("doc_id").cast("long"), "text")
    own = own.groupBy("fp").agg(F.min(F.struct("doc_id", "same")).alias("one"), F.min("print").alias("print"), *[F.min(c).alias(c) for c in SKETCH])
    own = stored(own.select("fp", "one.doc_id", "one.same", "print", *SKETCH), "sets-once")

    def count(stream):
        words, seen = Hashes(), np.zeros(BUCKETS, np.int64)
        for _, text in rows_of(stream):
            np.add.at(seen, _bucket(shingles(text, words, width)), 1)
        some = np.flatnonzero(seen)
        yield _columns(["bucket", "n"], some, seen[some])

    counts = texts.mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    common = np.zeros(BUCKETS, np.int64)
    common[counts["bucket"].to_numpy()] = counts["n"].to_numpy()
    sizes_of = docs.sparkSession.sparkContext.broadcast(common)

    def prefixes(stream):
        words, done = Hashes(), set()
        for b in stream:
            for part in range(0, b.num_rows, 256):
                tokens, keys, places, sizes = [], [], [], []
                for text in b.column(1).slice(part, 256).to_pylist():
                    s = shingles(text, words, width)
                    key = _key(s)
                    if not len(s) or key in done:
                        continue
                    if len(done) < 200_000:
                        done.add(key)
                    take = len(s) - int(_least(len(s), similarity)) + 1
                    tokens.append(s[np.lexsort((s, sizes_of.value[_bucket(s)]))[:take]].view(np.int64))
                    keys.append(np.full(take, key))
                    places.append(np.arange(take))
                    sizes.append(np.full(take, len(s)))
                if tokens:
                    yield _columns(["token", "key", "at", "n"], *map(np.concatenate, (tokens, keys, places, sizes)))

    def met(stream):
        """Rows of tokens that at least two keys have, from rows sorted by token and key; equal rows once."""
        token0 = key0 = first = None  # of the last row; first: the only row of its token so far, not given yet
        for b in stream:
            token, key = b.column(0).to_numpy(), b.column(1).to_numpy()
            if not len(token):
                continue
            fresh = np.r_[(token[0], key[0]) != (token0, key0), (token[1:] != token[:-1]) | (key[1:] != key[:-1])]
            b, token, key = b.filter(pa.array(fresh)), token[fresh], key[fresh]
            if not len(token):
                continue
            size = np.diff(np.r_[np.flatnonzero(np.r_[True, token[1:] != token[:-1]]), len(token)])
            several = size > 1
            if token[0] == token0:
                several[0] = True
                if first is not None:
                    yield first
            keep = np.repeat(several, size)
            first = None if several[-1] else b.slice(len(token) - 1, 1)
            token0, key0 = token[-1], key[-1]
            if keep.any():
                yield b.filter(pa.array(keep))

    spread = texts.mapInArrow(prefixes, "token long, key long, at long, n long").repartition("token").sortWithinPartitions("token", "key")
    shared = stored(spread.mapInArrow(met, "token long, key long, at long, n long"), "shared-prefixes")

    def sets(stream):
        words = Hashes()
        for b in stream:
            for part in range(0, b.num_rows, 256):
                some = [shingles(t, words, width) for t in b.column(1).slice(part, 256).to_pylist()]
                yield _columns(["key", "hashes"], np.array([_key(s) for s in some], np.int64), [s.tobytes() for s in some])

    def compare(stream):
        for b in stream:
            for part in range(0, b.num_rows, 256):
                u, v, x, y = (c.to_pylist() for c in b.slice(part, 256).columns)
                near = []
                for p, q in zip(x, y, strict=True):
                    p, q = np.frombuffer(p, np.uint64), np.frombuffer(q, np.uint64)
                    both = len(np.intersect1d(p, q, assume_unique=True))
                    near.append(both >= similarity * (len(p) + len(q) - both) - 1e-9)
                keep = np.array(near, bool)
                yield _columns(["u", "v"], np.array(u, np.int64)[keep], np.array(v, np.int64)[keep])

    def linked(pairs: DataFrame, label: str) -> DataFrame:
        """Of stored pairs (u, v) those that are near enough; the pairs go. Only the sets of these pairs are made, each from one text."""
        meant = pairs.select(F.explode(F.array("u", "v")).alias("fp")).distinct()
        ones = own.join(meant, "fp").select("doc_id", "same")
        some = texts.withColumn("same", F.xxhash64("text")).join(ones, ["doc_id", "same"], "left_semi").dropDuplicates(["doc_id", "same"])
        held = stored(some.select("doc_id", "text").mapInArrow(sets, "key long, hashes binary"), f"{label}-sets")
        one, other = (held.select(F.col("key").alias(k), F.col("hashes").alias(h)) for k, h in (("u", "x"), ("v", "y")))
        both = pairs.join(one, "u").join(other, "v").select("u", "v", "x", "y")
        links = stored(both.mapInArrow(compare, "u long, v long"), f"{label}-links")
        for old in (pairs, held):
            forget(old)
        return links

    sketches = own.select(F.col("fp").alias("key"), *SKETCH)
    share = similarity / (1 + similarity)
    left = F.col("n") - F.col("at")
    kind = [F.floor(F.ln("n") / math.log(FACTOR)).alias("size"), F.floor(left / F.col("n") / STEP).alias("rest")]

    def side(rows: DataFrame, name: str) -> DataFrame:
        return rows.select("token", *[F.col(c).alias(f"{name}{c}") for c in rows.columns if c != "token"])

    together = F.col("un") + F.col("vn")
    fits = F.least(F.col("un") - F.col("uat"), F.col("vn") - F.col("vat")) >= together * share - 1e-6
    apart = reduce(add, [F.bit_count(F.col(f"u{c}").bitwiseXOR(F.col(f"v{c}"))) for c in SKETCH])
    like = apart <= together * ((1 - similarity) / (1 + similarity)) + 1e-6

    def classes(rows: DataFrame) -> DataFrame:
        """For each class of a token: its smallest set, the most that is to come in one, and its groups from and to."""
        most = F.max(left).alias("left")
        return rows.groupBy("token", "size", "rest").agg(F.min("n").alias("n"), most, F.min("root").alias("low"), F.max("root").alias("high"))

    def meeting(some: DataFrame, rows: DataFrame) -> DataFrame:
        """Pairs of different groups that meet at a token and may be near enough."""
        once = F.col("uroot") < F.col("vroot") if some is rows else F.col("uroot") != F.col("vroot")
        may = F.least("uleft", "vleft") >= together * share - 1e-6
        several = F.least("ulow", "vlow") < F.greatest("uhigh", "vhigh")
        which = side(classes(some), "u").join(side(classes(rows), "v"), "token").where(may & several)
        which = stored(which.select("token", "usize", "urest", "vsize", "vrest"), "classes")
        told = lambda of, name: side(of.join(which.select("token").distinct(), "token", "left_semi").join(sketches, "key"), name)
        pairs = told(some, "u").join(which, ["token", "usize", "urest"]).join(told(rows, "v"), ["token", "vsize", "vrest"]).where(once & fits & like)
        few = stored(pairs.select(F.least("ukey", "vkey").alias("u"), F.greatest("ukey", "vkey").alias("v")).distinct(), "met-pairs")
        forget(which)
        return few

    found = linked(stored(sketched(own, bits).distinct(), "simhash-pairs"), "simhash")
    roots = components(found)
    forget(found)
    left_over = shared
    for most in (PIVOTS, None):
        # Tokens at which several groups meet; those of the first round hold those of the last.
        base = left_over.select("token", "key", "at", "n")
        named = base.join(roots, base.key == roots.node, "left").select("token", "key", "at", "n", F.coalesce("root", "key").alias("root"), *kind)
        several = named.groupBy("token").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select("token")
        rows = stored(named.join(several, "token", "left_semi"), "several-groups")
        forget(left_over)
        some = rows
        if most:
            place = F.row_number().over(W.partitionBy("token").orderBy("key"))
            some = rows.withColumn("place", place).where(F.col("place") <= most).drop("place")
        found = linked(meeting(some, rows), "met")
        after = components(found, roots)
        for old in (found, roots):
            forget(old)
        roots, left_over = after, rows
    for old in (left_over, own):
        forget(old)
    return roots


def near_duplicates(docs: DataFrame, width: int = WIDTH, similarity: float = SIMILARITY) -> DataFrame:
    """One row for each row of docs: doc_id, same (hash of the text), fp (key of its set), print (SimHash of the set),
    component_id (the smallest doc_id reachable), root (the component's own name). doc_id must not be null.
    """

    def keys(stream):
        words = Hashes()
        for b in stream:
            for part in range(0, b.num_rows, 256):
                some = b.slice(part, 256)
                found = [shingles(t, words, width) for t in some.column(1).to_pylist()]
                prints = np.fromiter(map(simhash.majority, found), np.uint64, len(found)).view(np.int64)
                sketches = np.array([sketch(f) for f in found], np.int64).reshape(-1, 4)
                yield pa.RecordBatch.from_arrays([some.column(0), some.column(2), pa.array([_key(f) for f in found], pa.int64()), pa.array(prints), *map(pa.array, sketches.T.copy())], ["doc_id", "same", "fp", "print", *SKETCH])

    rows = docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("same"))
    own = stored(rows.mapInArrow(keys, "doc_id long, same long, fp long, print long, b0 long, b1 long, b2 long, b3 long"), "set-keys")
    return grouped(own, lambda _: groups(docs, own, width, similarity))
