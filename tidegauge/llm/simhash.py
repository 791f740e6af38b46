"""SimHash near-duplicates by anchor-point covering.

Anchors: the product of nine perfect Hamming(7,4) codes (covering radius 1 a block) and the 64th bit as it is:
2^37 anchors, each fingerprint's home being one of them. Two fingerprints that differ in at most t bits have a
word halfway, at most ceil(t/2) bits from either, and the halfway word's home is an anchor within the covering
radius plus that half threshold of both. So each fingerprint is replicated to every anchor that is the home of a
word within ceil(t/2) bits (about 25 of them at t=2), and fingerprints are compared anchor by anchor: no link is
lost. Equal fingerprints are collapsed first, so copies never meet in a cell.

A cell of more than `cell_limit` different fingerprints is not compared: its members are sent on to the finest
covering code, all 2^64 words with radius 0, where a group is the ball of ceil(t/2) bits round its anchor. At even t
all its members link to each other, which needs no comparison; at odd t they are compared there. Such a group
has at most the ball's size (65 at t=2).

Cases: null or empty text has fingerprint 0, linked like any other; null doc_ids are kept and never become a
component id unless the component has no other; repeated rows are linked; an empty table gives an empty result.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.common import forget, rows_of, space_words, stored
from tidegauge.llm.graph import components

#: Shingle width, hash seed and threshold in bits of the near-duplicate contract.
SHINGLE, SEED, BITS = 3, 42, 2


def fingerprint(text: str | None, width: int = SHINGLE, seed: int = SEED) -> int:
    words = space_words(text)
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) < width:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(width)), strict=False))
    return majority(np.fromiter((digest(s, seed) for s in shingles), np.uint64))


def majority(h: np.ndarray) -> int:
    """The bits that are set in over half the hashes."""
    ones = np.zeros(64, np.int64)
    for part in range(0, len(h), 65536):  # bounded memory on very long texts
        bits = np.unpackbits(h[part : part + 65536].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view("<u8")[0])


def _nearest() -> np.ndarray:
    """Nearest Hamming(7,4) codeword of every 7-bit word: the syndrome names the bit to flip."""
    words = np.arange(128)
    syndrome = np.zeros(128, np.int64)
    for bit in range(7):
        syndrome ^= np.where(words >> bit & 1, bit + 1, 0)
    return np.where(syndrome > 0, words ^ (1 << np.maximum(syndrome - 1, 0)), words).astype(np.uint64)


NEAREST = _nearest()


def flips(most: int) -> np.ndarray:
    """All 64-bit words of at most `most` set bits."""
    masks = [sum(1 << b for b in c) for k in range(most + 1) for c in itertools.combinations(range(64), k)]
    return np.array(masks, np.uint64)


def home(words: np.ndarray) -> np.ndarray:
    """The anchor of each 64-bit word."""
    out = words & np.uint64(1 << 63)
    for block in range(9):
        shift = np.uint64(7 * block)
        out = out | (NEAREST[(words >> shift & np.uint64(127)).astype(np.int64)] << shift)
    return out


def replicas(prints: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(anchor, fingerprint) for each anchor that is the home of a word within `most` bits."""
    anchors = np.sort(home(prints[:, None] ^ flips(most)[None, :]), axis=1)
    fresh = np.ones(anchors.shape, bool)
    fresh[:, 1:] = anchors[:, 1:] != anchors[:, :-1]
    return anchors[fresh], np.repeat(prints, fresh.sum(axis=1))


def _trees(prints: np.ndarray, bits: int) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the fingerprints that differ in at most `bits` bits."""
    near = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= bits
    todo, edges = np.ones(len(prints), bool), []
    for first in range(len(prints)):
        if not todo[first]:
            continue
        todo[first], queue = False, [first]
        while queue:
            at = queue.pop()
            for to in np.flatnonzero(near[at] & todo):
                todo[to] = False
                edges.append((int(prints[to]), int(prints[at])))
                queue.append(int(to))
    return edges


EDGE = "hot boolean, a long, b long"


def _edge_batch(hot: bool, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([hot] * len(a), pa.bool_()), pa.array(a.astype(np.uint64).view(np.int64)), pa.array(b.astype(np.uint64).view(np.int64))],
        ["hot", "a", "b"],
    )


def _compare(batches: Iterator[pa.RecordBatch], bits: int, limit: int) -> Iterator[pa.RecordBatch]:
    """Runs of equal anchors, sorted: links of small cells; members of large cells with their halfway words."""
    masks = flips((bits + 1) // 2)
    anchor, held, hot = None, np.empty(0, np.uint64), False

    def passed_on(prints):
        for part in range(0, len(prints), 4096):
            some = prints[part : part + 4096]
            words = (some[:, None] ^ masks[None, :]).ravel()
            yield _edge_batch(True, words, np.repeat(some, len(masks)))

    def finish():
        if hot:
            yield from passed_on(held)
        elif len(held) > 1 and (edges := _trees(held, bits)):
            e = np.array(edges, np.uint64)
            yield _edge_batch(False, e[:, 0], e[:, 1])

    for batch in batches:
        keys = batch.column(0).to_numpy(zero_copy_only=False)
        prints = batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
        if not len(keys):
            continue
        cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
        starts, ends = np.r_[0, cuts], np.r_[cuts, len(keys)]
        if keys[0] == anchor:
            held = np.r_[held, prints[: ends[0]]]
            starts, ends = starts[1:], ends[1:]
            if len(held) > limit:
                hot = True
                yield from passed_on(held)
                held = np.empty(0, np.uint64)
        if not len(starts):
            continue
        yield from finish()
        size = ends - starts
        two = starts[:-1][size[:-1] == 2]
        close = two[np.bitwise_count(prints[two] ^ prints[two + 1]) <= bits]
        if len(close):
            yield _edge_batch(False, prints[close], prints[close + 1])
        for k in np.flatnonzero(size[:-1] > 2):
            anchor, held, hot = None, prints[starts[k] : ends[k]], size[k] > limit
            yield from finish()
        anchor, held, hot = keys[starts[-1]], prints[starts[-1] : ends[-1]].copy(), bool(size[-1] > limit)
        if hot:
            yield from passed_on(held)
            held = np.empty(0, np.uint64)
    yield from finish()


def _within_ball(prints: DataFrame, bits: int) -> DataFrame:
    """Edges from (word, fingerprint) rows of the finest code: groups of at most one ball."""
    if bits % 2 == 0:
        return prints.groupBy("a").agg(F.min("b").alias("m"), F.collect_set("b").alias("all")).select(F.explode("all").alias("u"), F.col("m").alias("v")).where("u <> v")
    pairs = prints.groupBy("a").agg(F.collect_set("b").alias("all")).select(F.explode("all").alias("u"), "all").select("u", F.explode("all").alias("v"))
    return pairs.where((F.col("u") < F.col("v")) & (F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= bits))


def links(prints: DataFrame, bits: int = BITS, cell_limit: int = 1024) -> DataFrame:
    """prints (fp long), all different -> edges (u, v) that connect whatever differs in at most `bits` bits."""
    half = (bits + 1) // 2

    def spread(batches):
        for b in batches:
            all_prints = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for part in range(0, len(all_prints), 4096):
                anchors, own = replicas(all_prints[part : part + 4096], half)
                yield pa.RecordBatch.from_arrays([pa.array(anchors.view(np.int64)), pa.array(own.view(np.int64))], ["anchor", "fp"])

    cells = prints.select("fp").mapInArrow(spread, "anchor long, fp long")
    dealt = cells.repartition("anchor").sortWithinPartitions("anchor", "fp")
    found = stored(dealt.mapInArrow(lambda it: _compare(it, bits, cell_limit), EDGE), "cells")
    plain = found.where("not hot").select(F.col("a").alias("u"), F.col("b").alias("v"))
    return plain.union(_within_ball(found.where("hot").select("a", "b").distinct(), bits)).distinct()


def fingerprints(docs: DataFrame, width: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """docs (doc_id, text) -> (doc_id, fp long: the 64 bits)."""

    def run(batches):
        for b in batches:
            fp = np.fromiter((fingerprint(t, width, seed) for _, t in rows_of([b])), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp.view(np.int64))], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, fp long")


def grouped(own: DataFrame, roots_of) -> DataFrame:
    """own (doc_id, fp, ...) and roots_of, which makes (node, root) of a table of all fp: adds component_id and root, the
    component's own name (two components may have documents of one doc_id)."""
    firsts = stored(own.groupBy("fp").agg(F.min("doc_id").alias("first")), "prints")
    roots = roots_of(firsts)
    rooted = firsts.join(roots, firsts.fp == roots.node, "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    rooted = stored(rooted, "rooted")
    smallest = stored(rooted.groupBy("root").agg(F.min("first").alias("component_id")), "smallest")
    named = stored(rooted.join(smallest, "root").select("fp", "component_id", "root"), "named")
    for old in (rooted, smallest, firsts):
        forget(old)
    return own.join(named, "fp").select(*own.columns, "component_id", "root")


def near_duplicates(docs: DataFrame, bits: int = BITS, width: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """One row for each row of docs: doc_id, fp (long), component_id (the smallest doc_id reachable)."""
    own = stored(fingerprints(docs, width, seed), "fingerprints")
    return grouped(own, lambda firsts: components(links(firsts, bits)))


def op2_simhash(spark, sf_dir: str) -> DataFrame:
    from tidegauge.llm.common import documents

    out = near_duplicates(documents(spark, sf_dir))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
