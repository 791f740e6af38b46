"""Packing by lexical retrieval: a sharded BM25 index returns unused neighbours of each window's seed, which fill it up.

Texts are encoded once. One aggregation over all documents counts in how many of them each id of the vocabulary stands,
and their mean length; BM25 weights come from these counts alone, wherever a document lies. The index is sharded by
content: a document's key is its rarest ids (the three that stand in the fewest documents, but in two at least), ids
are dealt whole to buckets of about `bucket_docs` documents, an id with more is dealt on by its documents' second id,
and a pair of ids with more by a hash of the document, so that a bucket holds documents that share rare ids, from all over
the table, and no key is one task's load. Where a document stands in the input plays no part: the same documents give the
same pieces however they are partitioned.

Each bucket is read as a stream in the order of these keys, in shards of `shard_docs` documents or `shard_tokens` ids;
a shard is an inverted index (id -> documents with BM25 weights; ids in over half of all documents weigh nothing and have no
postings). A window's seed is the document whose piece opens it: the rest of one that was cut where the window before
ended, otherwise the first unused of the shard. The seed's best unused neighbours follow, best first, until the window
is full. The open window goes on into the bucket's next shard, so a bucket pads one window. An id lies in exactly one
piece.

Ids: the byte-level BPE of a public vocabulary file (a parameter; the rank file holds the same ids as the JSON file, which
names the special tokens), then id 0 as end of document. A special token's string in a text gives its id, as
`tokenizers` has it.

Cases: null or empty text is the end id alone; repeated rows are packed as often as they stand; ties in BM25 go to the
document that comes first in the bucket's order, ties in rarity to the smaller id; rows equal in doc_id and text are
interchangeable; an empty table gives an empty result; sequence ids are (bucket << 32) + number in the bucket; other
columns are not read.
"""

from __future__ import annotations

import base64
import json
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tidegauge.llm.common import batches, forget, rows_of, stored

WINDOW, END = 1024, 0
K1, B = 1.2, 0.75
SCHEMA = pa.schema(
    [
        ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
        ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()),
    ]
)
DDL = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def vocabulary_paths() -> tuple[str, str]:
    """The rank file and the JSON file of one vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("byte_bpe_50k.json")


def _kind(size: int):
    return np.uint16 if size <= 1 << 16 else np.uint32


#: How the vocabulary's pattern ends: a run of white space leaves its last place to what follows. That takes a look ahead, which
#: is slow. Where no run has two places, the last rule is all there is. Unicode's white space, which is not Python's.
ENDING = r"|\s+(?!\S)|\s+"
SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
RUN = re.compile(f"[{SPACE}][{SPACE}]")


def encoder(ranks_path: str, json_path: str):
    """text -> ids (uint16 where the vocabulary fits, uint32 otherwise), END last; and the number of ids there are."""
    import public_tokenizers
    import tiktoken

    with open(ranks_path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    with open(json_path, encoding="utf-8") as file:
        special = {t["content"]: t["id"] for t in json.load(file)["added_tokens"]}
    pattern = public_tokenizers.PATTERN
    short = pattern.removesuffix(ENDING) + r"|\s" if pattern.endswith(ENDING) else pattern
    whole, plain = (tiktoken.Encoding("ranks", pat_str=p, mergeable_ranks=ranks, special_tokens=special) for p in (pattern, short))
    size = 1 + max([*ranks.values(), *special.values()])
    kind = _kind(size)
    code = "H" if kind is np.uint16 else "I"

    def encode(text: str) -> np.ndarray:
        if any(t in text for t in special):
            ids = whole.encode(text, allowed_special="all")
        else:
            ids = (whole if RUN.search(text) else plain).encode_ordinary(text)
        ids.append(END)
        return np.frombuffer(array(code, ids), kind)

    return encode, size


def idf(n_docs: int, df: np.ndarray) -> np.ndarray:
    """Weight of each id by the number of documents it stands in; none for those in over half of them."""
    return np.maximum(0.0, np.log((n_docs - df + 0.5) / (df + 0.5)))


class Bm25:
    """Inverted index of one shard, with the weights of the whole corpus."""

    def __init__(self, docs: list[np.ndarray], weights: np.ndarray, mean_length: float, k1: float = K1, b: float = B):
        self.n = len(docs)
        parts = [np.unique(d.astype(np.int32), return_counts=True) for d in docs]  # sorts faster than 16 bits
        sizes = np.array([len(t) for t, _ in parts])
        terms, tf = np.concatenate([t for t, _ in parts]).astype(np.int64), np.concatenate([c for _, c in parts]).astype(np.float64)
        owner = np.repeat(np.arange(self.n), sizes)
        length = np.array([len(d) for d in docs], np.float64)
        norm = k1 * (1 - b + b * length / mean_length)
        weight = weights[terms] * tf * (k1 + 1) / (tf + norm[owner])
        keep = weight > 0
        terms, owner, weight = terms[keep], owner[keep], weight[keep]
        ends = np.cumsum(np.bincount(owner, minlength=self.n))
        self.terms = np.split(terms, ends[:-1])
        order = np.argsort(terms, kind="stable")
        self.term, self.owner, self.weight, self.size = terms[order], owner[order], weight[order], len(weights)
        self._bounds()

    def _bounds(self) -> None:
        self.ends = np.cumsum(np.bincount(self.term, minlength=self.size))
        self.starts = np.r_[0, self.ends[:-1]]

    def without(self, used: np.ndarray) -> None:
        """Drops the postings of documents that are used; their scores are 0 from now on."""
        keep = ~used[self.owner]
        self.term, self.owner, self.weight = self.term[keep], self.owner[keep], self.weight[keep]
        self._bounds()

    def scores(self, terms: np.ndarray) -> np.ndarray:
        """BM25 of every document of the shard for a query of different ids."""
        start, size = self.starts[terms], self.ends[terms] - self.starts[terms]
        total = int(size.sum())
        at = np.repeat(start - np.r_[0, np.cumsum(size)[:-1]], size) + np.arange(total) if total else np.zeros(0, np.int64)
        return np.bincount(self.owner[at], self.weight[at], minlength=self.n)


class Packer:
    """The open window of a bucket: its number, how full it is, and the ids of the document that seeds it."""

    def __init__(self, base: int, window: int = WINDOW):
        self.window, self.sequence, self.used, self.seed = window, base, 0, None

    def place(self, doc_id, ids: np.ndarray, terms: np.ndarray) -> Iterator[tuple]:
        total, start = len(ids), 0
        data = ids.astype("<u4").tobytes()
        while start < total:
            length = min(total - start, self.window - self.used)
            if not self.used:
                self.seed = terms
            yield doc_id, start, length, zlib.crc32(data[4 * start : 4 * (start + length)]), total, self.sequence, self.used
            start, self.used = start + length, self.used + length
            if self.used == self.window:
                self.sequence, self.used, self.seed = self.sequence + 1, 0, None


def fill(shard: list[tuple], packer: Packer, weights: np.ndarray, mean_length: float) -> Iterator[tuple]:
    """Pieces of a shard's (doc_id, ids): each window is filled with the unused documents nearest to its seed."""
    if not shard:
        return
    index = Bm25([ids for _, ids in shard], weights, mean_length)
    unused, first, seed, near = np.ones(len(shard), bool), 0, None, None
    for done in range(len(shard)):
        if done and done % max(64, len(shard) // 8) == 0:
            index.without(~unused)
        if packer.seed is None:  # no window is open: the first unused document seeds one
            while not unused[first]:
                first += 1
            at, seed = first, None
        else:
            if packer.seed is not seed:
                seed, near = packer.seed, index.scores(packer.seed)
            at = int(np.where(unused, near, -1.0).argmax())
        unused[at] = False
        yield from packer.place(*shard[at], index.terms[at])


def encoded(docs: DataFrame, paths: tuple[str, str]) -> tuple[DataFrame, int, np.ndarray, float]:
    """docs (doc_id, text) -> stored rows (doc_id, h, ids), their number, documents by id, and the mean length.

    The counts are one row for each id of the vocabulary; each task writes its own (id, n) beside its documents.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("h", pa.int64()), ("ids", pa.binary()), ("id", pa.int64()), ("n", pa.int64())])

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, size = encoder(*paths)
        df, none = np.zeros(size + 2, np.int64), lambda n, c: pa.nulls(n, schema.types[c])
        for b in stream:
            for part in range(0, b.num_rows, 256):
                some = b.slice(part, 256)
                ids = [encode(t or "") for t in some.column(2).to_pylist()]
                for own in ids:
                    df[np.unique(own.astype(np.int32))] += 1
                df[size], df[size + 1] = df[size] + len(ids), df[size + 1] + sum(map(len, ids))
                n = some.num_rows
                yield pa.RecordBatch.from_arrays([some.column(0), some.column(1), pa.array([i.tobytes() for i in ids], pa.binary()), none(n, 3), none(n, 4)], schema=schema)
        there = np.flatnonzero(df)
        n = len(there)
        yield pa.RecordBatch.from_arrays([none(n, 0), none(n, 1), none(n, 2), pa.array(there), pa.array(df[there])], schema=schema)

    thin = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("doc_id", "text").alias("h"), "text")
    both = stored(thin.mapInArrow(run, "doc_id long, h long, ids binary, id long, n long"), "encoded", compression="zstd")
    size = encoder(*paths)[1]
    got = both.where("id is not null").groupBy("id").agg(F.sum("n").alias("n")).toArrow()
    df = np.zeros(size + 2, np.int64)
    df[got["id"].to_numpy()] = got["n"].to_numpy()
    return both, int(df[size]), df[:size], float(df[size + 1]) / max(1, int(df[size]))


def ranked(df: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The place of each id when those in the fewest documents, but in two at least, come first; and the id at each place, -1 at
    that of all others."""
    order = np.lexsort((np.arange(len(df)), df))
    order = order[df[order] > 1]
    place = np.full(len(df), len(order), np.int32)
    place[order] = np.arange(len(order))
    return place, np.r_[order, -1]


def rarest(ids: np.ndarray, place: np.ndarray, by_place: np.ndarray, most: int = 3) -> list[int]:
    """The `most` ids that stand in the fewest documents, but in two at least; -1 where there are no more."""
    places, last, best = place[ids], len(by_place) - 1, []
    for _ in range(most):
        best.append(int(places.min(initial=last)))
        places = places[places > best[-1]]
    return by_place[best].tolist()


def dealt(keys: DataFrame, bucket_docs: int) -> DataFrame:
    """keys (t1, t2, h, ...) -> with bucket, by content alone. What is collected or broadcast is one row for each id."""
    counts = stored(keys.groupBy("t1", "t2").agg(F.count("*").alias("c")), "pair-counts")
    firsts = sorted((r.t1, r.n) for r in counts.groupBy("t1").agg(F.sum("c").alias("n")).collect())
    pairs = counts.where(F.col("c") > bucket_docs).select("t1", "t2", F.ceil(F.col("c") / bucket_docs).cast("long").alias("k"))
    before = F.coalesce(F.sum("k").over(W.partitionBy("t1").orderBy("t2").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    pairs = stored(pairs.withColumn("before", before), "frequent-pairs")
    forget(counts)
    extra = {r.t1: r.k for r in pairs.groupBy("t1").agg(F.sum("k").alias("k")).collect()}
    start, number, held = [], 0, 0
    for t1, c in firsts:  # small ids share a bucket, a large one has buckets of its own
        if held and held + c > bucket_docs:
            number, held = number + 1, 0
        m = max(1, -(-c // bucket_docs))
        start.append([t1, number, m, 0])
        held += c
        if m > 1:
            number, held = number + m, 0
    number += bool(held)
    for row in start:
        row[3], number = number, number + extra.get(row[0], 0)
    starts = keys.sparkSession.createDataFrame(start, "t1 int, first long, m long, last long")
    own = F.col("first") + F.pmod(F.xxhash64("t2"), F.col("m"))
    hot = F.col("last") + F.col("before") + F.pmod(F.col("h"), F.col("k"))
    return keys.join(F.broadcast(starts), "t1").join(pairs, ["t1", "t2"], "left").withColumn("bucket", F.coalesce(hot, own)).drop("first", "m", "last", "k", "before")


def pack(docs: DataFrame, window: int = WINDOW, bucket_docs: int = 1024, shard_docs: int = 1024, shard_tokens: int = 4_000_000, vocabulary: tuple[str, str] | None = None) -> DataFrame:
    """docs (doc_id, text) -> one row for each piece."""
    paths = vocabulary or vocabulary_paths()
    both, n_docs, df, mean_length = encoded(docs, paths)
    rows = both.where("id is null").select("doc_id", "h", "ids")
    kind, weights, places = _kind(len(df)), idf(n_docs, df), ranked(df)

    def key(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in stream:
            for part in range(0, b.num_rows, 1024):
                some = b.slice(part, 1024)
                t = np.array([rarest(np.frombuffer(i, kind)[:-1], *places) for i in some.column(2).to_pylist()], np.int32).reshape(-1, 3)
                yield pa.RecordBatch.from_arrays([*some.columns, *(pa.array(t[:, k]) for k in range(3))], ["doc_id", "h", "ids", "t1", "t2", "t3"])

    keyed = stored(rows.mapInArrow(key, "doc_id long, h long, ids binary, t1 int, t2 int, t3 int"), "keyed", compression="zstd")
    forget(both)
    ordered = dealt(keyed, bucket_docs).repartition("bucket").sortWithinPartitions("bucket", "t1", "t2", "t3", "h", "doc_id")

    def pieces(stream: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        bucket, packer, shard, held = None, None, [], 0
        for here, doc_id, data in rows_of(stream):
            ids = np.frombuffer(data, kind)
            if here != bucket or len(shard) >= shard_docs or held >= shard_tokens:
                yield from fill(shard, packer, weights, mean_length)
                shard, held = [], 0
            if here != bucket:
                bucket, packer = here, Packer(here << 32, window)
            shard.append((doc_id, ids))
            held += len(ids)
        yield from fill(shard, packer, weights, mean_length)

    return ordered.select("bucket", "doc_id", "ids").mapInArrow(lambda it: batches(pieces(it), SCHEMA), DDL)


def op8_packing(spark, sf_dir: str) -> DataFrame:
    from tidegauge.llm.common import documents

    return pack(documents(spark, sf_dir))
