"""Quality classifier: logistic regression on hashed word n-grams, trained with follow-the-regularised-leader updates.

A text is a sequence of lower-cased words and single marks. Its features are the hashes of its words, of their pairs and triples,
each with the square root of its share of all, and for some k one feature that says which share of the words, or of the
pairs, stood k places before as well (repeated n-grams); so texts of all sizes are alike. The model is one weight for
each of 2 ** BITS hash values and of the shares of repeats; a score is the logistic function of a sparse dot product.

Each weight follows the regularised leader (proximal form): z gathers gradients, n their squares, and
w = -(z - sign(z) * l1) / ((beta + sqrt(n)) / alpha + l2), or 0 where |z| <= l1. Rows come in the order of a hash, in a
fixed number of passes, so training gives the same model however the tables are cut.

The model is fitted on a sample: the first MOST_ROWS labelled rows by hash of doc_id, fewer where their texts have more
than MOST_BYTES together. Tasks hash the texts; only features of sampled rows come to the driver. Every row is scored, by its whole text.

Cases: null text and text without words have no features and get the score of the bias; rows whose label is null or
neither 0 nor 1, whose text is null, or whose doc_id is null or unknown teach nothing; a repeated row teaches once more, a
repeated label does not; without anything to learn from, or with one label only, scores are those of an untrained, or one-sided, model; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.llm.common import documents, rows_of

BITS, PASSES = 18, 5
MOST_ROWS, MOST_BYTES = 4096, 12 << 20
ALPHA, BETA, L1, L2 = 4.0, 1.0, 1e-3, 1e-5
THRESHOLD = 0.3
#: Places before at which a repeated word or pair is looked for.
BACK = (1, 2, 3, 4, 6)
ODD = np.uint64(0x9E3779B97F4A7C15)
TOKEN = re.compile(r"[^\W_]+|[^\w\s]|_")


class Tokens(dict):
    """Hash of each token, remembering some."""

    def __missing__(self, token: str) -> int:
        h = xxhash.xxh64_intdigest(token.encode("utf-8", "surrogatepass"))
        if len(self) < 300_000:
            self[token] = h
        return h


def _mixed(h: np.ndarray, salt: int) -> np.ndarray:
    h = (h ^ np.uint64(salt * 0x2545F491 + 1)) * ODD
    return h ^ (h >> np.uint64(31))


#: Places: hash values, then how often a word, or a pair, stood k places before, then the bias.
MARKS = 2 * len(BACK)


def features(text: str | None, tokens: Tokens, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """(places, values) of a text's vector."""
    h = np.fromiter(map(tokens.__getitem__, TOKEN.findall(text.lower())), np.uint64) if text else np.zeros(0, np.uint64)
    if not len(h):
        return np.zeros(0, np.int32), np.zeros(0, np.float32)
    one = _mixed(h, 1)
    two = _mixed(one[:-1] ^ h[1:], 2)
    all_ = np.concatenate((one, two, _mixed(two[:-1] ^ h[2:], 3)))
    places, counts = np.unique(all_ >> np.uint64(64 - bits), return_counts=True)
    again = [np.count_nonzero(own[back:] == own[:-back]) / len(own) if len(own) > back else 0.0 for own in (one, two) for back in BACK]
    values = np.sqrt(np.r_[counts / len(all_), again])
    return np.r_[places.astype(np.int32), np.arange(MARKS, dtype=np.int32) + (1 << bits)], values.astype(np.float32)


class Leader:
    """Follow-the-regularised-leader (proximal) for logistic loss over sparse vectors; the last place is the bias."""

    def __init__(self, bits: int = BITS, alpha: float = ALPHA, beta: float = BETA, l1: float = L1, l2: float = L2):
        self.z, self.n = np.zeros((1 << bits) + MARKS + 1), np.zeros((1 << bits) + MARKS + 1)
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        return np.where(np.abs(z) > self.l1, -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2), 0.0)

    def learn(self, at: np.ndarray, x: np.ndarray, label: int) -> None:
        """One row; at and x with the bias."""
        w = self.weights(at)
        g = (logistic(w @ x) - label) * x
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[at] = n + g * g


def logistic(s):
    return 1 / (1 + np.exp(-np.clip(s, -40, 40)))


def fit(rows: list[tuple[np.ndarray, np.ndarray, int]], passes: int = PASSES, bits: int = BITS) -> np.ndarray:
    """(places, values, label) in order -> weights, the bias last."""
    leader, bias = Leader(bits), np.int32((1 << bits) + MARKS)
    ready = [(np.append(at, bias), np.append(x, np.float32(1)), label) for at, x, label in rows]
    for _ in range(passes):
        for row in ready:
            leader.learn(*row)
    return leader.weights().astype(np.float32)


def held_out(doc_id: Column) -> Column:
    """Rows of the test fold: crc32(doc_id as text) mod 5 is 0 (null: not)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, rows: int = MOST_ROWS, size: int = MOST_BYTES) -> list[tuple[np.ndarray, np.ndarray, int]]:
    """Features and labels of at most `rows` rows of docs (doc_id, text) with labels (doc_id, quality) outside the test fold, the first
    by hash of doc_id. Which they are is found from ids and sizes; then the few labels taken are sent to the texts."""
    doc = F.col("doc_id").cast("long").alias("doc_id")
    docs = docs.select(doc, "text").where("doc_id is not null and text is not null")
    known = labels.select(doc, F.col("quality").cast("int").alias("quality")).where(F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id"))).distinct()
    place = [F.xxhash64(F.lit(12), "doc_id"), F.col("doc_id")]
    ids = docs.select("doc_id", F.octet_length("text").alias("size")).join(known, "doc_id").orderBy(*place, "quality", "size").limit(rows).collect()
    taken, total = [], 0
    for r in ids:
        total += r["size"]
        if total > size and taken:
            break
        taken.append((r.doc_id, r.quality))
    if not taken:
        return []
    few = docs.sparkSession.createDataFrame(sorted(set(taken)), "doc_id long, quality int")

    def hashed(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Tokens()
        for doc_id, text, quality in rows_of(stream):
            at, x = features(text, tokens)
            yield pa.RecordBatch.from_arrays([pa.array([doc_id]), pa.array([quality], pa.int32()), pa.array([at.tobytes()]), pa.array([x.tobytes()])], ["doc_id", "quality", "at", "x"])

    # At most `rows` labels are broadcast.
    chosen = docs.join(F.broadcast(few), "doc_id").select("doc_id", "text", "quality")
    got = chosen.mapInArrow(hashed, "doc_id long, quality int, at binary, x binary")
    got = got.orderBy(*place, "quality", F.length("at"), "at", "x").limit(len(taken)).toArrow()
    columns = (got[c].to_pylist() for c in ("at", "x", "quality"))
    return [(np.frombuffer(at, np.int32), np.frombuffer(x, np.float32), q) for at, x, q in zip(*columns, strict=True)]


def scored(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """docs (doc_id, text) -> doc_id, held_out, score, predicted; the weights (one megabyte) are broadcast."""
    shared, bits = docs.sparkSession.sparkContext.broadcast(weights), (len(weights) - 1).bit_length() - 1

    def score(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, w = Tokens(), shared.value
        for b in stream:
            for part in range(0, b.num_rows, 256):
                some = b.slice(part, 256)
                sums = []
                for text in some.column(2).to_pylist():
                    at, x = features(text, tokens, bits)
                    sums.append(float(w[at] @ x + w[-1]))
                yield pa.RecordBatch.from_arrays([some.column(0), some.column(1), pa.array(logistic(np.array(sums)))], ["doc_id", "held_out", "score"])

    doc = F.col("doc_id").cast("long")
    got = docs.select(doc.alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), "text").mapInArrow(score, "doc_id long, held_out boolean, score double")
    return got.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def op12_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return scored(docs, fit(sample(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))))
