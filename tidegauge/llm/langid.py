"""Language ID by rank-order profiles (out-of-place distance between lists of the most frequent n-grams).

A text is lower-cased letter runs, each run padded with one blank on both sides; its n-grams are single letters and
the pairs and triples of a padded run. Training sums n-gram counts for each language over all labelled rows (one
aggregation, pre-summed in each task) and keeps the `top` most frequent, ties by code. A text's own `top` n-grams are
compared with each profile: an n-gram costs the difference of its ranks, or `top` if the profile lacks it. The least
total wins (ties: the smaller language name); score is 1 - total / (top * number of n-grams).

Cases: null text, or text without a letter, is `und` with score 0, as is everything if nothing could be learned; rows
with null lang or null text are not learned from; repeated rows count as often as they stand; an empty table gives an
empty result; other columns are untouched.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tidegauge.llm.common import rows_of

TOP, UNDECIDED = 400, "und"
BITS, WIDE = 20, 48  # bits of a code point in an n-gram's code; alphabets up to WIDE are counted in a dense table


@cache
def _letters() -> np.ndarray:
    """Lower-case code point of each letter of the first plane, 0 for all that is no letter."""
    return np.array([ord(c.lower()[0]) if (c := chr(p)).isalpha() else 0 for p in range(65536)], np.uint32)


def letters(text: str) -> np.ndarray:
    """Code points of the letter runs, 0 between them and at both ends."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    if len(points) and points.max() > 65535:
        low = _letters()[np.minimum(points, 65535)]
        for p in np.unique(points[points > 65535]):
            low[points == p] = ord(chr(p).lower()[0]) if chr(p).isalpha() else 0
    else:
        low = _letters()[points]
    out = np.zeros(len(low) + 2, np.int64)
    out[1:-1] = low
    keep = np.ones(len(out), bool)
    keep[1:] = (out[1:] != 0) | (out[:-1] != 0)
    return out[keep]


def ngrams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(codes, counts) of the 1-, 2- and 3-grams of the whole text."""
    run = letters(text) if text else np.zeros(0, np.int64)
    if len(run) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    there = np.flatnonzero(np.bincount(run)) if run.max() < 4096 else np.unique(run)
    k = len(there)
    if k > WIDE:
        one, two = run[run > 0], (run[:-1] << BITS) | run[1:]
        three = (run[:-2] << 2 * BITS) | (run[1:-1] << BITS) | run[2:]
        tagged = np.r_[one | (1 << 60), two | (2 << 60), three[run[1:-1] > 0] | (3 << 60)]
        return np.unique(tagged, return_counts=True)
    to = np.zeros(there[-1] + 1, np.int64)
    to[there] = np.arange(k)  # the blank is 0
    d = to[run]
    n1, n2 = np.bincount(d, minlength=k), np.bincount(d[:-1] * k + d[1:], minlength=k * k)
    n3 = np.bincount((d[:-2] * k + d[1:-1]) * k + d[2:], minlength=k**3).reshape(k, k, k)
    n1[0], n3[:, 0, :] = 0, 0
    n3 = n3.ravel()
    f1, f2, f3 = np.flatnonzero(n1), np.flatnonzero(n2), np.flatnonzero(n3)
    codes = np.r_[
        there[f1] | (1 << 60),
        (there[f2 // k] << BITS) | there[f2 % k] | (2 << 60),
        (there[f3 // (k * k)] << 2 * BITS) | (there[f3 // k % k] << BITS) | there[f3 % k] | (3 << 60),
    ]
    return codes, np.r_[n1[f1], n2[f2], n3[f3]]


def profile(codes: np.ndarray, counts: np.ndarray, top: int = TOP) -> np.ndarray:
    """The most frequent n-grams, best first, ties by code."""
    if len(codes) > top:
        least = np.partition(counts, len(counts) - top)[len(counts) - top]
        keep = counts >= least
        codes, counts = codes[keep], counts[keep]
    return codes[np.lexsort((codes, -counts))[:top]]


def train(rows: DataFrame, top: int = TOP) -> dict[str, np.ndarray]:
    """rows (text, lang) -> each language's profile: at most `top` codes for each value of lang."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}

        def summed(lang):
            codes, where = np.unique(np.concatenate([c for c, _ in held[lang]]), return_inverse=True)
            return codes, np.bincount(where, np.concatenate([n for _, n in held[lang]])).astype(np.int64)

        for text, lang in rows_of(batches):
            grams = ngrams(text)
            if len(grams[0]):
                mine = held.setdefault(lang, [])
                mine.append(grams)
                if len(mine) >= 500:
                    held[lang] = [summed(lang)]
        for lang in held:
            codes, counts = summed(lang)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(codes), pa.string()), pa.array(codes), pa.array(counts)], ["lang", "gram", "n"])

    usable = rows.where("text is not null and lang is not null").select("text", F.col("lang").cast("string"))
    counts = usable.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    first = W.partitionBy("lang").orderBy(F.desc("n"), "gram")
    best = counts.withColumn("place", F.row_number().over(first)).where(F.col("place") <= top).select("lang", "gram", "place").collect()
    found: dict[str, list] = {}
    for r in sorted(best, key=lambda r: (r.lang, r.place)):
        found.setdefault(r.lang, []).append(r.gram)
    return {lang: np.array(grams, np.int64) for lang, grams in found.items()}


class Model:
    """Profiles as one table: for each known n-gram its rank in each language, -1 where the language lacks it."""

    def __init__(self, profiles: dict[str, np.ndarray], top: int = TOP):
        self.langs, self.top = sorted(profiles), top
        self.codes = np.unique(np.concatenate([*profiles.values(), np.zeros(0, np.int64)])).astype(np.int64)
        self.ranks = np.full((len(self.codes), len(self.langs)), -1, np.int32)
        for k, lang in enumerate(self.langs):
            self.ranks[np.searchsorted(self.codes, profiles[lang]), k] = np.arange(len(profiles[lang]))

    def predict(self, text: str | None) -> tuple[str, float]:
        own = profile(*ngrams(text), self.top)
        if not len(own) or not self.langs:
            return UNDECIDED, 0.0
        at = np.minimum(np.searchsorted(self.codes, own), len(self.codes) - 1)
        ranks = np.where((self.codes[at] == own)[:, None], self.ranks[at], -1)
        cost = np.where(ranks < 0, self.top, np.abs(ranks - np.arange(len(own))[:, None])).sum(axis=0)
        best = int(cost.argmin())
        return self.langs[best], float(1 - cost[best] / (self.top * len(own)))


def predictor(profiles: dict[str, np.ndarray], top: int = TOP):
    """A column function text -> struct<lang, score>."""

    @F.pandas_udf("lang string, score double")
    def predict(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = Model(profiles, top)
        for text in texts:
            yield pd.DataFrame([model.predict(t) for t in text], columns=["lang", "score"])

    return predict.asNondeterministic()  # or a filter on the result would be moved below it and predict all texts again


def held_out(doc_id: Column) -> Column:
    """Rows of the test fold: crc32(doc_id as text) mod 4 is 2 (null: not)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, top: int = TOP) -> DataFrame:
    """docs (doc_id, text, lang) -> doc_id, held_out, lang_pred, score; learns from the rows that are not held out."""
    profiles = train(docs.where(~held_out(F.col("doc_id"))).select("text", "lang"), top)
    got = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), predictor(profiles, top)("text").alias("p"))
    return got.select("doc_id", "held_out", F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score"))


def op7_language_id(spark, sf_dir: str) -> DataFrame:
    from tidegauge.llm.common import documents

    return identify(documents(spark, sf_dir))
