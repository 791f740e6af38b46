"""From raw documents to packed training sequences: language ID, near-duplicates, source mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes each result as Parquet in the cluster's
shared folder and reads it again as the next stage's docs. All stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.llm import jaccard, langid, mixing, packing
from tidegauge.llm.common import documents, quoted, row_hash, stored


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents in which no language can be told (null text, text without a letter, nothing learned) and sets
    `lang` of all others to the predicted language. Rows are judged one by one: repeats and ties are judged alike, whole
    texts whatever their length, other columns are kept as they are.
    """
    profiles = langid.train(docs.where(~langid.held_out(F.col("doc_id"))).select("text", "lang"))
    told = _rows(docs).withColumn("told", langid.predictor(profiles)(F.col("row.text"))["lang"])
    row = F.struct(*[(F.col("told") if c == "lang" else F.col("row")[c]).alias(c) for c in docs.columns])
    return told.where(F.col("told") != langid.UNDECIDED).select(row.alias("row")).select("row.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps of each group of linked documents (five-word shingles alike by 0.8 or more) one with the smallest doc_id.

    Of several rows with that doc_id in a group, one with the smallest hash of its text and row stays, so a copy goes
    even if its doc_id is also the name of another document. Rows without doc_id take a negative id from the hash of
    the row. Null and empty texts are one group; whole texts count, however long; other columns play no part but in
    ties, and no name clashes, since the stage carries rows as one struct.
    """
    id_of = F.coalesce(docs["doc_id"].cast("long"), -F.abs(row_hash(docs) % (1 << 62)) - 1)
    groups = jaccard.near_duplicates(docs.select(id_of.alias("doc_id"), "text"))
    first = groups.groupBy("root").agg(F.min(F.struct("doc_id", "same")).alias("first"))
    first = stored(first.select(F.col("first.doc_id").alias("doc_id"), F.col("first.same").alias("same")), "kept")
    marked = _rows(docs, doc_id=id_of, same=F.xxhash64(docs["text"]), tie=row_hash(docs, 7))
    chosen = marked.join(first, ["doc_id", "same"], "left_semi").groupBy("doc_id", "same").agg(F.min_by("row", "tie").alias("row"))
    return chosen.select("row.*")


def _rows(docs: DataFrame, **more) -> DataFrame:
    """Each row as one struct, beside further columns."""
    return docs.select(F.struct(*[docs[quoted(c)] for c in docs.columns]).alias("row"), *[c.alias(name) for name, c in more.items()])


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: whole rows, repeats included; see mixing for nulls, ties and clashes."""
    return mixing.mixed(docs)


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of at most 1024 ids; see packing for nulls, ties and clashes."""
    return packing.pack(docs)


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("source_mixing", source_mixing),
    ("sequence_packing", sequence_packing),
]

#: Rounding by hash draws, XXH64 fingerprints and BPE ids are beyond SQL; tests/llm compares each stage with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
