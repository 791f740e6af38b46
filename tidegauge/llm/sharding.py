"""Sharding by proportional stratified interleaving (law `rows`: shard sizes differ by at most one row).

Rows are ranked within their source in seeded hash order, the fractional rank (rank - 1/2) / n orders all sources
together, and that order is cut into equal runs: every shard holds each source in proportion, to within a row or
two. No window holds a whole source or the whole table: hash order is cut into buckets of about `bucket_rows`,
ranks are taken within a bucket and a prefix sum of the bucket counts is added, which is itself summed in runs of 4096
buckets and then over these runs. Everything is DataFrame code.

Cases: null text has size 1 and the CRC of nothing; null source is a source; rows equal in doc_id and text get
different slots in no fixed order between them; an empty table gives an empty result; only doc_id, text and source
are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tidegauge.llm.common import stored

SHARDS, SEED = 16, 29


def _ranked(rows: DataFrame, group: list[str], bucket: str, order: list[str], out: str) -> DataFrame:
    """row_number within group by (bucket, order), from ranks in each bucket and a prefix sum of bucket counts."""
    counts = stored(rows.groupBy(*group, bucket).agg(F.count("*").alias("c")).withColumn("run", F.floor(F.col(bucket) / 4096).cast("long")), "bucket-counts")
    earlier = lambda x, by, at: F.coalesce(F.sum(x).over(W.partitionBy(*by).orderBy(at).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    runs = counts.groupBy(*group, "run").agg(F.sum("c").alias("n"))
    runs = runs.select(*[F.col(g).alias(f"{g}_r") for g in group], F.col("run").alias("run_r"), earlier("n", group, "run").alias("runs_before"))
    of_run = F.col("run") == F.col("run_r")
    for g in group:
        of_run = of_run & F.col(g).eqNullSafe(F.col(f"{g}_r"))
    before = F.col("runs_before") + F.col("in_run")
    offsets = counts.withColumn("in_run", earlier("c", [*group, "run"], bucket)).join(runs, of_run)
    offsets = stored(offsets.select(*[F.col(g).alias(f"{g}_o") for g in group], F.col(bucket).alias("bucket_o"), before.alias("before")), "offsets")
    within = F.row_number().over(W.partitionBy(*group, bucket).orderBy(*order))
    on = F.col(bucket) == F.col("bucket_o")
    for g in group:
        on = on & F.col(g).eqNullSafe(F.col(f"{g}_o"))
    return rows.withColumn("within", within).join(offsets, on).withColumn(out, F.col("before") + F.col("within")).drop("within", "before", "bucket_o", *[f"{g}_o" for g in group])


def interleave(docs: DataFrame, shards: int = SHARDS, seed: int = SEED, bucket_rows: int = 4096) -> DataFrame:
    """docs (doc_id, text, source) -> doc_id, source, size, text_crc32, shard, slot."""
    text = F.coalesce("text", F.lit(""))
    thin = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    thin = stored(thin.withColumn("h", F.xxhash64(F.lit(seed), "doc_id", "text_crc32", "size")), "rows")
    per = stored(thin.groupBy(F.col("source").alias("s")).agg(F.count("*").alias("n")), "source-counts")
    total = per.agg(F.sum("n")).first()[0] or 0
    unit = F.pmod(F.col("h"), F.lit(1 << 40)) / F.lit(float(1 << 40))
    rows = thin.join(per, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    rows = rows.withColumn("u", unit).withColumn("b", F.floor(F.col("u") * F.ceil(F.col("n") / F.lit(float(bucket_rows)))).cast("long"))
    rows = _ranked(rows, ["source"], "b", ["u", "h", "doc_id"], "rank")
    rows = rows.withColumn("f", (F.col("rank") - 0.5) / F.col("n")).withColumn("b", F.floor(F.col("f") * max(1, -(-total // bucket_rows))).cast("long"))
    rows = _ranked(stored(rows.drop("u"), "fractions"), [], "b", ["f", "source", "h", "doc_id"], "place")
    small, more = divmod(total, shards)  # the first `more` shards have one row more
    at = F.col("place") - 1
    edge = more * (small + 1)
    shard = F.when(at < edge, F.floor(at / F.lit(small + 1))).otherwise(more + F.floor((at - edge) / F.lit(max(small, 1))))
    rows = rows.withColumn("shard", shard.cast("int"))
    start = F.col("shard") * small + F.least("shard", F.lit(more))
    return rows.select("doc_id", "source", "size", "text_crc32", "shard", (F.col("place") - 1 - start).cast("long").alias("slot"))


def op5_sharding(spark, sf_dir: str) -> DataFrame:
    from tidegauge.llm.common import documents

    out = interleave(documents(spark, sf_dir))
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
