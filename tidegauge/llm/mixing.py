"""Mixing sources to target weights by pivotal dependent rounding.

Sources in code-point order (null last) weigh 1, 2, 3, repeating, and share all words; no target exceeds `cap` times
its source, what is cut being reshared by weight (closed form over the sources sorted by cap per weight). A document's
expected copies are target / source size: the whole part is certain, the rest is a probability p. Pivotal rounding
pairs two open documents and randomly moves words (p * size) from one to the other until one is taken or dropped
for certain; expectations and the source's words stay the same. Documents are dealt to buckets of about `bucket_rows`
by hash, each bucket is rounded as a sorted stream that leaves one open document, and these residuals are combined
bucket by bucket, `fan_in` at a time, up a reduction tree to one for each source: the mix misses a target by less than
one document, as a rule a short one, since each stream runs from long to short. All draws are hashes of the seed, the
level and the documents, never of their place in a file or batch, so reruns agree.

Cases: null text has size 0; an empty document is drawn by itself (it moves no words) from its doc_id, its keys and its
number among its equals; null source is a source of its own; rows that are equal in doc_id, source and size are
interchangeable in mix(); an empty table gives an empty result; other columns are not read here, and mixed() packs them
into one struct, so their names cannot clash. mixed() tells rows apart by 128 bits of hash.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from tidegauge.llm.common import quoted, row_hash, stored, words_count

WEIGHTS, CAP, SEED = (1, 2, 3), 3, 17


def targets(sizes: DataFrame, weights=WEIGHTS, cap: int = CAP) -> DataFrame:
    """sizes (source, source_size): one row for each source -> with target and copies (target / source_size)."""
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    place = (F.row_number().over(by_name) - 1) % len(weights)
    weighed = sizes.withColumn("weight", F.element_at(F.lit(list(weights)), place + 1).cast("double"))
    # Sorted by cap / weight, the capped sources come first. k is capped iff its cap is below its share of what they leave.
    order = W.orderBy((F.col("source_size") * cap / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    before, everything = order.rowsBetween(W.unboundedPreceding, -1), W.orderBy(F.lit(0)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    total = F.sum("source_size").over(everything).cast("double")
    used = F.coalesce(F.sum(F.col("source_size") * cap).over(before), F.lit(0)).cast("double")
    left = F.sum("weight").over(order.rowsBetween(0, W.unboundedFollowing))
    most = (F.col("source_size") * cap).cast("double")
    share = weighed.select("*", (total - used).alias("rest"), left.alias("open_weight"), most.alias("most"))
    share = share.withColumn("capped", F.col("most") * F.col("open_weight") <= F.col("rest") * F.col("weight"))
    # Every source that is not capped gets its weight's part of what the capped ones leave.
    all_rows = W.orderBy(F.lit(0)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    taken = F.coalesce(F.sum(F.when(F.col("capped"), F.col("most"))).over(all_rows), F.lit(0.0))
    open_weight = F.sum(F.when(~F.col("capped"), F.col("weight"))).over(all_rows)
    share = share.withColumn("target", F.when(F.col("capped"), F.col("most")).otherwise(F.try_divide((F.sum("source_size").over(all_rows) - taken) * F.col("weight"), open_weight)))
    copies = F.when(F.col("source_size") == 0, 0.0).when(F.col("capped"), float(cap)).otherwise(F.col("target") / F.col("source_size"))
    return share.select("source", "source_size", "target", copies.alias("expected"))


def _draw(*what) -> float:
    return xxhash.xxh64_intdigest(repr(what).encode()) / 2.0**64


def _pair(mass_i: float, size_i: float, mass_j: float, size_j: float, draw: float) -> tuple[float, float]:
    """Move words between two open documents until one holds none or all of its own; means stay."""
    to_i, to_j = min(size_i - mass_i, mass_j), min(mass_i, size_j - mass_j)
    if draw * (to_i + to_j) < to_j:
        return (size_i if to_i == size_i - mass_i else mass_i + to_i), (0.0 if to_i == mass_j else mass_j - to_i)
    return (0.0 if to_j == mass_i else mass_i - to_j), (size_j if to_j == size_j - mass_j else mass_j + to_j)


def _round(batches: Iterator[pa.RecordBatch], schema: pa.Schema, level: int, last: bool, seed: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (source, bucket): sets `extra` of all rows but each bucket's residual, whose `mass` is set anew.

    At most one open document is held; it waits as a slice of its own batch.
    """
    run, held = None, None  # held: its row (a table slice), mass, size, doc_id
    names = [f.name for f in schema if f.name in ("source", "bucket", "size", "mass", "doc_id") or f.name.startswith("key")]
    own = [n for n in names if n.startswith("key")]
    same, times = None, 0  # the last empty document and how many equal ones came before it

    def with_result(rows: pa.RecordBatch, extra: list, mass: list) -> pa.RecordBatch:
        out = [pa.array(extra, pa.int32()) if f.name == "extra" else pa.array(mass, pa.float64()) if f.name == "mass" else rows.column(f.name) for f in schema]
        return pa.RecordBatch.from_arrays(out, schema=schema)

    def settle():
        row, mass, size, doc_id = held
        if last:
            return with_result(row, [int(_draw(seed, "last", doc_id, size) * size < mass)], [None])
        return with_result(row, [None], [mass])

    for batch in batches:
        cols = {n: batch.column(n).to_pylist() for n in names}
        n = batch.num_rows
        extra, mass, here = [None] * n, cols["mass"], None
        keep = [True] * n
        for i in range(n):
            key = (cols["source"][i], cols["bucket"][i])
            if key != run:
                if held is not None:
                    yield settle()
                elif here is not None and last:
                    extra[here], mass[here] = int(_draw(seed, "last", cols["doc_id"][here], cols["size"][here]) * cols["size"][here] < mass[here]), None
                run, held, here = key, None, None
            size, m, doc_id = cols["size"][i], mass[i], cols["doc_id"][i]
            if size == 0:
                this = (*key, doc_id, *(cols[c][i] for c in own))
                same, times = this, times + 1 if this == same else 0
                extra[i], mass[i] = int(_draw(seed, "empty", doc_id, *this[3:], times) < m), None
            elif m <= 0 or m >= size:
                extra[i], mass[i] = int(m >= size), None
            elif held is None and here is None:
                here = i
            else:
                row, m0, s0, id0 = held or (None, mass[here], cols["size"][here], cols["doc_id"][here])
                a, b = _pair(m0, s0, m, size, _draw(seed, level, id0, s0, doc_id, size))
                first_done, second_done = a in (0.0, s0), b in (0.0, size)
                if first_done:
                    if row is not None:
                        yield with_result(row, [int(a == s0)], [None])
                    else:
                        extra[here], mass[here] = int(a == s0), None
                    held = here = None
                elif row is not None:
                    held = (row, a, s0, id0)
                else:
                    mass[here] = a
                if second_done:
                    extra[i], mass[i] = int(b == size), None
                else:
                    mass[i], here, held = b, i, None
        if here is not None:  # the open document waits for the next batch
            held = (batch.slice(here, 1), mass[here], cols["size"][here], cols["doc_id"][here])
            keep[here] = False
            here = None
        done = pa.array(keep)
        if any(keep):
            yield pa.RecordBatch.from_arrays([c for c in with_result(batch, extra, mass).filter(done).columns], schema=schema)
    if held is not None:
        yield settle()


def mix(docs: DataFrame, weights=WEIGHTS, cap: int = CAP, seed: int = SEED, bucket_rows: int = 2048, fan_in: int = 16, keys: tuple[Column, ...] = ()) -> DataFrame:
    """docs (doc_id, text, source) -> doc_id, source, size, source_size, target, copies, and key0, key1, ... (longs) if keys are given."""
    own = [k.cast("long").alias(f"key{i}") for i, k in enumerate(keys)]
    # Where doc_id is missing, the text deals the rows.
    place = F.pmod(F.xxhash64(F.lit(seed), "doc_id", F.when(F.col("doc_id").isNull(), F.col("text")), *keys), F.lit(1 << 30)) / F.lit(float(1 << 30))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), words_count(F.col("text")).alias("size"), place.alias("place"), *own)
    rows = stored(rows, "sizes")
    sums = stored(rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n")), "sources")
    most = sums.agg(F.max("n")).first()[0]
    goal = stored(targets(sums.select("source", "source_size"), weights, cap), "targets").join(sums.select(F.col("source").alias("s"), "n"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    goal = stored(goal.withColumnRenamed("source", "of"), "goals")
    rows = rows.join(goal, F.col("source").eqNullSafe(F.col("of"))).drop("of")
    whole = F.least(F.floor("expected"), F.lit(cap)).cast("int")
    rows = rows.select(
        "*", whole.alias("whole"), ((F.col("expected") - F.floor("expected")) * F.greatest("size", F.when(F.col("size") == 0, 1).otherwise(0))).alias("mass"),
        F.floor(F.col("place") * F.ceil(F.col("n") / F.lit(float(bucket_rows)))).cast("long").alias("bucket"), F.lit(None).cast("int").alias("extra"),
    ).drop("n")
    levels = 1 + (math.ceil(math.log(max(1, math.ceil(most / bucket_rows))) / math.log(fan_in) - 1e-9) if most else 0)
    open_rows, parts, schema, named = rows, [], rows.schema, [f"key{i}" for i in range(len(keys))]
    arrow = _arrow_schema(schema)
    for level in range(levels):
        last = level == levels - 1
        if level:
            open_rows = open_rows.withColumn("bucket", F.floor(F.col("bucket") / fan_in).cast("long"))
        dealt = open_rows.repartition("source", "bucket").sortWithinPartitions("source", "bucket", F.desc("size"), "place", "doc_id", *named)
        out = stored(dealt.mapInArrow(lambda it, k=level, z=last: _round(it, arrow, k, z, seed), schema), f"level{level}")
        parts.append(out.where("extra is not null"))
        open_rows = out.where("extra is null")
    done = parts[0]
    for p in parts[1:]:
        done = done.union(p)
    copies = F.least(F.col("whole") + F.col("extra"), F.lit(cap)).cast("int")
    keep = ["doc_id", "source", "size", "source_size", "target", copies.alias("copies")]
    return done.select(*keep, *named)


def mixed(docs: DataFrame, **how) -> DataFrame:
    """The rows of docs as often as the mix takes them. Texts do not go through the rounding: equal rows are collapsed
    by two hashes of the whole row before the shuffle, and joined with the copies that all of them together are taken."""
    keys = (row_hash(docs, 42), row_hash(docs, 43))
    taken = stored(mix(docs, keys=keys, **how).groupBy("key0", "key1").agg(F.sum("copies").cast("int").alias("copies")).where("copies > 0"), "taken")
    rows = docs.select(keys[0].alias("key0"), keys[1].alias("key1"), F.struct(*[docs[quoted(c)] for c in docs.columns]).alias("row"))
    once = rows.groupBy("key0", "key1").agg(F.first("row").alias("row"))
    return once.join(taken, ["key0", "key1"]).select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")


def _arrow_schema(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def op4_mixing(spark, sf_dir: str) -> DataFrame:
    from tidegauge.llm.common import documents

    out = mix(documents(spark, sf_dir))
    return out.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))
