"""What the corpus operators share: tables kept in the cluster's shared folder, word splitting, Arrow output."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A-Z to a-z and every ASCII character that is no letter or digit to a space, in UTF-8 bytes.
#: bytes.split() on the result gives the runs of [^\x00-\x2F\x3A-\x60\x7B-\x7F] of the lower-cased text.
ALNUM = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 or 48 <= b <= 57 else 32 for b in range(256)
)


def alnum_words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(ALNUM).split() if text else []


def space_words(text: str | None) -> list[bytes]:
    """Runs of [^\\x20\\x09-\\x0D] after lower-casing A-Z: what bytes.lower() and bytes.split() do."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir. Where it is unset, a local session (tests on one machine) gets one of its
    own; on a cluster that is an error, since executors would each write to their own disk."""
    conf = spark.sparkContext.getConf()
    root = spark.conf.get("spark.checkpoint.dir", None) or conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="tidegauge-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root


#: Spark deletes the shuffle files of a query when it ends; else they stay until the driver happens to collect its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, label: str, compression: str = "snappy") -> DataFrame:
    """Write df once to the shared folder and read it back: cuts the lineage and survives lost executors. The shuffle files of
    the write go with it."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/tidegauge/{label}-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path, compression=compression)
    finally:
        spark.conf.set(CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def forget(df: DataFrame) -> None:
    """Delete a stored table that no later plan reads."""
    path = getattr(df, "_stored_at", None)
    if path:
        jvm, spark = df.sparkSession._jvm, df.sparkSession
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(where, True)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def words_count(text) -> Column:
    """Number of runs of [^\\x20\\x09-\\x0D]; null: 0."""
    spaced = F.translate(F.coalesce(text, F.lit("")), "\t\n\x0b\x0c\r", "     ")
    return F.size(F.filter(F.split(spaced, " "), lambda w: w != "")).cast("long")


def row_hash(df: DataFrame, seed: int = 42) -> Column:
    """A hash of the whole row, whatever its columns are called; columns that hold maps are hashed as JSON."""
    parts = []
    for name, kind in df.dtypes:
        c = df[quoted(name)]
        parts.append(F.to_json(F.struct(c.alias("c"))) if "map<" in kind else c)
    return F.xxhash64(F.lit(seed), *parts)


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def hash_sample(rows: DataFrame, keys: list[str], size: int, seed: int) -> list:
    """At most `size` rows, the first by hash of their keys. The hash of the last one is found from the keys alone, so
    that a task sends the driver its share of the sample only (more where many rows have equal keys)."""
    unit = F.xxhash64(F.lit(seed), *keys)
    last = rows.select(unit.alias("unit")).orderBy("unit").limit(size).agg(F.max("unit")).first()[0]
    return [] if last is None else rows.where(unit <= last).orderBy(unit, *keys).limit(size).collect()


def rows_of(stream: Iterable[pa.RecordBatch], size: int = 256) -> Iterator[tuple]:
    """Rows of Arrow batches as tuples; only `size` of them are Python objects at a time."""
    for b in stream:
        for part in range(0, b.num_rows, size):
            yield from zip(*(c.to_pylist() for c in b.slice(part, size).columns), strict=True)


def batches(rows: Iterable[tuple], schema: pa.Schema, size: int = 20000) -> Iterator[pa.RecordBatch]:
    """Tuples to Arrow batches of bounded size."""
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield _batch(held, schema)
            held = []
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True))
    return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(columns, schema, strict=True)], schema=schema)
