"""Sinks: Parquet by year, CSV with fixed number formats, tables; column tiers, type narrowing, metadata, reports."""

from __future__ import annotations

import json
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.quantiles import quantiles
from tidegauge.sources import files

CODECS = {"none": None, "gzip": "gzip", "bz2": "bzip2"}
#: Integer types by range (strict bounds, unsigned ones widened).
NARROW = [(0, 255, "short"), (0, 65535, "int"), (-128, 127, "byte"), (-32768, 32767, "short")]


def file_name(tier: str, version: str, day: date | None = None) -> str:
    return f"{tier}_{(day or date.today()):%Y%m%d}_{version}"


def tier_columns(df: DataFrame, wanted: list[str], always: list[str]) -> DataFrame:
    """Columns whose name holds one of the tier's names, keys and target first; all of them if none does."""
    picked = list(dict.fromkeys([c for c in always if c in df.columns] + [c for w in wanted for c in df.columns if w in c]))
    return df.select(*picked) if len(picked) > len([c for c in always if c in df.columns]) else df


def narrow_types(df: DataFrame) -> DataFrame:
    """Whole doubles and integers to the least type that holds them, other doubles below 1e6 to float, text that is 0 or 1 only
    (no NULL) to boolean; one aggregation."""
    xs = [c for c, t in df.dtypes if t in ("double", "bigint", "int")]
    texts = [c for c, t in df.dtypes if t == "string"]
    if not xs and not texts:
        return df
    bits = [F.bool_and(F.coalesce(F.col(c).isin("0", "1"), F.lit(False))).alias(c) for c in texts]
    row = df.agg(*bits, *[F.struct(F.min(x).alias("lo"), F.max(x).alias("hi"), F.count_if(F.col(x).isNull()).alias("nulls"), F.bool_and(F.col(x) == F.floor(x)).alias("whole")).alias(x) for x in xs]).first()
    casts = {c: F.col(c) == "1" for c in texts if row[c]}
    for x in xs:
        s = row[x]
        if s.lo is None:
            continue
        if s.whole and not s.nulls:
            kind = next((t for lo, hi, t in NARROW if (s.lo >= lo if lo == 0 else s.lo > lo) and (s.hi <= hi if lo == 0 else s.hi < hi)), None)
        else:
            kind = "float" if max(abs(s.lo), abs(s.hi)) < 1e6 and dict(df.dtypes)[x] == "double" else None
        if kind:
            casts[x] = F.col(x).cast(kind)
    return df.withColumns(casts)


def write_csv(df: DataFrame, path: str, compression: str = "none", single: bool = False) -> dict:
    """Doubles with six decimals, ISO dates, a header. `single` puts small results into one file."""
    if compression not in CODECS:
        raise ValueError(f"no codec for {compression!r}; there are {sorted(CODECS)}")
    out = df.withColumns({c: F.format_string("%.6f", F.col(c).cast("double")) for c, t in df.dtypes if t in ("double", "float")})
    writer = (out.coalesce(1) if single else out).write.mode("overwrite").option("header", True).option("dateFormat", "yyyy-MM-dd")
    (writer.option("compression", CODECS[compression]) if CODECS[compression] else writer).csv(path)
    return {"path": path, "format": "csv", "columns": df.columns}


def write_parquet(df: DataFrame, path: str, years: str = "all") -> dict:
    """One folder a year. `years`: "all" replaces everything there; "given" replaces the years that df has and leaves the others, as
    daily runs and backfills need it. A given year is replaced as a whole: df must hold all of its rows."""
    if years not in ("all", "given"):
        raise ValueError(f"years are 'all' or 'given', not {years!r}")
    mode = "dynamic" if years == "given" else "static"
    writer = df.withColumn("year", F.year("date")).write.mode("overwrite").option("compression", "snappy").option("partitionOverwriteMode", mode)
    writer.partitionBy("year").parquet(path)
    return {"path": path, "format": "parquet", "columns": df.columns}


def replace_since(df: DataFrame, path: str, since: date) -> dict:
    """df (dates from `since` on) in place of what a stored target has from that date on; earlier rows stay.

    The target's columns are written; those that df lacks are NULL from `since` on. The year that `since` lies in is written anew from its stored rows before `since` and df's; older years are not read.
    """
    spark = df.sparkSession
    stored = spark.read.parquet(path)
    kept = stored.where((F.col("year") == since.year) & (F.col("date") < F.lit(since))).drop("year")
    mine = [F.col(c).cast(t) if c in df.columns else F.lit(None).cast(t).alias(c) for c, t in kept.dtypes]
    both = kept.unionByName(df.where(F.col("date") >= F.lit(since)).select(*mine))
    aside = files.shared_path(spark, "replaced")  # the target cannot be read while it is overwritten
    both.write.parquet(aside)
    return write_parquet(spark.read.schema(both.schema).parquet(aside), path, "given")


def write_table(df: DataFrame, name: str) -> dict:
    df.write.mode("overwrite").saveAsTable(name)
    return {"path": name, "format": "table", "columns": df.columns}


SINKS = {"csv": write_csv, "parquet": write_parquet, "database": write_table}


def export(df: DataFrame, target: str, kind: str, **how) -> dict:
    if kind not in SINKS:
        raise ValueError(f"no sink for {kind!r}; there are {sorted(SINKS)}")
    return SINKS[kind](df, target, **how)


def export_all(frames: dict[str, DataFrame], folder: str, kind: str) -> dict[str, dict]:
    return {name: export(df, f"{folder}/{name}", kind) for name, df in frames.items()}


def metadata(df: DataFrame, most: int = 20) -> str:
    """Shape, dates, types, null counts and statistics of the first numeric columns as JSON."""
    numeric = [c for c, t in df.dtypes if t in ("double", "float", "int", "bigint")][:most]
    aggs = [F.count("*").alias("rows")] + [F.count_if(F.col(c).isNull()).alias(f"nulls|{c}") for c in df.columns]
    aggs += [F.struct(F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"), F.min(c).cast("double").alias("min"), F.max(c).cast("double").alias("max")).alias(f"stats|{c}") for c in numeric]
    if "date" in df.columns:
        aggs += [F.min("date").cast("string").alias("first"), F.max("date").cast("string").alias("last")]
    row = df.agg(*aggs).first().asDict(recursive=True)
    if numeric:
        quartiles = quantiles(df, numeric, [0.25, 0.5, 0.75]).first().asDict()
        for c in numeric:
            row[f"stats|{c}"]["quartiles"] = quartiles[f"_q_{c}"]
    return json.dumps({
        "rows": row["rows"], "columns": len(df.columns), "dates": [row.get("first"), row.get("last")], "types": dict(df.dtypes),
        "nulls": {c: row[f"nulls|{c}"] for c in df.columns}, "statistics": {c: row[f"stats|{c}"] for c in numeric},
    })


def report(checks: DataFrame, path: str) -> dict:
    """Check rows (quality.verdicts) as JSON lines."""
    checks.select(F.to_json(F.struct(*checks.columns)).alias("value")).write.mode("overwrite").text(path)
    return {"path": path, "format": "json"}
