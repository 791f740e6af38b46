"""What stored tables leave on disk while a corpus operator runs."""

import os
import time

from pyspark.sql import functions as F

from tidegauge.llm import common, jaccard


def _shuffle_files(spark) -> int:
    tops = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return sum(name.startswith("shuffle_") and name.endswith(".data") for top in tops for _, _, names in os.walk(top) for name in names)


def test_stored_tables_leave_no_shuffle_files(spark):
    before, kept = _shuffle_files(spark), spark.conf.get(common.CLEANUP)
    rows = spark.range(5000).select((F.col("id") % 17).alias("k"), "id").repartition("k")
    out = common.stored(rows.join(rows.groupBy("k").agg(F.max("id").alias("last")), "k"), "joined")
    for _ in range(50):
        if _shuffle_files(spark) <= before:
            break
        time.sleep(0.1)
    assert _shuffle_files(spark) <= before and spark.conf.get(common.CLEANUP) == kept
    assert out.count() == 5000 and common.stored(out.groupBy("k").count(), "again").count() == 17


def test_only_sets_of_candidate_pairs_are_stored(spark, monkeypatch):
    """Texts that share a passage meet in the prefixes; sets are written for those that may be near, whatever their doc_ids."""
    passage = "this passage stands in all of these texts and none of them is near another for that"
    own = lambda k, n=40: " ".join(f"w{k}x{i}" for i in range(n))
    rows = [(k % 50, f"{passage} {own(k)}") for k in range(300)] + [(1, f"{own(1000)} {own(1001)}"), (2, f"{own(1000)} {own(1001)} more")] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    held = []

    def noted(df, label, *more, stored=common.stored):
        out = stored(df, label, *more)
        held.extend([out.count()] * label.endswith("sets"))
        return out

    monkeypatch.setattr(jaccard, "stored", noted)
    got = jaccard.near_duplicates(docs).collect()
    assert len(got) == 306 and len({r.root for r in got}) == 301
    assert held and max(held) <= 4
