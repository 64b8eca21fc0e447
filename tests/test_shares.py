"""Growing shares are marked in one pass and training rows are dealt over the cores."""

import os

from pyspark.sql import functions as F

from cellpulse.operators import sampling
from cellpulse.plans import models as md, search as se
from cellpulse.session import dealt, scratch_dir


def _stored(spark, name):
    return sum(f.startswith(f"{name}-") for f in os.listdir(scratch_dir(spark).removeprefix("file:")))


def test_growing_quotas_are_marked_together(spark):
    df = spark.range(900).select("id", (F.col("id") % 10 == 0).cast("double").alias("y"))
    shares = [.05, .3, 1.0]
    quotas = [lambda n, _, s=s: int(s * n) for s in shares]
    got = sampling.mark_quotas(df, "y", "id", quotas).collect()
    assert len(got) == 900
    for i, quota in enumerate(quotas):
        alone = sampling.mark_quota(df, "y", "id", quota).where("picked").collect()
        assert {r["id"] for r in got if r["picked_from"] is not None and r["picked_from"] <= i} == {
            r["id"] for r in alone}


def test_learning_curve_stores_each_training_side_once(spark):
    df = spark.range(200).select("id", (F.col("id") % 3 == 0).cast("double").alias("y"),
                                 F.sin("id").alias("a"))
    before = _stored(spark, "share")
    rows = se.learning_curve(df, lambda: se.by_pipeline(md.stages(md.decision_tree(), ["a"])),
                             "y", "id", [.3, .6, 1.0], k=2).collect()
    assert len(rows) == 24 and _stored(spark, "share") - before == 2


def test_training_rows_are_dealt_evenly(spark):
    one = spark.range(0, 120_000, 1, 1)
    cores = spark.sparkContext.defaultParallelism
    sizes = dealt(one, 120_000).groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) == cores and max(r["count"] for r in sizes) <= 120_000 / cores + cores
    assert dealt(one, 1_000).rdd.getNumPartitions() == 1
