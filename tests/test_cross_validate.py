"""Cross-validation reads its rows in a bounded number of tasks."""

import pytest
from pyspark.ml import Pipeline

from cellpulse.plans import models as md


class Seen(Exception):
    pass


def test_tasks_do_not_grow_with_the_rows(spark, monkeypatch):
    class Watched(md.CrossValidator):
        def fit(self, dataset):
            raise Seen(dataset.rdd.getNumPartitions(), dataset.count())
    monkeypatch.setattr(md, "CrossValidator", Watched)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "512")
    try:
        df = spark.range(20_000).selectExpr("id", "double(id % 2) AS y", "rand(1) AS f_x")
        model = md.logistic(20_000)
        steps = md.stages(model, ["f_x"])
        with pytest.raises(Seen) as seen:
            md.cross_validate(df, Pipeline(stages=steps), [{model.regParam: 0.1}], "y", "id")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    tasks, rows = seen.value.args
    assert rows == 20_000
    assert tasks <= max(16, 2 * spark.sparkContext.defaultParallelism)
