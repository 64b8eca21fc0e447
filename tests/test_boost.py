"""Boosted trees that stop by held rows, on classes a tree can and cannot tell apart."""

import random

from cellpulse.plans import models as md


def test_boost_stops_and_separates_classes(spark):
    rng = random.Random(4)
    rows = []
    for i in range(500):
        kind = rng.randrange(3)
        rows.append((i, rng.gauss(3 * kind, 0.4), rng.random(), kind, float(kind == 2)))
    df = spark.createDataFrame(rows, "id long, a double, b double, y_type int, y double")
    score, rounds = md.boost(df, ["a", "b"], "y_type", classes=3, maxIter=6)
    assert len(rounds) == 3 and max(rounds) <= 6
    out = score(df)
    assert set(df.columns) < set(out.columns)
    assert out.where("prediction = y_type").count() > 480
    score, rounds = md.boost(df, ["a", "b"], maxIter=6)
    assert score(df).where("prediction = y").count() > 485
    # Noise alone: the held rows end the rounds early.
    _, rounds = md.boost(df.withColumn("y", (df.id % 2).cast("double")), ["b"])
    assert rounds[0] < 20


def test_no_held_rows(spark):
    df = spark.createDataFrame([(i, float(i), float(i > 3)) for i in range(8)],
                               "id long, a double, y double")
    score, rounds = md.boost(df, ["a"], share=0.0, maxIter=3)
    assert rounds == [3] and score(df).where("prediction = y").count() == 8
