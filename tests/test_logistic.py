"""Logistic regressions side by side: known optima, folds left out, and the grid of the query."""

import datetime
import random

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from cellpulse.catalog.model_queries import ml_logistic
from cellpulse.plans import logistic as lo
from cellpulse.plans.features import assemble

INPUTS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(3)
    out = []
    for i in range(400):
        x = [rng.gauss(0, 1) for _ in INPUTS]
        noise = [rng.gauss(0, 1) for _ in range(3)]
        kind = int(np.argmax([x[0] + noise[0], x[1] + noise[1], 0.3 + noise[2]]))
        out.append((i, *x, float(kind == 1), float(kind * 2), i % 5))
    return spark.createDataFrame(out, "id long, a double, b double, c double, y double, "
                                      "y_type double, fold int").coalesce(2).cache()


def test_optima_of_another_solver(rows):
    ready = assemble(INPUTS).transform(rows)
    fits = [lo.Fit(), lo.Fit(0.05, "l1"), lo.Fit(5.0, balanced=True)]
    share = 400 / 2 / F.when(F.col("y") == 1, rows.where("y = 1").count()).otherwise(
        rows.where("y = 0").count())
    for fit, model in zip(fits, lo.fit_all(rows, fits, INPUTS, "y")):
        other = LogisticRegression(
            labelCol="y", regParam=1 / (fit.c * 400), standardization=False, tol=1e-12, maxIter=1000,
            elasticNetParam=float(fit.penalty == "l1"), weightCol="w")
        known = other.fit(ready.withColumn("w", share if fit.balanced else F.lit(1.0)))
        assert model.coefficients[0] == pytest.approx(
            [*known.coefficients.toArray(), known.intercept], abs=2e-3)
    model = lo.fit_all(rows, [lo.Fit()], INPUTS, "y_type")[0]
    known = LogisticRegression(labelCol="_k", regParam=1 / 400, standardization=False, tol=1e-12,
                               maxIter=1000).fit(ready.withColumn("_k", F.col("y_type") / 2))
    assert model.classes == [0.0, 2.0, 4.0]
    assert model.coefficients[:, :-1] == pytest.approx(known.coefficientMatrix.toArray(), abs=2e-3)
    out = lo.transform(rows, model, INPUTS).select("prediction").collect()
    seen = known.transform(ready).select("prediction").collect()
    assert [r[0] for r in out] == [2 * r[0] for r in seen]


def test_a_fold_left_out_does_not_count(rows):
    fits = [lo.Fit(1.0, "l2", True, held=3), lo.Fit(held=0)]
    found = lo.fit_all(rows, fits, INPUTS, "y", "fold")
    for fit, model in zip(fits, found):
        alone = lo.fit_all(rows.where(F.col("fold") != fit.held), [fit._replace(held=-1)], INPUTS, "y")
        assert model.coefficients == pytest.approx(alone[0].coefficients, abs=1e-4)


def test_scores_of_the_grid_come_from_rows_left_out(rows):
    fits = [lo.Fit(), lo.Fit(0.01, "l1")]
    models, scores = lo.grid_search(rows, fits, INPUTS, "y", "id", k=2)
    folded = lo.sampling.folds(rows.drop("fold"), "y", "id", 2).cache()
    for fit in fits:
        each = []
        for i in range(2):
            model = lo.fit_all(folded.where(F.col("fold") != i), [fit], INPUTS, "y")[0]
            out = lo.transform(folded.where(F.col("fold") == i), model, INPUTS).collect()
            hit = sum(r["y"] == r["prediction"] == 1 for r in out)
            each.append(2 * hit / max(1, sum(r["y"] + r["prediction"] for r in out)))
        assert scores[fit] == pytest.approx(sum(each) / 2)
    assert list(models) == fits


def test_separable_and_repeated_columns_end(spark):
    rows = spark.range(300).selectExpr("id", "double(id) / 100 AS a", "double(id) / 100 AS b",
                                       "0D AS c", "double(id > 200) AS y")
    fits = lo.grid(("l1", "l2"))
    assert len(fits) == 20
    for fit, model in zip(fits, lo.fit_all(rows, fits, INPUTS, "y")):
        assert np.isfinite(model.coefficients).all()
        if fit.c == 10:
            wrong = lo.transform(rows, model, INPUTS).where("y <> prediction").count()
            assert wrong <= (30 if fit.balanced or fit.penalty == "l2" else 5)


def test_a_null_label_is_refused(rows):
    with pytest.raises(ValueError):
        lo.fit_all(rows.withColumn("y", F.when(F.col("id") > 3, F.col("y"))), [lo.Fit()], INPUTS, "y")


def test_query_searches_its_grid(spark, tmp_path):
    start = datetime.datetime(2024, 1, 1)
    rng = random.Random(8)
    rows = [(i, start + datetime.timedelta(seconds=31 * i), rng.randrange(40),
             rng.expovariate(1 / 60), '{"k": %d}' % rng.randrange(100)) for i in range(900)]
    spark.createDataFrame(
        rows, "event_id long, ts timestamp_ntz, user_id long, value double, props string"
    ).write.parquet(f"{tmp_path}/events.parquet")
    names = [r["model"] for r in ml_logistic(spark, str(tmp_path)).collect()]
    assert {"l2", "l1", "balanced", "multiclass"} < set(names) and len(names) == 6
    assert sum(n.startswith("tuned") for n in names) == 2
