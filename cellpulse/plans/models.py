"""Supervised models on Spark ML: fitting, search, importances, storage."""

import itertools
import random
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier, GBTClassifier, LinearSVC, LogisticRegression, OneVsRest,
    RandomForestClassifier)
from pyspark.ml.evaluation import (
    BinaryClassificationEvaluator, MulticlassClassificationEvaluator)
from pyspark.ml.feature import PCA, StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import DataFrame, SparkSession, functions as F

from cellpulse.operators import sampling
from cellpulse.plans import evaluation as ev
from cellpulse.plans.features import assemble, with_class_weight
from cellpulse.session import materialise, small_table


BINS = 128  # candidate cuts per feature; the default of 32 misses rare classes


def decision_tree(label="y", weight=None, **params):
    """Depth 10, at least 10 rows per leaf, as in the stand-alone trainer."""
    options = {"maxDepth": 10, "minInstancesPerNode": 10, "maxBins": BINS, "seed": 42, **params}
    return _weighted(DecisionTreeClassifier(labelCol=label, **options), weight)


def random_forest(label="y", weight=None, **params):
    options = {"numTrees": 150, "maxDepth": 10, "featureSubsetStrategy": "sqrt",
               "subsamplingRate": 1.0, "maxBins": BINS, "seed": 42, **params}
    return _weighted(RandomForestClassifier(labelCol=label, **options), weight)


def gradient_boosting(label="y", **params):
    """Boosted trees, up to 100 rounds; ``boost`` adds the rows that say when to stop."""
    options = {"maxIter": 100, "maxDepth": 3, "stepSize": 0.1, "maxBins": BINS, "seed": 42,
               **params}
    return GBTClassifier(labelCol=label, **options)


def boost(train: DataFrame, inputs: list, label="y", classes: int = 2, key: str = "id",
          share: float = 0.1, parallelism: int = 4, **params):
    """Fit boosted trees that stop once a held share of the rows, by a hash of the key, gains nothing.

    Returns a function that adds ``prediction``. More than two classes are fitted one against the
    rest, each with its own number of rounds, and the largest margin wins.
    """
    steps = assemble(inputs)
    held = F.pmod(F.xxhash64(F.col(key), F.lit("boost")), F.lit(1000)) < int(share * 1000)
    rows = materialise(steps.transform(train).select(
        "features", F.col(label).cast("double").alias("_y"), held.alias("_held")), "boost")
    values = [1] if classes == 2 else list(range(classes))
    watch = {"validationIndicatorCol": "_held"} if rows.where("_held").limit(1).count() else {}

    def one(value):
        model = (gradient_boosting("_is", **watch, **params).setPredictionCol(f"_p{value}")
                 .setRawPredictionCol(f"_m{value}").setProbabilityCol(f"_q{value}"))
        return model.fit(rows.withColumn("_is", (F.col("_y") == value).cast("double")))
    with ThreadPool(parallelism) as pool:
        fitted = pool.map(inheritable_thread_target(train.sparkSession)(one), values)

    def score(df: DataFrame) -> DataFrame:
        out = steps.transform(df)
        for model in fitted:
            out = model.transform(out)
        margins = [F.element_at(vector_to_array(f"_m{v}"), 2) for v in values]
        if classes == 2:
            best = (margins[0] > 0).cast("double")
        else:
            every = F.array(*margins)
            best = (F.array_position(every, F.array_max(every)) - 1).cast("double")
        return out.withColumn("prediction", best).select(*df.columns, "features", "prediction")
    return score, [model.getNumTrees for model in fitted]


def logistic(n_rows: int, label="y", c=1.0, penalty="l2", weight=None, **params):
    """Inverse strength ``c`` over summed losses equals regParam 1 / (c * n) over the mean."""
    options = {"maxIter": 1000, **params}  # stops earlier at its tolerance
    return _weighted(LogisticRegression(
        labelCol=label, regParam=1.0 / (c * n_rows),
        elasticNetParam=1.0 if penalty == "l1" else 0.0, **options), weight)


def linear_svm(n_rows: int, label="y", classes=2, c=1.0, **params):
    # Stops earlier at its tolerance.
    options = {"maxIter": 3000, "regParam": 1.0 / (c * n_rows), **params}
    model = LinearSVC(labelCol=label, **options)
    return model if classes == 2 else OneVsRest(classifier=model, labelCol=label, parallelism=4)


def _weighted(model, weight):
    return model.setWeightCol(weight) if weight else model


def fit(model, train: DataFrame, inputs: list, scale: bool = False, pca: int = None):
    """Fit assembler, optional scaler and projection, and the model as one unit.

    Every stage learns from the training rows only and is stored with the model, so serving
    applies the same transforms.
    """
    return Pipeline(stages=stages(model, inputs, scale, pca)).fit(train)


def stages(model, inputs: list, scale: bool = False, pca: int = None) -> list:
    steps, column = [assemble(inputs, "raw" if scale or pca else "features")], "raw"
    if scale:
        out = "scaled" if pca else "features"
        steps.append(StandardScaler(inputCol=column, outputCol=out, withMean=True))
        column = out
    if pca:
        steps.append(PCA(k=pca, inputCol=column, outputCol="features"))
    return steps + [model]


def probability_of(df: DataFrame, cls: int = 1):
    """Score for a class: its probability, or the margin where the model has none."""
    source = "probability" if "probability" in df.columns else "rawPrediction"
    return F.element_at(vector_to_array(source), cls + 1)


def binary_scores(scored: DataFrame, label: str = "y") -> DataFrame:
    """Threshold metrics and ranking scores of a binary model in one row."""
    ranked = scored.withColumn("score", probability_of(scored))
    one = F.lit(1).alias("_one")
    return (ev.binary_metrics(ranked, label, "prediction").select("*", one)
            .join(ev.ranking_scores(ranked, label, "score").select("*", one), "_one").drop("_one"))


def summary_scores(scored: DataFrame, label: str) -> DataFrame:
    """Accuracy and support-weighted means of a multiclass model in one row."""
    lines = ev.report(scored, label, "prediction")
    return lines.where(F.col("class").isin("weighted avg", "accuracy")).agg(
        F.max(F.when(F.col("class") == "accuracy", F.col("f1"))).alias("accuracy"),
        *[F.max(F.when(F.col("class") == "weighted avg", F.col(m))).alias(m)
          for m in ("precision", "recall", "f1")])


def importances(model: PipelineModel, inputs: list, n: int = None) -> DataFrame:
    """Features by importance with their rank; ``n`` keeps the first ones (one row per feature)."""
    fitted = model.stages[-1]
    pairs = sorted(zip(inputs, fitted.featureImportances.toArray().tolist()),
                   key=lambda p: (-p[1], p[0]))
    rows = [(name, value, i + 1, value > 0.05, value < 0.001)
            for i, (name, value) in enumerate(pairs)]
    return small_table(
        SparkSession.active(),
        "feature string, importance double, rank int, strong boolean, negligible boolean", rows[:n])


def save(model: PipelineModel, path: str):
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


# ---- search --------------------------------------------------------------

def grid(options: dict) -> list:
    """All combinations of {param: values} as param maps."""
    params = list(options)
    return [dict(zip(params, values)) for values in itertools.product(*options.values())]


def random_grid(options: dict, n: int, seed: int = 42) -> list:
    every = grid(options)
    return random.Random(seed).sample(every, min(n, len(every)))


def cross_validate(df: DataFrame, pipeline: Pipeline, maps: list, label: str, key: str,
                   k: int = 3, metric: str = "f1", parallelism: int = 4):
    """Stratified k-fold search; returns (table of mean and spread per candidate, best model).

    Each step of a solver sends a result per task to the driver, so the stored rows are read in
    a number of tasks that follows the cores and not the rows.
    """
    spark = df.sparkSession
    folded = materialise(sampling.folds(df, label, key, k), "folds").coalesce(
        max(16, 2 * spark.sparkContext.defaultParallelism))
    if metric == "areaUnderROC":
        judge = BinaryClassificationEvaluator(labelCol=label, metricName=metric)
    else:
        judge = MulticlassClassificationEvaluator(labelCol=label, metricName=metric)
    search = CrossValidator(estimator=pipeline, estimatorParamMaps=maps, evaluator=judge,
                            numFolds=k, foldCol="fold", parallelism=parallelism)
    found = search.fit(folded)
    names = [", ".join(f"{p.name}={v}" for p, v in sorted(m.items(), key=lambda e: e[0].name))
             for m in maps]
    best = max(found.avgMetrics) if judge.isLargerBetter() else min(found.avgMetrics)
    rows = [(name, metric, float(mean), float(std), bool(mean == best))
            for name, mean, std in zip(names, found.avgMetrics, found.stdMetrics)]
    table = small_table(
        df.sparkSession, "candidate string, metric string, mean double, std double, best boolean",
        rows)
    return table, found.bestModel


# ---- kernel approximation ------------------------------------------------

def fourier_features(df: DataFrame, inputs: list, gamma: float, size: int = 128,
                     seed: int = 42) -> DataFrame:
    """Random Fourier features of an RBF kernel as ``features``; inputs should be scaled."""
    import numpy as np
    rng = np.random.default_rng(seed)
    w = rng.normal(0.0, np.sqrt(2.0 * gamma), (len(inputs), size))
    b = rng.uniform(0.0, 2.0 * np.pi, size)

    @F.pandas_udf("array<double>")
    def lift(x):
        import numpy as np
        import pandas as pd
        z = np.sqrt(2.0 / size) * np.cos(np.stack(x.to_numpy()) @ w + b)
        return pd.Series(list(z))
    return df.withColumn("features", array_to_vector(
        lift(F.array(*[F.col(c).cast("double") for c in inputs]))))


def balanced(df: DataFrame, label: str) -> DataFrame:
    return with_class_weight(df, label)
