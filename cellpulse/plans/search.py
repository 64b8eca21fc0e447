"""Model search on shared folds with several metrics, learning curves and calibration.

Folds are dealt once and stored. A candidate is a function of (train, test) that returns the test
rows with ``prediction`` and ``score``; everything it learns comes from the training rows, so
scalings and neighbours cannot leak. The predictions of all candidates on all folds are stored,
and one pass over them gives every metric of every candidate and fold.
"""

import threading
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window, functions as F

from cellpulse.operators import neighbors, sampling
from cellpulse.plans import features as fe
from cellpulse.session import materialise

METRICS = ["accuracy", "precision", "recall", "f1"]


def by_pipeline(steps: list):
    """Candidate of Spark ML stages; the score is the last class's probability or margin."""
    def run(train: DataFrame, test: DataFrame) -> DataFrame:
        out = Pipeline(stages=steps).fit(train).transform(test)
        source = "probability" if "probability" in out.columns else "rawPrediction"
        return out.withColumn("score", F.element_at(vector_to_array(source), -1))
    return run


def neighbour_search(inputs: list, label: str, key: str, k: int, metric: str = "euclidean"):
    """Scaled neighbours of the test among the training rows, found once for each pair of sides.

    Candidates with up to ``k`` neighbours share it.
    """
    found, lock = {}, threading.Lock()

    def look(train: DataFrame, test: DataFrame):
        with lock:
            own = found.setdefault((id(train), id(test)), {"lock": threading.Lock()})
        with own["lock"]:  # other sides are searched meanwhile
            if "rows" not in own:
                scale = fe.standard_scaler(train, inputs)
                vec = F.array(*[F.col(c).cast("double") for c in inputs]).alias("x")
                refs, asked = (materialise(scale(d).select(key, label, vec), "vectors")
                               for d in (train, test))
                near = materialise(neighbors.knn(asked, refs, k, "x", key, metric), "near")
                # The sides are kept with the rows, so that their ids stay theirs.
                own["rows"], own["sides"] = (refs, asked, near), (train, test)
            return own["rows"]
    return look


def by_neighbours(inputs: list, label: str, key: str, k: int, weights: str = "uniform",
                  metric: str = "euclidean", search=None):
    """Candidate of scaled nearest neighbours; the score is the share of votes for the result.

    ``search`` is a ``neighbour_search`` for ``k`` or more neighbours to share.
    """
    search = search or neighbour_search(inputs, label, key, k, metric)

    def run(train: DataFrame, test: DataFrame) -> DataFrame:
        refs, asked, near = search(train, test)
        near = near.where(F.col("rank") <= k)
        labels = refs.select(F.col(key).alias("n_id"), F.col(label).alias("label"))
        votes = neighbors.knn_vote(near, labels, [k], weights)
        share = near.join(labels, "n_id").groupBy("id").agg(F.avg("label").alias("score"))
        both = votes.join(share, "id").select(F.col("id").alias(key), "prediction", "score")
        return asked.select(key, label).join(both, key)
    return run


def fold_predictions(df: DataFrame, candidates: dict, label: str, key: str, k: int = 3,
                     parallelism: int = 4) -> DataFrame:
    """Stored (candidate, fold, key, label, prediction, score): each row predicted out of fold."""
    folded = materialise(sampling.folds(df, label, key, k), "folds")
    sides = [(folded.where(F.col("fold") != fold).drop("fold"),
              folded.where(F.col("fold") == fold).drop("fold")) for fold in range(k)]

    def one(task):
        fold, name = task
        train, test = sides[fold]
        found = candidates[name](train, test).select(
            F.lit(name).alias("candidate"), F.lit(fold).alias("fold"),
            F.col(key).cast("bigint").alias("key"), F.col(label).cast("double").alias("label"),
            F.col("prediction").cast("double").alias("prediction"),
            F.col("score").cast("double").alias("score"))
        return materialise(found, "fold-predictions")
    tasks = [(fold, name) for fold in range(k) for name in candidates]
    with ThreadPool(min(parallelism, len(tasks))) as pool:
        parts = pool.map(inheritable_thread_target(df.sparkSession)(one), tasks)
    return reduce(DataFrame.unionByName, parts)


def fold_metrics(predicted: DataFrame) -> DataFrame:
    """(candidate, fold, rows, accuracy, precision, recall, f1), means weighted by support.

    One grouped pass counts (label, prediction) pairs; the rest works on those counts.
    """
    return pair_metrics(pair_counts(predicted))


def pair_counts(predicted: DataFrame) -> DataFrame:
    return predicted.groupBy("candidate", "fold", "label", "prediction").agg(
        F.count(F.lit(1)).alias("n"))


def pair_metrics(pairs: DataFrame) -> DataFrame:
    """``fold_metrics`` from counts of (label, prediction) pairs."""
    group = ["candidate", "fold"]
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)
    sides = F.explode(F.array(
        F.struct(F.col("label").alias("cls"), F.col("n").alias("support"),
                 F.lit(0).cast("bigint").alias("claimed"), hit.cast("bigint").alias("hit")),
        F.struct(F.col("prediction").alias("cls"), F.lit(0).cast("bigint").alias("support"),
                 F.col("n").alias("claimed"), F.lit(0).cast("bigint").alias("hit"))))
    per = (pairs.select(*group, sides.alias("s")).select(*group, "s.*").groupBy(*group, "cls")
           .agg(*[F.sum(c).alias(c) for c in ("support", "claimed", "hit")]))
    share = {"precision": F.try_divide("hit", "claimed"), "recall": F.try_divide("hit", "support"),
             "f1": F.try_divide(2 * F.col("hit"), F.col("support") + F.col("claimed"))}
    rows = F.sum("support")
    return per.groupBy(*group).agg(
        rows.alias("rows"), (F.sum("hit") / rows).alias("accuracy"),
        *[(F.sum(F.coalesce(s, F.lit(0.0)) * F.col("support")) / rows).alias(m)
          for m, s in share.items()])


def search(df: DataFrame, candidates: dict, label: str, key: str, k: int = 3,
           refit: str = "f1") -> tuple:
    """Mean and spread of every metric per candidate, the best by ``refit``; and the predictions."""
    predicted = fold_predictions(df, candidates, label, key, k)
    return compare(fold_metrics(predicted), refit), predicted


def compare(per_fold: DataFrame, refit: str = "f1") -> DataFrame:
    """(candidate, metric, mean, std, best): ``best`` marks the first by mean of ``refit``."""
    long = per_fold.unpivot(["candidate", "fold"], METRICS, "metric", "value")
    table = long.groupBy("candidate", "metric").agg(
        F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"))
    lead = F.max_by("candidate", F.when(F.col("metric") == refit, F.struct(
        "mean", (-F.xxhash64("candidate")).alias("tie")))).over(Window.partitionBy())
    return table.withColumn("best", F.col("candidate") == lead)


def learning_curve(df: DataFrame, make, label: str, key: str, shares: list,
                   k: int = 3) -> DataFrame:
    """(share, part, metric, mean, std) over k folds for growing shares of each training side.

    ``make`` gives a candidate that keeps the other columns, such as ``by_pipeline``. Rows are taken in hash order
    within each class, so each share is a prefix of the next. A training side is stored once, with the first share of
    each row; of the predictions only the counts per (label, prediction) are.
    """
    folded = materialise(sampling.folds(df, label, key, k), "folds")
    grown = sorted(shares)
    quotas = [lambda n, _, share=share: max(1, int(round(share * n, 9))) for share in grown]

    def mark(fold):
        train = folded.where(F.col("fold") != fold).drop("fold")
        marked = sampling.mark_quotas(train, label, key, quotas)
        return materialise(marked.where("picked_from IS NOT NULL"), "share")

    def one(task):
        fold, share = task
        test = folded.where(F.col("fold") == fold).drop("fold")
        part = sides[fold].where(F.col("picked_from") <= grown.index(share)).drop("picked_from")
        both = part.withColumn("side", F.lit("train")).unionByName(
            test.withColumn("side", F.lit("test")))
        found = make()(part, both).select(
            F.concat(F.lit(f"{share!r} "), "side").alias("candidate"), F.lit(fold).alias("fold"),
            F.col(label).cast("double").alias("label"),
            F.col("prediction").cast("double").alias("prediction"))
        return materialise(pair_counts(found), "curve")
    tasks = [(fold, share) for fold in range(k) for share in shares]
    with ThreadPool(4) as pool:
        sides = pool.map(inheritable_thread_target(df.sparkSession)(mark), range(k))
        found = pool.map(inheritable_thread_target(df.sparkSession)(one), tasks)
    table = compare(pair_metrics(reduce(DataFrame.unionByName, found))).drop("best")
    spot = F.split("candidate", " ")
    return table.select(spot[0].cast("double").alias("share"), spot[1].alias("part"),
                        "metric", "mean", "std")


# ---- calibration ---------------------------------------------------------

def platt(margins: DataFrame, label: str = "label", score: str = "score"):
    """Sigmoid fitted on out-of-fold margins; returns a function that adds ``probability``."""
    rows = VectorAssembler(inputCols=[score], outputCol="margin").transform(
        margins.select(F.col(label).cast("double").alias("y"), score))
    fitted = LogisticRegression(labelCol="y", featuresCol="margin", maxIter=1000).fit(rows)
    slope, shift = float(fitted.coefficients[0]), float(fitted.intercept)

    def calibrate(df: DataFrame) -> DataFrame:
        return df.withColumn("probability", 1 / (1 + F.exp(-(slope * F.col(score) + shift))))
    return calibrate


def brier(df: DataFrame, label: str, probability: str) -> DataFrame:
    """Mean squared distance of the probability from the outcome, and that of the base rate."""
    y, p = F.col(label), F.col(probability)
    return df.agg(F.count(F.lit(1)).alias("rows"), F.avg((p - y) * (p - y)).alias("brier"),
                  (F.avg(y) * (1 - F.avg(y))).alias("brier_base_rate"))


def reliability(df: DataFrame, label: str, probability: str, bins: int = 10) -> DataFrame:
    """Rows, mean probability and share of positives per even probability range."""
    at = F.least(F.floor(F.col(probability) * bins), F.lit(bins - 1)).cast("int")
    return df.groupBy(at.alias("bin")).agg(
        F.count(F.lit(1)).alias("rows"), F.avg(probability).alias("mean_probability"),
        F.avg(label).alias("share_positive"))
