"""k-means, mixtures and the match of clusters to classes."""

import math

from pyspark.ml.clustering import GaussianMixture, KMeans
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from cellpulse.plans.evaluation import silhouette
from cellpulse.session import small_broadcast, small_table


def kmeans(df: DataFrame, k: int = 9, seed: int = 42, **params):
    options = {"maxIter": 300, **params}  # stops earlier once the centres rest
    return KMeans(k=k, seed=seed, featuresCol="features", predictionCol="cluster",
                  **options).fit(df)


def elbow(df: DataFrame, ks=range(2, 11), seed: int = 42) -> DataFrame:
    """Training cost and silhouette per k."""
    rows = []
    for k in ks:
        model = kmeans(df, k, seed)
        rows.append((k, model.summary.trainingCost, silhouette(model.transform(df), "cluster")))
    return small_table(df.sparkSession, "k int, cost double, silhouette double", rows)


def gaussian_mixture(df: DataFrame, k: int = 9, seed: int = 42, max_iter: int = 100):
    """Returns (model, one-row table of likelihood, BIC, AIC and mean confidence)."""
    model = GaussianMixture(k=k, seed=seed, maxIter=max_iter, featuresCol="features",
                            predictionCol="cluster").fit(df)
    scored = model.transform(df)
    d = len(model.gaussians[0].mean)
    n = df.count()
    free = (k - 1) + k * d + k * d * (d + 1) // 2  # weights, means, full covariances
    likelihood = model.summary.logLikelihood
    sure = scored.agg(F.avg(F.array_max(vector_to_array("probability")))).first()[0]
    table = small_table(
        df.sparkSession,
        "k int, log_likelihood double, bic double, aic double, mean_confidence double",
        [(k, likelihood, free * math.log(n) - 2 * likelihood, 2 * free - 2 * likelihood, sure)])
    return model, table


def best_assignment(gain: list) -> dict:
    """Row → column of largest total gain, one to one (shortest augmenting paths)."""
    rows, cols = len(gain), len(gain[0]) if gain else 0
    if rows > cols:
        turned = best_assignment([list(c) for c in zip(*gain)])
        return {r: c for c, r in turned.items()}
    u, v = [0.0] * (rows + 1), [0.0] * (cols + 1)
    owner = [0] * (cols + 1)
    for row in range(1, rows + 1):
        owner[0], col = row, 0
        slack, used, back = [math.inf] * (cols + 1), [False] * (cols + 1), [0] * (cols + 1)
        while owner[col]:
            used[col] = True
            here, step, nxt = owner[col], math.inf, 0
            for j in range(1, cols + 1):
                if used[j]:
                    continue
                cost = -gain[here - 1][j - 1] - u[here] - v[j]
                if cost < slack[j]:
                    slack[j], back[j] = cost, col
                if slack[j] < step:
                    step, nxt = slack[j], j
            for j in range(cols + 1):
                if used[j]:
                    u[owner[j]] += step
                    v[j] -= step
                else:
                    slack[j] -= step
            col = nxt
        while col:
            owner[col] = owner[back[col]]
            col = back[col]
    return {owner[j] - 1: j - 1 for j in range(1, cols + 1) if owner[j]}


def map_clusters(df: DataFrame, cluster: str, truth: str) -> DataFrame:
    """Add ``mapped``: the class matched to the cluster, -1 for noise and unmatched ones.

    Only the contingency table, clusters × classes, reaches the driver.
    """
    counts = (df.where(F.col(cluster) != -1).groupBy(cluster, truth)
              .agg(F.count(F.lit(1)).alias("n")).collect())
    found = sorted({r[cluster] for r in counts})
    classes = sorted({r[truth] for r in counts})
    gain = [[0] * len(classes) for _ in found]
    for r in counts:
        gain[found.index(r[cluster])][classes.index(r[truth])] = r["n"]
    pairs = [(int(found[i]), int(classes[j])) for i, j in best_assignment(gain).items()]
    table = small_table(df.sparkSession, "_cluster int, mapped int", pairs)
    return (df.join(small_broadcast(table, len(pairs)), F.col(cluster) == F.col("_cluster"), "left")
            .drop("_cluster").na.fill(-1, ["mapped"]))
