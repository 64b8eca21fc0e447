"""Scores of classifiers and clusterings.

Everything starts from counts per (label, prediction) or per distinct score, so the table
is reduced map-side before any ordering or ratio.
"""

from functools import reduce

from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, Window, functions as F

from cellpulse.operators.ordering import running_totals
from cellpulse.session import small_broadcast


def _ratio(a, b):
    return F.coalesce(F.try_divide(a.cast("double"), b), F.lit(0.0))


def confusion(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Counts and the share within each true class."""
    counts = df.groupBy(F.col(label).alias("label"), F.col(pred).alias("prediction")).agg(
        F.count(F.lit(1)).alias("n"))
    row = F.sum("n").over(Window.partitionBy("label"))
    return counts.withColumn("share", F.col("n") / row)


def binary_metrics(df: DataFrame, label: str, pred: str) -> DataFrame:
    """One row: tn, fp, fn, tp, accuracy, precision, recall, f1 (0 where undefined)."""
    def cell(y, p):
        return F.count_if((F.col(label) == y) & (F.col(pred) == p))
    counts = df.agg(cell(0, 0).alias("tn"), cell(0, 1).alias("fp"),
                    cell(1, 0).alias("fn"), cell(1, 1).alias("tp"))
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    return (counts.withColumn("accuracy", _ratio(tp + tn, tn + fp + fn + tp))
            .withColumn("precision", _ratio(tp, tp + fp))
            .withColumn("recall", _ratio(tp, tp + fn))
            .withColumn("f1", _ratio(2 * tp, 2 * tp + fp + fn)))


def report(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Precision, recall, f1 and support per class, with accuracy, macro and weighted means."""
    counts = df.groupBy(F.col(label).cast("string").alias("y"), F.col(pred).cast("string")
                        .alias("p")).agg(F.count(F.lit(1)).alias("n"))
    hit = F.when(F.col("y") == F.col("p"), F.col("n")).otherwise(0)
    sides = F.explode(F.array(
        F.struct(F.col("y").alias("class"), F.col("n").alias("support"), F.lit(0).cast("long")
                 .alias("predicted"), hit.cast("long").alias("tp")),
        F.struct(F.col("p").alias("class"), F.lit(0).cast("long").alias("support"),
                 F.col("n").alias("predicted"), F.lit(0).cast("long").alias("tp"))))
    per = (counts.select(sides.alias("s")).select("s.*").groupBy("class")
           .agg(F.sum("support").alias("support"), F.sum("predicted").alias("predicted"),
                F.sum("tp").alias("tp"))
           .withColumn("precision", _ratio(F.col("tp"), F.col("predicted")))
           .withColumn("recall", _ratio(F.col("tp"), F.col("support")))
           .withColumn("f1", _ratio(2 * F.col("tp"), F.col("predicted") + F.col("support"))))
    names = ["precision", "recall", "f1"]
    support = F.sum("support")
    weights = F.col("support")
    means = per.agg(
        support.alias("support"), (F.sum("tp") / support).alias("accuracy"),
        *[F.avg(m).alias(f"macro_{m}") for m in names],
        *[(F.sum(F.col(m) * weights) / support).alias(f"weighted_{m}") for m in names])

    def line(title, picks):
        return F.struct(F.lit(title).alias("class"), *[p.alias(m) for p, m in zip(picks, names)],
                        F.col("support"))
    extra = means.select(F.explode(F.array(
        line("accuracy", [F.col("accuracy")] * 3),
        line("macro avg", [F.col(f"macro_{m}") for m in names]),
        line("weighted avg", [F.col(f"weighted_{m}") for m in names]))).alias("r")).select("r.*")
    return per.select("class", *names, "support").unionByName(extra)


# ---- ranking scores ------------------------------------------------------

def _by_score(df: DataFrame, label: str, score: str) -> DataFrame:
    """Per distinct score, highest first: positives, negatives and their running sums."""
    counts = (df.where(F.col(score).isNotNull())
              .groupBy((-F.col(score)).alias("_neg"))
              .agg(F.count_if(F.col(label) == 1).alias("pos"),
                   F.count_if(F.col(label) == 0).alias("neg")))
    return (running_totals(counts, ["_neg"], ["pos", "neg"])
            .withColumn("threshold", -F.col("_neg")).drop("_neg"))


def roc_curve(df: DataFrame, label: str, score: str) -> DataFrame:
    """False and true positive rate at each distinct score."""
    return _by_score(df, label, score).select(
        "threshold", _ratio(F.col("neg_cum"), F.col("neg_total")).alias("fpr"),
        _ratio(F.col("pos_cum"), F.col("pos_total")).alias("tpr"))


def best_threshold(curve: DataFrame) -> DataFrame:
    """Threshold of the largest tpr - fpr; the highest such threshold on ties."""
    j = F.col("tpr") - F.col("fpr")
    return curve.agg(F.max_by("threshold", F.struct(j, "threshold")).alias("threshold"),
                     F.max(j).alias("youden_j"))


def ranking_scores(df: DataFrame, label: str, score: str) -> DataFrame:
    """Area under the ROC curve (ties count half) and average precision."""
    runs = _by_score(df, label, score)
    pairs = F.col("neg").cast("double") * (F.col("pos_cum") - F.col("pos") / 2.0)
    step = F.col("pos") * F.col("pos_cum").cast("double") / (F.col("pos_cum") + F.col("neg_cum"))
    sums = runs.agg(F.sum(pairs).alias("a"), F.sum(step).alias("s"),
                    F.max("pos_total").alias("p"), F.max("neg_total").alias("n"))
    return sums.select(F.try_divide(F.col("a"), F.col("p").cast("double") * F.col("n")).alias("auc"),
                       F.try_divide(F.col("s"), F.col("p")).alias("average_precision"))


# ---- comparisons ---------------------------------------------------------

METRICS = ["accuracy", "precision", "recall", "f1"]


def gap_table(train: DataFrame, test: DataFrame, metrics: list = METRICS) -> DataFrame:
    """Train and test value, gap and gap in percent per metric, with the overall verdict.

    ``train`` and ``test`` are one-row metric frames.
    """
    def long(frame, name):
        return frame.select(*[F.col(m).cast("double") for m in metrics]).unpivot(
            [], metrics, "metric", name)
    both = long(train, "train").join(long(test, "test"), "metric")
    gap = F.col("train") - F.col("test")
    table = both.withColumn("gap", gap).withColumn(
        "gap_pct", F.try_divide(gap, F.col("train")) * 100)
    mean = F.avg("gap_pct").over(Window.partitionBy(F.lit(1)))  # one row per metric
    verdict = (F.when(F.col("mean_gap_pct") < 2, "none").when(F.col("mean_gap_pct") < 5, "light")
               .when(F.col("mean_gap_pct") < 10, "moderate").otherwise("significant"))
    return table.withColumn("mean_gap_pct", mean).withColumn("overfitting", verdict)


def model_table(scores: DataFrame, baseline: str) -> DataFrame:
    """Gain over the task's baseline, dense rank by f1, and the winner of each task.

    ``scores`` holds one row per (task, model).
    """
    base = scores.where(F.col("model") == baseline).select("task", F.col("f1").alias("_base"))
    by_f1 = Window.partitionBy("task").orderBy(F.desc("f1"))
    first = F.row_number().over(Window.partitionBy("task").orderBy(F.desc("f1"), "model"))
    return (scores.join(base, "task", "left")
            .withColumn("f1_gain", F.col("f1") - F.col("_base")).drop("_base")
            .withColumn("rank", F.dense_rank().over(by_f1)).withColumn("winner", first == 1))


def melt_scores(scores: DataFrame, metrics: list = METRICS) -> DataFrame:
    return scores.unpivot(["task", "model"], metrics, "metric", "value")


# ---- clusterings ---------------------------------------------------------

def _contingency(df: DataFrame, a: str, b: str) -> DataFrame:
    counts = (df.where(F.col(a).isNotNull() & F.col(b).isNotNull())
              .groupBy(F.col(a).alias("a"), F.col(b).alias("b"))
              .agg(F.count(F.lit(1)).cast("double").alias("n")))
    every = Window.partitionBy(F.lit(1))  # one row per pair of classes
    return (counts.withColumn("ra", F.sum("n").over(Window.partitionBy("a")))
            .withColumn("rb", F.sum("n").over(Window.partitionBy("b")))
            .withColumn("total", F.sum("n").over(every)))


def adjusted_rand(df: DataFrame, a: str, b: str) -> DataFrame:
    def pairs(x):
        return x * (x - 1) / 2
    c = _contingency(df, a, b)
    # Each row total appears once per filled cell, so it is weighted by its cell's share.
    sums = c.agg(F.sum(pairs(F.col("n"))).alias("s"),
                 F.sum(pairs(F.col("ra")) * F.col("n") / F.col("ra")).alias("sa"),
                 F.sum(pairs(F.col("rb")) * F.col("n") / F.col("rb")).alias("sb"),
                 F.max("total").alias("total"))
    expected = F.col("sa") * F.col("sb") / pairs(F.col("total"))
    top = F.col("s") - expected
    bottom = (F.col("sa") + F.col("sb")) / 2 - expected
    return sums.select(F.coalesce(F.try_divide(top, bottom), F.lit(1.0)).alias("ari"))


def normalized_mutual_information(df: DataFrame, a: str, b: str) -> DataFrame:
    """Mutual information over the mean of the two entropies."""
    c = _contingency(df, a, b)
    share = F.col("n") / F.col("total")
    sums = c.agg(
        F.sum(share * F.log(F.col("n") * F.col("total") / (F.col("ra") * F.col("rb")))).alias("mi"),
        F.sum(-share * F.log(F.col("ra") / F.col("total"))).alias("ha"),
        F.sum(-share * F.log(F.col("rb") / F.col("total"))).alias("hb"))
    return sums.select(F.coalesce(
        F.try_divide(F.col("mi"), (F.col("ha") + F.col("hb")) / 2), F.lit(1.0)).alias("nmi"))


def davies_bouldin(df: DataFrame, cluster: str, vec: str) -> DataFrame:
    """Mean over clusters of the worst spread-to-separation ratio; ``vec`` is an array."""
    rows = df.select(F.col(cluster).alias("c"), F.col(vec).cast("array<double>").alias("x"))
    means = rows.groupBy("c").agg(Summarizer.mean(array_to_vector("x")).alias("m")).select(
        "c", vector_to_array("m").alias("m"))
    k = means.count()
    off = F.sqrt(F.aggregate(F.zip_with("x", "m", lambda a, b: (a - b) * (a - b)), F.lit(0.0),
                             lambda s, v: s + v))
    spread = (rows.join(small_broadcast(means, k, 1_000), "c").groupBy("c")
              .agg(F.avg(off).alias("s"), F.first("m").alias("m")))
    # Coordinates meet on their index: clusters squared times dimensions, not rows.
    flat = spread.select("c", "s", F.posexplode("m").alias("d", "v"))
    other = flat.select(F.col("c").alias("c2"), F.col("s").alias("s2"), F.col("d"),
                        F.col("v").alias("v2"))
    apart = (flat.join(other, "d").where(F.col("c") != F.col("c2"))
             .groupBy("c", "c2", "s", "s2")
             .agg(F.sqrt(F.sum((F.col("v") - F.col("v2")) ** 2)).alias("dist")))
    worst = apart.groupBy("c").agg(
        F.max(F.try_divide(F.col("s") + F.col("s2"), F.col("dist"))).alias("w"))
    return worst.agg(F.avg("w").alias("davies_bouldin"))


def silhouette(df: DataFrame, cluster: str, features: str = "features") -> float:
    return ClusteringEvaluator(predictionCol=cluster, featuresCol=features).evaluate(df)


def cluster_summary(df: DataFrame, truth: str, cluster: str, vec: str) -> DataFrame:
    """Cluster count, noise share and agreement scores; cluster -1 is noise."""
    kept = df.where(F.col(cluster) != -1)
    sizes = df.agg(F.countDistinct(F.when(F.col(cluster) != -1, F.col(cluster))).alias("clusters"),
                   (F.avg((F.col(cluster) == -1).cast("double")) * 100).alias("noise_pct"))
    parts = [sizes, adjusted_rand(kept, truth, cluster),
             normalized_mutual_information(kept, truth, cluster),
             davies_bouldin(kept, cluster, vec)]
    one = F.lit(1).alias("_one")
    return reduce(lambda x, y: x.join(y, "_one", "left"),
                  [p.select("*", one) for p in parts]).drop("_one")
