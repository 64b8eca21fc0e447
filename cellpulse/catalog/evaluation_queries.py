"""Registered feature, sampling and evaluation queries that need no trained model."""

from functools import reduce

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, functions as F

from cellpulse import schema
from cellpulse.functions.scalar import decode, encode, safe_date_parts
from cellpulse.operators import sampling
from cellpulse.plans import evaluation as ev, features as fe
from cellpulse.session import rounded
from cellpulse.sources.kpi_view import kpi_view

TYPES = schema.ANOMALY_TYPES + [schema.NORMAL]


def feat_label_encode(spark, sf):
    df = kpi_view(spark, sf)
    # Unknown and null labels appear too: the event kind of some rows is no slice.
    odd = F.when(F.col("id") % 7 == 0, "unknown").when(F.col("id") % 11 == 0, None) \
        .otherwise(F.col("slice_type"))
    code = encode(F.col("anomaly_type"), TYPES)
    return df.select("id", encode(odd, schema.SLICES).alias("slice_code"),
                     code.alias("type_code"), decode(code, TYPES, schema.NORMAL).alias("type_back"))


def feat_date_parts(spark, sf):
    return fe.with_date_parts(kpi_view(spark, sf).select("id", "timestamp")).drop("timestamp")


def feat_safe_timestamp(spark, sf):
    text = F.when(F.col("id") % 5 == 0, "not a time").when(F.col("id") % 5 == 1, "") \
        .when(F.col("id") % 5 == 2, None).otherwise(F.col("timestamp").cast("string"))
    rows = kpi_view(spark, sf).select("id", text.alias("text"))
    return rows.select("id", *[c.alias(n) for n, c in safe_date_parts(F.col("text")).items()])


def _holed(spark, sf):
    return kpi_view(spark, sf).select(
        "id", F.when(F.col("id") % 4 != 0, F.col("rtt_ms")).alias("rtt_ms"),
        F.when(F.col("id") % 9 != 0, F.col("bler_percent")).alias("bler_percent"), "jitter_ms")


def feat_fill(spark, sf):
    df = _holed(spark, sf)
    filled = fe.fill_median(df, ["rtt_ms", "bler_percent", "jitter_ms"])
    zero = fe.fill_zero(df, ["rtt_ms"]).select("id", F.col("rtt_ms").alias("rtt_zero"))
    return rounded(filled.join(zero, "id"))


def feat_stratified_split(spark, sf):
    df = kpi_view(spark, sf).select("id", "anomaly_type")
    return sampling.split_stratified(df, "anomaly_type", "id")


def feat_chrono_split(spark, sf):
    df = kpi_view(spark, sf).select("id", "timestamp")
    return sampling.split_chronological(df, ["timestamp", "id"]).select("id", "part")


def feat_stratified_sample(spark, sf):
    df = kpi_view(spark, sf).select("id", "anomaly_type")
    return sampling.sample_stratified(df, "anomaly_type", "id", 600)


def feat_uniform_sample(spark, sf):
    return sampling.sample_uniform(kpi_view(spark, sf).select("id", "cell_id"), "id", 500)


def feat_folds(spark, sf):
    df = kpi_view(spark, sf).select("id", "anomaly")
    return sampling.folds(df, "anomaly", "id", 5)


def feat_standard_scale(spark, sf):
    df = sampling.split_stratified(kpi_view(spark, sf), "anomaly", "id")
    scale = fe.standard_scaler(df.where("part = 'train'"), schema.KPIS)
    return rounded(scale(df).select("id", "part", *schema.KPIS))


def feat_class_weights(spark, sf):
    return rounded(fe.class_weights(kpi_view(spark, sf), "anomaly_type"))


# ---- classifiers ---------------------------------------------------------

def _score(df):
    """Probability of an anomaly implied by prediction and confidence."""
    return df.withColumn("score", F.when(F.col("ml_prediction") == 1, F.col("ml_confidence"))
                         .otherwise(1 - F.col("ml_confidence")))


def eval_confusion(spark, sf):
    return rounded(ev.confusion(kpi_view(spark, sf), "actual_anomaly_type", "ml_anomaly_type"))


def eval_binary(spark, sf):
    return rounded(ev.binary_metrics(kpi_view(spark, sf), "actual_anomaly", "ml_prediction"))


def eval_report(spark, sf):
    return rounded(ev.report(kpi_view(spark, sf), "actual_anomaly_type", "ml_anomaly_type"))


def eval_label_agreement(spark, sf):
    """The toxicity label of documents judged against the quality label."""
    return rounded(ev.report(spark.read.parquet(f"{sf}/labels.parquet"), "quality", "toxic"))


def eval_roc(spark, sf):
    return rounded(ev.roc_curve(_score(kpi_view(spark, sf)), "actual_anomaly", "score"))


def eval_best_threshold(spark, sf):
    curve = ev.roc_curve(_score(kpi_view(spark, sf)), "actual_anomaly", "score")
    return rounded(ev.best_threshold(curve))


def eval_auc(spark, sf):
    return rounded(ev.ranking_scores(kpi_view(spark, sf), "actual_anomaly", "rtt_ms")
                   .select("auc"))


def eval_average_precision(spark, sf):
    return rounded(ev.ranking_scores(kpi_view(spark, sf), "actual_anomaly", "rtt_ms")
                   .select("average_precision"))


def eval_gap(spark, sf):
    df = sampling.split_stratified(kpi_view(spark, sf), "anomaly", "id")
    # A rule that errs, so that train and test differ.
    df = df.withColumn("rule", (F.col("rtt_ms") > 33).cast("int"))
    train, test = (ev.binary_metrics(df.where(F.col("part") == p), "anomaly", "rule")
                   for p in ("train", "test"))
    return rounded(ev.gap_table(train, test), 5)


def _task_scores(spark, sf) -> DataFrame:
    """Metrics of three threshold rules for two tasks."""
    df = kpi_view(spark, sf)
    slow, lossy = F.col("rtt_ms"), F.col("handover_success_rate_percent")
    rules = {
        ("latency", "baseline"): slow > 30, ("latency", "tuned"): slow > 35,
        ("latency", "robust"): F.col("one_way_latency_ms") > 14,
        ("handover", "baseline"): lossy < 99, ("handover", "tuned"): lossy < 98,
        ("handover", "robust"): lossy < 97.5,
    }
    rows = [ev.binary_metrics(df.withColumn("rule", rule.cast("int")), "anomaly", "rule")
            .select(F.lit(task).alias("task"), F.lit(model).alias("model"), *ev.METRICS)
            for (task, model), rule in rules.items()]
    return reduce(DataFrame.unionByName, rows)


def eval_model_table(spark, sf):
    return rounded(ev.model_table(_task_scores(spark, sf), "baseline"))


def eval_model_melt(spark, sf):
    return rounded(ev.melt_scores(_task_scores(spark, sf)))


# ---- clusterings ---------------------------------------------------------

def eval_ari(spark, sf):
    return rounded(ev.adjusted_rand(kpi_view(spark, sf), "actual_anomaly_type", "ml_anomaly_type"))


def eval_nmi(spark, sf):
    return rounded(ev.normalized_mutual_information(
        kpi_view(spark, sf), "actual_anomaly_type", "ml_anomaly_type"))


def eval_dbi(spark, sf):
    return rounded(ev.davies_bouldin(spark.read.parquet(f"{sf}/embeddings.parquet"), "label",
                                     "embedding"), 5)


def eval_cluster_summary(spark, sf):
    """Labels 8 and 9 play the noise."""
    df = spark.read.parquet(f"{sf}/embeddings.parquet").select(
        "embedding", F.col("label").alias("truth"),
        F.when(F.col("label") >= 8, -1).otherwise(F.col("label") % 4).alias("cluster"))
    return rounded(ev.cluster_summary(df, "truth", "cluster", "embedding"), 5)


def eval_silhouette(spark, sf):
    df = spark.read.parquet(f"{sf}/embeddings.parquet").select(
        "label", array_to_vector(F.col("embedding").cast("array<double>")).alias("features"))
    return spark.createDataFrame([(round(ev.silhouette(df, "label"), 5),)], "silhouette double")


EVALUATION = {f.__name__: f for f in [
    feat_label_encode, feat_date_parts, feat_safe_timestamp, feat_fill, feat_stratified_split,
    feat_chrono_split, feat_stratified_sample, feat_uniform_sample, feat_folds,
    feat_standard_scale, feat_class_weights, eval_confusion, eval_binary, eval_report,
    eval_label_agreement, eval_roc, eval_best_threshold, eval_auc, eval_average_precision,
    eval_gap, eval_model_table, eval_model_melt, eval_ari, eval_nmi, eval_dbi,
    eval_cluster_summary, eval_silhouette]}
