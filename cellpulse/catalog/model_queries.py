"""Registered queries that fit models. They return scores, so only rows are checked."""

from functools import reduce

from pyspark.ml import Pipeline
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, functions as F

from cellpulse import schema
from cellpulse.operators import sampling
from cellpulse.plans import (
    clusters as cl, evaluation as ev, features as fe, logistic as lo, models as md, outliers as ou,
    search as se, stats as st)
from cellpulse.session import dealt, materialise, new_path, rounded
from cellpulse.sources.kpi_view import kpi_view, raw_records

STRICT = fe.STRICT_INPUTS
ALL = fe.SERVING_INPUTS


def _split(spark, sf, label="y"):
    """Train and test rows with the serving features."""
    rows = fe.labelled(kpi_view(spark, sf)).select("id", "y", "y_type", *ALL)
    marked = sampling.split_stratified(rows, label, "id")
    marked = materialise(dealt(marked, rows.count()), "split")
    return marked.where("part = 'train'"), marked.where("part = 'test'")


def _name(df, model):
    return rounded(df.select(F.lit(model).alias("model"), "*"), 4)


def ml_decision_tree(spark, sf):
    train, test = _split(spark, sf)
    model = md.fit(md.decision_tree(weight="weight"), md.balanced(train, "y"), ALL)
    tree = model.stages[-1]
    leaves = (tree.numNodes + 1) // 2  # every split is binary
    multi = md.fit(md.decision_tree("y_type"), train, ALL)
    both = md.binary_scores(model.transform(test)).select(*ev.METRICS, "auc").withColumn(
        "depth", F.lit(tree.depth)).withColumn("leaves", F.lit(leaves))
    tree = multi.stages[-1]
    types = md.summary_scores(multi.transform(test), "y_type").withColumn(
        "auc", F.lit(None).cast("double")).withColumn("depth", F.lit(tree.depth)).withColumn(
        "leaves", F.lit((tree.numNodes + 1) // 2))
    return _name(both, "binary").unionByName(_name(types, "multiclass"))


def ml_trainer(spark, sf):
    """The stand-alone trainer: 15 features, median fills, balanced tree, top five features."""
    rows = fe.trainer_features(raw_records(spark, sf).withColumn(
        "id", F.xxhash64("timestamp", "cell_id", "ue_id"))).withColumn(
        "y", F.col("anomaly").cast("double"))
    marked = materialise(sampling.split_stratified(rows, "y", "id"), "split")
    model = md.fit(md.decision_tree(weight="weight"),
                   md.balanced(marked.where("part = 'train'"), "y"), schema.TRAINER_FEATURES)
    path = new_path(spark, "trainer")
    md.save(model, path)
    return rounded(md.importances(md.load(path), schema.TRAINER_FEATURES, 5), 4)


def ml_random_forest(spark, sf):
    """Tuned forests, and a regularised one on deduplicated rows without position and date."""
    train, test = _split(spark, sf)
    binary = md.fit(md.random_forest(), train, ALL)
    multi = md.fit(md.random_forest("y_type"), train, ALL)
    clean = train.dropDuplicates(["y", *STRICT])
    strict = md.fit(md.random_forest(weight="weight", numTrees=250, maxDepth=6,
                                     subsamplingRate=0.7, minInstancesPerNode=5),
                    md.balanced(clean, "y"), STRICT)
    return (_name(md.binary_scores(binary.transform(test)).select(*ev.METRICS), "binary")
            .unionByName(_name(md.binary_scores(strict.transform(test)).select(*ev.METRICS),
                               "strict"))
            .unionByName(_name(md.summary_scores(multi.transform(test), "y_type"), "multiclass")))


def ml_importances(spark, sf):
    train, _ = _split(spark, sf)
    return rounded(md.importances(md.fit(md.random_forest(), train, ALL), ALL), 4)


def ml_gbt(spark, sf):
    train, test = _split(spark, sf)
    binary, _ = md.boost(train, STRICT)
    multi, _ = md.boost(train, STRICT, "y_type", classes=9, maxIter=10)
    return (_name(ev.binary_metrics(binary(test), "y", "prediction").select(*ev.METRICS), "binary")
            .unionByName(_name(md.summary_scores(multi(test), "y_type"), "multiclass")))


def ml_logistic(spark, sf):
    """Regressions on normal quantile scores, and the best of a grid by F1 over five folds."""
    train, test = _split(spark, sf)
    scale = fe.normal_quantile_scaler(train, STRICT)
    train, test = (materialise(scale(d).select("id", "y", "y_type", *STRICT), "scaled")
                   for d in (train, test))
    models, scores = lo.grid_search(train, lo.grid(("l1", "l2")), STRICT, "y", "id")
    best = max(scores, key=scores.get)
    fits = {"l2": lo.Fit(), "l1": lo.Fit(0.1, "l1"), "balanced": lo.Fit(balanced=True),
            f"tuned: {lo.name(best)}": best}
    out = [_name(md.binary_scores(lo.transform(test, models[fit], STRICT)).select(*ev.METRICS), name)
           for name, fit in fits.items()]
    models, scores = lo.grid_search(train, lo.grid(), STRICT, "y_type", "id")
    best = max(scores, key=scores.get)
    fits = {"multiclass": lo.Fit(), f"tuned multiclass: {lo.name(best)}": best}
    out += [_name(md.summary_scores(lo.transform(test, models[fit], STRICT), "y_type"), name)
            for name, fit in fits.items()]
    return reduce(DataFrame.unionByName, out)


def ml_linear_svm(spark, sf):
    train, test = _split(spark, sf)
    n = train.count()
    binary = md.fit(md.linear_svm(n, maxIter=100), train, STRICT, scale=True)
    multi = md.fit(md.linear_svm(n, "y_type", classes=9, maxIter=5), train, STRICT, scale=True)
    return (_name(md.binary_scores(binary.transform(test)).select(*ev.METRICS), "binary")
            .unionByName(_name(md.summary_scores(multi.transform(test), "y_type"), "multiclass")))


def ml_rbf_svm(spark, sf):
    train, test = _split(spark, sf)
    scale = fe.standard_scaler(train, STRICT)
    lifted = [md.fourier_features(scale(d), STRICT, gamma=1.0 / len(STRICT))
              for d in (train, test)]
    model = md.linear_svm(train.count(), maxIter=100).fit(materialise(
        lifted[0].select("y", "features"), "lifted"))
    return _name(md.binary_scores(model.transform(lifted[1])).select(*ev.METRICS), "rbf")


def ml_cross_validate(spark, sf):
    """Scaler, projection and model searched together, fitted anew in each fold."""
    train, _ = _split(spark, sf)
    model = md.logistic(train.count())
    steps = md.stages(model, STRICT, scale=True, pca=4)
    maps = md.random_grid({model.regParam: [0.0, 0.001, 0.01], steps[2].k: [3, 5]}, 6)
    table, _ = md.cross_validate(train, Pipeline(stages=steps), maps, "y", "id", k=3)
    return rounded(table, 4)


def _searched(spark, sf, candidates):
    train, _ = _split(spark, sf)
    table, _ = se.search(train, candidates, "y", "id")
    return rounded(table, 4)


def ml_search_tree(spark, sf):
    return _searched(spark, sf, {
        f"depth={d}, leaf={n}": se.by_pipeline(md.stages(
            md.decision_tree(maxDepth=d, minInstancesPerNode=n), STRICT))
        for d in (5, 10) for n in (1, 10)})


def ml_search_forest(spark, sf):
    return _searched(spark, sf, {
        f"trees={t}, depth={d}": se.by_pipeline(md.stages(
            md.random_forest(numTrees=t, maxDepth=d), STRICT))
        for t, d in ((100, 6), (150, 10))})


def ml_search_svm(spark, sf):
    n = kpi_view(spark, sf).count()
    return _searched(spark, sf, {
        f"c={c}": se.by_pipeline(md.stages(md.linear_svm(n, c=c, maxIter=100), STRICT, scale=True))
        for c in (0.1, 1.0, 10.0)})


def ml_search_knn(spark, sf):
    """Scaling and neighbours both learned from the training folds alone."""
    near = se.neighbour_search(STRICT, "y", "id", 15)
    return _searched(spark, sf, {
        f"k={k}, {w}": se.by_neighbours(STRICT, "y", "id", k, w, search=near)
        for k in (5, 15) for w in ("uniform", "distance")})


def ml_svm_calibrated(spark, sf):
    """Reliability of a machine's probabilities: a sigmoid on margins out of fold."""
    train, test = _split(spark, sf)
    run = se.by_pipeline(md.stages(md.linear_svm(train.count(), maxIter=100), STRICT, scale=True))
    out_of_fold = se.fold_predictions(train, {"svm": run}, "y", "id")
    scored = se.platt(out_of_fold)(run(train, test)).select("y", "probability")
    scored = materialise(scored, "calibrated")
    whole = se.brier(scored, "y", "probability").first()
    return rounded(se.reliability(scored, "y", "probability").withColumns(
        {c: F.lit(whole[c]) for c in ("brier", "brier_base_rate")}), 4)


def eval_learning_curve(spark, sf):
    """Every metric on both sides over three folds, for nested shares of the training rows."""
    train, _ = _split(spark, sf)
    return rounded(se.learning_curve(
        train, lambda: se.by_pipeline(md.stages(md.decision_tree(), STRICT)), "y", "id",
        [0.1, 0.25, 0.5, 0.75, 1.0]), 4)


def ml_save_load(spark, sf):
    """Predictions of a stored and reloaded model, counted against those of the original."""
    train, test = _split(spark, sf)
    model = md.fit(md.decision_tree(maxDepth=5), train, ALL)
    path = new_path(spark, "model")
    md.save(model, path)
    again = md.load(path)
    before = model.transform(test).select("id", F.col("prediction").alias("before"))
    after = again.transform(test).select("id", F.col("prediction").alias("after"))
    return before.join(after, "id").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("before") == F.col("after")).alias("equal"))


# ---- scalings and projections --------------------------------------------

_SHAPED = schema.KPIS


def feat_yeo_johnson(spark, sf):
    df = sampling.split_stratified(kpi_view(spark, sf), "anomaly", "id")
    scale, _ = fe.yeo_johnson_scaler(df.where("part = 'train'"), _SHAPED)
    return rounded(scale(df).select("id", "part", *_SHAPED), 4)


def feat_quantile_normal(spark, sf):
    df = sampling.split_stratified(kpi_view(spark, sf), "anomaly", "id")
    scale = fe.normal_quantile_scaler(df.where("part = 'train'"), _SHAPED)
    return rounded(scale(df).select("id", "part", *_SHAPED), 4)


def stat_best_transform(spark, sf):
    """Which of three scalings brings each KPI closest to normal."""
    df = raw_records(spark, sf)
    power, _ = fe.yeo_johnson_scaler(df, _SHAPED)
    versions = {"standard": fe.standard_scaler(df, _SHAPED)(df), "yeo_johnson": power(df),
                "quantile": fe.normal_quantile_scaler(df, _SHAPED)(df)}
    return rounded(st.best_transform(versions, _SHAPED), 2)


def _kpi_vectors(spark, sf, keep=("id", "anomaly", "anomaly_type")):
    df = kpi_view(spark, sf).select(*keep, *schema.KPIS)
    scaled = fe.standard_scaler(df, schema.KPIS)(df)
    return fe.assemble(schema.KPIS, "scaled").transform(scaled)


def ml_pca(spark, sf):
    df = _kpi_vectors(spark, sf)
    model, explained = ou.fit_pca(df, "scaled", share=0.95)
    rows, total = [], 0.0
    for i, value in enumerate(explained):
        total += value
        rows.append((i + 1, value, total, i < model.getK()))
    return rounded(spark.createDataFrame(
        rows, "component int, explained double, cumulative double, kept boolean"))


def ml_pca_plane(spark, sf):
    """Rows projected on two components, whose largest loadings are taken as positive."""
    df = _kpi_vectors(spark, sf)
    model, _ = ou.fit_pca(df, "scaled", k=2)
    loads = model.pc.toArray()
    sign = [1.0 if max(loads[:, i], key=abs) > 0 else -1.0 for i in range(2)]
    xy = vector_to_array("projected")
    return rounded(model.transform(df).select(
        "id", *[(xy[i] * sign[i]).alias(n) for i, n in enumerate("xy")]), 4)


# ---- outliers and clusters -----------------------------------------------

def _detected(df):
    """Scores of a detector against the labels it did not see."""
    one = F.lit(1).alias("_one")
    return (ev.binary_metrics(df, "anomaly", "flagged").select("*", one)
            .join(ev.ranking_scores(df, "anomaly", "score").select("*", one), "_one").drop("_one"))


def ml_isolation_forest(spark, sf):
    df = kpi_view(spark, sf).select("id", "anomaly", *schema.KPIS)
    nodes = ou.fit_isolation_forest(df, schema.KPIS, "id")
    scored = materialise(ou.score_isolation_forest(df, schema.KPIS, nodes)
                         .select("anomaly", "score", "flagged"), "scored")
    return rounded(_detected(scored), 4)


def ml_reconstruction_error(spark, sf):
    df = kpi_view(spark, sf).select("id", "anomaly", *schema.KPIS)
    normal = F.col("anomaly") == 0
    scale = fe.standard_scaler(df.where(normal), schema.KPIS)
    scored = ou.reconstruction_error(scale(df), schema.KPIS, normal)
    return rounded(_detected(scored.withColumnRenamed("error", "score")), 4)


def _embedded(spark, sf):
    return spark.read.parquet(f"{sf}/embeddings.parquet").select(
        "vec_id", "label", array_to_vector(F.col("embedding").cast("array<double>"))
        .alias("features"))


def ml_kmeans(spark, sf):
    df = _embedded(spark, sf)
    clustered = cl.kmeans(df, 9).transform(df)
    return clustered.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"))


def ml_elbow(spark, sf):
    return rounded(cl.elbow(materialise(_embedded(spark, sf), "vectors"), range(2, 11)), 4)


def ml_gmm(spark, sf):
    df = _kpi_vectors(spark, sf).select("scaled")
    model, _ = ou.fit_pca(df, "scaled", k=3)
    plane = materialise(model.transform(df).select(F.col("projected").alias("features")), "plane")
    _, table = cl.gaussian_mixture(plane, 9)
    return rounded(table, 3)


def ml_cluster_mapping(spark, sf):
    """Clusters named after classes, then scored per class."""
    df = _embedded(spark, sf)
    clustered = materialise(cl.kmeans(df, 10).transform(df).select("vec_id", "label", "cluster"),
                            "clustered")
    mapped = cl.map_clusters(clustered, "cluster", "label")
    return rounded(ev.report(mapped, "label", "mapped"), 4)


MODELS = {f.__name__: f for f in [
    ml_decision_tree, ml_trainer, ml_random_forest, ml_importances, ml_gbt, ml_logistic,
    ml_linear_svm, ml_rbf_svm, ml_cross_validate, ml_search_tree, ml_search_forest,
    ml_search_svm, ml_search_knn, ml_svm_calibrated, eval_learning_curve, ml_save_load,
    feat_yeo_johnson, feat_quantile_normal, stat_best_transform, ml_pca, ml_pca_plane,
    ml_isolation_forest, ml_reconstruction_error, ml_kmeans, ml_elbow, ml_gmm,
    ml_cluster_mapping]}
