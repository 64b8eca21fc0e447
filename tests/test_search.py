"""Metrics of folds, curves and calibrated margins against direct computation."""

import math
import random

import numpy as np

from cellpulse.operators import sampling
from cellpulse.plans import models as md, search as se


def rows(spark, n=240, seed=5):
    rng = random.Random(seed)
    data = []
    for i in range(n):
        y = int(rng.random() < .3)
        data.append((i, float(y), rng.gauss(2 * y, 1.0), rng.gauss(-y, 2.0) * 50))
    return spark.createDataFrame(data, "id bigint, y double, a double, b double")


def by_hand(pairs):
    n = len(pairs)
    out = {"accuracy": sum(y == p for y, p in pairs) / n, "precision": 0, "recall": 0, "f1": 0}
    for c in {y for y, _ in pairs}:
        support = sum(y == c for y, _ in pairs)
        claimed = sum(p == c for _, p in pairs)
        hit = sum(y == p == c for y, p in pairs)
        out["precision"] += (hit / claimed if claimed else 0) * support / n
        out["recall"] += hit / n
        out["f1"] += 2 * hit / (support + claimed) * support / n
    return out


def test_search_scores_every_family_on_the_same_folds(spark):
    df = rows(spark)
    candidates = {
        "tree": se.by_pipeline(md.stages(md.decision_tree(maxDepth=3), ["a", "b"])),
        "svm": se.by_pipeline(md.stages(md.linear_svm(240, maxIter=50), ["a", "b"], scale=True)),
        "knn": se.by_neighbours(["a", "b"], "y", "id", 5)}
    table, predicted = se.search(df, candidates, "y", "id", k=3)
    got = predicted.collect()
    assert len(got) == 3 * 240
    fold_of = {r["id"]: r["fold"] for r in sampling.folds(df, "y", "id", 3).collect()}
    assert all(fold_of[r["key"]] == r["fold"] for r in got)
    means = {}
    for r in table.collect():
        folds = [by_hand([(p["label"], p["prediction"]) for p in got
                          if (p["candidate"], p["fold"]) == (r["candidate"], f)])[r["metric"]]
                 for f in range(3)]
        assert math.isclose(r["mean"], np.mean(folds), abs_tol=1e-12)
        assert math.isclose(r["std"], np.std(folds), abs_tol=1e-9)
        means[r["candidate"], r["metric"]] = (r["mean"], r["best"])
    best = {c for (c, _), (_, b) in means.items() if b}
    assert len(best) == 1
    assert means[best.pop(), "f1"][0] == max(v[0] for (_, m), v in means.items() if m == "f1")


def test_neighbours_learn_scaling_from_the_training_rows_only(spark):
    df = rows(spark, 90, 8).toPandas()
    train, test = df[df.id % 3 > 0], df[df.id % 3 == 0]
    out = se.by_neighbours(["a", "b"], "y", "id", 5)(
        spark.createDataFrame(train), spark.createDataFrame(test)).toPandas().set_index("id")
    mean, std = train[["a", "b"]].mean(), train[["a", "b"]].std(ddof=0)
    x, q = (((d[["a", "b"]] - mean) / std).to_numpy() for d in (train, test))
    for key, point in zip(test.id, q):
        near = np.argsort(((x - point) ** 2).sum(1), kind="stable")[:5]
        votes = train.y.to_numpy()[near].mean()
        assert math.isclose(out.score[key], votes) and out.prediction[key] == float(votes > .5)


def test_learning_curve_takes_nested_shares(spark):
    df = rows(spark, 150)
    seen = {}

    def make():
        def run(train, both):
            ids = frozenset(r["id"] for r in train.select("id").collect())
            seen.setdefault(len(ids), []).append(ids)
            return se.by_pipeline(md.stages(md.decision_tree(maxDepth=2), ["a", "b"]))(train, both)
        return run
    table = se.learning_curve(df, make, "y", "id", [.2, .5, 1.0], k=2).collect()
    assert len(table) == 3 * 2 * 4
    assert {(r["share"], r["part"]) for r in table} == {
        (s, p) for s in (.2, .5, 1.0) for p in ("train", "test")}
    sets = [s for found in seen.values() for s in found]
    for small in sets:      # every share is inside the whole of its own fold
        assert any(small <= whole for whole in seen[max(seen)])


def test_platt_gives_calibrated_probabilities(spark):
    rng = random.Random(1)
    data = []
    for i in range(4000):
        margin = rng.gauss(0, 2)
        data.append((float(rng.random() < 1 / (1 + math.exp(-(1.5 * margin - 1)))), margin))
    df = spark.createDataFrame(data, "label double, score double")
    out = se.platt(df)(df)
    lines = se.reliability(out, "label", "probability").collect()
    assert sum(r["rows"] for r in lines) == 4000
    assert all(abs(r["mean_probability"] - r["share_positive"]) < .12 for r in lines)
    whole = se.brier(out, "label", "probability").first()
    p, y = (np.array([r[c] for r in out.collect()]) for c in ("probability", "label"))
    assert math.isclose(whole["brier"], ((p - y) ** 2).mean()) and (
        whole["brier"] < whole["brier_base_rate"])
