"""The W statistic against a plain computation on small columns."""

import random
from statistics import NormalDist

import numpy as np
import pytest

from cellpulse.plans import stats as st


def plain(values, f=lambda x: x):
    values = [f(v) for v in values]
    n = len(values)
    scores = [NormalDist().inv_cdf((i + 0.625) / (n + 0.25)) for i in range(n)]
    return np.corrcoef(sorted(values), scores)[0, 1] ** 2


@pytest.mark.parametrize("span", [7, 10_000])
def test_w_with_ties_nulls_and_transforms(spark, monkeypatch, span):
    monkeypatch.setattr(st, "RANK_SPAN", span)
    rng = random.Random(5)
    a = [rng.gauss(0, 1) for _ in range(300)]
    b = [float(rng.randrange(6)) for _ in range(300)]
    rows = [(x, y, None) for x, y in zip(a, b)] + [(None, None, None), (float("nan"), None, None)]
    df = spark.createDataFrame(rows, "a double, b double, c double").repartition(4)
    got = {(r["kpi"], r["transform"]): r
           for r in st.shapiro_francia(df, ["a", "b", "c"], st.MONOTONE).collect()}
    assert len(got) == 8 and all(r["n"] == 300 for r in got.values())
    assert got["a", "none"]["w"] == pytest.approx(plain(a), rel=1e-9)
    assert got["b", "none"]["w"] == pytest.approx(plain(b), rel=1e-9)
    assert got["b", "square_root"]["w"] == pytest.approx(plain(b, np.sqrt), rel=1e-9)
    assert got["a", "cube_root"]["w"] == pytest.approx(plain(a, np.cbrt), rel=1e-9)
    assert got["a", "none"]["normal"] and not got["b", "none"]["normal"]


def test_constant_and_short_columns(spark):
    df = spark.createDataFrame([(1.0, float(i * i)) for i in range(4)], "a double, b double")
    got = {r["kpi"]: r for r in st.shapiro_francia(df, ["a", "b"]).collect()}
    assert got["a"]["w"] is None and got["a"]["z"] is None
    assert 0 < got["b"]["w"] < 1 and got["b"]["z"] is None
    assert st.shapiro_francia(df.where("a > 2"), ["a", "b"]).count() == 0


def test_best_transform_brings_a_skewed_column_back(spark):
    rng = random.Random(6)
    df = spark.createDataFrame([(rng.gauss(4, 0.7) ** 2,) for _ in range(800)], "a double")
    best = st.most_normal(st.shapiro_francia(df, ["a"], st.MONOTONE)).first()
    assert best["best_transform"] == "square_root" and best["w"] > 0.99
