"""Lagged moments and ridge coefficients against windows laid out in full."""

import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellpulse import schema
from cellpulse.plans import lag_forecast as lag

T0 = datetime(2024, 1, 1)
KPI, OTHER = "one_way_latency_ms", "bler_percent"


@pytest.fixture(scope="module")
def data(spark):
    """A long and a short series, gaps in one feature, one constant feature."""
    rng = random.Random(2)
    names = list(dict.fromkeys(schema.FORECAST_FEATURES[KPI] + schema.FORECAST_FEATURES[OTHER]))
    rows, level = [], 5.0
    for i in range(260):
        level = 0.8 * level + rng.gauss(1, 0.3)
        values = {n: rng.gauss(0, 1) for n in names}
        values.update({KPI: level, "packet_loss_percent": 3.0,
                       "jitter_ms": None if i % 29 == 0 else rng.random()})
        cell = "short" if i % 26 == 0 else "hot"
        rows.append((i, T0 + timedelta(seconds=i // 2), "u", cell, "eMBB", *values.values()))
    columns = ", ".join(["id long", "timestamp timestamp_ntz", "ue_id string", "cell_id string",
                         "slice_type string"] + [f"{n} double" for n in names])
    return spark.createDataFrame(rows, columns).repartition(4), rows, names


def laid_out(rows, names, kpi):
    """(cell, target, 84 lagged values, whether in the training share), in plain Python."""
    at = [5 + names.index(f) for f in schema.FORECAST_FEATURES[kpi]]
    out = []
    for cell in ("hot", "short"):
        mine = [[r[c] for c in at] for r in sorted(rows, key=lambda r: (r[1], r[0])) if r[3] == cell]
        mine = [x for x in mine if None not in x]
        for p in range(12, len(mine)):
            out.append((cell, mine[p][0], sum(mine[p - 12:p], []), p + 1 <= int(0.8 * len(mine))))
    return out


@pytest.mark.parametrize("size", [20, 50_000])
def test_moments_and_predictions(spark, data, size):
    df, rows, names = data
    cut = lag.series(df, [KPI, OTHER], block_rows=size)
    sums = lag.moments(cut)
    got = {(r["kpi"], r["i"], r["j"]): r["s"] for r in sums.collect()}
    assert len(got) == 2 * 86 * 87 // 2
    fits = lag.solve(sums)
    scored = {k: sorted((r["target"], r["prediction"]) for r in
                        lag.predict(cut, fits).where(F.col("kpi") == k).collect()) for k in fits}
    for kpi in (KPI, OTHER):
        want = laid_out(rows, names, kpi)
        z = np.array([[1.0, t, *x] for _, t, x, train in want if train])
        gram = z.T @ z
        for (k, i, j), s in got.items():
            if k == kpi:
                assert s == pytest.approx(gram[i, j], rel=1e-9, abs=1e-7)
        x, y = z[:, 2:], z[:, 1]
        spread = x.std(axis=0)
        live = spread > 1e-9
        xs = (x[:, live] - x[:, live].mean(axis=0)) / spread[live]
        beta = np.linalg.solve(xs.T @ xs / len(y) + 0.001 * np.eye(live.sum()),
                               xs.T @ (y - y.mean()) / len(y))
        every = np.array([v for _, _, v, _ in want])
        guess = y.mean() + (every[:, live] - x[:, live].mean(axis=0)) / spread[live] @ beta
        plain = sorted((t, g) for (_, t, _, _), g in zip(want, guess))
        assert np.allclose(scored[kpi], plain, rtol=1e-6, atol=1e-6)


def test_nothing_to_learn_from(spark, data):
    df, _, _ = data
    cut = lag.series(df.where("id < 9"), [KPI])
    assert lag.moments(cut).count() == 0 and lag.solve(lag.moments(cut)) == {}
    assert lag.predict(cut, {}).count() == 0
    assert lag.moments(lag.series(df.where("id < 0"), [KPI])).count() == 0
