"""Ordered operators against plain Python on skewed inputs with ties and nulls."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellpulse.operators import lookback, ordering, sampling
from cellpulse.sources.files import row_batch


@pytest.fixture(scope="module")
def skewed(spark):
    """Two thirds of all rows share one key; one key has a single row."""
    rng = random.Random(7)
    rows = [(i, "hot" if i % 3 else f"k{i % 5}", rng.randrange(40) / 4) for i in range(900)]
    rows.append((900, "lone", 1.0))
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "id long, key string, v double").repartition(7), rows


def test_row_index_counts_within_each_key(skewed):
    df, rows = skewed
    got = {r["id"]: r["row_index"] for r in
           ordering.row_index(df, ["v", "id"], ["key"]).collect()}
    for key in {r[1] for r in rows}:
        mine = sorted((v, i) for i, k, v in rows if k == key)
        assert [got[i] for _, i in mine] == list(range(1, len(mine) + 1))


def test_row_index_handles_null_keys(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, "a")], "id long, key string")
    got = {r["id"]: r["row_index"] for r in ordering.row_index(df, ["id"], ["key"]).collect()}
    assert got == {1: 1, 2: 2, 3: 1}


def test_running_totals(skewed):
    df, rows = skewed
    counts = df.groupBy("key", "v").agg(F.count(F.lit(1)).alias("n"))
    for r in ordering.running_totals(counts, ["v"], ["n"], ["key"]).collect():
        mine = [v for _, k, v in rows if k == r["key"]]
        assert r["n_cum"] == sum(v <= r["v"] for v in mine)
        assert r["n_total"] == len(mine)


def test_quantiles_match_numpy(skewed):
    df, rows = skewed
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    names = [f"p{i}" for i in range(len(probs))]
    for r in ordering.quantiles(df, "v", probs, ["key"], names).collect():
        mine = [v for _, k, v in rows if k == r["key"]]
        np.testing.assert_allclose([r[n] for n in names], np.quantile(mine, probs))


@pytest.mark.parametrize("points", [2, 7, 100, 1000])
def test_quantile_grid_matches_numpy(skewed, points):
    df, rows = skewed
    for r in ordering.quantile_grid(df, "v", points, ["key"]).collect():
        mine = [v for _, k, v in rows if k == r["key"]]
        np.testing.assert_allclose(r["marks"], np.quantile(mine, np.linspace(0, 1, points)))


def test_lead_and_sequences_cross_block_borders(skewed):
    df, rows = skewed
    mine = sorted((v, i) for i, k, v in rows if k == "hot")
    leads = lookback.lead_target(df, "v", ["v", "id"], ["key"], block_rows=13)
    got = {r["id"]: r["target"] for r in leads.where("key = 'hot'").collect()}
    assert got == {i: mine[n + 1][0] for n, (_, i) in enumerate(mine[:-1])}
    seqs = lookback.sequences(df, ["v", "id"], "v", ["v", "id"], ["key"], length=5, horizon=2,
                              block_rows=11).where("key = 'hot'").collect()
    assert len(seqs) == len(mine) - 6
    for r in seqs:
        at = r["position"] - 1
        assert [tuple(s) for s in r["seq"]] == [(v, float(i)) for v, i in mine[at - 5:at]]
        assert r["target"] == mine[at + 1][0]


def test_sequences_drop_rows_with_null_features(spark):
    rows = [(i, None if i == 4 else float(i)) for i in range(8)]
    df = spark.createDataFrame(rows, "id long, v double")
    got = lookback.sequences(df, ["v"], "v", ["id"], length=3).orderBy("id").collect()
    assert [(r["id"], [s[0] for s in r["seq"]]) for r in got] == [
        (3, [0.0, 1.0, 2.0]), (5, [1.0, 2.0, 3.0]), (6, [2.0, 3.0, 5.0]), (7, [3.0, 5.0, 6.0])]


def test_row_batch_out_of_range(skewed):
    df, _ = skewed
    assert row_batch(df, 4, 300, ["id"]).count() == 1
    with pytest.raises(ValueError, match="out of range"):
        row_batch(df, 5, 300, ["id"])


def test_split_is_exact_per_class(skewed):
    df, rows = skewed
    parts = sampling.split_stratified(df, "key", "id").groupBy("key").agg(
        F.count_if(F.col("part") == "train").alias("train"), F.count(F.lit(1)).alias("n"))
    for r in parts.collect():
        assert r["train"] == int(r["n"] * 0.8 + 1e-9)


def test_sample_keeps_small_classes_and_cap(skewed):
    df, rows = skewed
    kept = sampling.sample_stratified(df, "key", "id", 90).groupBy("key").count().collect()
    assert {r["key"] for r in kept} == {r[1] for r in rows}
    assert sampling.sample_uniform(df, "id", 100).count() == 100
    assert sampling.sample_uniform(df, "id", 5000).count() == len(rows)


def test_folds_are_balanced(skewed):
    df, _ = skewed
    counts = sampling.folds(df, "key", "id", 3).groupBy("key", "fold").count().collect()
    for key in {r["key"] for r in counts}:
        sizes = [r["count"] for r in counts if r["key"] == key]
        assert max(sizes) - min(sizes) <= 1
