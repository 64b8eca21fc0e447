"""Neighbour operators against brute force, with copies and crowded cells."""

import numpy as np
import pytest

from cellpulse.operators import density, neighbors


@pytest.fixture(scope="module")
def cloud(spark):
    """Clumps, scattered points, and a third of all points being copies of one vector."""
    rng = np.random.default_rng(3)
    x = np.concatenate([
        rng.normal(0, 0.3, (60, 3)), rng.normal(4, 0.3, (50, 3)), rng.uniform(-8, 12, (50, 3)),
        np.tile([1.5, 1.5, 1.5], (80, 1))])
    ids = rng.permutation(len(x))
    rows = [(int(i), [float(c) for c in v]) for i, v in zip(ids, x)]
    df = spark.createDataFrame(rows, "id long, vec array<double>").repartition(5)
    order = np.argsort(ids)
    return df, x[order]


def distances(x, metric):
    diff = x[:, None, :] - x[None, :, :]
    return np.abs(diff).sum(2) if metric == "manhattan" else np.sqrt((diff ** 2).sum(2))


def brute_knn(x, k, metric, include_self):
    d = distances(x, metric)
    out = {}
    for i in range(len(x)):
        order = sorted((d[i, j], j) for j in range(len(x)) if include_self or j != i)
        out[i] = order[:k]
    return out


@pytest.mark.parametrize("metric,k,include_self", [
    ("euclidean", 5, False), ("euclidean", 90, False), ("manhattan", 7, True)])
def test_knn_is_exact(cloud, metric, k, include_self):
    df, x = cloud
    got = {}
    rows = neighbors.knn_graph(df, k, "vec", "id", metric, include_self, block_rows=9,
                               tile_rows=11).collect()
    for r in rows:
        got.setdefault(r["id"], []).append((r["rank"], r["distance"], r["n_id"]))
    want = brute_knn(x, k, metric, include_self)
    assert len(got) == len(x)
    for i, found in got.items():
        found.sort()
        np.testing.assert_allclose([f[1] for f in found], [w[0] for w in want[i]], atol=1e-12)
        assert [f[2] for f in found] == [w[1] for w in want[i]]


def test_fewer_references_than_neighbours(spark):
    df = spark.createDataFrame([(1, [0.0]), (2, [1.0])], "id long, vec array<double>")
    assert neighbors.knn_graph(df, 5, "vec", "id").count() == 2


def test_vote_prefers_exact_hits_and_low_labels(spark):
    near = spark.createDataFrame(
        [(1, 10, 0.0, 1), (1, 11, 0.1, 2), (1, 12, 0.1, 3), (2, 10, 1.0, 1), (2, 11, 1.0, 2)],
        "id long, n_id long, distance double, rank int")
    labels = spark.createDataFrame([(10, 2), (11, 1), (12, 1)], "n_id long, label int")
    by_distance = {r["id"]: r["prediction"] for r in
                   neighbors.knn_vote(near, labels, [3], "distance").collect()}
    assert by_distance == {1: 2, 2: 1}
    plain = {(r["id"], r["k"]): r["prediction"] for r in
             neighbors.knn_vote(near, labels, [1, 3]).collect()}
    assert plain == {(1, 1): 2, (1, 3): 1, (2, 1): 2, (2, 3): 1}


def test_outlier_factor(cloud):
    df, x = cloud
    k = 6
    want = brute_knn(x, k, "euclidean", False)
    kd = {i: w[-1][0] for i, w in want.items()}
    dens = {i: 1 / (np.mean([max(kd[j], d) for d, j in w]) + 1e-10) for i, w in want.items()}
    lof = {i: np.mean([dens[j] for _, j in w]) / dens[i] for i, w in want.items()}
    got = {r["id"]: r["lof"] for r in
           neighbors.local_outlier_factor(df, k, "vec", "id", block_rows=16).collect()}
    np.testing.assert_allclose([got[i] for i in range(len(x))], [lof[i] for i in range(len(x))],
                               rtol=1e-6)


def brute_dbscan(x, eps, least):
    near = distances(x, "euclidean") <= eps
    core = near.sum(1) >= least
    label = np.full(len(x), -1)
    for i in range(len(x)):
        if not core[i] or label[i] >= 0:
            continue
        stack = [i]
        while stack:
            j = stack.pop()
            if label[j] >= 0:
                continue
            label[j] = i
            if core[j]:
                stack.extend(n for n in np.flatnonzero(near[j]) if label[n] < 0)
    return label, core


@pytest.mark.parametrize("eps,least", [(0.5, 4), (1.2, 5), (2.5, 3), (0.01, 2)])
def test_dbscan_matches_brute_force(cloud, eps, least):
    df, x = cloud
    label, core = brute_dbscan(x, eps, least)
    got = density.dbscan(df, eps, least, "vec", "id", block_rows=7, tile_rows=10).collect()
    assert len(got) == len(x)
    assert {r["id"]: r["core"] for r in got} == {i: bool(c) for i, c in enumerate(core)}
    assert {r["id"]: r["cluster"] for r in got} == {i: int(c) for i, c in enumerate(label)}


def test_connected_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a long, b long")
    got = {r["node"]: r["label"] for r in density.connected(edges).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


@pytest.mark.parametrize("metric", ["euclidean", "manhattan"])
def test_many_groups_of_wide_vectors(spark, metric):
    """Vectors that no pivot separates, in single precision: every query visits every group."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 24)).astype("float32")
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, vec array<float>")
    got = {}
    for r in neighbors.knn_graph(df, 6, "vec", "id", metric, block_rows=40).collect():
        got.setdefault(r["id"], []).append((r["rank"], r["n_id"]))
    want = brute_knn(x.astype("float64"), 6, metric, False)
    assert {i: [n for _, n in sorted(found)] for i, found in got.items()} == {
        i: [n for _, n in near] for i, near in want.items()}


def test_a_query_travels_once_per_group(spark):
    rng = np.random.default_rng(6)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(900, 32)))]
    points = spark.createDataFrame(rows, "rep long, x array<double>").cache()
    placed, cells = neighbors.assign_cells(points, "euclidean", block_rows=300)
    go = neighbors.visits(points.selectExpr("*", "1e9D AS reach"), cells, "reach").collect()
    assert len(cells.pivots) > 10
    assert all(sorted(r["go"]) == list(range(len(cells.groups))) for r in go)
    assert len(cells.groups) <= 6
