"""Isolation forest and reconstruction error."""

from pyspark.ml.feature import PCA
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window, functions as F

from cellpulse.plans.features import assemble
from cellpulse.plans.stats import percentile_cut

_NODES = ("tree long, node int, feature int, cut double, left int, right int, size int, depth int")


def fit_isolation_forest(df: DataFrame, inputs: list, key: str, trees: int = 200,
                         sample: int = 256, seed: int = 42) -> list:
    """Grow ``trees`` trees on ``sample`` rows each; returns their nodes.

    The subsample per tree belongs to the method. Every row has a hash per tree and may enter
    any tree: a tree takes the rows of its ``sample`` smallest hashes. A bound on the hash, wide
    enough to leave ``sample`` rows by twelve standard deviations, is tested in place, so little
    more than the subsamples is shuffled. At most trees × (2 · sample) nodes come back.
    """
    total = df.count()
    share = min(1.0, (sample + 12 * sample ** 0.5 + 20) / max(total, 1))
    dealt = (df.select(key, *inputs, F.explode(F.filter(
        F.expr(f"transform(sequence(0L, {trees - 1}L), t -> named_struct('tree', t, 'place', "
               f"pmod(xxhash64(`{key}`, t, {seed}), {1 << 40}L)))"),
        lambda s: s["place"] <= share * (1 << 40))).alias("_s"))
        .select(key, *inputs, "_s.tree", "_s.place"))
    turn = Window.partitionBy("tree").orderBy("place", key)
    dealt = dealt.withColumn("_rn", F.row_number().over(turn)).where(F.col("_rn") <= sample)

    def grow(keys, frame):
        import numpy as np
        import pandas as pd
        rng = np.random.default_rng([seed, int(keys[0])])
        x = frame.sort_values(key)[list(inputs)].to_numpy(dtype="float64")
        limit = int(np.ceil(np.log2(max(len(x), 2))))
        nodes, todo, made = [], [(np.arange(len(x)), 0)], 1
        while todo:
            rows, depth = todo.pop(0)
            node = len(nodes)
            feature, cut = -1, 0.0
            if depth < limit and len(rows) > 1:
                low, high = x[rows].min(0), x[rows].max(0)
                open_ = np.flatnonzero(high > low)
                if len(open_):
                    feature = int(rng.choice(open_))
                    cut = float(rng.uniform(low[feature], high[feature]))
            nodes.append([int(keys[0]), node, feature, cut, -1, -1, len(rows), depth])
            if feature >= 0:
                under = x[rows, feature] < cut
                for side, part in ((4, rows[under]), (5, rows[~under])):
                    nodes[node][side] = made
                    made += 1
                    todo.append((part, depth + 1))
        return pd.DataFrame(nodes, columns=["tree", "node", "feature", "cut", "left", "right",
                                            "size", "depth"])
    return (dealt.select("tree", key, *inputs).groupBy("tree")
            .applyInPandas(grow, _NODES).collect())


def score_isolation_forest(df: DataFrame, inputs: list, nodes: list) -> DataFrame:
    """Add ``score`` in (0, 1) and ``flagged`` for scores over 0.5."""
    import numpy as np
    trees = sorted({r["tree"] for r in nodes})
    width = max(r["node"] for r in nodes) + 1
    place = {t: i for i, t in enumerate(trees)}
    shape = (len(trees), width)
    feature, left, right = (np.full(shape, -1, dtype="int32") for _ in range(3))
    cut, length = np.zeros(shape), np.zeros(shape)

    def expected(n):
        if n <= 1:
            return 0.0
        if n == 2:
            return 1.0
        return 2.0 * (np.log(n - 1) + np.euler_gamma) - 2.0 * (n - 1) / n
    for r in nodes:
        at = place[r["tree"]], r["node"]
        feature[at], left[at], right[at] = r["feature"], r["left"], r["right"]
        cut[at], length[at] = r["cut"], r["depth"] + expected(r["size"])
    # The root's size is the subsample size, the same for all trees.
    norm = expected(max(r["size"] for r in nodes if r["node"] == 0))
    forest = df.sparkSession.sparkContext.broadcast((feature, cut, left, right, length))

    @F.pandas_udf("double")
    def path(rows):
        import numpy as np
        import pandas as pd
        feature, cut, left, right, length = forest.value
        x = np.stack(rows.to_numpy()).astype("float64")
        every = np.arange(len(x))
        total = np.zeros(len(x))
        for t in range(len(feature)):
            at = np.zeros(len(x), dtype="int32")
            while True:
                f = feature[t, at]
                inner = np.flatnonzero(f >= 0)
                if not len(inner):
                    break
                under = x[every[inner], f[inner]] < cut[t, at[inner]]
                at[inner] = np.where(under, left[t, at[inner]], right[t, at[inner]])
            total += length[t, at]
        return pd.Series(2.0 ** (-(total / len(feature)) / norm))
    vector = F.array(*[F.col(c).cast("double") for c in inputs])
    return (df.withColumn("score", path(vector))
            .withColumn("flagged", (F.col("score") > 0.5).cast("int")))


def reconstruction_error(df: DataFrame, inputs: list, normal, share: float = 0.9,
                         prob: float = 0.95) -> DataFrame:
    """Row error after projecting on the components of the normal rows, and the flag.

    ``inputs`` are scaled on the normal rows. Components are orthonormal, so the squared error
    is the squared length lost by the projection.
    """
    ready = assemble(inputs, "scaled").transform(df)
    model, _ = fit_pca(ready.where(normal), "scaled", share)
    squares = "aggregate({a}, 0D, (s, v) -> s + v * v)"
    projected = model.transform(ready).withColumn("_p", vector_to_array("projected")).withColumn(
        "_x", vector_to_array("scaled"))
    lost = F.expr(squares.format(a="_x")) - F.expr(squares.format(a="_p"))
    scored = projected.withColumn("error", F.greatest(lost, F.lit(0.0)) / len(inputs))
    return percentile_cut(scored.drop("_p", "_x", "scaled", "projected"), "error", prob, normal)


def fit_pca(df: DataFrame, column: str, share: float = None, k: int = None):
    """PCA with ``k`` components or the fewest that reach the variance share.

    Returns the model and the explained variance of all components that were fitted.
    """
    size = len(df.select(vector_to_array(column).alias("v")).first()["v"])
    full = PCA(k=k or size, inputCol=column, outputCol="projected").fit(df)
    explained = full.explainedVariance.toArray().tolist()
    if share is None:
        return full, explained
    total, need = 0.0, size
    for i, value in enumerate(explained):
        total += value
        if total >= share:
            need = i + 1
            break
    if need == size:
        return full, explained
    return PCA(k=need, inputCol=column, outputCol="projected").fit(df), explained
