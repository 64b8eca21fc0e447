"""Density clustering on exact neighbourhoods without listing neighbour pairs.

Tasks on a group of cells and a tile of its visitors return counts, one edge per pair of local
groups, or one label per point; never the pairs of points themselves.
"""

from pyspark.sql import DataFrame, functions as F

from cellpulse.operators.neighbors import Cells, as_vectors, assign_cells, by_cell, meet, visits
from cellpulse.session import materialise


def _within(cells: Cells, eps: float):
    """Maker of a chunked test: which references lie within eps of which queries.

    Yields places of queries, places of references, and whether each pair is near.
    """
    def chunks(q, r):
        import numpy as np
        a, b, order, spans, least = by_cell(q, r, cells)
        norm_a, norm_b = (a * a).sum(1), (b * b).sum(1)
        for c, (_, start, end) in enumerate(spans):
            refs, here = b[start:end], order[start:end]
            rows = np.flatnonzero(least[:, c] <= eps * (1 + 1e-9))
            wide = refs.shape[1] if cells.metric == "manhattan" else 1
            step = max(1, (1 << 21) // (len(refs) * wide))
            for s in range(0, len(rows), step):
                some = rows[s:s + step]
                part = a[some]
                if cells.metric == "manhattan":
                    yield some, here, np.abs(part[:, None, :] - refs[None, :, :]).sum(2) <= eps
                    continue
                rough = part @ (-2.0 * refs.T)
                rough += norm_b[start:end]
                rough += norm_a[some][:, None]
                near = rough <= eps * eps
                slack = 1e-9 * (1 + norm_a[some].max() + norm_b[start:end].max())
                close = (rough <= eps * eps + slack) & (rough >= eps * eps - slack)
                i, j = np.nonzero(close)
                near[i, j] = np.sqrt(((part[i] - refs[j]) ** 2).sum(1)) <= eps
                yield some, here, near
    return chunks


def connected(edges: DataFrame) -> DataFrame:
    """Smallest node id of each node's component, for nodes with edges ``a, b``.

    Each round takes the smallest label among neighbours and then the label of that label;
    rounds are stored, so lineage stays short and a lost executor costs one round.
    """
    both = materialise(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    labels = both.select(F.col("a").alias("node")).distinct().withColumn("label", F.col("node"))
    labels = materialise(labels, "labels")
    while True:
        lowest = (both.join(labels, F.col("b") == F.col("node")).groupBy("a")
                  .agg(F.min("label").alias("low")))
        stepped = labels.join(lowest, F.col("node") == F.col("a")).select(
            "node", F.col("label").alias("old"), F.least("label", "low").alias("label"))
        stepped = materialise(stepped, "labels")
        jump = stepped.select(F.col("node").alias("via"), F.col("label").alias("far"))
        moved = materialise(
            stepped.join(jump, F.col("label") == F.col("via"), "left")
            .select("node", "old", F.least("label", F.coalesce("far", "label")).alias("label")),
            "labels")
        labels = moved.select("node", "label")
        if moved.where(F.col("label") != F.col("old")).limit(1).count() == 0:
            return labels


LOCAL_ROWS = 2048  # core points whose pairs one task holds at once


def dbscan(df: DataFrame, eps: float, min_points: int, vec: str, key: str,
           metric: str = "euclidean", block_rows: int = None, tile_rows: int = None) -> DataFrame:
    """Cluster per point (smallest core id of the cluster; -1 for noise) and core flag.

    A border point within reach of several clusters takes the one with the smallest id.
    """
    points = as_vectors(df, vec, key)
    distinct = points.groupBy("x").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("w"))
    placed, cells = assign_cells(
        materialise(distinct.select("rep", "x", "w"), "distinct"), metric, block_rows)
    chunks = _within(cells, eps)
    # Local groups of core points are found in blocks of one cell, whose pairs fit a task.
    cuts = F.array(*[F.lit(max(1, -(-n // LOCAL_ROWS))) for n in cells.sizes])
    placed = placed.withColumn("block", F.pmod(
        F.xxhash64("rep"), F.get(cuts, F.col("cell"))).cast("int"))

    def count(q, r):
        import numpy as np
        import pandas as pd
        n = np.zeros(len(q), dtype="int64")
        if len(q) and len(r):
            w = r["w"].to_numpy()
            for some, here, near in chunks(q, r):
                if 20 * np.count_nonzero(near) < near.size:
                    i, j = np.nonzero(near)
                    np.add.at(n, some[i], w[here[j]])
                else:
                    n[some] += near @ w[here]
        return pd.DataFrame({"rep": q["rep"].to_numpy(), "n": n})
    reach = placed.select("rep", "x").withColumn("reach", F.lit(float(eps)))
    asked = materialise(visits(reach, cells, "reach").drop("reach"), "searches")
    crowd = (meet(asked, placed.select("rep", "x", "w", "cell", "group"), cells, count,
                  "rep long, n long", tile_rows).groupBy("rep").agg(F.sum("n").alias("n")))
    flagged = materialise(placed.join(crowd, "rep").withColumn("core", F.col("n") >= min_points)
                          .select("rep", "x", "cell", "group", "block", "core"), "cores")
    core = flagged.where("core")

    def local(frame):
        import numpy as np
        import pandas as pd
        reps = frame["rep"].to_numpy()
        group = np.full(len(frame), -1)
        near = np.zeros((len(frame), len(frame)), dtype=bool)
        for some, here, part in chunks(frame, frame):
            near[np.ix_(some, here)] = part
        for i in np.argsort(reps):
            if group[i] >= 0:
                continue
            group[i], stack = i, [i]
            while stack:
                new = np.flatnonzero(near[stack.pop()] & (group < 0))
                group[new] = i
                stack.extend(new.tolist())
        return pd.DataFrame({"rep": reps, "part": reps[group]})
    parts = materialise(
        core.select("rep", "x", "cell", "block").groupBy("cell", "block")
        .applyInPandas(local, "rep long, part long"), "parts")
    core = materialise(core.join(parts, "rep"), "cores")

    def link(q, r):
        import numpy as np
        import pandas as pd
        pairs = set()
        if len(q) and len(r):
            a, b = q["part"].to_numpy(), r["part"].to_numpy()
            for some, here, near in chunks(q, r):
                i, j = np.nonzero(near & (a[some][:, None] != b[here][None, :]))
                ends = np.stack([a[some[i]], b[here[j]]])
                pairs.update(zip(*np.unique(np.sort(ends, axis=0), axis=1).tolist()))
        return pd.DataFrame(sorted(pairs), columns=["a", "b"]).astype("int64")
    core_asked = materialise(asked.join(parts, "rep"), "core-searches")
    edges = meet(core_asked, core.select("rep", "x", "part", "cell", "group"), cells, link,
                 "a long, b long", tile_rows)
    names = connected(edges)
    core = materialise(
        core.join(names, F.col("part") == F.col("node"), "left")
        .select("rep", "x", "cell", "group", F.coalesce("label", "part").alias("cluster")), "cores")

    def adopt(q, r):
        import numpy as np
        import pandas as pd
        none = np.iinfo("int64").max
        best = np.full(len(q), none)
        if len(q) and len(r):
            label = r["cluster"].to_numpy()
            for some, here, near in chunks(q, r):
                if 20 * np.count_nonzero(near) < near.size:
                    i, j = np.nonzero(near)
                    np.minimum.at(best, some[i], label[here[j]])
                else:
                    best[some] = np.minimum(
                        best[some], np.where(near, label[here][None, :], none).min(1))
        hit = best < none
        return pd.DataFrame({"rep": q["rep"].to_numpy()[hit], "cluster": best[hit]})
    outside = materialise(
        asked.join(flagged.where("NOT core").select("rep"), "rep", "left_semi"), "border-searches")
    border = (meet(outside, core, cells, adopt, "rep long, cluster long", tile_rows)
              .groupBy("rep").agg(F.min("cluster").alias("cluster")))
    known = core.select("rep", "cluster").unionByName(border)
    labelled = (flagged.select("rep", "x", "core").join(known, "rep", "left")
                .select("x", "core", F.coalesce("cluster", F.lit(-1)).alias("cluster")))
    return points.join(labelled, "x").select("id", "cluster", "core")
