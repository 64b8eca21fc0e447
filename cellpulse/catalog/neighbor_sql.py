"""SQL for the neighbour queries: all pairs, which the Spark jobs avoid."""

from cellpulse.catalog.kpi_sql import r

_P = "p AS (SELECT vec_id AS id, label, embedding::DOUBLE[] AS x FROM embeddings)"
_SPLIT = ("s AS (SELECT *, rn <= floor(n_c * 8 / 10.0) AS train FROM (SELECT *, row_number() OVER "
          "(PARTITION BY label ORDER BY md5(CAST(id AS VARCHAR)), id) AS rn, count(*) OVER "
          "(PARTITION BY label) AS n_c FROM p))")
_NEAR = ("near AS (SELECT a.id, a.label AS truth, b.id AS n_id, b.label, list_distance(a.x, b.x) "
         "AS distance, row_number() OVER (PARTITION BY a.id ORDER BY list_distance(a.x, b.x), b.id) "
         "AS rank FROM s a, s b WHERE NOT a.train AND b.train)")
_GRAPH = ("g AS (SELECT * FROM (SELECT a.id, b.id AS n_id, list_distance(a.x, b.x) AS distance, "
          "row_number() OVER (PARTITION BY a.id ORDER BY list_distance(a.x, b.x), b.id) AS rank "
          "FROM p a, p b WHERE a.id <> b.id) WHERE rank <= {k})")
_LOF = (_GRAPH.format(k=20) + ", kd AS (SELECT id, max(distance) AS kd FROM g GROUP BY id), "
        "dens AS (SELECT g.id, 1 / (avg(greatest(distance, kd)) + 1e-10) AS d FROM g "
        "JOIN kd ON g.n_id = kd.id GROUP BY g.id), "
        "lof AS (SELECT g.id, avg(o.d) / max(dens.d) AS lof FROM g JOIN dens o ON g.n_id = o.id "
        "JOIN dens ON dens.id = g.id GROUP BY g.id)")

_DENSE = (
    "d AS (SELECT a.id, b.id AS n, list_distance(a.x, b.x) AS dist FROM p a, p b), "
    "e AS (SELECT quantile_cont(dist, 0.9) AS eps FROM (SELECT dist, row_number() OVER "
    "(PARTITION BY id ORDER BY dist, n) AS rk FROM d) WHERE rk = 5), "
    "near AS (SELECT id, n FROM d, e WHERE dist <= eps), "
    "core AS (SELECT id FROM near GROUP BY id HAVING count(*) >= 10), "
    "links AS (SELECT id, n FROM near WHERE id IN (FROM core) AND n IN (FROM core)), "
    "reach(id, root) AS (SELECT id, id FROM core UNION SELECT links.n, reach.root FROM reach "
    "JOIN links ON links.id = reach.id), "
    "lab AS (SELECT id, min(root) AS cluster FROM reach GROUP BY id), "
    "edge AS (SELECT near.id, min(lab.cluster) AS cluster FROM near JOIN lab ON near.n = lab.id "
    "WHERE near.id NOT IN (FROM core) GROUP BY near.id)")

NEIGHBORS_SQL = {
    "ml_dbscan":
        f"WITH RECURSIVE {_P}, {_DENSE} SELECT p.id, coalesce(lab.cluster, edge.cluster, -1) AS "
        "cluster, lab.id IS NOT NULL AS core FROM p LEFT JOIN lab ON p.id = lab.id "
        "LEFT JOIN edge ON p.id = edge.id",
    "ml_knn_graph": f"WITH {_P}, {_GRAPH.format(k=5)} SELECT id, n_id, {r('distance')}, rank FROM g",
    "ml_knn_manhattan":
        f"WITH {_P}, flat AS (SELECT id, unnest(x) AS v, unnest(range(len(x))) AS d FROM p), "
        "pair AS (SELECT a.id, b.id AS n_id, sum(abs(a.v - b.v)) AS distance FROM flat a JOIN "
        "flat b ON a.d = b.d GROUP BY 1, 2) SELECT id, n_id, round(distance, 6) AS distance, rank "
        "FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY distance, n_id) AS rank "
        "FROM pair) WHERE rank <= 4",
    "ml_knn_classify":
        f"WITH {_P}, {_SPLIT}, {_NEAR} SELECT id, 5 AS k, prediction, truth AS label FROM "
        "(SELECT id, truth, label AS prediction, row_number() OVER (PARTITION BY id ORDER BY "
        "sum(1 / distance) DESC, label) AS rn FROM near WHERE rank <= 5 GROUP BY id, truth, label) "
        "WHERE rn = 1",
    "ml_knn_sweep":
        f"WITH {_P}, {_SPLIT}, {_NEAR} SELECT k, round(avg(CAST(truth = prediction AS INTEGER)), 6) "
        "AS accuracy FROM (SELECT id, k, truth, label AS prediction, row_number() OVER (PARTITION BY "
        "id, k ORDER BY count(*) DESC, label) AS rn FROM near, (SELECT unnest(range(1, 32, 2)) AS k) "
        "WHERE rank <= k GROUP BY id, k, truth, label) WHERE rn = 1 GROUP BY k",
    "ml_lof": f"WITH {_P}, {_LOF} SELECT id, round(lof, 5) AS lof FROM lof",
    "ml_lof_flags":
        f"WITH {_P}, {_LOF} SELECT CAST(lof > c AS INTEGER) AS flagged, count(*) AS n, "
        "round(avg(lof), 5) AS mean_lof FROM lof, (SELECT quantile_cont(lof, 0.95) AS c FROM lof) "
        "GROUP BY 1",
}
