"""SQL for model queries with a closed form."""

from cellpulse import schema
from cellpulse.catalog.kpi_sql import with_kpi
from cellpulse.plans import features as fe

_SHAPED = schema.KPIS
_SPLIT = ("split AS (SELECT *, rn <= floor(n_c * 8 / 10.0) AS train FROM (SELECT *, row_number() "
          "OVER (PARTITION BY anomaly ORDER BY md5(CAST(id AS VARCHAR)), id) AS rn, "
          "count(*) OVER (PARTITION BY anomaly) AS n_c FROM kpi))")
_T = ("CASE WHEN v >= 0 THEN CASE WHEN abs(lam) < 1e-9 THEN ln(1 + abs(v)) ELSE "
      "(pow(abs(v) + 1, lam) - 1) / lam END ELSE CASE WHEN abs(2 - lam) < 1e-9 THEN "
      "-ln(1 + abs(v)) ELSE -(pow(abs(v) + 1, 2 - lam) - 1) / (2 - lam) END END")


def _best(source: str) -> str:
    held = f"CASE WHEN abs(t) < {fe.LARGEST!r}::DOUBLE THEN t END"
    return (f"SELECT name, arg_max(lam, score) AS lam FROM (SELECT name, lam, "
            f"CASE WHEN count({held}) = count(*) AND var_pop({held}) > 0 THEN "
            f"-count(*) / 2.0::DOUBLE * ln(var_pop({held})) "
            "+ (lam - 1) * sum(sign(v) * ln(1 + abs(v))) END "
            f"AS score FROM (SELECT name, lam, v, {_T} AS t FROM ({source})) GROUP BY name, lam) "
            "WHERE score IS NOT NULL GROUP BY name")


_LONG = "long AS (" + " UNION ALL ".join(
    f"SELECT id, train, '{c}' AS name, {c} AS v FROM split" for c in _SHAPED) + ")"
_CENTRE = "grid0 AS (SELECT DISTINCT name, 0.0::DOUBLE AS lam FROM long)"
_GRIDS = [f"grid{n + 1} AS (" + _best(
    f"SELECT long.name, v, round(g.lam + {step}::DOUBLE * i, 2) AS lam FROM long JOIN grid{n} g "
    f"ON long.name = g.name, (SELECT unnest(range(-{reach}, {reach + 1})) AS i) WHERE train") + ")"
    for n, (step, reach) in enumerate(fe.POWER_GRIDS)]

MODEL_SQL = {
    "ml_save_load": with_kpi(
        'SELECT count(*) AS rows, count(*) AS equal FROM split WHERE NOT train',
        _SPLIT),
    "feat_yeo_johnson": with_kpi(
        "SELECT id, part, " + ", ".join(
            f"max(CASE WHEN name = '{c}' THEN z END) AS {c}" for c in _SHAPED)
        + " FROM (SELECT id, name, CASE WHEN train THEN 'train' ELSE 'test' END AS part, "
        "round((t - avg(t) FILTER (train) OVER (PARTITION BY name)) / "
        "stddev_pop(t) FILTER (train) OVER (PARTITION BY name), 4) AS z FROM "
        f"(SELECT id, long.name, train, {_T} AS t FROM long JOIN grid{len(_GRIDS)} g ON long.name = g.name)) "
        "GROUP BY id, part", _SPLIT, _LONG, _CENTRE, *_GRIDS),
}
