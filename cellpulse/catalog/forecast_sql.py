"""SQL for the look-back, forecast and fact-table queries."""

from cellpulse import schema
from cellpulse.catalog.kpi_sql import SLA, r, with_kpi

_ORDER = '"timestamp", ue_id, id'


def _windows(kpi: str, partition: str, target: str) -> str:
    feats = schema.FORECAST_FEATURES[kpi]
    w = f"({partition} ORDER BY {_ORDER} ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING)"
    o = f"({partition} ORDER BY {_ORDER})"
    total = " + ".join(f"sum({f}) OVER {w}" for f in feats)
    return (f"SELECT *, row_number() OVER {o} AS position, count(*) OVER {w} AS length, "
            f"first_value({feats[0]}) OVER {w} AS first_value, "
            f"last_value({feats[-1]}) OVER {w} AS last_value, {total} AS seq_sum, "
            f"{target.format(o=o)} AS target, lead(id) OVER {o} AS next_id FROM kpi")


def _sequence_rows(inner: str, more: str = "") -> str:
    return (f"SELECT id, position, length, 7 AS width, {r('first_value', 'last_value')}, "
            f"round(seq_sum, 4) AS seq_sum, {r('target')} FROM ({inner}) "
            f"WHERE length = 12 {more}")


def _history(kpis, by: str, n: int = 30) -> str:
    long = " UNION ALL ".join(
        f"SELECT '{k}' AS kpi, cell_id, slice_type, ingested_at, \"timestamp\", id, {k} AS v "
        "FROM kpi" for k in kpis)
    part = ", ".join(["kpi"] + ([by] if by else []))
    return (f"hist AS (SELECT *, count(*) OVER (PARTITION BY {part}) - rn AS x FROM (SELECT *, "
            f"row_number() OVER (PARTITION BY {part} ORDER BY \"timestamp\" DESC, id DESC) AS rn "
            f"FROM ({long})) WHERE rn <= {n}), "
            f"line AS (SELECT {part}, count(*) AS n, "
            "coalesce(covar_pop(v, x) / nullif(var_pop(x), 0), 0) AS slope, "
            f"avg(v) AS my, avg(x) AS mx FROM hist GROUP BY {part}), "
            f"fc AS (SELECT {part}, step, my - slope * mx + slope * (n + step - 1) AS value "
            "FROM line, (SELECT unnest(generate_series(1, 10)) AS step))")


_UNITS = " ".join(f"WHEN '{k}' THEN '{u}'" for k, u in schema.FORECAST_UNITS.items())
_JUDGED = ("CASE WHEN bad_side = 'high' AND value > threshold THEN 'breach_predicted' "
           "WHEN bad_side = 'low' AND value < threshold THEN 'breach_predicted' "
           "ELSE 'within_threshold' END AS sla_status, 'naive' AS model")


def _persist(kpi: str) -> str:
    w = "(PARTITION BY cell_id ORDER BY " + _ORDER + ")"
    return (f"SELECT *, {kpi} AS target, lag({kpi}) OVER {w} AS prediction, "
            f"row_number() OVER {w} AS rn FROM kpi")


def _fact(kpi: str) -> str:
    return (f"SELECT \"timestamp\", cell_id, ue_id, slice_type, '{kpi}' AS kpi_name, "
            "round(target, 4) AS actual_value, "
            "round(prediction, 4) AS predicted_value, "
            "round(prediction + 1.5 * mae, 4) AS confidence_upper, "
            "round(greatest(0.0::DOUBLE, prediction - 1.5 * mae), 4) AS "
            f"confidence_lower, 'persistence' AS model_name FROM ({_persist(kpi)}), "
            f"(SELECT avg(abs(prediction - target)) AS mae FROM ({_persist(kpi)}) WHERE rn > 12) "
            "WHERE rn > 12")


_METRICS = " UNION ALL ".join(
    f"SELECT '{k}' AS kpi, count(*) AS n, round(avg(abs(prediction - target)), 6) AS mae, "
    "round(sqrt(avg((prediction - target) * (prediction - target))), 6) AS rmse, "
    f"round(avg(CASE WHEN abs(prediction - target) <= {schema.FORECAST_TOLERANCE[k]} "
    f"THEN 1.0::DOUBLE ELSE 0 END) * 100, 6) AS accuracy FROM ({_persist(k)}) WHERE rn > 12"
    for k in schema.SLA_KPIS)

_L = "one_way_latency_ms"

FORECAST_SQL = {
    "win_lead_target": with_kpi(
        f'SELECT id, "timestamp", {r(_L)}, round(t, 6) AS target FROM '
        f'(SELECT *, lead({_L}) OVER (ORDER BY "timestamp", id) AS t FROM kpi) '
        "WHERE t IS NOT NULL"),
    "win_sequences": with_kpi(_sequence_rows(_windows(_L, "PARTITION BY cell_id", _L))),
    "win_sequences_global": with_kpi(_sequence_rows(
        _windows("bler_percent", "", "lead(bler_percent) OVER {o}"),
        "AND next_id IS NOT NULL")),
    "win_last_n": with_kpi(
        f'SELECT cell_id, id, "timestamp", {r(_L)}, '
        "count(*) OVER (PARTITION BY cell_id) - rn AS step FROM (SELECT *, row_number() OVER "
        '(PARTITION BY cell_id ORDER BY "timestamp" DESC, id DESC) AS rn FROM kpi) WHERE rn <= 30'),
    "q_latest_slice": with_kpi(
        "SELECT cell_id, arg_max(slice_type, ingested_at) AS slice_type FROM kpi "
        "GROUP BY cell_id"),
    "fc_linear": with_kpi(
        "SELECT kpi, step, round(value, 5) AS value FROM fc WHERE cell_id = 'gNB-003'",
        _history([_L], "cell_id")),
    "fc_linear_all": with_kpi(
        "SELECT kpi, cell_id, step, round(value, 5) AS value FROM fc",
        _history(schema.SLA_KPIS, "cell_id")),
    "fc_sla_status": with_kpi(
        f"SELECT fc.kpi, fc.cell_id, CASE fc.kpi {_UNITS} END AS unit, threshold, "
        f"round(value, 3) AS predicted_value, {_JUDGED} FROM fc JOIN "
        "(SELECT cell_id, arg_max(slice_type, ingested_at) AS slice_type FROM kpi "
        "GROUP BY cell_id) s ON fc.cell_id = s.cell_id JOIN sla "
        "ON sla.slice_type = s.slice_type AND sla.kpi = fc.kpi WHERE step = 10",
        SLA, _history(schema.SLA_KPIS, "cell_id")),
    "fc_sla_worst_case": with_kpi(
        f"SELECT fc.kpi, CASE fc.kpi {_UNITS} END AS unit, threshold, "
        f"round(value, 3) AS predicted_value, {_JUDGED} FROM fc JOIN (SELECT kpi, bad_side, "
        "CASE WHEN bad_side = 'high' THEN min(threshold) ELSE max(threshold) END AS threshold "
        "FROM sla GROUP BY kpi, bad_side) t ON t.kpi = fc.kpi WHERE step = 10",
        SLA, _history(schema.SLA_KPIS, "")),
    "fc_metrics": with_kpi(_METRICS),
    "fc_fact_rows": with_kpi(" UNION ALL ".join(_fact(k) for k in schema.FORECAST_UNITS)),
    "fact_union": with_kpi(" UNION ALL ".join(_fact(k) for k in schema.FORECAST_UNITS)),
    "fc_history": with_kpi(" UNION ALL ".join(
        f"SELECT '{k}' AS kpi, cell_id, count(*) OVER (PARTITION BY cell_id) - rn AS step, "
        f'"timestamp", round({k}, 6) AS value FROM (SELECT *, row_number() OVER (PARTITION BY '
        f'cell_id ORDER BY "timestamp" DESC, id DESC) AS rn FROM kpi WHERE {k} IS NOT NULL) '
        "WHERE rn <= 30" for k in schema.SLA_KPIS)),
    "fc_samples": with_kpi(
        "SELECT i AS sample_index, cell_id, round(prediction, 4) AS predicted, "
        "round(target, 4) AS actual, round(abs(prediction - target), 4) AS abs_error, "
        "abs(prediction - target) <= 2.0 AS within_tolerance FROM (SELECT *, "
        f"row_number() OVER (ORDER BY cell_id, {_ORDER}) - 1 AS i, count(*) OVER () AS n "
        f"FROM ({_persist(_L)}) WHERE rn > 12) "
        "WHERE i IN (0, n // 3, 2 * n // 3, n - 1)"),
}


def _lag_moments(kpi: str) -> str:
    o = f"(PARTITION BY cell_id ORDER BY {_ORDER})"
    return (f"SELECT '{kpi}' AS kpi, count(*) AS n, round(avg(v), 5) AS mean, "
            "round(avg(v * a), 5) AS lag_1, round(avg(v * b), 5) AS lag_12, "
            f"round(avg(a * b), 5) AS \"between\" FROM (SELECT {kpi} AS v, lag({kpi}, 1) OVER {o} AS a, "
            f"lag({kpi}, 12) OVER {o} AS b FROM kpi) WHERE b IS NOT NULL")


FORECAST_SQL["fc_lag_moments"] = with_kpi(
    " UNION ALL ".join(_lag_moments(kpi) for kpi in schema.SLA_KPIS))
