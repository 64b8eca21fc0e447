"""SQL for the listing, health, summary and timeline queries."""

from cellpulse import schema
from cellpulse.catalog.kpi_sql import SLA, cols, r, with_alerts, with_kpi

_DAY = "ingested_at >= (SELECT max(ingested_at) FROM kpi) - INTERVAL {h} HOUR"
_ALL = ("scope AS (SELECT * FROM kpi WHERE " + _DAY.format(h=24 * 365) + ")")
_LAST = ("scope AS (SELECT * FROM kpi WHERE " + _DAY.format(h=24) + ")")


def _scope(hours):
    return "scope AS (SELECT * FROM kpi WHERE " + _DAY.format(h=hours) + ")"


_DOMINANT = """
dom AS (SELECT cell_id, ml_anomaly_type AS dominant_anomaly_type, cnt FROM (
  SELECT cell_id, ml_anomaly_type, count(*) AS cnt,
         row_number() OVER (PARTITION BY cell_id ORDER BY count(*) DESC, ml_anomaly_type) AS rn
  FROM scope WHERE ml_prediction = 1 GROUP BY cell_id, ml_anomaly_type) WHERE rn = 1)"""

_HEALTH = """
health AS (SELECT cell_id, total, anomaly_count, dominant_anomaly_type, ue_count,
  round(rate, 4) AS anomaly_rate,
  CASE WHEN rate < 0.02 THEN 'Healthy' WHEN rate < 0.07 THEN 'Degraded' ELSE 'Critical' END
    AS status
  FROM (SELECT cell_id, count(*) AS total, CAST(sum(actual_anomaly) AS BIGINT) AS anomaly_count,
               max(actual_anomaly_type) AS dominant_anomaly_type,
               count(DISTINCT ue_id) AS ue_count,
               sum(actual_anomaly)::DOUBLE / count(*) AS rate
        FROM scope GROUP BY cell_id))"""

_PRED = cols(schema.PREDICTIONS.names)

_STATUS_LONG = " UNION ALL ".join(
    f"SELECT slice_type, count(*) AS total_records, CAST(sum(ml_prediction) AS BIGINT) AS "
    f"total_anomalies, '{k}' AS kpi, avg({k}) AS mean FROM kpi GROUP BY slice_type"
    for k in schema.SLA_KPIS)

_STATUS = f"""
status AS (SELECT slice_type, total_records, total_anomalies, kpi, round(mean, 4) AS value,
  threshold, CASE WHEN bad_side = 'low' THEN mean >= threshold ELSE mean <= threshold END
    AS meets_sla
  FROM ({_STATUS_LONG}) LEFT JOIN sla USING (slice_type, kpi))"""

MONITORING_SQL = {
    "src_csv_roundtrip": with_kpi(f"SELECT {cols(schema.RAW_RECORD.names)} FROM kpi"),
    "src_row_batch": with_kpi(
        f"SELECT id, {cols(schema.RAW_RECORD.names)} FROM kpi "
        'ORDER BY "timestamp", id LIMIT 400 OFFSET 400'),
    "src_schema_evolve": with_kpi(
        "SELECT " + _PRED.replace('"ue_id"',
                                  "CASE WHEN ml_prediction = 1 THEN ue_id END AS ue_id")
        + " FROM kpi"),
    "q_predictions": with_kpi(
        f"SELECT {_PRED} FROM kpi WHERE slice_type = 'URLLC' AND ml_prediction = 1 "
        "AND \"timestamp\" >= TIMESTAMP '2024-01-03' AND \"timestamp\" <= TIMESTAMP '2024-01-28' "
        'ORDER BY "timestamp" DESC, id DESC LIMIT 100 OFFSET 5'),
    "q_predictions_deep": with_kpi(
        f'SELECT {_PRED} FROM kpi ORDER BY "timestamp" DESC, id DESC LIMIT 300 OFFSET 450'),
    "q_page_keyset": with_kpi(
        f'SELECT {_PRED} FROM kpi ORDER BY "timestamp" DESC, id DESC LIMIT 200 OFFSET 400'),
    "q_page_jump": with_kpi(
        f'SELECT {_PRED} FROM kpi ORDER BY "timestamp" DESC, id DESC LIMIT 120 OFFSET 333'),
    "q_network": with_kpi(
        f"SELECT {cols(schema.NETWORK_COLUMNS)} FROM kpi WHERE cell_id = 'gNB-009' "
        'ORDER BY kpi."timestamp" DESC, id DESC LIMIT 50 OFFSET 3'),
    "q_alerts": with_alerts(
        "SELECT id, alert_time, cell_id, slice_type, kpi, round(kpi_value, 6) AS kpi_value, "
        "threshold, alert_message, alert_action, severity, created_at FROM alerts "
        "WHERE slice_type = 'eMBB' AND severity = 'Critical' "
        "ORDER BY created_at DESC, alerts.id DESC LIMIT 500"),
    "q_cells": with_kpi(
        "SELECT DISTINCT cell_id FROM kpi WHERE cell_id IS NOT NULL ORDER BY cell_id"),
    "q_in_filter": with_kpi(
        f"SELECT id, slice_type, {r('one_way_latency_ms')} FROM kpi "
        "WHERE slice_type IN ('eMBB', 'mMTC')"),
    "q_top_cells": with_kpi(
        "SELECT cell_id, anomaly_count, anomaly_rate FROM health "
        "ORDER BY anomaly_count DESC, cell_id LIMIT 10", _LAST, _HEALTH),
    "q_alert_board": with_alerts(
        "SELECT substr(strftime(alert_time, '%Y-%m-%d %H:%M:%S'), 12, 5) AS \"Alert Time\", "
        'slice_type AS "Slice", kpi AS "KPI", alert_message AS "Alert Message", '
        'alert_action AS "Alert Action" FROM (SELECT * FROM alerts '
        "ORDER BY created_at DESC, id DESC LIMIT 50) WHERE slice_type IN ('eMBB', 'URLLC')"),
    "q_dedup": "SELECT DISTINCT round(l_quantity, 6) AS l_quantity, "
               "round(l_discount, 6) AS l_discount, round(l_tax, 6) AS l_tax, "
               "l_returnflag, l_linestatus FROM lineitem",
    "q_drop_cols_nulls": "SELECT d.doc_id, lang, n_chars, quality, toxic FROM documents d "
                         "LEFT JOIN labels l ON d.doc_id = l.doc_id "
                         "WHERE quality IS NOT NULL AND toxic IS NOT NULL",
    "q_recent_anomalies": with_kpi(
        f'SELECT {_PRED} FROM (SELECT * FROM kpi ORDER BY "timestamp" DESC, id DESC LIMIT 500) '
        'AS b WHERE ml_prediction = 1 ORDER BY "timestamp" DESC, id DESC LIMIT 10'),
    "join_sla_broadcast": with_kpi(
        "SELECT slice_type, kpi, threshold, bad_side, action, count(*) AS n "
        "FROM kpi JOIN sla USING (slice_type) GROUP BY ALL", SLA).replace(
            "SELECT slice_type, kpi, threshold", "SELECT slice_type, sla.kpi, threshold"),
    "join_dominant_left": with_kpi(
        "SELECT c.cell_id, c.total, c.anomaly_count, dom.dominant_anomaly_type FROM "
        "(SELECT cell_id, count(*) AS total, CAST(sum(ml_prediction) AS BIGINT) AS anomaly_count "
        "FROM scope GROUP BY cell_id) c LEFT JOIN dom ON c.cell_id = dom.cell_id",
        _LAST, _DOMINANT),
    "q_sla_status": with_kpi("SELECT * FROM status", SLA, _STATUS),
    "q_sla_status_nested": with_kpi(
        "SELECT slice_type, total_records, 4 AS kpis, value AS latency, "
        "threshold AS latency_threshold, meets_sla AS latency_meets_sla FROM status "
        "WHERE kpi = 'one_way_latency_ms'", SLA, _STATUS),
    "q_network_health": with_kpi("SELECT * FROM health", _LAST, _HEALTH),
    "q_health_totals": with_kpi(
        "SELECT count(*) AS total_cells, count(*) FILTER (status = 'Healthy') AS healthy, "
        "count(*) FILTER (status = 'Degraded') AS degraded, "
        "count(*) FILTER (status = 'Critical') AS critical, "
        "(SELECT count(DISTINCT ue_id) FROM scope) AS active_ues, "
        "(SELECT count(*) FROM scope WHERE ue_id IS NOT NULL) AS total_records FROM health",
        _LAST, _HEALTH),
    "q_severity_ranking": with_kpi(
        "SELECT cell_id, dominant_anomaly_type, round(rate, 4) AS anomaly_rate, anomaly_count, "
        "CASE WHEN rate >= 0.2 THEN 'Critical' WHEN rate >= 0.05 THEN 'Medium' ELSE 'Low' END "
        "AS severity FROM (SELECT cell_id, CAST(sum(ml_prediction) AS BIGINT) AS anomaly_count, "
        "sum(ml_prediction)::DOUBLE / count(*) AS rate FROM scope GROUP BY cell_id) "
        "LEFT JOIN dom USING (cell_id) ORDER BY anomaly_count DESC, cell_id LIMIT 20",
        _ALL, _DOMINANT),
    "q_dominant_type": with_kpi("SELECT * FROM dom", _ALL, _DOMINANT),
    "q_anomaly_summary": with_kpi(
        "SELECT count(*) AS total, CAST(sum(ml_prediction) AS BIGINT) AS active_anomalies, "
        "count(DISTINCT cell_id) AS affected_cells, count(DISTINCT ue_id) AS affected_ues "
        "FROM scope", _LAST),
    "q_type_distribution": with_kpi(
        "SELECT ml_anomaly_type, count(*) AS count FROM scope WHERE ml_prediction = 1 "
        "GROUP BY ml_anomaly_type", _ALL),
    "q_avg_duration": with_kpi(
        "SELECT (SELECT ml_anomaly_type FROM scope WHERE ml_prediction = 1 "
        "GROUP BY ml_anomaly_type ORDER BY count(*) DESC, ml_anomaly_type LIMIT 1) "
        "AS dominant_anomaly_type, round(sum(ml_prediction)::DOUBLE / "
        "greatest((SELECT count(*) FROM dom), 1) / 60.0::DOUBLE, 2) AS avg_anomaly_duration_min "
        "FROM scope", _ALL, _DOMINANT),
    "q_timeline": with_kpi(
        "SELECT strftime(ingested_at, '%H:00') AS hour, slice_type, "
        "CAST(sum(ml_prediction) AS BIGINT) AS anomaly_count, count(*) AS total FROM scope "
        "GROUP BY 1, 2", _LAST),
    "q_timeline_by_type": with_kpi(
        "SELECT strftime(ingested_at, '%H:00') AS hour, ml_anomaly_type, count(*) AS count "
        "FROM scope WHERE ml_prediction = 1 GROUP BY 1, 2", _scope(24 * 30)),
    "q_breach_trend": with_alerts(
        "SELECT strftime(created_at, '%Y-%m-%d %H:00') AS bucket, slice_type, "
        "count(*) AS breach_count FROM alerts WHERE created_at >= "
        "(SELECT max(ingested_at) FROM kpi) - INTERVAL 48 HOUR GROUP BY 1, 2"),
    "q_timeline_rollup": with_kpi(
        "SELECT strftime(ingested_at, '%H:00') AS hour, "
        "CAST(sum(ml_prediction) AS BIGINT) AS anomaly_count FROM scope GROUP BY 1",
        _scope(24 * 7)),
    "q_value_counts": with_kpi(
        "SELECT anomaly_type, count(*) AS count, "
        "round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM kpi), 6) AS percent FROM kpi "
        "GROUP BY anomaly_type"),
    "q_rate_by_slice": with_kpi(
        "SELECT slice_type, total, anomaly_count, round(rate, 6) AS anomaly_rate, "
        "rate = max(rate) OVER () AS most_vulnerable, rate = min(rate) OVER () AS "
        "least_vulnerable FROM (SELECT slice_type, count(*) AS total, "
        "CAST(sum(anomaly) AS BIGINT) AS anomaly_count, avg(anomaly) * 100 AS rate FROM kpi "
        "GROUP BY slice_type)"),
    "q_daily": with_kpi(
        'SELECT CAST("timestamp" AS DATE) AS date, CAST(sum(anomaly) AS BIGINT) AS anomalies, '
        "count(*) AS total, round(sum(anomaly)::DOUBLE / count(*) * 100, 6) AS rate FROM kpi "
        "GROUP BY 1"),
    "q_daily_stats": with_kpi(
        "SELECT min(d) AS first_day, max(d) AS last_day, count(*) AS days, "
        "round(avg(a::DOUBLE / n * 100), 6) AS mean_daily_rate, "
        "round(avg(a), 6) AS mean_daily_anomalies FROM "
        '(SELECT CAST("timestamp" AS DATE) AS d, sum(anomaly) AS a, count(*) AS n FROM kpi '
        "GROUP BY 1)"),
    "q_compliance": with_kpi(
        "SELECT slice_type, kpi, CASE WHEN meets_sla IS NULL THEN 0.0::DOUBLE WHEN meets_sla "
        "THEN 1.0::DOUBLE ELSE 0.3::DOUBLE END AS score FROM status", SLA, _STATUS),
    "q_profile": with_kpi(
        "SELECT 'total' AS section, 'rows' AS item, count(*) AS n, 100.0::DOUBLE AS percent "
        "FROM kpi UNION ALL SELECT 'total', 'normal', count(*) FILTER (anomaly = 0), "
        "round(count(*) FILTER (anomaly = 0) * 100.0::DOUBLE / count(*), 6) FROM kpi "
        "UNION ALL SELECT 'total', 'anomalies', count(*) FILTER (anomaly = 1), "
        "round(count(*) FILTER (anomaly = 1) * 100.0::DOUBLE / count(*), 6) FROM kpi "
        "UNION ALL SELECT 'anomaly_type', anomaly_type, count(*), "
        "round(count(*) * 100.0::DOUBLE / (SELECT sum(anomaly) FROM kpi), 6) FROM kpi "
        "WHERE anomaly = 1 GROUP BY anomaly_type "
        "UNION ALL SELECT 'cells_per_slice', s, count(*), NULL FROM (SELECT cell_id, "
        'arg_min(slice_type, "timestamp") AS s FROM kpi GROUP BY cell_id) GROUP BY s '
        "UNION ALL SELECT 'distinct', 'cells', count(DISTINCT cell_id), NULL FROM kpi "
        "UNION ALL SELECT 'distinct', 'ues', count(DISTINCT ue_id), NULL FROM kpi "
        "UNION ALL SELECT 'first_time', strftime(min(\"timestamp\"), '%Y-%m-%d %H:%M:%S'), "
        "NULL, NULL FROM kpi "
        "UNION ALL SELECT 'last_time', strftime(max(\"timestamp\"), '%Y-%m-%d %H:%M:%S'), "
        "NULL, NULL FROM kpi"),
    "q_live_counters": with_kpi(
        "SELECT count(*) AS processed, CAST(sum(ml_prediction) AS BIGINT) AS anomalies, "
        "round(avg(CASE WHEN ml_prediction = actual_anomaly THEN 1.0::DOUBLE ELSE 0 END), 6) "
        "AS accuracy, round(avg(one_way_latency_ms), 6) AS avg_latency, "
        "round(avg(throughput_dl_mbps), 6) AS avg_throughput_dl FROM kpi"),
    "q_live_top_cells": with_kpi(
        "SELECT cell_id, round(sum(ml_prediction)::DOUBLE / count(*), 6) AS anomaly_rate "
        "FROM kpi GROUP BY cell_id ORDER BY sum(ml_prediction)::DOUBLE / count(*) DESC, cell_id "
        "LIMIT 20"),
    "q_live_top_types": with_kpi(
        "SELECT ml_anomaly_type, count(*) AS count FROM kpi WHERE ml_prediction = 1 "
        "GROUP BY ml_anomaly_type ORDER BY count(*) DESC, ml_anomaly_type LIMIT 8"),
    "alerts_eval": with_alerts(
        "SELECT id, alert_time, cell_id, slice_type, kpi, round(kpi_value, 6) AS kpi_value, "
        "threshold, alert_message, alert_action, severity, created_at FROM alerts"),
    "alerts_breach_counts": with_alerts(
        "SELECT slice_type, kpi, severity, count(*) AS alerts, "
        "round(avg(kpi_value), 6) AS avg_value FROM alerts GROUP BY ALL"),
}

# Hourly partials give the rows that the records give.
MONITORING_SQL.update({f"roll_{name}": MONITORING_SQL[f"q_{name}"] for name in (
    "network_health", "health_totals", "sla_status", "timeline", "timeline_by_type",
    "type_distribution", "severity_ranking", "anomaly_summary", "avg_duration")})
