"""SQL for the streaming queries: what the table says directly."""

from cellpulse import schema
from cellpulse.catalog.kpi_sql import cols, r, with_alerts, with_kpi

_SCORED = cols(schema.SCORED_RECORD.names)

STREAMING_SQL = {
    "stream_replay": with_kpi(
        "SELECT CAST(date_trunc('week', \"timestamp\") AS TIMESTAMP) AS week, count(*) AS n, "
        'min("timestamp") AS first, max("timestamp") AS last FROM kpi GROUP BY 1'),
    "stream_json_source": with_kpi(f"SELECT {cols(schema.RAW_RECORD.names)} FROM kpi"),
    "stream_json_sink": with_kpi(f"SELECT {_SCORED} FROM kpi"),
    "stream_score": with_kpi(
        'SELECT "timestamp", cell_id, ue_id, slice_type, actual_anomaly, actual_anomaly_type, '
        "true AS ml_prediction_equal, true AS ml_anomaly_label_equal, "
        "true AS ml_anomaly_type_equal, 0.0::DOUBLE AS confidence_gap FROM kpi"),
    "stream_progress": with_kpi("SELECT count(*) AS rows FROM kpi"),
    "stream_predictions_sink": with_kpi(f"SELECT {_SCORED} FROM kpi"),
    "stream_alerts": with_alerts(
        "SELECT alert_time, cell_id, slice_type, kpi, round(kpi_value, 6) AS kpi_value, threshold, "
        "alert_message, alert_action, severity FROM alerts"),
    "stream_hourly": with_kpi(
        "SELECT date_trunc('hour', \"timestamp\") AS hour, slice_type, "
        "CAST(sum(ml_prediction) AS BIGINT) AS anomaly_count, count(*) AS total FROM kpi "
        "GROUP BY 1, 2"),
    "stream_bad_records": with_kpi(
        "SELECT CASE WHEN id % 50 = 0 THEN 'aside' ELSE 'kept' END AS kind, count(*) AS n FROM kpi "
        "GROUP BY 1"),
}
