"""The KPI view, the alerts table and helpers as SQL text for the checks."""

from cellpulse import schema


def _types(flag: str) -> str:
    branches = " ".join(f"WHEN {i} THEN '{name}'" for i, name in enumerate(schema.ANOMALY_TYPES))
    return f"CASE WHEN {flag} THEN CASE k % 8 {branches} END ELSE 'normal' END"


VIEW = f"""
e AS (SELECT event_id, ts, user_id, value AS v,
             CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
             CAST(user_id % 20 AS INTEGER) AS c FROM events),
kpi AS (SELECT event_id AS id, ts AS "timestamp", ts AS ingested_at,
  'gNB-' || lpad(CAST(c + 1 AS VARCHAR), 3, '0') AS cell_id,
  'UE-' || CAST(user_id AS VARCHAR) AS ue_id,
  CASE c % 3 WHEN 0 THEN 'eMBB' WHEN 1 THEN 'URLLC' ELSE 'mMTC' END AS slice_type,
  33.5::DOUBLE + c * 0.03::DOUBLE AS latitude, -7.7::DOUBLE + c * 0.015::DOUBLE AS longitude,
  v / 10.0::DOUBLE + 0.0003::DOUBLE AS one_way_latency_ms, k / 20.0::DOUBLE AS jitter_ms,
  v / 5.0::DOUBLE + k / 10.0::DOUBLE AS rtt_ms,
  50.0::DOUBLE + k / 2.0::DOUBLE AS packet_delay_budget_ms,
  5.0::DOUBLE + k * 0.45::DOUBLE AS handover_interruption_time_ms,
  100.0::DOUBLE - k / 100.0::DOUBLE AS reliability_percent,
  v / 100.0::DOUBLE AS packet_loss_percent, v / 100.0::DOUBLE AS packet_loss_rate_percent,
  k / 10.0::DOUBLE AS bler_percent,
  1000.0::DOUBLE / (1.0::DOUBLE + v / 10.0::DOUBLE) + 0.0003::DOUBLE AS throughput_dl_mbps,
  500.0::DOUBLE / (1.0::DOUBLE + v / 10.0::DOUBLE) AS throughput_ul_mbps,
  30.0::DOUBLE / (1.0::DOUBLE + v / 100.0::DOUBLE) AS spectral_efficiency_bps_hz,
  99.9999993::DOUBLE - (k / 100.0::DOUBLE) * (v / 50.0::DOUBLE) AS handover_success_rate_percent,
  1e6::DOUBLE * (1 + k) AS energy_efficiency_bits_per_joule,
  CAST(v > 150 AS INTEGER) AS anomaly, {_types('v > 150')} AS anomaly_type,
  CAST(v > 140 AS INTEGER) AS ml_prediction,
  0.5::DOUBLE + least(abs(v - 140.0::DOUBLE) / 1000.0::DOUBLE, 0.5::DOUBLE) AS ml_confidence,
  CASE WHEN v > 140 THEN 'anomaly' ELSE 'normal' END AS ml_anomaly_label,
  {_types('v > 140')} AS ml_anomaly_type,
  0.5::DOUBLE + k / 200.0::DOUBLE AS ml_anomaly_type_confidence,
  CAST(v > 150 AS INTEGER) AS actual_anomaly, {_types('v > 150')} AS actual_anomaly_type
  FROM e)"""

_SLA_ROWS = ", ".join(
    f"('{s}', '{kpi}', {t}::DOUBLE, '{schema.SLA_BAD_SIDE[kpi]}', '{schema.SLA_ACTIONS[kpi]}')"
    for s, kpis in schema.SLA_THRESHOLDS.items() for kpi, t in kpis.items())

SLA = f"""
sla AS (SELECT * FROM (VALUES {_SLA_ROWS})
        AS t(slice_type, kpi, threshold, bad_side, action))"""

_ALERT_LONG = " UNION ALL ".join(
    f"SELECT id, \"timestamp\", ingested_at, cell_id, slice_type, '{kpi}' AS kpi, {i} AS place, "
    f"{kpi} AS kpi_value FROM kpi" for i, kpi in enumerate(schema.SLA_KPIS))

ALERTS = f"""
checks AS ({_ALERT_LONG}),
alerts AS (SELECT id * 4 + place AS id, "timestamp" AS alert_time, cell_id, slice_type, kpi,
  kpi_value, threshold,
  slice_type || ' ' || kpi || ' ' || printf('%.1f', kpi_value)
    || CASE WHEN bad_side = 'low' THEN ' below' ELSE ' above' END
    || ' SLA ' || CAST(threshold AS VARCHAR) AS alert_message,
  action AS alert_action,
  CASE WHEN abs(kpi_value - threshold) / threshold > 0.2 THEN 'Critical' ELSE 'Low' END
    AS severity, ingested_at AS created_at
  FROM checks JOIN sla USING (slice_type, kpi)
  WHERE CASE WHEN bad_side = 'low' THEN kpi_value < threshold ELSE kpi_value > threshold END)"""


def with_kpi(body: str, *more: str) -> str:
    """SQL text with the KPI view (and further named queries) in front."""
    return "WITH " + ", ".join([VIEW, *more]) + "\n" + body


def with_alerts(body: str, *more: str) -> str:
    return with_kpi(body, SLA, ALERTS, *more)


def long_kpis(kpis=schema.KPIS, extra: str = "id, anomaly, anomaly_type") -> str:
    """Named query ``long``: one row per record and KPI."""
    parts = " UNION ALL ".join(
        f"SELECT {extra}, '{k}' AS kpi, {k} AS v FROM kpi" for k in kpis)
    return f"long AS ({parts})"


def r(*names: str, digits: int = 6) -> str:
    """Rounded columns under their own names."""
    return ", ".join(f"round({n}, {digits}) AS {n}" for n in names)


_DOUBLES = schema.KPIS + ["latitude", "longitude", "ml_confidence", "ml_anomaly_type_confidence"]


def cols(names: list) -> str:
    """Column list, with double columns rounded."""
    return ", ".join(r(n) if n in _DOUBLES else f'"{n}"' for n in names)
