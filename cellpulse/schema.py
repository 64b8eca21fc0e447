"""Column lists, domains, service-level thresholds and table schemas."""

from pyspark.sql import types as T

# They must equal the published data model for results to agree.
SLICES = ["eMBB", "URLLC", "mMTC"]
ANOMALY_TYPES = [
    "network_congestion", "interference", "hardware_failure", "handover_failure",
    "signal_degradation", "security_attack", "backhaul_issue", "overload",
]
KPIS = [
    "one_way_latency_ms", "jitter_ms", "rtt_ms", "packet_delay_budget_ms",
    "handover_interruption_time_ms", "reliability_percent", "packet_loss_percent",
    "packet_loss_rate_percent", "bler_percent", "throughput_dl_mbps", "throughput_ul_mbps",
    "spectral_efficiency_bps_hz", "handover_success_rate_percent",
    "energy_efficiency_bits_per_joule",
]
SLA_THRESHOLDS = {
    "eMBB": {"throughput_dl_mbps": 100.0, "one_way_latency_ms": 20.0,
             "bler_percent": 5.0, "handover_success_rate_percent": 95.0},
    "URLLC": {"throughput_dl_mbps": 0.5, "one_way_latency_ms": 100.0,
              "bler_percent": 10.0, "handover_success_rate_percent": 90.0},
    "mMTC": {"throughput_dl_mbps": 50.0, "one_way_latency_ms": 1.0,
             "bler_percent": 0.1, "handover_success_rate_percent": 99.9},
}
SLA_ACTIONS = {
    "throughput_dl_mbps": "Check backhaul capacity",
    "one_way_latency_ms": "Check routing / congestion",
    "bler_percent": "Check radio interference",
    "handover_success_rate_percent": "Check handover config",
}
# "low": values under the threshold are bad; "high": values over it are bad.
SLA_BAD_SIDE = {
    "throughput_dl_mbps": "low", "one_way_latency_ms": "high",
    "bler_percent": "high", "handover_success_rate_percent": "low",
}
SLA_KPIS = list(SLA_BAD_SIDE)
FORECAST_UNITS = {
    "one_way_latency_ms": "ms", "bler_percent": "%",
    "throughput_dl_mbps": "Mbps", "handover_success_rate_percent": "%",
}
FORECAST_TOLERANCE = {
    "one_way_latency_ms": 2.0, "bler_percent": 0.5,
    "throughput_dl_mbps": 5.0, "handover_success_rate_percent": 0.5,
}
FORECAST_FEATURES = {
    "one_way_latency_ms": [
        "one_way_latency_ms", "jitter_ms", "rtt_ms", "packet_delay_budget_ms",
        "bler_percent", "packet_loss_percent", "throughput_dl_mbps"],
    "bler_percent": [
        "bler_percent", "reliability_percent", "packet_loss_percent",
        "packet_loss_rate_percent", "throughput_dl_mbps", "spectral_efficiency_bps_hz",
        "one_way_latency_ms"],
    "throughput_dl_mbps": [
        "throughput_dl_mbps", "throughput_ul_mbps", "spectral_efficiency_bps_hz",
        "energy_efficiency_bits_per_joule", "bler_percent", "reliability_percent",
        "one_way_latency_ms"],
    "handover_success_rate_percent": [
        "handover_success_rate_percent", "handover_interruption_time_ms",
        "one_way_latency_ms", "rtt_ms", "throughput_dl_mbps", "bler_percent",
        "packet_loss_percent"],
}
SERVING_FEATURES = [
    "slice_type", "latitude", "longitude", "one_way_latency_ms", "jitter_ms",
    "packet_delay_budget_ms", "handover_interruption_time_ms", "packet_loss_percent",
    "throughput_dl_mbps", "handover_success_rate_percent",
    "year", "month", "day", "hour", "minute", "second",
]
TRAINER_FEATURES = KPIS + ["slice_type_encoded"]
DATE_PARTS = ["year", "month", "day", "hour", "minute", "second"]
POSITION_AND_DATE = ["latitude", "longitude"] + DATE_PARTS
FALLBACK_DATE_PARTS = [2026, 1, 1, 0, 0, 0]
NORMAL = "normal"
# End of fixed values.

# Timestamps carry no zone, as in the source files.
_ID = [("timestamp", T.TimestampNTZType()), ("cell_id", T.StringType()),
       ("ue_id", T.StringType()), ("slice_type", T.StringType()),
       ("latitude", T.DoubleType()), ("longitude", T.DoubleType())]
_SERVED_KPIS = [
    "one_way_latency_ms", "jitter_ms", "rtt_ms", "throughput_dl_mbps", "throughput_ul_mbps",
    "packet_loss_percent", "reliability_percent", "bler_percent",
    "handover_success_rate_percent", "energy_efficiency_bits_per_joule",
]


def _struct(fields):
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


RAW_RECORD = _struct(
    _ID + [(k, T.DoubleType()) for k in KPIS]
    + [("anomaly", T.IntegerType()), ("anomaly_type", T.StringType())])

SCORED_RECORD = _struct(
    _ID + [(k, T.DoubleType()) for k in _SERVED_KPIS]
    + [("ml_prediction", T.IntegerType()), ("ml_confidence", T.DoubleType()),
       ("ml_anomaly_label", T.StringType()), ("ml_anomaly_type", T.StringType()),
       ("ml_anomaly_type_confidence", T.DoubleType()),
       ("actual_anomaly", T.IntegerType()), ("actual_anomaly_type", T.StringType())])

PREDICTIONS = T.StructType(
    [T.StructField("id", T.LongType(), True)] + SCORED_RECORD.fields
    + [T.StructField("ingested_at", T.TimestampNTZType(), True)])

ALERTS = _struct([
    ("id", T.LongType()), ("alert_time", T.TimestampNTZType()), ("cell_id", T.StringType()),
    ("slice_type", T.StringType()), ("kpi", T.StringType()), ("kpi_value", T.DoubleType()),
    ("threshold", T.DoubleType()), ("alert_message", T.StringType()),
    ("alert_action", T.StringType()), ("severity", T.StringType()),
    ("created_at", T.TimestampNTZType())])

ROLLUP_COUNTS = _struct(
    [("hour", T.TimestampNTZType()), ("cell_id", T.StringType()), ("slice_type", T.StringType()),
     ("ml_anomaly_type", T.StringType()), ("actual_anomaly_type", T.StringType()),
     ("n", T.LongType()), ("ml", T.LongType()), ("flagged", T.LongType()), ("actual", T.LongType())]
    + [part for k in SLA_KPIS for part in ((f"{k}_n", T.LongType()), (f"{k}_sum", T.DoubleType()))])

ROLLUP_DEVICES = _struct([
    ("hour", T.TimestampNTZType()), ("cell_id", T.StringType()), ("slice_type", T.StringType()),
    ("ue_id", T.StringType()), ("n", T.LongType())])

FACT_PREDICTIONS = _struct([
    ("timestamp", T.TimestampNTZType()), ("cell_id", T.StringType()), ("ue_id", T.StringType()),
    ("slice_type", T.StringType()), ("kpi_name", T.StringType()),
    ("actual_value", T.DoubleType()), ("predicted_value", T.DoubleType()),
    ("confidence_upper", T.DoubleType()), ("confidence_lower", T.DoubleType()),
    ("model_name", T.StringType())])

NETWORK_COLUMNS = [
    "timestamp", "cell_id", "slice_type", "latitude", "longitude", "one_way_latency_ms",
    "jitter_ms", "rtt_ms", "throughput_dl_mbps", "throughput_ul_mbps", "packet_loss_percent",
    "bler_percent", "handover_success_rate_percent",
]
