"""KPI records derived from the generic ``events`` table."""

from pyspark.sql import DataFrame, SparkSession

from cellpulse import schema


def _type_when(flag: str) -> str:
    names = ", ".join(f"'{name}'" for name in schema.ANOMALY_TYPES)
    return f"CASE WHEN {flag} THEN element_at(array({names}), k % 8 + 1) ELSE '{schema.NORMAL}' END"


_SLICE_NAMES = ", ".join(f"'{s}'" for s in schema.SLICES)

_INPUTS = [
    "event_id", "CAST(ts AS TIMESTAMP_NTZ) AS ts", "user_id", "value AS v",
    "CAST(get_json_object(props, '$.k') AS INT) AS k", "CAST(user_id % 20 AS INT) AS c",
]

_COLUMNS = [
    "event_id AS id",
    "ts AS timestamp",
    "concat('gNB-', lpad(CAST(c + 1 AS STRING), 3, '0')) AS cell_id",
    "concat('UE-', CAST(user_id AS STRING)) AS ue_id",
    f"element_at(array({_SLICE_NAMES}), c % 3 + 1) AS slice_type",
    "33.5D + c * 0.03D AS latitude",
    "-7.7D + c * 0.015D AS longitude",
    "v / 10.0D + 0.0003D AS one_way_latency_ms",
    "k / 20.0D AS jitter_ms",
    "v / 5.0D + k / 10.0D AS rtt_ms",
    "50.0D + k / 2.0D AS packet_delay_budget_ms",
    "5.0D + k * 0.45D AS handover_interruption_time_ms",
    "100.0D - k / 100.0D AS reliability_percent",
    "v / 100.0D AS packet_loss_percent",
    "v / 100.0D AS packet_loss_rate_percent",
    "k / 10.0D AS bler_percent",
    "1000.0D / (1.0D + v / 10.0D) + 0.0003D AS throughput_dl_mbps",
    "500.0D / (1.0D + v / 10.0D) AS throughput_ul_mbps",
    "30.0D / (1.0D + v / 100.0D) AS spectral_efficiency_bps_hz",
    "99.9999993D - (k / 100.0D) * (v / 50.0D) AS handover_success_rate_percent",
    "1e6D * (1 + k) AS energy_efficiency_bits_per_joule",
    "CAST(v > 150 AS INT) AS anomaly",
    _type_when("v > 150") + " AS anomaly_type",
    "CAST(v > 140 AS INT) AS ml_prediction",
    "0.5D + least(abs(v - 140.0D) / 1000.0D, 0.5D) AS ml_confidence",
    f"CASE WHEN v > 140 THEN 'anomaly' ELSE '{schema.NORMAL}' END AS ml_anomaly_label",
    _type_when("v > 140") + " AS ml_anomaly_type",
    "0.5D + k / 200.0D AS ml_anomaly_type_confidence",
    "CAST(v > 150 AS INT) AS actual_anomaly",
    _type_when("v > 150") + " AS actual_anomaly_type",
    "ts AS ingested_at",
]


def kpi_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All raw, scored and ground-truth columns, one row per event, lazily."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return events.selectExpr(*_INPUTS).selectExpr(*_COLUMNS)


def raw_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 22 raw columns."""
    return kpi_view(spark, sf_dir).select(schema.RAW_RECORD.names)


def predictions_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 25 columns of the predictions table."""
    return kpi_view(spark, sf_dir).select(schema.PREDICTIONS.names)
