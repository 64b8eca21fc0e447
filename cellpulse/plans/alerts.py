"""Service-level thresholds and the alerts they raise."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from cellpulse import schema
from cellpulse.functions.scalar import breaches, one_decimal, proximity
from cellpulse.session import small_broadcast, small_table


def thresholds_table(spark: SparkSession, thresholds: dict = None) -> DataFrame:
    """One row per (slice, KPI); built from the configuration dict, so small by nature."""
    rows = [(s, kpi, float(t), schema.SLA_BAD_SIDE[kpi],
             schema.SLA_ACTIONS.get(kpi, "Investigate"))
            for s, kpis in (thresholds or schema.SLA_THRESHOLDS).items()
            for kpi, t in kpis.items()]
    table = small_table(
        spark, "slice_type string, kpi string, threshold double, bad_side string, action string",
        rows)
    return small_broadcast(table, len(rows))


def long_kpis(df: DataFrame, kpis: list, keep: list) -> DataFrame:
    """One row per record and KPI; the scan reads only these columns."""
    return df.select(*keep, *kpis).unpivot(keep, kpis, "kpi", "kpi_value")


def evaluate_sla(df: DataFrame, thresholds: DataFrame) -> DataFrame:
    """One alert row per record and breached KPI.

    Null values, null slices and slices without thresholds raise nothing. The id is the
    record id times the number of checks plus the position of the KPI, hence unique.
    """
    keep = ["id", "timestamp", "cell_id", "slice_type", "ingested_at"]
    checks = schema.SLA_KPIS
    value, limit = F.col("kpi_value"), F.col("threshold")
    breached = (long_kpis(df, checks, keep)
                .join(thresholds, ["slice_type", "kpi"])
                .where(breaches(value, limit, F.col("bad_side"))))
    place = F.array_position(F.array(*[F.lit(k) for k in checks]), F.col("kpi")) - 1
    side = F.when(F.col("bad_side") == "low", "below").otherwise("above")
    message = F.concat(F.col("slice_type"), F.lit(" "), F.col("kpi"), F.lit(" "),
                       one_decimal(value), F.lit(" "), side, F.lit(" SLA "),
                       limit.cast("string"))
    return breached.select(
        (F.col("id") * len(checks) + place).alias("id"),
        F.col("timestamp").alias("alert_time"), "cell_id", "slice_type", "kpi", "kpi_value",
        "threshold", message.alias("alert_message"), F.col("action").alias("alert_action"),
        F.when(proximity(value, limit) > 0.2, "Critical").otherwise("Low").alias("severity"),
        F.col("ingested_at").alias("created_at"))


def breach_counts(alerts: DataFrame) -> DataFrame:
    """Alerts per slice, KPI and severity."""
    return (alerts.groupBy("slice_type", "kpi", "severity")
            .agg(F.count(F.lit(1)).alias("alerts"),
                 F.avg("kpi_value").alias("avg_value")))
