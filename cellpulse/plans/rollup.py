"""Hourly partial aggregates that served queries merge instead of reading the records again.

Two frames make a roll-up. ``counts`` holds sums per hour of ingestion, cell, slice and anomaly
types; ``devices`` holds the set of devices per hour, cell and slice. Partials of one key may stand
in several rows (one per micro-batch): every query sums them, so they can be merged in any order.
All results equal those of ``plans.monitoring`` on the records.
"""

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from cellpulse import schema
from cellpulse.functions.scalar import hour_label, hours_before, meets
from cellpulse.plans import monitoring as mo

COUNT_KEYS = ["hour", "cell_id", "slice_type", "ml_anomaly_type", "actual_anomaly_type"]
DEVICE_KEYS = ["hour", "cell_id", "slice_type", "ue_id"]


class Rollup(NamedTuple):
    counts: DataFrame
    devices: DataFrame


def hour_of(ts: Column) -> Column:
    """Start of the hour, without a detour over a time zone."""
    return F.to_date(ts).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.hour(ts))


def build(rows: DataFrame) -> Rollup:
    """Partials of scored records; both frames reduce map-side."""
    known = rows.withColumn("hour", hour_of(F.col("ingested_at")))
    measures = [F.count(F.lit(1)).alias("n"), F.sum("ml_prediction").cast("long").alias("ml"),
                F.count_if(F.col("ml_prediction") == 1).alias("flagged"),
                F.sum("actual_anomaly").cast("long").alias("actual")]
    for kpi in schema.SLA_KPIS:
        measures += [F.count(kpi).alias(f"{kpi}_n"), F.sum(kpi).alias(f"{kpi}_sum")]
    return Rollup(known.groupBy(*COUNT_KEYS).agg(*measures).select(schema.ROLLUP_COUNTS.names),
                  known.groupBy(*DEVICE_KEYS).agg(F.count(F.lit(1)).alias("n")))


def merge(parts: Rollup) -> Rollup:
    """One row per key, for the nightly rewrite of a closed day."""
    sums = [F.sum(c).alias(c) for c in schema.ROLLUP_COUNTS.names if c not in COUNT_KEYS]
    return Rollup(parts.counts.groupBy(*COUNT_KEYS).agg(*sums),
                  parts.devices.groupBy(*DEVICE_KEYS).agg(F.sum("n").alias("n")))


def scope(parts: Rollup, rows: DataFrame, as_of=None, hours: int = 24, slice_type=None) -> Rollup:
    """Partials of the last hours: whole hours as stored, the cut first hour from its records.

    The scan of the records is pruned to that one hour.
    """
    since = hours_before(as_of, hours)
    at = F.col("ingested_at")
    edge = rows.where((at >= since) & (at < since + F.expr("interval 1 hour")))
    if "ingest_date" in rows.columns:
        edge = edge.where(F.col("ingest_date").between(F.to_date(since), F.date_add(F.to_date(since), 1)))
    cut = build(edge.where(hour_of(at) < since))
    whole = [part.where(F.col("hour") >= since) for part in parts]
    both = [w.select(c.columns).unionByName(c) for w, c in zip(whole, cut)]
    if slice_type:
        both = [b.where(F.col("slice_type") == slice_type) for b in both]
    return Rollup(*both)


def network_health(parts: Rollup) -> DataFrame:
    sides = parts.counts.select("cell_id", "n", "actual", "actual_anomaly_type").unionByName(
        parts.devices.select("cell_id", "ue_id").distinct(), allowMissingColumns=True)
    # Distinct pairs and types are few; counting over them keeps a busy cell spread out.
    groups = sides.groupBy("cell_id", "ue_id", "actual_anomaly_type").agg(
        F.sum("n").alias("n"), F.sum("actual").alias("actual"))
    per_cell = groups.groupBy("cell_id").agg(
        F.sum("n").alias("total"), F.sum("actual").alias("anomaly_count"),
        F.max("actual_anomaly_type").alias("dominant_anomaly_type"),
        F.count_if(F.col("ue_id").isNotNull()).alias("ue_count"))
    rate = F.coalesce(F.col("anomaly_count"), F.lit(0)) / F.col("total")
    return (per_cell.withColumn("anomaly_rate", F.round(rate, 4))
            .withColumn("status", mo.status_of(rate))
            .orderBy(F.desc_nulls_last("anomaly_count"), "cell_id"))


def health_totals(parts: Rollup) -> DataFrame:
    """Cells per status, and devices and records with a known device."""
    cells = parts.counts.groupBy("cell_id").agg(F.sum("n").alias("n"), F.sum("actual").alias("a"))
    devices = (parts.devices.where("ue_id IS NOT NULL").groupBy("ue_id")
               .agg(F.sum("n").alias("known")))
    status = mo.status_of(F.coalesce(F.col("a"), F.lit(0)) / F.col("n"))
    both = cells.unionByName(devices, allowMissingColumns=True)
    cell = F.col("n").isNotNull()
    return both.agg(
        F.count_if(cell).alias("total_cells"),
        *[F.count_if(cell & (status == s)).alias(s.lower())
          for s in ("Healthy", "Degraded", "Critical")],
        F.count_if(~cell).alias("active_ues"),
        F.coalesce(F.sum("known"), F.lit(0)).alias("total_records"))


def sla_status(parts: Rollup, thresholds: DataFrame) -> DataFrame:
    kpis = schema.SLA_KPIS
    sums = parts.counts.groupBy("slice_type").agg(
        F.sum("n").alias("total_records"), F.sum("ml").alias("total_anomalies"),
        *[F.try_divide(F.sum(f"{k}_sum"), F.sum(f"{k}_n")).alias(k) for k in kpis])
    long = sums.unpivot(["slice_type", "total_records", "total_anomalies"], kpis, "kpi", "mean")
    return long.join(thresholds, ["slice_type", "kpi"], "left").select(
        "slice_type", "total_records", "total_anomalies", "kpi",
        F.round("mean", 4).alias("value"), "threshold",
        F.when(F.col("mean").isNotNull() & F.col("threshold").isNotNull(),
               meets(F.col("mean"), F.col("threshold"), F.col("bad_side"))).alias("meets_sla"))


def timeline(parts: Rollup) -> DataFrame:
    return (parts.counts.groupBy(hour_label(F.col("hour")).alias("hour"), "slice_type")
            .agg(F.sum("ml").alias("anomaly_count"), F.sum("n").alias("total"))
            .orderBy("hour", "slice_type"))


def timeline_by_type(parts: Rollup) -> DataFrame:
    return (parts.counts.where("flagged > 0")
            .groupBy(hour_label(F.col("hour")).alias("hour"), "ml_anomaly_type")
            .agg(F.sum("flagged").alias("count")).orderBy("hour", "ml_anomaly_type"))


def type_distribution(parts: Rollup) -> DataFrame:
    return (parts.counts.where("flagged > 0").groupBy("ml_anomaly_type")
            .agg(F.sum("flagged").alias("count")).orderBy(F.desc("count"), "ml_anomaly_type"))


def severity_ranking(parts: Rollup, n: int = 20) -> DataFrame:
    """Cells with the most anomalies, their most frequent type and severity.

    Records without a cell form one row without a type, as after the join on the records.
    """
    types = parts.counts.groupBy("cell_id", "ml_anomaly_type").agg(
        F.sum("n").alias("n"), F.sum("ml").alias("ml"), F.sum("flagged").alias("f"))
    best = F.min_by("ml_anomaly_type", F.when(
        (F.col("f") > 0) & F.col("cell_id").isNotNull(), F.struct(-F.col("f"), "ml_anomaly_type")))
    cells = types.groupBy("cell_id").agg(
        best.alias("dominant_anomaly_type"), F.coalesce(F.sum("ml"), F.lit(0)).alias("anomaly_count"),
        F.sum("n").alias("n"))
    rate = F.col("anomaly_count") / F.col("n")
    severity = F.when(rate >= 0.2, "Critical").when(rate >= 0.05, "Medium").otherwise("Low")
    return (cells.select("cell_id", "dominant_anomaly_type", F.round(rate, 4).alias("anomaly_rate"),
                         "anomaly_count", severity.alias("severity"))
            .orderBy(F.desc("anomaly_count"), "cell_id").limit(n))


def anomaly_head(parts: Rollup) -> DataFrame:
    """Totals in scope, the most frequent type and the mean duration."""
    keys = ["cell_id", "ml_anomaly_type"]
    sides = parts.counts.groupBy(*keys).agg(
        F.sum("n").alias("n"), F.sum("ml").alias("s"), F.sum("flagged").alias("f")).groupingSets(
        [[k] for k in keys], *keys).agg(
        F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("f").alias("f"),
        (F.grouping("cell_id") == 0).alias("_cell"))
    devices = parts.devices.where("ue_id IS NOT NULL").select("ue_id").distinct()
    cell, device = F.col("_cell"), F.col("ue_id").isNotNull()
    known = cell & F.col("cell_id").isNotNull()
    best = F.min_by("ml_anomaly_type", F.when(~cell & (F.col("f") > 0), F.struct(
        -F.col("f"), "ml_anomaly_type")))
    active = F.coalesce(F.sum(F.when(~cell, F.col("s"))), F.lit(0))
    duration = active / F.greatest(F.count_if(known & (F.col("f") > 0)), F.lit(1)) / 60.0
    return sides.unionByName(devices, allowMissingColumns=True).agg(
        F.coalesce(F.sum(F.when(~cell, F.col("n"))), F.lit(0)).alias("total"),
        active.alias("active_anomalies"), best.alias("dominant_anomaly_type"),
        F.count_if(known).alias("affected_cells"), F.count_if(device).alias("affected_ues"),
        F.round(duration, 2).alias("avg_anomaly_duration_min"))
