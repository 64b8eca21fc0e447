"""Record listings, health, anomaly summaries, timelines and profiles."""

from pyspark.sql import Column, DataFrame, Window, functions as F

from cellpulse import schema
from cellpulse.functions.scalar import hour_bucket, hour_label, hours_before, meets
from cellpulse.plans.paging import page_at, sorted_page
from cellpulse.session import materialise


def _rows():
    return F.count(F.lit(1))


def page(df: DataFrame, newest: list, limit: int, offset: int = 0) -> DataFrame:
    """Rows ``offset`` to ``offset + limit``, newest first; null keys come last.

    A top-k where it stays small; deep pages are found from counts per unit of time. The first
    sort column is then a time, and the columns together are unique.
    """
    if limit < 0 or offset < 0:
        raise ValueError("limit and offset must not be negative")
    return page_at(df, newest, limit, offset) if offset else sorted_page(df, newest, limit)


def _equal(df: DataFrame, **wanted) -> DataFrame:
    for name, value in wanted.items():
        if value:
            df = df.where(F.col(name) == value)
    return df


def predictions(df: DataFrame, slice_type=None, cell_id=None, anomaly_only=False,
                anomaly_source="ml", limit=1000, offset=0, start_time=None,
                end_time=None) -> DataFrame:
    if limit > 50_000:
        raise ValueError("limit is at most 50000")
    out = _equal(df, slice_type=slice_type, cell_id=cell_id)
    if anomaly_only:
        flag = "actual_anomaly" if anomaly_source == "actual" else "ml_prediction"
        out = out.where(F.col(flag) == 1)
    if start_time:
        out = out.where(F.col("timestamp") >= F.lit(str(start_time)).cast("timestamp_ntz"))
    if end_time:
        out = out.where(F.col("timestamp") <= F.lit(str(end_time)).cast("timestamp_ntz"))
    return page(out, ["timestamp", "id"], limit, offset)


def network(df: DataFrame, slice_type=None, cell_id=None, limit=1000, offset=0) -> DataFrame:
    if limit > 50_000:
        raise ValueError("limit is at most 50000")
    out = _equal(df, slice_type=slice_type, cell_id=cell_id).select("id", *schema.NETWORK_COLUMNS)
    return page(out, ["timestamp", "id"], limit, offset).drop("id")


def alert_list(alerts: DataFrame, slice_type=None, cell_id=None, severity=None, limit=500,
               offset=0) -> DataFrame:
    if limit > 10_000:
        raise ValueError("limit is at most 10000")
    out = _equal(alerts, slice_type=slice_type, cell_id=cell_id, severity=severity)
    return page(out, ["created_at", "id"], limit, offset)


def alert_board(alerts: DataFrame, slices: list, limit: int = 50) -> DataFrame:
    """Newest alerts first, then the slice filter, as the board shows them."""
    newest = alert_list(alerts, limit=limit).where(F.col("slice_type").isin(slices))
    return newest.select(
        F.substring(F.col("alert_time").cast("string"), 12, 5).alias("Alert Time"),
        F.col("slice_type").alias("Slice"), F.col("kpi").alias("KPI"),
        F.col("alert_message").alias("Alert Message"),
        F.col("alert_action").alias("Alert Action"))


def cells(df: DataFrame) -> DataFrame:
    return df.where(F.col("cell_id").isNotNull()).select("cell_id").distinct().orderBy("cell_id")


def in_slices(df: DataFrame, slices: list) -> DataFrame:
    return df.where(F.col("slice_type").isin(slices))


def recent_anomalies(df: DataFrame, buffer: int = 500, shown: int = 10) -> DataFrame:
    """Last flagged rows among the most recent ``buffer`` rows."""
    held = page(df, ["timestamp", "id"], buffer)
    return page(held.where(F.col("ml_prediction") == 1), ["timestamp", "id"], shown)


def drop_nulls_and_columns(df: DataFrame, required: list, drop: list) -> DataFrame:
    return df.dropna(subset=required).drop(*drop)


def kpi_columns(df: DataFrame) -> list:
    """Numeric KPI columns: all columns but the identifiers, position and labels."""
    other = {"timestamp", "cell_id", "ue_id", "slice_type", "latitude", "longitude",
             "anomaly", "anomaly_type"}
    return [c for c in df.columns if c not in other]


# ---- service levels ------------------------------------------------------

def sla_status(df: DataFrame, thresholds: DataFrame, slice_type=None) -> DataFrame:
    """Per slice and KPI: mean value, threshold and whether the mean meets it."""
    kpis = schema.SLA_KPIS
    means = (_equal(df, slice_type=slice_type).groupBy("slice_type")
             .agg(_rows().alias("total_records"), F.sum("ml_prediction").alias("total_anomalies"),
                  *[F.avg(k).alias(k) for k in kpis]))
    long = means.unpivot(["slice_type", "total_records", "total_anomalies"], kpis, "kpi", "mean")
    return long.join(thresholds, ["slice_type", "kpi"], "left").select(
        "slice_type", "total_records", "total_anomalies", "kpi",
        F.round("mean", 4).alias("value"), "threshold",
        F.when(F.col("mean").isNotNull() & F.col("threshold").isNotNull(),
               meets(F.col("mean"), F.col("threshold"), F.col("bad_side"))).alias("meets_sla"))


def sla_status_nested(status: DataFrame) -> DataFrame:
    """One row per slice with a KPI → {value, threshold, meets_sla} map (four entries)."""
    entry = F.struct("kpi", F.struct("value", "threshold", "meets_sla"))
    return (status.groupBy("slice_type", "total_records", "total_anomalies")
            .agg(F.map_from_entries(F.collect_list(entry)).alias("kpi_status")))


def compliance(status: DataFrame) -> DataFrame:
    """Score per slice and KPI: 1.0 met, 0.3 missed, 0.0 unknown."""
    score = (F.when(F.col("meets_sla").isNull(), 0.0).when(F.col("meets_sla"), 1.0)
             .otherwise(0.3))
    return status.select("slice_type", "kpi", score.alias("score"))


# ---- health --------------------------------------------------------------

def _rate(count: str, total: str = "total") -> Column:
    return F.coalesce(F.col(count), F.lit(0)) / F.col(total)


def recent(df: DataFrame, as_of=None, hours: int = 24) -> DataFrame:
    """Rows ingested in the last hours; the bound is a constant, so the scan is pruned by it.

    A table read with its ``ingest_date`` partitions lists only the days in question.
    """
    since = hours_before(as_of, hours)
    if "ingest_date" in df.columns:
        df = df.where(F.col("ingest_date") >= F.to_date(since))
    return df.where(F.col("ingested_at") >= since)


def status_of(rate: Column) -> Column:
    return F.when(rate < 0.02, "Healthy").when(rate < 0.07, "Degraded").otherwise("Critical")


def network_health(df: DataFrame, as_of=None, hours: int = 24) -> DataFrame:
    # Counting per device and type first keeps the pass over the rows a hash aggregate and a
    # busy cell spread out; the text maximum then runs over the few groups only.
    groups = recent(df, as_of, hours).groupBy("cell_id", "ue_id", "actual_anomaly_type").agg(
        _rows().alias("n"), F.sum("actual_anomaly").alias("a"))
    per_cell = groups.groupBy("cell_id").agg(
        F.sum("n").alias("total"), F.sum("a").alias("anomaly_count"),
        F.max("actual_anomaly_type").alias("dominant_anomaly_type"),
        F.countDistinct("ue_id").alias("ue_count"))
    rate = _rate("anomaly_count")
    return (per_cell.withColumn("anomaly_rate", F.round(rate, 4)).withColumn("status", status_of(rate))
            .orderBy(F.desc_nulls_last("anomaly_count"), "cell_id"))


def top_cells(health: DataFrame, n: int = 10) -> DataFrame:
    return (health.select("cell_id", "anomaly_count", "anomaly_rate")
            .orderBy(F.desc("anomaly_count"), "cell_id").limit(n))


def health_totals(df: DataFrame, as_of=None, hours: int = 24) -> DataFrame:
    """Cells per status, and devices and rows with a known device, in one pass."""
    groups = recent(df, as_of, hours).groupBy("cell_id", "ue_id").agg(
        _rows().alias("n"), F.sum("actual_anomaly").alias("a"))
    sides = groups.groupingSets([["cell_id"], ["ue_id"]], "cell_id", "ue_id").agg(
        F.sum("n").alias("total"), F.sum("a").alias("anomaly_count"),
        (F.grouping("cell_id") == 0).alias("_cell"))
    cell, device = F.col("_cell"), ~F.col("_cell") & F.col("ue_id").isNotNull()
    status = status_of(_rate("anomaly_count"))
    return sides.agg(
        F.count_if(cell).alias("total_cells"),
        *[F.count_if(cell & (status == s)).alias(s.lower())
          for s in ("Healthy", "Degraded", "Critical")],
        F.count_if(device).alias("active_ues"),
        F.coalesce(F.sum(F.when(device, F.col("total"))), F.lit(0)).alias("total_records"))


# ---- anomaly summary -----------------------------------------------------

def scope_of(df, as_of, hours, slice_type=None, cell_id=None):
    return _equal(recent(df, as_of, hours), slice_type=slice_type, cell_id=cell_id)


def dominant_type(scope: DataFrame) -> DataFrame:
    """Most frequent predicted type per cell; the first in type order wins a tie."""
    counted = (scope.where(F.col("ml_prediction") == 1)
               .groupBy("cell_id", "ml_anomaly_type").agg(_rows().alias("cnt")))
    best = Window.partitionBy("cell_id").orderBy(F.desc("cnt"), "ml_anomaly_type")
    return (counted.withColumn("_rn", F.row_number().over(best)).where("_rn = 1").drop("_rn")
            .withColumnRenamed("ml_anomaly_type", "dominant_anomaly_type"))


def with_dominant_type(per_cell: DataFrame, scope: DataFrame) -> DataFrame:
    """Left join: a cell without anomalies keeps a null type."""
    return per_cell.join(dominant_type(scope).drop("cnt"), "cell_id", "left")


def cell_counts(scope: DataFrame) -> DataFrame:
    return scope.groupBy("cell_id").agg(_rows().alias("total"),
                                        F.sum("ml_prediction").alias("anomaly_count"))


def severity_ranking(scope: DataFrame, n: int = 20) -> DataFrame:
    rate = _rate("anomaly_count")
    severity = F.when(rate >= 0.2, "Critical").when(rate >= 0.05, "Medium").otherwise("Low")
    return (with_dominant_type(cell_counts(scope), scope)
            .select("cell_id", "dominant_anomaly_type", F.round(rate, 4).alias("anomaly_rate"),
                    F.coalesce("anomaly_count", F.lit(0)).alias("anomaly_count"),
                    severity.alias("severity"))
            .orderBy(F.desc("anomaly_count"), "cell_id").limit(n))


def type_distribution(scope: DataFrame) -> DataFrame:
    return (scope.where(F.col("ml_prediction") == 1).groupBy("ml_anomaly_type")
            .agg(_rows().alias("count")).orderBy(F.desc("count"), "ml_anomaly_type"))


def anomaly_head(scope: DataFrame) -> DataFrame:
    """Totals over all rows in scope, the most frequent type and the mean duration.

    One pass counts rows per cell, device and type; the sides are summed from those groups.
    """
    flagged = F.col("ml_prediction") == 1
    keys = ["cell_id", "ue_id", "ml_anomaly_type"]
    groups = scope.groupBy(*keys).agg(
        _rows().alias("n"), F.sum("ml_prediction").alias("s"), F.count_if(flagged).alias("f"))
    sides = groups.groupingSets([[k] for k in keys], *keys).agg(
        F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("f").alias("f"),
        *[(F.grouping(k) == 0).alias(f"_{k}") for k in keys])
    cell, device, kind = (F.col(f"_{k}") for k in keys)
    known = cell & F.col("cell_id").isNotNull()
    # Largest count first, then the alphabetically first type.
    best = F.min_by("ml_anomaly_type", F.when(kind & (F.col("f") > 0), F.struct(
        (-F.col("f")).alias("n"), "ml_anomaly_type")))
    active = F.coalesce(F.sum(F.when(kind, F.col("s"))), F.lit(0))
    duration = active / F.greatest(F.count_if(known & (F.col("f") > 0)), F.lit(1)) / 60.0
    return sides.agg(
        F.coalesce(F.sum(F.when(kind, F.col("n"))), F.lit(0)).alias("total"),
        active.alias("active_anomalies"), best.alias("dominant_anomaly_type"),
        F.count_if(known).alias("affected_cells"),
        F.count_if(device & F.col("ue_id").isNotNull()).alias("affected_ues"),
        F.round(duration, 2).alias("avg_anomaly_duration_min"))


def anomaly_summary(df: DataFrame, as_of=None, hours: int = 24, slice_type=None,
                    cell_id=None) -> dict:
    scope = scope_of(df, as_of, hours, slice_type, cell_id)
    return {"head": anomaly_head(scope), "types": type_distribution(scope),
            "ranking": severity_ranking(scope)}


# ---- timelines -----------------------------------------------------------

def timeline(df: DataFrame, as_of=None, hours: int = 24, slice_type=None) -> DataFrame:
    """Anomalies per hour of day and slice (the label carries no date)."""
    return (scope_of(df, as_of, hours, slice_type)
            .groupBy(hour_label(F.col("ingested_at")).alias("hour"), "slice_type")
            .agg(F.sum("ml_prediction").alias("anomaly_count"), _rows().alias("total"))
            .orderBy("hour", "slice_type"))


def timeline_by_type(df: DataFrame, as_of=None, hours: int = 24, slice_type=None) -> DataFrame:
    return (scope_of(df, as_of, hours, slice_type).where(F.col("ml_prediction") == 1)
            .groupBy(hour_label(F.col("ingested_at")).alias("hour"), "ml_anomaly_type")
            .agg(_rows().alias("count")).orderBy("hour", "ml_anomaly_type"))


def timeline_rollup(lines: DataFrame) -> DataFrame:
    return (lines.groupBy("hour").agg(F.sum("anomaly_count").alias("anomaly_count"))
            .orderBy("hour"))


def breach_trend(alerts: DataFrame, as_of=None, hours: int = 24) -> DataFrame:
    return (alerts.where(F.col("created_at") >= hours_before(as_of, hours))
            .groupBy(hour_bucket(F.col("created_at")).alias("bucket"), "slice_type")
            .agg(_rows().alias("breach_count")).orderBy("bucket", "slice_type"))


# ---- counts and profiles -------------------------------------------------

def value_counts(df: DataFrame, column: str) -> DataFrame:
    counted = df.groupBy(column).agg(_rows().alias("count"))
    return value_counts_of(counted, column, "count").orderBy(F.desc("count"), column)


def rate_by_slice(df: DataFrame) -> DataFrame:
    """Anomaly count and rate in percent per slice; marks the most and least vulnerable."""
    rates = df.groupBy("slice_type").agg(
        _rows().alias("total"), F.sum("anomaly").alias("anomaly_count"),
        (F.avg("anomaly") * 100).alias("anomaly_rate"))
    every = Window.partitionBy(F.lit(1))  # one row per slice by now
    return (rates
            .withColumn("most_vulnerable", F.col("slice_type") == F.max_by(
                "slice_type", "anomaly_rate").over(every))
            .withColumn("least_vulnerable", F.col("slice_type") == F.min_by(
                "slice_type", "anomaly_rate").over(every)))


def daily(df: DataFrame) -> DataFrame:
    return (df.groupBy(F.to_date("timestamp").alias("date"))
            .agg(F.sum("anomaly").alias("anomalies"), _rows().alias("total"))
            .withColumn("rate", F.col("anomalies") / F.col("total") * 100).orderBy("date"))


def daily_stats(days: DataFrame) -> DataFrame:
    return days.agg(F.min("date").alias("first_day"), F.max("date").alias("last_day"),
                    _rows().alias("days"), F.avg("rate").alias("mean_daily_rate"),
                    F.avg("anomalies").alias("mean_daily_anomalies"))


def profile(df: DataFrame) -> DataFrame:
    """Data set summary as (section, item, n, percent) rows.

    Sections: totals, anomaly types (share of anomalies), cells per slice (the slice of a
    cell is that of its first record) and first and last time stamp.
    """
    # One pass over the rows; every section is summed from these groups.
    groups = materialise(df.groupBy("cell_id", "ue_id", "slice_type", "anomaly", "anomaly_type")
                         .agg(_rows().alias("n"), F.min("timestamp").alias("a"),
                              F.max("timestamp").alias("b")), "profile")
    by_type = groups.groupBy("anomaly", "anomaly_type").agg(F.sum("n").alias("n"))
    wide = by_type.agg(F.sum("n").alias("rows"),
                       F.sum(F.when(F.col("anomaly") == 0, F.col("n"))).alias("normal"),
                       F.sum(F.when(F.col("anomaly") == 1, F.col("n"))).alias("anomalies"))
    entries = F.explode(F.array(*[
        F.struct(F.lit(name).alias("item"), F.col(name).alias("n"),
                 (F.col(name) * 100.0 / F.col("rows")).alias("percent"))
        for name in ("rows", "normal", "anomalies")]))
    totals = wide.select(F.lit("total").alias("section"), entries.alias("e")).select(
        "section", "e.item", "e.n", "e.percent")
    types = value_counts_of(by_type.where("anomaly = 1"), "anomaly_type", "n").select(
        F.lit("anomaly_type").alias("section"), F.col("anomaly_type").alias("item"), "n",
        "percent")
    per_cell = (groups.groupBy("cell_id", "slice_type").agg(F.min("a").alias("t"))
                .groupBy("cell_id").agg(
                    F.min_by("slice_type", F.struct("t", "slice_type")).alias("slice_type")))
    slices = per_cell.groupBy("slice_type").agg(_rows().alias("n")).select(
        F.lit("cells_per_slice").alias("section"), F.col("slice_type").alias("item"), "n",
        F.lit(None).cast("double").alias("percent"))
    ids = groups.agg(F.countDistinct("cell_id").alias("cells"),
                    F.countDistinct("ue_id").alias("ues"),
                    F.min("a").alias("a"), F.max("b").alias("b"))
    none = F.lit(None).cast("long")
    facts = [("distinct", F.lit("cells"), F.col("cells")),
             ("distinct", F.lit("ues"), F.col("ues")),
             ("first_time", F.date_format("a", "yyyy-MM-dd HH:mm:ss"), none),
             ("last_time", F.date_format("b", "yyyy-MM-dd HH:mm:ss"), none)]
    spans = ids.select(F.explode(F.array(*[
        F.struct(F.lit(section).alias("section"), item.alias("item"), n.alias("n"))
        for section, item, n in facts])).alias("e")).select(
        "e.section", "e.item", "e.n", F.lit(None).cast("double").alias("percent"))
    return totals.unionByName(types).unionByName(slices).unionByName(spans)


def value_counts_of(counted: DataFrame, column: str, n: str) -> DataFrame:
    """Share of each group in an already counted, result-sized frame."""
    every = Window.partitionBy(F.lit(1))
    return counted.select(column, n, (F.col(n) * 100.0 / F.sum(n).over(every)).alias("percent"))


def live_counters(df: DataFrame) -> DataFrame:
    """Running figures of the live board in one pass."""
    return df.agg(
        _rows().alias("processed"), F.sum("ml_prediction").alias("anomalies"),
        F.avg(F.when(F.col("ml_prediction") == F.col("actual_anomaly"), 1.0).otherwise(0.0))
        .alias("accuracy"),
        F.avg("one_way_latency_ms").alias("avg_latency"),
        F.avg("throughput_dl_mbps").alias("avg_throughput_dl"))


def top_rate_cells(df: DataFrame, n: int = 20) -> DataFrame:
    return (cell_counts(df).select("cell_id", _rate("anomaly_count").alias("anomaly_rate"))
            .orderBy(F.desc("anomaly_rate"), "cell_id").limit(n))


def top_types(df: DataFrame, n: int = 8) -> DataFrame:
    return type_distribution(df).limit(n)
