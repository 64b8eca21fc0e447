"""Registered listings, health, summary and timeline queries."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from cellpulse import schema
from cellpulse.plans import alerts as al, monitoring as mo, paging, rollup
from cellpulse.session import materialise, new_path, rounded
from cellpulse.sources import files, tables
from cellpulse.sources.kpi_view import kpi_view, predictions_table, raw_records


def latest(df: DataFrame):
    """Newest ingestion time, one value."""
    return df.agg(F.max("ingested_at")).first()[0]


def alert_table(spark: SparkSession, sf: str) -> DataFrame:
    return al.evaluate_sla(kpi_view(spark, sf), al.thresholds_table(spark))


def last_day(spark, sf, **filters):
    df = kpi_view(spark, sf)
    return mo.scope_of(df, latest(df), 24, **filters)


# ---- sources -------------------------------------------------------------

def src_csv_roundtrip(spark, sf):
    path = new_path(spark, "csv")
    files.write_csv(raw_records(spark, sf), path, files.MICROS)
    return rounded(files.read_csv(spark, path, schema.RAW_RECORD, files.MICROS))


def src_row_batch(spark, sf):
    rows = kpi_view(spark, sf).select("id", *schema.RAW_RECORD.names)
    return rounded(files.row_batch(rows, 2, 400, ["timestamp", "id"]))


def src_schema_evolve(spark, sf):
    root = new_path(spark, "tables")
    paths = tables.init_tables(spark, root)
    tables.init_tables(spark, root)
    rows = predictions_table(spark, sf)
    older = F.col("ml_prediction") == 0
    rows.where(older).drop("ue_id").write.mode("append").parquet(
        tables.batch_path(paths["predictions"], "2024-01-01", 1))
    rows.where(~older).write.mode("append").parquet(
        tables.batch_path(paths["predictions"], "2024-01-02", 2))
    return rounded(tables.read_table(spark, paths["predictions"], schema.PREDICTIONS))


# ---- filters, projections, sort, limit -----------------------------------

def q_predictions(spark, sf):
    return rounded(mo.predictions(
        predictions_table(spark, sf), slice_type="URLLC", anomaly_only=True,
        start_time="2024-01-03", end_time="2024-01-28", limit=100, offset=5))


def q_predictions_deep(spark, sf):
    """A page far behind the newest row."""
    return rounded(mo.predictions(predictions_table(spark, sf), limit=300, offset=450))


def q_page_keyset(spark, sf):
    """The third page of 200 rows, reached by the cursors of the two before."""
    df, newest, mark = predictions_table(spark, sf), ["timestamp", "id"], None
    for _ in range(2):
        mark = paging.cursor(paging.page_after(df, newest, mark, 200).collect()[-1], newest)
    return rounded(paging.page_after(df, newest, mark, 200))


def q_page_jump(spark, sf):
    """A page at a position, found from counts per unit of time."""
    return rounded(paging.page_at(predictions_table(spark, sf), ["timestamp", "id"], 120, 333,
                                  top_rows=150))


def q_network(spark, sf):
    return rounded(mo.network(predictions_table(spark, sf), cell_id="gNB-009", limit=50, offset=3))


def q_alerts(spark, sf):
    return rounded(mo.alert_list(alert_table(spark, sf), slice_type="eMBB", severity="Critical"))


def q_cells(spark, sf):
    return mo.cells(kpi_view(spark, sf))


def q_in_filter(spark, sf):
    return rounded(mo.in_slices(predictions_table(spark, sf), ["eMBB", "mMTC"])
                   .select("id", "slice_type", "one_way_latency_ms"))


def q_top_cells(spark, sf):
    df = kpi_view(spark, sf)
    return mo.top_cells(mo.network_health(df, latest(df)))


def q_alert_board(spark, sf):
    return mo.alert_board(alert_table(spark, sf), ["eMBB", "URLLC"])


def q_dedup(spark, sf):
    """Distinct order lines without their keys, which do repeat."""
    lines = spark.read.parquet(f"{sf}/lineitem.parquet").select(
        "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus")
    return rounded(lines.dropDuplicates())


def q_drop_cols_nulls(spark, sf):
    # Rows without a quality label get a null there and are dropped.
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang", "source", "n_chars")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    return mo.drop_nulls_and_columns(docs.join(labels, "doc_id", "left"),
                                     ["quality", "toxic"], ["source"])


def q_recent_anomalies(spark, sf):
    return rounded(mo.recent_anomalies(predictions_table(spark, sf)))


# ---- joins ---------------------------------------------------------------

def join_sla_broadcast(spark, sf):
    joined = kpi_view(spark, sf).select("id", "slice_type").join(
        al.thresholds_table(spark), "slice_type")
    return (joined.groupBy("slice_type", "kpi", "threshold", "bad_side", "action")
            .agg(F.count(F.lit(1)).alias("n")))


def join_dominant_left(spark, sf):
    scope = last_day(spark, sf)
    return mo.with_dominant_type(mo.cell_counts(scope), scope)


# ---- aggregates ----------------------------------------------------------

def q_sla_status(spark, sf):
    return mo.sla_status(kpi_view(spark, sf), al.thresholds_table(spark))


def q_network_health(spark, sf):
    df = kpi_view(spark, sf)
    return mo.network_health(df, latest(df))


def q_health_totals(spark, sf):
    df = kpi_view(spark, sf)
    return mo.health_totals(df, latest(df))


def q_severity_ranking(spark, sf):
    return mo.severity_ranking(kpi_view(spark, sf))


def q_dominant_type(spark, sf):
    return mo.dominant_type(kpi_view(spark, sf))


def q_anomaly_summary(spark, sf):
    return mo.anomaly_head(last_day(spark, sf)).drop("dominant_anomaly_type",
                                                    "avg_anomaly_duration_min")


def q_type_distribution(spark, sf):
    return mo.type_distribution(kpi_view(spark, sf))


def q_avg_duration(spark, sf):
    return mo.anomaly_head(kpi_view(spark, sf)).select(
        "dominant_anomaly_type", "avg_anomaly_duration_min")


def q_timeline(spark, sf):
    df = kpi_view(spark, sf)
    return mo.timeline(df, latest(df), 24)


def q_timeline_by_type(spark, sf):
    df = kpi_view(spark, sf)
    return mo.timeline_by_type(df, latest(df), 24 * 30)


def q_breach_trend(spark, sf):
    alerts = alert_table(spark, sf)
    return mo.breach_trend(alerts, latest(kpi_view(spark, sf)), 48)


def q_timeline_rollup(spark, sf):
    df = kpi_view(spark, sf)
    return mo.timeline_rollup(mo.timeline(df, latest(df), 24 * 7))


def q_value_counts(spark, sf):
    return rounded(mo.value_counts(kpi_view(spark, sf), "anomaly_type"))


def q_rate_by_slice(spark, sf):
    return rounded(mo.rate_by_slice(kpi_view(spark, sf)))


def q_daily(spark, sf):
    return rounded(mo.daily(kpi_view(spark, sf)))


def q_daily_stats(spark, sf):
    return rounded(mo.daily_stats(mo.daily(kpi_view(spark, sf))))


def q_compliance(spark, sf):
    return mo.compliance(mo.sla_status(kpi_view(spark, sf), al.thresholds_table(spark)))


def q_profile(spark, sf):
    return rounded(mo.profile(raw_records(spark, sf)))


def q_live_counters(spark, sf):
    return rounded(mo.live_counters(kpi_view(spark, sf)))


def q_live_top_cells(spark, sf):
    return rounded(mo.top_rate_cells(kpi_view(spark, sf)))


def q_live_top_types(spark, sf):
    return mo.top_types(kpi_view(spark, sf))


def alerts_eval(spark, sf):
    return rounded(alert_table(spark, sf))


def alerts_breach_counts(spark, sf):
    return rounded(al.breach_counts(alert_table(spark, sf)))


def q_sla_status_nested(spark, sf):
    """Map form of the status, read back one KPI at a time."""
    nested = mo.sla_status_nested(mo.sla_status(kpi_view(spark, sf), al.thresholds_table(spark)))
    latency = F.element_at("kpi_status", F.lit("one_way_latency_ms"))
    return nested.select("slice_type", "total_records",
                         F.size("kpi_status").alias("kpis"),
                         latency["value"].alias("latency"),
                         latency["threshold"].alias("latency_threshold"),
                         latency["meets_sla"].alias("latency_meets_sla"))


# ---- the same from hourly partials ---------------------------------------

def _partials(spark, sf, hours=None):
    """Stored roll-up of all records, all of it or cut to the last hours."""
    df = kpi_view(spark, sf)
    made = rollup.build(df)
    parts = rollup.Rollup(materialise(made.counts, "counts"), materialise(made.devices, "devices"))
    return rollup.scope(parts, df, latest(df), hours) if hours else parts


def roll_network_health(spark, sf):
    return rollup.network_health(_partials(spark, sf, 24))


def roll_health_totals(spark, sf):
    return rollup.health_totals(_partials(spark, sf, 24))


def roll_sla_status(spark, sf):
    return rollup.sla_status(_partials(spark, sf), al.thresholds_table(spark))


def roll_timeline(spark, sf):
    return rollup.timeline(_partials(spark, sf, 24))


def roll_timeline_by_type(spark, sf):
    return rollup.timeline_by_type(_partials(spark, sf, 24 * 30))


def roll_type_distribution(spark, sf):
    return rollup.type_distribution(_partials(spark, sf))


def roll_severity_ranking(spark, sf):
    return rollup.severity_ranking(_partials(spark, sf))


def roll_anomaly_summary(spark, sf):
    return rollup.anomaly_head(_partials(spark, sf, 24)).drop("dominant_anomaly_type",
                                                             "avg_anomaly_duration_min")


def roll_avg_duration(spark, sf):
    return rollup.anomaly_head(_partials(spark, sf)).select(
        "dominant_anomaly_type", "avg_anomaly_duration_min")


MONITORING = {f.__name__: f for f in [
    src_csv_roundtrip, src_row_batch, src_schema_evolve, q_predictions, q_predictions_deep,
    q_page_keyset, q_page_jump,
    q_network, q_alerts, q_cells, q_in_filter, q_top_cells, q_alert_board, q_dedup,
    q_drop_cols_nulls, q_recent_anomalies, join_sla_broadcast, join_dominant_left, q_sla_status,
    q_sla_status_nested, q_network_health, q_health_totals, q_severity_ranking, q_dominant_type,
    q_anomaly_summary, q_type_distribution, q_avg_duration, q_timeline, q_timeline_by_type,
    q_breach_trend, q_timeline_rollup, q_value_counts, q_rate_by_slice, q_daily, q_daily_stats,
    q_compliance, q_profile, q_live_counters, q_live_top_cells, q_live_top_types, alerts_eval,
    alerts_breach_counts, roll_network_health, roll_health_totals, roll_sla_status, roll_timeline,
    roll_timeline_by_type, roll_type_distribution, roll_severity_ranking, roll_anomaly_summary,
    roll_avg_duration]}
