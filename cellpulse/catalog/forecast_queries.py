"""Registered look-back, forecast and fact-table queries."""

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from cellpulse import schema
from cellpulse.operators import lookback
from cellpulse.plans import alerts as al, forecast as fc, lag_forecast as lag
from cellpulse.session import materialise, new_path, rounded
from cellpulse.sources import files
from cellpulse.sources.kpi_view import kpi_view

LATENCY = "one_way_latency_ms"
ORDER = ["timestamp", "ue_id", "id"]


def win_lead_target(spark, sf):
    df = kpi_view(spark, sf).select("id", "timestamp", LATENCY)
    return rounded(lookback.lead_target(df, LATENCY, ["timestamp", "id"], block_rows=1000))


def _summed(rows, width):
    """First, last and summed inputs of each window, which identify it."""
    total = F.aggregate(F.flatten("seq"), F.lit(0.0), lambda a, x: a + x)
    return rows.select(
        "id", "position", F.size("seq").alias("length"),
        F.size(F.element_at("seq", 1)).alias("width"),
        F.element_at(F.element_at("seq", 1), 1).alias("first_value"),
        F.element_at(F.element_at("seq", -1), width).alias("last_value"),
        F.round(total, 4).alias("seq_sum"), "target")


def win_sequences(spark, sf):
    features = schema.FORECAST_FEATURES[LATENCY]
    rows = lookback.sequences(kpi_view(spark, sf), features, LATENCY, ORDER, ["cell_id"],
                              block_rows=100)
    return rounded(_summed(rows, len(features)))


def win_sequences_global(spark, sf):
    features = schema.FORECAST_FEATURES["bler_percent"]
    rows = lookback.sequences(kpi_view(spark, sf), features, "bler_percent", ORDER, horizon=2,
                              block_rows=700)
    return rounded(_summed(rows, len(features)))


def win_last_n(spark, sf):
    df = kpi_view(spark, sf).select("cell_id", "id", "timestamp", LATENCY)
    return rounded(lookback.last_n(df, 30, ["timestamp", "id"], ["cell_id"]))


def q_latest_slice(spark, sf):
    return lookback.latest_slice(kpi_view(spark, sf))


def fc_linear(spark, sf):
    df = kpi_view(spark, sf).where(F.col("cell_id") == "gNB-003")
    return rounded(fc.forecast_linear(df, [LATENCY]), 5)


def fc_linear_all(spark, sf):
    return rounded(fc.forecast_linear(kpi_view(spark, sf), schema.SLA_KPIS, ["cell_id"]), 5)


def fc_sla_status(spark, sf):
    df = kpi_view(spark, sf)
    return fc.forecast_status(df, schema.SLA_KPIS, al.thresholds_table(spark), ["cell_id"])


def fc_sla_worst_case(spark, sf):
    """No slice and no cell: the strictest threshold applies."""
    return fc.forecast_status(kpi_view(spark, sf), schema.SLA_KPIS, al.thresholds_table(spark))


def fc_metrics(spark, sf):
    scored = fc.persistence(kpi_view(spark, sf), schema.SLA_KPIS)
    return rounded(fc.forecast_metrics(scored, fc.tolerances(), ["kpi"]))


def _facts(spark, sf, kpis):
    """Fact rows of the persistence forecast, one frame per KPI."""
    scored = materialise(fc.persistence(kpi_view(spark, sf), kpis), "scored")
    errors = {r["kpi"]: r["mae"] for r in
              fc.forecast_metrics(scored, fc.tolerances(), ["kpi"]).collect()}
    return [fc.fact_rows(scored.where(F.col("kpi") == kpi), kpi, errors[kpi], "persistence")
            for kpi in kpis]


def fc_fact_rows(spark, sf):
    return reduce(DataFrame.unionByName, _facts(spark, sf, list(schema.FORECAST_UNITS)))


def fc_history(spark, sf):
    """The last 30 points that the forecast of each cell and KPI starts from."""
    return rounded(fc.history(kpi_view(spark, sf), schema.SLA_KPIS, ["cell_id"]))


def fc_samples(spark, sf):
    scored = materialise(fc.persistence(kpi_view(spark, sf), [LATENCY]), "scored")
    return rounded(fc.sample_view(scored, schema.FORECAST_TOLERANCE[LATENCY]))


def fact_union(spark, sf):
    root = new_path(spark, "facts")
    kpis = list(schema.FORECAST_UNITS)
    for kpi, facts in zip(kpis, _facts(spark, sf, kpis)):
        files.write_csv(facts, f"{root}/{kpi}", files.MICROS)
    # A fifth file stays missing and is skipped.
    return files.union_facts(spark, [f"{root}/{kpi}" for kpi in [*kpis, "none"]], files.MICROS)


def fc_window_model(spark, sf):
    """Scores of the window models of every KPI."""
    return rounded(reduce(DataFrame.unionByName, [
        fc.train_window_models(kpi_view(spark, sf), kpi)[0] for kpi in schema.FORECAST_UNITS]), 4)


def fc_window_facts(spark, sf):
    """Fact rows of each KPI's best trained window model for every cell."""
    return reduce(DataFrame.unionByName, [
        fc.score_all(kpi_view(spark, sf), kpi) for kpi in schema.FORECAST_UNITS])


def fc_lag_moments(spark, sf):
    """Mean products of each KPI with its own values one and twelve rows before."""
    sums = lag.moments(lag.series(kpi_view(spark, sf), schema.SLA_KPIS, train_share=1.0))
    one, twelve = 2 + 7 * 11, 2  # places of the KPI itself
    cells = {"n": (0, 0), "mean": (0, 1), "lag_1": (1, one), "lag_12": (1, twelve),
             "between": (twelve, one)}
    wide = sums.groupBy("kpi").agg(*[
        F.max(F.when((F.col("i") == i) & (F.col("j") == j), F.col("s"))).alias(name)
        for name, (i, j) in cells.items()])
    return rounded(wide.select("kpi", F.col("n").cast("long").alias("n"), *[
        (F.col(c) / F.col("n")).alias(c) for c in cells if c != "n"]), 5)


def fc_ridge(spark, sf):
    """Scores of the ridge forecast of all KPIs on the later fifth of every cell's series."""
    cut = lag.series(kpi_view(spark, sf), schema.SLA_KPIS)
    scored = lag.predict(cut, lag.solve(lag.moments(cut))).where("NOT train")
    return rounded(fc.forecast_metrics(scored, fc.tolerances(), ["kpi"]), 4)


FORECAST = {f.__name__: f for f in [
    win_lead_target, win_sequences, win_sequences_global, win_last_n, q_latest_slice, fc_linear,
    fc_history,
    fc_linear_all, fc_sla_status, fc_sla_worst_case, fc_metrics, fc_fact_rows, fc_samples,
    fact_union, fc_window_model, fc_window_facts, fc_lag_moments, fc_ridge]}
