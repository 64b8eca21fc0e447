"""Registered statistics queries."""

from pyspark.sql import functions as F

from cellpulse import schema
from cellpulse.plans import monitoring as mo, stats as st
from cellpulse.session import rounded
from cellpulse.sources.kpi_view import kpi_view, raw_records

LATENCY = "one_way_latency_ms"


def _raw(spark, sf):
    return raw_records(spark, sf)


def stat_describe(spark, sf):
    return rounded(st.describe(_raw(spark, sf), mo.kpi_columns(_raw(spark, sf))), 9, mean=4, std=4)


def stat_mean_diff(spark, sf):
    return rounded(st.mean_difference(_raw(spark, sf), schema.KPIS), 4)


def stat_discriminance(spark, sf):
    return st.discriminance(st.mean_difference(_raw(spark, sf), schema.KPIS))


def stat_crosstab(spark, sf):
    return st.crosstab(_raw(spark, sf), "slice_type", "anomaly")


def stat_crosstab_types(spark, sf):
    return st.crosstab_wide(_raw(spark, sf).where("anomaly = 1"), "anomaly_type", "slice_type",
                            schema.SLICES)


def stat_chi2(spark, sf):
    df = _raw(spark, sf)
    slices = st.chi2(df, "slice_type", "anomaly").withColumn("test", F.lit("slice_anomaly"))
    types = st.chi2(df.where("anomaly = 1"), "anomaly_type", "slice_type").withColumn(
        "test", F.lit("type_slice"))
    two = st.chi2(df.withColumn("night", F.hour("timestamp") < 6), "night", "anomaly").withColumn(
        "test", F.lit("night_anomaly"))
    return rounded(slices.unionByName(types).unionByName(two).drop("p_value"))


def stat_mannwhitney(spark, sf):
    return rounded(st.mann_whitney(_raw(spark, sf), schema.KPIS).select("kpi", "u_statistic"), 2)


def stat_mannwhitney_p(spark, sf):
    return st.mann_whitney(_raw(spark, sf), schema.KPIS)


def stat_kruskal(spark, sf):
    rows = st.kruskal(_raw(spark, sf).where("anomaly = 1"), schema.KPIS, "anomaly_type")
    return rounded(rows.select("kpi", "h_statistic", "dof"), 4)


def stat_normality(spark, sf):
    return rounded(st.normality(_raw(spark, sf), schema.KPIS)
                   .select("kpi", "n", "skew", "excess_kurtosis", "jb", "normal"), 3)


def stat_shapiro_francia(spark, sf):
    """W of every KPI as it is and under increasing transforms, from one ordering."""
    rows = st.shapiro_francia(_raw(spark, sf), schema.KPIS, st.MONOTONE)
    return rounded(rows, 6, z=3)


def stat_most_normal(spark, sf):
    return rounded(st.most_normal(
        st.shapiro_francia(_raw(spark, sf), schema.KPIS, st.MONOTONE)))


def stat_corr(spark, sf):
    return rounded(st.correlation(_raw(spark, sf), schema.KPIS))


def stat_strong_pairs(spark, sf):
    return st.strong_pairs(st.correlation(_raw(spark, sf), schema.KPIS))


def stat_histogram(spark, sf):
    return rounded(st.histogram(_raw(spark, sf), LATENCY, 50))


def stat_histogram_by_class(spark, sf):
    return rounded(st.histogram(_raw(spark, sf), "throughput_dl_mbps", 30, "anomaly"))


def stat_mean_median(spark, sf):
    return rounded(st.mean_and_median(_raw(spark, sf), schema.KPIS), 4, median=9)


def stat_boxplot(spark, sf):
    return rounded(st.boxplot(_raw(spark, sf), schema.KPIS, "anomaly"), 9)


def stat_percentile_cut(spark, sf):
    flagged = st.percentile_cut(kpi_view(spark, sf), "rtt_ms", 0.95, F.col("anomaly") == 0)
    return rounded(flagged.groupBy("anomaly", "flagged", "cut").agg(
        F.count(F.lit(1)).alias("n")))


STATS = {f.__name__: f for f in [
    stat_describe, stat_mean_diff, stat_discriminance, stat_crosstab, stat_crosstab_types,
    stat_chi2, stat_mannwhitney, stat_mannwhitney_p, stat_kruskal, stat_normality,
    stat_shapiro_francia, stat_most_normal, stat_corr,
    stat_strong_pairs, stat_histogram, stat_histogram_by_class, stat_mean_median, stat_boxplot,
    stat_percentile_cut]}
