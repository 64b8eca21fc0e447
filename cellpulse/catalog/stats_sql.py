"""SQL for the statistics queries."""

from cellpulse import schema
from cellpulse.catalog.kpi_sql import long_kpis, r, with_kpi
from cellpulse.functions.tails import normal_score_sql

_LONG = long_kpis()
_PAIRS = [(a, b) for i, a in enumerate(schema.KPIS) for b in schema.KPIS[i + 1:]]
_CORR = "corr_rows AS (" + " UNION ALL ".join(
    f"SELECT '{a}' AS kpi_x, '{b}' AS kpi_y, corr({a}, {b}) AS r FROM kpi"
    for a, b in _PAIRS) + ")"

_DIFF = """
diff AS (SELECT kpi, avg(v) FILTER (anomaly = 0) AS normal_mean,
  avg(v) FILTER (anomaly = 1) AS anomaly_mean FROM long GROUP BY kpi),
diff2 AS (SELECT *, round((anomaly_mean - normal_mean) / normal_mean * 100, 2)
  AS difference_pct FROM diff)"""

# Mid-rank: first rank of the tie group plus half of its extra members.
_RANKED = """
ranked AS (SELECT kpi, {g} AS g, v,
  rank() OVER (PARTITION BY kpi ORDER BY v)
    + (count(*) OVER (PARTITION BY kpi, v) - 1) / 2.0::DOUBLE AS mid,
  count(*) OVER (PARTITION BY kpi, v) AS t FROM long {where})"""

_TRANSFORMS = {"none": "v", "cube_root": "sign(v) * cbrt(abs(v))",
               "log": "sign(v) * ln(1 + abs(v))", "square_root": "sign(v) * sqrt(abs(v))"}
_SCORED = ("normal_scores AS (SELECT kpi, v, " + normal_score_sql(
    "((row_number() OVER (PARTITION BY kpi ORDER BY v) - 0.375::DOUBLE) / "
    "(count(*) OVER (PARTITION BY kpi) + 0.25::DOUBLE))") + " AS m FROM long)")
_SHAPIRO = "shapiro AS (" + " UNION ALL ".join(
    f"SELECT kpi, '{name}' AS transform, count(*) AS n, corr({text}, m) ** 2 AS w "
    "FROM normal_scores GROUP BY kpi" for name, text in _TRANSFORMS.items()) + ")"


def _chi2(name: str, a: str, b: str, where: str = "") -> str:
    return (f"SELECT n, CASE WHEN dof = 1 THEN yates ELSE plain END AS chi2, dof, '{name}' AS test "
            "FROM (SELECT CAST(max(n) AS BIGINT) AS n, round(sum((o - ex) * (o - ex) / ex), 6) "
            "AS plain, round(sum((abs(o - ex) - least(0.5, abs(o - ex))) ** 2 / ex), 6) AS yates, "
            "(count(DISTINCT a) - 1) * (count(DISTINCT b) - 1) AS dof FROM ("
            "SELECT a, b, o, sum(o) OVER (PARTITION BY a) * sum(o) OVER (PARTITION BY b)::DOUBLE "
            "/ sum(o) OVER () AS ex, sum(o) OVER () AS n FROM (SELECT l.a, m.b, count(x.id) AS o "
            f"FROM (SELECT DISTINCT {a} AS a FROM kpi {where}) l CROSS JOIN "
            f"(SELECT DISTINCT {b} AS b FROM kpi {where}) m LEFT JOIN "
            f"(SELECT id, {a} AS a, {b} AS b FROM kpi {where}) x ON x.a = l.a AND x.b = m.b "
            "GROUP BY l.a, m.b)))")


STATS_SQL = {
    "stat_describe": with_kpi(
        "SELECT kpi, count(v) AS count, round(avg(v), 4) AS mean, round(stddev_samp(v), 4) AS std, "
        "round(min(v), 9) AS min, round(quantile_cont(v, 0.25), 9) AS q25, "
        "round(quantile_cont(v, 0.5), 9) AS q50, round(quantile_cont(v, 0.75), 9) AS q75, "
        "round(max(v), 9) AS max FROM long GROUP BY kpi", _LONG),
    "stat_mean_diff": with_kpi(
        f"SELECT kpi, {r('normal_mean', 'anomaly_mean', digits=4)}, difference_pct FROM diff2",
        _LONG, _DIFF),
    "stat_discriminance": with_kpi(
        "SELECT kpi, difference_pct, abs(difference_pct) AS abs_difference, "
        "CASE WHEN abs(difference_pct) > 50 THEN 'high' WHEN abs(difference_pct) >= 20 "
        "THEN 'moderate' ELSE 'low' END AS level, CASE WHEN difference_pct > 0 THEN 'increases' "
        "ELSE 'decreases' END AS trend FROM diff2", _LONG, _DIFF),
    "stat_crosstab": with_kpi(
        "SELECT coalesce(slice_type, 'All') AS slice_type, "
        "coalesce(CAST(anomaly AS VARCHAR), 'All') AS anomaly, count(*) AS n FROM kpi "
        "GROUP BY CUBE (kpi.slice_type, kpi.anomaly)"),
    "stat_crosstab_types": with_kpi(
        "SELECT anomaly_type, " + ", ".join(
            f"count(*) FILTER (slice_type = '{s}') AS \"{s}\"" for s in schema.SLICES)
        + ', count(*) AS "All" FROM kpi WHERE anomaly = 1 GROUP BY anomaly_type'),
    "stat_chi2": with_kpi(" UNION ALL ".join([
        _chi2("slice_anomaly", "slice_type", "anomaly"),
        _chi2("type_slice", "anomaly_type", "slice_type", "WHERE anomaly = 1"),
        _chi2("night_anomaly", 'hour("timestamp") < 6', "anomaly")])),
    "stat_mannwhitney": with_kpi(
        "SELECT kpi, round(sum(mid) FILTER (g = 0) - count(*) FILTER (g = 0) * "
        "(count(*) FILTER (g = 0) + 1) / 2.0::DOUBLE, 2) AS u_statistic FROM ranked GROUP BY kpi",
        _LONG, _RANKED.format(g="anomaly", where="")),
    "stat_kruskal": with_kpi(
        "SELECT kpi, round((12.0::DOUBLE / (n * (n + 1)) * s - 3 * (n + 1)) "
        "/ (1 - ties / (n * n * n - n)), 4) AS h_statistic, dof FROM (SELECT kpi, "
        "sum(n_g)::DOUBLE AS n, sum(r * r / n_g) AS s, sum(tie) AS ties, count(*) - 1 AS dof FROM "
        "(SELECT kpi, g, count(*) AS n_g, sum(mid) AS r, sum(t::DOUBLE * t - 1) AS tie "
        "FROM ranked GROUP BY kpi, g) GROUP BY kpi)",
        _LONG, _RANKED.format(g="anomaly_type", where="WHERE anomaly = 1")),
    "stat_normality": with_kpi(
        "SELECT kpi, n, round(sk, 3) AS skew, round(ku, 3) AS excess_kurtosis, "
        "round(n / 6.0::DOUBLE * (sk * sk + ku * ku / 4), 3) AS jb, "
        "exp(-n / 12.0::DOUBLE * (sk * sk + ku * ku / 4)) > 0.05 AS normal FROM ("
        "SELECT kpi, count(*) AS n, avg((v - m) ** 3) / pow(avg((v - m) ** 2), 1.5) AS sk, "
        "avg((v - m) ** 4) / pow(avg((v - m) ** 2), 2) - 3 AS ku FROM "
        "(SELECT kpi, v, avg(v) OVER (PARTITION BY kpi) AS m FROM long) GROUP BY kpi)", _LONG),
    "stat_shapiro_francia": with_kpi(
        "SELECT kpi, transform, n, round(w, 6) AS w, round(z, 3) AS z, z < 1.6448536269514722 "
        "AS normal FROM (SELECT *, (ln(1 - w) - (-1.2725 + 1.0521 * (ln(ln(n)) - ln(n)))) / "
        "(1.0308 - 0.26758 * (ln(ln(n)) + 2 / ln(n))) AS z FROM shapiro)",
        _LONG, _SCORED, _SHAPIRO),
    "stat_most_normal": with_kpi(
        "SELECT kpi, transform AS best_transform, round(w, 6) AS w FROM (SELECT *, row_number() "
        "OVER (PARTITION BY kpi ORDER BY w DESC, transform) AS rn FROM shapiro) WHERE rn = 1",
        _LONG, _SCORED, _SHAPIRO),
    "stat_corr": with_kpi("SELECT kpi_x, kpi_y, round(r, 6) AS r FROM corr_rows", _CORR),
    "stat_strong_pairs": with_kpi(
        "SELECT kpi_x, kpi_y, round(r, 3) AS r FROM corr_rows WHERE abs(r) > 0.7", _CORR),
    "stat_histogram": with_kpi(
        "SELECT bin, coalesce(c, 0) AS count, round(lo + (bin - 1) * (hi - lo) / 50, 6) AS lower, "
        "round(lo + bin * (hi - lo) / 50, 6) AS upper FROM (SELECT unnest(generate_series(1, 50)) "
        "AS bin) LEFT JOIN (SELECT least(CAST(floor(50 * (v - lo) / (hi - lo)) AS INTEGER) + 1, 50) "
        "AS bin, count(*) AS c FROM (SELECT one_way_latency_ms AS v, "
        "min(one_way_latency_ms) OVER () AS lo, max(one_way_latency_ms) OVER () AS hi FROM kpi) "
        "GROUP BY 1) USING (bin), (SELECT min(one_way_latency_ms) AS lo, "
        "max(one_way_latency_ms) AS hi FROM kpi)"),
    "stat_histogram_by_class": with_kpi(
        "SELECT anomaly, bin, c AS count, round(lo + (bin - 1) * (hi - lo) / 30, 6) AS lower, "
        "round(lo + bin * (hi - lo) / 30, 6) AS upper, "
        "round(c / sum(c) OVER (PARTITION BY anomaly)::DOUBLE / ((hi - lo) / 30), 6) AS density "
        "FROM (SELECT a.anomaly, bin, lo, hi, (SELECT count(*) FROM kpi k WHERE "
        "k.anomaly = a.anomaly AND least(CAST(floor(30 * (throughput_dl_mbps - lo) / (hi - lo)) "
        "AS INTEGER) + 1, 30) = bin) AS c FROM (SELECT DISTINCT anomaly FROM kpi) a, "
        "(SELECT unnest(generate_series(1, 30)) AS bin), (SELECT min(throughput_dl_mbps) AS lo, "
        "max(throughput_dl_mbps) AS hi FROM kpi))"),
    "stat_mean_median": with_kpi(
        "SELECT kpi, round(avg(v), 4) AS mean, round(quantile_cont(v, 0.5), 9) AS median "
        "FROM long GROUP BY kpi", _LONG),
    "stat_boxplot": with_kpi(
        "SELECT kpi, anomaly, n, round(q1, 9) AS q1, round(md, 9) AS median, round(q3, 9) AS q3, "
        "round(min(v) FILTER (v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)), 9) "
        "AS whisker_low, round(max(v) FILTER (v BETWEEN q1 - 1.5 * (q3 - q1) AND "
        "q3 + 1.5 * (q3 - q1)), 9) AS whisker_high, count(*) FILTER (NOT (v BETWEEN "
        "q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1))) AS outliers FROM long JOIN "
        "(SELECT kpi, anomaly, count(*) AS n, quantile_cont(v, 0.25) AS q1, "
        "quantile_cont(v, 0.5) AS md, quantile_cont(v, 0.75) AS q3 FROM long "
        "GROUP BY kpi, anomaly) USING (kpi, anomaly) GROUP BY kpi, anomaly, n, q1, md, q3", _LONG),
    "stat_percentile_cut": with_kpi(
        "SELECT anomaly, CAST(rtt_ms > c AS INTEGER) AS flagged, round(c, 6) AS cut, count(*) AS n "
        "FROM kpi, (SELECT quantile_cont(rtt_ms, 0.95) AS c FROM kpi WHERE anomaly = 0) "
        "GROUP BY ALL"),
}
