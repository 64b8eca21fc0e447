"""Edge cases of alerts, summaries, forecasts, statistics and scores on tiny inputs."""

import itertools
import math
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Row, functions as F

from cellpulse import schema
from cellpulse.functions.scalar import decode, encode, one_decimal, safe_date_parts
from cellpulse.functions.tails import chi2_tail, normal_two_sided
from cellpulse.plans import (
    alerts as al, clusters as cl, evaluation as ev, features as fe, forecast as fc,
    monitoring as mo, stats as st)
from cellpulse.sources import files, tables

T0 = datetime(2024, 1, 1)


def records(spark, rows):
    """Prediction rows from partial dicts."""
    full = []
    for i, given in enumerate(rows):
        row = {f.name: None for f in schema.PREDICTIONS.fields}
        row.update(id=i, timestamp=T0 + timedelta(minutes=i), ingested_at=T0 + timedelta(minutes=i),
                   cell_id="c1", ue_id="u1", slice_type="eMBB", ml_prediction=0,
                   ml_anomaly_type="normal", actual_anomaly=0, actual_anomaly_type="normal")
        row.update(given)
        full.append(tuple(row[f.name] for f in schema.PREDICTIONS.fields))
    return spark.createDataFrame(full, schema.PREDICTIONS)


def test_alert_rules(spark):
    df = records(spark, [
        {"throughput_dl_mbps": 100.0, "one_way_latency_ms": 20.0, "bler_percent": 5.0,
         "handover_success_rate_percent": 95.0},           # on the threshold: no breach
        {"throughput_dl_mbps": 99.0, "one_way_latency_ms": 30.0},
        {"slice_type": None, "one_way_latency_ms": 999.0},
        {"slice_type": "other", "one_way_latency_ms": 999.0},
        {"bler_percent": None, "handover_success_rate_percent": 2.25}])
    got = {(r["id"] // 4, r["kpi"]): (r["severity"], r["alert_message"])
           for r in al.evaluate_sla(df, al.thresholds_table(spark)).collect()}
    assert got == {
        (1, "throughput_dl_mbps"): ("Low", "eMBB throughput_dl_mbps 99.0 below SLA 100.0"),
        (1, "one_way_latency_ms"): ("Critical", "eMBB one_way_latency_ms 30.0 above SLA 20.0"),
        (4, "handover_success_rate_percent"):
            ("Critical", "eMBB handover_success_rate_percent 2.2 below SLA 95.0")}


def test_one_decimal_rounds_like_the_binary_value(spark):
    values = [2.25, 0.15, 2.35, 1234.56, -0.04, 0.05, 99.95]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r[0] for r in df.select(one_decimal(F.col("v"))).collect()]
    assert got == [f"{v:.1f}" for v in values]


def test_zero_threshold_gives_low_severity(spark):
    limits = al.thresholds_table(spark, {"eMBB": {"bler_percent": 0.0}})
    rows = al.evaluate_sla(records(spark, [{"bler_percent": 3.0}]), limits).collect()
    assert [r["severity"] for r in rows] == ["Low"]


def test_status_without_values_or_thresholds_is_unknown(spark):
    df = records(spark, [{"bler_percent": None}, {"slice_type": "new", "bler_percent": 1.0}])
    status = mo.sla_status(df, al.thresholds_table(spark)).where("kpi = 'bler_percent'")
    assert {(r["slice_type"], r["value"], r["meets_sla"]) for r in status.collect()} == {
        ("eMBB", None, None), ("new", 1.0, None)}
    assert {r["score"] for r in mo.compliance(status).collect()} == {0.0}


def test_dominant_type_tie_takes_the_first_type(spark):
    df = records(spark, [{"ml_prediction": 1, "ml_anomaly_type": t} for t in ("b", "a", "b", "a")]
                 + [{"cell_id": "c2"}])
    assert [tuple(r) for r in mo.dominant_type(df).collect()] == [("c1", "a", 2)]
    ranking = {r["cell_id"]: r for r in mo.severity_ranking(df).collect()}
    assert ranking["c2"]["dominant_anomaly_type"] is None
    assert ranking["c1"]["severity"] == "Critical"
    head = mo.anomaly_head(df).first()
    assert (head["dominant_anomaly_type"], head["affected_cells"]) == ("a", 2)


def test_head_of_an_empty_scope(spark):
    head = mo.anomaly_head(records(spark, []).where("false")).first()
    assert tuple(head) == (0, 0, None, 0, 0, 0.0)


def test_paging_limits(spark):
    df = records(spark, [{} for _ in range(5)])
    with pytest.raises(ValueError):
        mo.predictions(df, limit=50_001)
    shallow = [r["id"] for r in mo.predictions(df, limit=2, offset=1).collect()]
    deep = [r["id"] for r in mo.predictions(df, limit=2, offset=1).collect()]
    assert shallow == deep == [3, 2]


def test_health_window_uses_ingestion_time(spark):
    df = records(spark, [{"ingested_at": T0 - timedelta(hours=30)}, {"ue_id": None}, {}])
    row = mo.health_totals(df, T0 + timedelta(minutes=10)).first()
    assert (row["total_cells"], row["active_ues"], row["total_records"]) == (1, 1, 1)


def test_one_point_forecast_is_flat(spark):
    df = records(spark, [{"bler_percent": 7.0}])
    values = {r["value"] for r in fc.forecast_linear(df, ["bler_percent"]).collect()}
    assert values == {7.0}


def test_forecast_without_rows_is_unknown(spark):
    df = records(spark, [{"bler_percent": 7.0}])
    got = {r["kpi"]: (r["sla_status"], r["predicted_value"]) for r in fc.forecast_status(
        df, ["bler_percent", "one_way_latency_ms"], al.thresholds_table(spark)).collect()}
    assert got == {"bler_percent": ("breach_predicted", 7.0), "one_way_latency_ms": ("unknown", None)}


def test_forecast_threshold_order(spark):
    df = records(spark, [{"bler_percent": 7.0, "slice_type": "URLLC"}])
    limits = al.thresholds_table(spark)

    def threshold(**options):
        return fc.forecast_status(df, ["bler_percent"], limits, **options).first()["threshold"]
    assert threshold(slice_type="URLLC") == 10.0
    assert threshold(by=["cell_id"]) == 10.0
    assert threshold() == 0.1


def test_date_parts_of_bad_texts(spark):
    texts = ["2024-02-03 04:05:06", "nonsense", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    parts = safe_date_parts(F.col("t"))
    got = [tuple(r) for r in df.select(*[parts[p] for p in schema.DATE_PARTS]).collect()]
    assert got == [(2024, 2, 3, 4, 5, 6), (2026, 1, 1, 0, 0, 0), (0,) * 6, (0,) * 6]


def test_codes_of_labels(spark):
    df = spark.createDataFrame([("URLLC",), ("eMBB",), ("mMTC",), ("x",), (None,)], "s string")
    code = encode(F.col("s"), schema.SLICES)
    assert [r[0] for r in df.select(code).collect()] == [0, 1, 2, 0, 0]
    back = decode(F.lit(9), schema.SLICES, "none")
    assert df.select(back).first()[0] == "none"


def test_tails_at_known_points(spark):
    df = spark.createDataFrame([(3.841459, 1), (5.991465, 2), (7.814728, 3), (26.296228, 16)],
                               "x double, k int")
    for r in df.select(chi2_tail(F.col("x"), F.col("k")).alias("p")).collect():
        assert r["p"] == pytest.approx(0.05, abs=1e-6)
    two = spark.createDataFrame([(1.959964,)], "z double")
    assert two.select(normal_two_sided(F.col("z"))).first()[0] == pytest.approx(0.05, abs=1e-6)


def test_rank_tests_by_hand(spark):
    rows = [(0, "a", 1.0), (0, "a", 2.0), (0, "b", 2.0), (1, "b", 3.0), (1, "c", 2.0), (1, "c", 9.0)]
    df = spark.createDataFrame(rows, "anomaly int, kind string, x double")
    u = st.mann_whitney(df, ["x"]).first()
    zeros, ones = [r[2] for r in rows if r[0] == 0], [r[2] for r in rows if r[0] == 1]
    want = sum((a > b) + 0.5 * (a == b) for a in zeros for b in ones)
    assert u["u_statistic"] == want
    spread = math.sqrt(9 / 12 * (7 - (27 - 3) / 30))
    z = (9 - want - 4.5 - 0.5) / spread
    assert u["p_value"] == pytest.approx(math.erfc(z / math.sqrt(2)))
    h = st.kruskal(df, ["x"], "kind").first()
    ranks = {"a": 1 + 3, "b": 3 + 5, "c": 3 + 6}
    plain = 12 / 42 * sum(v * v / 2 for v in ranks.values()) - 21
    assert h["h_statistic"] == pytest.approx(plain / (1 - 24 / 210)) and h["dof"] == 2


def test_constant_column_has_no_correlation(spark):
    df = spark.createDataFrame([(1.0, 5.0, 2.0), (2.0, 5.0, 4.0), (4.0, 5.0, None)],
                               "x double, c double, y double")
    got = {(r["kpi_x"], r["kpi_y"]): r["r"] for r in st.correlation(df, ["x", "c", "y"]).collect()}
    assert got[("x", "c")] is None and got[("c", "y")] is None
    assert got[("x", "y")] == pytest.approx(1.0)
    assert st.correlation(df.drop("y"), ["x", "c"]).first()["r"] is None


def test_histogram_of_a_constant_and_closed_last_bin(spark):
    df = spark.createDataFrame([(float(v),) for v in range(11)], "x double")
    counts = [r["count"] for r in st.histogram(df, "x", 5).orderBy("bin").collect()]
    assert counts == [2, 2, 2, 2, 3]
    flat = spark.createDataFrame([(3.0,), (3.0,)], "x double")
    assert sum(r["count"] for r in st.histogram(flat, "x", 4).collect()) == 2


def test_report_counts_classes_missing_on_one_side(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "z"), ("b", "a")], "y string, p string")
    got = {r["class"]: r for r in ev.report(df, "y", "p").collect()}
    assert (got["z"]["support"], got["z"]["precision"], got["b"]["recall"]) == (0, 0.0, 0.0)
    assert got["accuracy"]["f1"] == pytest.approx(1 / 3)
    assert got["macro avg"]["recall"] == pytest.approx(0.5 / 3)


def test_metrics_are_zero_when_undefined(spark):
    df = spark.createDataFrame([(0, 0), (0, 0)], "y int, p int")
    row = ev.binary_metrics(df, "y", "p").first()
    assert (row["accuracy"], row["precision"], row["recall"], row["f1"]) == (1.0, 0.0, 0.0, 0.0)


def test_best_assignment_is_optimal():
    rng = random.Random(5)
    for rows, cols in [(3, 3), (4, 6), (6, 4), (1, 5)]:
        gain = [[rng.randrange(50) for _ in range(cols)] for _ in range(rows)]
        got = cl.best_assignment(gain)
        k = min(rows, cols)
        assert len(got) == k and len(set(got.values())) == k
        best = max(sum(gain[r][c] for r, c in zip(rs, cs))
                   for rs in itertools.combinations(range(rows), k)
                   for cs in itertools.permutations(range(cols), k))
        assert sum(gain[r][c] for r, c in got.items()) == best


def test_unmatched_clusters_and_noise_map_to_minus_one(spark):
    df = spark.createDataFrame([(0, 1), (0, 1), (1, 1), (-1, 1)], "cluster int, truth int")
    got = {r["cluster"]: r["mapped"] for r in cl.map_clusters(df, "cluster", "truth").collect()}
    assert got == {0: 1, 1: -1, -1: -1}


def test_constant_feature_scales_to_zero(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 4.0)], "c double, x double")
    rows = fe.standard_scaler(df, ["c", "x"])(df).orderBy("x").collect()
    assert rows == [Row(c=0.0, x=-1.0), Row(c=0.0, x=1.0)]


def test_missing_fact_files_are_skipped(spark, tmp_path):
    assert files.union_facts(spark, [str(tmp_path / "none")]).count() == 0


def test_conform_pads_and_orders(spark):
    got = tables.conform(spark.createDataFrame([("c", 1)], "cell_id string, extra int"), schema.ALERTS)
    assert got.columns == schema.ALERTS.names and got.first()["cell_id"] == "c"


def test_pages_take_null_keys(spark):
    df = records(spark, [{}, {"timestamp": None}, {}, {"timestamp": None}])
    pages = [[r["id"] for r in mo.predictions(df, limit=2, offset=o).collect()] for o in (0, 2)]
    assert pages == [[2, 0], [3, 1]]
    batch = files.row_batch(df, 1, 3, ["timestamp", "id"])
    assert sorted(r["id"] for r in batch.collect()) == [0, 1, 3]


def test_older_than_a_year_still_counts(spark):
    df = records(spark, [{"ingested_at": T0 - timedelta(days=900), "ml_prediction": 1,
                          "ml_anomaly_type": "overload"}, {}])
    assert [r["count"] for r in mo.type_distribution(df).collect()] == [1]
    head = mo.anomaly_head(df).first()
    assert (head["total"], head["active_anomalies"], head["dominant_anomaly_type"]) == (
        2, 1, "overload")


def test_summaries_of_nothing(spark):
    df = records(spark, [{}]).limit(0)
    head = mo.anomaly_head(df).first()
    assert (head["total"], head["active_anomalies"], head["affected_cells"]) == (0, 0, 0)
    assert mo.health_totals(df, T0).first()["total_cells"] == 0
    assert mo.value_counts(df, "cell_id").count() == 0


def test_configured_slice_without_the_kpi_is_unknown(spark):
    limits = al.thresholds_table(spark, {"eMBB": {"bler_percent": 5.0},
                                         "URLLC": {"one_way_latency_ms": 10.0}})
    df = records(spark, [{"one_way_latency_ms": 99.0 + i, "bler_percent": 1.0} for i in range(3)])

    def status(**options):
        rows = fc.forecast_status(df, ["one_way_latency_ms", "bler_percent"], limits, **options)
        return {r["kpi"]: r["sla_status"] for r in rows.collect()}
    assert status(slice_type="eMBB") == {"one_way_latency_ms": "unknown",
                                         "bler_percent": "within_threshold"}
    assert status() == {"one_way_latency_ms": "breach_predicted",
                        "bler_percent": "within_threshold"}


def test_normal_quantile_and_far_powers(spark):
    from statistics import NormalDist

    from cellpulse.functions.tails import normal_quantile
    shares = [1e-7, 1e-4, 0.01, 0.0749, 0.0751, 0.3, 0.5, 0.92, 0.9251, 1 - 1e-7]
    for share, got in zip(shares, normal_quantile(shares)):
        assert got == pytest.approx(NormalDist().inv_cdf(share), rel=1e-9, abs=1e-14)
    x = [(float((i / 400) ** (1 / 7)),) for i in range(1, 400)]
    _, powers = fe.yeo_johnson_scaler(spark.createDataFrame(x, "x double"), ["x"])
    assert powers["x"] > 2.2
