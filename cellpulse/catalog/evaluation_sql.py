"""SQL for the feature, sampling and evaluation queries."""

from cellpulse import schema
from cellpulse.catalog.kpi_sql import r, with_kpi

_TYPES = sorted(schema.ANOMALY_TYPES + [schema.NORMAL])
_TYPE_CODE = "CASE {c} " + " ".join(f"WHEN '{t}' THEN {i}" for i, t in enumerate(_TYPES)) + " END"
_SLICE_CODE = "CASE {c} " + " ".join(
    f"WHEN '{t}' THEN {i}" for i, t in enumerate(sorted(schema.SLICES))) + " ELSE 0 END"
_HASH = "md5(CAST(id AS VARCHAR)), id"


def _ranked(label: str) -> str:
    return (f"SELECT *, row_number() OVER (PARTITION BY {label} ORDER BY {_HASH}) AS rn, "
            f"count(*) OVER (PARTITION BY {label}) AS n_c, count(*) OVER () AS n_all FROM kpi")


_SPLIT = (f"split AS (SELECT *, CASE WHEN rn <= floor(n_c * 8 / 10.0) THEN 'train' ELSE 'test' END "
          f"AS part FROM ({_ranked('anomaly')}))")

_PARTS = [("year", 2026), ("month", 1), ("day", 1), ("hour", 0), ("minute", 0), ("second", 0)]


def _safe(name: str, fallback: int) -> str:
    return (f"CASE id % 5 WHEN 0 THEN {fallback} WHEN 1 THEN 0 WHEN 2 THEN 0 "
            f"ELSE CAST(date_part('{name}', \"timestamp\") AS INTEGER) END AS {name}")


def _metrics(label: str, pred: str, where: str = "") -> str:
    return ("SELECT tn, fp, fn, tp, (tp + tn) / (tn + fp + fn + tp)::DOUBLE AS accuracy, "
            "coalesce(tp / nullif(tp + fp, 0)::DOUBLE, 0) AS precision, "
            "coalesce(tp / nullif(tp + fn, 0)::DOUBLE, 0) AS recall, "
            "coalesce(2 * tp / nullif(2 * tp + fp + fn, 0)::DOUBLE, 0) AS f1 FROM (SELECT "
            f"count(*) FILTER ({label} = 0 AND ({pred}) = 0) AS tn, "
            f"count(*) FILTER ({label} = 0 AND ({pred}) = 1) AS fp, "
            f"count(*) FILTER ({label} = 1 AND ({pred}) = 0) AS fn, "
            f"count(*) FILTER ({label} = 1 AND ({pred}) = 1) AS tp FROM {where or 'kpi'})")


def _report(source: str, label: str, pred: str) -> str:
    return (
        f"src AS (SELECT CAST({label} AS VARCHAR) AS y, CAST({pred} AS VARCHAR) AS p FROM {source}), "
        "cls AS (SELECT y AS c FROM src UNION SELECT p FROM src), "
        "per AS (SELECT c, coalesce(tp / nullif(np, 0)::DOUBLE, 0) AS precision, "
        "coalesce(tp / nullif(support, 0)::DOUBLE, 0) AS recall, "
        "coalesce(2 * tp / nullif(np + support, 0)::DOUBLE, 0) AS f1, support FROM (SELECT c, "
        "(SELECT count(*) FROM src WHERE y = c) AS support, "
        "(SELECT count(*) FROM src WHERE p = c) AS np, "
        "(SELECT count(*) FROM src WHERE y = c AND p = c) AS tp FROM cls))")


_REPORT_OUT = (
    f"SELECT c AS class, {r('precision', 'recall', 'f1')}, support FROM per UNION ALL "
    "SELECT 'accuracy', a, a, a, n FROM (SELECT round(count(*) FILTER (y = p) / "
    "count(*)::DOUBLE, 6) AS a, count(*) AS n FROM src) UNION ALL "
    "SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6), "
    "CAST(sum(support) AS BIGINT) FROM per UNION ALL SELECT 'weighted avg', "
    + ", ".join(f"round(sum({m} * support) / sum(support), 6)" for m in
                ("precision", "recall", "f1"))
    + ", CAST(sum(support) AS BIGINT) FROM per")

_SCORED = """
scored AS (SELECT actual_anomaly AS y, CASE WHEN ml_prediction = 1 THEN ml_confidence
  ELSE 1 - ml_confidence END AS score FROM kpi),
curve AS (SELECT DISTINCT score AS threshold,
  count(*) FILTER (y = 0) OVER (ORDER BY score DESC RANGE UNBOUNDED PRECEDING)::DOUBLE
    / count(*) FILTER (y = 0) OVER () AS fpr,
  count(*) FILTER (y = 1) OVER (ORDER BY score DESC RANGE UNBOUNDED PRECEDING)::DOUBLE
    / count(*) FILTER (y = 1) OVER () AS tpr FROM scored)"""

_TASKS = [("latency", "baseline", "rtt_ms > 30"), ("latency", "tuned", "rtt_ms > 35"),
          ("latency", "robust", "one_way_latency_ms > 14"),
          ("handover", "baseline", "handover_success_rate_percent < 99"),
          ("handover", "tuned", "handover_success_rate_percent < 98"),
          ("handover", "robust", "handover_success_rate_percent < 97.5::DOUBLE")]
_TASK_SCORES = "tasks AS (" + " UNION ALL ".join(
    f"SELECT '{t}' AS task, '{m}' AS model, accuracy, precision, recall, f1 FROM "
    f"({_metrics('anomaly', f'CAST({rule} AS INTEGER)')})" for t, m, rule in _TASKS) + ")"

_RULE = "CAST(rtt_ms > 33 AS INTEGER)"


def _gap_side(part: str) -> str:
    return _metrics("anomaly", _RULE, f"(SELECT * FROM split WHERE part = '{part}')")


_GAP = ("sides AS (" + " UNION ALL ".join(
    f"SELECT '{m}' AS metric, a.{m} AS train, b.{m} AS test FROM ({_gap_side('train')}) a, "
    f"({_gap_side('test')}) b" for m in ("accuracy", "precision", "recall", "f1"))
    + "), gaps AS (SELECT *, train - test AS gap, (train - test) / train * 100 AS gap_pct, "
    "avg((train - test) / train * 100) OVER () AS mean_gap_pct FROM sides)")

_PAIRS = """
cells AS (SELECT actual_anomaly_type AS a, ml_anomaly_type AS b, count(*)::DOUBLE AS n FROM kpi
  GROUP BY 1, 2),
ra AS (SELECT a, sum(n) AS n FROM cells GROUP BY a),
rb AS (SELECT b, sum(n) AS n FROM cells GROUP BY b),
tot AS (SELECT sum(n) AS n FROM cells)"""


def _dbi(source: str) -> str:
    return (
        f"pts AS (SELECT ROW_NUMBER() OVER () AS i, c, x FROM ({source})), "
        "flat AS (SELECT i, c, unnest(x)::DOUBLE AS v, unnest(range(len(x))) AS d FROM pts), "
        "cen AS (SELECT c, d, avg(v) AS m FROM flat GROUP BY c, d), "
        "spread AS (SELECT c, avg(dist) AS s FROM (SELECT f.c, f.i, sqrt(sum((v - m) ** 2)) AS dist "
        "FROM flat f JOIN cen ON f.c = cen.c AND f.d = cen.d GROUP BY f.c, f.i) GROUP BY c), "
        "apart AS (SELECT p.c AS c1, q.c AS c2, sqrt(sum((p.m - q.m) ** 2)) AS dist FROM cen p "
        "JOIN cen q ON p.d = q.d AND p.c <> q.c GROUP BY 1, 2), "
        "dbi AS (SELECT avg(w) AS davies_bouldin FROM (SELECT c1, max((u.s + v.s) / dist) AS w "
        "FROM apart JOIN spread u ON u.c = c1 JOIN spread v ON v.c = c2 GROUP BY c1))")


_ARI = ("(s - sa * sb / (tn * (tn - 1) / 2)) / ((sa + sb) / 2 - sa * sb / (tn * (tn - 1) / 2))")

EVALUATION_SQL = {
    "feat_label_encode": with_kpi(
        "SELECT id, " + _SLICE_CODE.format(
            c="CASE WHEN id % 7 = 0 THEN 'unknown' WHEN id % 11 = 0 THEN NULL ELSE slice_type END")
        + " AS slice_code, " + _TYPE_CODE.format(c="anomaly_type")
        + " AS type_code, anomaly_type AS type_back FROM kpi"),
    "feat_date_parts": with_kpi(
        "SELECT id, " + ", ".join(
            f"CAST(date_part('{p}', \"timestamp\") AS INTEGER) AS {p}" for p, _ in _PARTS)
        + ", CAST(isodow(\"timestamp\") - 1 AS INTEGER) AS dayofweek, "
        'CAST("timestamp" AS DATE) AS date FROM kpi'),
    "feat_safe_timestamp": with_kpi(
        "SELECT id, " + ", ".join(_safe(p, f) for p, f in _PARTS) + " FROM kpi"),
    "feat_fill": with_kpi(
        "SELECT id, round(coalesce(a, (SELECT quantile_cont(a, 0.5) FROM holed)), 6) AS rtt_ms, "
        "round(coalesce(b, (SELECT quantile_cont(b, 0.5) FROM holed)), 6) AS bler_percent, "
        "round(jitter_ms, 6) AS jitter_ms, round(coalesce(a, 0), 6) AS rtt_zero FROM holed",
        "holed AS (SELECT id, jitter_ms, CASE WHEN id % 4 <> 0 THEN rtt_ms END AS a, "
        "CASE WHEN id % 9 <> 0 THEN bler_percent END AS b FROM kpi)"),
    "feat_stratified_split": with_kpi(
        "SELECT id, anomaly_type, CASE WHEN rn <= floor(n_c * 8 / 10.0) THEN 'train' ELSE 'test' "
        f"END AS part FROM ({_ranked('anomaly_type')})"),
    "feat_chrono_split": with_kpi(
        "SELECT id, CASE WHEN row_number() OVER (ORDER BY \"timestamp\", id) <= "
        "floor(count(*) OVER () * 8 / 10.0) THEN 'train' ELSE 'test' END AS part FROM kpi"),
    "feat_stratified_sample": with_kpi(
        f"SELECT id, anomaly_type FROM ({_ranked('anomaly_type')}) WHERE rn <= "
        "greatest(1, floor(least(1.0::DOUBLE, 600::DOUBLE / n_all) * n_c))"),
    "feat_uniform_sample": with_kpi(
        f"SELECT id, cell_id FROM kpi ORDER BY {_HASH} LIMIT 500"),
    "feat_folds": with_kpi(
        f"SELECT id, anomaly, CAST((rn - 1) % 5 AS INTEGER) AS fold FROM ({_ranked('anomaly')})"),
    "feat_standard_scale": with_kpi(
        "SELECT id, part, " + ", ".join(
            f"round(({c} - avg({c}) FILTER (part = 'train') OVER ()) / "
            f"stddev_pop({c}) FILTER (part = 'train') OVER (), 6) AS {c}"
            for c in schema.KPIS)
        + " FROM split", _SPLIT),
    "feat_class_weights": with_kpi(
        "SELECT anomaly_type, count(*) AS n_class, round(sum(count(*)) OVER () / "
        "(count(*) OVER () * count(*))::DOUBLE, 6) AS weight FROM kpi GROUP BY anomaly_type"),
    "eval_confusion": with_kpi(
        "SELECT label, prediction, n, round(n / sum(n) OVER (PARTITION BY label)::DOUBLE, 6) "
        "AS share FROM (SELECT actual_anomaly_type AS label, ml_anomaly_type AS prediction, "
        "count(*) AS n FROM kpi GROUP BY 1, 2)"),
    "eval_binary": with_kpi(
        f"SELECT tn, fp, fn, tp, {r('accuracy', 'precision', 'recall', 'f1')} FROM "
        f"({_metrics('actual_anomaly', 'ml_prediction')})"),
    "eval_report": with_kpi(_REPORT_OUT, _report("kpi", "actual_anomaly_type", "ml_anomaly_type")),
    "eval_label_agreement": "WITH " + _report("labels", "quality", "toxic") + " " + _REPORT_OUT,
    "eval_roc": with_kpi(f"SELECT {r('threshold', 'fpr', 'tpr')} FROM curve", _SCORED),
    "eval_best_threshold": with_kpi(
        "SELECT round(threshold, 6) AS threshold, round(tpr - fpr, 6) AS youden_j FROM curve "
        "ORDER BY tpr - fpr DESC, curve.threshold DESC LIMIT 1", _SCORED),
    "eval_auc": with_kpi(
        "SELECT round((sum(mid) FILTER (y = 1) - p * (p + 1) / 2.0::DOUBLE) / (p * (n - p))"
        "::DOUBLE, 6) AS auc FROM (SELECT actual_anomaly AS y, rank() OVER (ORDER BY rtt_ms) + "
        "(count(*) OVER (PARTITION BY rtt_ms) - 1) / 2.0::DOUBLE AS mid, "
        "sum(actual_anomaly) OVER () AS p, count(*) OVER () AS n FROM kpi) GROUP BY p, n"),
    "eval_average_precision": with_kpi(
        "SELECT round(sum(g * cp / ca::DOUBLE) / max(cp), 6) AS average_precision FROM (SELECT g, "
        "sum(g) OVER (ORDER BY s DESC) AS cp, sum(c) OVER (ORDER BY s DESC) AS ca FROM "
        "(SELECT rtt_ms AS s, sum(actual_anomaly) AS g, count(*) AS c FROM kpi GROUP BY 1))"),
    "eval_gap": with_kpi(
        f"SELECT metric, {r('train', 'test', 'gap', 'gap_pct', 'mean_gap_pct', digits=5)}, "
        "CASE WHEN mean_gap_pct < 2 THEN 'none' WHEN mean_gap_pct < 5 THEN 'light' "
        "WHEN mean_gap_pct < 10 THEN 'moderate' ELSE 'significant' END AS overfitting FROM gaps",
        _SPLIT, _GAP),
    "eval_model_table": with_kpi(
        f"SELECT task, model, {r('accuracy', 'precision', 'recall', 'f1')}, "
        "round(f1 - max(CASE WHEN model = 'baseline' THEN f1 END) OVER (PARTITION BY task), 6) "
        "AS f1_gain, dense_rank() OVER (PARTITION BY task ORDER BY tasks.f1 DESC) AS rank, "
        "row_number() OVER (PARTITION BY task ORDER BY tasks.f1 DESC, model) = 1 AS winner "
        "FROM tasks", _TASK_SCORES),
    "eval_model_melt": with_kpi(" UNION ALL ".join(
        f"SELECT task, model, '{m}' AS metric, round({m}, 6) AS value FROM tasks"
        for m in ("accuracy", "precision", "recall", "f1")), _TASK_SCORES),
    "eval_ari": with_kpi(
        f"SELECT round({_ARI}, 6) AS ari FROM (SELECT "
        "(SELECT sum(n * (n - 1) / 2) FROM cells) AS s, (SELECT sum(n * (n - 1) / 2) FROM ra) AS sa, "
        "(SELECT sum(n * (n - 1) / 2) FROM rb) AS sb, (SELECT n FROM tot) AS tn)", _PAIRS),
    "eval_nmi": with_kpi(
        "SELECT round((SELECT sum(c.n / tot.n * ln(c.n * tot.n / (ra.n * rb.n))) FROM cells c "
        "JOIN ra ON c.a = ra.a JOIN rb ON c.b = rb.b, tot) / (((SELECT -sum(ra.n / tot.n * "
        "ln(ra.n / tot.n)) FROM ra, tot) + (SELECT -sum(rb.n / tot.n * ln(rb.n / tot.n)) "
        "FROM rb, tot)) / 2), 6) AS nmi", _PAIRS),
    "eval_dbi": "WITH " + _dbi("SELECT label AS c, embedding AS x FROM embeddings")
                + " SELECT round(davies_bouldin, 5) AS davies_bouldin FROM dbi",
    "eval_silhouette": "WITH p AS (SELECT vec_id AS i, label AS c, embedding::DOUBLE[] AS x "
                       "FROM embeddings), d AS (SELECT a.i, a.c, b.c AS o, "
                       "sum(list_distance(a.x, b.x) ** 2) AS s, count(*) AS n FROM p a, p b "
                       "GROUP BY 1, 2, 3), m AS (SELECT i, max(CASE WHEN c = o THEN "
                       "s / nullif(n - 1, 0) END) AS own, min(CASE WHEN c <> o THEN s / n END) "
                       "AS near FROM d GROUP BY i) SELECT round(avg((near - own) / "
                       "greatest(near, own)), 5) AS silhouette FROM m",
    "eval_cluster_summary": "WITH src AS (SELECT label AS a, CASE WHEN label >= 8 THEN -1 ELSE "
                            "label % 4 END AS b, embedding FROM embeddings), "
                            "cells AS (SELECT a, b, count(*)::DOUBLE AS n FROM src WHERE b <> -1 "
                            "GROUP BY 1, 2), ra AS (SELECT a, sum(n) AS n FROM cells GROUP BY a), "
                            "rb AS (SELECT b, sum(n) AS n FROM cells GROUP BY b), "
                            "tot AS (SELECT sum(n) AS n FROM cells), "
                            + _dbi("SELECT b AS c, embedding AS x FROM src WHERE b <> -1")
                            + " SELECT (SELECT count(*) FROM rb) AS clusters, "
                            "(SELECT round(avg(CAST(b = -1 AS INTEGER)) * 100, 5) FROM src) "
                            "AS noise_pct, round(" + _ARI + ", 5) AS ari, "
                            "round((SELECT sum(c.n / tot.n * ln(c.n * tot.n / (ra.n * rb.n))) FROM "
                            "cells c JOIN ra ON c.a = ra.a JOIN rb ON c.b = rb.b, tot) / "
                            "(((SELECT -sum(ra.n / tot.n * ln(ra.n / tot.n)) FROM ra, tot) + "
                            "(SELECT -sum(rb.n / tot.n * ln(rb.n / tot.n)) FROM rb, tot)) / 2), 5) "
                            "AS nmi, (SELECT round(davies_bouldin, 5) FROM dbi) AS davies_bouldin "
                            "FROM (SELECT (SELECT sum(n * (n - 1) / 2) FROM cells) AS s, "
                            "(SELECT sum(n * (n - 1) / 2) FROM ra) AS sa, "
                            "(SELECT sum(n * (n - 1) / 2) FROM rb) AS sb, "
                            "(SELECT n FROM tot) AS tn)",
}
