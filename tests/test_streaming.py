"""Streams give what the batch gives, survive bad messages and repeat without doubles."""

import json

from pyspark.sql import functions as F

from cellpulse import schema
from cellpulse.plans import (
    alerts as al, features as fe, models as md, monitoring as mo, outliers as ou)
from cellpulse.sources import tables
from cellpulse.sources.kpi_view import kpi_view, raw_records
from cellpulse.streaming import jobs
from cellpulse.streaming.messages import message, open_messages

NOW = {"availableNow": True}


def test_messages_keep_nulls_and_every_row(spark, sf, tmp_path):
    rows = raw_records(spark, sf).where("cell_id = 'gNB-001'").withColumn(
        "jitter_ms", F.when(F.col("jitter_ms") > 1, F.col("jitter_ms")))
    seen = [json.loads(r["value"]) for r in message(rows).collect()]
    assert len(seen) == rows.count()
    assert any(r["jitter_ms"] is None for r in seen) and set(seen[0]) == set(schema.RAW_RECORD.names)


def test_scoring_rules_for_slices_and_bad_messages(spark, sf, tmp_path):
    train = fe.labelled(kpi_view(spark, sf)).select("y", "y_type", *fe.SERVING_INPUTS)
    binary, types = (md.fit(md.decision_tree(label, maxDepth=3), train, fe.SERVING_INPUTS)
                     for label in ("y", "y_type"))
    texts = ['{"slice_type": "mMTC", "timestamp": "2024-01-01 01:02:03", "one_way_latency_ms": 99.0}',
             '{"timestamp": "", "one_way_latency_ms": null}', '{"slice_type": null}', "{oops"]
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.txt").write_text("\n".join(texts))
    out, aside = str(tmp_path / "out"), str(tmp_path / "aside")
    for query in jobs.start_scoring(open_messages(spark, str(folder)), binary, types, out,
                                    str(tmp_path / "log"), aside, trigger=NOW):
        query.awaitTermination()
    got = [json.loads(r["value"]) for r in spark.read.text(out).collect()]
    assert len(got) == 3 and set(got[0]) == set(schema.SCORED_RECORD.names)
    slow = next(r for r in got if r["slice_type"] == "mMTC")
    assert (slow["ml_prediction"], slow["ml_anomaly_label"]) == (1, "anomaly")
    assert [r["value"] for r in spark.read.text(aside).collect()] == ["{oops"]


def test_missing_slice_key_counts_as_embb(spark):
    rows = spark.createDataFrame([('{"a": 1}',), ('{"slice_type": null}',)], "value string")
    parsed = jobs.good(jobs.parse(rows, schema.RAW_RECORD))
    named = F.array_contains(F.json_object_keys("value"), "slice_type")
    marked = parsed.withColumn("_s", F.when(named, F.col("slice_type")).otherwise("eMBB"))
    got = {r["value"]: r["f_slice_type"] for r in fe.serving_features(marked, "_s").collect()}
    assert got == {'{"a": 1}': 1.0, '{"slice_type": null}': 0.0}


def test_ingest_equals_batch_and_repeats_cleanly(spark, sf, tmp_path):
    source = str(tmp_path / "messages")
    scored = kpi_view(spark, sf).select(schema.SCORED_RECORD.names)
    message(scored.repartition(3)).write.text(source)
    paths = tables.init_tables(spark, str(tmp_path / "tables"))
    limits = al.thresholds_table(spark)
    for log in ("log1", "log2"):  # a lost checkpoint replays the same batches
        jobs.start_ingest(open_messages(spark, source), paths, limits, str(tmp_path / log),
                          NOW).awaitTermination()
    stored = tables.read_table(spark, paths["predictions"], schema.PREDICTIONS)
    keyed = tables.read_table(spark, paths["predictions"], schema.PREDICTIONS, partitions=True)
    assert stored.count() == scored.count() == keyed.select("batch_id", "id").distinct().count()
    assert stored.where("ingested_at IS NULL").count() == 0
    breaches = tables.read_table(spark, paths["alerts"], schema.ALERTS)
    keys = ["alert_time", "cell_id", "slice_type", "kpi", "kpi_value", "threshold",
            "alert_message", "alert_action", "severity"]
    batch = al.evaluate_sla(kpi_view(spark, sf), limits).select(keys)
    assert breaches.select(keys).exceptAll(batch).count() == 0
    assert batch.exceptAll(breaches.select(keys)).count() == 0
    keyed = tables.read_table(spark, paths["alerts"], schema.ALERTS, partitions=True)
    assert breaches.count() == keyed.select("batch_id", "id").distinct().count()


def test_bad_messages_and_counts_are_kept(spark, sf, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    good = [r["value"] for r in message(
        kpi_view(spark, sf).select(schema.SCORED_RECORD.names).limit(5)).collect()]
    (source / "a.txt").write_text("\n".join(good + ["{oops", "no json"]))
    paths = tables.init_tables(spark, str(tmp_path / "tables"))
    jobs.start_ingest(open_messages(spark, str(source)), paths, al.thresholds_table(spark),
                      str(tmp_path / "log"), NOW).awaitTermination()
    assert sorted(r["value"] for r in spark.read.text(paths["bad"]).collect()) == [
        "no json", "{oops"]
    stored = tables.read_table(spark, paths["predictions"], schema.PREDICTIONS, partitions=True)
    assert stored.count() == 5
    plan = mo.recent(stored, "2024-01-01 00:00:00")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(ingest_date" in plan
    day = stored.first()["ingest_date"]
    tables.compact(spark, paths["predictions"], schema.PREDICTIONS, day, str(tmp_path / "closed"))
    closed = tables.read_table(spark, str(tmp_path / "closed"), schema.PREDICTIONS, partitions=True)
    assert closed.exceptAll(stored).count() == 0 and closed.count() == 5


def test_ids_hold_for_late_batches_and_many_tasks(spark, sf, tmp_path):
    """Record and alert keys of one batch over 1,100 tasks, and of a batch of a high number."""
    limits = al.thresholds_table(spark)
    rows = (kpi_view(spark, sf).select(schema.SCORED_RECORD.names).repartition(1100)
            .withColumn("id", F.monotonically_increasing_id())
            .withColumn("ingested_at", F.localtimestamp()))
    alerts = al.evaluate_sla(rows, limits)
    assert alerts.count() == alerts.select("id").distinct().count()
    assert rows.agg(F.max("id")).first()[0] > 1000 << 33
    place = tables.batch_path("root", "2024-01-01", 1 << 20)
    assert place == "root/ingest_date=2024-01-01/batch_id=1048576"


def test_complete_hours_hold_late_records(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    records = [("2024-01-01 10:05:00", 1), ("2024-01-03 10:05:00", 0), ("2024-01-01 10:55:00", 1)]
    for i, (when, flag) in enumerate(records):
        (source / f"{i}.txt").write_text(json.dumps(
            {"timestamp": when, "slice_type": "eMBB", "ml_prediction": flag}))
    stream = jobs.good(jobs.parse(open_messages(spark, str(source), files_per_trigger=1),
                                  schema.SCORED_RECORD))
    out = str(tmp_path / "out")
    jobs.start_hourly(stream, out, str(tmp_path / "log"), trigger=NOW,
                      complete=True).awaitTermination()
    got = sorted((str(r["hour"]), r["anomaly_count"], r["total"])
                 for r in jobs.read_hourly(spark, out).collect())
    assert got == [("2024-01-01 10:00:00", 2, 2), ("2024-01-03 10:00:00", 0, 1)]


def test_every_row_may_enter_a_tree(spark):
    df = spark.range(60_000).select(F.col("id"), (F.col("id") % 97).cast("double").alias("x"))
    nodes = ou.fit_isolation_forest(df, ["x"], "id", trees=3, sample=30_000)
    assert {r["size"] for r in nodes if r["node"] == 0} == {30_000}
    few = ou.fit_isolation_forest(df.limit(50), ["x"], "id", trees=3, sample=64)
    assert {r["size"] for r in few if r["node"] == 0} == {50}


def test_isolation_forest_prefers_far_points(spark):
    rows = [(i, float(i % 10), float(i % 7)) for i in range(400)] + [(400, 500.0, -300.0)]
    df = spark.createDataFrame(rows, "id long, x double, y double")
    nodes = ou.fit_isolation_forest(df, ["x", "y"], "id", trees=30, sample=64)
    roots = [r for r in nodes if r["node"] == 0]
    assert len(roots) == 30 and {r["size"] for r in roots} == {64}
    scored = ou.score_isolation_forest(df, ["x", "y"], nodes)
    assert scored.orderBy(F.desc("score")).first()["id"] == 400
    assert scored.where("score <= 0 OR score >= 1").count() == 0


def test_importances_sum_to_one(spark, sf):
    train = fe.labelled(kpi_view(spark, sf))
    model = md.fit(md.decision_tree(), train, fe.SERVING_INPUTS)
    rows = md.importances(model, fe.SERVING_INPUTS).collect()
    assert len(rows) == 16 and abs(sum(r["importance"] for r in rows) - 1) < 1e-9
    assert [r["rank"] for r in rows] == list(range(1, 17))
