"""Registered streaming queries: each writes the table as messages, runs its job, reads the sink."""

from pyspark.sql import functions as F

from cellpulse import schema
from cellpulse.plans import alerts as al, features as fe, models as md
from cellpulse.session import new_path, rounded
from cellpulse.sources import tables
from cellpulse.sources.kpi_view import kpi_view, raw_records
from cellpulse.streaming import jobs, ledger
from cellpulse.streaming.messages import message, open_messages

NOW = {"availableNow": True}


def _week():
    return F.date_trunc("week", F.col("timestamp"))


def _raw_messages(spark, sf):
    path = new_path(spark, "raw-messages")
    message(raw_records(spark, sf)).write.text(path)
    return path


def _scored_messages(spark, sf):
    path = new_path(spark, "scored-messages")
    message(kpi_view(spark, sf).select(schema.SCORED_RECORD.names)).write.text(path)
    return path


def _finish(*queries):
    for query in queries:
        query.awaitTermination()


def _read(spark, path, record):
    rows = jobs.good(jobs.parse(spark.read.text(path), record)).drop("value")
    return rows.withColumn("timestamp", F.col("timestamp").try_cast("timestamp_ntz"))


def stream_replay(spark, sf):
    rows = _read(spark, _raw_messages(spark, sf), schema.RAW_RECORD)
    return rows.groupBy(_week().cast("timestamp_ntz").alias("week")).agg(
        F.count(F.lit(1)).alias("n"), F.min("timestamp").alias("first"),
        F.max("timestamp").alias("last"))


def stream_json_source(spark, sf):
    """Messages read one file per trigger, parsed, and stored as a table."""
    source = open_messages(spark, _raw_messages(spark, sf), files_per_trigger=2)
    out = new_path(spark, "parsed")
    parsed = jobs.good(jobs.parse(source, schema.RAW_RECORD)).drop("value")
    _finish(parsed.writeStream.format("parquet").option("checkpointLocation", out + "-log")
            .trigger(**NOW).start(out))
    rows = spark.read.parquet(out)
    return rounded(rows.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz")))


def stream_json_sink(spark, sf):
    source = open_messages(spark, _scored_messages(spark, sf))
    parsed = jobs.good(jobs.parse(source, schema.SCORED_RECORD)).drop("value")
    out = new_path(spark, "sink")
    _finish(jobs.write_messages(parsed, out, out + "-log", trigger=NOW))
    return rounded(_read(spark, out, schema.SCORED_RECORD))


def _models(spark, sf):
    train = fe.labelled(kpi_view(spark, sf)).select("y", "y_type", *fe.SERVING_INPUTS)
    return (md.fit(md.random_forest(numTrees=10, maxDepth=5), train, fe.SERVING_INPUTS),
            md.fit(md.random_forest("y_type", numTrees=10, maxDepth=5), train, fe.SERVING_INPUTS))


def stream_score(spark, sf):
    """Stored models applied to the stream, against the same models applied to the table."""
    fitted = []
    for model in _models(spark, sf):
        path = new_path(spark, "model")
        md.save(model, path)
        fitted.append(md.load(path))
    out = new_path(spark, "scored")
    _finish(*jobs.start_scoring(open_messages(spark, _raw_messages(spark, sf)), *fitted,
                                out, out + "-log", trigger=NOW))
    names = ["timestamp", "cell_id", "ue_id", "slice_type", "actual_anomaly",
             "actual_anomaly_type"]
    made = ["ml_prediction", "ml_confidence", "ml_anomaly_label", "ml_anomaly_type",
            "ml_anomaly_type_confidence"]
    streamed = _read(spark, out, schema.SCORED_RECORD).select(*names, F.struct(*made).alias("s"))
    batch = raw_records(spark, sf).withColumn("value", F.lit('{"slice_type": 0}'))
    batch = jobs.score(batch, *fitted).select(*names[:3], F.struct(*made).alias("b"))
    gap = F.greatest(F.abs(F.col("s.ml_confidence") - F.col("b.ml_confidence")), F.abs(
        F.col("s.ml_anomaly_type_confidence") - F.col("b.ml_anomaly_type_confidence")))
    return streamed.join(batch, names[:3]).select(
        *names, *[(F.col(f"s.{m}") == F.col(f"b.{m}")).alias(f"{m}_equal") for m in
                  ("ml_prediction", "ml_anomaly_label", "ml_anomaly_type")],
        F.round(gap, 6).alias("confidence_gap"))


def _ingested(spark, sf):
    paths = tables.init_tables(spark, new_path(spark, "tables"))
    query = jobs.start_ingest(open_messages(spark, _scored_messages(spark, sf)), paths,
                              al.thresholds_table(spark), new_path(spark, "log"), NOW)
    _finish(query)
    return paths


def stream_predictions_sink(spark, sf):
    rows = tables.read_table(spark, _ingested(spark, sf)["predictions"], schema.PREDICTIONS)
    return rounded(rows.select(schema.SCORED_RECORD.names))


def stream_alerts(spark, sf):
    rows = tables.read_table(spark, _ingested(spark, sf)["alerts"], schema.ALERTS)
    return rounded(rows.drop("id", "created_at"))


def stream_hourly(spark, sf):
    """Counts of all hours, open ones included, after the last batch."""
    source = open_messages(spark, _scored_messages(spark, sf))
    records = jobs.good(jobs.parse(source, schema.SCORED_RECORD))
    out = new_path(spark, "hourly")
    _finish(jobs.start_hourly(records, out, out + "-log", trigger=NOW, complete=True))
    return jobs.read_hourly(spark, out).withColumn("hour", F.col("hour").cast("timestamp_ntz"))


def stream_progress(spark, sf):
    """Rows counted by the kept reports of all batches of the scoring job."""
    out = new_path(spark, "scored")
    log = ledger.ProgressLog(spark, new_path(spark, "progress"))
    source = open_messages(spark, _raw_messages(spark, sf), files_per_trigger=2)
    queries = jobs.start_scoring(source, *_models(spark, sf), out, out + "-log", log=log,
                                 trigger=NOW)
    _finish(*queries)
    log.wait(queries[0])
    spark.streams.removeListener(log)
    return ledger.totals(spark, log.root).select("rows")


def stream_bad_records(spark, sf):
    """Every fiftieth message is cut short; it goes aside and the others are scored."""
    path = new_path(spark, "mixed")
    texts = kpi_view(spark, sf).select("id", *schema.RAW_RECORD.names)
    cut = F.when(F.get_json_object("value", "$.id").cast("long") % 50 == 0,
                 F.substring("value", 1, 40)).otherwise(F.col("value"))
    message(texts).select(cut.alias("value")).write.text(path)
    out = new_path(spark, "kept")
    parsed = jobs.parse(open_messages(spark, path), schema.RAW_RECORD)
    kept = jobs.good(parsed).drop("value").writeStream.format("parquet").option(
        "checkpointLocation", out + "-log").trigger(**NOW).start(out)
    aside = jobs.bad(parsed).writeStream.format("text").option(
        "checkpointLocation", out + "-bad-log").trigger(**NOW).start(out + "-bad")
    _finish(kept, aside)
    good = spark.read.parquet(out).select(F.lit("kept").alias("kind"))
    bad = spark.read.text(out + "-bad").select(F.lit("aside").alias("kind"))
    return good.unionByName(bad).groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


STREAMING = {f.__name__: f for f in [
    stream_replay, stream_json_source, stream_json_sink, stream_score, stream_predictions_sink,
    stream_alerts, stream_hourly, stream_progress, stream_bad_records]}
