"""Scoring, ingest and counting jobs on message streams."""

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from cellpulse import schema
from cellpulse.functions.scalar import decode
from cellpulse.plans import rollup
from cellpulse.plans.alerts import evaluate_sla
from cellpulse.plans.features import serving_features
from cellpulse.sources.tables import RECORDS, batch_path, conform
from cellpulse.streaming import ledger
from cellpulse.streaming.messages import message

BAD = "_bad"
MANIFEST = "_batches"  # under the predictions table; readers skip names with an underscore


def _as_text(record: StructType) -> StructType:
    """The record with its timestamp as text, which may be anything on the wire."""
    return StructType([StructField(f.name, StringType() if f.name == "timestamp" else f.dataType)
                       for f in record.fields])


def parse(messages: DataFrame, record: StructType) -> DataFrame:
    """Fields of each message beside its text; ``_bad`` holds texts that are no such record."""
    wire = StructType(_as_text(record).fields + [StructField(BAD, StringType())])
    parsed = F.from_json("value", wire, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD})
    return messages.select("value", parsed.alias("r")).select("value", "r.*")


def good(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col(BAD).isNull()).drop(BAD)


def bad(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col(BAD).isNotNull()).select("value")


def score(records: DataFrame, binary, multiclass) -> DataFrame:
    """The 23 output fields of each raw record, with both model results.

    A missing slice key counts as eMBB for the models; a null or unknown slice as code 0.
    """
    named = F.array_contains(F.json_object_keys("value"), "slice_type")
    rows = serving_features(
        records.withColumn("_slice", F.when(named, F.col("slice_type")).otherwise("eMBB")), "_slice")
    taken = ["features", "raw", "scaled", "rawPrediction", "probability", "prediction"]

    def run(model, df, name):
        out = model.transform(df)
        sure = F.element_at(vector_to_array("probability"), F.col("prediction").cast("int") + 1)
        return (out.withColumn(f"_{name}", F.col("prediction").cast("int"))
                .withColumn(f"_{name}_sure", sure).drop(*taken))
    rows = run(multiclass, run(binary, rows, "binary"), "type")
    classes = schema.ANOMALY_TYPES + [schema.NORMAL]
    made = {
        "ml_prediction": F.col("_binary"), "ml_confidence": F.col("_binary_sure"),
        "ml_anomaly_label": F.when(F.col("_binary") == 1, "anomaly").otherwise(schema.NORMAL),
        "ml_anomaly_type": decode(F.col("_type"), classes, schema.NORMAL),
        "ml_anomaly_type_confidence": F.col("_type_sure"),
        "actual_anomaly": F.col("anomaly"), "actual_anomaly_type": F.col("anomaly_type")}
    return rows.select([made.get(n, F.col(n)).alias(n) for n in schema.SCORED_RECORD.names])


def write_messages(records: DataFrame, target: str, checkpoint: str, fmt: str = "text",
                   trigger: dict = None, options: dict = None) -> StreamingQuery:
    """Start writing records as JSON messages to a folder, or a topic with ``fmt="kafka"``."""
    writer = (message(records).writeStream.format(fmt).outputMode("append")
              .option("checkpointLocation", checkpoint).options(**(options or {}))
              .trigger(**(trigger or {"processingTime": "1 second"})))
    return writer.option("topic", target).start() if fmt == "kafka" else writer.start(target)


def start_scoring(messages: DataFrame, binary, multiclass, target: str, checkpoint: str,
                  bad_target: str = None, log: ledger.ProgressLog = None, **sink):
    """Score each raw message; unreadable ones go to ``bad_target`` and do not stop the job.

    ``bad_target`` is a folder, ``target`` with the ending ``-bad`` by default. ``log`` keeps the
    counts of every batch; ``ledger.progress`` reads them, also after a restart.
    """
    if log is not None:
        log.spark.streams.addListener(log)
    parsed = parse(messages, schema.RAW_RECORD)
    counted = score(good(parsed), binary, multiclass).observe(
        "scored", F.count(F.lit(1)).alias("rows"), F.sum("ml_prediction").alias("anomalies"))
    queries = [write_messages(counted, target, checkpoint, **sink)]
    queries.append(
        bad(parsed).writeStream.format("text").option("checkpointLocation", checkpoint + "-bad")
        .trigger(**(sink.get("trigger") or {"processingTime": "1 second"}))
        .start(bad_target or f"{target}-bad"))
    return queries


def _places(spark, paths: dict, batch: int) -> dict:
    """Day and folders of a batch as its manifest names them; the first attempt writes it."""
    day = str(spark.sql("SELECT current_date() AS d").first()["d"])
    held = [name for name in RECORDS if name in paths]
    found = ledger.once(
        spark, ledger.record_path(f"{paths['predictions']}/{MANIFEST}", batch),
        {"batch": batch, "day": day, **{name: batch_path(paths[name], day, batch) for name in held}})
    # A manifest written before a table existed names only its day.
    return {**{name: batch_path(paths[name], found["day"], batch) for name in held}, **found}


def start_ingest(messages: DataFrame, paths: dict, thresholds: DataFrame, checkpoint: str,
                 trigger: dict = None) -> StreamingQuery:
    """Append scored records to the predictions table and their breaches to the alerts table.

    Each micro-batch owns one folder per table, under the day of its first attempt. Its manifest
    names them before a row is written, so a batch that is run again, however late, replaces its
    rows and leaves no double ones. ``id`` is unique within a batch; ``batch_id`` and
    ``id`` name a record, whatever the number of batches and tasks. Unreadable messages are kept
    under ``paths["bad"]``. Alerts and hourly partials are read off the stored predictions.
    """
    records = parse(messages, schema.SCORED_RECORD)

    def store(batch: DataFrame, number: int):
        spark, name = batch.sparkSession, number + 1
        places = _places(spark, paths, name)
        place = places["predictions"]
        bad(batch).write.mode("overwrite").text(f"{paths['bad']}/batch_id={name}")
        rows = (conform(good(batch).drop("value"), schema.PREDICTIONS)
                .withColumn("timestamp", F.col("timestamp").try_cast("timestamp_ntz"))
                .withColumn("id", F.monotonically_increasing_id())
                .withColumn("ingested_at", F.localtimestamp()))
        rows.write.mode("overwrite").parquet(place)
        stored = spark.read.schema(schema.PREDICTIONS).parquet(place)
        evaluate_sla(stored, thresholds).write.mode("overwrite").parquet(places["alerts"])
        for name, part in rollup.build(stored)._asdict().items():
            if name in places:
                part.write.mode("overwrite").parquet(places[name])
    return (records.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "1 second"})).start())


def hourly_counts(records: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Anomalies and rows per hour and slice; state is dropped once the hour is ``delay`` past."""
    hour = F.window("timestamp", "1 hour")
    return (records.withColumn("timestamp", F.col("timestamp").cast("timestamp"))
            .withWatermark("timestamp", delay).groupBy(hour, "slice_type")
            .agg(F.sum("ml_prediction").alias("anomaly_count"), F.count(F.lit(1)).alias("total"))
            .select(F.col("window.start").alias("hour"), "slice_type", "anomaly_count", "total"))


def start_hourly(records: DataFrame, target: str, checkpoint: str, delay: str = "1 hour",
                 trigger: dict = None, complete: bool = False) -> StreamingQuery:
    """Write hourly counts to a folder.

    By default closed hours are appended, and records later than ``delay`` are left out. With
    ``complete``, every batch rewrites all hours, open ones and late records included; the state
    is one row per hour and slice.
    """
    started = {"processingTime": "1 second"} if trigger is None else trigger
    if not complete:
        return (hourly_counts(records, delay).writeStream.format("parquet").outputMode("append")
                .option("checkpointLocation", checkpoint).trigger(**started).start(target))

    def rewrite(counts: DataFrame, number: int):
        counts.write.mode("overwrite").parquet(f"{target}/batch_id={number}")
    return (hourly_counts(records, delay).writeStream.outputMode("complete")
            .foreachBatch(rewrite).option("checkpointLocation", checkpoint).trigger(**started)
            .start())


def read_hourly(spark, target: str) -> DataFrame:
    """Counts of the newest complete rewrite."""
    rows = spark.read.parquet(target)
    newest = rows.agg(F.max("batch_id")).first()[0]
    return rows.where(F.col("batch_id") == newest).drop("batch_id")
