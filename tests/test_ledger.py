"""Reports and manifests outlive Spark's memory of a query and late repeats of a batch."""

import json

from pyspark.sql import functions as F

from cellpulse import schema
from cellpulse.plans import alerts as al
from cellpulse.sources import tables
from cellpulse.sources.kpi_view import kpi_view
from cellpulse.streaming import jobs, ledger
from cellpulse.streaming.messages import message, open_messages

NOW = {"availableNow": True}


def test_records_replace_themselves(spark, tmp_path):
    path = ledger.record_path(str(tmp_path / "log"), 123456)
    assert path.endswith("/12/123456.json") and ledger.get(spark, path) is None
    ledger.put(spark, path, {"batch": 1, "text": "é"})
    ledger.put(spark, path, {"batch": 2, "text": "é"})
    assert ledger.get(spark, path) == {"batch": 2, "text": "é"}
    assert ledger.once(spark, path, {"batch": 3}) == {"batch": 2, "text": "é"}


def test_progress_counts_more_batches_than_spark_remembers(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    for i in range(150):
        (source / f"{i:03}.txt").write_text("\n".join(str(k) for k in range(i % 7 + 1)))
    log = ledger.ProgressLog(spark, str(tmp_path / "progress"))
    assert ledger.totals(spark, log.root).first().asDict() == dict(batches=0, rows=0, anomalies=0)
    spark.streams.addListener(log)

    def run(checkpoint):
        seen = open_messages(spark, str(source), files_per_trigger=1).observe(
            "scored", F.count(F.lit(1)).alias("rows"),
            F.sum(F.col("value").cast("int")).alias("anomalies"))
        query = (seen.writeStream.format("noop").trigger(**NOW)
                 .option("checkpointLocation", str(tmp_path / checkpoint)).start())
        query.awaitTermination()
        assert log.wait(query)
        return query
    query = run("log")
    assert len(query.recentProgress) <= 100
    rows = sum(i % 7 + 1 for i in range(150))
    ones = sum((i % 7 + 1) * (i % 7) // 2 for i in range(150))
    got = ledger.totals(spark, log.root).first().asDict()
    assert got == {"batches": 150, "rows": rows, "anomalies": ones}
    # A restart goes on where the checkpoint ends.
    (source / "zzz.txt").write_text("5")
    run("log")
    got = ledger.totals(spark, log.root).first().asDict()
    assert got == {"batches": 151, "rows": rows + 1, "anomalies": ones + 5}
    spark.streams.removeListener(log)


def test_a_batch_repeated_after_a_month_replaces_itself(spark, sf, tmp_path):
    source = str(tmp_path / "messages")
    message(kpi_view(spark, sf).select(schema.SCORED_RECORD.names).limit(40)).write.text(source)
    paths = tables.init_tables(spark, str(tmp_path / "tables"))
    limits = al.thresholds_table(spark)
    # The manifest of a first attempt thirty days ago, which wrote some rows.
    day = str(spark.sql("SELECT current_date() - 30 AS d").first()["d"])
    places = {n: tables.batch_path(paths[n], day, 1) for n in ("predictions", "alerts")}
    record = ledger.record_path(f"{paths['predictions']}/{jobs.MANIFEST}", 1)
    ledger.put(spark, record, {"batch": 1, "day": day, **places})
    tables.conform(spark.range(7), schema.PREDICTIONS).write.parquet(places["predictions"])
    jobs.start_ingest(open_messages(spark, source), paths, limits, str(tmp_path / "log"),
                      NOW).awaitTermination()
    stored = tables.read_table(spark, paths["predictions"], schema.PREDICTIONS, partitions=True)
    assert stored.count() == 40
    assert {str(r["ingest_date"]) for r in stored.collect()} == {day}
    breaches = tables.read_table(spark, paths["alerts"], schema.ALERTS, partitions=True)
    assert {str(r["ingest_date"]) for r in breaches.collect()} <= {day}
    assert json.loads(json.dumps(ledger.get(spark, record)))["day"] == day
