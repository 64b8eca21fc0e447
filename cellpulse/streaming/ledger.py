"""Small durable records of streaming jobs: one file per batch, written in one step.

A record replaces the one of the same name, so a repeated batch leaves a single one.
"""

import json
import threading
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQueryListener
from pyspark.sql.types import StructType

from cellpulse.session import small_table

PER_FOLDER = 10_000  # records under one folder


def record_path(root: str, number: int) -> str:
    return f"{root}/{number // PER_FOLDER}/{number}.json"


def _place(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def get(spark: SparkSession, path: str):
    """The record of that name, or None."""
    place, fs = _place(spark, path)
    if not fs.exists(place):
        return None
    stream = fs.open(place)
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return json.loads(text)


def put(spark: SparkSession, path: str, record: dict):
    """Write the record beside its place and rename it, so it is there whole or not at all."""
    place, fs = _place(spark, path)
    draft, _ = _place(spark, f"{path.rsplit('/', 1)[0]}/.{uuid.uuid4().hex}")
    stream = fs.create(draft, True)
    try:
        stream.write(bytearray(json.dumps(record).encode()))
    finally:
        stream.close()
    if not fs.rename(draft, place):
        fs.delete(place, False)
        if not fs.rename(draft, place):
            raise OSError(f"cannot write {path}")


def once(spark: SparkSession, path: str, record: dict) -> dict:
    """The record of that name; this one is written if there is none."""
    found = get(spark, path)
    if found is None:
        put(spark, path, record)
        found = record
    return found


def read(spark: SparkSession, root: str, record: StructType) -> DataFrame:
    """All records under a folder."""
    place, fs = _place(spark, root)
    if not fs.exists(place):
        return spark.createDataFrame([], record)
    return (spark.read.schema(record).option("recursiveFileLookup", True)
            .option("pathGlobFilter", "*.json").json(root))


class ProgressLog(StreamingQueryListener):
    """Keeps the report of every batch of a scoring query under ``root``.

    Spark itself forgets all but the last hundred. The query's id stays with its checkpoint, so a
    restarted query goes on in the same folder and a repeated batch replaces its report.
    """

    def __init__(self, spark: SparkSession, root: str, metric: str = "scored"):
        self.spark, self.root, self.metric = spark, root, metric
        self.over = {}

    def onQueryStarted(self, event):
        self.over.setdefault(str(event.runId), threading.Event())

    def onQueryProgress(self, event):
        report = event.progress
        seen = report.observedMetrics.get(self.metric)
        if seen is None or report.numInputRows == 0:
            return
        put(self.spark, record_path(f"{self.root}/query={report.id}", report.batchId),
            {"batch": report.batchId, "rows": seen["rows"], "anomalies": seen["anomalies"] or 0})

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        self.over.setdefault(str(event.runId), threading.Event()).set()

    def wait(self, query, seconds: float = 60.0) -> bool:
        """Whether all reports of an ended query are written; listeners run behind it."""
        return self.over.setdefault(str(query.runId), threading.Event()).wait(seconds)


PROGRESS = "batch bigint, rows bigint, anomalies bigint"


def progress(spark: SparkSession, root: str) -> DataFrame:
    """Rows and anomalies of every batch of all queries that report under ``root``."""
    return read(spark, root, small_table(spark, PROGRESS, []).schema).select(
        "batch", "rows", "anomalies")


def totals(spark: SparkSession, root: str) -> DataFrame:
    """Batches, rows and anomalies scored so far, in one row."""
    return progress(spark, root).agg(
        F.count(F.lit(1)).alias("batches"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum("anomalies"), F.lit(0)).alias("anomalies"))
