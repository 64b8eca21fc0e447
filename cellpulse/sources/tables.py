"""The predictions and alerts tables as parquet folders."""

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DateType, LongType, StructField, StructType

from cellpulse import schema
from cellpulse.sources.files import path_exists


def conform(df: DataFrame, target: StructType) -> DataFrame:
    """Select the target columns in order; absent ones become typed nulls."""
    have = set(df.columns)
    return df.select([
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in target.fields])


PARTITIONS = StructType([StructField("ingest_date", DateType()),
                         StructField("batch_id", LongType())])


def batch_path(root: str, day, batch: int) -> str:
    """Folder of one micro-batch; the day above it lets time filters skip folders."""
    return f"{root}/ingest_date={day}/batch_id={batch}"


RECORDS = {"predictions": schema.PREDICTIONS, "alerts": schema.ALERTS,
           "counts": schema.ROLLUP_COUNTS, "devices": schema.ROLLUP_DEVICES}


def init_tables(spark: SparkSession, root: str) -> dict:
    """Create the empty tables where missing; existing data stays. Returns their paths.

    ``counts`` and ``devices`` hold hourly partials of the predictions; ``bad`` is the folder for
    unreadable messages.
    """
    paths = {name: f"{root}/{name}" for name in RECORDS}
    for name, record in RECORDS.items():
        if not path_exists(spark, paths[name]):
            (spark.createDataFrame([], StructType(record.fields + PARTITIONS.fields))
             .write.mode("ignore").partitionBy(*PARTITIONS.names).parquet(paths[name]))
    return {**paths, "bad": f"{root}/bad"}


def read_table(spark: SparkSession, path: str, target: StructType,
               partitions: bool = False) -> DataFrame:
    """Read files of any age: the declared schema pads columns that older files lack.

    With ``partitions``, ``ingest_date`` and ``batch_id`` come too; the latter makes ids unique.
    """
    rows = spark.read.schema(StructType(target.fields + PARTITIONS.fields)).parquet(path)
    return rows.select(*target.names, *(PARTITIONS.names if partitions else []))


def read_rollup(spark: SparkSession, paths: dict) -> list:
    """The two frames of hourly partials, pruned to days by their folders."""
    return [read_table(spark, paths[name], RECORDS[name]) for name in ("counts", "devices")]


def compact(spark: SparkSession, path: str, target: StructType, day, to: str, files: int = 1):
    """Rewrite one closed day of a table as a few files sorted by cell under another root."""
    rows = read_table(spark, path, target, partitions=True).where(F.col("ingest_date") == day)
    (rows.drop("ingest_date").repartitionByRange(files, "cell_id", "batch_id", "id")
     .sortWithinPartitions("cell_id", "batch_id", "id")
     .write.mode("overwrite").parquet(f"{to}/ingest_date={day}"))
