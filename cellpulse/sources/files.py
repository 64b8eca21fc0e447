"""CSV files, row batches and fact files."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from cellpulse import schema
from cellpulse.operators.ordering import rows_between

SECONDS = "yyyy-MM-dd HH:mm:ss"
MICROS = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def read_csv(spark: SparkSession, paths, record: StructType = schema.RAW_RECORD,
             timestamp_format: str = SECONDS) -> DataFrame:
    """Scan CSV with a header and a declared schema; no inference pass."""
    return (spark.read.schema(record).option("header", True)
            .option("timestampNTZFormat", timestamp_format)
            .option("timestampFormat", timestamp_format).csv(paths))


def write_csv(df: DataFrame, path: str, timestamp_format: str = SECONDS, mode: str = "error"):
    (df.write.mode(mode).option("header", True)
     .option("timestampNTZFormat", timestamp_format)
     .option("timestampFormat", timestamp_format).csv(path))


def row_batch(df: DataFrame, batch_number: int, batch_size: int, order: list) -> DataFrame:
    """Batch ``batch_number`` (from 1) of ``batch_size`` rows in the given order.

    Positions come from a range partitioning, so a late batch costs no more than an
    early one. Raises if the batch starts past the end.
    """
    start = (batch_number - 1) * batch_size
    total = df.count()
    if batch_number < 1 or start >= total:
        raise ValueError(f"batch {batch_number} is out of range: {total} rows")
    return rows_between(df, order, start + 1, start + batch_size)


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(hadoop)


def union_facts(spark: SparkSession, paths: list, timestamp_format: str = SECONDS) -> DataFrame:
    """Union of the per-KPI forecast files; missing paths are skipped."""
    found = [p for p in paths if path_exists(spark, p)]
    if not found:
        return spark.createDataFrame([], schema.FACT_PREDICTIONS)
    return read_csv(spark, found, schema.FACT_PREDICTIONS, timestamp_format)
