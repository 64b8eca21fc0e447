"""Rows as JSON messages, and streams of messages."""

from pyspark.sql import DataFrame, SparkSession, functions as F


def message(df: DataFrame) -> DataFrame:
    """One JSON text per row in ``value``; nulls are written, timestamps as plain text."""
    fields = [F.col(n).cast("string").alias(n) if k.startswith("timestamp") else F.col(n)
              for n, k in df.dtypes]
    return df.select(F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("value"))


def open_messages(spark: SparkSession, source: str, fmt: str = "text",
                  files_per_trigger: int = None, options: dict = None) -> DataFrame:
    """Stream of message texts in ``value``, from the earliest one.

    ``fmt="kafka"`` reads a topic (the connector must be on the class path), else a folder.
    """
    reader = spark.readStream.format(fmt).options(**(options or {}))
    if fmt == "kafka":
        return (reader.option("subscribe", source).option("startingOffsets", "earliest").load()
                .select(F.col("value").cast("string").alias("value")))
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(source).select("value")
