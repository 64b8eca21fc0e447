"""Shared scratch space and small frame helpers."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F


def scratch_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, named by ``spark.checkpoint.dir``."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    local = tempfile.mkdtemp(prefix="cellpulse-")
    spark.sparkContext.setCheckpointDir(local)
    return local


def new_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str = "frame") -> DataFrame:
    """Write the frame once to shared storage and continue from the files.

    Cuts the lineage so that lost executors cost a re-read, not a re-run, and
    fixes values that would change on recomputation.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dealt(df: DataFrame, rows: int, few: int = 100_000) -> DataFrame:
    """Rows dealt evenly over the cores, for passes that each send a result per task.

    ``rows`` is their number; a few stay where they are.
    """
    if rows <= few:
        return df
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism)


def small_broadcast(df: DataFrame, rows: int, bound: int = 10_000) -> DataFrame:
    """Broadcast hint only for a side whose known row count is within the bound."""
    return F.broadcast(df) if rows <= bound else df


def _literal(value, kind: str) -> str:
    if value is None:
        return f"CAST(NULL AS {kind})"
    if kind == "string":
        return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"
    if kind == "double":
        return f"CAST('{float(value)!r}' AS DOUBLE)"
    return f"CAST({value} AS {kind})"


def small_table(spark: SparkSession, columns: str, rows: list) -> DataFrame:
    """Result- or configuration-sized table as an inline relation, whose size Spark knows.

    ``columns`` is a DDL list of simple types.
    """
    names, kinds = zip(*[c.split() for c in columns.split(",")])
    if not rows:
        return spark.createDataFrame([], columns)
    body = ", ".join(
        "(" + ", ".join(_literal(v, k) for v, k in zip(row, kinds)) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {body} AS t({', '.join(names)})")


def rounded(df: DataFrame, digits: int = 6, **other) -> DataFrame:
    """Round every double column, so that sums in another order compare equal.

    ``other`` gives digits for single columns, such as quantiles that may end in a 5.
    """
    return df.select([
        F.round(F.col(name), other.get(name, digits)).alias(name) if kind == "double"
        else F.col(name) for name, kind in df.dtypes])
