"""Exact splits, quotas and folds in the order of a hash of the row key.

The hash order is the same on every run and engine. A quota is met without moving rows:
counts per hash prefix locate the prefix where it is reached, only the rows of that prefix
are ranked, and the boundary found there is compared with every row in place.
"""

from pyspark.sql import DataFrame, Window, functions as F

from cellpulse.operators.ordering import edge, row_index
from cellpulse.session import materialise, small_broadcast, small_table

_PREFIX = 4  # hex digits: 65536 even shares of each class


def key_hash(key: str):
    return F.md5(F.col(key).cast("string"))


def mark_quota(df: DataFrame, label: str, key: str, quota) -> DataFrame:
    """Add ``picked``: true for the first ``quota(n_class, n_all)`` rows of each class."""
    marked = mark_quotas(df, label, key, [quota])
    return marked.withColumn("picked", F.col("picked_from").isNotNull()).drop("picked_from")


def mark_quotas(df: DataFrame, label: str, key: str, quotas: list) -> DataFrame:
    """Add ``picked_from``: place of the first of the growing quotas that takes the row, or null.

    All quotas share one count of the rows and one pass that marks them.
    """
    hashed = df.withColumn("_h", key_hash(key)).withColumn("_p", F.substring("_h", 1, _PREFIX))
    shares = materialise(hashed.groupBy(label, "_p").agg(F.count(F.lit(1)).alias("_c")), "shares")
    sizes = {r[label]: r["n"] for r in
             shares.groupBy(label).agg(F.sum("_c").alias("n")).collect()}  # one row per class
    total, most = sum(sizes.values()), len(sizes) * len(quotas)
    wanted = small_table(
        df.sparkSession,
        f"_label {df.schema[label].dataType.simpleString()}, _at int, _quota bigint",
        [(c, i, min(n, quota(n, total))) for c, n in sizes.items() for i, quota in enumerate(quotas)])
    wanted = small_broadcast(wanted, most)
    run = Window.partitionBy(label).orderBy("_p")  # at most 65536 counts per class
    cut = (shares.withColumn("_cum", F.sum("_c").over(run))
           .join(wanted, F.col(label).eqNullSafe(F.col("_label")))
           .where((F.col("_cum") >= F.col("_quota")) & (F.col("_cum") - F.col("_c") < F.col("_quota")))
           .select("_label", "_at", F.col("_p").alias("_cut"),
                   (F.col("_quota") - (F.col("_cum") - F.col("_c"))).alias("_need")))
    edge = hashed.select(F.col(label).alias("_l"), "_h", "_p", key).join(
        small_broadcast(cut, most),
        F.col("_l").eqNullSafe(F.col("_label")) & (F.col("_p") == F.col("_cut")))
    rank = F.row_number().over(Window.partitionBy("_label", "_at").orderBy("_h", key))
    bounds = (edge.withColumn("_rank", rank).where(F.col("_rank") == F.col("_need"))
              .groupBy("_label").agg(*[
                  F.max(F.when(F.col("_at") == i, F.struct("_h", key))).alias(f"_bound{i}")
                  for i in range(len(quotas))]))
    first = F.coalesce(*[F.when(F.struct("_h", key) <= F.col(f"_bound{i}"), F.lit(i))
                         for i in range(len(quotas))])
    return (hashed.join(small_broadcast(bounds, len(sizes)),
                        F.col(label).eqNullSafe(F.col("_label")), "left")
            .withColumn("picked_from", first)
            .drop("_h", "_p", "_label", *[f"_bound{i}" for i in range(len(quotas))]))


def split_stratified(df: DataFrame, label: str, key: str, train: float = 0.8) -> DataFrame:
    """Add ``part``: ``train`` for the given share of each class, else ``test``."""
    marked = mark_quota(df, label, key, lambda n, _: int(round(train * n, 9)))
    return marked.withColumn(
        "part", F.when(F.col("picked"), "train").otherwise("test")).drop("picked")


def split_chronological(df: DataFrame, order: list, train: float = 0.8) -> DataFrame:
    """Add ``part``: the earlier share of all rows is ``train``.

    Only the order columns are sorted; the rows are compared with the boundary in place.
    """
    spots = row_index(df.select(*order), order, name="_idx")
    cut = int(round(spots.count() * train, 9))
    bound = spots.where(F.col("_idx") == cut).first()
    if bound is None:
        return df.withColumn("part", F.lit("test"))
    last = edge(bound, order, dict(df.dtypes))
    return df.withColumn(
        "part", F.when(F.struct(*order) <= last, "train").otherwise("test"))


def sample_stratified(df: DataFrame, label: str, key: str, cap: int) -> DataFrame:
    """Proportional sample of about ``cap`` rows, at least one row per class."""
    marked = mark_quota(df, label, key, lambda n, total: max(1, int(min(1.0, cap / total) * n)))
    return marked.where("picked").drop("picked")


def sample_uniform(df: DataFrame, key: str, cap: int) -> DataFrame:
    one = df.withColumn("_all", F.lit(1))
    return mark_quota(one, "_all", key, lambda n, _: cap).where("picked").drop("picked", "_all")


def folds(df: DataFrame, label: str, key: str, k: int) -> DataFrame:
    """Add ``fold`` 0…k-1, dealt in turn within each class in hash order."""
    hashed = df.withColumn("_h", key_hash(key))
    return (row_index(hashed, ["_h", key], [label], "_idx")
            .withColumn("fold", ((F.col("_idx") - 1) % k).cast("int")).drop("_h", "_idx"))
