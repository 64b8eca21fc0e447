"""Feature columns, encodings, fills, scalings and class weights."""

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, functions as F

from cellpulse import schema
from cellpulse.functions.scalar import date_parts, encode, safe_date_parts
from cellpulse.functions.tails import normal_quantile
from cellpulse.operators.ordering import quantile_grid, quantiles
from cellpulse.session import materialise, small_broadcast, small_table


def serving_features(df: DataFrame, slice_column: str = "slice_type") -> DataFrame:
    """The 16 serving features as ``f_*`` columns beside the record; nulls become 0.

    ``timestamp`` may be a timestamp or a text that might not parse.
    """
    parse = safe_date_parts if dict(df.dtypes)["timestamp"] == "string" else date_parts
    parts = parse(F.col("timestamp"))
    made = {"slice_type": encode(F.col(slice_column), schema.SLICES)}
    made.update({p: parts[p] for p in schema.DATE_PARTS})
    return df.select("*", *[
        F.coalesce(made.get(c, F.col(c)).cast("double"), F.lit(0.0)).alias(f"f_{c}")
        for c in schema.SERVING_FEATURES])


SERVING_INPUTS = [f"f_{c}" for c in schema.SERVING_FEATURES]
# Without position and date, which identify a record rather than describe it.
STRICT_INPUTS = [f"f_{c}" for c in schema.SERVING_FEATURES if c not in schema.POSITION_AND_DATE]


def labelled(df: DataFrame) -> DataFrame:
    """Serving features with ``y`` (0/1) and ``y_type`` (code of the anomaly type)."""
    classes = schema.ANOMALY_TYPES + [schema.NORMAL]
    return (serving_features(df)
            .withColumn("y", F.col("anomaly").cast("double"))
            .withColumn("y_type", encode(F.col("anomaly_type"), classes).cast("double")))


def trainer_features(df: DataFrame) -> DataFrame:
    """The 15 stand-alone trainer features; nulls become the column median."""
    coded = df.withColumn("slice_type_encoded", encode(F.col("slice_type"), schema.SLICES)
                          .cast("double"))
    return fill_median(coded, schema.TRAINER_FEATURES)


def assemble(columns: list, output: str = "features") -> VectorAssembler:
    return VectorAssembler(inputCols=list(columns), outputCol=output, handleInvalid="keep")


def with_date_parts(df: DataFrame) -> DataFrame:
    return df.select("*", *[c.alias(n) for n, c in date_parts(F.col("timestamp")).items()])


# ---- fills ---------------------------------------------------------------

def fill_zero(df: DataFrame, columns: list) -> DataFrame:
    return df.na.fill(0.0, columns)


def medians(df: DataFrame, columns: list) -> dict:
    long = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        [], list(columns), "name", "value")
    rows = quantiles(long, "value", [0.5], ["name"], ["median"]).collect()  # one per column
    return {r["name"]: r["median"] for r in rows}


def fill_median(df: DataFrame, columns: list) -> DataFrame:
    """Exact medians, computed only for the columns that have nulls."""
    holes = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns]).first()
    gaps = [c for c in columns if holes[c]]
    if not gaps:
        return df
    found = medians(df, gaps)
    return df.na.fill({c: m for c, m in found.items() if m is not None})


# ---- scalings ------------------------------------------------------------

def standard_scaler(train: DataFrame, columns: list):
    """Scaling by mean and population spread of the training rows; a constant gives 0."""
    row = train.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(columns)],
                    *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(columns)]).first()

    def scale(df: DataFrame) -> DataFrame:
        return df.withColumns({
            c: (F.col(c) - F.lit(row[f"m{i}"])) / F.lit(row[f"s{i}"] or 1.0)
            for i, c in enumerate(columns)})
    return scale


NEAR = 1e-9  # powers closer to 0 count as 0


def yeo_johnson(x, power):
    """Power transform of a column; ``power`` is a number or a column."""
    lam = F.lit(power) if isinstance(power, (int, float)) else power
    near = NEAR
    up = F.when(F.abs(lam) < near, F.log1p(F.abs(x))).otherwise(
        (F.pow(F.abs(x) + 1, lam) - 1) / F.when(F.abs(lam) < near, 1.0).otherwise(lam))
    rest = 2 - lam
    down = F.when(F.abs(rest) < near, -F.log1p(F.abs(x))).otherwise(
        -(F.pow(F.abs(x) + 1, rest) - 1) / F.when(F.abs(rest) < near, 1.0).otherwise(rest))
    return F.when(x >= 0, up).otherwise(down)


POWER_GRIDS = ((5.0, 20), (0.5, 10), (0.05, 10), (0.01, 5))  # step, candidates on each side
LARGEST = 1e150  # its square still is a number


def _power_moments(columns: list, grids: dict):
    """Task that reduces its rows to one row of moments per column and candidate power."""
    def reduce_rows(batches):
        import numpy as np
        import pyarrow as pa
        held = {(c, lam): [0, 0.0, 0.0, 0.0, 0.0] for c in columns for lam in grids[c]}
        with np.errstate(all="ignore"):
            for batch in batches:
                for place, c in enumerate(columns):
                    x = batch.column(place).drop_null().to_numpy(zero_copy_only=False)
                    if not len(x):
                        continue
                    low = x < 0
                    size, sign = np.abs(x), np.where(low, -1.0, 1.0)
                    grown, logs = size + 1, np.log1p(size)
                    s = float((sign * logs).sum())
                    for lam in grids[c]:
                        t = np.empty(len(x))
                        for part, power in ((~low, lam), (low, 2 - lam)):
                            t[part] = (logs[part] if abs(power) < NEAR
                                       else (np.power(grown[part], power) - 1) / power)
                        t *= sign
                        # Distances from the first value: equal values have no spread at all.
                        off = t - t[0]
                        mid = off.mean()
                        at = held[c, lam]
                        n, step = at[0] + len(t), (t[0] + mid) - at[1]
                        share = len(t) / n
                        at[2] += ((off - mid) ** 2).sum() + step * step * at[0] * share
                        at[1] = t[0] + mid if not at[0] else at[1] + step * share
                        at[3], at[4] = np.maximum(at[3], np.abs(t).max()), at[4] + s
                        at[0] = n
        rows = [(c, lam, *map(float, at)) for (c, lam), at in held.items() if at[0]]
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows])]
                + [pa.array([r[i] for r in rows], pa.float64()) for i in range(1, 7)],
                ["name", "lam", "n", "mean", "m2", "top", "s"])
    return reduce_rows


def _best_powers(train: DataFrame, grids: dict) -> dict:
    """Power of highest likelihood per column of the non-null rows, out of its candidates."""
    columns = list(grids)
    parts = train.select(*columns).mapInArrow(
        _power_moments(columns, grids),
        "name string, lam double, n double, mean double, m2 double, top double, s double")
    fits = parts.groupBy("name", "lam").agg(
        F.collect_list(F.struct("n", "mean", "m2")).alias("parts"),  # one per task
        F.max("top").alias("top"), F.sum("s").alias("s"))

    def merge(x, y):
        n, step = x["n"] + y["n"], y["mean"] - x["mean"]
        return F.struct(n.alias("n"), (x["mean"] + step * y["n"] / n).alias("mean"),
                        (x["m2"] + y["m2"] + step * step * x["n"] * y["n"] / n).alias("m2"))
    whole = F.aggregate(F.slice("parts", 2, F.size("parts")), F.get("parts", F.lit(0)), merge)
    fits = fits.withColumn("all", whole).withColumn("n", F.col("all.n")).withColumn(
        "v", F.col("all.m2") / F.col("n"))
    score = F.when((F.col("v") > 0) & (F.col("top") < LARGEST), -F.col("n") / 2 * F.log("v") + (F.col("lam") - 1) * F.col("s"))
    best = (fits.withColumn("score", score).where(F.col("score").isNotNull()).groupBy("name")
            .agg(F.max_by("lam", "score").alias("lam")))
    return {r["name"]: r["lam"] for r in best.collect()}  # one row per column


def yeo_johnson_scaler(train: DataFrame, columns: list):
    """Powers by ever finer grids on the training rows, then standard scaling.

    A first grid whose end fits best is moved there and searched again, so no power is out of
    reach but those that carry values beyond ``LARGEST``. The columns are stored once, dealt
    evenly; each grid is one pass over them that leaves a row per task, column and power.
    """
    columns = list(columns)
    spark = train.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    train = materialise(train.select(*[F.col(c).cast("double").alias(c) for c in columns])
                        .repartition(tasks), "power")

    def search(centres, step, reach):
        if not centres:
            return {}
        return _best_powers(train, {
            c: [round(lam + step * i, 2) for i in range(-reach, reach + 1)]
            for c, lam in centres.items()})
    step, reach = POWER_GRIDS[0]
    powers, open_ = {}, dict.fromkeys(columns, 0.0)
    while open_:
        found = search(open_, step, reach)
        powers.update(found)
        open_ = {c: lam for c, lam in found.items() if abs(lam - open_[c]) > step * (reach - 0.5)}
    for step, reach in POWER_GRIDS[1:]:
        powers = search(powers, step, reach)

    def warp(df: DataFrame) -> DataFrame:
        return df.withColumns({c: yeo_johnson(F.col(c), powers[c]) for c in columns
                               if c in powers})
    scale = standard_scaler(warp(train), columns)
    return (lambda df: scale(warp(df))), powers


def normal_quantile_scaler(train: DataFrame, columns: list, points: int = 1000):
    """Map each column to a standard normal through its training quantiles."""
    columns = list(columns)
    long = train.select(*columns).unpivot([], columns, "name", "value")
    found = {}
    for row in quantile_grid(long, "value", points, ["name"]).collect():  # `points` numbers each
        found[row["name"]] = row["marks"]

    def make(marks):
        @F.pandas_udf("double")
        def to_normal(values):
            import numpy as np
            import pandas as pd
            x = values.to_numpy(dtype="float64")
            ref, p = np.asarray(marks), np.linspace(0.0, 1.0, len(marks))
            # Equal landmarks: take the middle of the lowest and highest fitting share.
            share = 0.5 * (np.interp(x, ref, p) - np.interp(-x, -ref[::-1], -p[::-1]))
            share = np.clip(share, 1e-7, 1 - 1e-7)
            return pd.Series(normal_quantile(share), dtype="float64")
        return to_normal

    def scale(df: DataFrame) -> DataFrame:
        return df.withColumns({c: make(found[c])(F.col(c)) for c in columns if c in found})
    return scale


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balancing weight n / (classes * n_class) per class."""
    sizes = df.groupBy(label).agg(F.count(F.lit(1)).alias("n_class"))
    rows = sizes.collect()  # one row per class
    total, k = sum(r["n_class"] for r in rows), len(rows)
    return small_table(
        df.sparkSession,
        f"{label} {df.schema[label].dataType.simpleString()}, n_class bigint, weight double",
        [(r[label], r["n_class"], total / (k * r["n_class"])) for r in rows])


def with_class_weight(df: DataFrame, label: str) -> DataFrame:
    weights = class_weights(df, label)
    return df.join(small_broadcast(weights.drop("n_class"), weights.count()), label)
