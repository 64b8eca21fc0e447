"""Ridge forecasts from lagged moments: all KPIs in one pass, without a row per window.

The next value of a KPI is a linear function of its seven features in the 12 rows before. Least
squares needs only the sums of products of lags, so blocks of the ordered series give one small
matrix per KPI, which add up to the whole; the coefficients come from those sums.
"""

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from cellpulse import schema
from cellpulse.operators.ordering import blocks, row_index
from cellpulse.session import materialise

ORDER = ["timestamp", "ue_id", "id"]
ROWS_AT_ONCE = 4096  # windows that a task lays out side by side


def series(df: DataFrame, kpis: list, by: list = ("cell_id",), length: int = 12,
           block_rows: int = 50_000, train_share: float = 0.8) -> DataFrame:
    """Stored blocks of every KPI's series: features ``x`` (the KPI first), place and split.

    Rows without one of a KPI's features are not part of its series. The first ``length`` rows of a
    series only serve as history; ``train`` marks the earlier share of each series.
    """
    by, entries = list(by), []
    for kpi in kpis:
        names = [kpi] + [f for f in schema.FORECAST_FEATURES[kpi] if f != kpi]
        known = " AND ".join(f"`{f}` IS NOT NULL" for f in names)
        values = ", ".join(f"CAST(`{f}` AS DOUBLE)" for f in names)
        entries.append(f"CASE WHEN {known} THEN named_struct('kpi', '{kpi}', 'x', array({values})) END")
    keep = list(dict.fromkeys(by + ORDER + ["slice_type"]))
    long = df.selectExpr(*keep, f"inline(array_compact(array({', '.join(entries)})))")
    keys = ["kpi"] + by
    placed = row_index(long, ORDER, keys, "position")
    sizes = placed.groupBy(*keys).agg(F.count(F.lit(1)).alias("_size"))  # a row per series
    same = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]
    sizes = sizes.select(*[F.col(k).alias(f"_k_{k}") for k in keys], "_size")
    sized = placed.join(sizes, same).withColumn(
        "train", F.col("position") <= F.floor(F.col("_size") * F.lit(train_share)))
    cut = blocks(sized.drop("_size", *[f"_k_{k}" for k in keys]), "position", keys, before=length,
                 size=block_rows)
    return materialise(cut, "series")


def _windows(block: pd.DataFrame, length: int):
    """Parts of a block as (rows that are predicted, their lags side by side, oldest first)."""
    block = block.sort_values("position", ignore_index=True)
    x = np.array(block["x"].tolist(), "float64")
    wanted = np.flatnonzero(block["_own"].to_numpy() & (block["position"].to_numpy() > length))
    for start in range(0, len(wanted), ROWS_AT_ONCE):
        rows = wanted[start:start + ROWS_AT_ONCE]
        lags = x[rows[:, None] + np.arange(-length, 0)].reshape(len(rows), -1)
        yield block.iloc[rows], x[rows, 0], lags


def moments(cut: DataFrame, by: list = ("cell_id",), length: int = 12) -> DataFrame:
    """Sums of products per KPI as rows (kpi, i, j, s) with i <= j, over the training rows.

    Place 0 is the constant 1, place 1 the value to come, place 2 + 7 a + f feature f of the
    row ``length - a`` before it.
    """
    def products(block: pd.DataFrame) -> pd.DataFrame:
        total, kpi = 0.0, block["kpi"].iloc[0]
        for rows, goal, lags in _windows(block, length):
            z = np.column_stack([np.ones(len(goal)), goal, lags])[rows["train"].to_numpy()]
            total = total + z.T @ z
        if np.ndim(total) == 0:
            return pd.DataFrame({"kpi": [], "i": [], "j": [], "s": []}).astype(
                {"kpi": "object", "i": "int32", "j": "int32", "s": "float64"})
        i, j = np.triu_indices(len(total))
        return pd.DataFrame({"kpi": kpi, "i": i.astype("int32"), "j": j.astype("int32"),
                             "s": total[i, j]})
    sums = (cut.groupBy("kpi", *by, "_block")
            .applyInPandas(products, "kpi string, i int, j int, s double"))
    return sums.groupBy("kpi", "i", "j").agg(F.sum("s").alias("s"))


def solve(sums: DataFrame, strength: float = 0.001) -> dict:
    """Intercept and coefficients per KPI; the penalty is on scaled features, as a share of rows.

    The sums are fixed in size: 3,741 rows per KPI, whatever the data.
    """
    fits = {}
    for kpi, rows in sums.toPandas().groupby("kpi"):
        size = int(rows["j"].max()) + 1
        gram = np.zeros((size, size))
        gram[rows["i"], rows["j"]] = rows["s"]
        gram = gram + np.triu(gram, 1).T
        n = gram[0, 0]
        if n < 1:
            continue
        mean = gram[0, 1:] / n
        spread = gram[1:, 1:] / n - np.outer(mean, mean)
        scale = np.sqrt(np.maximum(np.diag(spread)[1:], 0.0))
        flat = scale <= 1e-9 * np.maximum(1.0, np.abs(mean[1:]))
        scale[flat] = 1.0
        inner = spread[1:, 1:] / np.outer(scale, scale)
        inner[flat, :] = 0.0
        inner[:, flat] = 0.0
        outer = np.where(flat, 0.0, spread[1:, 0] / scale)
        factors = np.linalg.solve(inner + strength * np.eye(len(inner)), outer) / scale
        fits[kpi] = (float(mean[0] - factors @ mean[1:]), factors.tolist())
    return fits


def predict(cut: DataFrame, fits: dict, by: list = ("cell_id",), length: int = 12) -> DataFrame:
    """Every row with a full history, with its value (``target``) and ``prediction``."""
    kinds = dict(cut.dtypes)
    names = [c for c in cut.columns if c not in ("x", "_own", "_block")]
    layout = ", ".join([f"`{c}` {kinds[c]}" for c in names] + ["target double", "prediction double"])

    def score(block: pd.DataFrame) -> pd.DataFrame:
        parts = []
        constant, factors = fits.get(block["kpi"].iloc[0], (np.nan, None))
        for rows, goal, lags in _windows(block, length):
            guess = constant if factors is None else constant + lags @ np.array(factors)
            parts.append(rows[names].assign(target=goal, prediction=guess))
        return (pd.concat(parts) if parts
                else block.iloc[:0][names].assign(target=0.0, prediction=0.0))
    return cut.groupBy("kpi", *by, "_block").applyInPandas(score, layout)
