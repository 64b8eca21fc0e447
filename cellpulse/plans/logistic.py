"""Logistic regressions fitted side by side, and a grid search over them on stratified folds.

All models of a call take their Newton steps together: one pass over the rows returns per task and
model the loss, its slope and its curvature, whose size depends on columns and classes alone.
"""

from typing import NamedTuple

from pyspark.sql import DataFrame, functions as F

from cellpulse.operators import sampling
from cellpulse.plans.features import assemble
from cellpulse.session import dealt, materialise

STRENGTHS = (0.01, 0.1, 1.0, 5.0, 10.0)


class Fit(NamedTuple):
    """Inverse strength over summed losses, penalty, class weights; and the fold left out, if any."""
    c: float = 1.0
    penalty: str = "l2"
    balanced: bool = False
    held: int = -1


class Model(NamedTuple):
    """Coefficients per class, or one row of the second class against the first; intercepts last."""
    classes: list
    coefficients: object


def grid(penalties=("l2",)) -> list:
    return [Fit(c, p, b) for c in STRENGTHS for b in (False, True) for p in penalties]


def _blocks(batch, inputs: list, classes: list):
    """Columns of a batch: rows with a constant 1 at the end, places of their classes, folds."""
    import numpy as np
    x = np.column_stack([batch.column(c).to_numpy(zero_copy_only=False) for c in inputs]
                        + [np.ones(batch.num_rows)])
    y = np.searchsorted(classes, batch.column("_y").to_numpy(zero_copy_only=False))
    return x, y, batch.column("_fold").to_numpy(zero_copy_only=False)


def _curves(inputs: list, classes: list, fits: list, weights, at):
    """Task that reduces its rows to loss, slope and curvature of every model at ``at``."""
    def reduce_rows(batches):
        import numpy as np
        import pyarrow as pa
        width, k = len(inputs) + 1, len(classes)
        upper = np.triu_indices(width)
        one, two = np.triu_indices(k, 1)
        held = np.array([f.held for f in fits])
        single = k == 2
        loss = np.zeros(len(fits))
        slope = np.zeros((len(fits), at.shape[1], width))
        curve = np.zeros((len(fits), 1 if single else len(one), len(upper[0])))
        for batch in batches:
            x, y, fold = _blocks(batch, inputs, classes)
            squares = x[:, upper[0]] * x[:, upper[1]]
            if single:
                sign = np.where(y == 1, 1.0, -1.0)[:, None]
                w = weights[:, y].T * (fold[:, None] != held[None, :])
                margin = sign * (x @ at[:, 0, :].T)
                small = np.exp(-np.abs(margin))
                loss += (w * (np.log1p(small) + np.maximum(-margin, 0))).sum(0)
                miss = np.where(margin > 0, small, 1.0) / (1 + small)
                slope[:, 0, :] -= (w * sign * miss).T @ x
                curve[:, 0, :] += (w * small / (1 + small) ** 2).T @ squares
                continue
            for m in range(len(fits)):
                w = weights[m, y] * (fold != held[m])
                z = x @ at[m].T
                z -= z.max(1)[:, None]
                p = np.exp(z)
                total = p.sum(1)
                loss[m] += (w * (np.log(total) - z[np.arange(len(y)), y])).sum()
                p /= total[:, None]
                wp = w[:, None] * p
                curve[m] += (wp[:, one] * p[:, two]).T @ squares
                wp[np.arange(len(y)), y] -= w
                slope[m] += wp.T @ x
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(len(fits)), pa.int32()), pa.array(loss),
             pa.array(list(slope.reshape(len(fits), -1))),
             pa.array(list(curve.reshape(len(fits), -1)), pa.list_(pa.float64()))],
            ["model", "loss", "slope", "curve"])
    return reduce_rows


def _whole(curve, width: int, k: int):
    """Curvature of all coefficients from its entries between pairs of classes."""
    import numpy as np
    upper = np.triu_indices(width)
    parts = np.zeros((len(curve), width, width))
    parts[:, upper[0], upper[1]] = curve
    parts[:, upper[1], upper[0]] = curve
    if k == 2:
        return parts[0]
    out = np.zeros((k, width, k, width))
    for part, a, b in zip(parts, *np.triu_indices(k, 1)):
        out[a, :, b, :] -= part
        out[b, :, a, :] -= part
        out[a, :, a, :] += part
        out[b, :, b, :] += part
    return out.reshape(k * width, k * width)


def _penalty(fit: Fit, w) -> float:
    import numpy as np
    own = w[:, :-1]  # intercepts are free
    return float(np.abs(own).sum() if fit.penalty == "l1" else (own * own).sum() / 2)


def _direction(fit: Fit, w, slope, curve):
    """Step to the least of the local quadratic plus the penalty, and its promised change."""
    import numpy as np
    flat, width = w.reshape(-1), w.shape[1]
    free = np.arange(len(flat)) % width == width - 1
    curve = curve + np.diag(np.full(len(flat), 1e-10 * (np.trace(curve) / len(flat)) + 1e-300))
    if fit.penalty == "l2":
        pull = np.where(free, 0.0, flat)
        total = slope + pull
        step = -np.linalg.solve(curve + np.diag(np.where(free, 0.0, 1.0)), total)
        return step.reshape(w.shape), float(total @ step)
    goal = _least_l1(curve, slope - curve @ flat, ~free, flat)
    promised = slope @ (goal - flat) + np.abs(goal[~free]).sum() - np.abs(flat[~free]).sum()
    return (goal - flat).reshape(w.shape), float(promised)


def _least_l1(curve, slope, bound, start):
    """Least of u'Cu/2 + s'u + the sum of |u| over ``bound`` entries, by search over their signs.

    The least for given signs is solved for directly; an entry that would change its sign on the
    way stays at 0 until the slope there pulls it off again.
    """
    import numpy as np
    u, sign = start.copy(), np.where(bound, np.sign(start), 0.0)
    for _ in range(100 * len(u)):
        used = np.flatnonzero(~bound | (sign != 0))
        goal = np.zeros(len(u))
        goal[used] = -np.linalg.solve(curve[np.ix_(used, used)], slope[used] + sign[used])
        turned = np.flatnonzero(goal * sign < 0)
        if len(turned):
            shares = u[turned] / (u[turned] - goal[turned])
            u += shares.min() * (goal - u)
            u[turned[shares.argmin()]] = sign[turned[shares.argmin()]] = 0.0
            continue
        u, pull = goal, curve @ goal + slope
        rest = np.where(bound & (sign == 0), np.abs(pull), 0.0)
        if rest.max() <= 1 + 1e-6:
            break
        sign[rest.argmax()] = -np.sign(pull[rest.argmax()])
    return u


def _stored(rows: DataFrame, inputs: list, label: str, fold: str = None) -> tuple:
    """Inputs, label and fold once on disk, read in as many tasks as cores; and counts per both."""
    kept = rows.select(*[F.col(c).cast("double").alias(c) for c in inputs],
                       F.col(label).cast("double").alias("_y"),
                       (F.col(fold) if fold else F.lit(-2)).cast("int").alias("_fold"))
    kept = materialise(dealt(kept, rows.count()), "logistic")
    sizes = {(r["_y"], r["_fold"]): r["n"] for r in kept.groupBy("_y", "_fold").agg(
        F.count(F.lit(1)).alias("n")).collect()}  # one row per class and fold
    if any(y is None for y, _ in sizes):
        raise ValueError(f"{label} must not be null")
    return kept.coalesce(max(16, 2 * rows.sparkSession.sparkContext.defaultParallelism)), sizes


def fit_all(rows: DataFrame, fits: list, inputs: list, label: str, fold: str = None) -> list:
    """One ``Model`` per ``Fit``; ``fold`` names the column that ``held`` refers to."""
    return _fit_stored(*_stored(rows, inputs, label, fold), fits, inputs)


def _fit_stored(kept: DataFrame, sizes: dict, fits: list, inputs: list, starts: list = None,
                passes: int = 200, tolerance: float = 1e-8) -> list:
    import numpy as np
    classes = sorted({y for y, _ in sizes})
    k, width = len(classes), len(inputs) + 1
    if k != 2 and any(f.penalty == "l1" for f in fits):
        raise ValueError("the l1 penalty needs two classes")
    weights = np.zeros((len(fits), k))
    for m, f in enumerate(fits):
        seen = np.array([sum(n for (y, at), n in sizes.items() if y == c and at != f.held)
                         for c in classes], dtype="float64")
        share = seen.sum() / (np.count_nonzero(seen) * np.maximum(seen, 1)) if f.balanced else 1.0
        weights[m] = f.c * share
    trial = (np.array(starts) if starts is not None
             else np.zeros((len(fits), 1 if k == 2 else k, width)))
    best, value, step, promised = [None] * len(fits), [np.inf] * len(fits), {}, {}
    size, open_ = [1.0] * len(fits), list(range(len(fits)))
    for _ in range(passes):
        if not open_:
            break
        parts = kept.mapInArrow(
            _curves(inputs, classes, [fits[m] for m in open_], weights[open_], trial[open_]),
            "model int, loss double, slope array<double>, curve array<double>").collect()
        found = {}
        for r in parts:  # one row per task and model, whose size the columns and classes fix
            own = found.setdefault(r["model"], [0.0, 0.0, 0.0])
            for i, part in enumerate((r["loss"], np.array(r["slope"]), np.array(r["curve"]))):
                own[i] = own[i] + part
        still = []
        for place, m in enumerate(open_):
            loss, slope, curve = found[place]
            now = loss + _penalty(fits[m], trial[m])
            if best[m] is None or now <= value[m] + 1e-4 * size[m] * promised[m]:
                best[m], value[m], size[m] = trial[m].copy(), now, 1.0
                pairs = 1 if k == 2 else k * (k - 1) // 2
                step[m], promised[m] = _direction(
                    fits[m], best[m], slope, _whole(curve.reshape(pairs, -1), width, k))
                if -promised[m] <= tolerance * max(now, 1e-12):
                    continue
            else:
                size[m] /= 2
                if size[m] < 1e-6:
                    continue
            trial[m] = best[m] + size[m] * step[m]
            still.append(m)
        open_ = still
    return [Model(classes, w) for w in best]


def _hits(inputs: list, classes: list, fits: list, models: list):
    """Task that counts (label, prediction) per model over the fold it was not fitted on."""
    def count(batches):
        import numpy as np
        import pyarrow as pa
        k = len(classes)
        held = [f.held for f in fits]
        n = np.zeros((len(fits), k * k), dtype="int64")
        for batch in batches:
            x, y, fold = _blocks(batch, inputs, classes)
            for m, w in enumerate(models):
                own = fold == held[m]
                z = x[own] @ w.T
                guess = (z[:, 0] > 0).astype("int64") if k == 2 else z.argmax(1)
                n[m] += np.bincount(y[own] * k + guess, minlength=k * k)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(len(fits)), pa.int32()), pa.array(list(n))], ["model", "n"])
    return count


def f1_score(pairs, binary: bool) -> float:
    """F1 of the second class, or the mean over classes by support, from counts (label, prediction)."""
    import numpy as np
    hit, support, claimed = np.diag(pairs), pairs.sum(1), pairs.sum(0)
    f1 = 2 * hit / np.maximum(support + claimed, 1)
    return float(f1[-1] if binary else (f1 * support).sum() / max(support.sum(), 1))


def grid_search(train: DataFrame, fits: list, inputs: list, label: str, key: str,
                k: int = 5) -> tuple:
    """Each fit on all rows, and its mean F1 over ``k`` stratified folds it was not fitted on.

    F1 is that of the second of two classes, else the mean by support. Returns ({fit: model},
    {fit: score}); the first of equal scores is the best.
    """
    import numpy as np
    folded = sampling.folds(train, label, key, k)
    kept, sizes = _stored(folded, inputs, label, "fold")
    whole = _fit_stored(kept, sizes, fits, inputs)
    held = [f._replace(held=i) for f in fits for i in range(k)]
    # A fold changes little, so its models go on from those of all rows.
    parts = _fit_stored(kept, sizes, held, inputs, [m.coefficients for m in whole for _ in range(k)])
    classes = whole[0].classes
    pairs = np.zeros((len(held), len(classes) ** 2), dtype="int64")
    for r in kept.mapInArrow(_hits(inputs, classes, held, [m.coefficients for m in parts]),
                             "model int, n array<bigint>").collect():  # a row per task and model
        pairs[r["model"]] += np.array(r["n"], dtype="int64")
    scores = [f1_score(p.reshape(len(classes), -1), len(classes) == 2) for p in pairs]
    means = [sum(scores[i * k:(i + 1) * k]) / k for i in range(len(fits))]
    return dict(zip(fits, whole)), dict(zip(fits, means))


def transform(df: DataFrame, model: Model, inputs: list) -> DataFrame:
    """Add ``features``, ``prediction`` and, for two classes, ``probability``."""
    from pyspark.ml.functions import array_to_vector
    margins = [sum((F.col(c) * F.lit(float(v)) for c, v in zip(inputs, w)), F.lit(float(w[-1])))
               for w in model.coefficients]
    out = assemble(inputs).transform(df)
    if len(model.classes) == 2:
        one = 1 / (1 + F.exp(-margins[0]))
        return out.withColumns({
            "probability": array_to_vector(F.array(1 - one, one)),
            "prediction": F.when(margins[0] > 0, model.classes[1]).otherwise(model.classes[0])})
    every = F.array(*margins)
    codes = F.array(*[F.lit(float(c)) for c in model.classes])
    return out.withColumn("prediction", F.get(codes, (
        F.array_position(every, F.array_max(every)) - 1).cast("int")))


def name(fit: Fit) -> str:
    return f"{fit.penalty}, c={fit.c:g}" + (", balanced" if fit.balanced else "")
