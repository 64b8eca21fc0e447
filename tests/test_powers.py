"""Powers of the Yeo-Johnson scaling: moments of all candidates in one pass over the rows."""

import math

from cellpulse.plans import features as fe


def likelihood(values, lam):
    def shape(x):
        power, sign = (lam, 1) if x >= 0 else (2 - lam, -1)
        grown = abs(x) + 1
        return sign * (math.log(grown) if abs(power) < 1e-9 else (grown ** power - 1) / power)
    t = [shape(x) for x in values]
    mean = sum(t) / len(t)
    v = sum((x - mean) ** 2 for x in t) / len(t)
    s = sum(math.copysign(math.log1p(abs(x)), x) for x in values)
    return -len(t) / 2 * math.log(v) + (lam - 1) * s


def test_moments_of_all_candidates_over_many_tasks(spark):
    x = [((i * 37 % 101) / 9.0 - 3) ** 3 for i in range(300)]
    rows = [(v, None if i % 3 else v + 5.0, 7.25, None) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "x double, y double, same double, none double").repartition(7)
    grid = [round(-2 + 0.5 * i, 2) for i in range(9)]
    found = fe._best_powers(df, dict.fromkeys(df.columns, grid))
    y = [v + 5.0 for i, v in enumerate(x) if i % 3 == 0]
    assert found == {"x": max(grid, key=lambda lam: likelihood(x, lam)),
                     "y": max(grid, key=lambda lam: likelihood(y, lam))}
