"""Tail probabilities for result-sized columns (one value per test)."""

import pandas as pd
from pyspark.sql import Column, functions as F


def normal_two_sided(z: Column) -> Column:
    """P(|Z| > z) for a standard normal."""
    @F.pandas_udf("double")
    def tail(values: pd.Series) -> pd.Series:
        import math
        return values.map(lambda v: None if v is None or v != v
                          else math.erfc(abs(v) / math.sqrt(2.0)))
    return tail(z)


def chi2_tail(x: Column, dof: Column) -> Column:
    """P(X > x) for chi-square with a whole number of degrees of freedom."""
    @F.pandas_udf("double")
    def tail(values: pd.Series, freedoms: pd.Series) -> pd.Series:
        import math

        def one(v, k):
            if v is None or v != v or k is None or k != k or k < 1:
                return None
            half, k = v / 2.0, int(k)
            if half <= 0:
                return 1.0
            # Recurrence Q(a+1) = Q(a) + half^a e^-half / Gamma(a+1), from a = 1/2 or 1.
            q, a = (math.erfc(math.sqrt(half)), 0.5) if k % 2 else (math.exp(-half), 1.0)
            while a < k / 2.0:
                q += math.exp(a * math.log(half) - half - math.lgamma(a + 1))
                a += 1
            return min(q, 1.0)
        return pd.Series([one(v, k) for v, k in zip(values, freedoms)], dtype="float64")
    return tail(x, dof)


# Rational approximation of the normal quantile (Wichura 1988, AS 241), highest
# power first.
_CENTRE_TOP = [2509.0809287301226727, 33430.575583588128105, 67265.770927008700853,
               45921.953931549871457, 13731.693765509461125, 1971.5909503065514427,
               133.14166789178437745, 3.3871328727963666080]
_CENTRE_BOTTOM = [5226.4952788528545610, 28729.085735721942674, 39307.895800092710610,
                  21213.794301586595867, 5394.1960214247511077, 687.18700749205790830,
                  42.313330701600911252, 1.0]
_TAIL_TOP = [7.74545014278341407640e-4, 2.27238449892691845833e-2, 0.241780725177450611770,
             1.27045825245236838258, 3.64784832476320460504, 5.76949722146069140550,
             4.63033784615654529590, 1.42343711074968357734]
_TAIL_BOTTOM = [1.05075007164441684324e-9, 5.47593808499534494600e-4, 1.51986665636164571966e-2,
                0.148103976427480074590, 0.689767334985100004550, 1.67638483018380384940,
                2.05319162663775882187, 1.0]
# End of fixed values.


def normal_quantile(share):
    """Standard normal quantiles of an array of shares between 1e-10 and 1 - 1e-10."""
    import numpy as np
    q = np.asarray(share, "float64") - 0.5
    near = 0.180625 - q * q
    centre = q * np.polyval(_CENTRE_TOP, near) / np.polyval(_CENTRE_BOTTOM, near)
    far = np.sqrt(-np.log(np.maximum(0.5 - np.abs(q), 1e-10))) - 1.6
    tail = np.sign(q) * np.polyval(_TAIL_TOP, far) / np.polyval(_TAIL_BOTTOM, far)
    return np.where(np.abs(q) <= 0.425, centre, tail)


def _horner(x: Column, factors: list) -> Column:
    total = F.lit(factors[0])
    for factor in factors[1:]:
        total = total * x + F.lit(factor)
    return total


def normal_score(share: Column) -> Column:
    """``normal_quantile`` as a column expression."""
    q = share - 0.5
    near = 0.180625 - q * q
    far = F.sqrt(-F.log(F.greatest(0.5 - F.abs(q), F.lit(1e-10)))) - 1.6
    return F.when(F.abs(q) <= 0.425,
                  q * _horner(near, _CENTRE_TOP) / _horner(near, _CENTRE_BOTTOM)).otherwise(
        F.signum(q) * _horner(far, _TAIL_TOP) / _horner(far, _TAIL_BOTTOM))


def normal_score_sql(share: str) -> str:
    """The same as SQL text for another engine."""
    def poly(x, factors):
        text = repr(factors[0])
        for factor in factors[1:]:
            text = f"({text} * {x} + {factor!r})"
        return text
    q = f"({share} - 0.5::DOUBLE)"
    near = f"(0.180625::DOUBLE - {q} * {q})"
    far = f"(sqrt(-ln(greatest(0.5::DOUBLE - abs({q}), 1e-10::DOUBLE))) - 1.6::DOUBLE)"
    return (f"CASE WHEN abs({q}) <= 0.425 THEN {q} * {poly(near, _CENTRE_TOP)} / "
            f"{poly(near, _CENTRE_BOTTOM)} ELSE sign({q}) * {poly(far, _TAIL_TOP)} / "
            f"{poly(far, _TAIL_BOTTOM)} END")
