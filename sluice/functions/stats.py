"""Normal quantile, gamma fit and gamma distribution, rank scores and classes."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

# Coefficients of algorithm AS 241 (Wichura, 1988), lowest degree first.
AS241_CENTRE = (
    (3.3871328727963666080e0, 1.3314166789178437745e2, 1.9715909503065514427e3,
     1.3731693765509461125e4, 4.5921953931549871457e4, 6.7265770927008700853e4,
     3.3430575583588128105e4, 2.5090809287301226727e3),
    (1.0, 4.2313330701600911252e1, 6.8718700749205790830e2, 5.3941960214247511077e3,
     2.1213794301586595867e4, 3.9307895800092710610e4, 2.8729085735721942674e4,
     5.2264952788528545610e3),
)
AS241_MIDDLE = (
    (1.42343711074968357734e0, 4.63033784615654529590e0, 5.76949722146069140550e0,
     3.64784832476320460504e0, 1.27045825245236838258e0, 2.41780725177450611770e-1,
     2.27238449892691845833e-2, 7.74545014278341407640e-4),
    (1.0, 2.05319162663775882187e0, 1.67638483018380384940e0, 6.89767334985100004550e-1,
     1.48103976427480074590e-1, 1.51986665636164571966e-2, 5.47593808499534494600e-4,
     1.05075007164441684324e-9),
)
AS241_TAIL = (
    (6.65790464350110377720e0, 5.46378491116411436990e0, 1.78482653991729133580e0,
     2.96560571828504891230e-1, 2.65321895265761230930e-2, 1.24266094738807843860e-3,
     2.71155556874348757815e-5, 2.01033439929228813265e-7),
    (1.0, 5.99832206555887937690e-1, 1.36929880922735805310e-1, 1.48753612908506148525e-2,
     7.86869131145613259100e-4, 1.84631831751005468180e-5, 1.42151175831644588870e-7,
     2.04426310338993978564e-15),
)

# Plotting position (Gringorten), bound of a standardised value, class limits.
GRINGORTEN = (0.44, 0.12)
Z_BOUND = 3.0
CLASS_LIMITS = (-1.28, -0.84, -0.25, 0.25, 0.84, 1.28)


def _horner(x: Column, coefficients: Sequence[float]) -> Column:
    value = F.lit(coefficients[-1])
    for c in reversed(coefficients[:-1]):
        value = value * x + F.lit(c)
    return value


def probit(p: Column) -> Column:
    """Normal quantile of a probability; -inf and +inf at 0 and 1, null outside [0, 1].

    The formula names its argument some fifty times. It is bound once, as the only element of an
    array, so that the optimiser can move the expression without copying what `p` stands for."""
    return F.get(F.transform(F.array(p), _probit_of), F.lit(0))


def _probit_of(p: Column) -> Column:
    q = p - 0.5
    centre = F.lit(0.180625) - q * q
    near = q * _horner(centre, AS241_CENTRE[0]) / _horner(centre, AS241_CENTRE[1])
    r = F.sqrt(-F.ln(F.least(p, 1 - p)))
    middle = _horner(r - 1.6, AS241_MIDDLE[0]) / _horner(r - 1.6, AS241_MIDDLE[1])
    tail = _horner(r - 5.0, AS241_TAIL[0]) / _horner(r - 5.0, AS241_TAIL[1])
    far = F.when(r <= 5.0, middle).otherwise(tail)
    return (
        F.when(p.isNull() | (p < 0) | (p > 1), F.lit(None).cast("double"))
        .when(p == 0, F.lit(float("-inf")))
        .when(p == 1, F.lit(float("inf")))
        .when(F.abs(q) <= 0.425, near)
        .otherwise(F.signum(q) * far)
    )


def rank_probability(less: Column, equal: Column, n: Column) -> Column:
    """Non-exceedance of a value added to a sample of size n, ties at their mean rank."""
    a, b = GRINGORTEN
    return (less + 1 + equal / 2 - a) / (n + 1 + b)


def sample_probability(value: Column, sample: Column) -> Column:
    """`rank_probability` from the sample held as an array."""
    return rank_probability(
        F.size(F.filter(sample, lambda x: x < value)),
        F.size(F.filter(sample, lambda x: x == value)),
        F.size(sample),
    )


def classify(value: Column, limits: Sequence[float] = CLASS_LIMITS) -> Column:
    """1 + number of limits strictly below the value; null stays null."""
    above = F.lit(1)
    for limit in limits:
        above = above + F.when(value > limit, 1).otherwise(0)
    return F.when(value.isNotNull(), above)


def clip(value: Column, bound: float = Z_BOUND) -> Column:
    return F.greatest(F.least(value, F.lit(bound)), F.lit(-bound))


# --- Gamma ------------------------------------------------------------------------------------

_SHIFT = 8  # the asymptotic series is used from this argument on


def _digamma(k: Column) -> Column:
    """psi(k) by recurrence up to k + _SHIFT, then the asymptotic series."""
    x = k + _SHIFT
    y = 1 / (x * x)
    series = F.ln(x) - 0.5 / x - y * (1 / 12 - y * (1 / 120 - y * (1 / 252 - y * (1 / 240))))
    for i in range(_SHIFT):
        series = series - 1 / (k + i)
    return series


def _trigamma(k: Column) -> Column:
    x = k + _SHIFT
    y = 1 / (x * x)
    series = 1 / x + y / 2 + y / x * (1 / 6 - y * (1 / 30 - y * (1 / 42 - y * (1 / 30))))
    for i in range(_SHIFT):
        series = series + 1 / ((k + i) * (k + i))
    return series


def gamma_shape(mean: Column, mean_log: Column, steps: int = 10) -> Column:
    """Maximum-likelihood shape with location 0: root of ln k - psi(k) = ln mean - mean of ln.

    Newton steps on 1/k from the usual closed form, folded with `aggregate` so that each step is
    evaluated once. Null when the sample is constant or empty (no finite root)."""
    s = F.ln(mean) - mean_log
    start = (3 - s + F.sqrt((s - 3) * (s - 3) + 24 * s)) / (12 * s)

    def newton(k: Column, _: Column) -> Column:
        gap = F.ln(k) - _digamma(k) - s
        return 1 / (1 / k + gap / (k * k * (1 / k - _trigamma(k))))

    root = F.aggregate(F.array_repeat(F.lit(0), steps), start, newton)
    return F.when(s > 1e-12, root)


LARGE_SHAPE = 1e4  # from here on the uniform expansion is exact to double precision


def _near_normal(k: np.ndarray, t: np.ndarray) -> np.ndarray:
    """P(k, t) for large k by Temme's uniform expansion: a normal law in eta, the signed root of
    2 (mu - ln(1 + mu)) with mu = t / k - 1, and a correction that vanishes away from eta = 0."""
    from math import erfc

    mu = (t - k) / k
    small = np.clip(mu, -0.01, 0.01)
    series = np.polyval([(-1.0) ** j / (j + 2) for j in range(9, -1, -1)], small) * small * small
    with np.errstate(all="ignore"):
        half = np.where(np.abs(mu) <= 0.01, series, mu - np.log1p(mu))
    eta = np.sign(mu) * np.sqrt(2 * half)
    e = np.clip(eta, -0.1, 0.1)  # beyond, the factor exp(-k eta^2 / 2) is below 1e-21
    c0 = np.polyval([-139 / 777600, 1 / 2835, 1 / 864, -2 / 135, 1 / 12, -1 / 3], e)
    c1 = np.polyval([1 / 378, -1 / 288, -1 / 540], e)
    upper = np.array([erfc(v) / 2 for v in -eta * np.sqrt(k / 2)])
    return upper - np.exp(-k * half) / np.sqrt(2 * np.pi * k) * (c0 + c1 / k)


@F.pandas_udf(DoubleType())
def gamma_cdf(x: pd.Series, shape: pd.Series, scale: pd.Series) -> pd.Series:
    """Regularised lower incomplete gamma function, one Arrow batch at a time: series below
    shape + 1, continued fraction above, uniform expansion for large shapes. The loops end on
    convergence, after a few times the root of the shape."""
    from math import lgamma

    k = shape.to_numpy(float)
    t = x.to_numpy(float) / scale.to_numpy(float)
    out = np.full(t.shape, np.nan)
    known = np.isfinite(k) & np.isfinite(t)
    out[known & (t <= 0)] = 0.0
    log_norm = np.array([lgamma(v) if v > 0 else np.nan for v in k])
    with np.errstate(all="ignore"):
        front = np.exp(k * np.log(t) - t - log_norm)

    large = known & (t > 0) & (k >= LARGE_SHAPE)
    if large.any():
        out[large] = _near_normal(k[large], t[large])

    low = known & (t > 0) & (t < k + 1) & (k > 0) & ~large
    if low.any():
        a, u = k[low], t[low]
        term = 1 / a
        total = term.copy()
        n = 0
        while (term >= total * 1e-17).any():
            n += 1
            term = term * u / (a + n)
            total += term
        out[low] = front[low] * total

    high = known & (t >= k + 1) & (k > 0) & ~large
    if high.any():
        # the factors of the fraction tend to 1: stop once all are 1 up to the last two bits
        a, u = k[high], t[high]
        tiny = 1e-300
        b = u + 1 - a
        c = np.full_like(u, 1 / tiny)
        d = 1 / b
        h = d.copy()
        delta = np.zeros_like(u)
        n = 0
        while (np.abs(delta - 1) > 5e-16).any():
            n += 1
            an = -n * (n - a)
            b = b + 2
            d = an * d + b
            d = np.where(np.abs(d) < tiny, tiny, d)
            c = b + an / c
            c = np.where(np.abs(c) < tiny, tiny, c)
            d = 1 / d
            delta = d * c
            h = h * delta
        out[high] = 1 - front[high] * h
    return pd.Series(out).where(known, None)
