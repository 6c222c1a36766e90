"""Aggregate expressions whose definition differs between engines."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def skew_unbiased(c: Column | str) -> Column:
    """Bias-corrected skewness (Spark's ``skewness`` is the population form)."""
    x = _c(c)
    n = F.count(x).cast("double")
    g1 = F.skewness(x)
    return F.when(n > 2, g1 * F.sqrt(n * (n - 1.0)) / (n - 2.0))


def kurtosis_unbiased(c: Column | str) -> Column:
    """Bias-corrected excess kurtosis (Spark's ``kurtosis`` is the population form)."""
    x = _c(c)
    n = F.count(x).cast("double")
    g2 = F.kurtosis(x)
    return F.when(n > 3, (n - 1.0) / ((n - 2.0) * (n - 3.0)) * ((n + 1.0) * g2 + 6.0))


def exact_quantile(c: Column | str, q: float) -> Column:
    """Linear-interpolated quantile, exact."""
    return F.percentile(_c(c), F.lit(float(q)))


def correlation(a: Column | str, b: Column | str) -> Column:
    """Pearson r over rows where both exist; NULL for a constant column (``corr`` raises there under ANSI)."""
    x, y = _c(a).cast("double"), _c(b).cast("double")
    px, py = F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(px) * F.stddev_pop(py))


def exact_mean(c: Column | str, digits: int = 6) -> Column:
    """Mean of values rounded to decimals, the same in whatever order they are summed.

    For thresholds: a mean of doubles may differ in its last bit from run to run.
    """
    return F.sum(_c(c).cast(f"decimal(18,{digits})")).cast("double") / F.count(_c(c))
