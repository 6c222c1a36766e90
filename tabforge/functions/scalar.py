"""Column expressions: feature engineering, bands, codes and text helpers.

Everything here stays a native Spark expression, so it runs inside whole-stage
codegen next to the scan.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---- dates -----------------------------------------------------------------

def date_parts(text: Column | str) -> dict[str, Column]:
    """Calendar digits of a ``YYYY-MM-DD HH:...`` string, as written (no zone shift)."""
    c = col(text)
    spans = {"year": (1, 4), "month": (6, 2), "day": (9, 2), "hour": (12, 2)}
    return {name: F.substring(c, start, length).try_cast("int") for name, (start, length) in spans.items()}


def cyclic(value: Column | str, period: float) -> tuple[Column, Column]:
    """Sine and cosine of a position on a cycle of the given period."""
    angle = col(value) * F.lit(2.0 * math.pi) / F.lit(float(period))
    return F.sin(angle), F.cos(angle)


def is_winter(month: Column | str) -> Column:
    return col(month).isin(12, 1, 2).cast("int")


def is_summer(month: Column | str) -> Column:
    return col(month).isin(6, 7, 8).cast("int")


def is_day(hour: Column | str) -> Column:
    return col(hour).between(6, 18).cast("int")


# ---- arithmetic features ---------------------------------------------------

def wind_vector(speed: Column | str, bearing: Column | str) -> tuple[Column, Column]:
    """East and north parts of a speed at a bearing in degrees."""
    theta = F.radians(col(bearing))
    return col(speed) * F.cos(theta), col(speed) * F.sin(theta)


def flag_below(c: Column | str, limit: float) -> Column:
    """1 where below the limit; a missing value counts as 0."""
    return F.coalesce(col(c) < F.lit(limit), F.lit(False)).cast("int")


def flag_above(c: Column | str, limit: float) -> Column:
    return F.coalesce(col(c) > F.lit(limit), F.lit(False)).cast("int")


def safe_ratio(num: Column | str, den: Column | str, offset: float = 0.01) -> Column:
    return F.try_divide(col(num), col(den) + F.lit(offset))


def pct_change(new: Column | str, old: Column | str, on_zero: str = "null", signed: bool = False) -> Column:
    """Change in percent of ``old``. ``on_zero``: 'null', 'zero' or 'epsilon' (old := 1e-10)."""
    n, o = col(new), col(old)
    if on_zero == "epsilon":
        o = F.when(o == 0, F.lit(1e-10)).otherwise(o)
    out = F.try_divide(n - o, o) * 100.0
    if not signed:
        out = F.abs(out)
    if on_zero == "zero":
        out = F.when(col(old) == 0, F.lit(0.0)).otherwise(out)
    return out


def log_target(y: Column | str, train_min: float | Column) -> Column:
    lo = train_min if isinstance(train_min, Column) else F.lit(float(train_min))
    return F.log1p(col(y) - lo + 1.0)


def unlog_target(p: Column | str, train_min: float | Column) -> Column:
    lo = train_min if isinstance(train_min, Column) else F.lit(float(train_min))
    return F.expm1(col(p)) + lo - 1.0


def neg_log10_p(p: Column | str) -> Column:
    return -F.log10(col(p) + F.lit(1e-300))


def sigmoid(margin: Column | str) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-col(margin)))


def rescale(x: Column | str, lo: Column, hi: Column, reverse: bool = False) -> Column:
    """Metric to 0..1 with a 1e-8 guard; ``reverse`` makes small values good."""
    share = (col(x) - lo) / (hi - lo + F.lit(1e-8))
    return F.lit(1.0) - share if reverse else share


# ---- bands -----------------------------------------------------------------

def banded(c: Column | str, limits: list[float], names: list[str], closed_right: bool = False) -> Column:
    """Name of the interval a value falls in; ``limits`` split the line ascending.

    The default puts a value equal to a limit into the upper interval.
    """
    x = col(c)
    out = None
    for limit, name in zip(limits, names):
        test = x <= F.lit(limit) if closed_right else x < F.lit(limit)
        out = F.when(test, F.lit(name)) if out is None else out.when(test, F.lit(name))
    return F.when(x.isNotNull(), out.otherwise(F.lit(names[-1])))


# The report limits.
RISK_LIMITS, RISK_NAMES = [30.0, 70.0], ["Low", "Moderate", "High"]
TEMPERATURE_LIMITS, TEMPERATURE_NAMES = [0.0, 15.0, 25.0], ["Freezing", "Cold", "Pleasant", "Hot"]
QUALITY_LIMITS, QUALITY_NAMES = [5.0, 10.0], ["EXCELLENT", "GOOD", "FAIR"]
CORRELATION_LIMITS, CORRELATION_NAMES = [0.2, 0.3], ["weak", "moderate", "strong"]


def risk_band(risk: Column | str) -> Column:
    return banded(risk, RISK_LIMITS, RISK_NAMES)


def temperature_band(t: Column | str) -> Column:
    return banded(t, TEMPERATURE_LIMITS, TEMPERATURE_NAMES)


def quality_grade(change_pct: Column | str) -> Column:
    return banded(change_pct, QUALITY_LIMITS, QUALITY_NAMES)


def correlation_band(r: Column | str) -> Column:
    """By |r|: weak up to 0.2, moderate up to 0.3, strong above."""
    return banded(F.abs(col(r)), CORRELATION_LIMITS, CORRELATION_NAMES, closed_right=True)


def auc_change_band(delta_pp: Column | str) -> Column:
    d = col(delta_pp)
    return (
        F.when(F.abs(d) < 0.5, F.lit("comparable")).when(d > 0, F.lit("improved")).when(d.isNotNull(), F.lit("degraded"))
    )


# ---- rule-based class distribution ----------------------------------------

# Cloud-cover lower limits with the distribution over
# (Clear, Mostly Cloudy, Overcast, Partly Cloudy) positions, and the last row as default.
SKY_RULES = [
    (6.0, [0.05, 0.10, 0.25, 0.60]),
    (4.0, [0.10, 0.20, 0.60, 0.10]),
    (2.0, [0.20, 0.60, 0.15, 0.05]),
    (None, [0.70, 0.20, 0.08, 0.02]),
]
SKY_CLASSES = ["Clear", "Mostly Cloudy", "Overcast", "Partly Cloudy"]


def sky_distribution(cloud: Column | str, humidity: Column | str) -> Column:
    """Class shares from cloud cover (0..8) and humidity in percent, summing to 1.

    Humid air moves weight to the last class, dry air to the first.
    """
    base = None
    for limit, shares in SKY_RULES:
        arr = F.array(*[F.lit(s) for s in shares])
        if limit is None:
            base = base.otherwise(arr)
        else:
            test = col(cloud) > limit
            base = F.when(test, arr) if base is None else base.when(test, arr)
    favoured = F.when(col(humidity) > 80, F.lit(3)).when(col(humidity) < 30, F.lit(0)).otherwise(F.lit(-1))
    weighted = F.transform(
        base,
        lambda p, i: F.when(favoured < 0, p).when(i == favoured, p * 1.3).otherwise(p * 0.7),
    )
    total = F.aggregate(weighted, F.lit(0.0), lambda acc, p: acc + p)
    return F.transform(weighted, lambda p: p / total)


def arg_max_label(shares: Column, labels: list[str]) -> Column:
    """Label at the first largest position."""
    pos = F.array_position(shares, F.array_max(shares)).cast("int")
    return F.element_at(F.array(*[F.lit(x) for x in labels]), pos)


# ---- text ------------------------------------------------------------------

def choice_code(label: Column | str) -> Column:
    """First integer inside a choice label such as ``"Male (1)"``."""
    digits = F.regexp_extract(col(label), r"(\d+)", 1)
    return F.when(digits != "", digits.try_cast("int"))


def model_type(name: Column | str) -> Column:
    c = col(name)
    return (
        F.when(c.contains("Voting") | c.contains("Stacking"), F.lit("Ensemble"))
        .when(c.contains("GridSearch"), F.lit("GridSearch"))
        .otherwise(F.lit("Individual"))
    )
