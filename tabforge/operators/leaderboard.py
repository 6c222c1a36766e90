"""Operations on result tables: ranking, comparing runs, gating and registering.

Result tables have one row per run, so a single-partition window is fine here.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from tabforge.functions.scalar import auc_change_band


def sort_by_metric(df: DataFrame, metric: str, keys: Sequence[str] = ("model", "normalization")) -> DataFrame:
    return df.orderBy(F.col(metric).desc_nulls_last(), *keys)


def ranked(df: DataFrame, metric: str, keys: Sequence[str] = ("model", "normalization"), smallest: bool = False) -> DataFrame:
    """Place 1..n of every run; use on result tables only."""
    first = F.col(metric).asc_nulls_last() if smallest else F.col(metric).desc_nulls_last()
    return df.withColumn("place", F.row_number().over(Window.orderBy(first, *keys)).cast("long"))


def best_row(df: DataFrame, metric: str, keys: Sequence[str], smallest: bool = False) -> DataFrame:
    """The winning run; NULL metrics lose and ties go to the first key."""
    order = F.col(metric).asc() if smallest else F.col(metric).desc()
    return df.where(F.col(metric).isNotNull()).orderBy(order, *keys).limit(1)


def best_per(df: DataFrame, group: str, metric: str, keys: Sequence[str]) -> DataFrame:
    """First row per group in metric order, as one aggregate without a window sort."""
    rest = [c for c in df.columns if c not in (group, metric) and c not in keys]
    order = F.struct((-F.col(metric)).alias("_neg"), *keys, *rest)
    picked = df.where(F.col(metric).isNotNull()).groupBy(group).agg(F.min(order).alias("r"))
    return picked.select(group, *[F.col(f"r.{c}").alias(c) for c in (*keys, *rest)], (-F.col("r._neg")).alias(metric)).select(
        *df.columns
    )


def top_with_ties(df: DataFrame, metric: str, k: int) -> DataFrame:
    """Rows whose value reaches the k-th largest; distributed top-k, then a filter."""
    kth = df.orderBy(F.col(metric).desc_nulls_last()).limit(k).agg(F.min(metric).alias("kth")).scalar()
    return df.where(F.col(metric) >= kth)


def grid(configs: DataFrame, name: str, values: Sequence) -> DataFrame:
    """Every configuration with every value of a second axis."""
    return configs.withColumn(name, F.explode(F.array(*[F.lit(v) for v in values])))


def unregistered(new: DataFrame, registry: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Runs still to do; makes a repeated job skip what is stored."""
    return new.join(registry.select(*keys), list(keys), "left_anti")


def against_baseline(df: DataFrame, metric: str, baseline: DataFrame) -> DataFrame:
    """Signed change to a one-row, one-column baseline, in percent and points."""
    base = baseline.scalar()
    x = F.col(metric)
    return df.withColumn("change_pct", F.try_divide(x - base, base) * 100.0).withColumn("change_pp", (x - base) * 100.0)


def compare_runs(a: DataFrame, b: DataFrame, metric: str, key: str = "model") -> DataFrame:
    """Best metric per model in both experiments, with the delta."""
    left = a.groupBy(key).agg(F.max(metric).alias("metric_a"))
    right = b.groupBy(key).agg(F.max(metric).alias("metric_b"))
    return left.join(right, key).withColumn("delta", F.col("metric_b") - F.col("metric_a"))


def win_loss(compared: DataFrame, tolerance: float = 0.001) -> DataFrame:
    """Improved, degraded and same counts; the three bands do not overlap."""
    d = F.col("delta")
    return compared.agg(
        F.count_if(d >= tolerance).alias("improved"),
        F.count_if(d <= -tolerance).alias("degraded"),
        F.count_if(F.abs(d) < tolerance).alias("same"),
    )


def comparison_report(a: DataFrame, b: DataFrame, metric: str) -> DataFrame:
    """Per-model deltas with the verdict band of the change in points."""
    return compare_runs(a, b, metric).withColumn("verdict", auc_change_band(F.col("delta") * 100.0))


def gate(candidates: DataFrame, previous: DataFrame, auc: str = "auc", accuracy: str = "accuracy", drift: str = "drift") -> DataFrame:
    """Decide per candidate whether to store it, with the reasons.

    Stored when AUC or accuracy beats the best before, or when drift improves and
    AUC is at least 0.995 of the best before. ``previous``: one row best_auc,
    best_accuracy, best_drift.
    """
    p = previous.select(F.struct("best_auc", "best_accuracy", "best_drift").alias("p")).scalar()
    better_auc, better_acc = F.col(auc) > p["best_auc"], F.col(accuracy) > p["best_accuracy"]
    better_drift = F.col(drift) < p["best_drift"]
    near = F.col(auc) >= p["best_auc"] * 0.995
    reasons = F.array_compact(
        F.array(F.when(better_auc, F.lit("auc")), F.when(better_acc, F.lit("accuracy")), F.when(better_drift, F.lit("drift")))
    )
    return candidates.withColumn("save", (better_auc | better_acc | (better_drift & near)).cast("int")).withColumn(
        "reasons", F.concat_ws(",", reasons)
    )
