"""Correlation and distribution tests per feature.

Rank statistics work on counts per distinct value, so their cost after the first
map-side combine follows the number of distinct values, not of rows.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tabforge.functions.special import correlation_p, kolmogorov_p
from tabforge.operators.prefix import running_totals
from tabforge.operators.profile import correlation_with, quoted


@F.pandas_udf(T.DoubleType())
def _corr_p(r: pd.Series, n: pd.Series) -> pd.Series:
    return pd.Series([correlation_p(None if pd.isna(a) else float(a), int(b)) for a, b in zip(r, n)], dtype="float64")


@F.pandas_udf(T.DoubleType())
def _ks_p(d: pd.Series, n1: pd.Series, n2: pd.Series) -> pd.Series:
    return pd.Series(
        [kolmogorov_p(None if pd.isna(a) else float(a), int(b), int(c)) for a, b, c in zip(d, n1, n2)], dtype="float64"
    )


def correlation_p_value(r: Column, n: Column) -> Column:
    return _corr_p(r, n.cast("long"))


def pearson(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """r, p and row count per feature against the target, pairwise complete."""
    out = correlation_with(df, columns, target)
    return out.select("feature", F.col("r").alias("pearson_r"), _corr_p("r", "n").alias("pearson_p"), F.col("n").alias("valid"))


def point_biserial(df: DataFrame, columns: Sequence[str], label: str) -> DataFrame:
    """(mean1 - mean0) / s * sqrt(p*q) with the population deviation."""
    y = F.col(label)
    aggs = []
    for i, c in enumerate(columns):
        x = F.when(y.isNotNull(), F.col(quoted(c)).cast("double"))
        m1, m0 = F.avg(F.when(y == 1, x)), F.avg(F.when(y == 0, x))
        share = F.avg(F.when(x.isNotNull(), y.cast("double")))
        aggs += [
            (F.try_divide(m1 - m0, F.stddev_pop(x)) * F.sqrt(share * (1.0 - share))).alias(f"{i}_r"),
            F.count(x).alias(f"{i}_n"),
        ]
    from tabforge.operators.profile import long_rows

    out = long_rows(df.agg(*aggs), columns, {"r": "r", "n": "n"})
    return out.select("feature", F.col("r").alias("pointbiserial_r"), _corr_p("r", "n").alias("pointbiserial_p"))


def _midranks(joint: DataFrame, key: str) -> DataFrame:
    """Average rank of every distinct key within its feature."""
    counts = joint.groupBy("feature", key).agg(F.sum("n").alias("n"))
    run = running_totals(counts, key, ["n"], by=["feature"])
    return run.select("feature", key, (F.col("n_before") + (F.col("n") + 1) / 2.0).alias(f"rank_{key}"))


def spearman(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """Rank correlation with mid-ranks for ties, over pairwise complete rows."""
    arms = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(quoted(c)).cast("double").alias("x")) for c in columns])
    long = df.select(F.col(quoted(target)).cast("double").alias("y"), F.explode(arms).alias("a")).select("y", "a.*")
    joint = (
        long.where(F.col("x").isNotNull() & F.col("y").isNotNull())
        .groupBy("feature", "x", "y")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    ranked = joint.join(_midranks(joint, "x"), ["feature", "x"]).join(_midranks(joint, "y"), ["feature", "y"])
    n, a, b = F.col("n"), F.col("rank_x"), F.col("rank_y")
    # The mean of mid-ranks is (N + 1) / 2, so the sums can be centred in one pass.
    total = joint.groupBy("feature").agg(F.sum("n").alias("total"))
    centred = ranked.join(F.broadcast(total), "feature")
    da, db = a - (F.col("total") + 1) / 2.0, b - (F.col("total") + 1) / 2.0
    out = centred.groupBy("feature").agg(
        F.try_divide(F.sum(n * da * db), F.sqrt(F.sum(n * da * da) * F.sum(n * db * db))).alias("spearman_r"),
        F.sum("n").alias("n"),
    )
    return out.select("feature", "spearman_r", _corr_p("spearman_r", "n").alias("spearman_p"))


def correlation_table(df: DataFrame, columns: Sequence[str], label: str) -> DataFrame:
    """The full per-feature report: three coefficients, p-values, class means."""
    from tabforge.operators.profile import class_means

    out = pearson(df, columns, label)
    for part in (spearman(df, columns, label), point_biserial(df, columns, label), class_means(df, columns, label)):
        out = out.join(part, "feature")
    return out.withColumn("abs_pearson", F.abs("pearson_r"))


def ks_two_sample(df: DataFrame, feature: str, value: str, in_first: str, alpha: float = 0.05) -> DataFrame:
    """Largest distance of two empirical distributions per feature.

    ``in_first`` is a boolean column that says which sample a row belongs to.
    """
    counts = (
        df.where(F.col(value).isNotNull())
        .groupBy(F.col(feature).alias("feature"), F.col(value).cast("double").alias("x"))
        .agg(F.count_if(F.col(in_first)).alias("a"), F.count_if(~F.col(in_first)).alias("b"))
    )
    run = running_totals(counts, "x", ["a", "b"], by=["feature"])
    sizes = counts.groupBy("feature").agg(F.sum("a").alias("n1"), F.sum("b").alias("n2"))
    gap = F.abs(F.try_divide(F.col("a_to").cast("double"), F.col("n1")) - F.try_divide(F.col("b_to").cast("double"), F.col("n2")))
    out = run.join(F.broadcast(sizes), "feature").groupBy("feature").agg(
        F.max(gap).alias("ks_statistic"), F.max("n1").alias("n1"), F.max("n2").alias("n2")
    )
    return out.withColumn("ks_p", _ks_p("ks_statistic", "n1", "n2")).withColumn(
        "preserved", F.when(F.col("ks_p") > alpha, F.lit("Yes")).otherwise(F.lit("No"))
    )
