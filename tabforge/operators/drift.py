"""How much an imputation distorts the data.

Input is a wide table with the original column ``c`` (with NULL) and a filled copy
``c__method``; every report is one scan over it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tabforge.functions.moments import correlation
from tabforge.functions.scalar import pct_change, quality_grade
from tabforge.operators.profile import long_rows, quoted
from tabforge.operators.quantiles import exact_quantiles
from tabforge.operators.stats import ks_two_sample


def _pair(c: str, method: str):
    return F.col(quoted(c)).cast("double"), F.col(quoted(f"{c}__{method}")).cast("double")


def drift(wide: DataFrame, columns: Sequence[str], method: str) -> DataFrame:
    """|change| of mean and deviation in percent, per feature with gaps."""
    aggs = []
    for i, c in enumerate(columns):
        before, after = _pair(c, method)
        aggs += [
            F.count_if(before.isNull()).alias(f"{i}_gaps"),
            F.avg(before).alias(f"{i}_m0"),
            F.avg(after).alias(f"{i}_m1"),
            F.stddev_samp(before).alias(f"{i}_s0"),
            F.stddev_samp(after).alias(f"{i}_s1"),
        ]
    rows = long_rows(wide.agg(*aggs), columns, {"gaps": "gaps", "m0": "m0", "m1": "m1", "s0": "s0", "s1": "s1"})
    return rows.where("gaps > 0").select(
        "feature",
        "gaps",
        pct_change("m1", "m0").alias("mean_change_pct"),
        pct_change("s1", "s0").alias("std_change_pct"),
    )


def drift_summary(per_feature: DataFrame) -> DataFrame:
    return per_feature.agg(
        F.avg("mean_change_pct").alias("avg_mean_change_pct"),
        F.avg("std_change_pct").alias("avg_std_change_pct"),
        F.max("mean_change_pct").alias("max_mean_change_pct"),
    )


def evaluate_imputation(df: DataFrame, imputer, columns: Sequence[str], name: str) -> DataFrame:
    """Fit any imputer with ``add_filled`` and return its drift summary under a name."""
    wide = imputer.fit(df).add_filled(df, "new")
    return drift_summary(drift(wide, columns, "new")).select(F.lit(name).alias("strategy"), "*")


def rank_strategies(df: DataFrame, imputers: dict[str, object], columns: Sequence[str], good_below: float = 2.0) -> DataFrame:
    """Drift of several imputers, smallest average mean change first."""
    out = None
    for name, imputer in imputers.items():
        part = evaluate_imputation(df, imputer, columns, name)
        out = part if out is None else out.unionByName(part)
    return out.withColumn("meets_goal", (F.col("avg_mean_change_pct") < good_below).cast("int")).orderBy("avg_mean_change_pct", "strategy")


def imputation_profile(wide: DataFrame, columns: Sequence[str], method: str) -> DataFrame:
    """Original, all-after and imputed-only statistics per feature (20 columns)."""
    exprs = {}
    for c in columns:
        before, after = _pair(c, method)
        exprs[f"{c}|o"], exprs[f"{c}|a"] = before, after
        exprs[f"{c}|i"] = F.when(before.isNull(), after)
    medians = exact_quantiles(wide, exprs, [0.5])
    aggs = [F.count(F.lit(1)).alias("total")]
    for i, c in enumerate(columns):
        for tag in "oai":
            x = exprs[f"{c}|{tag}"]
            aggs += [F.avg(x).alias(f"{i}_{tag}mean"), F.stddev_samp(x).alias(f"{i}_{tag}std")]
            if tag != "i":
                aggs += [F.min(x).alias(f"{i}_{tag}min"), F.max(x).alias(f"{i}_{tag}max")]
        aggs.append(F.count_if(exprs[f"{c}|o"].isNull()).alias(f"{i}_gaps"))
    one = wide.agg(*aggs)
    for i, c in enumerate(columns):
        for tag in "oai":
            one = one.withColumn(f"{i}_{tag}med", F.lit(medians[f"{c}|{tag}"][0]).cast("double"))
    fields = {"missing_count": "gaps"}
    for tag, name in (("o", "original"), ("a", "imputed")):
        fields.update({f"{name}_{s}": f"{tag}{k}" for s, k in (("mean", "mean"), ("median", "med"), ("std", "std"), ("min", "min"), ("max", "max"))})
    fields.update({"imputedvals_mean": "imean", "imputedvals_median": "imed", "imputedvals_std": "istd"})
    out = long_rows(one, columns, fields)
    mean_change = F.col("imputed_mean") - F.col("original_mean")
    std_change = F.col("imputed_std") - F.col("original_std")
    return out.select(
        "feature",
        "missing_count",
        (F.col("missing_count") * 100.0 / F.col("total")).alias("missing_pct"),
        *list(fields)[1:],
        mean_change.alias("mean_change"),
        pct_change("imputed_mean", "original_mean", on_zero="zero", signed=True).alias("mean_change_pct"),
        std_change.alias("std_change"),
        pct_change("imputed_std", "original_std", on_zero="zero", signed=True).alias("std_change_pct"),
    )


def imputation_ks(wide: DataFrame, columns: Sequence[str], method: str) -> DataFrame:
    """Two-sample KS of the observed against the imputed-only values, per feature."""
    arms = F.array(
        *[
            F.struct(F.lit(c).alias("feature"), _pair(c, method)[1].alias("value"), _pair(c, method)[0].isNotNull().alias("observed"))
            for c in columns
        ]
    )
    long = wide.select(F.explode(arms).alias("r")).select("r.*")
    return ks_two_sample(long, "feature", "value", "observed")


def grade(profile: DataFrame, ks: DataFrame) -> DataFrame:
    """Overall grade from the average |mean change| and the share of preserved features."""
    p = profile.where("missing_count > 0").agg(
        F.avg(F.abs("mean_change_pct")).alias("avg_mean_change_pct"), F.avg(F.abs("std_change_pct")).alias("avg_std_change_pct")
    )
    share = ks.agg(F.avg((F.col("preserved") == "Yes").cast("double")).alias("s")).scalar()
    verdict = (
        F.when((F.col("avg_mean_change_pct") < 5) & (share > 0.8), "preserved")
        .when(F.col("avg_mean_change_pct") < 10, "acceptable")
        .otherwise("review")
    )
    return p.select("*", quality_grade("avg_mean_change_pct").alias("grade"), share.alias("preserved_share"), verdict.alias("verdict"))


def band_counts(per_feature: DataFrame, column: str = "mean_change_pct") -> DataFrame:
    x = F.abs(column)
    return per_feature.agg(
        F.count_if(x < 5).alias("below_5"), F.count_if((x >= 5) & (x < 10)).alias("from_5_to_10"), F.count_if(x >= 10).alias("from_10")
    )


def method_difference(wide: DataFrame, columns: Sequence[str], first: str, second: str) -> DataFrame:
    """Difference of two fillings on the imputed cells only, also relative to the observed mean."""
    aggs = []
    for i, c in enumerate(columns):
        before, a = _pair(c, first)
        gap = F.when(before.isNull(), F.abs(a - _pair(c, second)[1]))
        aggs += [F.avg(gap).alias(f"{i}_d"), F.max(gap).alias(f"{i}_x"), F.avg(before).alias(f"{i}_m"), F.count(gap).alias(f"{i}_n")]
    out = long_rows(wide.agg(*aggs), columns, {"cells": "n", "mean_abs_diff": "d", "max_abs_diff": "x", "observed_mean": "m"})
    return out.where("cells > 0").select(
        "feature", "cells", "mean_abs_diff", "max_abs_diff",
        (F.try_divide(F.col("mean_abs_diff"), F.abs("observed_mean")) * 100.0).alias("relative_pct"),
    )


def correlation_shift(wide: DataFrame, columns: Sequence[str], label: str, first: str, second: str) -> DataFrame:
    y = F.col(label).cast("double")
    aggs = []
    for i, c in enumerate(columns):
        aggs += [correlation(_pair(c, first)[1], y).alias(f"{i}_a"), correlation(_pair(c, second)[1], y).alias(f"{i}_b")]
    out = long_rows(wide.agg(*aggs), columns, {"corr_first": "a", "corr_second": "b"})
    return out.withColumn("shift", F.col("corr_second") - F.col("corr_first"))


def category_shift(df: DataFrame, column: str, filled: str) -> DataFrame:
    """Share of every category before, after, and among the imputed rows: one grouped pass."""
    before, after = F.col(quoted(column)), F.col(quoted(filled))
    counts = df.groupBy(after.alias("category")).agg(
        F.count(before).alias("n_before"), F.count(F.lit(1)).alias("n_after"), F.count_if(before.isNull()).alias("n_imputed")
    )
    t = counts.agg(F.sum("n_before").alias("b"), F.sum("n_after").alias("a"), F.sum("n_imputed").alias("i"))
    s = t.select(F.struct("*").alias("t")).scalar()
    return counts.select(
        "category",
        (F.col("n_before") * 100.0 / s["b"]).alias("before_pct"),
        (F.col("n_after") * 100.0 / s["a"]).alias("after_pct"),
        F.try_divide(F.col("n_imputed") * 100.0, s["i"]).alias("imputed_pct"),
    )
