"""Column profiles: each report is one aggregate pass, turned into long rows."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tabforge.functions.moments import correlation, kurtosis_unbiased, skew_unbiased
from tabforge.operators.quantiles import exact_quantiles

_NUMERIC = (T.DoubleType, T.FloatType, T.IntegerType, T.LongType, T.ShortType, T.ByteType, T.DecimalType)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, _NUMERIC)]


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def quoted(name: str) -> str:
    return f"`{name}`"


def long_rows(wide: DataFrame, features: Sequence[str], fields: dict[str, str], key: str = "feature") -> DataFrame:
    """One-row aggregate -> one row per feature; field source names are ``<feature index>_<suffix>``."""
    structs = [
        F.struct(F.lit(f).alias(key), *[F.col(f"{i}_{suffix}").alias(out) for out, suffix in fields.items()])
        for i, f in enumerate(features)
    ]
    keep = [c for c in wide.columns if not c[0].isdigit()]
    return wide.select(*keep, F.explode(F.array(*structs)).alias("r")).select(*keep, "r.*")


def describe(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """count, mean, std, min, quartiles, max per numeric column; quartiles exact."""
    cols = list(columns or numeric_columns(df))
    quartiles = exact_quantiles(df, {c: F.col(quoted(c)) for c in cols}, [0.25, 0.5, 0.75])
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(quoted(c)).cast("double")
        aggs += [
            F.count(x).alias(f"{i}_n"),
            F.avg(x).alias(f"{i}_mean"),
            F.stddev_samp(x).alias(f"{i}_std"),
            F.min(x).alias(f"{i}_min"),
            F.max(x).alias(f"{i}_max"),
        ]
    wide = df.agg(*aggs)
    for i, c in enumerate(cols):
        for j, name in enumerate(("q25", "q50", "q75")):
            wide = wide.withColumn(f"{i}_{name}", F.lit(quartiles[c][j]).cast("double"))
    fields = {"n": "n", "mean": "mean", "std": "std", "min": "min", "q25": "q25", "q50": "q50", "q75": "q75", "max": "max"}
    return long_rows(wide, cols, fields)


def target_profile(df: DataFrame, target: str) -> DataFrame:
    x = F.col(quoted(target)).cast("double")
    median = exact_quantiles(df, {target: x}, [0.5])[target][0]
    return df.agg(
        F.avg(x).alias("mean"),
        F.lit(median).alias("median"),
        F.stddev_samp(x).alias("std"),
        F.min(x).alias("min"),
        F.max(x).alias("max"),
        (F.max(x) - F.min(x)).alias("range"),
        skew_unbiased(x).alias("skew"),
        kurtosis_unbiased(x).alias("kurtosis"),
    )


def missing_report(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """NULL count and percent per column, in one scan."""
    cols = list(columns or df.columns)
    wide = df.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(F.col(quoted(c)).isNull()).alias(f"{i}_m") for i, c in enumerate(cols)],
    )
    return long_rows(wide, cols, {"missing": "m"}).select(
        "feature", "missing", (F.col("missing") * 100.0 / F.col("total")).alias("missing_pct"), "total"
    )


def missing_by_class(df: DataFrame, label: str, columns: Sequence[str]) -> DataFrame:
    cells = sum((F.col(quoted(c)).isNull().cast("long") for c in columns), F.lit(0))
    return df.groupBy(label).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(cells).alias("missing_cells"),
        (F.sum(cells) * 100.0 / (F.count(F.lit(1)) * len(columns))).alias("missing_pct"),
    )


def value_counts(df: DataFrame, column: str, dropna: bool = True) -> DataFrame:
    """Class counts and shares; the total is a second level over the counted rows."""
    src = df.where(F.col(quoted(column)).isNotNull()) if dropna else df
    counts = src.groupBy(F.col(quoted(column)).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("t")).scalar()
    return counts.withColumn("share", F.col("n") / total)


def distinct_values(df: DataFrame, columns: Sequence[str], list_up_to: int = 30) -> DataFrame:
    """Distinct count per column and the sorted values where there are few.

    A first sketch pass decides which columns are small, so the exact list of a
    wide column is never gathered.
    """
    sketch = df.agg(*[F.approx_count_distinct(quoted(c)).alias(f"d{i}") for i, c in enumerate(columns)]).first()
    small = {i for i in range(len(columns)) if sketch[f"d{i}"] <= 4 * list_up_to}
    pairs = F.explode(
        F.array(*[F.struct(F.lit(c).alias("feature"), F.col(quoted(c)).cast("string").alias("v")) for c in columns])
    )
    distinct = df.select(pairs.alias("p")).select("p.*").where(F.col("v").isNotNull()).distinct()
    small_names = [columns[i] for i in sorted(small)]
    listed = F.collect_list(F.when(F.col("feature").isin(small_names), F.col("v")))
    out = distinct.groupBy("feature").agg(F.count("v").alias("n_distinct"), F.array_sort(listed).alias("vals"))
    return out.select(
        "feature",
        "n_distinct",
        F.when(F.col("n_distinct") <= list_up_to, F.concat_ws("|", "vals")).alias("listed"),
    )


def class_balance(df: DataFrame, label: str, threshold: float = 1.5) -> DataFrame:
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(F.max("n").alias("largest"), F.min("n").alias("smallest")).select(
        "largest",
        "smallest",
        (F.col("largest") / F.col("smallest")).alias("ratio"),
        (F.col("largest") / F.col("smallest") > threshold).cast("int").alias("imbalanced"),
    )


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weight n / (k * n_c) per class; rows without a label are no class and are not counted."""
    counts = df.where(F.col(label).isNotNull()).groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg((F.sum("n") / F.count(F.lit(1))).alias("t")).scalar()
    return counts.withColumn("weight", total / F.col("n"))


def with_class_weights(df: DataFrame, label: str, weight: str = "weight") -> DataFrame:
    """Attach balanced weights; the weight table has one row per class. A row without a label stays, without a weight."""
    weights = class_weights(df, label).select(F.col("label").alias(label), F.col("weight").alias(weight))
    return df.join(F.broadcast(weights), label, "left")


def correlation_pairs(df: DataFrame, columns: Sequence[str], chunk: int = 150) -> DataFrame:
    """Upper-triangle Pearson matrix, pairwise complete, in one scan per ``chunk`` pairs."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :]]
    out = None
    for start in range(0, len(pairs), chunk):
        part = pairs[start : start + chunk]
        wide = df.agg(
            *[
                correlation(F.col(quoted(a)), F.col(quoted(b))).alias(f"{i}_r")
                for i, (a, b) in enumerate(part)
            ]
        )
        structs = [
            F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"{i}_r").alias("r")) for i, (a, b) in enumerate(part)
        ]
        rows = wide.select(F.explode(F.array(*structs)).alias("p")).select("p.*")
        out = rows if out is None else out.unionByName(rows)
    return out


def correlation_with(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """r of every column with the target over the rows where both exist, and that row count."""
    y = F.col(quoted(target)).cast("double")
    aggs = []
    for i, c in enumerate(columns):
        x = F.col(quoted(c)).cast("double")
        aggs += [correlation(x, y).alias(f"{i}_r"), F.count_if(x.isNotNull() & y.isNotNull()).alias(f"{i}_n")]
    return long_rows(df.agg(*aggs), columns, {"r": "r", "n": "n"})


def class_means(df: DataFrame, columns: Sequence[str], label: str) -> DataFrame:
    aggs = []
    for i, c in enumerate(columns):
        x = F.col(quoted(c)).cast("double")
        aggs += [
            F.avg(F.when(F.col(label) == 0, x)).alias(f"{i}_m0"),
            F.avg(F.when(F.col(label) == 1, x)).alias(f"{i}_m1"),
        ]
    out = long_rows(df.agg(*aggs), columns, {"mean_negative": "m0", "mean_positive": "m1"})
    return out.withColumn("diff_means", F.col("mean_positive") - F.col("mean_negative"))


def box_stats(df: DataFrame, column: str, label: str, classes: Sequence) -> DataFrame:
    """Quartiles, mean and 1.5*IQR whiskers of a column per class."""
    x = F.col(quoted(column)).cast("double")
    exprs = {str(c): F.when(F.col(label) == F.lit(c), x) for c in classes}
    quart = exact_quantiles(df, exprs, [0.25, 0.5, 0.75])
    aggs = []
    for i, c in enumerate(classes):
        q1, _, q3 = quart[str(c)]
        lo, hi = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        inside = F.when(exprs[str(c)].between(lo, hi), x)
        aggs += [
            F.min(inside).alias(f"{i}_lo"),
            F.max(inside).alias(f"{i}_hi"),
            F.avg(exprs[str(c)]).alias(f"{i}_mean"),
        ]
    wide = df.agg(*aggs)
    for i, c in enumerate(classes):
        for name, v in zip(("q1", "med", "q3"), quart[str(c)]):
            wide = wide.withColumn(f"{i}_{name}", F.lit(v))
    fields = {"q1": "q1", "median": "med", "q3": "q3", "whisker_low": "lo", "whisker_high": "hi", "mean": "mean"}
    return long_rows(wide, [str(c) for c in classes], fields, key="class")


def histogram(df: DataFrame, column: str, bins: int = 30) -> DataFrame:
    """Equal-width bins between min and max; the top edge belongs to the last bin."""
    x = F.col(quoted(column)).cast("double")
    edges = df.agg(F.min(x).alias("lo"), F.max(x).alias("hi")).select(F.struct("*").alias("s")).scalar()
    lo, width = edges["lo"], (edges["hi"] - edges["lo"]) / float(bins)
    bin_no = F.least(F.lit(bins - 1), F.floor((x - lo) / width)).cast("int")
    return df.where(x.isNotNull()).groupBy(bin_no.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def density(df: DataFrame, column: str, label: str, grid: int = 64, bins: int = 512) -> DataFrame:
    """Gaussian density per class on a grid, from a fine histogram instead of the rows.

    Bandwidth is Scott's rule on the class's sample deviation.
    """
    x = F.col(quoted(column)).cast("double")
    src = df.where(x.isNotNull()).select(F.col(label).alias("class"), x.alias("x"))
    edges = src.agg(F.min("x").alias("lo"), F.max("x").alias("hi")).select(F.struct("*").alias("s")).scalar()
    lo, hi = edges["lo"], edges["hi"]
    width = (hi - lo) / float(bins)
    binned = src.groupBy("class", F.least(F.lit(bins - 1), F.floor((F.col("x") - lo) / width)).alias("bin")).agg(
        F.count(F.lit(1)).alias("n")
    )
    spread = src.groupBy("class").agg(
        F.count(F.lit(1)).alias("total"),
        (F.stddev_samp("x") * F.pow(F.count(F.lit(1)).cast("double"), F.lit(-0.2))).alias("h"),
    )
    points = binned.join(F.broadcast(spread), "class").select(
        "class",
        "n",
        "total",
        "h",
        (lo + (F.col("bin") + 0.5) * width).alias("centre"),
        F.explode(F.sequence(F.lit(0), F.lit(grid - 1))).alias("grid_no"),
    )
    at = lo + F.col("grid_no") * (hi - lo) / float(grid - 1)
    z = (at - F.col("centre")) / F.col("h")
    kernel = F.col("n") * F.exp(-0.5 * z * z)
    return points.groupBy("class", "grid_no").agg(
        (F.sum(kernel / (F.col("total") * F.col("h"))) / math.sqrt(2.0 * math.pi)).alias("density")
    )
