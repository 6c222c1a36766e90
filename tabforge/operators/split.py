"""Reproducible samples, splits and folds keyed by a row id.

Membership depends only on ``md5(id:seed)``, so a split is the same after any
repartitioning, on any cluster size and in SQL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from tabforge.functions.rng import uniform

RANK_BUCKETS = 1024


def random_split(df: DataFrame, row_id: str, train_share: float = 0.8, seed: int = 42, out: str = "is_train") -> DataFrame:
    return df.withColumn(out, uniform(row_id, seed) < F.lit(train_share))


def sample_fraction(df: DataFrame, row_id: str, fraction: float, seed: int = 42) -> DataFrame:
    """Samples of growing fraction with one seed are nested."""
    return df.where(uniform(row_id, seed) < F.lit(fraction))


def seeded_splits(df: DataFrame, row_id: str, seeds: Sequence[int], train_share: float = 0.8) -> DataFrame:
    """One copy of the rows per seed, each with its own split."""
    many = df.withColumn("seed", F.explode(F.array(*[F.lit(int(s)) for s in seeds])))
    return many.withColumn("is_train", uniform(row_id, F.col("seed")) < F.lit(train_share))


def kfold(df: DataFrame, row_id: str, k: int = 5, seed: int = 42, out: str = "fold") -> DataFrame:
    return df.withColumn(out, F.floor(uniform(row_id, seed) * k).cast("int"))


def hashed_rank(df: DataFrame, row_id: str, by: Sequence[str], seed: int = 42, buckets: int = RANK_BUCKETS) -> DataFrame:
    """1-based ``_rank`` and size ``_size`` of each row in its class, in hash order.

    The hash is uniform, so cutting each class into equal hash intervals gives
    windows of equal size even when one class holds most rows; the interval
    totals, ``buckets`` per class, are accumulated separately.
    """
    by = list(by)
    marked = df.withColumn("_u", uniform(row_id, seed)).withColumn("_b", F.floor(F.col("_u") * buckets).cast("int"))
    totals = marked.groupBy(*by, "_b").agg(F.count(F.lit(1)).alias("_n"))
    upto = Window.partitionBy(*by).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*by)
    offsets = totals.select(
        *[F.col(c).alias(f"_o_{c}") for c in by],
        F.col("_b").alias("_ob"),
        F.coalesce(F.sum("_n").over(upto), F.lit(0)).alias("_before"),
        F.sum("_n").over(whole).alias("_size"),
    )
    inner = Window.partitionBy(*by, "_b").orderBy("_u", row_id)
    ranked = marked.withColumn("_in", F.row_number().over(inner))
    # Null-safe, so rows without a class form a class of their own and are kept.
    same = F.col("_b") == F.col("_ob")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_o_{c}"))
    joined = ranked.join(offsets, same)
    return joined.select(*df.columns, (F.col("_in") + F.col("_before")).alias("_rank"), "_size")


def stratified_split(df: DataFrame, row_id: str, label: str, train_share: float = 0.8, seed: int = 42) -> DataFrame:
    """Exactly ``round(share * n_c)`` training rows in every class."""
    ranked = hashed_rank(df, row_id, [label], seed)
    return ranked.select(*df.columns, (F.col("_rank") <= F.round(F.col("_size") * F.lit(train_share))).alias("is_train"))


def stratified_kfold(df: DataFrame, row_id: str, label: str, k: int = 5, seed: int = 42) -> DataFrame:
    ranked = hashed_rank(df, row_id, [label], seed)
    return ranked.select(*df.columns, ((F.col("_rank") - 1) % k).cast("int").alias("fold"))
