"""Running totals over a global order without a one-partition window.

Input rows are already one per distinct key (and group), so a value shared by a
third of all rows is a single row here. The key range is cut into buckets at
quantiles of the distinct keys; totals inside a bucket come from a window per
bucket, and the few bucket totals are accumulated on their own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F, types as T

from tabforge.session import cut_lineage

BUCKETS = 128
SMALL_KEYS = 50_000


def running_totals(
    counts: DataFrame,
    key: str,
    sums: Sequence[str],
    by: Sequence[str] = (),
    buckets: int = BUCKETS,
    descending: bool = False,
) -> DataFrame:
    """Add ``<s>_to`` (inclusive) and ``<s>_before`` (exclusive) for every summed column.

    ``by`` holds columns with few values (feature, class, fold): the bucket limits,
    at most ``buckets`` numbers per group, pass through the driver so that every
    retry of a task sees the same limits.
    """
    by = list(by)
    cuts = [i / buckets for i in range(1, buckets)]
    limits_df = counts.groupBy(*by).agg(
        F.percentile_approx(F.col(key).cast("double"), F.array(*[F.lit(c) for c in cuts]), F.lit(1000)).alias("limits"),
        F.count(F.lit(1)).alias("keys"),
    )
    limits = [r.asDict() for r in limits_df.collect()]
    for r in limits:
        r["limits"] = sorted(set(r["limits"] or []))
    if sum(r["keys"] for r in limits) <= SMALL_KEYS:
        # Proven small: one window per group, no bucket bookkeeping.
        return _running_small(counts, key, sums, by, descending)
    x = F.col(key).cast("double")
    if by:
        schema = T.StructType(
            [counts.schema[b] for b in by] + [T.StructField("_limits", T.ArrayType(T.DoubleType()))]
        )
        rows = [tuple(r[b] for b in by) + (r["limits"],) for r in limits]
        side = counts.sparkSession.createDataFrame(rows, schema)
        marked = _match(counts, side, by)
        limit_col = F.col("_limits")
    else:
        marked = counts
        limit_col = F.array(*[F.lit(v) for v in (limits[0]["limits"] if limits else [])]).cast("array<double>")
    marked = marked.withColumn("_bucket", F.size(F.filter(limit_col, lambda v: v < x))).drop("_limits")

    order = F.col(key).desc() if descending else F.col(key).asc()
    bucket_order = F.col("_bucket").desc() if descending else F.col("_bucket").asc()
    inner = Window.partitionBy(*by, "_bucket").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    totals = marked.groupBy(*by, "_bucket").agg(*[F.sum(s).alias(f"_t_{s}") for s in sums])
    before = Window.partitionBy(*by).orderBy(bucket_order).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *by, "_bucket", *[F.coalesce(F.sum(f"_t_{s}").over(before), F.lit(0)).alias(f"_o_{s}") for s in sums]
    )
    running = marked.select("*", *[F.sum(s).over(inner).alias(f"_r_{s}") for s in sums])
    joined = _match(running, offsets, [*by, "_bucket"])
    out = [F.col(c) for c in counts.columns]
    for s in sums:
        out.append((F.col(f"_r_{s}") + F.col(f"_o_{s}")).alias(f"{s}_to"))
        out.append((F.col(f"_r_{s}") + F.col(f"_o_{s}") - F.col(s)).alias(f"{s}_before"))
    return joined.select(*out)


def _match(left: DataFrame, small: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Attach a small per-group table; NULL is a group like any other."""
    renamed = small.withColumnsRenamed({k: f"_k_{k}" for k in keys})
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return left.join(F.broadcast(renamed), same).drop(*[f"_k_{k}" for k in keys])


def _running_small(counts: DataFrame, key: str, sums: Sequence[str], by: Sequence[str], descending: bool) -> DataFrame:
    order = F.col(key).desc() if descending else F.col(key).asc()
    w = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    out = counts.select("*", *[F.sum(s).over(w).alias(f"{s}_to") for s in sums])
    return out.select("*", *[(F.col(f"{s}_to") - F.col(s)).alias(f"{s}_before") for s in sums])


def global_positions(df: DataFrame, order: Sequence[str], out: str) -> DataFrame:
    """0-based position of every row in a total order, for keys of any type.

    One range-partitioned sort, kept by a checkpoint so that positions cannot change
    on a retry; only the row count per partition is accumulated centrally.
    """
    ordered = cut_lineage(df.orderBy(*order).withColumn("_id", F.monotonically_increasing_id()))
    part = F.shiftright("_id", 33)
    sizes = ordered.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    joined = ordered.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    position = F.col("_id") - F.shiftleft("_part", 33) + F.col("_offset")
    return joined.select(*df.columns, position.cast("long").alias(out))
