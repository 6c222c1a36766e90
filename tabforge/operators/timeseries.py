"""Lag and trailing means per series, safe for a series that holds most rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

DAY = 86_400_000_000


def lag_and_trailing_means(
    df: DataFrame, series: str, time_us: Column, order: str, value: str, spans_us: dict[str, int], slot_us: int = DAY
) -> DataFrame:
    """Add ``lag1`` and one trailing mean per span (name -> microseconds).

    A series is cut into time slots so that no window holds a whole series. For the
    means a row is also sent to the next slot when it can still count there; the
    lag of a slot's first row is the last value of the slot before.
    """
    longest = max(spans_us.values())
    if longest > slot_us:
        raise ValueError("a span must fit into one slot")
    base = df.withColumn("_t", time_us).withColumn("_slot", F.floor(F.col("_t") / F.lit(slot_us)))
    reaches = (F.col("_slot") + 1) * F.lit(slot_us) - F.col("_t") <= F.lit(longest)
    slots = F.when(reaches, F.array(F.col("_slot"), F.col("_slot") + 1)).otherwise(F.array(F.col("_slot")))
    spread = base.withColumn("_in", F.explode(slots))
    one = Window.partitionBy(series, "_in")
    means = {
        name: F.avg(value).over(one.orderBy("_t").rangeBetween(-span, 0)) for name, span in spans_us.items()
    }
    previous = F.lag(value).over(one.orderBy("_t", order))
    own_first = F.row_number().over(Window.partitionBy(series, "_in", F.col("_in") == F.col("_slot")).orderBy("_t", order))
    local = spread.withColumns({**means, "_lag": previous, "_first": own_first}).where(F.col("_in") == F.col("_slot"))
    last = base.groupBy(series, "_slot").agg(F.max(F.struct("_t", order, value)).alias("_last"))
    carried = last.select(
        F.col(series).alias("_c_series"),
        F.col("_slot").alias("_c_slot"),
        F.lag(F.col(f"_last.{value}")).over(Window.partitionBy(series).orderBy("_slot")).alias("_carry"),
    )
    joined = local.join(carried, (F.col("_slot") == F.col("_c_slot")) & F.col(series).eqNullSafe(F.col("_c_series")), "left")
    lag1 = F.when(F.col("_first") == 1, F.col("_carry")).otherwise(F.col("_lag"))
    keep: Sequence[str] = df.columns
    return joined.select(*keep, lag1.alias("lag1"), *spans_us)
