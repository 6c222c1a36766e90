"""Structured Streaming jobs: continuous scoring and a drift monitor."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tabforge.operators.serve import score_table


def file_stream(spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def score_stream(
    model: PipelineModel, arriving: DataFrame, required: Sequence[str], keep: Sequence[str], out_path: str, checkpoint: str
):
    """Score whatever has arrived and stop; started again it goes on from its checkpoint.

    Stateless, so it scales with the input partitions; the file sink makes every row
    appear exactly once.
    """
    scored = score_table(model, arriving, required, keep)
    return (
        scored.writeStream.format("parquet")
        .option("path", out_path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def drift_windows(arriving: DataFrame, time: str, value: str, window: str = "1 hour", lateness: str = "10 minutes") -> DataFrame:
    """Count, mean and deviation of a feature per event-time window, late rows bounded by a watermark."""
    timed = arriving.withColumn(time, F.col(time).cast("timestamp"))
    return (
        timed.withWatermark(time, lateness)
        .groupBy(F.window(time, window).alias("w"))
        .agg(F.count(F.lit(1)).alias("n"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"))
        .select(F.col("w.start").alias("window_start"), "n", "mean", "std")
    )
