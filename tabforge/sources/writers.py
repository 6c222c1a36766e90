"""Writing result tables, datasets, metadata, strategies and models."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

# Report headers of exported tables, by internal column name.
EXPORT_HEADERS = {
    "r2_score": "R²",
    "mae": "MAE",
    "rmse": "RMSE",
    "bias": "Bias",
    "feature": "Feature",
    "missing_count": "Missing_Count",
    "missing_pct": "Missing_Pct",
    "mean_change_pct": "Mean_Change_Pct",
    "std_change_pct": "Std_Change_Pct",
    "ks_statistic": "KS_Statistic",
    "ks_p": "KS_PValue",
    "preserved": "Distribution_Preserved",
    "strategy": "Strategy",
    "avg_mean_change_pct": "Avg_Mean_Change_%",
    "avg_std_change_pct": "Avg_Std_Change_%",
    "max_mean_change_pct": "Max_Mean_Change_%",
}


def write_csv(df: DataFrame, path: str, report_headers: bool = False) -> None:
    out = df.withColumnsRenamed({k: v for k, v in EXPORT_HEADERS.items() if k in df.columns}) if report_headers else df
    out.write.mode("overwrite").option("header", True).csv(path)


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def append_runs(df: DataFrame, path: str, experiment: str) -> None:
    """Store a leaderboard as one partition; storing it again replaces only that partition."""
    (
        df.withColumn("experiment", F.lit(experiment))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("experiment")
        .parquet(path)
    )


def write_metadata(df: DataFrame, path: str) -> None:
    """Nested metadata rows as JSON lines."""
    df.write.mode("overwrite").json(path)


def write_strategy(spark: SparkSession, strategy: dict[str, str], path: str) -> None:
    rows = sorted(strategy.items())
    spark.createDataFrame(rows, "feature string, method string").write.mode("overwrite").parquet(path)


def read_strategy(spark: SparkSession, path: str) -> dict[str, str]:
    return {r["feature"]: r["method"] for r in spark.read.parquet(path).collect()}


def write_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)
