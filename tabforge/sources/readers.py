"""Reading datasets, result tables, metadata and models."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tabforge.operators.clean import null_nan
from tabforge.sources.schemas import RUN_METADATA


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Header CSV under an explicit schema; empty text and NaN become NULL.

    Inference would read the data twice, so there is none.
    """
    return null_nan(spark.read.schema(schema).option("header", True).option("nanValue", "NaN").csv(path))


def read_stage(spark: SparkSession, path: str) -> DataFrame:
    """An intermediate table left by an earlier job."""
    return spark.read.parquet(path)


def read_runs(spark: SparkSession, path: str, experiments: list[str] | None = None) -> DataFrame:
    """Result tables, stored partitioned by experiment so that other runs are pruned."""
    runs = spark.read.parquet(path)
    return runs.where(F.col("experiment").isin(experiments)) if experiments else runs


def read_metadata(spark: SparkSession, path: str, one_document: bool = False) -> DataFrame:
    """Nested run metadata; no rows if nothing was stored yet.

    Tables are stored as JSON lines; ``one_document`` reads indented files instead.
    """
    try:
        return spark.read.schema(RUN_METADATA).option("multiLine", one_document).json(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], RUN_METADATA)


def metric_or(metadata: DataFrame, metric: str, default: float) -> DataFrame:
    """Largest stored value of a metric, or the default: always one row."""
    return metadata.agg(F.coalesce(F.max(F.try_element_at("metrics", F.lit(metric))), F.lit(default)).alias(metric))


def read_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def literal_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema)
