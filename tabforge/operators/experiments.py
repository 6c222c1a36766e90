"""Experiments: many fits, one predictions table, metrics in one grouped pass.

A run appends its predictions to a table under the run's name. Metrics of all runs
are then computed together, so the number of metric jobs does not grow with the
number of runs, and a repeated experiment can skip what is stored.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from tabforge.operators.encode import ColumnScaler
from tabforge.operators.metrics import binary_metrics, regression_metrics, roc_auc
from tabforge.operators.models import assemble
from tabforge.session import scratch_path

RUN_SCHEMA = "run string, model string, scaler string, training_time_s double, error string"


def fold_stats(per_fold: DataFrame, metrics: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Mean, population and sample deviation of metrics over folds or seeds."""
    aggs = []
    for m in metrics:
        aggs += [F.avg(m).alias(f"{m}_mean"), F.stddev_pop(m).alias(f"{m}_std"), F.stddev_samp(m).alias(f"{m}_std_samp")]
    return per_fold.groupBy(*by).agg(*aggs)


def cross_validated_metrics(predictions: DataFrame, fold: str = "fold", by: Sequence[str] = ()) -> DataFrame:
    """Five metrics per fold from given predictions, then mean and deviation over folds."""
    keys = [*by, fold]
    per = binary_metrics(predictions, by=keys).join(roc_auc(predictions, by=keys).select(*keys, "auc"), keys)
    return fold_stats(per, ["auc", "accuracy", "precision", "recall", "f1_score"], by)


def with_score(df: DataFrame) -> DataFrame:
    """``score`` from whatever the model offers: P(class 1), the margin, or nothing."""
    if "probability" in df.columns:
        return df.withColumn("score", F.get(vector_to_array("probability"), F.lit(1)))
    if "rawPrediction" in df.columns:
        return df.withColumn("score", F.get(vector_to_array("rawPrediction"), F.lit(1)))
    if "probabilities" in df.columns:
        return df.withColumn("score", F.get("probabilities", F.lit(1)))
    return df if "score" in df.columns else df.withColumn("score", F.lit(None).cast("double"))


class Experiment:
    """Collects predictions of many runs and turns them into a leaderboard."""

    def __init__(self, spark, row_id: str = "row_id", label: str = "label", parallel: int = 4):
        self.spark, self.row_id, self.label, self.parallel = spark, row_id, label, parallel
        self.path = scratch_path(spark, "predictions")
        self.records: list[tuple] = []
        self.stored: list[str] = []

    def run(self, name: str, model: str, scaler: str, make: Callable[[], DataFrame]) -> None:
        """Execute one run; ``make`` returns predictions. A failing run is recorded and skipped."""
        start = time.perf_counter()
        try:
            out = with_score(make()).select(
                F.lit(name).alias("run"),
                self.row_id,
                F.col(self.label).cast("double").alias("label"),
                F.col("prediction").cast("double").alias("prediction"),
                F.col("score").cast("double").alias("score"),
            )
            # A folder per run: jobs that append to one folder would clear each other's work.
            target = f"{self.path}/{uuid.uuid4().hex}"
            out.write.parquet(target)
            self.stored.append(target)
            self.records.append((name, model, scaler, time.perf_counter() - start, None))
        except Exception as e:  # noqa: BLE001 - the failure is the result
            self.records.append((name, model, scaler, time.perf_counter() - start, str(e)[:200]))

    def run_all(self, tasks: Sequence[tuple[str, str, str, Callable[[], DataFrame]]]) -> None:
        """Runs side by side; each is a Spark job, so the cluster stays busy between stages."""
        with ThreadPoolExecutor(self.parallel) as pool:
            list(pool.map(lambda t: self.run(*t), tasks))

    def predictions(self) -> DataFrame:
        schema = f"run string, {self.row_id} long, label double, prediction double, score double"
        if not self.stored:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*self.stored)

    def runs(self) -> DataFrame:
        return self.spark.createDataFrame(sorted(self.records), RUN_SCHEMA)

    def leaderboard(self) -> DataFrame:
        """Classification metrics per run; failed runs keep their error."""
        p = self.predictions()
        metrics = binary_metrics(p, by=["run"]).select("run", "accuracy", "precision", "recall", "f1_score")
        auc = roc_auc(p, by=["run"]).select("run", F.col("auc").alias("roc_auc"))
        return self.runs().join(metrics, "run", "left").join(auc, "run", "left").orderBy(F.col("roc_auc").desc_nulls_last(), "run")

    def regression_board(self) -> DataFrame:
        m = regression_metrics(self.predictions(), by=["run"])
        return self.runs().join(m, "run", "left").orderBy("mae", "run")


def scaled_pair(train: DataFrame, test: DataFrame, columns: Sequence[str], kind: str) -> tuple[DataFrame, DataFrame]:
    """Scaler fitted on the training rows only, features assembled."""
    model = ColumnScaler(inputCols=list(columns), kind=kind).fit(train)
    return assemble(model.transform(train), columns), assemble(model.transform(test), columns)


def model_scaler_matrix(
    train: DataFrame, test: DataFrame, columns: Sequence[str], label: str, models: dict[str, Callable], scalers: Sequence[str], row_id: str = "row_id"
) -> DataFrame:
    """Every model with every scaler. ``models``: name -> function(train) giving an estimator."""
    exp = Experiment(train.sparkSession, row_id, label)
    tasks, kept = [], []
    for kind in scalers:
        a, b = scaled_pair(train, test, columns, kind)
        kept.append(a.cache())
        for name, build in models.items():
            tasks.append((f"{name}|{kind}", name, kind, lambda a=a, b=b, build=build: build(a).fit(a).transform(b)))
    exp.run_all(tasks)
    for a in kept:
        a.unpersist()
    return exp.leaderboard()


def cross_validate(df: DataFrame, make: Callable[[DataFrame, DataFrame], DataFrame], row_id: str, label: str, k: int, fold: str = "fold") -> DataFrame:
    """Out-of-fold predictions -> five metrics with deviation. ``make(train, test)`` fits and
    predicts inside the fold, so preprocessing never sees the held-out rows."""
    exp = Experiment(df.sparkSession, row_id, label)
    exp.run_all(
        [
            (str(i), "cv", "", lambda i=i: make(df.where(F.col(fold) != i), df.where(F.col(fold) == i)))
            for i in range(k)
        ]
    )
    failed = [r[4] for r in exp.records if r[4]]
    if failed:
        raise RuntimeError(failed[0])
    return cross_validated_metrics(exp.predictions().withColumnRenamed("run", "fold"))


def against_first(board: DataFrame, metric: str, baseline_run: str) -> DataFrame:
    """Percent by which each run is better than the baseline on an error metric."""
    base = board.where(F.col("run") == baseline_run).agg(F.max(metric)).scalar()
    return board.withColumn("better_pct", (base - F.col(metric)) / base * 100.0)


class MeanR2Evaluator:
    """Mean R2 over several targets, for grids over multi-target models."""

    def __init__(self, targets: dict[str, tuple[str, str]]):
        self.targets = targets

    def evaluate(self, df: DataFrame) -> float:
        aggs = []
        for i, (y, p) in enumerate(self.targets.values()):
            e = F.col(y).cast("double") - F.col(p)
            aggs.append((F.lit(1.0) - F.avg(e * e) / F.var_pop(F.col(y).cast("double"))).alias(f"r{i}"))
        row = df.agg(*aggs).first()
        return sum(row) / len(row)
