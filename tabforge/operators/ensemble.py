"""Combining predictions: votes, averages, bias correction, stacking."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace

from pyspark.ml import Model
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from tabforge.operators import models
from tabforge.operators.boosting import CELLS, Boosting, bin_limits, fit_many
from tabforge.operators.forests import Forest, fit_forests, fits_cells
from tabforge.session import SMALL_PARTITIONS, cut_lineage, step_partitions

#: Fits that run at a time; each leaves cores idle between its jobs.
PARALLEL = 6


def hard_vote(votes: Sequence[Column], classes: Sequence) -> Column:
    """Most voted class; a tie goes to the earlier class."""
    counts = F.array(*[sum(((v == F.lit(c)).cast("int") for v in votes), F.lit(0)) for c in classes])
    return F.element_at(F.array(*[F.lit(c) for c in classes]), F.array_position(counts, F.array_max(counts)).cast("int"))


def soft_vote(probabilities: Sequence[Column], weights: Sequence[float] | None = None) -> Column:
    """Weighted mean of probability arrays."""
    w = list(weights) if weights else [1.0] * len(probabilities)
    total = float(sum(w))

    def plus(out: Column, extra: Column, share: float) -> Column:
        return F.zip_with(out, extra, lambda a, b: a + b * share)

    out = F.transform(probabilities[0], lambda p: p * w[0])
    for extra, share in zip(probabilities[1:], w[1:]):
        out = plus(out, extra, share)
    return F.transform(out, lambda p: p / total)


def arg_max_class(probabilities: Column) -> Column:
    """Position of the first largest probability."""
    return (F.array_position(probabilities, F.array_max(probabilities)) - 1).cast("int")


def mean_prediction(columns: Sequence[str]) -> Column:
    return sum((F.col(c) for c in columns), F.lit(0.0)) / len(columns)


def bias_corrected(train: DataFrame, test: DataFrame, label: str, pred: str) -> DataFrame:
    """Subtract the mean training residual (prediction minus truth) from test predictions."""
    bias = train.agg(F.avg(F.col(pred) - F.col(label))).scalar()
    return test.withColumn(pred, F.col(pred) - bias)


# ---- stacking --------------------------------------------------------------


def _probability(df: DataFrame, name: str) -> DataFrame:
    """The base's output as one column: P(class 1), or the prediction of a regressor."""
    if "probability" in df.columns:
        value = F.get(vector_to_array("probability"), F.lit(1))
    else:
        value = F.col("prediction")
    return df.withColumn(name, value).drop("probability", "rawPrediction", "prediction")


def fit_side_by_side(tasks: dict, parallel: int = PARALLEL) -> dict:
    """{name: result} of functions without arguments, run from several driver threads."""
    with ThreadPoolExecutor(max(1, min(parallel, len(tasks)))) as pool:
        return dict(zip(tasks, pool.map(lambda make: make(), tasks.values())))


def fit_forest_batch(df: DataFrame, specs: dict, features: Sequence[str], row_id: str) -> dict:
    """{name: model} of ``Forest`` specs: together from sums by cell, or as MLlib forests where the bins make too many cells."""
    limits = bin_limits(df, features)
    if fits_cells(limits):
        return fit_forests(df, specs, features, row_id, limits=limits)
    return fit_side_by_side({n: lambda s=s: _mllib_forest(s, len(features)).fit(df.where(s.rows) if s.rows else df) for n, s in specs.items()})


def _mllib_forest(s: Forest, width: int):
    """Nearest MLlib forest: it has no random cuts."""
    tries = "all" if s.tries >= 1.0 else str(max(1, round(s.tries * width)))
    extra = {"weightCol": s.weight} if s.weight else {}
    return models.forest(s.label, s.trees, s.max_depth, not s.classes, minInstancesPerNode=s.least, bootstrap=s.bootstrap, featureSubsetStrategy=tries, **extra)


def _fit_tabulated(df: DataFrame, specs: dict, features: Sequence[str], row_id: str) -> dict:
    """``fit_many``, with margins by cell where more rows than cells will be scored."""
    fitted = fit_many(df, specs, features, row_id)
    return {n: m.tabulated() for n, m in fitted.items()} if df.count() > CELLS else fitted


def fit_bases(df: DataFrame, bases: dict[str, object], row_id: str, fold: str, k: int, features: Sequence[str] = (), whole: bool = True) -> dict:
    """{(base, fold or None): model}: every base on all rows but a fold's, and on all rows if ``whole``.

    Bases given as ``Boosting`` or ``Forest`` grow together in a batch of each kind over ``features``; the others are fitted side by side.
    A base with ``prepared`` makes its rows ready once, for all folds.
    """
    parts = [*range(k), *([None] if whole else [])]
    batch = df.withColumns({f"_in{i}": F.col(fold) != i for i in range(k)})
    tasks, ready = {}, {n: b.prepared(df, fold).cache() for n, b in bases.items() if hasattr(b, "prepared")}
    for kind, fit in ((Boosting, _fit_tabulated), (Forest, fit_forest_batch)):
        specs = {(n, i): replace(b, rows="" if i is None else f"_in{i}") for n, b in bases.items() if isinstance(b, kind) for i in parts}
        if specs:
            tasks[kind] = lambda fit=fit, specs=specs: fit(batch, specs, features, row_id)
    for n, b in bases.items():
        if not isinstance(b, (Boosting, Forest)):
            rows = ready.get(n, df)
            tasks |= {(n, i): lambda b=b, i=i, rows=rows: b.fit(rows if i is None else rows.where(F.col(fold) != i)) for i in parts}
    found = fit_side_by_side(tasks)
    for rows in ready.values():
        rows.unpersist()
    return {**found.pop(Boosting, {}), **found.pop(Forest, {}), **found}


def out_of_fold(df: DataFrame, bases: Sequence[str], fitted: dict, row_id: str, label: str, fold: str, k: int) -> DataFrame:
    """Predictions of every base for every row by a model that did not see the row's fold.

    Each fold is scored by all bases in one chain of projections, so the table is
    written once per fold and never joined. The folds of a table of many partitions are
    dealt anew by the hash of the row id, or each step of a meta model would start a task a fold and partition.
    """
    parts, partitions = None, df.rdd.getNumPartitions()
    for i in range(k):
        scored = df.where(F.col(fold) == i)
        for name in bases:
            scored = _probability(fitted[name, i].transform(scored), f"z_{name}")
        scored = scored.select(row_id, label, fold, *[f"z_{n}" for n in bases])
        parts = scored if parts is None else parts.unionByName(scored)
    if k * partitions > SMALL_PARTITIONS:
        parts = parts.repartition(step_partitions(partitions), row_id).sortWithinPartitions(*parts.columns)
    return cut_lineage(parts)


class StackedModel(Model):
    """Bases refitted on all rows, with a meta model over their outputs."""

    def __init__(self, bases: dict[str, Model], meta: Model, names: Sequence[str]):
        super().__init__()
        self.bases, self.meta, self.names = bases, meta, list(names)

    def _transform(self, df: DataFrame) -> DataFrame:
        return self.combined(member_outputs(df, self.bases))

    def combined(self, outputs: DataFrame) -> DataFrame:
        """Predictions from the bases' outputs, of which stacks over the same bases share a table."""
        out = VectorAssembler(inputCols=[f"z_{n}" for n in self.names], outputCol="meta_features").transform(outputs)
        return self.meta.transform(out).drop("meta_features", *[f"z_{n}" for n in self.names])

    def weights(self, spark) -> DataFrame:
        return meta_weights(self.meta, self.names, spark)


def meta_weights(meta: Model, names: Sequence[str], spark) -> DataFrame:
    """Meta coefficient per base."""
    rows = [(n, float(c)) for n, c in zip(names, meta.coefficients)]
    return spark.createDataFrame(rows, "base string, coefficient double")


def fit_stack(
    df: DataFrame,
    bases: dict[str, object],
    meta: object,
    row_id: str = "row_id",
    label: str = "label",
    fold: str = "fold",
    k: int = 5,
    features: Sequence[str] = (),
) -> StackedModel:
    """Stacked generalisation (Wolpert 1992): meta model on out-of-fold outputs only."""
    return fit_stacks(df, bases, {"": meta}, row_id, label, fold, k, features)[""]


def fit_metas(df: DataFrame, bases: Sequence[str], fitted: dict, metas: dict[str, object], row_id: str, label: str, fold: str, k: int) -> dict[str, Model]:
    """Meta models over the out-of-fold outputs of fitted bases."""
    level_one = out_of_fold(df, bases, fitted, row_id, label, fold, k)
    assembled = VectorAssembler(inputCols=[f"z_{n}" for n in bases], outputCol="meta_features").transform(level_one)
    return fit_side_by_side({n: lambda m=m: m.copy({m.featuresCol: "meta_features", m.labelCol: label}).fit(assembled) for n, m in metas.items()})


def fit_stacks(
    df: DataFrame,
    bases: dict[str, object],
    metas: dict[str, object],
    row_id: str = "row_id",
    label: str = "label",
    fold: str = "fold",
    k: int = 5,
    features: Sequence[str] = (),
) -> dict[str, StackedModel]:
    """A stack for each meta model, all over the same bases, which are fitted once."""
    fitted = fit_bases(df, bases, row_id, fold, k, features)
    fitted_metas = fit_metas(df, list(bases), fitted, metas, row_id, label, fold, k)
    return {name: StackedModel({n: fitted[n, None] for n in bases}, meta, list(bases)) for name, meta in fitted_metas.items()}


def fit_members(df: DataFrame, bases: dict[str, object]) -> dict[str, Model]:
    return {name: learner.fit(df) for name, learner in bases.items()}


def member_outputs(df: DataFrame, members: dict[str, Model]) -> DataFrame:
    """One output column ``z_<name>`` per member, as a chain of projections."""
    out = df
    for name, model in members.items():
        out = _probability(model.transform(out), f"z_{name}")
    return out


def voting_classifier(df: DataFrame, members: dict[str, Model], soft: bool = True) -> DataFrame:
    """Adds ``score`` (soft only) and ``prediction`` for a two-class problem."""
    out = member_outputs(df, members)
    zs = [F.col(f"z_{n}") for n in members]
    if soft:
        score = sum(zs, F.lit(0.0)) / len(zs)
        return out.withColumn("score", score).withColumn("prediction", (F.col("score") > 0.5).cast("int"))
    return out.withColumn("prediction", hard_vote([(z > 0.5).cast("int") for z in zs], [0, 1]))


def voting_regressor(df: DataFrame, members: dict[str, Model]) -> DataFrame:
    out = member_outputs(df, members)
    return out.withColumn("prediction", mean_prediction([f"z_{n}" for n in members]))


