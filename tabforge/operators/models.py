"""Learners: MLlib estimators with the reference meaning of their parameters, and a few
built from DataFrame jobs where MLlib has none."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml import Model
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    LinearSVC,
    LogisticRegression,
    NaiveBayes,
    RandomForestClassifier,
)
from pyspark.ml.feature import PolynomialExpansion, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tabforge.functions.rng import uniform
from tabforge.operators import knn
from tabforge.operators.boosting import CELLS, Boosting, fit_many
from tabforge.operators.cells import CellBins, CellGBTClassifier, CellGBTRegressor, bins_of
from tabforge.operators.encode import bounded_rows
from tabforge.operators.profile import with_class_weights
from tabforge.session import cut_lineage, for_steps


def assemble(df: DataFrame, columns: Sequence[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(columns), outputCol=out, handleInvalid="error").transform(df)


def split_shares(df: DataFrame, label: str) -> tuple[int, float]:
    row = df.agg(F.count(F.lit(1)).alias("n"), F.stddev_samp(label).alias("s")).first()
    return row["n"], float(row["s"] or 1.0)


# ---- linear ----------------------------------------------------------------


def logistic(df: DataFrame, label: str = "label", weight: str | None = None, c: float = 1.0, **params) -> LogisticRegression:
    """Penalty as in 'C': the mean loss is minimised, so the strength is 1 / (C * n)."""
    extra = {"weightCol": weight} if weight else {}
    return LogisticRegression(
        labelCol=label, maxIter=1000, regParam=1.0 / (c * max(df.count(), 1)), standardization=False, **extra, **params
    )


def ridge(df: DataFrame, label: str, alpha: float = 1.0) -> LinearRegression:
    """Sum-of-squares objective with alpha * |w|^2; MLlib divides its L2 part by sd(y)."""
    n, sd = split_shares(df, label)
    return LinearRegression(
        labelCol=label, regParam=alpha * sd / n, elasticNetParam=0.0, standardization=False, solver="l-bfgs", maxIter=500, tol=1e-12
    )


def lasso(label: str, alpha: float = 0.1) -> LinearRegression:
    return LinearRegression(
        labelCol=label, regParam=alpha, elasticNetParam=1.0, standardization=False, solver="l-bfgs", maxIter=500, tol=1e-10
    )


def elastic_net(df: DataFrame, label: str, alpha: float = 0.1, rho: float = 0.5) -> LinearRegression:
    _, sd = split_shares(df, label)
    l1, l2 = alpha * rho, alpha * (1.0 - rho) * sd
    return LinearRegression(
        labelCol=label, regParam=l1 + l2, elasticNetParam=l1 / (l1 + l2), standardization=False, solver="l-bfgs", maxIter=500, tol=1e-10
    )


# ---- trees -----------------------------------------------------------------


def tree(label: str = "label", depth: int = 10, **params) -> DecisionTreeClassifier:
    return DecisionTreeClassifier(labelCol=label, maxDepth=depth, seed=42, **params)


def forest(label: str = "label", trees: int = 100, depth: int = 10, regression: bool = False, **params):
    cls = RandomForestRegressor if regression else RandomForestClassifier
    return cls(labelCol=label, numTrees=trees, maxDepth=depth, seed=42, **params)


def extra_trees(label: str = "label", trees: int = 100, depth: int = 10, regression: bool = False):
    """Approximation: no bootstrap and few features per split; thresholds are not random."""
    return forest(label, trees, depth, regression, bootstrap=False, featureSubsetStrategy="sqrt")


def forest_errors(fitted, df: DataFrame, label: str, sizes: Sequence[int], block: int = 25) -> dict[int, float]:
    """Mean squared error of the first n trees of a regression forest, for each n of ``sizes``."""
    wanted, errors = set(sizes), {}
    state = df.select("features", F.col(label).cast("double").alias("_y"), F.lit(0.0).alias("_sum"))
    for n, member in enumerate(fitted.trees[: max(wanted, default=0)], 1):
        state = member.transform(state).withColumn("_sum", F.col("_sum") + F.col("prediction")).drop("prediction")
        if n % block == 0 or n in wanted:
            state = cut_lineage(state)
        if n in wanted:
            errors[n] = state.agg(F.avg((F.col("_sum") / n - F.col("_y")) ** 2)).first()[0]
    return errors


# How second-order boosting parameters map to MLlib's boosting.
BOOST_PARAMS = {
    "n_estimators": "maxIter",
    "learning_rate": "stepSize",
    "max_depth": "maxDepth",
    "subsample": "subsamplingRate",
    "gamma": "minInfoGain",
    "min_child_weight": "minInstancesPerNode",
    "colsample": "featureSubsetStrategy",
}


def boosted(label: str = "label", regression: bool = False, **params):
    """Boosted trees; a parameter without an MLlib counterpart is an error."""
    known = {}
    for name, value in params.items():
        if name not in BOOST_PARAMS:
            raise ValueError(f"{name} has no counterpart in MLlib boosting")
        known[BOOST_PARAMS[name]] = str(value) if name == "colsample" else value
    cls = CellGBTRegressor if regression else CellGBTClassifier
    return cls(labelCol=label, seed=42, **known)


def gaussian_bayes(label: str = "label") -> NaiveBayes:
    return NaiveBayes(labelCol=label, modelType="gaussian")


def importances(model, names: Sequence[str], spark) -> DataFrame:
    """(feature, importance) of a fitted tree model, largest first."""
    rows = [(n, float(v)) for n, v in zip(names, model.featureImportances.toArray())]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.col("importance").desc(), "feature")


# ---- one-vs-rest boosting --------------------------------------------------


class OneVsRestBoosting(Model):
    """k two-class boosted models; class-1 probabilities normalised to sum 1."""

    def __init__(self, members: list, classes: list[int]):
        super().__init__()
        self.members, self.classes = members, classes

    def _transform(self, df: DataFrame) -> DataFrame:
        out = df
        for c, model in zip(self.classes, self.members):
            out = model.transform(out).withColumn(f"_p{c}", F.get(vector_to_array("probability"), F.lit(1)))
            out = out.drop("rawPrediction", "probability", "prediction")
        total = sum((F.col(f"_p{c}") for c in self.classes), F.lit(0.0))
        shares = F.array(*[F.col(f"_p{c}") / total for c in self.classes])
        out = out.withColumn("probabilities", shares)
        best = F.array_position("probabilities", F.array_max("probabilities")).cast("int")
        labels = F.array(*[F.lit(c) for c in self.classes])
        return out.withColumn("prediction", F.element_at(labels, best)).drop(*[f"_p{c}" for c in self.classes])


def fit_one_vs_rest(df: DataFrame, label: str, features: Sequence[str], row_id: str, **params) -> OneVsRestBoosting:
    """One boosted model for each class against the rest, all grown in the same passes."""
    classes = [r[0] for r in bounded_rows(df.select(label).distinct().orderBy(label), 1000, "classes")]
    marked = df.withColumns({f"_y{i}": (F.col(label) == F.lit(c)).cast("double") for i, c in enumerate(classes)})
    fitted = fit_many(marked, {i: Boosting(f"_y{i}", **params) for i in range(len(classes))}, features, row_id)
    return OneVsRestBoosting([fitted[i] for i in range(len(classes))], classes)


# ---- AdaBoost --------------------------------------------------------------


class SammeModel(Model):
    """Weighted vote of weak trees; with ``bins`` they are trees over bin numbers."""

    def __init__(self, members: list, alphas: list[float], classes: list[int], bins: CellBins | None = None):
        super().__init__()
        self.members, self.alphas, self.classes, self.bins = members, alphas, classes, bins
        self.table: np.ndarray | None = None

    def _transform(self, df: DataFrame) -> DataFrame:
        few = self.bins and self.bins.size() <= CELLS
        out = self._looked_up(df) if few else self._chained(self.bins.transform(df) if self.bins else df).drop("_bins")
        best = F.array_position("probabilities", F.array_max("probabilities")).cast("int")
        return out.withColumn("prediction", F.element_at(F.array(*[F.lit(c) for c in self.classes]), best))

    def _chained(self, df: DataFrame) -> DataFrame:
        """The shares of votes, by each member in turn."""
        votes = {c: F.lit(0.0) for c in self.classes}
        out = df
        for i, (model, alpha) in enumerate(zip(self.members, self.alphas)):
            out = model.transform(out).withColumn(f"_h{i}", F.col("prediction").cast("int"))
            out = out.drop("rawPrediction", "probability", "prediction")
            for c in self.classes:
                votes[c] = votes[c] + F.when(F.col(f"_h{i}") == c, F.lit(alpha)).otherwise(F.lit(0.0))
        total = sum(self.alphas) or 1.0
        shares = F.array(*[votes[c] / total for c in self.classes])
        return out.withColumn("probabilities", shares).drop(*[f"_h{i}" for i in range(len(self.members))])

    def _looked_up(self, df: DataFrame) -> DataFrame:
        """The shares of votes from those of each cell, so that a row does not pass through all members."""
        if self.table is None:
            rows = self._chained(self.bins.grid(df.sparkSession)).select("cell", "probabilities").orderBy("cell").collect()
            self.table = np.array([r["probabilities"] for r in rows])
        table = self.table

        @F.arrow_udf(T.ArrayType(T.DoubleType()))
        def shares(cell: pa.Array) -> pa.Array:
            found = table[cell.to_numpy(zero_copy_only=False)]
            offsets = pa.array(np.arange(0, found.size + 1, found.shape[1]), pa.int32())
            return pa.ListArray.from_arrays(offsets, pa.array(found.ravel()))

        return self.bins.numbered(df).withColumn("probabilities", shares("_cell")).drop("_cell")


def fit_samme(df: DataFrame, label: str = "label", rounds: int = 100, depth: int = 1, rate: float = 1.0, cut_every: int = 10) -> SammeModel:
    """Multi-class AdaBoost (Zhu et al. 2009): reweight rows after every weak tree.

    Each round is a weighted tree fit and one aggregate for the error; weights are a
    column, and lineage is cut every few rounds. Where rows are many more than cells of their bins, rows
    of a cell and class keep equal weights in all rounds, so they are one row whose weight is their sum.
    """
    classes = [r[0] for r in bounded_rows(df.select(label).distinct().orderBy(label), 1000, "classes")]
    k = len(classes)
    n = df.count()
    state = df.select("features", F.col(label).cast("double").alias("_y"), F.lit(1.0 / n).alias("_w"))
    bins = bins_of(state)
    own = "_bins" if bins else "features"
    if bins:
        state = bins.table(state.drop("_w"), ["_y"], (F.count(F.lit(1)) / F.lit(n)).alias("_w"))
    members, alphas = [], []
    for r in range(rounds):
        if r % cut_every == 0:
            state = cut_lineage(state)
        weak = DecisionTreeClassifier(featuresCol=own, labelCol="_y", weightCol="_w", maxDepth=depth, seed=42).fit(state)
        marked = weak.transform(state).withColumn("_miss", (F.col("prediction") != F.col("_y")).cast("double"))
        error = marked.agg((F.sum(F.col("_w") * F.col("_miss")) / F.sum("_w")).alias("e")).first()["e"]
        if error >= 1.0 - 1.0 / k:
            break
        alpha = rate * (np.log((1.0 - error) / max(error, 1e-12)) + np.log(k - 1.0))
        members.append(weak)
        alphas.append(float(alpha))
        if error <= 1e-12:
            break
        # Normalised so that the weights add up to 1 again.
        grown = float(np.exp(alpha))
        total = (1.0 - error) + error * grown
        weight = F.col("_w") * F.when(F.col("_miss") == 1.0, F.lit(grown)).otherwise(F.lit(1.0)) / F.lit(total)
        state = marked.select(own, "_y", weight.alias("_w"))
    return SammeModel(members, alphas, [int(c) for c in classes], bins)


# ---- kernels ---------------------------------------------------------------


class KernelMap:
    """Explicit features whose inner product approximates a kernel.

    linear: the columns themselves. rbf: random Fourier features (Rahimi & Recht 2007).
    poly: all monomials up to degree 3. sigmoid: kernel values to hash-chosen landmark rows.
    """

    def __init__(self, kind: str, columns: Sequence[str], gamma: float, size: int = 100, seed: int = 42):
        self.kind, self.columns, self.gamma, self.size, self.seed = kind, list(columns), gamma, size, seed
        self.state: tuple = ()

    def fit(self, df: DataFrame, row_id: str) -> "KernelMap":
        d = len(self.columns)
        if self.kind == "rbf":
            rng = np.random.default_rng(self.seed)
            self.state = (rng.normal(0.0, np.sqrt(2.0 * self.gamma), (d, self.size)), rng.uniform(0, 2 * np.pi, self.size))
        elif self.kind == "sigmoid":
            order = [uniform(row_id, self.seed), F.col(row_id)]
            marks = df.orderBy(*order).limit(self.size).select(*self.columns).toPandas().to_numpy(dtype=float)
            self.state = (marks,)
        return self

    def transform(self, df: DataFrame, out: str = "kernel_features") -> DataFrame:
        if self.kind == "linear":
            return assemble(df, self.columns, out)
        if self.kind == "poly":
            ready = assemble(df, self.columns, "_base")
            return PolynomialExpansion(degree=3, inputCol="_base", outputCol=out).transform(ready).drop("_base")
        explicit, d = self._explicit(), len(self.columns)

        @F.arrow_udf(T.ArrayType(T.DoubleType()))
        def mapped(vectors: pa.Array) -> pa.Array:
            z = explicit(vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(vectors), d))
            offsets = pa.array(np.arange(0, z.size + 1, z.shape[1]), pa.int32())
            return pa.ListArray.from_arrays(offsets, pa.array(z.ravel()))

        return df.withColumn(out, array_to_vector(mapped(knn.vector(self.columns))))

    def _explicit(self) -> Callable[[np.ndarray], np.ndarray]:
        """The explicit features of rows, for rbf and sigmoid."""
        kind, state, gamma = self.kind, self.state, self.gamma

        def values(x: np.ndarray) -> np.ndarray:
            if kind == "rbf":
                return np.sqrt(2.0 / state[0].shape[1]) * np.cos(x @ state[0] + state[1])
            return np.tanh(gamma * (x @ state[0].T))

        return values

    def product(self, weights: np.ndarray, begin: float) -> Column:
        """The explicit features of a row (rbf and sigmoid) times ``weights``, plus ``begin``; the features never become a column."""
        explicit, d = self._explicit(), len(self.columns)

        @F.arrow_udf("double")
        def product(vectors: pa.Array) -> pa.Array:
            return pa.array(explicit(vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(vectors), d)) @ weights + begin)

        return product(knn.vector(self.columns))


class KernelSvm(Model):
    """Linear SVM on a kernel map, with probabilities from a logistic fit on the margin."""

    def __init__(self, kernel: KernelMap, svm, calibrator):
        super().__init__()
        self.kernel, self.svm, self.calibrator = kernel, svm, calibrator

    def _transform(self, df: DataFrame) -> DataFrame:
        if self.kernel.kind in ("rbf", "sigmoid"):
            margin = self.kernel.product(self.svm.coefficients.toArray(), float(self.svm.intercept))
            out = VectorAssembler(inputCols=["margin"], outputCol="margin_vec").transform(df.withColumn("margin", margin))
        else:
            out = _margin(self.svm.transform(self.kernel.transform(df)))
        return self.calibrator.transform(out).drop("kernel_features", "margin_vec")


def _margin(df: DataFrame) -> DataFrame:
    out = df.withColumn("margin", F.get(vector_to_array("rawPrediction"), F.lit(1))).drop("rawPrediction", "prediction")
    return VectorAssembler(inputCols=["margin"], outputCol="margin_vec").transform(out)


def fit_kernel_svm(df: DataFrame, columns: Sequence[str], label: str, row_id: str, kind: str = "rbf", gamma: float | None = None) -> KernelSvm:
    """Columns should be scaled; gamma defaults to 1 / number of columns."""
    kernel = KernelMap(kind, columns, gamma or 1.0 / len(columns)).fit(df, row_id)
    mapped = kernel.transform(for_steps(df)).select(label, "kernel_features").cache()
    out = fit_mapped_svm(mapped, kernel, label)
    mapped.unpersist()
    return out


def fit_mapped_svm(mapped: DataFrame, kernel: KernelMap, label: str) -> KernelSvm:
    """The machine over rows that ``kernel`` has mapped already; these should be cached."""
    svm = LinearSVC(featuresCol="kernel_features", labelCol=label, maxIter=50, regParam=1e-3).fit(mapped)
    scored = _margin(svm.transform(mapped))
    calibrator = LogisticRegression(featuresCol="margin_vec", labelCol=label, maxIter=100).fit(scored)
    return KernelSvm(kernel, svm, calibrator)


def fit_kernel_regression(df: DataFrame, columns: Sequence[str], label: str, row_id: str, kind: str = "rbf", gamma: float | None = None):
    """Kernel regression under the Huber loss (stands in for the epsilon-insensitive loss)."""
    kernel = KernelMap(kind, columns, gamma or 1.0 / len(columns)).fit(df, row_id)
    learner = LinearRegression(featuresCol="kernel_features", labelCol=label, loss="huber", regParam=1e-4, maxIter=200)
    mapped = kernel.transform(df).cache()
    model = learner.fit(mapped)
    mapped.unpersist()
    return kernel, model


# ---- neighbours ------------------------------------------------------------


def knn_predict(
    train: DataFrame,
    test: DataFrame,
    row_id: str,
    columns: Sequence[str],
    label: str,
    k: int = 5,
    metric: str = "euclidean",
    p: float = 2.0,
    weights: str = "uniform",
    regression: bool = False,
    **options,
) -> DataFrame:
    """Vote or mean of the k nearest training rows: (row_id, prediction, score).

    ``score`` is the vote share of class 1, or the mean. Ties go to the lower class.
    """
    power = knn.metric_power(metric, p)
    edges = knn.knn_edges(
        test, train, query_id=row_id, donor_id=row_id, query_vector=knn.vector(columns), donor_vector=knn.vector(columns),
        width=len(columns), k=k, p=power, value=F.col(label), **options,
    )
    if regression:
        out = knn.weighted_mean(edges, ["query_id"], power, weights)
        return out.select(F.col("query_id").alias(row_id), F.col("estimate").alias("prediction"), F.col("estimate").alias("score"))
    weight: Column = F.lit(1.0)
    if weights == "distance":
        weight = F.coalesce(F.try_divide(F.lit(1.0), F.pow("power", F.lit(1.0 / power))), F.lit(1e300))
    votes = edges.groupBy("query_id", "value").agg(F.sum(weight).alias("w"))
    per = votes.groupBy("query_id").agg(
        F.max(F.struct(F.col("w"), (-F.col("value")).alias("neg"))).alias("best"),
        (F.sum(F.when(F.col("value") == 1, F.col("w")).otherwise(0.0)) / F.sum("w")).alias("score"),
    )
    return per.select(F.col("query_id").alias(row_id), (-F.col("best.neg")).cast("int").alias("prediction"), "score")


def balanced(df: DataFrame, label: str) -> DataFrame:
    """Rows with balanced class weights in ``weight``, for learners with a weight column."""
    return with_class_weights(df, label, "weight")
