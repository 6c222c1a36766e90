"""Imputation: constants, category draws, neighbours, and per-feature method choice.

Every imputer fills only NULL cells. Fitted state is a few numbers per column, or
for neighbours the path of the donor table; all of it can be saved and applied
to new rows.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols
from pyspark.sql import Column, DataFrame, functions as F

from tabforge.functions.rng import uniform
from tabforge.operators import knn
from tabforge.operators.encode import _Stage
from tabforge.operators.prefix import global_positions, running_totals
from tabforge.operators.profile import quoted
from tabforge.operators.quantiles import exact_quantiles
from tabforge.session import cut_lineage, handed_off


# ---- constants -------------------------------------------------------------


class ColumnImputer(Estimator, HasInputCols, _Stage):
    """Fill a column by its mean or its exact median."""

    strategy = Param(Params._dummy(), "strategy", "mean|median", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputCols=None, strategy="median"):
        super().__init__()
        self._setDefault(strategy="median")
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, df: DataFrame) -> "ColumnImputerModel":
        cols = self.getInputCols()
        if self.getOrDefault(self.strategy) == "median":
            found = exact_quantiles(df, {c: F.col(quoted(c)) for c in cols}, [0.5])
            fills = [found[c][0] for c in cols]
        else:
            row = df.agg(*[F.avg(quoted(c)).alias(f"m{i}") for i, c in enumerate(cols)]).first()
            fills = [row[f"m{i}"] for i in range(len(cols))]
        return ColumnImputerModel(inputCols=cols, fills=[float(f) if f is not None else float("nan") for f in fills])


class ColumnImputerModel(Model, HasInputCols, _Stage):
    fills = Param(Params._dummy(), "fills", "fill value per column", TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, *, inputCols=None, fills=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _filled(self, decimals: int | None = None) -> dict[str, Column]:
        out = {}
        for c, v in zip(self.getInputCols(), self.getOrDefault(self.fills)):
            fill = F.lit(v) if decimals is None else F.round(F.lit(v), decimals)
            out[c] = F.coalesce(F.col(quoted(c)).cast("double"), fill)
        return out

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns(self._filled())

    def add_filled(self, df: DataFrame, method: str, decimals: int | None = None) -> DataFrame:
        return df.withColumns({f"{c}__{method}": e for c, e in self._filled(decimals).items()})


def round_codes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Imputed category codes back to whole numbers, halves to even."""
    return df.withColumns({c: F.bround(quoted(c)).cast("int") for c in columns})


# ---- category draws --------------------------------------------------------


def impute_by_distribution(df: DataFrame, column: str, row_id: str, seed: int = 42) -> DataFrame:
    """Draw a missing category from the observed frequencies, fixed by row id and seed.

    Categories stand in text order on a line of length total count; a row takes
    the one its uniform number falls on. Integer counts make the draw exact. The line
    is cut into as many equal buckets as there are categories, so a row meets the few
    categories of its bucket in a join, however many there are.
    """
    x = F.col(quoted(column))
    counts = df.where(x.isNotNull()).groupBy(x.alias("label")).agg(F.count(F.lit(1)).alias("n"))
    ladder = cut_lineage(running_totals(global_positions(counts, ["label"], "place"), "place", ["n"]))
    size = ladder.agg(F.count(F.lit(1)).alias("labels"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows")).first()
    if not size["labels"]:
        return df
    width = size["rows"] / size["labels"]

    def bucket(at: Column) -> Column:
        return F.floor(at / F.lit(width))

    steps = ladder.select("label", "n_before", "n_to", F.explode(F.sequence(bucket(F.col("n_before")), bucket(F.col("n_to")))).alias("bucket"))
    open_rows = df.where(x.isNull()).withColumn("at", uniform(row_id, seed) * F.lit(float(size["rows"]))).withColumn("bucket", bucket(F.col("at")))
    drawn = open_rows.drop(column).join(steps, "bucket").where("n_before <= at AND at < n_to")
    filled = drawn.select(*[F.col("label").alias(c) if c == column else F.col(quoted(c)) for c in df.columns])
    return df.where(x.isNotNull()).union(filled)


# ---- neighbours ------------------------------------------------------------


class SharedSearch:
    """One neighbour search for imputers that differ in k alone: that of the largest k, of which the others take the first places."""

    def __init__(self, most: int):
        self.most, self.known = most, []

    def edges(self, k: int, of: tuple, search: Callable[[int], DataFrame]) -> DataFrame:
        """Edges of the k nearest; ``of`` are the objects that the search depends on."""
        if not self.known or any(a is not b for a, b in zip(self.known[0][0], of, strict=True)):
            self.known = [(of, handed_off(search(self.most)))]
        return self.known[0][1].where(F.col("place") <= k)


class KnnImputer(Estimator, HasInputCols, _Stage):
    """Mean of the k nearest rows that have the feature; weights uniform or 1/distance."""

    k = Param(Params._dummy(), "k", "neighbours", TypeConverters.toInt)
    weights = Param(Params._dummy(), "weights", "uniform|distance", TypeConverters.toString)
    rowId = Param(Params._dummy(), "rowId", "unique key column", TypeConverters.toString)
    donorsPath = Param(Params._dummy(), "donorsPath", "where to keep the donor table", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputCols=None, k=5, weights="uniform", rowId="row_id", donorsPath=None):
        super().__init__()
        self._setDefault(k=5, weights="uniform", rowId="row_id")
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    _shared: SharedSearch | None = None

    def sharing(self, search: SharedSearch) -> "KnnImputer":
        """This imputer, with a search that others of the same columns and rows use too."""
        self._shared = search
        return self

    def copy(self, extra=None):
        new = super().copy(extra)
        new._shared = self._shared
        return new

    def _fit(self, df: DataFrame) -> "KnnImputerModel":
        cols, rid = self.getInputCols(), self.getOrDefault(self.rowId)
        donors = df.select(rid, *[quoted(c) for c in cols])
        row = df.agg(*[F.avg(quoted(c)).alias(f"m{i}") for i, c in enumerate(cols)]).first()
        model = KnnImputerModel(
            inputCols=cols,
            k=self.getOrDefault(self.k),
            weights=self.getOrDefault(self.weights),
            rowId=rid,
            means=[float(m) if m is not None else float("nan") for m in row],
        )
        if self.isDefined(self.donorsPath):
            path = self.getOrDefault(self.donorsPath)
            donors.write.mode("overwrite").parquet(path)
            model._set(donorsPath=path)
        else:
            model._donors = donors
            model._shared, model._source = self._shared, df
        return model


class KnnImputerModel(Model, HasInputCols, _Stage):
    k = Param(Params._dummy(), "k", "neighbours", TypeConverters.toInt)
    weights = Param(Params._dummy(), "weights", "uniform|distance", TypeConverters.toString)
    rowId = Param(Params._dummy(), "rowId", "unique key column", TypeConverters.toString)
    donorsPath = Param(Params._dummy(), "donorsPath", "donor table", TypeConverters.toString)
    means = Param(Params._dummy(), "means", "fallback per column", TypeConverters.toListFloat)

    _donors: DataFrame | None = None
    _source: DataFrame | None = None  # the rows of the fit, as given
    _shared: SharedSearch | None = None

    @keyword_only
    def __init__(self, *, inputCols=None, k=5, weights="uniform", rowId="row_id", means=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def copy(self, extra=None):
        new = super().copy(extra)
        new._donors, new._source, new._shared = self._donors, self._source, self._shared
        return new

    def donors(self, df: DataFrame) -> DataFrame:
        if self._donors is not None:
            return self._donors
        return df.sparkSession.read.parquet(self.getOrDefault(self.donorsPath))

    def fills(self, df: DataFrame, **options) -> DataFrame:
        """One row per row with a gap: row id and the estimate of every feature (NULL if not missing)."""
        cols, rid = self.getInputCols(), self.getOrDefault(self.rowId)
        vec = knn.vector(cols)

        def search(k: int) -> DataFrame:
            return knn.knn_edges(
                df, self.donors(df), query_id=rid, donor_id=rid, query_vector=vec, donor_vector=vec, width=len(cols),
                k=k, targets=range(len(cols)), **options,
            )

        k = self.getOrDefault(self.k)
        edges = self._shared.edges(k, (df, self._source), search) if self._shared and k <= self._shared.most else search(k)
        long = knn.weighted_mean(edges, ["query_id", "target"], 2.0, self.getOrDefault(self.weights))
        return long.groupBy(F.col("query_id").alias(rid)).agg(
            *[F.max(F.when(F.col("target") == i, F.col("estimate"))).alias(f"_f{i}") for i in range(len(cols))]
        )

    def _joined(self, df: DataFrame, **options) -> tuple[DataFrame, dict[str, Column]]:
        cols = self.getInputCols()
        wide = df.join(self.fills(df, **options), self.getOrDefault(self.rowId), "left")
        means = self.getOrDefault(self.means)
        exprs = {
            c: F.coalesce(F.col(quoted(c)).cast("double"), F.col(f"_f{i}"), F.lit(means[i])) for i, c in enumerate(cols)
        }
        return wide, exprs

    def _transform(self, df: DataFrame) -> DataFrame:
        return self.apply(df)

    def apply(self, df: DataFrame, **options) -> DataFrame:
        wide, exprs = self._joined(df, **options)
        return wide.select(*[exprs[c].alias(c) if c in exprs else F.col(quoted(c)) for c in df.columns])

    def add_filled(self, df: DataFrame, method: str, decimals: int | None = None) -> DataFrame:
        wide, exprs = self._joined(df)
        return wide.select(*[F.col(quoted(c)) for c in df.columns], *[e.alias(f"{c}__{method}") for c, e in exprs.items()])


# ---- choosing a method per feature -----------------------------------------


def missing_shares(df: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    row = df.agg(*[F.avg(F.col(quoted(c)).isNull().cast("double")).alias(f"m{i}") for i, c in enumerate(columns)]).first()
    return {c: row[i] for i, c in enumerate(columns)}


def merge_methods(wide: DataFrame, strategy: dict[str, str], keep: Sequence[str]) -> DataFrame:
    """Each column from the copy its method made; a pure projection, no join."""
    return wide.select(*keep, *[F.col(quoted(f"{c}__{m}")).alias(c) for c, m in strategy.items()])


def threshold_strategy(df: DataFrame, columns: Sequence[str], limit: float = 0.30) -> dict[str, str]:
    """median above the missing limit, else knn."""
    return {c: "median" if share > limit else "knn" for c, share in missing_shares(df, columns).items()}


# Features always filled by neighbours in the fixed hybrid.
FIXED_KNN_FEATURES = ("UREA", "PLT1", "NET", "MOT", "BAT")


class ThresholdImputer:
    """Median for columns with a larger share of gaps than ``limit``, neighbours in the others."""

    def __init__(self, columns: Sequence[str], limit: float = 0.30, k: int = 5):
        self.columns, self.limit, self.k = list(columns), limit, k
        self.models: list = []

    def fit(self, df: DataFrame) -> "ThresholdImputer":
        shares = missing_shares(df, self.columns)
        gappy = [c for c in self.columns if shares[c] > self.limit]
        rest = [c for c in self.columns if c not in gappy]
        self.models = [ColumnImputer(inputCols=gappy, strategy="median").fit(df)] if gappy else []
        self.models += [KnnImputer(inputCols=rest, k=self.k).fit(df)] if rest else []
        return self

    def add_filled(self, df: DataFrame, method: str) -> DataFrame:
        for model in self.models:
            df = model.add_filled(df, method)
        return df


def fixed_strategy(columns: Sequence[str], knn_features: Sequence[str] = FIXED_KNN_FEATURES) -> dict[str, str]:
    return {c: "knn" if c in knn_features else "mice" for c in columns}


def best_method_table(wide: DataFrame, columns: Sequence[str], methods: Sequence[str]) -> DataFrame:
    """Mean drift of every method per feature and the first smallest one.

    One scan over the wide table measures all features and methods.
    """
    aggs = []
    for i, c in enumerate(columns):
        aggs.append(F.avg(quoted(c)).alias(f"o{i}"))
        aggs += [F.avg(quoted(f"{c}__{m}")).alias(f"m{i}_{j}") for j, m in enumerate(methods)]
    row = wide.agg(*aggs)
    structs = []
    for i, c in enumerate(columns):
        old = F.when(F.col(f"o{i}") == 0, F.lit(1e-10)).otherwise(F.col(f"o{i}"))
        changes = [F.abs((F.col(f"m{i}_{j}") - old) / old) * 100.0 for j in range(len(methods))]
        structs.append(
            F.struct(
                F.lit(c).alias("feature"),
                F.col(f"o{i}").alias("original_mean"),
                *[e.alias(f"{m}_change_pct") for m, e in zip(methods, changes)],
                F.array_min(
                    F.array(*[F.struct(e.alias("change"), F.lit(j).alias("ord"), F.lit(m).alias("name")) for j, (m, e) in enumerate(zip(methods, changes))])
                ).alias("best"),
            )
        )
    long = row.select(F.explode(F.array(*structs)).alias("r")).select("r.*")
    return long.select(
        *[c for c in long.columns if c != "best"], F.col("best.name").alias("best_method"), F.col("best.change").alias("best_change_pct")
    )


def best_strategy(table: DataFrame) -> dict[str, str]:
    return {r["feature"]: r["best_method"] for r in table.select("feature", "best_method").collect()}


def strategy_frame(spark, strategy: dict[str, str]) -> DataFrame:
    return spark.createDataFrame(sorted(strategy.items()), "feature string, method string")


class HybridImputerModel:
    """Fitted imputers and the method of every feature, applied together to new rows.

    A feature without a method is filled by neighbours.
    """

    def __init__(self, models: dict[str, object], strategy: dict[str, str], row_id: str = "row_id"):
        self.models, self.strategy, self.row_id = models, dict(strategy), row_id

    def transform(self, df: DataFrame, columns: Sequence[str]) -> DataFrame:
        plan = {c: self.strategy.get(c, "knn") for c in columns}
        wide = df
        for method in sorted(set(plan.values())):
            wide = self.models[method].add_filled(wide, method)
        keep = [c for c in df.columns if c not in plan]
        return merge_methods(wide, plan, keep)

    def save(self, spark, path: str) -> None:
        for method, model in self.models.items():
            model.write().overwrite().save(f"{path}/{method}")
        rows = [(json.dumps(self.strategy), json.dumps({m: type(x).__name__ for m, x in self.models.items()}), self.row_id)]
        spark.createDataFrame(rows, "strategy string, kinds string, row_id string").write.mode("overwrite").json(f"{path}/plan")

    @classmethod
    def load(cls, spark, path: str) -> "HybridImputerModel":
        from tabforge.operators.mice import ChainedLinearModel

        classes = {c.__name__: c for c in (ColumnImputerModel, KnnImputerModel, ChainedLinearModel)}
        plan = spark.read.schema("strategy string, kinds string, row_id string").json(f"{path}/plan").first()
        models = {m: classes[kind].load(f"{path}/{m}") for m, kind in json.loads(plan["kinds"]).items()}
        return cls(models, json.loads(plan["strategy"]), plan["row_id"])
