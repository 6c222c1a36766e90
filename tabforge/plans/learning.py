"""Models, stacking, experiments, registry and serving (inventory 2.14-2.16, 2.19, 2.20)."""

from __future__ import annotations

from dataclasses import replace
from itertools import product

import numpy as np
from pyspark.ml import Pipeline
from pyspark.ml.classification import LinearSVC, LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from tabforge.functions.moments import exact_mean
from tabforge.functions.rng import uniform, uniform_sql
from tabforge.operators import ensemble, experiments, impute, leaderboard, metrics, mice, models, outliers, serve, split
from tabforge.operators.boosting import Boosting, fit_many
from tabforge.operators.encode import ColumnScaler
from tabforge.operators.forests import Forest
from tabforge.operators.experiments import Experiment, with_score
from tabforge.plans.aggregates import rounded
from tabforge.plans.basics import _TWO_RUNS_SQL, _two_runs
from tabforge.plans.catalog import query, table
from tabforge.plans.inputs import GAP_COLUMNS, READINGS_SQL, RUNS_SQL, SCALER_NAMES, readings, runs, with_sql
from tabforge.session import cut_lineage, for_steps, scratch_path, training_table

X = ["v", "k", "h"]
#: Depth of forests; the reference's classifiers stop there, its regressors have no limit.
FOREST_DEPTH = 15
#: Share of the features that a split of a classifying forest looks at: the root of their number.
ROOT = int(len(X) ** 0.5) / len(X)


def lessons(spark, sf):
    """Training table: three features, a noisy class, a regression target, four ordered classes."""
    e = table(spark, sf, "events").select(
        F.col("event_id").alias("row_id"),
        F.col("value").alias("v"),
        F.get_json_object("props", "$.k").cast("double").alias("k"),
        F.hour("ts").cast("double").alias("h"),
    )
    noisy = F.col("v") + F.col("k") + 40.0 * (uniform("row_id", 5) - 0.5)
    return e.select(
        "*",
        (noisy > 100).cast("int").alias("label"),
        (0.6 * F.col("v") + 0.4 * F.col("k") + 10.0 * uniform("row_id", 6)).alias("y"),
        (0.3 * F.col("v") - 0.5 * F.col("k") + 5.0 * uniform("row_id", 7)).alias("y2"),
        F.when(noisy < 60, 0).when(noisy < 100, 1).when(noisy < 140, 2).otherwise(3).alias("cls"),
        (uniform("row_id", 42) < 0.8).alias("is_train"),
    )


LESSONS_SQL = f"""lessons AS (SELECT *, CAST(noisy > 100 AS INTEGER) AS label, 0.6e0 * v + 0.4e0 * k + 10e0 * {uniform_sql('row_id', 6)} AS y, {uniform_sql('row_id', 42)} < 0.8e0 AS is_train
  FROM (SELECT *, v + k + 40.0e0 * ({uniform_sql('row_id', 5)} - 0.5e0) AS noisy FROM (
    SELECT event_id AS row_id, value AS v, CAST(regexp_extract(props, '([0-9]+)', 1) AS DOUBLE) AS k, CAST(hour(ts) AS DOUBLE) AS h FROM events)))"""


def _train_test(spark, sf):
    """Materialised once, because every learner scans it many times."""
    data = training_table(models.assemble(lessons(spark, sf), X), "row_id")
    return data.where("is_train"), data.where("NOT is_train")


def _boost(train, spec):
    return fit_many(train, {"": spec}, X, "row_id")[""].tabulated()


#: Sizes of the reference's boosted learners.
MULTICLASS = {"n_estimators": 200, "max_depth": 7, "learning_rate": 0.1, "subsample": 0.8}
STACK_TREES, STACK_META_TREES, GRID_TREES, SWEEP_TREES = 150, 50, (100, 200), 200
CURVE_TREES = tuple(range(50, 251, 25))


def _score(predictions, label="label"):
    """Accuracy, F1, AUC of a two-class prediction table as one row."""
    p = with_score(predictions).select(F.col(label).cast("double").alias("label"), F.col("prediction").cast("double").alias("prediction"), "score")
    m = metrics.binary_metrics(p).select("accuracy", "f1_score")
    return m.withColumn("auc", metrics.roc_auc(p).select("auc").scalar())


def _regress(predictions, label="y"):
    return metrics.regression_metrics(predictions, label).select("r2_score", "mae", "rmse", "bias")


# ---- models ----------------------------------------------------------------


@query("md_logreg")
def md_logreg(spark, sf):
    train, test = _train_test(spark, sf)
    weighted = models.balanced(train, "label")
    return _score(models.logistic(weighted, weight="weight").fit(weighted).transform(test))


# Closed form for two features: (n * Cov + alpha * I) w = n * cov(x, y).
_RIDGE_SQL = with_sql(
    LESSONS_SQL
    + """, m AS (SELECT count(*) AS n, avg(v) AS mv, avg(k) AS mk, avg(y) AS my, covar_pop(v, v) AS a, covar_pop(v, k) AS b, covar_pop(k, k) AS d, covar_pop(v, y) AS p, covar_pop(k, y) AS q FROM lessons WHERE is_train),
    w AS (SELECT *, (p * (d + 1.0e0 / n) - b * q) / ((a + 1.0e0 / n) * (d + 1.0e0 / n) - b * b) AS wv, ((a + 1.0e0 / n) * q - b * p) / ((a + 1.0e0 / n) * (d + 1.0e0 / n) - b * b) AS wk FROM m)""",
    "SELECT round(wv, 5) AS w_v, round(wk, 5) AS w_k, round(my - wv * mv - wk * mk, 4) AS intercept FROM w",
)


@query("md_ridge", _RIDGE_SQL)
def md_ridge(spark, sf):
    train = models.assemble(lessons(spark, sf).where("is_train"), ["v", "k"])
    fitted = models.ridge(train, "y", 1.0).fit(train)
    row = (float(fitted.coefficients[0]), float(fitted.coefficients[1]), float(fitted.intercept))
    out = spark.createDataFrame([row], "w_v double, w_k double, intercept double")
    return out.select(F.round("w_v", 5).alias("w_v"), F.round("w_k", 5).alias("w_k"), F.round("intercept", 4).alias("intercept"))


@query("md_lasso")
def md_lasso(spark, sf):
    train, test = _train_test(spark, sf)
    return _regress(models.lasso("y", 0.1).fit(train).transform(test))


@query("md_enet")
def md_enet(spark, sf):
    train, test = _train_test(spark, sf)
    return _regress(models.elastic_net(train, "y", 0.1).fit(train).transform(test))


@query("md_tree")
def md_tree(spark, sf):
    train, test = _train_test(spark, sf)
    return _score(models.tree(depth=10).fit(train).transform(test))


@query("md_rf")
def md_rf(spark, sf):
    train, test = _train_test(spark, sf)
    weighted = models.balanced(train, "label")
    specs = {
        "classifier": Forest("label", weight="weight", classes=True, trees=100, max_depth=FOREST_DEPTH, tries=ROOT),
        "regressor": Forest("y", trees=150, max_depth=FOREST_DEPTH),
    }
    fitted = ensemble.fit_forest_batch(weighted, specs, X, "row_id")
    cls = _score(fitted["classifier"].transform(test)).select(F.lit("classifier").alias("kind"), F.col("auc").alias("metric"))
    reg = _regress(fitted["regressor"].transform(test))
    return cls.unionByName(reg.select(F.lit("regressor").alias("kind"), F.col("r2_score").alias("metric")))


@query("md_extratrees")
def md_extratrees(spark, sf):
    train, test = _train_test(spark, sf)
    spec = Forest("label", classes=True, trees=150, max_depth=FOREST_DEPTH, tries=ROOT, bootstrap=False, cuts="random")
    return _score(ensemble.fit_forest_batch(train, {"": spec}, X, "row_id")[""].transform(test))


@query("md_gbt")
def md_gbt(spark, sf):
    train, test = _train_test(spark, sf)
    cls = _score(models.boosted(n_estimators=100, learning_rate=0.1, max_depth=5).fit(train).transform(test)).select(
        F.lit("classifier").alias("kind"), F.col("auc").alias("metric")
    )
    reg = _regress(models.boosted("y", True, n_estimators=150, learning_rate=0.1, max_depth=3).fit(train).transform(test))
    return cls.unionByName(reg.select(F.lit("regressor").alias("kind"), F.col("r2_score").alias("metric")))


@query("md_xgb")
def md_xgb(spark, sf):
    """Second-order boosting with both penalties."""
    train, test = _train_test(spark, sf)
    return _score(_boost(train, Boosting("label", n_estimators=150, subsample=0.8, colsample=0.8, gamma=0.001, min_child_weight=3, reg_lambda=1.0, reg_alpha=0.01)).transform(test))


@query("md_lgbm")
def md_lgbm(spark, sf):
    """Second-order boosting whose trees are bounded by their leaves."""
    train, test = _train_test(spark, sf)
    return _score(_boost(train, Boosting("label", n_estimators=150, subsample=0.8, colsample=0.8, min_child_samples=20, num_leaves=31)).transform(test))


@query("md_multiclass_gbt")
def md_multiclass_gbt(spark, sf):
    """Four classes: probabilities that sum to 1, class report and weighted AUC."""
    train, test = _train_test(spark, sf)
    p = cut_lineage(models.fit_one_vs_rest(train, "cls", X, "row_id", **MULTICLASS).transform(test))
    wide = p.withColumns({f"s{i}": F.get("probabilities", F.lit(i)) for i in range(4)})
    report = metrics.class_report(p, "cls", "prediction")
    auc = metrics.auc_one_vs_rest(wide, "cls", {i: f"s{i}" for i in range(4)}).select("auc_weighted").scalar()
    total = p.agg(F.max(F.abs(F.aggregate("probabilities", F.lit(0.0), lambda a, x: a + x) - 1.0))).scalar()
    return report.withColumn("auc_weighted", auc).withColumn("sum_error", F.round(total, 9))


@query("md_adaboost")
def md_adaboost(spark, sf):
    train, test = _train_test(spark, sf)
    return _score(models.fit_samme(train, "label", rounds=100).transform(test))


_NB_SQL = with_sql(
    LESSONS_SQL
    + """, m AS (SELECT label, count(*) AS n, avg(v) AS mv, var_pop(v) AS sv, avg(k) AS mk, var_pop(k) AS sk, avg(h) AS mh, var_pop(h) AS sh FROM lessons WHERE is_train GROUP BY label),
    s AS (SELECT t.row_id, m.label AS c, ln(n) - 0.5 * (ln(sv) + (t.v - mv) * (t.v - mv) / sv + ln(sk) + (t.k - mk) * (t.k - mk) / sk + ln(sh) + (t.h - mh) * (t.h - mh) / sh) AS score
      FROM lessons t, m WHERE NOT t.is_train)""",
    "SELECT row_id, CAST(arg_max(c, score) AS INTEGER) AS prediction FROM s GROUP BY row_id",
)


@query("md_nb", _NB_SQL)
def md_nb(spark, sf):
    train, test = _train_test(spark, sf)
    return models.gaussian_bayes().fit(train).transform(test).select("row_id", F.col("prediction").cast("int").alias("prediction"))


_PART_SPLIT = f"""p AS (SELECT p_partkey AS row_id, CAST(p_size AS DOUBLE) AS s, round(p_retailprice * 10 - 9000) AS r, CAST(regexp_extract(p_brand, '([0-9]+)', 1) AS DOUBLE) AS b,
 {uniform_sql('p_partkey', 42)} < 0.8e0 AS is_train FROM part), l AS (SELECT *, CAST(r + 8 * s + 3 * b > 700 AS INTEGER) AS label FROM p)"""


def _knn_sql(power):
    d = "(q.s - d.s) * (q.s - d.s) + (q.r - d.r) * (q.r - d.r) + (q.b - d.b) * (q.b - d.b)" if power == 2 else "abs(q.s - d.s) + abs(q.r - d.r) + abs(q.b - d.b)"
    return f"""SELECT q.row_id, d.label, d.r AS val, row_number() OVER (PARTITION BY q.row_id ORDER BY {d}, d.row_id) AS place FROM l q, l d WHERE NOT q.is_train AND d.is_train"""


def _part_lessons(spark, sf):
    p = table(spark, sf, "part").select(
        F.col("p_partkey").alias("row_id"),
        F.col("p_size").cast("double").alias("s"),
        F.round(F.col("p_retailprice") * 10 - 9000).alias("r"),
        F.regexp_extract("p_brand", r"(\d+)", 1).cast("double").alias("b"),
    )
    p = p.withColumn("label", (F.col("r") + 8 * F.col("s") + 3 * F.col("b") > 700).cast("int"))
    return split.random_split(p, "row_id")


@query(
    "md_knn",
    with_sql(
        _PART_SPLIT + f", e AS ({_knn_sql(2)}), f AS ({_knn_sql(1)})",
        """SELECT e.row_id, CAST(avg(e.label) > 0.5 AS INTEGER) AS euclidean5, round(avg(e.val), 6) AS mean5, any_value(m3) AS manhattan3
        FROM e JOIN (SELECT row_id, CAST(avg(label) > 0.5 AS INTEGER) AS m3 FROM f WHERE place <= 3 GROUP BY row_id) g ON g.row_id = e.row_id WHERE e.place <= 5 GROUP BY e.row_id""",
    ),
)
def md_knn(spark, sf):
    """Two votes and one regression mean."""
    p = _part_lessons(spark, sf)
    train, test = p.where("is_train"), p.where("NOT is_train")
    cols = ["s", "r", "b"]
    five = models.knn_predict(train, test, "row_id", cols, "label", 5).select("row_id", F.col("prediction").alias("euclidean5"))
    three = models.knn_predict(train, test, "row_id", cols, "label", 3, metric="manhattan").select("row_id", F.col("prediction").alias("manhattan3"))
    mean = models.knn_predict(train, test, "row_id", cols, "r", 5, regression=True).select("row_id", F.round("prediction", 6).alias("mean5"))
    return five.join(three, "row_id").join(mean, "row_id")


@query("md_linsvm")
def md_linsvm(spark, sf):
    train, test = _train_test(spark, sf)
    return _score(LinearSVC(labelCol="label", maxIter=50).fit(train).transform(test))


@query("md_kernelsvm")
def md_kernelsvm(spark, sf):
    """rbf, polynomial and sigmoid kernels on standardised features."""
    train, test = _train_test(spark, sf)
    scaler = ColumnScaler(inputCols=X, kind="standard").fit(train)
    a, b = cut_lineage(scaler.transform(train)), scaler.transform(test)
    out = None
    for kind in ("rbf", "poly", "sigmoid"):
        part = _score(models.fit_kernel_svm(a, X, "label", "row_id", kind).transform(b)).select(F.lit(kind).alias("kernel"), "*")
        out = part if out is None else out.unionByName(part)
    return out


@query("md_svr")
def md_svr(spark, sf):
    """Kernel regression; the explicit map makes its cost linear in the rows, so none are left out."""
    train, test = _train_test(spark, sf)
    scaler = ColumnScaler(inputCols=X, kind="standard").fit(train)
    a, b = cut_lineage(scaler.transform(train)), scaler.transform(test)
    out = None
    for kind in ("linear", "rbf", "poly", "sigmoid"):
        kernel, fitted = models.fit_kernel_regression(a, X, "y", "row_id", kind)
        part = _regress(fitted.transform(kernel.transform(b))).select(F.lit(kind).alias("kernel"), "*")
        out = part if out is None else out.unionByName(part)
    return out


def _two_target_stages(trees=10):
    return [
        ColumnScaler(inputCols=X, kind="standard"),
        VectorAssembler(inputCols=X, outputCol="x"),
        GBTRegressor(featuresCol="x", labelCol="y", predictionCol="y_hat", maxIter=trees, maxDepth=4, stepSize=0.3, seed=42),
        GBTRegressor(featuresCol="x", labelCol="y2", predictionCol="y2_hat", maxIter=trees, maxDepth=4, stepSize=0.3, seed=42),
    ]


@query("md_multiout")
def md_multiout(spark, sf):
    data = training_table(lessons(spark, sf), "row_id")
    fitted = Pipeline(stages=_two_target_stages()).fit(data.where("is_train"))
    return metrics.multi_target_metrics(
        fitted.transform(data.where("NOT is_train")), {"y": ("y", "y_hat"), "y2": ("y2", "y2_hat")}, {"y": 0.9, "y2": 0.9}
    )


@query("md_importance")
def md_importance(spark, sf):
    """Importances joined with the method that filled each feature."""
    train, _ = _train_test(spark, sf)
    fitted = models.forest(trees=20, depth=6).fit(train)
    methods = impute.strategy_frame(spark, {"v": "knn", "k": "mice", "h": "none"})
    return models.importances(fitted, X, spark).join(methods, "feature", "left").orderBy(F.col("importance").desc(), "feature")


# ---- stacking --------------------------------------------------------------


class _KernelSvm:
    """The rbf machine as a base of a stack; its map does not follow the rows, so folds share the mapped table."""

    def __init__(self):
        self.kernel = models.KernelMap("rbf", X, 1.0 / len(X))

    def prepared(self, df, fold):
        self.kernel.fit(df, "row_id")
        return self.kernel.transform(for_steps(df)).select(fold, "label", "kernel_features")

    def fit(self, mapped):
        return models.fit_mapped_svm(mapped, self.kernel, "label")


@query("en_stack_cls")
def en_stack_cls(spark, sf):
    """Out-of-fold stack of five bases under a logistic, a forest and a boosted meta model."""
    train, test = _train_test(spark, sf)
    train, test = experiments.scaled_pair(train.drop("features"), test.drop("features"), X, "standard")
    folded = cut_lineage(models.balanced(split.kfold(train, "row_id", 5, seed=9), "label"))
    boost = Boosting("label", weight="weight", n_estimators=STACK_TREES, subsample=0.8)
    bases = {
        "svm": _KernelSvm(),
        "forest": Forest("label", weight="weight", classes=True, trees=STACK_TREES, max_depth=FOREST_DEPTH, least=2, tries=ROOT),
        "gbt": replace(boost, newton=False),
        "xgb": replace(boost, colsample=0.8, reg_lambda=1.0, min_child_weight=1.0),
        "lgbm": replace(boost, colsample=0.8, min_child_samples=20, num_leaves=31),
    }
    metas = {
        "logistic": LogisticRegression(),
        "forest": models.forest(trees=STACK_META_TREES, depth=10),
        "gbt": models.boosted(n_estimators=STACK_META_TREES, learning_rate=0.1, max_depth=3),
    }
    stacks = ensemble.fit_stacks(folded, bases, metas, k=5, features=X)
    one = next(iter(stacks.values()))  # all stacks have the same bases
    scored = cut_lineage(ensemble.member_outputs(for_steps(test), one.bases).select("row_id", "label", *[f"z_{n}" for n in one.names]))
    out = None
    for name, stack in stacks.items():
        part = _score(stack.combined(scored)).select(F.lit(name).alias("meta"), "*")
        out = part if out is None else out.unionByName(part)
    return out


def _stack_reg_parts(spark, sf):
    train, test = _train_test(spark, sf)
    folded = cut_lineage(split.kfold(train, "row_id", 5, seed=9))
    boost = Boosting("y", logistic=False, n_estimators=STACK_TREES)
    bases = {
        "xgb": replace(boost, learning_rate=0.3, max_depth=6, reg_lambda=1.0, min_child_weight=1.0),
        "forest": Forest("y", trees=STACK_TREES, max_depth=FOREST_DEPTH),
        "gbt": replace(boost, max_depth=3, newton=False),
        "extra": Forest("y", trees=STACK_TREES, max_depth=FOREST_DEPTH, bootstrap=False, cuts="random"),
        "ridge": models.ridge(train, "y"),
        "lasso": models.lasso("y"),
    }
    return folded, test, bases, models.ridge(train, "y")


@query("en_stack_reg")
def en_stack_reg(spark, sf):
    folded, test, bases, meta = _stack_reg_parts(spark, sf)
    return _regress(ensemble.fit_stack(folded, bases, meta, label="y", k=5, features=X).transform(test))


@query("en_weights")
def en_weights(spark, sf):
    """Weights of the stack's meta model, which needs the out-of-fold models only."""
    folded, _, bases, meta = _stack_reg_parts(spark, sf)
    fitted = ensemble.fit_bases(folded, bases, "row_id", "fold", 5, X, whole=False)
    metas = ensemble.fit_metas(folded, list(bases), fitted, {"": meta}, "row_id", "y", "fold", 5)
    return ensemble.meta_weights(metas[""], list(bases), spark)


@query("en_members")
def en_members(spark, sf):
    """Soft and hard vote and the regressors' mean, with fitted members."""
    train, test = _train_test(spark, sf)
    members = ensemble.fit_members(train, {"tree": models.tree(depth=5), "nb": models.gaussian_bayes(), "lr": LogisticRegression(labelCol="label")})
    soft = _score(ensemble.voting_classifier(test, members, True)).select(F.lit("soft").alias("kind"), F.col("accuracy").alias("metric"))
    hard = metrics.binary_metrics(ensemble.voting_classifier(test, members, False)).select(F.lit("hard").alias("kind"), F.col("accuracy").alias("metric"))
    regs = ensemble.fit_members(train, {"lasso": models.lasso("y"), "forest": models.forest("y", trees=10, depth=6, regression=True)})
    mean = _regress(ensemble.voting_regressor(test, regs)).select(F.lit("mean").alias("kind"), F.col("r2_score").alias("metric"))
    return soft.unionByName(hard).unionByName(mean)


# ---- experiments -----------------------------------------------------------


@query("ex_grid")
def ex_grid(spark, sf):
    """Exhaustive grids of three learners under fixed folds; the best of each on the held-out rows.

    Numbers of trees are prefixes of the largest model. The boosted models of all folds, steps and
    depths grow together, and so do the forests.
    """
    train, test = _train_test(spark, sf)
    folds, (small, large) = 3, GRID_TREES
    folded = cut_lineage(split.kfold(train, "row_id", folds, seed=3)).withColumns({f"_in{i}": F.col("fold") != i for i in range(folds)})
    specs = {}
    for name, kind in (("XGBoost", {"reg_lambda": 1.0, "min_child_weight": 1.0}), ("GradientBoosting", {"newton": False})):
        for depth, step, i in product((5, 7), (0.1, 0.2), (*range(folds), None)):
            rows = "" if i is None else f"_in{i}"
            specs[name, depth, step, i] = Boosting("y", rows=rows, logistic=False, n_estimators=large, learning_rate=step, max_depth=depth, **kind)

    def forest(depth, least, i):
        return Forest("y", rows="" if i is None else f"_in{i}", trees=large, max_depth=depth, least=least)

    grown = {("RandomForest", d, n, i): forest(d, n, i) for d, n, i in product((10, 20), (1, 2), range(folds))}
    both = {"boosted": lambda: fit_many(folded, specs, X, "row_id"), "forests": lambda: ensemble.fit_forest_batch(folded, grown, X, "row_id")}
    found = ensemble.fit_side_by_side(both)
    fitted = {**found["boosted"], **found["forests"]}

    def errors(model, df):
        return model.errors(df, "y", (small, large)) if hasattr(model, "errors") else models.forest_errors(model, df, "y", (small, large))

    parts = {i: cut_lineage(folded.where(F.col("fold") == i)) for i in range(folds)} | {None: cut_lineage(test)}
    spread = {i: df.agg(F.var_pop("y")).first()[0] for i, df in parts.items()}
    found = ensemble.fit_side_by_side({key: lambda key=key, m=m: errors(m, parts[key[3]]) for key, m in fitted.items()})
    scores = {(*key[:3], n, key[3]): 1.0 - e / spread[key[3]] for key, by_size in found.items() for n, e in by_size.items()}
    rows = []
    for name, depth, third, n in sorted({key[:4] for key in scores}):
        each = [scores[name, depth, third, n, i] for i in range(folds)]
        rows.append((name, depth, n, None if name == "RandomForest" else third, third if name == "RandomForest" else 1, float(np.mean(each)), float(np.std(each))))
    held = {}
    for name in {r[0] for r in rows}:
        _, depth, n, step, least, _, _ = max((r for r in rows if r[0] == name), key=lambda r: r[5])
        if name == "RandomForest":
            best = errors(ensemble.fit_forest_batch(folded, {"": forest(depth, least, None)}, X, "row_id")[""], parts[None])[n]
        else:
            best = found[name, depth, step, None][n]
        held[name] = 1.0 - best / spread[None]
    schema = "model string, max_depth int, trees int, step double, min_rows int, cv_r2 double, cv_r2_std double, test_r2_of_best double"
    return spark.createDataFrame([(*r, float(held[r[0]])) for r in rows], schema).orderBy(F.col("cv_r2").desc(), "model", "max_depth", "trees")


@query("ex_matrix")
def ex_matrix(spark, sf):
    """Three models with four scalers, plus one that must fail and be recorded."""
    train, test = _train_test(spark, sf)
    zoo = {
        "Logistic Regression": lambda a: LogisticRegression(labelCol="label"),
        "Decision Tree": lambda a: models.tree(depth=6),
        "Naive Bayes": lambda a: models.gaussian_bayes(),
        "Unsupported": lambda a: models.boosted(reg_lambda=1.0),
    }
    board = experiments.model_scaler_matrix(train.drop("features"), test.drop("features"), X, "label", zoo, ["none", "standard", "minmax", "robust"])
    return board.select("model", "scaler", "accuracy", "precision", "recall", "f1_score", "roc_auc", "training_time_s", "error")


@query("ex_trees")
def ex_trees(spark, sf):
    """Error by number of trees, each learner fitted once at the largest number."""
    train, test = _train_test(spark, sf)
    sizes = CURVE_TREES
    boost = Boosting("y", logistic=False, n_estimators=sizes[-1])
    specs = {"XGBoost": replace(boost, learning_rate=0.3, max_depth=6, reg_lambda=1.0, min_child_weight=1.0), "GradientBoosting": replace(boost, max_depth=3, newton=False)}
    forest = {"RandomForest": Forest("y", trees=sizes[-1], max_depth=FOREST_DEPTH)}
    both = {"boosted": lambda: fit_many(train, specs, X, "row_id"), "forest": lambda: ensemble.fit_forest_batch(train, forest, X, "row_id")}
    fitted = ensemble.fit_side_by_side(both)
    errors = {name: m.errors(test, "y", sizes) for name, m in fitted["boosted"].items()}
    for name, m in fitted["forest"].items():
        errors[name] = m.errors(test, "y", sizes) if hasattr(m, "errors") else models.forest_errors(m, test, "y", sizes)
    spread = test.agg(F.var_pop("y")).first()[0]
    rows = [(name, n, float(e), float(1.0 - e / spread)) for name, by_size in errors.items() for n, e in by_size.items()]
    return spark.createDataFrame(rows, "model string, n_estimators int, mse double, r2_score double")


def _regression_runs(spark, sf, tasks):
    exp = Experiment(spark, "row_id", "y")
    exp.run_all(tasks)
    return exp.regression_board()


@query("ex_learning")
def ex_learning(spark, sf):
    """Ten nested shares of the training rows."""
    train, test = _train_test(spark, sf)

    def fit(share):
        part = split.sample_fraction(train, "row_id", share, seed=8)
        return GBTRegressor(labelCol="y", maxIter=8, maxDepth=4, stepSize=0.3, seed=42).fit(part).transform(test)

    tasks = [(f"{i / 10:.1f}", "gbt", "none", lambda i=i: fit(i / 10)) for i in range(1, 11)]
    return _regression_runs(spark, sf, tasks).select(F.col("run").cast("double").alias("data_share"), "r2_score", "mae").orderBy("data_share")


@query("ex_scaler")
def ex_scaler(spark, sf):
    train, test = _train_test(spark, sf)

    def fit(kind):
        a, b = experiments.scaled_pair(train.drop("features"), test.drop("features"), X, kind)
        return models.ridge(a, "y").fit(a).transform(b)

    tasks = [(k, "ridge", k, lambda k=k: fit(k)) for k in ("none", "standard", "minmax", "robust")]
    return _regression_runs(spark, sf, tasks).select("scaler", "r2_score", "mae")


@query("ex_seeds")
def ex_seeds(spark, sf):
    """Five splits: train and test metrics, then their spread."""
    data = training_table(models.assemble(lessons(spark, sf).drop("is_train"), X), "row_id")
    exp = Experiment(spark, "row_id", "y")

    def fit(cut):
        return models.boosted("y", True, n_estimators=6, max_depth=4, learning_rate=0.3).fit(cut.where("is_train"))

    cuts = {s: split.random_split(data, "row_id", seed=s) for s in (42, 123, 456, 789, 1024)}
    fitted = ensemble.fit_side_by_side({s: lambda cut=cut: fit(cut) for s, cut in cuts.items()})  # one fit for both parts

    def scored(seed, part):
        return fitted[seed].transform(cuts[seed].where("is_train" if part == "train" else "NOT is_train"))

    exp.run_all([(f"{p}:{s}", p, "none", lambda s=s, p=p: scored(s, p)) for s in cuts for p in ("train", "test")])
    board = exp.regression_board().withColumn("part", F.col("model"))
    return experiments.fold_stats(board, ["r2_score", "mae", "mse"], ["part"])


@query("ex_strategies")
def ex_strategies(spark, sf):
    """Eight ways to reduce error and bias, ranked by MAE against the plain model."""
    train, test = _train_test(spark, sf)

    def gbt(label="y", **kw):
        return models.boosted(label, True, **{"n_estimators": 10, "learning_rate": 0.3, "max_depth": 4, **kw})

    def plain():
        return gbt().fit(train).transform(test)

    def robust():
        a, b = experiments.scaled_pair(train.drop("features"), test.drop("features"), X, "robust")
        return gbt().fit(a).transform(b)

    def logged():
        from tabforge.functions.scalar import log_target, unlog_target

        lo = train.agg(F.min("y")).first()[0]
        out = gbt("y_log").fit(train.withColumn("y_log", log_target("y", lo))).transform(test)
        return out.withColumn("prediction", unlog_target("prediction", lo))

    def corrected():
        fitted = gbt().fit(train)
        return ensemble.bias_corrected(fitted.transform(train), fitted.transform(test), "y", "prediction")

    ways = {
        "Baseline": plain,
        "Lower LR": lambda: gbt(n_estimators=20, learning_rate=0.1).fit(train).transform(test),
        "Regularization": lambda: gbt(gamma=0.1).fit(train).transform(test),
        "Subsampling": lambda: gbt(subsample=0.8, colsample=0.8).fit(train).transform(test),
        "RobustScaler": robust,
        "Log Transform": logged,
        "Bias Correction": corrected,
        "Optimized": lambda: gbt(n_estimators=20, learning_rate=0.2, subsample=0.8, min_child_weight=3).fit(train).transform(test),
    }
    board = _regression_runs(spark, sf, [(name, name, "none", make) for name, make in ways.items()])
    return experiments.against_first(board, "mae", "Baseline").select("run", "r2_score", "mae", "rmse", "bias", "better_pct", "error").orderBy("mae")


@query("ex_imputers")
def ex_imputers(spark, sf):
    """One classifier under 3-fold CV on differently imputed tables, imputer fitted inside the fold."""
    r = cut_lineage(split.kfold(readings(spark, sf).select("row_id", *GAP_COLUMNS, "label"), "row_id", 3, seed=4))
    makers = {
        "median": impute.ColumnImputer(inputCols=GAP_COLUMNS, strategy="median"),
        "knn": impute.KnnImputer(inputCols=GAP_COLUMNS, k=5),
        "mice": mice.ChainedLinearImputer(inputCols=GAP_COLUMNS),
    }
    out = None
    for name, imputer in makers.items():

        def make(train, test, imputer=imputer):
            filler = imputer.fit(train)
            filled = cut_lineage(filler.transform(train))  # the tree scans it several times
            a, b = models.assemble(filled, GAP_COLUMNS), models.assemble(filler.transform(test), GAP_COLUMNS)
            return models.tree(depth=5).fit(a).transform(b)

        part = experiments.cross_validate(r, make, "row_id", "label", 3).select(F.lit(name).alias("imputer"), "auc_mean", "auc_std", "accuracy_mean")
        out = part if out is None else out.unionByName(part)
    return out


@query("ex_time")
def ex_time(spark, sf):
    """Wall time of fits, measured around the write of their predictions."""
    train, test = _train_test(spark, sf)
    exp = Experiment(spark, parallel=1)
    exp.run_all(
        [
            ("lr", "lr", "none", lambda: LogisticRegression(labelCol="label").fit(train).transform(test)),
            ("nb", "nb", "none", lambda: models.gaussian_bayes().fit(train).transform(test)),
        ]
    )
    return exp.runs().select("run", (F.col("training_time_s") > 0).cast("int").alias("timed"), "training_time_s")


# ---- outlier experiments ---------------------------------------------------


def _sweep_detectors():
    """Four detectors at three levels each; each takes rows in standard units. Levels of a detector share its scores."""
    detectors = {f"z {limit}": lambda d, limit=limit: outliers.zscore_flags(d, X, limit) for limit in (2.5, 3.0, 3.5)}
    kinds = {"iforest": outliers.isolation_scored, "lof": outliers.lof_scored, "envelope": outliers.envelope_scored}
    for name, kind in kinds.items():
        scores = outliers.Scores(kind, "row_id", X)
        for share in (0.05, 0.10, 0.15):
            detectors[f"{name} {share:.2f}"] = lambda d, scores=scores, share=share: scores.flags(d, share)
    return detectors


@query("out_sweep")
def out_sweep(spark, sf):
    """Detectors at several levels: rows removed and 5-fold CV metrics before and after, ranked by AUC.

    The detectors run side by side, and the boosted models of all detectors and folds grow in the same passes; a model takes
    the rows its detector keeps outside of its fold. Trees follow the order of a feature's values alone, so a scaler changes nothing.
    """
    folds = 5
    data = training_table(split.kfold(lessons(spark, sf), "row_id", folds, seed=4), "row_id")
    scaled = cut_lineage(ColumnScaler(inputCols=X, kind="standard").fit(data).transform(data).select("row_id", *X))
    detectors = _sweep_detectors()
    flags = ensemble.fit_side_by_side({n: lambda f=f: cut_lineage(f(scaled).where("is_inlier").select("row_id")) for n, f in detectors.items()})
    names = ["none", *detectors]
    marked = data.withColumn("_d0", F.lit(True))
    for d, name in enumerate(names[1:], 1):
        marked = marked.join(flags[name].withColumn(f"_d{d}", F.lit(True)), "row_id", "left")
    keys = list(product(range(len(names)), range(folds)))
    marked = marked.withColumns({f"_d{d}": F.coalesce(f"_d{d}", F.lit(False)) for d in range(len(names))})
    marked = training_table(marked.withColumns({f"_in{d}_{i}": F.col(f"_d{d}") & (F.col("fold") != i) for d, i in keys}), "row_id")
    spec = Boosting("label", n_estimators=SWEEP_TREES, learning_rate=0.05, max_depth=5)
    fitted = fit_many(marked, {k: replace(spec, rows=f"_in{k[0]}_{k[1]}") for k in keys}, X, "row_id")
    scored = None
    for i in range(folds):
        rows = marked.where(F.col("fold") == i)
        each = [F.struct(F.lit(d).alias("d"), F.col(f"_d{d}").alias("kept"), fitted[d, i].margin().alias("margin")) for d in range(len(names))]
        part = rows.select("row_id", "fold", F.col("label").cast("double").alias("label"), F.explode(F.array(*each)).alias("x"))
        scored = part if scored is None else scored.unionByName(part)
    method = F.element_at(F.array(*[F.lit(n) for n in names]), F.col("x.d") + 1).alias("method")
    kept = cut_lineage(
        scored.where("x.kept").select("row_id", "fold", "label", method, F.col("x.margin").alias("score"), (F.col("x.margin") > 0).cast("double").alias("prediction"))
    )
    total = data.count()
    sizes = kept.groupBy("method").agg(F.count("*").alias("samples"))
    m = experiments.cross_validated_metrics(kept, by=["method"]).join(sizes, "method")
    removed = F.lit(total) - F.col("samples")
    return m.select(
        "method",
        "samples",
        removed.alias("removed"),
        (100.0 * removed / total).alias("removed_pct"),
        F.col("auc_mean").alias("cv_auc"),
        F.col("auc_std").alias("cv_auc_std"),
        F.col("accuracy_mean").alias("cv_accuracy"),
        F.col("f1_score_mean").alias("cv_f1"),
    ).orderBy(F.col("cv_auc").desc(), "method")


@query("out_impute_scale_detect")
def out_impute_scale_detect(spark, sf):
    """Impute, scale, detect, filter, fit: all fitted on training rows; the filter never touches test rows."""
    r = cut_lineage(split.stratified_split(readings(spark, sf).select("row_id", *GAP_COLUMNS, "label"), "row_id", "label"))
    train, test = r.where("is_train"), r.where("NOT is_train")
    filler = mice.ChainedLinearImputer(inputCols=GAP_COLUMNS).fit(train)
    scaler = ColumnScaler(inputCols=GAP_COLUMNS, kind="standard").fit(filler.transform(train))

    def ready(df):
        return scaler.transform(filler.transform(df))

    kept = outliers.isolation_flags(ready(train), "row_id", GAP_COLUMNS, 0.10).where("is_inlier")
    a, b = models.assemble(kept, GAP_COLUMNS), models.assemble(ready(test), GAP_COLUMNS)
    return _score(models.boosted(n_estimators=200, learning_rate=0.05, max_depth=5).fit(a).transform(b))


# ---- registry --------------------------------------------------------------


@query(
    "rg_best",
    with_sql(
        RUNS_SQL,
        "SELECT model, normalization, roc_auc, CASE WHEN model LIKE '%Voting%' OR model LIKE '%Stacking%' THEN 'Ensemble' WHEN model LIKE '%GridSearch%' THEN 'GridSearch' ELSE 'Individual' END AS type FROM runs ORDER BY roc_auc DESC, model, normalization LIMIT 1",
    ),
)
def rg_best(spark, sf):
    """Best over individual and ensemble tables together."""
    from tabforge.functions.scalar import model_type

    r = runs(spark, sf).withColumn("type", model_type("model"))
    singles, groups = r.where("type <> 'Ensemble'"), r.where("type = 'Ensemble'")
    return leaderboard.best_row(singles.unionByName(groups), "roc_auc", ["model", "normalization"]).select("model", "normalization", "roc_auc", "type")


@query(
    "rg_gate",
    with_sql(
        RUNS_SQL
        + """, p AS (SELECT max(roc_auc) - 0.002e0 AS best_auc, max(accuracy) - 0.002e0 AS best_accuracy, CAST(sum(CAST(training_time_s AS DECIMAL(18, 6))) AS DOUBLE) / count(*) AS best_drift FROM runs)""",
        """SELECT model, normalization, CAST(roc_auc > best_auc OR accuracy > best_accuracy OR (training_time_s < best_drift AND roc_auc >= best_auc * 0.995) AS INTEGER) AS save,
        concat_ws(',', CASE WHEN roc_auc > best_auc THEN 'auc' END, CASE WHEN accuracy > best_accuracy THEN 'accuracy' END, CASE WHEN training_time_s < best_drift THEN 'drift' END) AS reasons FROM runs, p""",
    ),
)
def rg_gate(spark, sf):
    r = runs(spark, sf)
    previous = r.agg(
        (F.max("roc_auc") - 0.002).alias("best_auc"), (F.max("accuracy") - 0.002).alias("best_accuracy"), exact_mean("training_time_s").alias("best_drift")
    )
    out = leaderboard.gate(r, previous, "roc_auc", "accuracy", "training_time_s")
    return out.select("model", "normalization", "save", "reasons")


@query(
    "rg_compare",
    with_sql(
        _TWO_RUNS_SQL,
        """SELECT model, a.best AS metric_a, b.best AS metric_b, round(b.best - a.best, 6) AS delta,
        CASE WHEN abs((b.best - a.best) * 100) < 0.5 THEN 'comparable' WHEN b.best > a.best THEN 'improved' ELSE 'degraded' END AS verdict FROM run_a a JOIN run_b b USING (model)""",
    ),
)
def rg_compare(spark, sf):
    a, b = _two_runs(spark, sf)
    return rounded(leaderboard.comparison_report(a, b, "accuracy"), 6, "delta")


# ---- serving ---------------------------------------------------------------


def _served_model(train):
    stages = [
        ColumnScaler(inputCols=X, kind="standard"),
        VectorAssembler(inputCols=X, outputCol="features"),
        LogisticRegression(labelCol="label"),
    ]
    return Pipeline(stages=stages).fit(train)


@query("sv_batch")
def sv_batch(spark, sf):
    """Score held-out rows with a stored and reloaded model."""
    from tabforge.sources import readers, writers

    data = lessons(spark, sf)
    path = scratch_path(spark, "served")
    writers.write_model(_served_model(data.where("is_train")), path)
    return serve.score_table(readers.read_model(path), data.where("NOT is_train").select("row_id", *X), X, ["row_id"])


@query("sv_multi")
def sv_multi(spark, sf):
    data = lessons(spark, sf)
    fitted = Pipeline(stages=_two_target_stages(5)).fit(data.where("is_train"))
    new = data.where("NOT is_train").select("row_id", *X)
    return serve.score_targets(fitted, new, X, {"y_hat": "y", "y2_hat": "y2"}, ["row_id"])


@query("sv_stream")
def sv_stream(spark, sf):
    """Rows arriving as files are scored by a stream; the result equals the batch scores."""
    from tabforge.streaming.scoring import file_stream, score_stream

    data = lessons(spark, sf)
    fitted = _served_model(data.where("is_train"))
    landing, out, state = (scratch_path(spark, n) for n in ("landing", "scored", "offsets"))
    new = data.where("NOT is_train").select("row_id", *X)
    new.repartition(4).write.parquet(landing)
    q = score_stream(fitted, file_stream(spark, landing, new.schema, 2), X, ["row_id"], out, state)
    q.awaitTermination()
    streamed = spark.read.parquet(out)
    batch = serve.score_table(fitted, new, X, ["row_id"]).select("row_id", F.col("risk").alias("batch_risk"))
    return streamed.join(batch, "row_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.abs(F.col("risk") - F.col("batch_risk")) > 1e-9).alias("n_different")
    )


@query(
    "sv_drift_windows",
    """SELECT CAST(epoch(time_bucket(INTERVAL 1 DAY, ts)) AS BIGINT) AS day_start, count(*) AS n, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std FROM events GROUP BY 1""",
)
def sv_drift_windows(spark, sf):
    """The drift monitor's windows over all events (same code as the stream)."""
    from tabforge.streaming.scoring import drift_windows

    out = drift_windows(table(spark, sf, "events").select("ts", "value"), "ts", "value", "1 day")
    return out.select(
        F.unix_timestamp("window_start").alias("day_start"), "n", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std")
    )
