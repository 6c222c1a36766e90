"""Learners, stacking, experiments, serving and streams."""

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tabforge.functions.rng import uniform
from tabforge.operators import ensemble, experiments, models, serve, split
from tabforge.operators.encode import ColumnScaler, LabelCoder, SentinelCleaner
from tabforge.operators.impute import ColumnImputer, HybridImputerModel, KnnImputer
from tabforge.operators.mice import ChainedLinearImputer
from tabforge.plans import load_all
from tabforge.plans.catalog import QUERIES
from tabforge.streaming import scoring


@pytest.fixture(scope="module")
def planted(spark):
    df = spark.range(600).select(
        F.col("id").alias("row_id"), uniform("id", 1).alias("a"), uniform("id", 2).alias("b"), uniform("id", 3).alias("c")
    )
    df = df.withColumn("label", (F.col("a") + 0.5 * F.col("b") > 0.75).cast("int"))
    df = df.withColumn("y", 3 * F.col("a") - 2 * F.col("b") + 1)
    return models.assemble(df, ["a", "b", "c"]).cache()


def _accuracy(df):
    return df.agg(F.avg((F.col("prediction") == F.col("label")).cast("double"))).first()[0]


def test_boosted_rejects_unknown_parameters():
    for name in ("reg_alpha", "reg_lambda", "num_leaves"):
        with pytest.raises(ValueError):
            models.boosted(**{name: 1})


def test_linear_models_match_closed_form(planted):
    x = np.array([[r.a, r.b, r.c] for r in planted.collect()])
    y = np.array([r.y for r in planted.collect()])
    xc, yc = x - x.mean(0), y - y.mean()
    alpha = 5.0
    want = np.linalg.solve(xc.T @ xc + alpha * np.eye(3), xc.T @ yc)
    assert list(models.ridge(planted, "y", alpha).fit(planted).coefficients) == pytest.approx(list(want), abs=1e-4)
    # coordinate descent for the other two, mean loss / 2 + alpha * (rho |w| + (1 - rho) / 2 w^2)
    n = len(y)
    for rho, learner in ((1.0, models.lasso("y", 0.1)), (0.5, models.elastic_net(planted, "y", 0.1))):
        w = np.zeros(3)
        for _ in range(500):
            for j in range(3):
                r = yc - xc @ w + xc[:, j] * w[j]
                z = xc[:, j] @ r / n
                w[j] = np.sign(z) * max(abs(z) - 0.1 * rho, 0) / (xc[:, j] @ xc[:, j] / n + 0.1 * (1 - rho))
        assert list(learner.fit(planted).coefficients) == pytest.approx(list(w), abs=2e-3)


def test_samme_first_weight(spark):
    """One stump with error 1/4 has the vote log(3)."""
    rows = [(0.0, 0), (1.0, 0), (2.0, 0), (3.0, 1), (4.0, 1), (5.0, 1), (6.0, 0), (7.0, 0)]
    df = models.assemble(spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(rows)], "row_id long, x double, label int"), ["x"])
    m = models.fit_samme(df, rounds=1)
    error = 1 - _accuracy(m.transform(df))
    assert m.alphas[0] == pytest.approx(np.log((1 - error) / error))


def test_samme_beats_one_stump(planted):
    one = _accuracy(models.fit_samme(planted, rounds=1).transform(planted))
    many = _accuracy(models.fit_samme(planted, rounds=8).transform(planted))
    assert many > one


def test_one_vs_rest_probabilities(planted):
    df = planted.withColumn("cls", F.floor(F.col("a") * 3).cast("int"))
    out = models.fit_one_vs_rest(df, "cls", ["a", "b", "c"], "row_id", n_estimators=3, max_depth=3, learning_rate=0.3).transform(df)
    sums = [sum(r.probabilities) for r in out.collect()]
    assert sums == pytest.approx([1.0] * len(sums))
    assert out.agg(F.avg((F.col("prediction") == F.col("cls")).cast("double"))).first()[0] > 0.9


@pytest.mark.parametrize("kind", ["rbf", "poly", "sigmoid"])
def test_kernel_svm_beats_majority(planted, kind):
    scaled = ColumnScaler(inputCols=["a", "b", "c"]).fit(planted).transform(planted.drop("features"))
    out = models.fit_kernel_svm(scaled, ["a", "b", "c"], "label", "row_id", kind).transform(scaled)
    share = planted.agg(F.avg("label")).first()[0]
    assert _accuracy(out) > max(share, 1 - share) + 0.1


def test_out_of_fold_rows_come_from_other_folds(planted):
    """A learner that memorises its rows must not see the row it scores."""

    class Memory:
        def fit(self, train):
            return MemoryModel({r.row_id for r in train.select("row_id").collect()})

    class MemoryModel:
        def __init__(self, ids):
            self.ids = ids

        def transform(self, df):
            return df.withColumn("prediction", F.col("row_id").isin(list(self.ids)).cast("double"))

    folded = split.kfold(planted, "row_id", 3)
    fitted = ensemble.fit_bases(folded, {"m": Memory()}, "row_id", "fold", 3, whole=False)
    out = ensemble.out_of_fold(folded, ["m"], fitted, "row_id", "label", "fold", 3)
    assert out.count() == 600
    assert out.agg(F.max("z_m")).first()[0] == 0.0


def test_stack_beats_majority(planted):
    folded = split.kfold(planted, "row_id", 3)
    bases = {"tree": models.tree(depth=3), "nb": models.gaussian_bayes()}
    out = ensemble.fit_stack(folded, bases, LogisticRegression(), k=3).transform(planted)
    assert _accuracy(out) > 0.85


def test_soft_vote_lies_between_members(planted):
    members = ensemble.fit_members(planted, {"tree": models.tree(depth=3), "nb": models.gaussian_bayes()})
    out = ensemble.voting_classifier(planted, members)
    bad = out.where((F.col("score") < F.least("z_tree", "z_nb") - 1e-9) | (F.col("score") > F.greatest("z_tree", "z_nb") + 1e-9))
    assert bad.count() == 0


def test_failed_run_is_recorded(planted):
    def fail():
        raise ValueError("no such model")

    exp = experiments.Experiment(planted.sparkSession)
    exp.run_all(
        [
            ("good", "lr", "none", lambda: LogisticRegression(labelCol="label").fit(planted).transform(planted)),
            ("bad", "x", "none", fail),
        ]
    )
    rows = {r.run: r for r in exp.leaderboard().collect()}
    assert rows["good"].error is None and rows["good"].roc_auc > 0.9
    assert rows["bad"].accuracy is None and "no such model" in rows["bad"].error


def test_knn_vote_and_mean(spark):
    train = spark.createDataFrame([(1, 0.0, 0), (2, 1.0, 0), (3, 10.0, 1), (4, 11.0, 1), (5, 12.0, 1)], "row_id long, x double, label int")
    test = spark.createDataFrame([(9, 0.4), (10, 10.6)], "row_id long, x double")
    out = {r.row_id: (r.prediction, r.score) for r in models.knn_predict(train, test, "row_id", ["x"], "label", 3).collect()}
    assert out == {9: (0, pytest.approx(1 / 3)), 10: (1, 1.0)}
    near = {r.row_id: r.prediction for r in models.knn_predict(train, test, "row_id", ["x"], "x", 2, regression=True, weights="distance").collect()}
    assert near[9] == pytest.approx((0 / 0.4 + 1 / 0.6) / (1 / 0.4 + 1 / 0.6))


def test_whole_chain_saves_and_loads(spark, planted, tmp_path):
    raw = planted.select("row_id", "label", F.when(F.col("row_id") % 5 != 0, F.col("a")).alias("a"), "b").withColumn(
        "kind", F.when(F.col("b") > 0.5, "x").otherwise("y")
    )
    stages = [
        SentinelCleaner(rules='{"b": 0.0}'),
        LabelCoder(inputCols=["kind"]),
        ColumnImputer(inputCols=["a", "b"], strategy="mean"),
        ColumnScaler(inputCols=["a", "b"], kind="robust"),
        VectorAssembler(inputCols=["a", "b", "kind"], outputCol="features"),
        LogisticRegression(labelCol="label"),
    ]
    fitted = Pipeline(stages=stages).fit(raw)
    fitted.write().overwrite().save(str(tmp_path / "m"))
    from tabforge.sources.readers import read_model

    a = [r.prediction for r in fitted.transform(raw).orderBy("row_id").collect()]
    assert a == [r.prediction for r in read_model(str(tmp_path / "m")).transform(raw).orderBy("row_id").collect()]


def test_hybrid_model_saves_and_loads(spark, planted, tmp_path):
    gappy = planted.select("row_id", F.when(F.col("row_id") % 4 != 0, F.col("a")).alias("a"), F.when(F.col("row_id") % 7 != 0, F.col("b")).alias("b"), "c")
    cols = ["a", "b", "c"]
    fitted = {
        "knn": KnnImputer(inputCols=cols, k=3, donorsPath=str(tmp_path / "donors")).fit(gappy),
        "mice": ChainedLinearImputer(inputCols=cols).fit(gappy),
    }
    hybrid = HybridImputerModel(fitted, {"a": "mice"})
    hybrid.save(spark, str(tmp_path / "h"))
    loaded = HybridImputerModel.load(spark, str(tmp_path / "h"))
    want = sorted(tuple(r) for r in hybrid.transform(gappy, cols).select("row_id", *cols).collect())
    got = sorted(tuple(r) for r in loaded.transform(gappy, cols).select("row_id", *cols).collect())
    assert got == want
    assert not any(None in r for r in got)


def test_serving_rejects_missing_columns(planted):
    with pytest.raises(ValueError):
        serve.check_columns(planted, ["a", "pressure"])


def test_stream_continues_from_its_checkpoint(spark, planted, tmp_path):
    fitted = Pipeline(stages=[VectorAssembler(inputCols=["a", "b"], outputCol="f2"), LogisticRegression(featuresCol="f2", labelCol="label")]).fit(planted)
    rows = planted.select("row_id", "a", "b")
    landing, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    for part in (0, 1):
        rows.where(F.col("row_id") % 2 == part).write.mode("append").parquet(landing)
        arriving = scoring.file_stream(spark, landing, rows.schema)
        scoring.score_stream(fitted, arriving, ["a", "b"], ["row_id"], out, state).awaitTermination()
        assert spark.read.parquet(out).count() == 300 * (part + 1)
    assert spark.read.parquet(out).select("row_id").distinct().count() == 600


def test_drift_monitor_closes_windows_behind_the_watermark(spark, tmp_path):
    rows = spark.range(48).select(
        F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 1800).alias("ts"), F.col("id").cast("double").alias("v")
    )
    rows.write.parquet(str(tmp_path / "in"))
    arriving = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    q = (
        scoring.drift_windows(arriving, "ts", "v")
        .writeStream.format("memory").queryName("drift_out").outputMode("append").trigger(availableNow=True).start()
    )
    q.awaitTermination()
    out = spark.table("drift_out")
    assert out.count() >= 20
    assert out.agg(F.max("n")).first()[0] == 2


def test_fits_do_not_follow_the_partitioning(spark):
    from pyspark.ml.classification import RandomForestClassifier

    from tabforge.session import training_table

    rows = spark.range(3000).selectExpr("id AS row_id", "double(xxhash64(id) % 100) AS a", "double(xxhash64(id, 1) % 100) AS b")
    rows = rows.withColumn("label", (F.col("a") + F.col("b") > 20).cast("double"))
    data = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(rows)
    forest = RandomForestClassifier(numTrees=5, subsamplingRate=0.5, seed=3)
    trees = {forest.fit(training_table(data.repartition(n), "row_id")).toDebugString.split("\n", 1)[1] for n in (1, 3, 8)}
    assert len(trees) == 1


def test_training_partitions_grow_slower_than_small_tables_would_have_it(spark, monkeypatch):
    from tabforge import session

    assert [session.training_partitions(n) for n in (0, 1, 2_001, 100_000)] == [1, 1, 2, 50]
    assert [session.training_partitions(n) for n in (600_000, 6_000_000, 36_000_000)] == [64, 120, 720]
    monkeypatch.setattr(session, "TRAINING_ROWS", 10)
    monkeypatch.setattr(session, "SMALL_PARTITIONS", 4)
    monkeypatch.setattr(session, "LARGE_ROWS", 100)
    data = session.training_table(spark.range(500).withColumnRenamed("id", "row_id"), "row_id")
    assert data.rdd.getNumPartitions() == 5 and data.distinct().count() == 500


# ---- full sizes ------------------------------------------------------------


load_all()


class Recorded(Exception):
    pass


def sizes_of(learner):
    return {p.name: v for p, v in learner.extractParamMap().items()}


@pytest.mark.parametrize(("name", "size"), [("md_gbt", {"maxIter": 100, "maxDepth": 5})])
def test_registered_learners_have_the_reference_sizes(spark, monkeypatch, name, size):
    from pyspark.ml import Estimator

    def fit(self, dataset, params=None):
        raise Recorded(self)

    monkeypatch.setattr(Estimator, "fit", fit)
    with pytest.raises(Recorded) as caught:
        QUERIES[name](spark, "/root/testdata/sf0.001")
    assert sizes_of(caught.value.args[0]).items() >= size.items()


#: Forests of the registered queries at full size: number of models, trees and depths.
FORESTS = {"md_rf": (2, {(100, 15), (150, 15)}), "md_extratrees": (1, {(150, 15)}), "en_weights": (10, {(150, 15)}), "en_stack_cls": (6, {(150, 15)}), "ex_grid": (12, {(200, 10), (200, 20)})}


@pytest.mark.parametrize("name", FORESTS)
def test_forests_have_the_registered_sizes(spark, monkeypatch, name):
    """The recorded sizes are whole; the query goes on to its end with four trees of depth three."""
    from dataclasses import replace

    from tabforge.operators import boosting, forests
    from tabforge.plans import learning

    seen = []

    def few_forests(df, specs, features, row_id, seed=42, limits=None):
        seen.append(list(specs.values()))
        return forests.fit_forests(df, {n: replace(s, trees=4, max_depth=3) for n, s in specs.items()}, features, row_id, seed, limits)

    def few_boosted(df, specs, features, row_id, seed=42):
        return boosting.fit_many(df, {n: replace(s, n_estimators=4) for n, s in specs.items()}, features, row_id, seed)

    monkeypatch.setattr(ensemble, "fit_forests", few_forests)
    for module in (learning, ensemble):
        monkeypatch.setattr(module, "fit_many", few_boosted)
    forest = models.forest
    monkeypatch.setattr(models, "boosted", lambda **kw: forest(trees=4, depth=3))  # the meta model
    if name == "ex_grid":
        errors = forests.ForestModel.errors
        monkeypatch.setattr(forests.ForestModel, "errors", lambda self, df, y, sizes: dict(zip(sizes, errors(self, df, y, (2, 4)).values())))
        boosted_errors = boosting.BoostedModel.errors
        monkeypatch.setattr(boosting.BoostedModel, "errors", lambda self, df, y, sizes: dict(zip(sizes, boosted_errors(self, df, y, (2, 4)).values())))
    assert QUERIES[name](spark, "/root/testdata/sf0.001").collect()
    n, sizes = FORESTS[name]
    assert len(seen[0]) == n and {(s.trees, s.max_depth) for s in seen[0]} == sizes


def test_wide_tables_take_mllib_forests(spark, planted, monkeypatch):
    """Bins that make too many cells: the same specs grow as forests of MLlib."""
    from tabforge.operators import forests
    from tabforge.operators.forests import Forest

    df = planted if "features" in planted.columns else models.assemble(planted, ["a", "b", "c"])
    df = df.withColumn("some", F.col("row_id") % 2 == 0)
    specs = {"f": Forest("label", rows="some", classes=True, trees=5, max_depth=4), "e": Forest("label", classes=True, trees=5, max_depth=4, bootstrap=False, cuts="random")}
    kinds, scores = [], []
    for cells in (forests.CELLS, 10):
        monkeypatch.setattr(forests, "CELLS", cells)
        fitted = ensemble.fit_forest_batch(df, specs, ["a", "b", "c"], "row_id")
        kinds.append(type(fitted["f"]).__name__)
        scores += [_accuracy(m.transform(df)) for m in fitted.values()]
    assert kinds == ["ForestModel", "RandomForestClassificationModel"] and min(scores) > 0.85, (kinds, scores)


#: Batches of the registered queries at full size: numbers of models, and trees and depths among them.
BATCHES = {
    "md_xgb": (1, {(150, 5)}),
    "md_lgbm": (1, {(150, 5)}),
    "md_multiclass_gbt": (4, {(200, 7)}),
    "en_stack_cls": (18, {(150, 5)}),
    "en_stack_reg": (12, {(150, 3), (150, 6)}),
    "en_weights": (10, {(150, 3), (150, 6)}),
    "ex_grid": (32, {(200, 5), (200, 7)}),
    "ex_trees": (2, {(250, 3), (250, 6)}),
    "out_sweep": (65, {(200, 5)}),
}


@pytest.mark.parametrize("name", BATCHES)
def test_batches_are_whole_and_queries_end(spark, monkeypatch, name):
    """Each query runs to its end on a small table; only the trees of the recorded batch are cut to four."""
    from dataclasses import replace

    from tabforge.operators import boosting
    from tabforge.plans import learning

    seen = []

    def few(df, specs, features, row_id, seed=42):
        seen.append(list(specs.values()))
        return boosting.fit_many(df, {n: replace(s, n_estimators=4) for n, s in specs.items()}, features, row_id, seed)

    for module in (learning, ensemble, models):
        monkeypatch.setattr(module, "fit_many", few)
    monkeypatch.setattr(learning, "FOREST_DEPTH", 3)
    grid_trees, curve = learning.GRID_TREES, learning.CURVE_TREES
    forest = models.forest
    small = lambda label="label", trees=100, depth=10, regression=False, **kw: forest(label, min(trees, 4), min(depth, 3), regression, **kw)
    monkeypatch.setattr(models, "forest", small)
    monkeypatch.setattr(models, "boosted", lambda **kw: small())  # the meta model
    if name == "ex_trees":  # sizes of the curve are prefixes, here of four trees
        monkeypatch.setattr(learning, "CURVE_TREES", (2, 4))
    if name == "ex_grid":
        monkeypatch.setattr(learning, "GRID_TREES", (2, 4))
    out = QUERIES[name](spark, "/root/testdata/sf0.001").collect()
    rows = {"md_multiclass_gbt": 6, "en_stack_cls": 3, "en_weights": 6, "ex_grid": 24, "ex_trees": 6, "out_sweep": 13}
    assert len(out) == rows.get(name, len(out)) and out
    n, sizes = BATCHES[name]
    assert [len(s) for s in seen] == [n]
    assert (grid_trees, curve[0], curve[-1], len(curve)) == ((100, 200), 50, 250, 9)
    if name not in ("ex_grid", "ex_trees"):
        assert {(s.n_estimators, s.max_depth) for s in seen[0]} == sizes
    if name == "out_sweep":
        assert {r.method for r in out} == {"none", *learning._sweep_detectors()} and all(0 < r.cv_auc <= 1 for r in out)


def test_registered_rounds(spark, monkeypatch):
    from tabforge.plans import imputation

    seen = []

    def record(*args, **sizes):
        seen.append(sizes)
        raise Recorded

    monkeypatch.setattr(models, "fit_samme", record)
    monkeypatch.setattr(imputation.mice, "chained_trees", record)
    for name in ("md_adaboost", "im_mice_rf", "im_mice_gbt", "im_mice_gbt_scaled"):
        with pytest.raises(Recorded):
            QUERIES[name](spark, "/root/testdata/sf0.001")
    assert [s["rounds"] for s in seen] == [100, 10, 10, 10] and [s["trees"] for s in seen[1:]] == [10, 50, 50]


def test_errors_of_the_first_trees_of_a_forest(spark):
    rows = spark.range(300).selectExpr("id AS row_id", "CAST(id % 17 AS DOUBLE) AS v", "CAST(id % 17 * 2 + id % 5 AS DOUBLE) AS y")
    df = models.assemble(rows, ["v"])
    fitted = models.forest("y", trees=6, depth=3, regression=True).fit(df)
    got = models.forest_errors(fitted, df, "y", [2, 6], block=3)
    whole = fitted.transform(df).selectExpr("avg(power(prediction - y, 2))").first()[0]
    assert sorted(got) == [2, 6] and got[6] == pytest.approx(whole)


def test_all_strategies_detectors_and_metas_are_registered(spark, planted, monkeypatch):
    from tabforge.plans import imputation, learning

    assert {"mice_10", "mice_20", "mice_50", "mice_rf", "median_knn", "knn_20"} <= set(imputation._strategies())
    assert len(learning._sweep_detectors()) == 12
    for name, flag in learning._sweep_detectors().items():
        kept = flag(planted.select("row_id", F.col("a").alias("v"), F.col("b").alias("k"), F.col("c").alias("h"))).where("is_inlier").count()
        assert kept == (600 if name.startswith("z") else round(600 * (1 - float(name.split()[1])))), name

    def fit_stacks(df, bases, metas, **options):
        raise Recorded(sorted(metas))

    monkeypatch.setattr(ensemble, "fit_stacks", fit_stacks)
    with pytest.raises(Recorded) as caught:
        QUERIES["en_stack_cls"](spark, "/root/testdata/sf0.001")
    assert caught.value.args == (["forest", "gbt", "logistic"],)


def test_stacks_and_added_strategies(spark, planted):
    from tabforge.operators.impute import ThresholdImputer
    from tabforge.operators.mice import ChainedTreeImputer

    folded = split.kfold(planted, "row_id", 2, seed=9)
    stacks = ensemble.fit_stacks(folded, {"tree": models.tree(depth=3), "lr": LogisticRegression(labelCol="label")}, {"f": models.forest(trees=5, depth=3), "g": models.boosted(n_estimators=3)}, k=2)
    assert all(_accuracy(stack.transform(planted)) > 0.9 for stack in stacks.values())
    holes = planted.select("row_id", F.when(F.col("a") > 0.6, F.col("a")).alias("a"), F.when(F.col("b") > 0.1, F.col("b")).alias("b"), "c")
    for imputer in (ThresholdImputer(["a", "b", "c"]), ChainedTreeImputer("row_id", ["a", "b", "c"], "rf", rounds=1, trees=2, depth=2)):
        out = imputer.fit(holes).add_filled(holes, "new")
        assert out.count() == 600 and out.where("a__new IS NULL OR b__new IS NULL OR c__new IS NULL").count() == 0
        if isinstance(imputer, ThresholdImputer):
            assert out.where("a IS NULL").select("a__new").distinct().count() == 1 and out.where("b IS NULL").select("b__new").distinct().count() > 1


def test_tree_chain_stops_and_fills_rows_it_has_not_seen(spark, planted):
    """A chain over a feature that follows from the others settles early; its models fill new rows and do not change."""
    from tabforge.operators.mice import ChainedTreeImputer, fit_chained_trees

    holes = planted.select("row_id", F.when(F.col("row_id") % 5 > 0, F.col("a")).alias("a"), "b", (2 * F.col("a")).alias("c"))
    chain, filled = fit_chained_trees(holes, "row_id", ["a", "b", "c"], "rf", rounds=6, trees=3, depth=5)
    assert len(chain.rounds) == 2  # the second round moves nothing
    again = {r.row_id: r.a for r in chain.transform(holes).collect()}
    assert all(again[r.row_id] == pytest.approx(r.a) for r in filled.collect())
    old, new = holes.where("row_id < 400"), holes.where("row_id >= 400")
    model = ChainedTreeImputer("row_id", ["a", "b", "c"], "gbt", rounds=2, trees=5, depth=4, step=0.5, scaled=True).fit(old)
    before = [m.toDebugString for steps in model.rounds for _, m in steps]
    out = model.add_filled(new, "tree").collect()
    assert len(out) == 200 and before == [m.toDebugString for steps in model.rounds for _, m in steps]
    assert max(abs(r["a__tree"] - r["c"] / 2) for r in out if r["a"] is None) < 0.15
