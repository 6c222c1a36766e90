"""Boosted models grown in shared passes, against a plain version."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabforge.functions.rng import uniform
from tabforge.operators import boosting
from tabforge.operators.boosting import Boosting, fit_many

FEATURES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def table(spark):
    df = spark.range(500).select(F.col("id").alias("row_id"), *(F.floor(uniform("id", k) * 20).alias(c) for k, c in enumerate(FEATURES)))
    df = df.withColumn("y", 0.3 * F.col("a") - 0.1 * F.col("b") * F.col("c") + uniform("row_id", 9)).withColumn("label", (F.col("y") > -3).cast("int"))
    return df.withColumn("part", F.col("row_id") % 3 != 0).withColumn("w", 1 + F.col("row_id") % 2)


def plain(x, y, w, s):
    """Margins of all rows by a boosted model of the rows with a weight, split at every value."""
    mean = (y * w).sum() / w.sum()
    out = np.full(len(x), np.log(mean / (1 - mean)) if s.logistic else mean)
    for _ in range(s.n_estimators):
        p = 1 / (1 + np.exp(-out))
        g, h = ((y - p) * w, p * (1 - p) * w) if s.logistic else ((y - out) * w, w)
        value, leaves = np.zeros(len(x)), [(np.ones(len(x), dtype=bool), 0)]

        def soft(v):
            return np.sign(v) * max(abs(v) - s.reg_alpha, 0)

        def score(rows):
            return soft(g[rows].sum()) ** 2 / ((h if s.newton else w)[rows].sum() + s.reg_lambda)

        while leaves:
            rows, depth = leaves.pop()
            best = (max(s.gamma, 1e-12), None)
            for i in range(x.shape[1]):
                for limit in np.unique(x[:, i]):
                    sides = rows & (x[:, i] <= limit), rows & (x[:, i] > limit)
                    if min(w[k].sum() for k in sides) < max(s.min_child_samples, 1e-12) or min(h[k].sum() for k in sides) < s.min_child_weight:
                        continue
                    gain = (score(sides[0]) + score(sides[1]) - score(rows)) / 2
                    if gain > best[0] + 1e-9:
                        best = (gain, sides)
            if best[1] is None:
                continue
            for side in best[1]:
                value[side] = soft(g[side].sum()) / (h[side].sum() + s.reg_lambda) * s.learning_rate
                if depth + 1 < s.max_depth:
                    leaves.append((side, depth + 1))
        out = out + value
    return out


SPECS = {
    "newton": Boosting("label", n_estimators=4, max_depth=3, reg_lambda=1.0, min_child_weight=1.0),
    "first": Boosting("y", logistic=False, n_estimators=3, max_depth=2, learning_rate=0.3, newton=False, min_child_samples=15),
    "part": Boosting("y", rows="part", logistic=False, n_estimators=5, max_depth=3, reg_alpha=2.0, gamma=0.5),
    "weighted": Boosting("label", rows="part", weight="w", n_estimators=2, max_depth=4, reg_lambda=0.5),
}


def test_models_of_a_batch_equal_plain_ones(spark, table, monkeypatch):
    monkeypatch.setattr(boosting, "CHECKPOINT", 2)
    rows = table.orderBy("row_id").collect()
    x = np.array([[r[c] for c in FEATURES] for r in rows], dtype=float)
    fitted = fit_many(table.repartition(4), SPECS, FEATURES, "row_id")
    for name, s in SPECS.items():
        w = np.array([(r[s.rows] if s.rows else 1) * (r[s.weight] if s.weight else 1) for r in rows], dtype=float)
        want = plain(x, np.array([r[s.label] for r in rows], dtype=float), w, s)
        got = [r.m for r in table.withColumn("m", fitted[name].margin()).orderBy("row_id").collect()]
        assert got == pytest.approx(want, abs=1e-9), name
    sizes = (1, 3, 4)
    errors = fitted["newton"].errors(table, "label", sizes)
    for n in sizes:
        assert errors[n] == pytest.approx(table.select(F.avg((fitted["newton"].prefix(n).margin() - F.col("label")) ** 2)).first()[0])


def test_partitions_do_not_change_models(table):
    spec = {"m": Boosting("label", n_estimators=5, max_depth=3, subsample=0.7, colsample=0.7)}
    one, many = (fit_many(table.repartition(k, "row_id"), spec, FEATURES, "row_id")["m"] for k in (1, 20))
    assert (one.feature == many.feature).all() and np.allclose(one.value, many.value)


def test_leaves_are_bounded(table):
    m = fit_many(table, {"m": Boosting("y", logistic=False, n_estimators=3, max_depth=5, num_leaves=6)}, FEATURES, "row_id")["m"]
    assert [(f >= 0).sum() + 1 for f in m.feature] == [6, 6, 6]


def test_prediction_columns(table):
    m = fit_many(table, {"m": SPECS["newton"]}, FEATURES, "row_id")["m"]
    out = m.transform(table)
    assert {"probability", "prediction"} <= set(out.columns) and out.where("prediction = label").count() > 400


def test_empty_and_constant_tables(table):
    for df in (table.limit(0), table.withColumns({c: F.lit(1.0) for c in FEATURES})):
        m = fit_many(df, {"m": Boosting("y", logistic=False, n_estimators=2)}, FEATURES, "row_id")["m"]
        assert (m.feature < 0).all()


def test_models_by_cells_equal_those_by_passes(table, monkeypatch):
    """One scan and a task a model gives the trees that passes over the rows give, for folds, weights, samples of rows, few features and few leaves."""
    specs = dict(SPECS, half=Boosting("label", n_estimators=5, max_depth=3, subsample=0.5), most=Boosting("y", rows="part", logistic=False, n_estimators=4, max_depth=4, subsample=0.8))
    specs["few"] = Boosting("label", rows="part", weight="w", n_estimators=6, max_depth=4, colsample=0.67, num_leaves=5, reg_lambda=0.5)
    odd = table.withColumn("y", F.when(F.col("row_id") % 50 > 0, F.col("y"))).withColumn("part", F.when(F.col("row_id") % 40 > 0, F.col("part")))
    calls = []
    by_cells = boosting._grow_by_cells
    monkeypatch.setattr(boosting, "_grow_by_cells", lambda *a: calls.append(1) or by_cells(*a))
    fast = fit_many(odd, specs, FEATURES, "row_id")
    monkeypatch.setattr(boosting, "CELLS", 0)
    slow = fit_many(odd, specs, FEATURES, "row_id")
    assert calls == [1]
    for n in specs:
        assert np.array_equal(fast[n].feature, slow[n].feature) and np.array_equal(fast[n].limit, slow[n].limit), n
        assert np.allclose(fast[n].value, slow[n].value, atol=1e-9) and fast[n].begin == pytest.approx(slow[n].begin)


def test_sampled_trees_see_their_groups_only(table):
    """The first tree of a sampled model is that of a model over the rows of the drawn groups, but for the start."""
    spec = Boosting("y", logistic=False, n_estimators=1, max_depth=3, subsample=0.25)
    own = np.nonzero(boosting._Batch([spec], 42).drawn(0)[0])[0]
    assert len(own) == boosting.DRAWS / 4
    marked = table.withColumn("seen", boosting._draw_group("row_id").isin(own.tolist()))
    limits = boosting.bin_limits(table, FEATURES)
    sampled, seen = (fit_many(marked, {0: s}, FEATURES, "row_id", limits=limits)[0] for s in (spec, Boosting("y", rows="seen", logistic=False, n_estimators=1, max_depth=3)))
    assert np.array_equal(sampled.feature, seen.feature) and np.array_equal(sampled.limit, seen.limit)


def test_debug_string_names_splits(table):
    text = fit_many(table, {0: Boosting("label", n_estimators=2, max_depth=1)}, FEATURES, "row_id")[0].toDebugString
    assert text.startswith("tree 0: 0: ") and " <= " in text and text.count("tree ") == 2
