"""Steps that must not grow with the rows: chains over groups, scores and margins computed once, donors in parts."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabforge.operators import knn, mice, outliers
from tabforge.operators.boosting import Boosting, fit_many
from tabforge.operators.forests import row_draws


@pytest.fixture(scope="module")
def holes(spark):
    rows = spark.range(3000).select(F.col("id").alias("row_id"), (F.col("id") % 10).cast("double").alias("a0"), (F.col("id") * 7 % 12).cast("double").alias("b0"))
    return rows.select(
        "row_id", F.when(F.col("row_id") % 5 > 0, F.col("a0")).alias("a"), F.when(F.col("row_id") % 7 > 1, F.col("a0") + F.col("b0")).alias("b"), F.col("b0").alias("c")
    ).cache()


@pytest.mark.parametrize("scaled", [False, True])
def test_boosted_chain_over_groups_fills_as_over_rows(holes, monkeypatch, scaled):
    seen, fit = [], mice.fit_many
    monkeypatch.setattr(mice, "fit_many", lambda df, *rest: seen.append(df.count()) or fit(df, *rest))
    sizes = {"rounds": 2, "trees": 4, "depth": 3, "step": 0.3, "scaled": scaled}
    chain, filled = mice.fit_chained_trees(holes, "row_id", ["a", "b", "c"], "gbt", **sizes)
    assert max(seen) < 700  # groups, not rows
    got = {r.row_id: r for r in filled.collect()}
    assert len(got) == 3000 and {r.row_id: r for r in chain.transform(holes).collect()} == got
    monkeypatch.setattr(mice, "fits_cells", lambda limits: False)
    for r in mice.fit_chained_trees(holes, "row_id", ["a", "b", "c"], "gbt", **sizes)[1].collect():
        assert tuple(got[r.row_id]) == pytest.approx(tuple(r), abs=1e-9)


def test_forest_chain_grows_from_groups(holes, monkeypatch):
    from pyspark.ml.regression import RandomForestRegressor

    def never(*_):
        raise AssertionError("fitted over rows")

    monkeypatch.setattr(RandomForestRegressor, "fit", never)
    chain, filled = mice.fit_chained_trees(holes, "row_id", ["a", "b", "c"], "rf", rounds=3, trees=5, depth=8)
    true = {r.row_id: r for r in holes.collect()}
    out = filled.collect()
    assert len(out) == 3000 and all(true[r.row_id].a in (None, r.a) and true[r.row_id].b in (None, r.b) for r in out)
    error = [abs(r.a - r.row_id % 10) for r in out if true[r.row_id].a is None and true[r.row_id].b is not None]
    assert np.mean(error) < 1.5 and len(chain.rounds[0][0][1].nodes) == 5


def test_bootstrap_draws_rows(holes):
    draws = holes.select(*[d.alias(f"d{t}") for t, d in enumerate(row_draws("row_id", 3, 42))]).agg(*[f(f"d{t}") for t in range(3) for f in (F.avg, F.var_pop)]).first()
    assert all(abs(x - 1.0) < 0.12 for x in draws)


def test_levels_share_scores(holes):
    calls = []

    def scored(df, row_id, columns):
        calls.append(1)
        return df.withColumn("s", F.col("c")), "s"

    scores = outliers.Scores(scored, "row_id", ["c"])
    kept = [scores.flags(holes, share).where("is_inlier").count() for share in (0.05, 0.1)]
    assert kept == [2850, 2700] and len(calls) == 1


def test_margins_by_cell_equal_those_of_trees(spark):
    rows = spark.range(500).select(F.col("id").alias("row_id"), (F.col("id") % 17).cast("double").alias("a"), (F.col("id") * 31 % 23).cast("double").alias("b"))
    rows = rows.withColumn("y", (F.col("a") * F.col("b") > 90).cast("int"))
    model = fit_many(rows, {0: Boosting("y", n_estimators=6, max_depth=4)}, ["a", "b"], "row_id")[0]
    x = np.array([[p, q] for p in [*np.arange(-2, 20, 0.5), np.nan, np.inf, -np.inf] for q in [*np.arange(-1, 25, 0.5), np.nan]])
    fast = model.tabulated()
    assert fast.cells is not None and (fast.margins(x) == model.margins(x)).all()


def test_donors_of_one_split_are_dealt(holes, monkeypatch):
    monkeypatch.setattr(knn, "DEALT_ROWS", 300)
    d = holes.select(F.col("row_id").alias("id"), knn.vector(["a", "b", "c"]).alias("v"), F.lit(0.0).alias("value"))
    assert knn._dealt(d.coalesce(1), 3000).rdd.getNumPartitions() == 10
    kept = knn._nearest_copies(d, 2).collect()
    best = {}
    for r in sorted(d.collect(), key=lambda r: r.id):
        best.setdefault(tuple(r.v), []).append(r.id)
    assert sorted(r.id for r in kept) == sorted(i for ids in best.values() for i in ids[:2])
