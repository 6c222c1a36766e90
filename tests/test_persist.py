"""Models made of other models come back as they were."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabforge.functions.rng import uniform
from tabforge.operators.boosting import Boosting, fit_many
from tabforge.operators.mice import fit_chained_trees
from tabforge.operators.persist import load_model, save_model
from tabforge.plans import load_all
from tabforge.plans.catalog import QUERIES


def _holes(spark):
    full = spark.range(300).select(F.col("id").alias("row_id"), *(uniform("id", k).alias(c) for k, c in enumerate("ab")))
    return full.select("row_id", F.when(F.col("row_id") % 4 > 0, F.col("a")).alias("a"), "b", (F.col("a") + F.col("b")).alias("c"))


def test_boosted_model_round_trip(spark, tmp_path):
    df = _holes(spark).where("a IS NOT NULL")
    model = fit_many(df, {0: Boosting("a", logistic=False, n_estimators=3, max_depth=2)}, ["b", "c"], "row_id")[0]
    save_model(spark, model, str(tmp_path / "m"))
    again = load_model(spark, str(tmp_path / "m"))
    assert again.toDebugString == model.toDebugString and again.begin == model.begin
    assert np.array_equal(again.limit, model.limit)  # infinite limits of leaves too
    none = model.prefix(0)
    save_model(spark, none, str(tmp_path / "none"))
    assert load_model(spark, str(tmp_path / "none")).margins(np.zeros((2, 2))).tolist() == [model.begin] * 2


@pytest.mark.parametrize("kind", ["gbt", "rf"])
def test_tree_chain_round_trip(spark, tmp_path, kind):
    holes = _holes(spark)
    chain, _ = fit_chained_trees(holes, "row_id", ["a", "b", "c"], kind, rounds=2, trees=2, depth=2, scaled=True)
    save_model(spark, chain, str(tmp_path / "c"))
    again = load_model(spark, str(tmp_path / "c"))
    want, got = ({r.row_id: r.a for r in m.transform(holes).collect()} for m in (chain, again))
    assert got == want and None not in got.values()


def test_foreign_classes_do_not_load(spark, tmp_path):
    spark.createDataFrame([("os.path", "{}", "[]")], "kind string, parts string, children string").write.json(str(tmp_path / "x/plan"))
    with pytest.raises(ValueError, match="no model"):
        load_model(spark, str(tmp_path / "x"))


def test_nested_models_agree_after_reload(spark):
    load_all()
    rows = QUERIES["snk_nested"](spark, "/root/testdata/sf0.001").collect()
    assert sorted(r.kind for r in rows) == ["kernel_svm", "one_vs_rest", "samme", "stack"]
    assert all(r.n_rows > 0 and r.n_different == 0 for r in rows)
