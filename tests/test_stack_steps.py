"""A stack maps, scores and deals its rows once, in few partitions."""

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from tabforge.functions.rng import uniform
from tabforge.operators import ensemble, models
from tabforge.operators.boosting import Boosting, distinct_cells
from tabforge.plans import learning
from tabforge.session import SMALL_PARTITIONS, STEP_PARTITIONS, cut_lineage, step_partitions


@pytest.fixture(scope="module")
def folded(spark):
    """400 rows in 33 partitions, of two folds."""
    rows = spark.range(0, 400, 1, 33).select(F.col("id").alias("row_id"), *(uniform("id", k).alias(c) for k, c in enumerate(learning.X)))
    rows = rows.withColumns({"label": (F.col("v") + F.col("k") > 1).cast("int"), "fold": (F.col("row_id") % 2).cast("int")})
    return cut_lineage(models.assemble(rows, learning.X))


@pytest.fixture(scope="module")
def one_part(folded):
    return cut_lineage(folded.coalesce(1))


def test_level_one_has_few_partitions_and_all_rows(folded):
    fitted = {("lr", i): LogisticRegression(labelCol="label").fit(folded.where(F.col("fold") != i)) for i in range(2)}
    out = ensemble.out_of_fold(folded, ["lr"], fitted, "row_id", "label", "fold", 2)
    assert out.rdd.getNumPartitions() <= STEP_PARTITIONS < SMALL_PARTITIONS < 2 * folded.rdd.getNumPartitions()
    got = {r.row_id: r.z_lr for r in out.collect()}
    assert len(got) == out.count() == 400
    for i in range(2):
        part = fitted["lr", i].transform(folded.where(F.col("fold") == i)).select("row_id", "probability")
        assert all(got[r.row_id] == pytest.approx(r.probability[1]) for r in part.collect())


def test_step_partitions_leave_large_tables():
    assert [step_partitions(n) for n in (1, 24, 50, 64, 65, 900)] == [1, 24, 24, 24, 65, 900]


def test_folds_share_the_mapped_rows_of_a_kernel(one_part, monkeypatch):
    calls, transform = [], models.KernelMap.transform

    def counted(self, df, out="kernel_features"):
        calls.append(1)
        return transform(self, df, out)

    monkeypatch.setattr(models.KernelMap, "transform", counted)
    fitted = ensemble.fit_bases(one_part, {"svm": learning._KernelSvm()}, "row_id", "fold", 2, learning.X)
    assert len(calls) == 1 and set(fitted) == {("svm", 0), ("svm", 1), ("svm", None)}
    alone = models.fit_kernel_svm(one_part.where("fold != 0"), learning.X, "label", "row_id", "rbf")
    shared = fitted["svm", 0].svm.coefficients.toArray()
    assert np.allclose(shared, alone.svm.coefficients.toArray(), atol=1e-6) and np.abs(shared).max() > 0


@pytest.mark.parametrize("kind", ["rbf", "sigmoid"])
def test_margins_of_a_kernel_machine_need_no_feature_column(one_part, kind):
    fitted = models.fit_kernel_svm(one_part, learning.X, "label", "row_id", kind)
    out = fitted.transform(one_part)
    plans = out._jdf.queryExecution().optimizedPlan().toString()
    assert "kernel_features" not in plans
    long = models._margin(fitted.svm.transform(fitted.kernel.transform(one_part.select("row_id", *learning.X))))
    want = {r.row_id: r.margin for r in long.select("row_id", "margin").collect()}
    assert all(r.margin == pytest.approx(want[r.row_id], abs=1e-9) for r in out.select("row_id", "margin").collect())


def test_bases_score_by_cell_and_stacks_share_their_outputs(one_part, monkeypatch):
    monkeypatch.setattr(ensemble, "CELLS", 399)  # fewer than rows
    bases = {"gbt": Boosting("label", n_estimators=5, max_depth=3), "lr": LogisticRegression(labelCol="label")}
    stacks = ensemble.fit_stacks(one_part, bases, {"a": LogisticRegression(), "b": models.tree(depth=2)}, k=2, features=learning.X)
    assert all(s.bases["gbt"].cells for s in stacks.values())
    outputs = cut_lineage(ensemble.member_outputs(one_part, stacks["a"].bases).select("row_id", "z_gbt", "z_lr"))
    for s in stacks.values():
        want = {r.row_id: r.prediction for r in s.transform(one_part).collect()}
        assert {r.row_id: r.prediction for r in s.combined(outputs).collect()} == want


@pytest.mark.parametrize("rows", [0, 1, 5000])
def test_cells_are_told_apart_by_one_number(rows):
    binned = np.random.default_rng(3).integers(0, [32, 5, 1], (rows, 3)).astype(np.int32)
    cells, at = distinct_cells(binned)
    assert np.array_equal(cells, np.unique(binned, axis=0)) and np.array_equal(cells[at], binned)
