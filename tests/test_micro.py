"""Small tables with results worked out by hand."""

from bisect import bisect_right
from collections import Counter
import math

import pytest
from pyspark.sql import functions as F

from tabforge.functions import scalar, special
from tabforge.functions.rng import uniform
from tabforge.operators import clean, ensemble, impute, leaderboard, metrics, outliers, profile, quantiles, stats
from tabforge.operators.encode import ColumnScaler, LabelCoder, label_codes


def test_uniform_numbers_are_fixed(spark):
    rows = spark.range(3).select((uniform("id", 42) * 4294967296).cast("long")).collect()
    assert [r[0] for r in rows] == [2845920338, 2707051513, 2345943595]


def test_uniform_survives_repartition(spark):
    df = spark.range(1000)
    a = df.where(uniform("id", 7) < 0.3).count()
    assert a == df.repartition(7).where(uniform("id", 7) < 0.3).count()


def test_sentinel_and_thresholds(spark):
    df = spark.createDataFrame([(0.0,), (1010.0,), (None,), (1021.0,)], "p double")
    out = clean.clean_sentinels(df, {"p": 0.0})
    assert [r.p for r in out.collect()] == [None, 1010.0, None, 1021.0]
    flags = out.select(scalar.flag_below("p", 1010).alias("low"), scalar.flag_above("p", 1020).alias("high")).collect()
    assert [r.low for r in flags] == [0, 0, 0, 0]
    assert [r.high for r in flags] == [0, 0, 0, 1]


def test_nan_becomes_null(spark):
    df = spark.createDataFrame([(float("nan"), "x"), (1.0, None)], "a double, b string")
    assert [tuple(r) for r in clean.null_nan(df).collect()] == [(None, "x"), (1.0, None)]


def test_knn_fill_uniform(spark):
    df = spark.createDataFrame([(1, 1.0, 2.0), (2, 3.0, 4.0), (3, 5.0, 6.0), (4, 2.0, None)], "row_id long, a double, b double")
    out = impute.KnnImputer(inputCols=["a", "b"], k=2).fit(df).transform(df)
    assert out.where("row_id = 4").first().b == 3.0


def test_knn_fill_zero_distance_takes_all(spark):
    df = spark.createDataFrame([(1, 1.0, 10.0), (2, 1.0, None), (3, 4.0, 40.0)], "row_id long, a double, b double")
    out = impute.KnnImputer(inputCols=["a", "b"], k=2, weights="distance").fit(df).transform(df)
    assert out.where("row_id = 2").first().b == 10.0


def test_knn_fill_without_shared_feature_uses_mean(spark):
    df = spark.createDataFrame([(1, None, 10.0), (2, 5.0, None), (3, None, 20.0)], "row_id long, a double, b double")
    out = impute.KnnImputer(inputCols=["a", "b"], k=2).fit(df).transform(df)
    assert out.where("row_id = 2").first().b == 15.0


def test_auc_counts_ties_half(spark):
    df = spark.createDataFrame([(1, 0.8), (0, 0.5), (1, 0.5), (0, 0.2)], "label int, score double")
    assert metrics.roc_auc(df).first().auc == 0.875


def test_auc_needs_both_classes(spark):
    df = spark.createDataFrame([(1, 0.8), (1, 0.5)], "label int, score double")
    assert metrics.roc_auc(df).first().auc is None


def test_binary_metrics_zero_division(spark):
    df = spark.createDataFrame([(1, 0), (1, 0), (0, 0), (0, 0), (0, 0)], "label int, prediction int")
    m = metrics.binary_metrics(df).first()
    assert (m.precision, m.recall, m.f1_score, m.accuracy) == (0.0, 0.0, 0.0, 0.6)


def test_regression_metrics(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 2.0), (3.0, 4.0)], "label double, prediction double")
    m = metrics.regression_metrics(df).first()
    assert m.r2_score == pytest.approx(0.5)
    assert m.mae == pytest.approx(1 / 3)
    assert m.bias == pytest.approx(1 / 3)
    assert m.explained_variance == pytest.approx(2 / 3)


def test_scalers_on_constant_column(spark):
    df = spark.createDataFrame([(0.0,), (0.0,), (0.0,)], "x double")
    for kind in ("standard", "minmax", "robust"):
        out = ColumnScaler(inputCols=["x"], kind=kind).fit(df).transform(df)
        assert [r.x for r in out.collect()] == [0.0, 0.0, 0.0]


def test_label_codes_keep_null(spark):
    df = spark.createDataFrame([(1, "b"), (2, None), (3, "a"), (4, "c")], "i int, s string")
    model = LabelCoder(inputCols=["s"]).fit(df)
    assert [r.s for r in model.transform(df).orderBy("i").collect()] == [1, None, 0, 2]
    table = {r.label: r.code for r in label_codes(df, "s").collect()}
    assert table == {"a": 0, "b": 1, "c": 2}


def test_label_coder_with_a_huge_dictionary(spark):
    label = F.when(F.col("id") % 50 != 0, F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")))
    df = spark.range(60_000).select("id", label.alias("s"), F.lit(1).alias("label"))
    model = LabelCoder(inputCols=["s"]).fit(df)
    rows = [tuple(r) for r in df.orderBy("id").collect()]
    codes = {v: k for k, v in enumerate(sorted({s for _, s, _ in rows if s}))}
    assert len(codes) > 20_000
    coded = model.transform(df)
    assert coded.columns == df.columns
    assert [r.s for r in coded.orderBy("id").collect()] == [codes.get(s) for _, s, _ in rows]
    assert [r.s for r in model.decode(coded, "s").orderBy("id").collect()] == [s for _, s, _ in rows]


def test_ks_two_sample(spark):
    rows = [("f", float(v), True) for v in (1, 2, 3)] + [("f", float(v), False) for v in (2, 3, 4)]
    df = spark.createDataFrame(rows, "feature string, value double, first boolean")
    assert stats.ks_two_sample(df, "feature", "value", "first").first().ks_statistic == pytest.approx(1 / 3)


def test_spearman_with_ties(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1.0, 2.0), (2.0, 3.0)], "x double, y double")
    assert stats.spearman(df, ["x"], "y").first().spearman_r == pytest.approx(0.8660254, abs=1e-6)


def test_correlation_of_a_constant_is_null(spark):
    df = spark.createDataFrame([(1.0, 1.0, 2.0), (1.0, 2.0, 4.0), (1.0, None, 9.0)], "a double, b double, c double")
    got = {(r.a, r.b): r.r for r in profile.correlation_pairs(df, ["a", "b", "c"]).collect()}
    assert got == {("a", "b"): None, ("a", "c"): None, ("b", "c"): pytest.approx(1.0)}


def test_class_weights(spark):
    df = spark.createDataFrame([(0,), (0,), (0,), (1,)], "label int")
    w = {r.label: r.weight for r in profile.class_weights(df, "label").collect()}
    assert w == {0: pytest.approx(4 / 6), 1: pytest.approx(2.0)}


def test_votes(spark):
    row = spark.range(1).select(
        F.array(F.lit(0.9), F.lit(0.1)).alias("a"), F.array(F.lit(0.4), F.lit(0.6)).alias("b"), F.array(F.lit(0.3), F.lit(0.7)).alias("c")
    )
    mean = ensemble.soft_vote([F.col("a"), F.col("b"), F.col("c")])
    votes = [ensemble.arg_max_class(F.col(x)) for x in "abc"]
    r = row.select(mean.alias("m"), ensemble.arg_max_class(mean).alias("soft"), ensemble.hard_vote(votes, [0, 1]).alias("hard")).first()
    assert r.m == [pytest.approx(1.6 / 3), pytest.approx(1.4 / 3)]
    assert (r.soft, r.hard) == (0, 1)


def test_iqr(spark):
    df = spark.createDataFrame([(float(v),) for v in (1, 2, 3, 4, 100)], "x double")
    r = outliers.iqr_report(df, ["x"]).first()
    assert (r.low_fence, r.high_fence, r.outliers) == (-1.0, 7.0, 1)


def test_correlation_bands(spark):
    df = spark.createDataFrame([(0.31,), (0.30,), (0.20,), (-0.25,)], "r double")
    assert [r[0] for r in df.select(scalar.correlation_band("r")).collect()] == ["strong", "moderate", "weak", "moderate"]


def test_first_method_wins_a_tie(spark):
    df = spark.createDataFrame([(1.0, 1.1, 0.9), (None, 1.1, 0.9)], "a double, a__knn double, a__mice double")
    table = impute.best_method_table(df.select("a", "a__knn", F.col("a__knn").alias("a__mice")), ["a"], ["knn", "mice"])
    assert table.first().best_method == "knn"


def test_log_target_round_trip(spark):
    df = spark.createDataFrame([(-2.0,), (0.0,), (5.0,)], "y double")
    back = df.select(scalar.unlog_target(scalar.log_target("y", -2.0), -2.0).alias("b")).collect()
    assert [r.b for r in back] == [pytest.approx(-2.0), pytest.approx(0.0), pytest.approx(5.0)]


def test_pct_change_policies(spark):
    row = spark.range(1).select(
        scalar.pct_change(F.lit(1.0), F.lit(0.0)).alias("none"),
        scalar.pct_change(F.lit(1.0), F.lit(0.0), on_zero="zero").alias("zero"),
        scalar.pct_change(F.lit(-3.0), F.lit(-2.0), signed=True).alias("signed"),
    ).first()
    assert (row.none, row.zero, row.signed) == (None, 0.0, 50.0)


def test_p_values():
    # t distribution: two-sided p at t = 2.2281 with 10 degrees of freedom is 0.05
    t, df = 2.228138852, 10
    r = t / math.sqrt(df + t * t)
    assert special.correlation_p(r, df + 2) == pytest.approx(0.05, abs=1e-7)
    assert special.correlation_p(0.0, 50) == pytest.approx(1.0)
    # Kolmogorov distribution: Q(1.3581) is 0.05
    assert special.kolmogorov_p(1.3581015 / math.sqrt(50.0), 100, 100) == pytest.approx(0.05, abs=1e-5)


def test_win_loss_bands_do_not_overlap(spark):
    df = spark.createDataFrame([(0.01,), (-0.02,), (0.0005,), (0.0,)], "delta double")
    r = leaderboard.win_loss(df).first()
    assert (r.improved, r.degraded, r.same) == (1, 1, 2)


def test_gate_needs_near_best_auc_for_drift(spark):
    previous = spark.createDataFrame([(0.9, 0.8, 1.0)], "best_auc double, best_accuracy double, best_drift double")
    runs = spark.createDataFrame(
        [("a", 0.91, 0.7, 2.0), ("b", 0.897, 0.7, 0.5), ("c", 0.80, 0.7, 0.5), ("d", 0.85, 0.85, 2.0)],
        "m string, auc double, accuracy double, drift double",
    )
    got = {r.m: (r.save, r.reasons) for r in leaderboard.gate(runs, previous).collect()}
    assert got == {"a": (1, "auc"), "b": (1, "drift"), "c": (0, "drift"), "d": (1, "accuracy")}


def test_sky_distribution_sums_to_one(spark):
    df = spark.createDataFrame([(7.0, 90.0), (5.0, 50.0), (3.0, 10.0), (0.0, 50.0)], "c double, h double")
    rows = df.select(scalar.sky_distribution("c", "h").alias("p")).collect()
    assert all(sum(r.p) == pytest.approx(1.0) for r in rows)
    assert rows[3].p == [pytest.approx(0.7), pytest.approx(0.2), pytest.approx(0.08), pytest.approx(0.02)]


def test_median_of_even_count(spark):
    df = spark.createDataFrame([(float(v),) for v in (4, 1, 3, 2)], "x double")
    assert quantiles.exact_quantiles(df, {"x": F.col("x")}, [0.5])["x"] == [2.5]


def test_category_draw_from_very_many_labels(spark):
    from tabforge.operators.impute import impute_by_distribution

    label = F.when(F.col("id") % 10 != 0, F.when(F.col("id") % 3 == 0, "hot").otherwise(F.format_string("l%07d", "id")))
    df = spark.range(60_000).select(F.col("id").alias("row_id"), label.alias("s"))
    rows = [tuple(r) for r in df.orderBy("row_id").collect()]
    counts = sorted((s, n) for s, n in Counter(s for _, s in rows if s).items())
    ends, total = [], 0
    for _, n in counts:
        total += n
        ends.append(total)
    u = {r.row_id: r.u for r in df.where("s IS NULL").select("row_id", uniform("row_id", 42).alias("u")).collect()}
    got = {r.row_id: r.s for r in impute_by_distribution(df, "s", "row_id").collect()}
    assert len(got) == 60_000
    for i, s in rows:
        assert got[i] == (s or counts[bisect_right(ends, u[i] * total)][0])
