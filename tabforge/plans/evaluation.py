"""Metrics, statistical tests and ensembles of given predictions (inventory 2.15, 2.17, 2.18)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabforge.functions.rng import uniform, uniform_sql
from tabforge.operators import metrics, stats
from tabforge.plans.aggregates import rounded
from tabforge.plans.catalog import query, table
from tabforge.plans.inputs import READINGS_SQL, SCORED_SQL, readings, scored, with_sql

_CELLS = """, c AS (SELECT CAST(count(*) FILTER (label = 1 AND prediction = 1) AS DOUBLE) AS tp, CAST(count(*) FILTER (label = 0 AND prediction = 1) AS DOUBLE) AS fp,
 CAST(count(*) FILTER (label = 1 AND prediction = 0) AS DOUBLE) AS fn, CAST(count(*) FILTER (label = 0 AND prediction = 0) AS DOUBLE) AS tn FROM scored)"""


@query("mt_confusion", with_sql(SCORED_SQL, "SELECT label, prediction, count(*) AS n FROM scored GROUP BY 1, 2"))
def mt_confusion(spark, sf):
    return metrics.confusion(scored(spark, sf))


@query(
    "mt_binary",
    with_sql(
        SCORED_SQL + _CELLS,
        "SELECT round((tp + tn) / (tp + tn + fp + fn), 8) AS accuracy, round(tp / (tp + fp), 8) AS precision, round(tp / (tp + fn), 8) AS recall, round(2 * tp / (2 * tp + fp + fn), 8) AS f1_score FROM c",
    ),
)
def mt_binary(spark, sf):
    cols = ["accuracy", "precision", "recall", "f1_score"]
    return rounded(metrics.binary_metrics(scored(spark, sf)).select(*cols), 8, *cols)


@query("mt_sensspec", with_sql(SCORED_SQL + _CELLS, "SELECT round(tp / (tp + fn), 8) AS sensitivity, round(tn / (tn + fp), 8) AS specificity FROM c"))
def mt_sensspec(spark, sf):
    return rounded(metrics.binary_metrics(scored(spark, sf)).select("sensitivity", "specificity"), 8, "sensitivity", "specificity")


_MULTI_SQL = (
    SCORED_SQL + f", multi AS (SELECT row_id, event_type AS label, CASE WHEN {uniform_sql('row_id', 3)} < 0.6e0 THEN event_type ELSE 'view' END AS prediction FROM scored)"
)


def _multi(spark, sf):
    s = scored(spark, sf)
    return s.select(
        "row_id",
        F.col("event_type").alias("label"),
        F.when(uniform("row_id", 3) < 0.6, F.col("event_type")).otherwise("view").alias("prediction"),
    )


@query(
    "mt_report",
    with_sql(
        _MULTI_SQL
        + """, per AS (SELECT class, CASE WHEN g > 0 THEN hits / g ELSE 0 END AS precision, hits / support AS recall, 2 * hits / (g + support) AS f1_score, support FROM (
        SELECT label AS class, CAST(count(*) FILTER (label = prediction) AS DOUBLE) AS hits, count(*) AS support FROM multi GROUP BY 1)
        LEFT JOIN (SELECT prediction AS class, count(*) AS g FROM multi GROUP BY 1) USING (class))""",
        """SELECT class, round(precision, 8) AS precision, round(recall, 8) AS recall, round(f1_score, 8) AS f1_score, support FROM per
        UNION ALL SELECT 'macro avg', round(avg(precision), 8), round(avg(recall), 8), round(avg(f1_score), 8), CAST(sum(support) AS BIGINT) FROM per
        UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 8), round(sum(recall * support) / sum(support), 8), round(sum(f1_score * support) / sum(support), 8), CAST(sum(support) AS BIGINT) FROM per""",
    ),
)
def mt_report(spark, sf):
    return rounded(metrics.class_report(_multi(spark, sf)), 8, "precision", "recall", "f1_score")


_AUC_SQL = """(SELECT sum(pos * (below + neg / 2.0e0)) / (sum(pos) * CAST(sum(neg) AS DOUBLE)) FROM (
 SELECT pos, neg, sum(neg) OVER (ORDER BY s) - neg AS below FROM (SELECT {score} AS s, count(*) FILTER ({pos}) AS pos, count(*) FILTER (NOT ({pos})) AS neg FROM {src} GROUP BY 1)))"""


@query(
    "mt_auc",
    with_sql(
        SCORED_SQL,
        f"SELECT round({_AUC_SQL.format(score='score', pos='label = 1', src='scored')}, 8) AS auc, count(*) FILTER (label = 1) AS n_pos, count(*) FILTER (label = 0) AS n_neg FROM scored",
    ),
)
def mt_auc(spark, sf):
    return rounded(metrics.roc_auc(scored(spark, sf)), 8, "auc")


_CLASSES = ["click", "error", "purchase", "signup", "view"]


def _class_scores(spark, sf):
    s = scored(spark, sf)
    return s.withColumns(
        {
            f"p{i}": F.round(uniform("row_id", 10 + i) * 0.7 + (F.col("event_type") == c).cast("int") * 0.3, 2)
            for i, c in enumerate(_CLASSES)
        }
    )


_CLASS_SQL = SCORED_SQL + ", cs AS (SELECT *, " + ", ".join(
    f"round({uniform_sql('row_id', 10 + i)} * 0.7e0 + CAST(event_type = '{c}' AS INTEGER) * 0.3e0, 2) AS p{i}" for i, c in enumerate(_CLASSES)
) + " FROM scored), per AS (" + " UNION ALL ".join(
    "SELECT " + _AUC_SQL.format(score=f"p{i}", pos=f"event_type = '{c}'", src="cs") + f" AS auc, (SELECT count(*) FROM cs WHERE event_type = '{c}') AS n"
    for i, c in enumerate(_CLASSES)
) + ")"


@query("mt_auc_ovr", with_sql(_CLASS_SQL, "SELECT round(sum(auc * n) / sum(n), 8) AS auc_weighted, round(avg(auc), 8) AS auc_macro FROM per"))
def mt_auc_ovr(spark, sf):
    out = metrics.auc_one_vs_rest(_class_scores(spark, sf), "event_type", {c: f"p{i}" for i, c in enumerate(_CLASSES)})
    return rounded(out, 8, "auc_weighted", "auc_macro")


_CURVE_SQL = """, k AS (SELECT score AS threshold, CAST(sum(pos) OVER (ORDER BY score DESC) AS BIGINT) AS tp, CAST(sum(neg) OVER (ORDER BY score DESC) AS BIGINT) AS fp,
 CAST(sum(pos) OVER () AS DOUBLE) AS p, CAST(sum(neg) OVER () AS DOUBLE) AS n
 FROM (SELECT score, count(*) FILTER (label = 1) AS pos, count(*) FILTER (label = 0) AS neg FROM scored GROUP BY 1))"""


@query("mt_roc", with_sql(SCORED_SQL + _CURVE_SQL, "SELECT threshold, tp, fp, round(tp / p, 8) AS tpr, round(fp / n, 8) AS fpr FROM k"))
def mt_roc(spark, sf):
    return rounded(metrics.curve_points(scored(spark, sf)).select("threshold", "tp", "fp", "tpr", "fpr"), 8, "tpr", "fpr")


@query(
    "mt_pr",
    with_sql(SCORED_SQL + _CURVE_SQL, "SELECT threshold, round(tp / CAST(tp + fp AS DOUBLE), 8) AS precision, round(tp / p, 8) AS recall FROM k"),
)
def mt_pr(spark, sf):
    return rounded(metrics.curve_points(scored(spark, sf)).select("threshold", "precision", "recall"), 8, "precision", "recall")


_REG_SQL = """round(1 - sum((y - y_hat) * (y - y_hat)) / (count(*) * var_pop(y)), 6) AS r2_score, round(avg((y - y_hat) * (y - y_hat)), 6) AS mse,
 round(sqrt(avg((y - y_hat) * (y - y_hat))), 6) AS rmse, round(avg(abs(y - y_hat)), 6) AS mae, round(1 - var_pop(y - y_hat) / var_pop(y), 6) AS explained_variance"""


@query("mt_reg", with_sql(SCORED_SQL, f"SELECT grp, count(*) AS n, {_REG_SQL} FROM scored GROUP BY grp"))
def mt_reg(spark, sf):
    out = metrics.regression_metrics(scored(spark, sf), "y", "y_hat", by=["grp"]).drop("bias")
    return rounded(out, 6, "r2_score", "mse", "rmse", "mae", "explained_variance")


@query("mt_bias", with_sql(SCORED_SQL, "SELECT round(avg(y_hat - y), 6) AS bias FROM scored"))
def mt_bias(spark, sf):
    return rounded(metrics.regression_metrics(scored(spark, sf), "y", "y_hat").select("bias"), 6, "bias")


@query(
    "mt_residual",
    with_sql(
        SCORED_SQL,
        "SELECT round(avg(y - y_hat), 6) AS residual_mean, round(stddev_pop(y - y_hat), 6) AS residual_std, round(corr(y, y_hat), 6) AS corr_actual_predicted FROM scored",
    ),
)
def mt_residual(spark, sf):
    out = metrics.residual_summary(scored(spark, sf), "y", "y_hat")
    return rounded(out, 6, *out.columns)


@query(
    "mt_residual_hist",
    with_sql(
        SCORED_SQL + ", r AS (SELECT y - y_hat AS e FROM scored), b AS (SELECT min(e) AS lo, max(e) AS hi FROM r)",
        "SELECT CAST(least(49, floor((e - lo) / ((hi - lo) / 50.0e0))) AS INTEGER) AS bin, count(*) AS n FROM r, b GROUP BY 1",
    ),
)
def mt_residual_hist(spark, sf):
    from tabforge.operators.profile import histogram

    return histogram(scored(spark, sf).select((F.col("y") - F.col("y_hat")).alias("e")), "e", 50)


@query(
    "mt_multiout",
    with_sql(
        SCORED_SQL
        + """, t AS (SELECT 'first' AS target, y, y_hat FROM scored UNION ALL SELECT 'second', score, label * 0.5e0 + 0.25e0 FROM scored),
        per AS (SELECT target, 1 - sum((y - y_hat) * (y - y_hat)) / (count(*) * var_pop(y)) AS r2_score, avg((y - y_hat) * (y - y_hat)) AS mse, avg(abs(y - y_hat)) AS mae,
        1 - var_pop(y - y_hat) / var_pop(y) AS explained_variance FROM t GROUP BY target),
        al AS (SELECT * FROM per UNION ALL SELECT 'average', avg(r2_score), avg(mse), avg(mae), avg(explained_variance) FROM per)""",
        """SELECT target, round(r2_score, 6) AS r2_score, round(mse, 6) AS mse, round(mae, 6) AS mae, round(explained_variance, 6) AS explained_variance,
        round(CASE target WHEN 'first' THEN (r2_score - 0.5e0) / 0.5e0 * 100 WHEN 'second' THEN (r2_score - 0.4e0) / 0.4e0 * 100 END, 4) AS improvement_pct FROM al""",
    ),
)
def mt_multiout(spark, sf):
    s = scored(spark, sf).withColumn("guess", F.col("label") * 0.5 + 0.25)
    out = metrics.multi_target_metrics(s, {"first": ("y", "y_hat"), "second": ("score", "guess")}, {"first": 0.5, "second": 0.4})
    return rounded(rounded(out, 6, "r2_score", "mse", "mae", "explained_variance"), 4, "improvement_pct")


@query("mt_confidence", with_sql(SCORED_SQL, "SELECT row_id, greatest(score, 1 - score) AS confidence, round(100 * score, 6) AS risk FROM scored"))
def mt_confidence(spark, sf):
    p = F.array(1 - F.col("score"), F.col("score"))
    return scored(spark, sf).select("row_id", metrics.confidence(p).alias("confidence"), F.round(100 * F.col("score"), 6).alias("risk"))


# ---- tests -----------------------------------------------------------------

_COLS = ["a", "b", "c", "h"]


@query(
    "ts_pearson",
    with_sql(READINGS_SQL, " UNION ALL ".join(f"SELECT '{c}' AS feature, round(corr({c}, label), 6) AS pearson_r, count({c}) AS valid FROM readings" for c in _COLS)),
)
def ts_pearson(spark, sf):
    """The p-value column is checked against known values in the tests."""
    return rounded(stats.pearson(readings(spark, sf), _COLS, "label").drop("pearson_p"), 6, "pearson_r")


@query("ts_pearson_p")
def ts_pearson_p(spark, sf):
    return stats.pearson(readings(spark, sf), _COLS, "label")


def _spearman_sql(c):
    return f"""SELECT '{c}' AS feature, round(corr(rx, ry), 6) AS spearman_r FROM (
    SELECT rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0e0 AS rx, rank() OVER (ORDER BY label) + (count(*) OVER (PARTITION BY label) - 1) / 2.0e0 AS ry
    FROM readings WHERE {c} IS NOT NULL)"""


@query("ts_spearman", with_sql(READINGS_SQL, " UNION ALL ".join(_spearman_sql(c) for c in _COLS)))
def ts_spearman(spark, sf):
    return rounded(stats.spearman(readings(spark, sf), _COLS, "label").drop("spearman_p"), 6, "spearman_r")


@query(
    "ts_pointbiserial",
    with_sql(READINGS_SQL, " UNION ALL ".join(f"SELECT '{c}' AS feature, round(corr({c}, label), 6) AS pointbiserial_r FROM readings" for c in _COLS)),
)
def ts_pointbiserial(spark, sf):
    return rounded(stats.point_biserial(readings(spark, sf), _COLS, "label").drop("pointbiserial_p"), 6, "pointbiserial_r")


@query("ts_correlations")
def ts_correlations(spark, sf):
    """The whole correlation report with all p-values."""
    return stats.correlation_table(readings(spark, sf), _COLS, "label")


@query(
    "ts_ks2",
    """WITH v AS (SELECT value AS x, event_type = 'click' AS f FROM events WHERE event_type IN ('click', 'view')),
    g AS (SELECT x, CAST(count(*) FILTER (f) AS DOUBLE) AS a, CAST(count(*) FILTER (NOT f) AS DOUBLE) AS b FROM v GROUP BY x)
    SELECT 'value' AS feature, round(max(abs(fa - fb)), 8) AS ks_statistic, (SELECT count(*) FROM v WHERE f) AS n1, (SELECT count(*) FROM v WHERE NOT f) AS n2
    FROM (SELECT sum(a) OVER (ORDER BY x) / (SELECT sum(a) FROM g) AS fa, sum(b) OVER (ORDER BY x) / (SELECT sum(b) FROM g) AS fb FROM g)""",
)
def ts_ks2(spark, sf):
    e = table(spark, sf, "events").where(F.col("event_type").isin("click", "view"))
    rows = e.select(F.lit("value").alias("feature"), "value", (F.col("event_type") == "click").alias("first"))
    out = stats.ks_two_sample(rows, "feature", "value", "first")
    return rounded(out.select("feature", "ks_statistic", "n1", "n2"), 8, "ks_statistic")


# ---- ensembles of given predictions ----------------------------------------

_THREE_SQL = SCORED_SQL + ", three AS (SELECT row_id, label, y, " + ", ".join(
    f"round({uniform_sql('row_id', 20 + i)} * 0.6e0 + label * 0.4e0, 3) AS p{i}" for i in range(3)
) + ", " + ", ".join(f"y + {uniform_sql('row_id', 30 + i)} * 10 AS r{i}" for i in range(3)) + " FROM scored)"


def three(spark, sf):
    s = scored(spark, sf)
    return s.select(
        "row_id",
        "label",
        "y",
        *[F.round(uniform("row_id", 20 + i) * 0.6 + F.col("label") * 0.4, 3).alias(f"p{i}") for i in range(3)],
        *[(F.col("y") + uniform("row_id", 30 + i) * 10).alias(f"r{i}") for i in range(3)],
    )


@query(
    "en_hard",
    with_sql(_THREE_SQL, "SELECT row_id, CAST((p0 >= 0.5)::INT + (p1 >= 0.5)::INT + (p2 >= 0.5)::INT >= 2 AS INTEGER) AS prediction FROM three"),
)
def en_hard(spark, sf):
    from tabforge.operators.ensemble import hard_vote

    votes = [(F.col(f"p{i}") >= 0.5).cast("int") for i in range(3)]
    return three(spark, sf).select("row_id", hard_vote(votes, [0, 1]).alias("prediction"))


@query(
    "en_soft",
    with_sql(_THREE_SQL, "SELECT row_id, round((p0 + p1 + p2) / 3, 8) AS p1, CAST(round((p0 + p1 + p2) / 3, 8) > 0.5 AS INTEGER) AS prediction FROM three"),
)
def en_soft(spark, sf):
    from tabforge.operators.ensemble import arg_max_class, soft_vote

    t = three(spark, sf)
    mean = soft_vote([F.array(1 - F.col(f"p{i}"), F.col(f"p{i}")) for i in range(3)])
    exact = F.transform(mean, lambda p: F.round(p, 8))
    return t.select("row_id", F.get(exact, F.lit(1)).alias("p1"), arg_max_class(exact).alias("prediction"))


@query("en_avg", with_sql(_THREE_SQL, "SELECT row_id, round((r0 + r1 + r2) / 3, 6) AS prediction FROM three"))
def en_avg(spark, sf):
    from tabforge.operators.ensemble import mean_prediction

    return three(spark, sf).select("row_id", F.round(mean_prediction(["r0", "r1", "r2"]), 6).alias("prediction"))


@query(
    "en_biascorrect",
    with_sql(
        SCORED_SQL,
        f"""SELECT row_id, round(y_hat - (SELECT avg(y_hat - y) FROM scored WHERE {uniform_sql('row_id', 42)} < 0.8e0), 6) AS prediction FROM scored WHERE {uniform_sql('row_id', 42)} >= 0.8e0""",
    ),
)
def en_biascorrect(spark, sf):
    from tabforge.operators.ensemble import bias_corrected
    from tabforge.operators.split import random_split

    s = random_split(scored(spark, sf), "row_id")
    out = bias_corrected(s.where("is_train"), s.where("NOT is_train"), "y", "y_hat")
    return out.select("row_id", F.round("y_hat", 6).alias("prediction"))


@query(
    "ex_cv",
    with_sql(
        SCORED_SQL
        + f""", f AS (SELECT *, CAST(floor({uniform_sql('row_id', 42)} * 5) AS INTEGER) AS fold FROM scored),
        m AS (SELECT fold, CAST(count(*) FILTER (label = prediction) AS DOUBLE) / count(*) AS accuracy, CAST(count(*) FILTER (label = 1 AND prediction = 1) AS DOUBLE) / count(*) FILTER (prediction = 1) AS precision,
        CAST(count(*) FILTER (label = 1 AND prediction = 1) AS DOUBLE) / count(*) FILTER (label = 1) AS recall FROM f GROUP BY fold),
        sc AS (SELECT fold, score, count(*) FILTER (label = 1) AS pos, count(*) FILTER (label = 0) AS neg FROM f GROUP BY 1, 2),
        au AS (SELECT fold, sum(pos * (below + neg / 2.0e0)) / (sum(pos) * CAST(sum(neg) AS DOUBLE)) AS auc FROM (SELECT *, sum(neg) OVER (PARTITION BY fold ORDER BY score) - neg AS below FROM sc) GROUP BY fold)""",
        """SELECT round(avg(auc), 6) AS auc_mean, round(stddev_pop(auc), 6) AS auc_std, round(avg(accuracy), 6) AS accuracy_mean, round(stddev_pop(accuracy), 6) AS accuracy_std,
        round(avg(precision), 6) AS precision_mean, round(avg(recall), 6) AS recall_mean, round(avg(2 * precision * recall / (precision + recall)), 6) AS f1_score_mean FROM m JOIN au USING (fold)""",
    ),
)
def ex_cv(spark, sf):
    from tabforge.operators.experiments import cross_validated_metrics
    from tabforge.operators.split import kfold

    out = cross_validated_metrics(kfold(scored(spark, sf), "row_id"), fold="fold")
    cols = ["auc_mean", "auc_std", "accuracy_mean", "accuracy_std", "precision_mean", "recall_mean", "f1_score_mean"]
    return rounded(out.select(*cols), 6, *cols)
