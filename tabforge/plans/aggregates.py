"""Profiles and aggregations (inventory 2.4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabforge.operators import leaderboard, profile
from tabforge.operators.quantiles import exact_quantiles
from tabforge.plans.basics import _CORR_SQL, _TWO_RUNS_SQL, _two_runs
from tabforge.plans.catalog import query, table
from tabforge.plans.inputs import READINGS_SQL, RUNS_SQL, SCORED_SQL, readings, runs, scored, with_sql

LINE_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def rounded(df, digits, *columns):
    return df.withColumns({c: F.round(c, digits) for c in columns})


def _describe_sql(cols, src):
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, count({c}) AS n, round(avg({c}), 5) AS mean, round(stddev_samp({c}), 5) AS std, CAST(min({c}) AS DOUBLE) AS min,
        round(quantile_cont({c}, 0.25), 6) AS q25, round(quantile_cont({c}, 0.5), 6) AS q50, round(quantile_cont({c}, 0.75), 6) AS q75, CAST(max({c}) AS DOUBLE) AS max FROM {src}"""
        for c in cols
    )


@query("ag_describe", _describe_sql(LINE_COLS, "lineitem"))
def ag_describe(spark, sf):
    out = profile.describe(table(spark, sf, "lineitem").select(*LINE_COLS))
    return rounded(rounded(out, 5, "mean", "std"), 6, "q25", "q50", "q75")


@query(
    "ag_target",
    """SELECT round(avg(value), 6) AS mean, round(median(value), 6) AS median, round(stddev_samp(value), 6) AS std, min(value) AS min, max(value) AS max,
    round(max(value) - min(value), 6) AS range, round(skewness(value), 6) AS skew, round(kurtosis(value), 6) AS kurtosis FROM events""",
)
def ag_target(spark, sf):
    out = profile.target_profile(table(spark, sf, "events"), "value")
    return rounded(out, 6, "mean", "median", "std", "range", "skew", "kurtosis")


@query(
    "ag_valuecounts",
    with_sql(
        READINGS_SQL,
        "SELECT cat AS value, count(*) AS n, round(count(*) / (SELECT CAST(count(*) AS DOUBLE) FROM readings), 8) AS share FROM readings GROUP BY cat",
    ),
)
def ag_valuecounts(spark, sf):
    return rounded(profile.value_counts(readings(spark, sf), "cat", dropna=False), 8, "share")


@query(
    "ag_nunique",
    """SELECT 'lang' AS feature, count(DISTINCT lang) AS n_distinct, (SELECT string_agg(v, '|' ORDER BY v) FROM (SELECT DISTINCT lang AS v FROM documents)) AS listed FROM documents
    UNION ALL SELECT 'source', count(DISTINCT source), (SELECT string_agg(v, '|' ORDER BY v) FROM (SELECT DISTINCT source AS v FROM documents)) FROM documents
    UNION ALL SELECT 'n_chars', count(DISTINCT n_chars), NULL FROM documents""",
)
def ag_nunique(spark, sf):
    return profile.distinct_values(table(spark, sf, "documents"), ["lang", "source", "n_chars"])


@query(
    "ag_missing",
    with_sql(
        READINGS_SQL,
        " UNION ALL ".join(
            f"SELECT '{c}' AS feature, count(*) FILTER ({c} IS NULL) AS missing, round(100.0e0 * count(*) FILTER ({c} IS NULL) / count(*), 6) AS missing_pct, count(*) AS total FROM readings"
            for c in ("a", "b", "c", "h", "cat")
        ),
    ),
)
def ag_missing(spark, sf):
    return rounded(profile.missing_report(readings(spark, sf), ["a", "b", "c", "h", "cat"]), 6, "missing_pct")


@query(
    "ag_missing_by_class",
    with_sql(
        READINGS_SQL,
        """SELECT label, count(*) AS n, CAST(sum((a IS NULL)::INT + (b IS NULL)::INT + (c IS NULL)::INT) AS BIGINT) AS missing_cells,
        round(100.0e0 * sum((a IS NULL)::INT + (b IS NULL)::INT + (c IS NULL)::INT) / (count(*) * 3), 6) AS missing_pct FROM readings GROUP BY label""",
    ),
)
def ag_missing_by_class(spark, sf):
    return rounded(profile.missing_by_class(readings(spark, sf), "label", ["a", "b", "c"]), 6, "missing_pct")


@query(
    "ag_imbalance",
    """SELECT max(n) AS largest, min(n) AS smallest, round(max(n) / CAST(min(n) AS DOUBLE), 6) AS ratio, CAST(max(n) / CAST(min(n) AS DOUBLE) > 1.5 AS INTEGER) AS imbalanced
    FROM (SELECT quality, count(*) AS n FROM labels GROUP BY quality)""",
)
def ag_imbalance(spark, sf):
    return rounded(profile.class_balance(table(spark, sf, "labels"), "quality"), 6, "ratio")


@query(
    "ag_classweight",
    """SELECT quality AS label, count(*) AS n, round((SELECT CAST(count(*) AS DOUBLE) FROM labels) / ((SELECT count(DISTINCT quality) FROM labels) * count(*)), 8) AS weight FROM labels GROUP BY quality""",
)
def ag_classweight(spark, sf):
    return rounded(profile.class_weights(table(spark, sf, "labels"), "quality"), 8, "weight")


_METRICS = ["accuracy", "precision", "recall", "f1_score", "roc_auc"]


@query(
    "ag_groupmean",
    with_sql(
        RUNS_SQL,
        "SELECT normalization, " + ", ".join(f"round(avg({m}), 6) AS {m}" for m in _METRICS) + " FROM runs GROUP BY normalization",
    ),
)
def ag_groupmean(spark, sf):
    return runs(spark, sf).groupBy("normalization").agg(*[F.round(F.avg(m), 6).alias(m) for m in _METRICS])


@query(
    "ag_pivot",
    with_sql(
        RUNS_SQL,
        """SELECT model, """
        + ", ".join(
            f"round(avg(accuracy) FILTER (normalization = '{s}'), 6) AS \"{s}\""
            for s in ("None", "StandardScaler", "MinMaxScaler", "RobustScaler")
        )
        + " FROM runs GROUP BY model",
    ),
)
def ag_pivot(spark, sf):
    scalers = ["None", "StandardScaler", "MinMaxScaler", "RobustScaler"]
    wide = runs(spark, sf).groupBy("model").pivot("normalization", scalers).agg(F.avg("accuracy"))
    return rounded(wide, 6, *scalers)


@query(
    "ag_argbest",
    with_sql(RUNS_SQL, "SELECT model, normalization, roc_auc FROM runs ORDER BY roc_auc DESC, model, normalization LIMIT 1"),
)
def ag_argbest(spark, sf):
    return leaderboard.best_row(runs(spark, sf), "roc_auc", ["model", "normalization"]).select("model", "normalization", "roc_auc")


@query(
    "ag_foldstats",
    with_sql(
        SCORED_SQL,
        """SELECT round(avg(acc), 6) AS mean, round(stddev_pop(acc), 6) AS std_folds, round(stddev_samp(acc), 6) AS std_seeds FROM (
        SELECT row_id % 5 AS fold, avg(CAST(label = prediction AS INTEGER)) AS acc FROM scored GROUP BY 1)""",
    ),
)
def ag_foldstats(spark, sf):
    from tabforge.operators.experiments import fold_stats
    from tabforge.operators.metrics import binary_metrics

    folds = binary_metrics(scored(spark, sf).withColumn("fold", F.col("row_id") % 5), by=["fold"])
    out = fold_stats(folds, ["accuracy"])
    return out.select(
        F.round("accuracy_mean", 6).alias("mean"),
        F.round("accuracy_std", 6).alias("std_folds"),
        F.round("accuracy_std_samp", 6).alias("std_seeds"),
    )


@query(
    "ag_summary",
    with_sql(
        RUNS_SQL,
        """SELECT round(avg(accuracy), 6) AS accuracy_mean, round(stddev_samp(accuracy), 6) AS accuracy_std, round(avg(roc_auc), 6) AS auc_mean, round(stddev_samp(roc_auc), 6) AS auc_std,
        round(avg(training_time_s), 6) AS time_mean, round(stddev_samp(training_time_s), 6) AS time_std FROM runs""",
    ),
)
def ag_summary(spark, sf):
    pairs = {"accuracy": "accuracy", "auc": "roc_auc", "time": "training_time_s"}
    return runs(spark, sf).agg(
        *[e for k, c in pairs.items() for e in (F.round(F.avg(c), 6).alias(f"{k}_mean"), F.round(F.stddev_samp(c), 6).alias(f"{k}_std"))]
    )


@query(
    "ag_classmeans",
    with_sql(
        READINGS_SQL,
        " UNION ALL ".join(
            f"""SELECT '{c}' AS feature, round(avg({c}) FILTER (label = 0), 6) AS mean_negative, round(avg({c}) FILTER (label = 1), 6) AS mean_positive,
            round(avg({c}) FILTER (label = 1) - avg({c}) FILTER (label = 0), 6) AS diff_means FROM readings"""
            for c in ("a", "b", "c", "h")
        ),
    ),
)
def ag_classmeans(spark, sf):
    out = profile.class_means(readings(spark, sf), ["a", "b", "c", "h"], "label")
    return rounded(out, 6, "mean_negative", "mean_positive", "diff_means")


_GAP_PAIRS = [("a", "b"), ("a", "c"), ("a", "h"), ("b", "c"), ("b", "h"), ("c", "h")]


@query(
    "ag_corrmatrix",
    with_sql(
        READINGS_SQL,
        " UNION ALL ".join(f"SELECT '{x}' AS a, '{y}' AS b, round(corr(r.{x}, r.{y}), 6) AS r FROM readings r" for x, y in _GAP_PAIRS),
    ),
)
def ag_corrmatrix(spark, sf):
    return rounded(profile.correlation_pairs(readings(spark, sf), ["a", "b", "c", "h"]), 6, "r")


@query("ag_corrtarget", with_sql(READINGS_SQL + _CORR_SQL, "SELECT feature, round(r, 6) AS r, n FROM r"))
def ag_corrtarget(spark, sf):
    out = profile.correlation_with(readings(spark, sf), ["a", "b", "c", "h"], "label")
    return rounded(out.orderBy(F.abs("r").desc()), 6, "r")


@query(
    "ag_quantile",
    """SELECT o_orderstatus AS status, round(quantile_cont(o_totalprice, 0.25), 6) AS q25, round(quantile_cont(o_totalprice, 0.75), 6) AS q75,
    round(quantile_cont(o_totalprice, 0.95), 6) AS q95 FROM orders GROUP BY 1""",
)
def ag_quantile(spark, sf):
    """Exact quantiles per status, all found in shared passes."""
    o = table(spark, sf, "orders")
    states = [r[0] for r in o.select("o_orderstatus").distinct().collect()]
    found = exact_quantiles(o, {s: F.when(F.col("o_orderstatus") == s, F.col("o_totalprice")) for s in states}, [0.25, 0.75, 0.95])
    rows = o.select(F.col("o_orderstatus").alias("status")).distinct()
    pick = F.create_map(*[x for s in states for x in (F.lit(s), F.array(*[F.lit(v) for v in found[s]]))])
    return rows.select("status", *[F.round(pick[F.col("status")][i], 6).alias(n) for i, n in enumerate(("q25", "q75", "q95"))])


@query(
    "ag_boxstats",
    with_sql(
        READINGS_SQL
        + """, q AS (SELECT label, quantile_cont(a, 0.25) AS q1, quantile_cont(a, 0.5) AS med, quantile_cont(a, 0.75) AS q3, avg(a) AS mean FROM readings GROUP BY label)""",
        """SELECT CAST(label AS VARCHAR) AS class, round(any_value(q1), 6) AS q1, round(any_value(med), 6) AS median, round(any_value(q3), 6) AS q3,
        min(a) FILTER (a BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_low,
        max(a) FILTER (a BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_high, round(any_value(mean), 6) AS mean
        FROM readings JOIN q USING (label) GROUP BY label""",
    ),
)
def ag_boxstats(spark, sf):
    return rounded(profile.box_stats(readings(spark, sf), "a", "label", [0, 1]), 6, "q1", "median", "q3", "mean")


@query(
    "ag_hist",
    """WITH e AS (SELECT min(value) AS lo, max(value) AS hi FROM events)
    SELECT CAST(least(29, floor((value - lo) / ((hi - lo) / 30.0e0))) AS INTEGER) AS bin, count(*) AS n FROM events, e GROUP BY 1""",
)
def ag_hist(spark, sf):
    return profile.histogram(table(spark, sf, "events"), "value", 30)


@query(
    "ag_kde",
    with_sql(
        READINGS_SQL
        + """, e AS (SELECT min(a) AS lo, max(a) AS hi FROM readings), w AS (SELECT lo, hi, (hi - lo) / 512.0e0 AS width FROM e),
        b AS (SELECT label AS class, least(511, floor((a - lo) / width)) AS bin, count(*) AS n FROM readings, w WHERE a IS NOT NULL GROUP BY 1, 2),
        s AS (SELECT label AS class, count(a) AS total, stddev_samp(a) * pow(count(a), -0.2e0) AS h FROM readings GROUP BY 1)""",
        """SELECT class, CAST(g AS INTEGER) AS grid_no, round(sum(n * exp(-0.5e0 * pow((lo + g * (hi - lo) / 63.0e0 - (lo + (bin + 0.5e0) * width)) / h, 2)) / (total * h)) / sqrt(2 * pi()), 8) AS density
        FROM b JOIN s USING (class), w, range(64) t(g) GROUP BY class, g""",
    ),
)
def ag_kde(spark, sf):
    return rounded(profile.density(readings(spark, sf), "a", "label"), 8, "density")


@query(
    "ag_bandcount",
    with_sql(
        READINGS_SQL + ", d AS (SELECT grp, abs((avg(coalesce(b, 90.0e0)) - avg(b)) / avg(b)) * 100 AS x FROM readings GROUP BY grp)",
        "SELECT count(*) FILTER (x < 5) AS below_5, count(*) FILTER (x >= 5 AND x < 10) AS from_5_to_10, count(*) FILTER (x >= 10) AS from_10 FROM d",
    ),
)
def ag_bandcount(spark, sf):
    """Groups by how far a constant fill moves their mean."""
    from tabforge.functions.scalar import pct_change
    from tabforge.operators.drift import band_counts

    r = readings(spark, sf).groupBy("grp").agg(F.avg("b").alias("m0"), F.avg(F.coalesce("b", F.lit(90.0))).alias("m1"))
    return band_counts(r.select("grp", pct_change("m1", "m0").alias("mean_change_pct")))


_METHODS_SQL = (
    READINGS_SQL
    + """, m AS (SELECT median(a) AS ma, avg(a) AS aa, median(b) AS mb, avg(b) AS ab, median(c) AS mc, avg(c) AS ac FROM readings),
d AS (SELECT feature, o, abs((m1 - o) / o) * 100 AS median_change_pct, abs((m2 - o) / o) * 100 AS mean7_change_pct FROM (
  SELECT 'a' AS feature, avg(a) AS o, avg(coalesce(a, ma)) AS m1, avg(coalesce(a, aa * 1.07e0)) AS m2 FROM readings, m
  UNION ALL SELECT 'b', avg(b), avg(coalesce(b, mb)), avg(coalesce(b, ab * 1.07e0)) FROM readings, m
  UNION ALL SELECT 'c', avg(c), avg(coalesce(c, mc)), avg(coalesce(c, ac * 1.07e0)) FROM readings, m))"""
)


def _method_copies(spark, sf):
    from tabforge.operators.impute import ColumnImputer

    cols = ["a", "b", "c"]
    r = readings(spark, sf).select("row_id", *cols)
    wide = ColumnImputer(inputCols=cols, strategy="median").fit(r).add_filled(r, "median")
    mean = r.agg(*[F.avg(c).alias(c) for c in cols]).select(F.struct("*").alias("m")).scalar()
    return wide.withColumns({f"{c}__mean7": F.coalesce(F.col(c), mean[c] * 1.07) for c in cols})


@query(
    "ag_rowmin",
    with_sql(
        _METHODS_SQL,
        """SELECT feature, round(o, 6) AS original_mean, round(median_change_pct, 6) AS median_change_pct, round(mean7_change_pct, 6) AS mean7_change_pct,
        CASE WHEN median_change_pct <= mean7_change_pct THEN 'median' ELSE 'mean7' END AS best_method, round(least(median_change_pct, mean7_change_pct), 6) AS best_change_pct FROM d""",
    ),
)
def ag_rowmin(spark, sf):
    from tabforge.operators.impute import best_method_table

    out = best_method_table(_method_copies(spark, sf), ["a", "b", "c"], ["median", "mean7"])
    return rounded(out, 6, "original_mean", "median_change_pct", "mean7_change_pct", "best_change_pct")


@query(
    "ag_methodcount",
    with_sql(
        _METHODS_SQL,
        "SELECT CASE WHEN median_change_pct <= mean7_change_pct THEN 'median' ELSE 'mean7' END AS best_method, count(*) AS n FROM d GROUP BY 1",
    ),
)
def ag_methodcount(spark, sf):
    from tabforge.operators.impute import best_method_table

    out = best_method_table(_method_copies(spark, sf), ["a", "b", "c"], ["median", "mean7"])
    return out.groupBy("best_method").agg(F.count(F.lit(1)).alias("n"))


@query(
    "ag_modeltype",
    with_sql(
        RUNS_SQL,
        """SELECT CASE WHEN model LIKE '%Voting%' OR model LIKE '%Stacking%' THEN 'Ensemble' WHEN model LIKE '%GridSearch%' THEN 'GridSearch' ELSE 'Individual' END AS type, count(*) AS n FROM runs GROUP BY 1""",
    ),
)
def ag_modeltype(spark, sf):
    from tabforge.functions.scalar import model_type

    return runs(spark, sf).groupBy(model_type("model").alias("type")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "ag_winloss",
    with_sql(
        _TWO_RUNS_SQL,
        """SELECT count(*) FILTER (b.best - a.best >= 0.001) AS improved, count(*) FILTER (b.best - a.best <= -0.001) AS degraded, count(*) FILTER (abs(b.best - a.best) < 0.001) AS same
        FROM run_a a JOIN run_b b USING (model)""",
    ),
)
def ag_winloss(spark, sf):
    a, b = _two_runs(spark, sf)
    return leaderboard.win_loss(leaderboard.compare_runs(a, b, "accuracy"))
