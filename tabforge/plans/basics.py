"""Projections, filters, joins, sets, sorts and window queries (inventory 2.2, 2.3, 2.5-2.7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabforge.functions.moments import exact_mean
from tabforge.operators import clean, leaderboard, profile
from tabforge.plans.catalog import query, table
from tabforge.plans.inputs import READINGS_SQL, RUNS_SQL, readings, runs, with_sql

GAPS = ["a", "b", "c", "h"]


# ---- projections -----------------------------------------------------------


@query(
    "prj_drop",
    "SELECT o_orderkey, o_custkey, o_orderstatus, round(o_totalprice, 2) AS o_totalprice FROM orders",
)
def prj_drop(spark, sf):
    out = table(spark, sf, "orders").drop("o_orderdate", "o_orderpriority")
    return out.withColumn("o_totalprice", F.round("o_totalprice", 2))


@query(
    "prj_xy",
    with_sql(READINGS_SQL, "SELECT row_id, v AS x_v, k AS x_k, h AS x_h, label AS y FROM readings"),
)
def prj_xy(spark, sf):
    r = readings(spark, sf)
    return r.select("row_id", *[F.col(c).alias(f"x_{c}") for c in ("v", "k", "h")], F.col("label").alias("y"))


@query(
    "prj_dtype",
    "SELECT 'numeric' AS kind, p_partkey AS row_id, CAST(p_size AS DOUBLE) AS num_sum, CAST(NULL AS VARCHAR) AS texts FROM part "
    "UNION ALL SELECT 'text', p_partkey, NULL, p_name || '|' || p_brand || '|' || p_type FROM part",
)
def prj_dtype(spark, sf):
    p = table(spark, sf, "part")
    numeric = [c for c in profile.numeric_columns(p) if c not in ("p_partkey", "p_retailprice")]
    total = sum((F.col(c) for c in numeric), F.lit(0)).cast("double")
    texts = F.concat_ws("|", *profile.text_columns(p))
    arms = F.array(
        F.struct(F.lit("numeric").alias("kind"), total.alias("num_sum"), F.lit(None).cast("string").alias("texts")),
        F.struct(F.lit("text").alias("kind"), F.lit(None).cast("double").alias("num_sum"), texts.alias("texts")),
    )
    return p.select(F.col("p_partkey").alias("row_id"), F.explode(arms).alias("r")).select("row_id", "r.*")


@query(
    "prj_display",
    with_sql(RUNS_SQL, "SELECT model, normalization, round(accuracy, 4) AS accuracy, round(roc_auc, 4) AS roc_auc FROM runs"),
)
def prj_display(spark, sf):
    return runs(spark, sf).select("model", "normalization", *[F.round(c, 4).alias(c) for c in ("accuracy", "roc_auc")])


@query("prj_tag", with_sql(RUNS_SQL, "SELECT model, normalization, accuracy, 'KNN' AS imputation FROM runs"))
def prj_tag(spark, sf):
    return runs(spark, sf).select("model", "normalization", "accuracy", F.lit("KNN").alias("imputation"))


# ---- filters ---------------------------------------------------------------


@query(
    "flt_topclass",
    """SELECT doc_id, source FROM documents WHERE source IN
    (SELECT source FROM documents GROUP BY source ORDER BY count(*) DESC, source LIMIT 4)""",
)
def flt_topclass(spark, sf):
    return clean.keep_top_classes(table(spark, sf, "documents").select("doc_id", "source"), "source", 4)


@query(
    "flt_sentinel",
    """SELECT 'l_discount' AS feature, count(*) FILTER (l_discount = 0) AS hits, round(count(*) FILTER (l_discount = 0) * 100.0e0 / count(*), 6) AS hit_pct FROM lineitem
    UNION ALL SELECT 'l_tax', count(*) FILTER (l_tax = 0), round(count(*) FILTER (l_tax = 0) * 100.0e0 / count(*), 6) FROM lineitem""",
)
def flt_sentinel(spark, sf):
    out = clean.sentinel_report(table(spark, sf, "lineitem"), {"l_discount": 0.0, "l_tax": 0.0})
    return out.withColumn("hit_pct", F.round("hit_pct", 6))


@query(
    "flt_sentinel_clean",
    """SELECT l_returnflag, l_linestatus, count(*) AS n, count(CASE WHEN l_discount <> 0 THEN l_discount END) AS n_discount,
    round(avg(CASE WHEN l_discount <> 0 THEN l_discount END), 9) AS mean_discount, count(CASE WHEN l_tax <> 0 THEN l_tax END) AS n_tax
    FROM lineitem GROUP BY 1, 2""",
)
def flt_sentinel_clean(spark, sf):
    cols = ["l_returnflag", "l_linestatus", "l_discount", "l_tax"]
    cleaned = clean.clean_sentinels(table(spark, sf, "lineitem").select(*cols), {"l_discount": 0.0, "l_tax": 0.0})
    return cleaned.groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n"),
        F.count("l_discount").alias("n_discount"),
        F.round(F.avg("l_discount"), 9).alias("mean_discount"),
        F.count("l_tax").alias("n_tax"),
    )


@query(
    "flt_const",
    """SELECT 'o_totalprice' AS feature, CAST(count(DISTINCT o_totalprice) <= 1 AS INTEGER) AS is_constant FROM orders
    UNION ALL SELECT 'o_orderstatus', CAST(count(DISTINCT o_orderstatus) <= 1 AS INTEGER) FROM orders
    UNION ALL SELECT 'loud_cover', CAST(count(DISTINCT o_totalprice * 0) <= 1 AS INTEGER) FROM orders""",
)
def flt_const(spark, sf):
    o = table(spark, sf, "orders").withColumn("loud_cover", F.col("o_totalprice") * 0)
    return clean.constant_columns(o, ["o_totalprice", "o_orderstatus", "loud_cover"])


@query(
    "flt_complete",
    with_sql(READINGS_SQL, "SELECT row_id, a, b, c FROM readings WHERE a IS NOT NULL AND b IS NOT NULL AND c IS NOT NULL"),
)
def flt_complete(spark, sf):
    return clean.complete_cases(readings(spark, sf).select("row_id", "a", "b", "c"), ["a", "b", "c"])


@query(
    "flt_mask",
    "SELECT event_id AS row_id, value FROM events WHERE value <= 150",
)
def flt_mask(spark, sf):
    e = table(spark, sf, "events").select(F.col("event_id").alias("row_id"), "value")
    return e.withColumn("is_inlier", F.col("value") <= 150).where("is_inlier").drop("is_inlier")


_CORR_SQL = """, r AS (SELECT 'a' AS feature, corr(a, label) AS r, count(a) AS n FROM readings
 UNION ALL SELECT 'b', corr(b, label), count(b) FROM readings UNION ALL SELECT 'c', corr(c, label), count(c) FROM readings
 UNION ALL SELECT 'h', corr(h, label), count(h) FROM readings)"""


@query(
    "flt_signif",
    with_sql(
        READINGS_SQL + _CORR_SQL,
        """SELECT feature, round(r, 6) AS r, CASE WHEN r > 0 THEN 'positive' ELSE 'negative' END AS direction FROM r
        WHERE abs(r) * sqrt((n - 2) / (1 - r * r)) > 1.96e0""",
    ),
)
def flt_signif(spark, sf):
    """Two-sided p below 0.05 (large samples: |t| above 1.96)."""
    from tabforge.operators.stats import pearson

    out = pearson(readings(spark, sf), GAPS, "label").where("pearson_p < 0.05")
    direction = F.when(F.col("pearson_r") > 0, "positive").otherwise("negative")
    return out.select("feature", F.round("pearson_r", 6).alias("r"), direction.alias("direction"))


@query(
    "flt_band",
    with_sql(
        READINGS_SQL + _CORR_SQL,
        "SELECT feature, CASE WHEN abs(r) > 0.3 THEN 'strong' WHEN abs(r) > 0.2 THEN 'moderate' ELSE 'weak' END AS band FROM r",
    ),
)
def flt_band(spark, sf):
    from tabforge.functions.scalar import correlation_band

    return profile.correlation_with(readings(spark, sf), GAPS, "label").select("feature", correlation_band("r").alias("band"))


@query(
    "flt_missing",
    with_sql(
        READINGS_SQL,
        """SELECT feature, missing, round(missing_pct, 6) AS missing_pct, CAST(missing_pct > 30 AS INTEGER) AS heavy FROM (
        SELECT 'a' AS feature, count(*) FILTER (a IS NULL) AS missing, 100.0e0 * count(*) FILTER (a IS NULL) / count(*) AS missing_pct FROM readings
        UNION ALL SELECT 'b', count(*) FILTER (b IS NULL), 100.0e0 * count(*) FILTER (b IS NULL) / count(*) FROM readings
        UNION ALL SELECT 'c', count(*) FILTER (c IS NULL), 100.0e0 * count(*) FILTER (c IS NULL) / count(*) FROM readings
        UNION ALL SELECT 'h', count(*) FILTER (h IS NULL), 100.0e0 * count(*) FILTER (h IS NULL) / count(*) FROM readings) WHERE missing > 0""",
    ),
)
def flt_missing(spark, sf):
    rep = profile.missing_report(readings(spark, sf), GAPS).where("missing > 0")
    return rep.select(
        "feature", "missing", F.round("missing_pct", 6).alias("missing_pct"), (F.col("missing_pct") > 30).cast("int").alias("heavy")
    )


@query(
    "flt_exists",
    with_sql(RUNS_SQL, "SELECT model, normalization, accuracy FROM runs WHERE accuracy < (SELECT CAST(sum(CAST(accuracy AS DECIMAL(18, 6))) AS DOUBLE) / count(*) FROM runs)"),
)
def flt_exists(spark, sf):
    """Runs not registered yet; here the registry holds those at or above the mean accuracy."""
    new = runs(spark, sf).select("model", "normalization", "accuracy")
    mean = new.agg(exact_mean("accuracy").alias("m")).scalar()
    registered = new.where(F.col("accuracy") >= mean).select("model", "normalization")
    return leaderboard.unregistered(new, registered, ["model", "normalization"])


# ---- joins -----------------------------------------------------------------


@query("jn_rowid", with_sql(READINGS_SQL, "SELECT row_id, v, k, label FROM readings"))
def jn_rowid(spark, sf):
    r = readings(spark, sf)
    return r.select("row_id", "v", "k").join(r.select("row_id", "label"), "row_id")


_TWO_RUNS_SQL = (
    RUNS_SQL
    + """, run_a AS (SELECT model, max(accuracy) AS best FROM runs WHERE normalization IN ('None', 'StandardScaler') GROUP BY model),
run_b AS (SELECT model, max(accuracy) AS best FROM runs WHERE normalization IN ('MinMaxScaler', 'RobustScaler') AND model <> 'Random Forest' GROUP BY model)"""
)


def _two_runs(spark, sf):
    r = runs(spark, sf)
    a = r.where(F.col("normalization").isin("None", "StandardScaler"))
    b = r.where(F.col("normalization").isin("MinMaxScaler", "RobustScaler") & (F.col("model") != "Random Forest"))
    return a, b


@query(
    "jn_common",
    with_sql(
        _TWO_RUNS_SQL,
        "SELECT model, a.best AS metric_a, b.best AS metric_b, round(b.best - a.best, 6) AS delta FROM run_a a JOIN run_b b USING (model)",
    ),
)
def jn_common(spark, sf):
    a, b = _two_runs(spark, sf)
    out = leaderboard.compare_runs(a, b, "accuracy")
    return out.withColumn("delta", F.round("delta", 6))


@query(
    "jn_merge",
    with_sql(
        READINGS_SQL,
        """SELECT row_id, coalesce(a, (SELECT median(a) FROM readings)) AS a, coalesce(b, (SELECT round(avg(b), 6) FROM readings)) AS b,
        coalesce(c, (SELECT median(c) FROM readings)) AS c FROM readings""",
    ),
)
def jn_merge(spark, sf):
    """Each column from the copy made by its assigned method."""
    from tabforge.operators.impute import ColumnImputer, merge_methods

    r = readings(spark, sf).select("row_id", "a", "b", "c")
    cols = ["a", "b", "c"]
    by_median = ColumnImputer(inputCols=cols, strategy="median").fit(r)
    by_mean = ColumnImputer(inputCols=cols, strategy="mean").fit(r)
    wide = by_median.add_filled(r, "median")
    wide = by_mean.add_filled(wide, "mean", decimals=6)
    return merge_methods(wide, {"a": "median", "b": "mean", "c": "median"}, keep=["row_id"])


@query(
    "jn_label",
    "SELECT event_id AS row_id, CASE event_type WHEN 'click' THEN 0 WHEN 'error' THEN 1 WHEN 'purchase' THEN 2 WHEN 'signup' THEN 3 ELSE 4 END AS code FROM events",
)
def jn_label(spark, sf):
    e = table(spark, sf, "events")
    codes = spark.createDataFrame(
        [("click", 0), ("error", 1), ("purchase", 2), ("signup", 3), ("view", 4)], "event_type string, code int"
    )
    return e.join(F.broadcast(codes), "event_type", "left").select(F.col("event_id").alias("row_id"), "code")


@query(
    "jn_grid",
    """SELECT DISTINCT e.event_type || '_model' AS model, s.scaler FROM events e,
    (VALUES ('none'), ('standard'), ('minmax'), ('robust')) s(scaler)""",
)
def jn_grid(spark, sf):
    """Every model with every scaler; the four scalers unfold from an array."""
    models = table(spark, sf, "events").select(F.concat("event_type", F.lit("_model")).alias("model")).distinct()
    return leaderboard.grid(models, "scaler", ["none", "standard", "minmax", "robust"])


@query(
    "jn_baseline",
    with_sql(
        RUNS_SQL,
        """SELECT model, normalization, round((accuracy - b) / b * 100, 6) AS change_pct, round((accuracy - b) * 100, 6) AS change_pp
        FROM runs, (SELECT accuracy AS b FROM runs WHERE model = 'Logistic Regression' AND normalization = 'None')""",
    ),
)
def jn_baseline(spark, sf):
    r = runs(spark, sf)
    base = r.where("model = 'Logistic Regression' AND normalization = 'None'").select("accuracy")
    out = leaderboard.against_baseline(r, "accuracy", base)
    return out.select("model", "normalization", F.round("change_pct", 6).alias("change_pct"), F.round("change_pp", 6).alias("change_pp"))


@query("jn_semi", "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")
def jn_semi(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    c = table(spark, sf, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    return o.join(c, "o_custkey", "left_semi").select("o_orderkey", "o_custkey")


@query("jn_anti", "SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)")
def jn_anti(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_name")
    o = table(spark, sf, "orders").where("o_totalprice > 400000").select(F.col("o_custkey").alias("c_custkey"))
    return c.join(o, "c_custkey", "left_anti")


# ---- windows ---------------------------------------------------------------


@query(
    "wn_rank",
    with_sql(RUNS_SQL, "SELECT model, normalization, row_number() OVER (ORDER BY accuracy DESC, model, normalization) AS place FROM runs"),
)
def wn_rank(spark, sf):
    return leaderboard.ranked(runs(spark, sf), "accuracy").select("model", "normalization", "place")


@query(
    "wn_dedup",
    with_sql(
        RUNS_SQL,
        """SELECT model, normalization, accuracy FROM (SELECT *, row_number() OVER (PARTITION BY model ORDER BY accuracy DESC, normalization) AS rn FROM runs) WHERE rn = 1""",
    ),
)
def wn_dedup(spark, sf):
    return leaderboard.best_per(runs(spark, sf), "model", "accuracy", ["normalization"]).select("model", "normalization", "accuracy")


@query(
    "wn_topkeepall",
    "SELECT p_partkey, p_size FROM (SELECT p_partkey, p_size, rank() OVER (ORDER BY p_size DESC) AS r FROM part) WHERE r <= 10",
)
def wn_topkeepall(spark, sf):
    """Top ten with all ties: the tenth largest value is found first, then one filter."""
    p = table(spark, sf, "part").select("p_partkey", "p_size")
    return leaderboard.top_with_ties(p, "p_size", 10)


@query(
    "wn_cum",
    """SELECT value AS key, CAST(sum(n) OVER (ORDER BY value) AS BIGINT) AS n_to, CAST(sum(n) OVER (ORDER BY value) - n AS BIGINT) AS n_before
    FROM (SELECT value, count(*) AS n FROM events GROUP BY value)""",
)
def wn_cum(spark, sf):
    from tabforge.operators.prefix import running_totals

    counts = table(spark, sf, "events").groupBy(F.col("value").alias("key")).agg(F.count(F.lit(1)).alias("n"))
    return running_totals(counts, "key", ["n"]).select("key", "n_to", "n_before")


@query(
    "wn_lagroll",
    """SELECT event_id AS row_id, lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS lag1,
    round(avg(value) OVER (PARTITION BY user_id ORDER BY epoch_us(ts) RANGE BETWEEN 10800000000 PRECEDING AND CURRENT ROW), 6) AS mean_3h,
    round(avg(value) OVER (PARTITION BY user_id ORDER BY epoch_us(ts) RANGE BETWEEN 21600000000 PRECEDING AND CURRENT ROW), 6) AS mean_6h FROM events""",
)
def wn_lagroll(spark, sf):
    """Previous reading and trailing 3 h / 6 h means per sensor."""
    from tabforge.operators.timeseries import lag_and_trailing_means

    hour = 3_600_000_000
    e = table(spark, sf, "events").select(F.col("event_id").alias("row_id"), "user_id", "ts", "value")
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    out = lag_and_trailing_means(e, "user_id", micros, "row_id", "value", {"mean_3h": 3 * hour, "mean_6h": 6 * hour})
    return out.select("row_id", "lag1", F.round("mean_3h", 6).alias("mean_3h"), F.round("mean_6h", 6).alias("mean_6h"))


# ---- sort, limit -----------------------------------------------------------


@query("st_sort", with_sql(RUNS_SQL, "SELECT model, normalization, roc_auc FROM runs ORDER BY roc_auc DESC NULLS LAST, model, normalization"))
def st_sort(spark, sf):
    return leaderboard.sort_by_metric(runs(spark, sf), "roc_auc").select("model", "normalization", "roc_auc")


@query("st_abs", with_sql(READINGS_SQL + _CORR_SQL, "SELECT feature, round(r, 6) AS r FROM r ORDER BY abs(r) DESC"))
def st_abs(spark, sf):
    out = profile.correlation_with(readings(spark, sf), GAPS, "label").orderBy(F.abs("r").desc())
    return out.select("feature", F.round("r", 6).alias("r"))


@query("st_topk", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def st_topk(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_totalprice").orderBy(F.col("o_totalprice").desc(), "o_orderkey").limit(10)


@query(
    "st_sortedsample",
    "SELECT event_id AS row_id, value AS y FROM events ORDER BY value, event_id LIMIT 500",
)
def st_sortedsample(spark, sf):
    e = table(spark, sf, "events").select(F.col("event_id").alias("row_id"), F.col("value").alias("y"))
    return e.orderBy("y", "row_id").limit(500)


# ---- sets ------------------------------------------------------------------


@query(
    "set_union",
    with_sql(
        RUNS_SQL,
        """SELECT model, normalization, accuracy, CAST(NULL AS DOUBLE) AS mae FROM runs WHERE normalization = 'None'
        UNION ALL SELECT model, normalization, NULL, 1 - accuracy FROM runs WHERE normalization = 'RobustScaler'""",
    ),
)
def set_union(spark, sf):
    r = runs(spark, sf)
    a = r.where("normalization = 'None'").select("model", "normalization", "accuracy")
    b = r.where("normalization = 'RobustScaler'").select("model", "normalization", (1 - F.col("accuracy")).alias("mae"))
    return a.unionByName(b, allowMissingColumns=True)


@query("set_intersect", with_sql(_TWO_RUNS_SQL, "SELECT model FROM run_a INTERSECT SELECT model FROM run_b"))
def set_intersect(spark, sf):
    a, b = _two_runs(spark, sf)
    return a.select("model").intersect(b.select("model"))


@query("set_except", with_sql(_TWO_RUNS_SQL, "SELECT model FROM run_a EXCEPT SELECT model FROM run_b"))
def set_except(spark, sf):
    a, b = _two_runs(spark, sf)
    return a.select("model").subtract(b.select("model"))
