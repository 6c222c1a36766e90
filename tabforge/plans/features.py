"""Scalar functions, encoders, scalers, samples and splits (inventory 2.8-2.10, 2.21)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabforge.functions import scalar
from tabforge.functions.rng import uniform_sql
from tabforge.operators import split
from tabforge.operators.encode import ColumnScaler, LabelCoder
from tabforge.plans.aggregates import rounded
from tabforge.plans.basics import _TWO_RUNS_SQL, _two_runs
from tabforge.plans.catalog import query, table
from tabforge.plans.inputs import READINGS_SQL, RUNS_SQL, SCORED_SQL, readings, runs, scored, with_sql

# ---- scalar functions ------------------------------------------------------


@query(
    "fn_cast",
    with_sql(
        READINGS_SQL,
        """SELECT row_id, CAST(trunc(v) AS INTEGER) AS v_int, CAST(h AS VARCHAR) AS h_text, CAST(v > 30 AS INTEGER) AS v_flag, TRY_CAST(event_type AS INTEGER) AS bad FROM readings""",
    ),
)
def fn_cast(spark, sf):
    return readings(spark, sf).select(
        "row_id",
        F.col("v").cast("int").alias("v_int"),
        F.col("h").cast("string").alias("h_text"),
        (F.col("v") > 30).cast("int").alias("v_flag"),
        F.col("event_type").try_cast("int").alias("bad"),
    )


@query(
    "fn_missind",
    with_sql(READINGS_SQL, "SELECT row_id, (a IS NULL)::INT AS a, (b IS NULL)::INT AS b, (c IS NULL)::INT AS c, (h IS NULL)::INT AS h, (cat IS NULL)::INT AS cat FROM readings"),
)
def fn_missind(spark, sf):
    cols = ["a", "b", "c", "h", "cat"]
    return readings(spark, sf).select("row_id", *[F.col(c).isNull().cast("int").alias(c) for c in cols])


@query(
    "fn_dateparts",
    with_sql(
        READINGS_SQL,
        "SELECT row_id, substr(stamp, 1, 4)::INT AS year, substr(stamp, 6, 2)::INT AS month, substr(stamp, 9, 2)::INT AS day, substr(stamp, 12, 2)::INT AS hour FROM readings",
    ),
)
def fn_dateparts(spark, sf):
    return readings(spark, sf).select("row_id", *[c.alias(n) for n, c in scalar.date_parts("stamp").items()])


@query(
    "fn_cyclic",
    """SELECT o_orderkey, round(sin(2 * pi() * month(o_orderdate) / 12), 8) AS month_sin, round(cos(2 * pi() * month(o_orderdate) / 12), 8) AS month_cos FROM orders""",
)
def fn_cyclic(spark, sf):
    s, c = scalar.cyclic(F.month("o_orderdate"), 12)
    return table(spark, sf, "orders").select("o_orderkey", F.round(s, 8).alias("month_sin"), F.round(c, 8).alias("month_cos"))


@query(
    "fn_season",
    """SELECT e.event_id AS row_id, CAST(month(ts) IN (12, 1, 2) AS INTEGER) AS is_winter, CAST(month(ts) IN (6, 7, 8) AS INTEGER) AS is_summer, CAST(hour(ts) BETWEEN 6 AND 18 AS INTEGER) AS is_day FROM events e""",
)
def fn_season(spark, sf):
    return table(spark, sf, "events").select(
        F.col("event_id").alias("row_id"),
        scalar.is_winter(F.month("ts")).alias("is_winter"),
        scalar.is_summer(F.month("ts")).alias("is_summer"),
        scalar.is_day(F.hour("ts")).alias("is_day"),
    )


@query("fn_interact", with_sql(READINGS_SQL, "SELECT row_id, round(v * k, 6) AS v_k, round(v * h, 6) AS v_h, round(k - v, 6) AS k_minus_v FROM readings"))
def fn_interact(spark, sf):
    v, k, h = F.col("v"), F.col("k"), F.col("h")
    return readings(spark, sf).select(
        "row_id", F.round(v * k, 6).alias("v_k"), F.round(v * h, 6).alias("v_h"), F.round(k - v, 6).alias("k_minus_v")
    )


@query("fn_square", with_sql(READINGS_SQL, "SELECT row_id, round(v * v, 6) AS v2, round(h * h, 6) AS h2 FROM readings"))
def fn_square(spark, sf):
    return readings(spark, sf).select("row_id", *[F.round(F.col(c) * F.col(c), 6).alias(f"{c}2") for c in ("v", "h")])


@query(
    "fn_windvec",
    with_sql(READINGS_SQL, "SELECT row_id, round(v * cos(radians(k * 3.6e0)), 6) AS wx, round(v * sin(radians(k * 3.6e0)), 6) AS wy FROM readings"),
)
def fn_windvec(spark, sf):
    wx, wy = scalar.wind_vector("v", F.col("k") * 3.6)
    return readings(spark, sf).select("row_id", F.round(wx, 6).alias("wx"), F.round(wy, 6).alias("wy"))


@query(
    "fn_threshold",
    with_sql(
        READINGS_SQL,
        "SELECT row_id, CASE WHEN 1000 + a / 10 < 1010 THEN 1 ELSE 0 END AS low, CASE WHEN 1000 + a / 10 > 1020 THEN 1 ELSE 0 END AS high FROM readings",
    ),
)
def fn_threshold(spark, sf):
    r = readings(spark, sf).withColumn("pressure", 1000 + F.col("a") / 10)
    return r.select("row_id", scalar.flag_below("pressure", 1010).alias("low"), scalar.flag_above("pressure", 1020).alias("high"))


@query("fn_ratio", with_sql(READINGS_SQL, "SELECT row_id, round(v / (k / 100 + 0.01e0), 6) AS ratio FROM readings"))
def fn_ratio(spark, sf):
    return readings(spark, sf).select("row_id", F.round(scalar.safe_ratio("v", F.col("k") / 100), 6).alias("ratio"))


@query(
    "fn_pctchange",
    with_sql(
        READINGS_SQL,
        """SELECT row_id, round(CASE WHEN k <> 0 THEN abs((v - k) / k) * 100 END, 6) AS plain, round(CASE WHEN k <> 0 THEN (v - k) / k * 100 ELSE 0 END, 6) AS zero,
        CASE WHEN k = 0 THEN round(abs((v - 1e-10) / 1e-10) / 1e10, 3) ELSE round(abs((v - k) / k) * 100, 6) END AS eps FROM readings""",
    ),
)
def fn_pctchange(spark, sf):
    eps = scalar.pct_change("v", "k", on_zero="epsilon")
    return readings(spark, sf).select(
        "row_id",
        F.round(scalar.pct_change("v", "k"), 6).alias("plain"),
        F.round(scalar.pct_change("v", "k", on_zero="zero", signed=True), 6).alias("zero"),
        F.when(F.col("k") == 0, F.round(eps / 1e12, 3)).otherwise(F.round(eps, 6)).alias("eps"),
    )


@query(
    "fn_logtarget",
    """SELECT event_id AS row_id, round(ln(1 + value - (SELECT min(value) FROM events) + 1), 8) AS logged, round(value, 6) AS back FROM events""",
)
def fn_logtarget(spark, sf):
    e = table(spark, sf, "events")
    lo = e.agg(F.min("value")).scalar()
    logged = scalar.log_target("value", lo)
    return e.select(
        F.col("event_id").alias("row_id"), F.round(logged, 8).alias("logged"), F.round(scalar.unlog_target(logged, lo), 6).alias("back")
    )


@query("fn_neglogp", with_sql(SCORED_SQL, "SELECT row_id, round(-log10(score + 1e-300), 8) AS neg_log FROM scored"))
def fn_neglogp(spark, sf):
    return scored(spark, sf).select("row_id", F.round(scalar.neg_log10_p("score"), 8).alias("neg_log"))


@query("fn_sigmoid", with_sql(READINGS_SQL, "SELECT row_id, round(1 / (1 + exp(-(v - 50) / 10)), 8) AS p FROM readings"))
def fn_sigmoid(spark, sf):
    return readings(spark, sf).select("row_id", F.round(scalar.sigmoid((F.col("v") - 50) / 10), 8).alias("p"))


@query(
    "fn_minmaxmetric",
    with_sql(
        RUNS_SQL,
        """SELECT model, normalization, round((roc_auc - lo) / (hi - lo + 1e-8), 6) AS good, round(1 - (training_time_s - tlo) / (thi - tlo + 1e-8), 6) AS fast
        FROM runs, (SELECT min(roc_auc) AS lo, max(roc_auc) AS hi, min(training_time_s) AS tlo, max(training_time_s) AS thi FROM runs)""",
    ),
)
def fn_minmaxmetric(spark, sf):
    r = runs(spark, sf)
    e = r.agg(
        F.min("roc_auc").alias("lo"), F.max("roc_auc").alias("hi"), F.min("training_time_s").alias("tlo"), F.max("training_time_s").alias("thi")
    ).select(F.struct("*").alias("e")).scalar()
    return r.select(
        "model",
        "normalization",
        F.round(scalar.rescale("roc_auc", e["lo"], e["hi"]), 6).alias("good"),
        F.round(scalar.rescale("training_time_s", e["tlo"], e["thi"], reverse=True), 6).alias("fast"),
    )


@query(
    "fn_bands",
    with_sql(
        READINGS_SQL,
        """SELECT row_id, CASE WHEN k < 30 THEN 'Low' WHEN k < 70 THEN 'Moderate' ELSE 'High' END AS risk,
        CASE WHEN k / 2 - 10 < 0 THEN 'Freezing' WHEN k / 2 - 10 < 15 THEN 'Cold' WHEN k / 2 - 10 < 25 THEN 'Pleasant' ELSE 'Hot' END AS temperature,
        CASE WHEN v < 5 THEN 'EXCELLENT' WHEN v < 10 THEN 'GOOD' ELSE 'FAIR' END AS quality,
        CASE WHEN abs((v - k) / 50) < 0.5 THEN 'comparable' WHEN v > k THEN 'improved' ELSE 'degraded' END AS auc_change FROM readings""",
    ),
)
def fn_bands(spark, sf):
    return readings(spark, sf).select(
        "row_id",
        scalar.risk_band("k").alias("risk"),
        scalar.temperature_band(F.col("k") / 2 - 10).alias("temperature"),
        scalar.quality_grade("v").alias("quality"),
        scalar.auc_change_band((F.col("v") - F.col("k")) / 50).alias("auc_change"),
    )


@query(
    "fn_heuristic",
    with_sql(
        READINGS_SQL
        + """, base AS (SELECT row_id, k, CASE WHEN h / 3 > 6 THEN [0.05e0, 0.10e0, 0.25e0, 0.60e0] WHEN h / 3 > 4 THEN [0.10e0, 0.20e0, 0.60e0, 0.10e0]
        WHEN h / 3 > 2 THEN [0.20e0, 0.60e0, 0.15e0, 0.05e0] ELSE [0.70e0, 0.20e0, 0.08e0, 0.02e0] END AS p FROM readings),
        adj AS (SELECT row_id, CASE WHEN k > 80 THEN [p[1] * 0.7, p[2] * 0.7, p[3] * 0.7, p[4] * 1.3] WHEN k < 30 THEN [p[1] * 1.3, p[2] * 0.7, p[3] * 0.7, p[4] * 0.7] ELSE p END AS q FROM base)""",
        """SELECT row_id, round(q[1] / list_sum(q), 8) AS p_clear, round(list_max(q) / list_sum(q), 8) AS confidence,
        (['Clear', 'Mostly Cloudy', 'Overcast', 'Partly Cloudy'])[list_position(q, list_max(q))] AS sky FROM adj""",
    ),
)
def fn_heuristic(spark, sf):
    r = readings(spark, sf).select("row_id", scalar.sky_distribution(F.col("h") / 3, "k").alias("p"))
    return r.select(
        "row_id",
        F.round(F.get("p", F.lit(0)), 8).alias("p_clear"),
        F.round(F.array_max("p"), 8).alias("confidence"),
        scalar.arg_max_label(F.col("p"), scalar.SKY_CLASSES).alias("sky"),
    )


@query(
    "fn_text",
    """SELECT p_partkey, trim(split_part(p_name, ' ', 1)) AS first_word, substr(p_brand, 1, 5) AS prefix, CAST(p_type LIKE '%PROMO%' AS INTEGER) AS is_promo,
    lower(replace(p_type, 'E', 'e')) AS low FROM part""",
)
def fn_text(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey",
        F.trim(F.split("p_name", " ")[0]).alias("first_word"),
        F.substring("p_brand", 1, 5).alias("prefix"),
        F.col("p_type").contains("PROMO").cast("int").alias("is_promo"),
        F.lower(F.replace("p_type", F.lit("E"), F.lit("e"))).alias("low"),
    )


@query(
    "fn_codes",
    "SELECT o_orderkey, CAST(regexp_extract(o_orderpriority, '([0-9]+)', 1) AS INTEGER) AS code, TRY_CAST(nullif(regexp_extract(o_orderstatus, '([0-9]+)', 1), '') AS INTEGER) AS none FROM orders",
)
def fn_codes(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", scalar.choice_code("o_orderpriority").alias("code"), scalar.choice_code("o_orderstatus").alias("none")
    )


# ---- encoders and scalers --------------------------------------------------


@query(
    "enc_label",
    with_sql(
        READINGS_SQL,
        "SELECT row_id, CAST(rk AS INTEGER) AS cat FROM readings LEFT JOIN (SELECT cat, row_number() OVER (ORDER BY cat) - 1 AS rk FROM (SELECT DISTINCT cat FROM readings WHERE cat IS NOT NULL)) USING (cat)",
    ),
)
def enc_label(spark, sf):
    r = readings(spark, sf).select("row_id", "cat")
    return LabelCoder(inputCols=["cat"]).fit(r).transform(r)


@query(
    "enc_label_nan",
    with_sql(
        READINGS_SQL,
        "SELECT row_id, CAST(rk AS INTEGER) AS cat FROM (SELECT row_id, coalesce(cat, 'nan') AS v FROM readings) JOIN (SELECT v, row_number() OVER (ORDER BY v) - 1 AS rk FROM (SELECT DISTINCT coalesce(cat, 'nan') AS v FROM readings)) USING (v)",
    ),
)
def enc_label_nan(spark, sf):
    r = readings(spark, sf).select("row_id", "cat")
    return LabelCoder(inputCols=["cat"], missingAsLabel=True).fit(r).transform(r)


@query("enc_inverse", with_sql(READINGS_SQL, "SELECT row_id, cat FROM readings"))
def enc_inverse(spark, sf):
    r = readings(spark, sf).select("row_id", "cat")
    model = LabelCoder(inputCols=["cat"]).fit(r)
    return model.transform(r).select("row_id", model.label_of(F.col("cat"), "cat").alias("cat"))


_SCALE_COLS = ["a", "b", "h"]


def _scaled(spark, sf, kind, cols=_SCALE_COLS):
    r = readings(spark, sf).select("row_id", *_SCALE_COLS)
    return rounded(ColumnScaler(inputCols=list(cols), kind=kind).fit(r).transform(r), 6, *_SCALE_COLS)


def _scale_sql(center, spread, cols=_SCALE_COLS):
    exprs = ", ".join(
        f"round(({c} - {center.format(c=c)}) / {spread.format(c=c)}, 6) AS {c}" if c in cols else f"round({c}, 6) AS {c}" for c in _SCALE_COLS
    )
    stats = ", ".join(
        f"avg({c}) AS {c}_m, stddev_pop({c}) AS {c}_s, min({c}) AS {c}_lo, max({c}) AS {c}_hi, median({c}) AS {c}_q2, quantile_cont({c}, 0.25) AS {c}_q1, quantile_cont({c}, 0.75) AS {c}_q3"
        for c in _SCALE_COLS
    )
    return with_sql(READINGS_SQL, f"SELECT row_id, {exprs} FROM readings, (SELECT {stats} FROM readings)")


@query("sc_standard", _scale_sql("{c}_m", "{c}_s"))
def sc_standard(spark, sf):
    return _scaled(spark, sf, "standard")


@query("sc_minmax", _scale_sql("{c}_lo", "({c}_hi - {c}_lo)"))
def sc_minmax(spark, sf):
    return _scaled(spark, sf, "minmax")


@query("sc_robust", _scale_sql("{c}_q2", "({c}_q3 - {c}_q1)"))
def sc_robust(spark, sf):
    return _scaled(spark, sf, "robust")


@query("sc_none", with_sql(READINGS_SQL, "SELECT row_id, round(a, 6) AS a, round(b, 6) AS b, round(h, 6) AS h FROM readings"))
def sc_none(spark, sf):
    return _scaled(spark, sf, "none")


@query("sc_subset", _scale_sql("{c}_m", "{c}_s", ["a"]))
def sc_subset(spark, sf):
    return _scaled(spark, sf, "standard", ["a"])


@query("sc_inverse", with_sql(READINGS_SQL, "SELECT row_id, round(a, 6) AS a, round(b, 6) AS b, round(h, 6) AS h FROM readings"))
def sc_inverse(spark, sf):
    r = readings(spark, sf).select("row_id", *_SCALE_COLS)
    model = ColumnScaler(inputCols=_SCALE_COLS, kind="standard").fit(r)
    return rounded(model.inverse(model.transform(r)), 6, *_SCALE_COLS)


@query("enc_assemble", with_sql(READINGS_SQL, "SELECT row_id, [v, k, h] AS features FROM readings"))
def enc_assemble(spark, sf):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array

    out = VectorAssembler(inputCols=["v", "k", "h"], outputCol="vec", handleInvalid="error").transform(readings(spark, sf))
    return out.select("row_id", vector_to_array("vec").alias("features"))


# ---- sampling and splitting ------------------------------------------------

_U = uniform_sql("event_id", 42)


def _events(spark, sf):
    return table(spark, sf, "events").select(F.col("event_id").alias("row_id"), F.col("event_type").alias("label"))


@query("sp_random", f"SELECT event_id AS row_id, CAST({_U} < 0.8e0 AS INTEGER) AS is_train FROM events")
def sp_random(spark, sf):
    return split.random_split(_events(spark, sf), "row_id").select("row_id", F.col("is_train").cast("int").alias("is_train"))


_RANKED = f"(SELECT event_id AS row_id, event_type AS label, row_number() OVER (PARTITION BY event_type ORDER BY {_U}, event_id) AS rn, count(*) OVER (PARTITION BY event_type) AS n FROM events)"


@query("sp_strat", f"SELECT row_id, label, CAST(rn <= round(n * 0.8e0) AS INTEGER) AS is_train FROM {_RANKED}")
def sp_strat(spark, sf):
    out = split.stratified_split(_events(spark, sf), "row_id", "label")
    return out.select("row_id", "label", F.col("is_train").cast("int").alias("is_train"))


@query("sp_frac", f"SELECT event_id AS row_id, event_type AS label FROM events WHERE {_U} < 0.3e0")
def sp_frac(spark, sf):
    return split.sample_fraction(_events(spark, sf), "row_id", 0.3)


@query(
    "sp_seeds",
    " UNION ALL ".join(
        f"SELECT {s} AS seed, event_id AS row_id, CAST({uniform_sql('event_id', s)} < 0.8e0 AS INTEGER) AS is_train FROM events"
        for s in (42, 123, 456, 789, 1024)
    ),
)
def sp_seeds(spark, sf):
    out = split.seeded_splits(_events(spark, sf), "row_id", [42, 123, 456, 789, 1024])
    return out.select("seed", "row_id", F.col("is_train").cast("int").alias("is_train"))


@query("sp_kfold", f"SELECT event_id AS row_id, CAST(floor({_U} * 5) AS INTEGER) AS fold FROM events")
def sp_kfold(spark, sf):
    return split.kfold(_events(spark, sf), "row_id").select("row_id", "fold")


@query("sp_stratkfold", f"SELECT row_id, label, CAST((rn - 1) % 5 AS INTEGER) AS fold FROM {_RANKED}")
def sp_stratkfold(spark, sf):
    return split.stratified_kfold(_events(spark, sf), "row_id", "label")


# ---- functions passed to rows ----------------------------------------------


@query("udf_map", with_sql(READINGS_SQL, "SELECT row_id, upper(coalesce(cat, 'unknown')) AS label FROM readings"))
def udf_map(spark, sf):
    return readings(spark, sf).select("row_id", F.upper(F.coalesce("cat", F.lit("unknown"))).alias("label"))


@query(
    "udf_row",
    with_sql(RUNS_SQL, "SELECT CASE WHEN normalization = 'None' THEN model ELSE model || ' (' || substr(normalization, 1, 3) || ')' END AS label, accuracy FROM runs"),
)
def udf_row(spark, sf):
    tagged = F.concat("model", F.lit(" ("), F.substring("normalization", 1, 3), F.lit(")"))
    return runs(spark, sf).select(F.when(F.col("normalization") == "None", F.col("model")).otherwise(tagged).alias("label"), "accuracy")


@query(
    "udf_key",
    with_sql(
        _TWO_RUNS_SQL,
        "SELECT model, round(b.best - a.best, 6) AS delta FROM run_a a JOIN run_b b USING (model) ORDER BY abs(delta) DESC, model LIMIT 3",
    ),
)
def udf_key(spark, sf):
    from tabforge.operators.leaderboard import compare_runs

    a, b = _two_runs(spark, sf)
    out = compare_runs(a, b, "accuracy").select("model", F.round("delta", 6).alias("delta"))
    return out.orderBy(F.abs("delta").desc(), "model").limit(3)
