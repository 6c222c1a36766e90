"""Imputation, its quality reports and outlier detection (inventory 2.11-2.13)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabforge.functions.rng import uniform_sql
from tabforge.operators import drift, impute, mice, outliers, profile
from tabforge.operators.encode import ColumnScaler
from tabforge.operators.ensemble import fit_side_by_side
from tabforge.operators.impute import ColumnImputer, KnnImputer
from tabforge.operators.mice import ChainedLinearImputer
from tabforge.plans.aggregates import rounded
from tabforge.plans.catalog import query, table
from tabforge.plans.inputs import GAP_COLUMNS, PART_FEATURES, PARTS_SQL, READINGS_SQL, parts, readings, with_sql
from tabforge.session import cut_lineage, scratch_path

# ---- SQL of the neighbour fill ---------------------------------------------


def _power_sql(features, q="r", d="d"):
    total = " + ".join(f"coalesce(({q}.{c} - {d}.{c}) * ({q}.{c} - {d}.{c}), 0)" for c in features)
    shared = " + ".join(f"({q}.{c} IS NOT NULL AND {d}.{c} IS NOT NULL)::INT" for c in features)
    return f"({total}) * ({len(features)}.0e0 / ({shared}))"


def _fill_sql(src, features, gaps, k, weights="uniform"):
    """CTE ``filled``: src with every gap column filled by its k nearest donors."""
    mean = (
        "avg(x)"
        if weights == "uniform"
        else "coalesce(avg(x) FILTER (power = 0), sum(x / sqrt(power)) FILTER (power > 0) / sum(1 / sqrt(power)) FILTER (power > 0))"
    )
    ctes = [
        f"""fill_{c} AS (SELECT row_id, {mean} AS est FROM (
          SELECT r.row_id, d.{c} AS x, {_power_sql(features)} AS power, row_number() OVER (PARTITION BY r.row_id ORDER BY {_power_sql(features)}, d.row_id) AS place
          FROM {src} r JOIN {src} d ON r.{c} IS NULL AND d.{c} IS NOT NULL) WHERE place <= {k} GROUP BY row_id)"""
        for c in gaps
    ]
    cols = ", ".join(f"coalesce({src}.{c}, fill_{c}.est) AS {c}" for c in gaps)
    joins = " ".join(f"LEFT JOIN fill_{c} ON fill_{c}.row_id = {src}.row_id" for c in gaps)
    return ", " + ", ".join(ctes) + f", filled AS (SELECT {src}.row_id, {cols} FROM {src} {joins})"


_GAPPY = ["size", "price"]


def _knn_parts(spark, sf, k=5, weights="uniform"):
    p = parts(spark, sf).select("row_id", *PART_FEATURES)
    return p, KnnImputer(inputCols=PART_FEATURES, k=k, weights=weights).fit(p)


# ---- imputation ------------------------------------------------------------


@query(
    "im_median",
    with_sql(
        READINGS_SQL,
        "SELECT row_id, " + ", ".join(f"coalesce({c}, (SELECT median({c}) FROM readings)) AS {c}" for c in ("a", "b", "c")) + " FROM readings",
    ),
)
def im_median(spark, sf):
    r = readings(spark, sf).select("row_id", "a", "b", "c")
    return ColumnImputer(inputCols=["a", "b", "c"], strategy="median").fit(r).transform(r)


@query(
    "im_knn_uniform",
    with_sql(PARTS_SQL + _fill_sql("parts", PART_FEATURES, _GAPPY, 5), "SELECT row_id, round(size, 6) AS size, round(price, 6) AS price FROM filled"),
)
def im_knn_uniform(spark, sf):
    p, model = _knn_parts(spark, sf)
    return rounded(model.transform(p).select("row_id", *_GAPPY), 6, *_GAPPY)


@query(
    "im_knn_dist",
    with_sql(
        PARTS_SQL + _fill_sql("parts", PART_FEATURES, _GAPPY, 20, "distance"),
        "SELECT row_id, round(size, 6) AS size, round(price, 6) AS price FROM filled",
    ),
)
def im_knn_dist(spark, sf):
    p, model = _knn_parts(spark, sf, 20, "distance")
    return rounded(model.transform(p).select("row_id", *_GAPPY), 6, *_GAPPY)


@query("im_knn_events")
def im_knn_events(spark, sf):
    """Neighbour fill of the readings: four features, most rows with a gap."""
    r = readings(spark, sf).select("row_id", *GAP_COLUMNS)
    filled = KnnImputer(inputCols=GAP_COLUMNS, k=5).fit(r).transform(r)
    return filled.agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(F.col(c).isNull()).alias(f"{c}_left") for c in GAP_COLUMNS],
        *[F.round(F.avg(c), 4).alias(f"{c}_mean") for c in GAP_COLUMNS],
    )


@query("im_mice_bayes")
def im_mice_bayes(spark, sf):
    r = readings(spark, sf).select("row_id", *GAP_COLUMNS)
    return rounded(ChainedLinearImputer(inputCols=GAP_COLUMNS).fit(r).transform(r), 6, *GAP_COLUMNS)


@query("im_mice_bayes_onepass")
def im_mice_bayes_onepass(spark, sf):
    """All features updated from one scan per round, for tables where scans are dear."""
    r = readings(spark, sf).select("row_id", *GAP_COLUMNS)
    model = ChainedLinearImputer(inputCols=GAP_COLUMNS, order="simultaneous", start="median").fit(r)
    return rounded(model.transform(r), 6, *GAP_COLUMNS)


#: Sizes of the reference's chains.
FOREST_CHAIN = {"rounds": 10, "trees": 10, "depth": 15}
BOOSTED_CHAIN = {"rounds": 10, "trees": 50, "depth": 5, "step": 0.1}


@query("im_mice_rf")
def im_mice_rf(spark, sf):
    out = mice.chained_trees(readings(spark, sf), "row_id", GAP_COLUMNS, "rf", **FOREST_CHAIN)
    return rounded(out, 6, *GAP_COLUMNS)


@query("im_mice_gbt")
def im_mice_gbt(spark, sf):
    out = mice.chained_trees(readings(spark, sf), "row_id", GAP_COLUMNS, "gbt", **BOOSTED_CHAIN)
    return rounded(out, 6, *GAP_COLUMNS)


@query("im_mice_gbt_scaled")
def im_mice_gbt_scaled(spark, sf):
    out = mice.chained_trees(readings(spark, sf), "row_id", GAP_COLUMNS, "gbt", **BOOSTED_CHAIN, scaled=True)
    return rounded(out, 6, *GAP_COLUMNS)


_DRAW_SQL = with_sql(
    READINGS_SQL
    + f""", ladder AS (SELECT cat AS label, sum(count(*)) OVER (ORDER BY cat) AS upto, sum(count(*)) OVER () AS total FROM readings WHERE cat IS NOT NULL GROUP BY cat),
    holes AS (SELECT row_id, {uniform_sql('row_id', 42)} AS u FROM readings WHERE cat IS NULL),
    drawn AS (SELECT row_id, min(label) AS label FROM holes JOIN ladder ON upto > u * total GROUP BY row_id)""",
    "SELECT row_id, coalesce(r.cat, d.label) AS cat FROM readings r LEFT JOIN drawn d USING (row_id)",
)


@query("im_dist", _DRAW_SQL)
def im_dist(spark, sf):
    return impute.impute_by_distribution(readings(spark, sf).select("row_id", "cat"), "cat", "row_id")


@query("im_adaptive")
def im_adaptive(spark, sf):
    """Category and numbers both have gaps, so the chained branch runs."""
    r = readings(spark, sf).select("row_id", "cat", "a", "h")
    return mice.impute_adaptive(r, "cat", "row_id", ["a", "h"]).select("row_id", "cat")


@query("im_adaptive_draw", _DRAW_SQL)
def im_adaptive_draw(spark, sf):
    """Only the category has gaps, so the frequency draw runs."""
    r = readings(spark, sf).select("row_id", "cat", "v", "h")
    return mice.impute_adaptive(r, "cat", "row_id", ["v", "h"]).select("row_id", "cat")


@query(
    "im_round",
    with_sql(READINGS_SQL, "SELECT row_id, CAST(round_even(k / 2, 0) AS INTEGER) AS code FROM readings"),
)
def im_round(spark, sf):
    return impute.round_codes(readings(spark, sf).select("row_id", (F.col("k") / 2).alias("code")), ["code"])


@query(
    "im_hybrid_thresh",
    with_sql(
        PARTS_SQL + _fill_sql("parts", PART_FEATURES, _GAPPY, 5),
        "SELECT row_id, round(f.size, 6) AS size, coalesce(p.price, (SELECT median(price) FROM parts)) AS price FROM filled f JOIN parts p USING (row_id)",
    ),
)
def im_hybrid_thresh(spark, sf):
    """Median above 25 % missing, neighbours below."""
    p, knn_model = _knn_parts(spark, sf)
    strategy = impute.threshold_strategy(p, _GAPPY, 0.25)
    median = ColumnImputer(inputCols=_GAPPY, strategy="median").fit(p)
    wide = median.add_filled(knn_model.add_filled(p, "knn"), "median")
    return rounded(impute.merge_methods(wide, strategy, ["row_id"]), 6, "size")


def _two_methods(spark, sf):
    r = readings(spark, sf).select("row_id", *GAP_COLUMNS, "label")
    knn_model = KnnImputer(inputCols=GAP_COLUMNS, k=5).fit(r)
    mice_model = ChainedLinearImputer(inputCols=GAP_COLUMNS).fit(r)
    return r, {"knn": knn_model, "mice": mice_model}


@query("im_hybrid_fixed")
def im_hybrid_fixed(spark, sf):
    r, models = _two_methods(spark, sf)
    strategy = impute.fixed_strategy(["a", "b", "c"], knn_features=("a",))
    return rounded(impute.HybridImputerModel(models, strategy).transform(r, ["a", "b", "c"]), 6, "a", "b", "c")


@query("im_hybrid_best2")
def im_hybrid_best2(spark, sf):
    r, models = _two_methods(spark, sf)
    wide = cut_lineage(models["mice"].add_filled(models["knn"].add_filled(r, "knn"), "mice"))
    best = impute.best_strategy(impute.best_method_table(wide, ["a", "b", "c"], ["knn", "mice"]))
    return rounded(impute.merge_methods(wide, best, ["row_id", "label"]), 6, "a", "b", "c")


def _four_methods(spark, sf):
    r, models = _two_methods(spark, sf)
    wide = models["mice"].add_filled(models["knn"].add_filled(r, "knn"), "mice")
    chains = {n: lambda s=s: mice.chained_trees(r, "row_id", GAP_COLUMNS, "gbt", **BOOSTED_CHAIN, scaled=s) for n, s in (("tree", False), ("tree_scaled", True))}
    for name, filled in fit_side_by_side(chains).items():
        wide = mice.attach_filled(wide, filled, "row_id", GAP_COLUMNS, name)
    return cut_lineage(wide)


@query("im_hybrid_best4")
def im_hybrid_best4(spark, sf):
    """Per-feature winner of four methods, with every method's drift."""
    wide = _four_methods(spark, sf)
    return impute.best_method_table(wide, ["a", "b", "c"], ["knn", "mice", "tree", "tree_scaled"])


_JOINT = ["size", "price", "brand"]


@query(
    "im_joint",
    with_sql(
        PARTS_SQL
        + """, joint AS (SELECT row_id, size, price, brand, CASE WHEN (row_id * 31) % 100 >= 10 THEN name_len END AS target FROM parts)"""
        + _fill_sql("joint", _JOINT + ["target"], ["size", "price", "target"], 3),
        "SELECT row_id, round(size, 6) AS size, round(price, 6) AS price, round(target, 6) AS target FROM filled",
    ),
)
def im_joint(spark, sf):
    """Features and target filled together, as one set of columns."""
    p = parts(spark, sf).select(
        "row_id", *_JOINT, F.when((F.col("row_id") * 31) % 100 >= 10, F.col("name_len")).alias("target")
    )
    cols = _JOINT + ["target"]
    out = KnnImputer(inputCols=cols, k=3).fit(p).transform(p)
    return rounded(out.select("row_id", "size", "price", "target"), 6, "size", "price", "target")


@query("im_apply")
def im_apply(spark, sf):
    """Imputers fitted on one half, saved, loaded and applied to the other half."""
    r = readings(spark, sf).select("row_id", *GAP_COLUMNS)
    old, new = r.where(F.col("row_id") % 2 == 0), r.where(F.col("row_id") % 2 == 1)
    path = scratch_path(spark, "imputer")
    models = {
        "knn": KnnImputer(inputCols=GAP_COLUMNS, k=5, donorsPath=f"{path}-donors").fit(old),
        "mice": ChainedLinearImputer(inputCols=GAP_COLUMNS).fit(old),
    }
    impute.HybridImputerModel(models, {"b": "mice", "c": "mice"}).save(spark, path)
    loaded = impute.HybridImputerModel.load(spark, path)
    return rounded(loaded.transform(new, GAP_COLUMNS), 6, *GAP_COLUMNS)


# ---- quality ---------------------------------------------------------------

_FILLED = PARTS_SQL + _fill_sql("parts", PART_FEATURES, _GAPPY, 5)
_BOTH = _FILLED + ", both_ AS (SELECT p.row_id, p.label, p.size, p.price, f.size AS size_n, f.price AS price_n FROM parts p JOIN filled f USING (row_id))"


def _wide_parts(spark, sf):
    """Original and filled columns side by side, kept because a report scans them several times."""
    p = parts(spark, sf).select("row_id", "label", *PART_FEATURES)
    return cut_lineage(KnnImputer(inputCols=PART_FEATURES, k=5).fit(p).add_filled(p, "knn"))


def _drift_sql(c):
    return f"""SELECT '{c}' AS feature, count(*) FILTER ({c} IS NULL) AS gaps, abs((avg({c}_n) - avg({c})) / avg({c})) * 100 AS mean_change_pct,
    abs((stddev_samp({c}_n) - stddev_samp({c})) / stddev_samp({c})) * 100 AS std_change_pct FROM both_"""


_DRIFT = _BOTH + ", dr AS (" + " UNION ALL ".join(_drift_sql(c) for c in _GAPPY) + ")"


@query(
    "q_drift",
    with_sql(_DRIFT, "SELECT feature, gaps, round(mean_change_pct, 6) AS mean_change_pct, round(std_change_pct, 6) AS std_change_pct FROM dr"),
)
def q_drift(spark, sf):
    return rounded(drift.drift(_wide_parts(spark, sf), PART_FEATURES, "knn"), 6, "mean_change_pct", "std_change_pct")


def _profile_sql(c):
    i = f"{c}_n) FILTER ({c} IS NULL"
    return f"""SELECT '{c}' AS feature, count(*) FILTER ({c} IS NULL) AS missing_count, round(100.0e0 * count(*) FILTER ({c} IS NULL) / count(*), 6) AS missing_pct,
    round(avg({c}), 6) AS original_mean, round(median({c}), 6) AS original_median, round(stddev_samp({c}), 6) AS original_std, min({c}) AS original_min, max({c}) AS original_max,
    round(avg({c}_n), 6) AS imputed_mean, round(median({c}_n), 6) AS imputed_median, round(stddev_samp({c}_n), 6) AS imputed_std, min({c}_n) AS imputed_min, max({c}_n) AS imputed_max,
    round(avg({i}), 6) AS imputedvals_mean, round(median({i}), 6) AS imputedvals_median, round(stddev_samp({i}), 6) AS imputedvals_std,
    round(avg({c}_n) - avg({c}), 6) AS mean_change, round((avg({c}_n) - avg({c})) / avg({c}) * 100, 6) AS mean_change_pct,
    round(stddev_samp({c}_n) - stddev_samp({c}), 6) AS std_change, round((stddev_samp({c}_n) - stddev_samp({c})) / stddev_samp({c}) * 100, 6) AS std_change_pct FROM both_"""


@query("q_profile", with_sql(_BOTH, " UNION ALL ".join(_profile_sql(c) for c in _GAPPY)))
def q_profile(spark, sf):
    out = drift.imputation_profile(_wide_parts(spark, sf), _GAPPY, "knn")
    return rounded(out, 6, *[c for c in out.columns if c not in ("feature", "missing_count") and not c.endswith(("_min", "_max"))])


def _ks_sql(c):
    return f"""SELECT '{c}' AS feature, max(abs(fa - fb)) AS ks FROM (
      SELECT sum(a) OVER (ORDER BY x) / (SELECT count({c}) FROM both_) AS fa, sum(b) OVER (ORDER BY x) / (SELECT CAST(count(*) AS DOUBLE) FROM both_ WHERE {c} IS NULL) AS fb
      FROM (SELECT {c}_n AS x, CAST(count({c}) AS DOUBLE) AS a, CAST(count(*) - count({c}) AS DOUBLE) AS b FROM both_ GROUP BY 1))"""


@query(
    "q_ks",
    with_sql(
        _BOTH,
        "SELECT feature, round(ks, 8) AS ks_statistic, n1, n2 FROM ("
        + " UNION ALL ".join(
            f"SELECT *, (SELECT count({c}) FROM both_) AS n1, (SELECT count(*) - count({c}) FROM both_) AS n2 FROM ({_ks_sql(c)})" for c in _GAPPY
        )
        + ")",
    ),
)
def q_ks(spark, sf):
    out = drift.imputation_ks(_wide_parts(spark, sf), _GAPPY, "knn")
    return rounded(out.select("feature", "ks_statistic", "n1", "n2"), 8, "ks_statistic")


@query("q_ks_verdict")
def q_ks_verdict(spark, sf):
    """The same test with its p-value and Yes/No verdict."""
    return drift.imputation_ks(_wide_parts(spark, sf), _GAPPY, "knn")


@query(
    "q_grade",
    with_sql(
        _DRIFT,
        """SELECT round(avg(mean_change_pct), 6) AS avg_mean_change_pct, CASE WHEN avg(mean_change_pct) < 5 THEN 'EXCELLENT' WHEN avg(mean_change_pct) < 10 THEN 'GOOD' ELSE 'FAIR' END AS grade FROM dr""",
    ),
)
def q_grade(spark, sf):
    wide = _wide_parts(spark, sf)
    out = drift.grade(drift.imputation_profile(wide, _GAPPY, "knn"), drift.imputation_ks(wide, _GAPPY, "knn"))
    return rounded(out.select("avg_mean_change_pct", "grade"), 6, "avg_mean_change_pct")


@query("q_strategies")
def q_strategies(spark, sf):
    """All strategies fitted and ranked by the mean drift."""
    r = readings(spark, sf).select("row_id", *GAP_COLUMNS)
    imputers = _strategies()
    return rounded(drift.rank_strategies(r, imputers, GAP_COLUMNS), 6, "avg_mean_change_pct", "avg_std_change_pct", "max_mean_change_pct")


def _strategies():
    search = impute.SharedSearch(20)
    imputers = {f"knn_{k}": KnnImputer(inputCols=GAP_COLUMNS, k=k).sharing(search) for k in (3, 5, 7, 10, 15, 20)}
    imputers.update({f"mice_{n}": ChainedLinearImputer(inputCols=GAP_COLUMNS, maxRounds=n) for n in (5, 10, 20, 50)})
    imputers["mice_rf"] = mice.ChainedTreeImputer("row_id", GAP_COLUMNS, "rf", **FOREST_CHAIN)
    imputers["median"] = ColumnImputer(inputCols=GAP_COLUMNS, strategy="median")
    imputers["median_knn"] = impute.ThresholdImputer(GAP_COLUMNS, 0.30, 5)
    return imputers


@query(
    "udaf_eval",
    with_sql(
        READINGS_SQL
        + ", m AS (SELECT median(a) AS ma, median(b) AS mb, median(c) AS mc FROM readings), f AS (SELECT a, b, c, coalesce(a, ma) AS a_n, coalesce(b, mb) AS b_n, coalesce(c, mc) AS c_n FROM readings, m)"
        + ", dr AS ("
        + " UNION ALL ".join(_drift_sql(c).replace("both_", "f") for c in ("a", "b", "c"))
        + ")",
        "SELECT 'median' AS strategy, round(avg(mean_change_pct), 6) AS avg_mean_change_pct, round(avg(std_change_pct), 6) AS avg_std_change_pct, round(max(mean_change_pct), 6) AS max_mean_change_pct FROM dr",
    ),
)
def udaf_eval(spark, sf):
    r = readings(spark, sf).select("row_id", "a", "b", "c")
    out = drift.evaluate_imputation(r, ColumnImputer(inputCols=["a", "b", "c"], strategy="median"), ["a", "b", "c"], "median")
    return rounded(out, 6, *out.columns[1:])


def _two_copies(spark, sf):
    wide = _wide_parts(spark, sf)
    return ColumnImputer(inputCols=_GAPPY, strategy="median").fit(wide).add_filled(wide, "median")


_TWO = _BOTH + ", two AS (SELECT *, coalesce(size, (SELECT median(size) FROM parts)) AS size_m, coalesce(price, (SELECT median(price) FROM parts)) AS price_m FROM both_)"


@query(
    "q_methoddiff",
    with_sql(
        _TWO,
        " UNION ALL ".join(
            f"""SELECT '{c}' AS feature, count(*) FILTER ({c} IS NULL) AS cells, round(avg(abs({c}_n - {c}_m)) FILTER ({c} IS NULL), 6) AS mean_abs_diff,
            round(max(abs({c}_n - {c}_m)) FILTER ({c} IS NULL), 6) AS max_abs_diff, round(avg(abs({c}_n - {c}_m)) FILTER ({c} IS NULL) / abs(avg({c})) * 100, 6) AS relative_pct FROM two"""
            for c in _GAPPY
        ),
    ),
)
def q_methoddiff(spark, sf):
    out = drift.method_difference(_two_copies(spark, sf), _GAPPY, "knn", "median")
    return rounded(out, 6, "mean_abs_diff", "max_abs_diff", "relative_pct")


@query(
    "q_corrshift",
    with_sql(
        _TWO,
        " UNION ALL ".join(
            f"SELECT '{c}' AS feature, round(corr({c}_n, label), 6) AS corr_first, round(corr({c}_m, label), 6) AS corr_second, round(corr({c}_m, label) - corr({c}_n, label), 6) AS shift FROM two"
            for c in _GAPPY
        ),
    ),
)
def q_corrshift(spark, sf):
    out = drift.correlation_shift(_two_copies(spark, sf), _GAPPY, "label", "knn", "median")
    return rounded(out, 6, "corr_first", "corr_second", "shift")


@query(
    "q_catdist",
    with_sql(
        READINGS_SQL + ", f AS (SELECT cat, coalesce(cat, CASE WHEN row_id % 3 = 0 THEN 'view' ELSE 'click' END) AS filled FROM readings)",
        """SELECT filled AS category, round(count(cat) * 100.0e0 / (SELECT count(cat) FROM f), 6) AS before_pct, round(count(*) * 100.0e0 / (SELECT count(*) FROM f), 6) AS after_pct,
        round((count(*) - count(cat)) * 100.0e0 / (SELECT count(*) - count(cat) FROM f), 6) AS imputed_pct FROM f GROUP BY filled""",
    ),
)
def q_catdist(spark, sf):
    r = readings(spark, sf)
    fill = F.when(F.col("row_id") % 3 == 0, "view").otherwise("click")
    out = drift.category_shift(r.select("cat", F.coalesce("cat", fill).alias("filled")), "cat", "filled")
    return rounded(out, 6, "before_pct", "after_pct", "imputed_pct")


# ---- neighbours and outliers -----------------------------------------------


def _embedding_vector():
    return F.col("embedding").cast("array<double>")


@query(
    "jn_knn",
    """SELECT q.vec_id AS row_id, nbr_id, place, round(dist, 6) AS dist FROM embeddings q, LATERAL (
      SELECT d.vec_id AS nbr_id, list_distance(q.embedding::DOUBLE[], d.embedding::DOUBLE[]) AS dist,
        CAST(row_number() OVER (ORDER BY list_distance(q.embedding::DOUBLE[], d.embedding::DOUBLE[]), d.vec_id) AS INTEGER) AS place
      FROM embeddings d WHERE d.vec_id <> q.vec_id) WHERE place <= 5""",
)
def jn_knn(spark, sf):
    from tabforge.operators.knn import knn_edges

    e = table(spark, sf, "embeddings").select("vec_id", "embedding")
    edges = knn_edges(
        e, e, query_id="vec_id", donor_id="vec_id", query_vector=_embedding_vector(), donor_vector=_embedding_vector(),
        width=64, k=5, skip_self=True,
    )
    return edges.select(
        F.col("query_id").alias("row_id"), F.col("donor_id").alias("nbr_id"), "place", F.round(F.sqrt("power"), 6).alias("dist")
    )


@query(
    "out_z",
    """WITH s AS (SELECT avg(value) AS m, stddev_pop(value) AS d FROM events), t AS (SELECT unnest([2.5e0, 3.0e0, 3.5e0]) AS level)
    SELECT level, count(*) FILTER (abs(value - m) / d < level) AS kept, count(*) AS total FROM events, s, t GROUP BY level""",
)
def out_z(spark, sf):
    e = table(spark, sf, "events").select("event_id", "value")
    out = None
    for level in (2.5, 3.0, 3.5):
        part = outliers.zscore_flags(e, ["value"], level).agg(
            F.lit(level).alias("level"), F.count_if("is_inlier").alias("kept"), F.count(F.lit(1)).alias("total")
        )
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "out_iqr",
    """WITH q AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events)
    SELECT 'value' AS feature, round(any_value(q1 - 1.5 * (q3 - q1)), 6) AS low_fence, round(any_value(q3 + 1.5 * (q3 - q1)), 6) AS high_fence,
    count(*) FILTER (value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)) AS outliers,
    round(100.0e0 * count(*) FILTER (value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)) / count(*), 6) AS outlier_pct FROM events, q""",
)
def out_iqr(spark, sf):
    return rounded(outliers.iqr_report(table(spark, sf, "events"), ["value"]), 6, "low_fence", "high_fence", "outlier_pct")


_LOF_K = 20


@query(
    "out_lof",
    f"""WITH c AS (SELECT c_custkey AS id, c_acctbal AS x, CAST(c_nationkey AS DOUBLE) AS y FROM customer),
    e AS (SELECT q, d, dist FROM (SELECT a.id AS q, b.id AS d, sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) AS dist,
      row_number() OVER (PARTITION BY a.id ORDER BY (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y), b.id) AS place FROM c a JOIN c b ON a.id <> b.id) WHERE place <= {_LOF_K}),
    kd AS (SELECT q AS d, max(dist) AS k_dist FROM e GROUP BY q),
    l AS (SELECT q, 1 / (avg(greatest(dist, k_dist)) + 1e-10) AS lrd FROM e JOIN kd USING (d) GROUP BY q)
    SELECT e.q AS c_custkey, round(avg(n.lrd) / any_value(m.lrd), 6) AS lof FROM e JOIN l n ON n.q = e.d JOIN l m ON m.q = e.q GROUP BY e.q""",
)
def out_lof(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_acctbal", F.col("c_nationkey").cast("double").alias("nation"))
    return rounded(outliers.local_outlier_factor(c, "c_custkey", ["c_acctbal", "nation"], _LOF_K), 6, "lof")


def _outlier_input(spark, sf):
    o = table(spark, sf, "events").select(
        F.col("event_id").alias("row_id"), "value", F.get_json_object("props", "$.k").cast("double").alias("k")
    )
    return ColumnScaler(inputCols=["value", "k"], kind="standard").fit(o).transform(o)


@query("out_iforest")
def out_iforest(spark, sf):
    return outliers.isolation_flags(_outlier_input(spark, sf), "row_id", ["value", "k"], 0.10, trees=100).select("row_id", "is_inlier")


@query("out_ellip")
def out_ellip(spark, sf):
    return outliers.envelope_flags(_outlier_input(spark, sf), "row_id", ["value", "k"], 0.10).select("row_id", "is_inlier")


# ---- flagship --------------------------------------------------------------


@query(
    "flagship",
    """WITH cleaned AS (SELECT l_quantity, l_extendedprice, CASE WHEN l_discount <> 0 THEN l_discount END AS l_discount, CASE WHEN l_tax <> 0 THEN l_tax END AS l_tax FROM lineitem),
    m AS (SELECT median(l_discount) AS md, median(l_tax) AS mt FROM cleaned), f AS (SELECT *, coalesce(l_discount, md) AS d_n, coalesce(l_tax, mt) AS t_n FROM cleaned, m)
    SELECT 'l_discount' AS feature, count(*) FILTER (l_discount IS NULL) AS missing, round(100.0e0 * count(*) FILTER (l_discount IS NULL) / count(*), 6) AS missing_pct,
      round(avg(l_discount), 6) AS mean, round(abs((avg(d_n) - avg(l_discount)) / avg(l_discount)) * 100, 4) AS mean_change_pct FROM f
    UNION ALL SELECT 'l_tax', count(*) FILTER (l_tax IS NULL), round(100.0e0 * count(*) FILTER (l_tax IS NULL) / count(*), 6), round(avg(l_tax), 6), round(abs((avg(t_n) - avg(l_tax)) / avg(l_tax)) * 100, 4) FROM f""",
)
def flagship(spark, sf):
    """Zero as missing, gap report, profile, median fill and its drift, on lineitem."""
    from tabforge.operators.clean import clean_sentinels

    cols = ["l_discount", "l_tax"]
    cleaned = clean_sentinels(table(spark, sf, "lineitem").select(*cols), {c: 0.0 for c in cols})
    gaps = profile.missing_report(cleaned, cols).select("feature", "missing", F.round("missing_pct", 6).alias("missing_pct"))
    stats = profile.describe(cleaned, cols).select("feature", F.round("mean", 6).alias("mean"))
    filled = ColumnImputer(inputCols=cols, strategy="median").fit(cleaned).add_filled(cleaned, "median")
    moved = drift.drift(filled, cols, "median").select("feature", F.round("mean_change_pct", 4).alias("mean_change_pct"))
    return gaps.join(stats, "feature").join(moved, "feature")
