"""The paths meant for large tables, forced on small ones and compared with brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabforge.operators import impute, knn, mice, outliers, prefix, quantiles, split, timeseries
from tabforge.operators.impute import KnnImputer
from tabforge.operators.mice import ChainedLinearImputer


def _frame(spark, x, parts=5):
    rows = [(i, *[None if np.isnan(v) else float(v) for v in r]) for i, r in enumerate(x)]
    schema = "row_id long, " + ", ".join(f"f{j} double" for j in range(x.shape[1]))
    return spark.createDataFrame(rows, schema).repartition(parts)


def _brute(x, k, p=2.0, skip_self=True):
    n, d = x.shape
    out = {}
    for i in range(n):
        power = []
        for j in range(n):
            if skip_self and i == j:
                continue
            both = ~np.isnan(x[i]) & ~np.isnan(x[j])
            if both.any():
                power.append((np.sum(np.abs(x[i, both] - x[j, both]) ** p) * (d / both.sum()), j))
        out[i] = [j for _, j in sorted(power)[:k]]
    return out


@pytest.mark.parametrize("skip_self", [False, True])
def test_copies_of_a_donor_are_few_and_lose_no_neighbour(spark, monkeypatch, skip_self):
    rng = np.random.default_rng(8)
    x = np.repeat(rng.integers(0, 6, (12, 2)).astype(float), 50, axis=0)[rng.permutation(600)]
    donors = []
    build = knn._build_cells
    monkeypatch.setattr(knn, "_build_cells", lambda d, *rest: donors.append(d.count()) or build(d, *rest))
    monkeypatch.setattr(knn, "BROADCAST_BYTES", 0)
    df = _frame(spark, x)
    edges = knn.knn_edges(
        df, df, query_id="row_id", donor_id="row_id", query_vector=knn.vector(["f0", "f1"]), donor_vector=knn.vector(["f0", "f1"]),
        width=2, k=3, skip_self=skip_self, rows_per_cell=8,
    )
    got = {}
    for r in edges.orderBy("query_id", "place").collect():
        got.setdefault(r["query_id"], []).append(r["donor_id"])
    assert got == _brute(x, 3, skip_self=skip_self)
    assert donors[0] <= 12 * (4 if skip_self else 3)


@pytest.mark.parametrize("p", [1.0, 2.0])
@pytest.mark.parametrize("shape", ["plain", "gaps", "hot"])
def test_cell_search_equals_brute_force(spark, shape, p):
    rng = np.random.default_rng(3)
    x = rng.integers(0, 60, (300, 4)).astype(float)
    if shape == "gaps":
        x[rng.random(x.shape) < 0.25] = np.nan
    if shape == "hot":
        x[:120] = x[0]  # a third of all rows are copies
    df = _frame(spark, x)
    cols = [f"f{j}" for j in range(4)]
    got = knn.neighbours(df, "row_id", cols, 5, p, broadcast_rows=0, rows_per_cell=8, block_rows=16)
    found = {}
    for r in got.orderBy("row_id", "place").collect():
        found.setdefault(r.row_id, []).append(r.nbr_id)
    want = _brute(x, 5, p)
    assert found == {i: v for i, v in want.items() if v}


def test_small_and_cell_search_fill_alike(spark):
    rng = np.random.default_rng(5)
    x = rng.integers(0, 50, (240, 5)).astype(float)
    x[rng.random(x.shape) < 0.2] = np.nan
    df = _frame(spark, x)
    cols = [f"f{j}" for j in range(5)]
    model = KnnImputer(inputCols=cols, k=4).fit(df)
    small = {r.row_id: tuple(r) for r in model.apply(df).collect()}
    cells = {r.row_id: tuple(r) for r in model.apply(df, broadcast_rows=0, rows_per_cell=6, block_rows=10).collect()}
    assert small.keys() == cells.keys()
    for i in small:
        assert small[i] == pytest.approx(cells[i])


def test_donors_alike_in_what_a_query_has_are_few(spark, monkeypatch):
    """Donors that share one equal feature only are all at distance 0; a search meets k of them, whatever their number."""
    rng = np.random.default_rng(9)
    x = np.column_stack([rng.integers(0, 500, 600), rng.integers(0, 500, 600), rng.integers(0, 3, 600)]).astype(float)
    x[rng.random(600) < 0.3, 0] = np.nan
    x[rng.random(600) < 0.6, 1] = np.nan
    met = []
    build = knn._build_cells
    monkeypatch.setattr(knn, "_build_cells", lambda d, *rest: met.append(d.count()) or build(d, *rest))
    df, cols, k = _frame(spark, x), ["f0", "f1", "f2"], 4
    edges = knn.knn_edges(
        df, df, query_id="row_id", donor_id="row_id", query_vector=knn.vector(cols), donor_vector=knn.vector(cols),
        width=3, k=k, targets=[0, 1, 2], broadcast_rows=0, rows_per_cell=8, block_rows=16,
    )
    got = {}
    for r in edges.orderBy("query_id", "target", "place").collect():
        assert r["value"] == x[r["donor_id"], r["target"]]
        got.setdefault((r["query_id"], r["target"]), []).append(r["donor_id"])
    want = {}
    for i, t in zip(*np.nonzero(np.isnan(x))):
        have = np.nonzero(~np.isnan(x[:, t]))[0]
        shared = ~np.isnan(x[i]) & ~np.isnan(x[have])
        power = np.where(shared, (x[have] - x[i]) ** 2, 0.0).sum(axis=1) * 3 / shared.sum(axis=1)
        want[i, t] = [int(j) for j in have[np.lexsort((have, power))][:k]]
    assert got == want
    both = int(np.isnan(x[:, :2]).all(axis=1).any())
    assert both and sorted(met)[:2] == [3 * k, 3 * k]  # rows that have the third feature only meet k donors for each of its values


def test_home_cells_of_a_block_are_those_of_each_query():
    rng = np.random.default_rng(10)
    low = rng.integers(0, 50, (900, 3)).astype(float)
    boxes = knn._Boxes(rng.integers(0, 9, (900, 3)), low, low + 3, np.ones((900, 3), dtype=bool), np.ones((900, 3), dtype=bool))
    q = rng.integers(0, 50, (40, 3)).astype(float)
    q[::3, 1] = np.nan
    for targets in ([knn.PLAIN], [1]):
        together = knn._home(boxes, boxes.grouped(), q, 5, 2.0, targets)
        alone = [knn._home(boxes, boxes.grouped(), q[i : i + 1], 5, 2.0, targets)[0] for i in range(len(q))]
        assert all(np.array_equal(a, b) for a, b in zip(together, alone, strict=True))
        for i, cells in enumerate(together):
            asks = targets == [knn.PLAIN] or np.isnan(q[i, 1])
            have = boxes.count.max(axis=1) if targets == [knn.PLAIN] else boxes.count[:, 1]
            assert have[cells].sum() >= 10 if asks else not len(cells)


def test_reached_cells_come_in_parts_of_bounded_size(monkeypatch):
    monkeypatch.setattr(knn, "_GROUPS_AT_ONCE", 4)
    boxes = knn._Boxes(np.ones((900, 64)), np.zeros((900, 64)), np.ones((900, 64)), np.ones((900, 64), dtype=bool), np.ones((900, 64), dtype=bool))
    parts = list(knn._reached_parts(boxes, boxes.grouped(), np.zeros((30, 64)), np.ones((30, 1)), 2.0, [knn.PLAIN]))
    assert max(len(rows) for rows, _ in parts) <= 4 * knn.CELLS_PER_GROUP
    assert {(r, c) for rows, cells in parts for r, c in zip(rows.tolist(), cells.tolist())} == {(r, c) for r in range(30) for c in range(900)}


@pytest.mark.parametrize("broadcast_rows", [0, knn.BROADCAST_ROWS])
def test_imputers_of_several_k_share_one_search(spark, monkeypatch, broadcast_rows):
    rng = np.random.default_rng(11)
    x = rng.integers(0, 30, (200, 3)).astype(float)
    x[rng.random(200) < 0.3, 0] = np.nan
    df, cols, search, calls = _frame(spark, x).cache(), ["f0", "f1", "f2"], impute.SharedSearch(6), []
    monkeypatch.setitem(knn.knn_edges.__kwdefaults__, "broadcast_rows", broadcast_rows)
    whole = knn.knn_edges
    monkeypatch.setattr(knn, "knn_edges", lambda *a, **o: calls.append(o["k"]) or whole(*a, **o))
    for k in (2, 4, 6):
        shared = {r.row_id: tuple(r) for r in KnnImputer(inputCols=cols, k=k).sharing(search).fit(df).add_filled(df, "n").collect()}
        assert calls == [6]
        own = {r.row_id: tuple(r) for r in KnnImputer(inputCols=cols, k=k).fit(df).add_filled(df, "n").collect()}
        assert calls.pop() == k and shared.keys() == own.keys()
        assert all(shared[i] == pytest.approx(own[i], nan_ok=True) for i in own)


def test_many_missing_patterns(spark):
    rng = np.random.default_rng(6)
    x = rng.integers(0, 40, (150, 4)).astype(float)
    x[rng.random(x.shape) < 0.4] = np.nan
    df = _frame(spark, x)
    cols = [f"f{j}" for j in range(4)]
    got = knn.neighbours(df, "row_id", cols, 3, broadcast_rows=0, rows_per_cell=8, block_rows=16)
    found = {}
    for r in got.orderBy("row_id", "place").collect():
        found.setdefault(r.row_id, []).append(r.nbr_id)
    assert found == {i: v for i, v in _brute(x, 3).items() if v}


SCALE_PATH = "im_knn_uniform im_knn_dist jn_knn im_joint md_knn out_lof im_hybrid_thresh".split()


@pytest.mark.parametrize("name", SCALE_PATH)
def test_neighbour_queries_match_sql_on_the_cell_path(spark, monkeypatch, name):
    import duckdb

    import __spark_entry__ as entry
    from tools.check import TABLES, compare

    monkeypatch.setitem(knn.knn_edges.__kwdefaults__, "broadcast_rows", 0)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '/root/testdata/sf0.001/{t}.parquet'")
    assert compare(entry.queries()[name](spark, "/root/testdata/sf0.001"), con, entry.oracle_sql()[name]) == ""


def test_donors_met_per_query_hardly_grow_with_the_donors(spark):
    """Exact radii, so what is counted is what the second pass measures."""
    met = {}
    for n in (2_000, 20_000):
        rng = np.random.default_rng(4)
        x = rng.normal(0, 1, (n, 3))
        x[rng.random(x.shape) < 0.15] = np.nan
        x[np.isnan(x).all(axis=1), 0] = 0.0
        rows = [(i, [None if np.isnan(v) else float(v) for v in r], None) for i, r in enumerate(x)]
        donors = spark.createDataFrame(rows, "id long, v array<double>, value double")
        _, boxes, cells = knn._build_cells(donors, 3, n, [1.0] * 3, knn.MAX_CELLS, 32)
        size = np.array([r.n for r in cells.orderBy("cell").collect()])
        queries = rng.normal(0, 1, (100, 3))
        power = np.sort(knn._power_distances(queries, x, 2.0), axis=1)[:, 4:5]
        _, reached = knn._reached(boxes, boxes.grouped(), queries, power, 2.0, [knn.PLAIN])
        met[n] = size[reached].sum() / len(queries)
        assert met[n] < 0.25 * n
    assert met[20_000] < 4 * met[2_000]


def test_quantile_narrowing_is_exact(spark):
    rng = np.random.default_rng(1)
    values = np.concatenate([rng.normal(0, 1, 6000), np.full(3000, 0.25), rng.exponential(5, 3000)])
    df = spark.createDataFrame([(float(v),) for v in values], "x double").repartition(6)
    probs = [0.0, 0.01, 0.25, 0.5, 0.61, 0.95, 1.0]
    got = quantiles.exact_quantiles(df, {"x": F.col("x")}, probs, distinct_limit=50)["x"]
    assert got == pytest.approx(list(np.quantile(values, probs)))


def test_quantile_between_two_huge_ties(spark):
    values = np.concatenate([np.zeros(50_000), np.linspace(0.1, 0.9, 8), np.ones(50_000)])
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    got = quantiles.exact_quantiles(df, {"x": F.col("x")}, [0.5, 0.49999], distinct_limit=2)["x"]
    assert got == pytest.approx(list(np.quantile(values, [0.5, 0.49999])))


def test_value_at_rank(spark):
    values = [5, 1, 1, 1, 9, 7]
    df = spark.createDataFrame([(v, float(v)) for v in values], "i long, x double")
    assert [quantiles.value_at_rank(df, F.col("x"), r) for r in range(6)] == sorted(values)
    assert [quantiles.value_at_rank(df, F.col("i"), r) for r in range(6)] == sorted(values)


@pytest.mark.parametrize("small_keys", [0, 50_000])
@pytest.mark.parametrize("descending", [False, True])
def test_running_totals(spark, monkeypatch, descending, small_keys):
    monkeypatch.setattr(prefix, "SMALL_KEYS", small_keys)
    rng = np.random.default_rng(2)
    keys = np.unique(rng.integers(0, 5000, 900))
    counts = {(g, int(k)): int(rng.integers(1, 9)) for g in ("a", "b", None) for k in keys}
    df = spark.createDataFrame([(g, k, n) for (g, k), n in counts.items()], "g string, key long, n long").repartition(7)
    out = prefix.running_totals(df, "key", ["n"], by=["g"], buckets=16, descending=descending)
    for g in ("a", "b", None):
        rows = sorted((r.key, r.n_to, r.n_before) for r in out.where(F.col("g").eqNullSafe(F.lit(g))).collect())
        assert len(rows) == len(keys)
        total = 0
        for key, upto, before in reversed(rows) if descending else rows:
            assert before == total
            total += counts[(g, key)]
            assert upto == total


def test_global_positions(spark):
    df = spark.range(997).select(F.format_string("%05d", (F.col("id") * 7) % 997).alias("s")).repartition(9)
    rows = prefix.global_positions(df, ["s"], "pos").collect()
    assert sorted((r.s, r.pos) for r in rows) == [(f"{i:05d}", i) for i in range(997)]


def test_hashed_rank_is_a_permutation_under_skew(spark):
    df = spark.range(3000).select(F.col("id"), F.when(F.col("id") % 3 == 0, "rare").otherwise("hot").alias("g"))
    for parts in (1, 7):
        out = split.hashed_rank(df.repartition(parts), "id", ["g"], buckets=32)
        for g, n in (("hot", 2000), ("rare", 1000)):
            assert sorted(r[0] for r in out.where(F.col("g") == g).select("_rank").collect()) == list(range(1, n + 1))


def test_stratified_split_is_exact(spark):
    df = spark.range(1000).select(F.col("id"), (F.col("id") % 10 == 0).cast("int").alias("y"))
    out = split.stratified_split(df, "id", "y").groupBy("y").agg(F.count_if("is_train").alias("t")).collect()
    assert {r.y: r.t for r in out} == {0: 720, 1: 80}


def test_rows_without_a_class_are_kept(spark):
    df = spark.range(100).select(F.col("id"), F.when(F.col("id") % 2 == 0, F.lit("a")).alias("g"))
    out = split.stratified_kfold(df, "id", "g", 5)
    assert out.count() == 100
    assert {(r.g, r.fold): r["count"] for r in out.groupBy("g", "fold").count().collect()} == {
        (g, f): 10 for g in ("a", None) for f in range(5)
    }


def test_lag_across_slots(spark):
    day = timeseries.DAY
    rows = [(1, 0, 1, 1.0), (1, day // 2, 2, 2.0), (1, 3 * day, 3, 3.0), (1, 3 * day + 5, 4, 4.0), (2, 10, 5, 9.0), (None, 0, 6, 7.0)]
    df = spark.createDataFrame(rows, "s long, t long, id long, v double")
    out = timeseries.lag_and_trailing_means(df, "s", F.col("t"), "id", "v", {"m": day // 4})
    got = {r.id: (r.lag1, r.m) for r in out.collect()}
    assert got == {1: (None, 1.0), 2: (1.0, 2.0), 3: (2.0, 3.0), 4: (3.0, 3.5), 5: (None, 9.0), 6: (None, 7.0)}


# ---- chained regressions ---------------------------------------------------


def _gappy(seed=0, n=400, d=4, share=0.2):
    rng = np.random.default_rng(seed)
    base = rng.normal(0, 1, (n, 2))
    x = base @ rng.normal(0, 1, (2, d)) + 5 + 0.05 * rng.normal(0, 1, (n, d))
    full = x.copy()
    x[rng.random(x.shape) < share] = np.nan
    return x, full


def _by_scanning(x, rounds):
    """Textbook round robin on the rows themselves."""
    gaps = np.isnan(x)
    mean = np.nanmean(x, axis=0)
    z = np.where(gaps, mean, x)
    order = [i for _, i in sorted((gaps[:, i].sum(), i) for i in range(x.shape[1])) if gaps[:, i].any()]
    for _ in range(rounds):
        for i in order:
            rows = ~gaps[:, i]
            m = np.column_stack([np.ones(rows.sum()), z[rows] - mean])
            coef, intercept = mice.bayesian_ridge(m.T @ m, i)
            others = [j for j in range(x.shape[1]) if j != i]
            z[gaps[:, i], i] = intercept + (z[np.ix_(gaps[:, i], others)] - mean[others]) @ coef + mean[i]
    return z


@pytest.mark.parametrize("jvm_width", [10, 1])
def test_chain_from_products_equals_chain_on_rows(spark, monkeypatch, jvm_width):
    monkeypatch.setattr(mice, "_JVM_WIDTH", jvm_width)
    x, full = _gappy()
    df = _frame(spark, x)
    cols = [f"f{j}" for j in range(x.shape[1])]
    model = ChainedLinearImputer(inputCols=cols, maxRounds=4, tol=0.0).fit(df)
    got = np.array([tuple(r)[1:] for r in model.transform(df).orderBy("row_id").collect()], dtype=float)
    assert got == pytest.approx(_by_scanning(x, 4), abs=1e-8)
    assert np.abs(got - full)[np.isnan(x)].mean() < np.abs(np.nanmean(x, axis=0) - full)[np.isnan(x)].mean()


@pytest.mark.parametrize("order", ["sequential", "simultaneous"])
def test_chain_by_scans_when_patterns_are_many(spark, monkeypatch, order):
    x, full = _gappy(1)
    df = _frame(spark, x)
    cols = [f"f{j}" for j in range(x.shape[1])]
    fitted = ChainedLinearImputer(inputCols=cols, maxRounds=3, tol=0.0, order=order).fit(df)
    monkeypatch.setattr(mice, "_JVM_WIDTH", 1)
    monkeypatch.setattr(mice, "MAX_PRODUCTS", 1)
    scanned = ChainedLinearImputer(inputCols=cols, maxRounds=3, tol=0.0, order=order).fit(df)
    a, b = (np.array([tuple(r)[1:] for r in m.transform(df).orderBy("row_id").collect()], dtype=float) for m in (fitted, scanned))
    assert a == pytest.approx(b, abs=1e-8)
    if order == "sequential":
        assert b == pytest.approx(_by_scanning(x, 3), abs=1e-8)


def test_chain_keeps_observed_cells_and_leaves_no_gap(spark):
    x, _ = _gappy(2)
    df = _frame(spark, x)
    cols = [f"f{j}" for j in range(x.shape[1])]
    out = ChainedLinearImputer(inputCols=cols).fit(df).transform(df).orderBy("row_id").collect()
    got = np.array([tuple(r)[1:] for r in out], dtype=float)
    assert not np.isnan(got).any()
    assert np.array_equal(got[~np.isnan(x)], x[~np.isnan(x)])


def test_chain_without_gaps_is_identity(spark):
    x = np.arange(20.0).reshape(10, 2)
    df = _frame(spark, x)
    model = ChainedLinearImputer(inputCols=["f0", "f1"]).fit(df)
    assert model.n_rounds() == 0
    assert sorted(tuple(r) for r in model.transform(df).collect()) == sorted(tuple(r) for r in df.collect())


# ---- outliers --------------------------------------------------------------


def test_lof_equals_brute_force(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(0, 1, (120, 2))
    x[0] = [9, 9]
    k = 10
    dist = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    np.fill_diagonal(dist, np.inf)
    nbr = np.argsort(dist, axis=1, kind="stable")[:, :k]
    kd = dist[np.arange(120), nbr[:, -1]]
    lrd = 1 / (np.maximum(kd[nbr], np.take_along_axis(dist, nbr, 1)).mean(1) + 1e-10)
    want = lrd[nbr].mean(1) / lrd
    df = _frame(spark, x)
    for options in ({}, {"broadcast_rows": 0, "rows_per_cell": 10, "block_rows": 16}):
        rows = outliers.local_outlier_factor(df, "row_id", ["f0", "f1"], k, **options).orderBy("row_id").collect()
        assert [r.lof for r in rows] == pytest.approx(list(want))


def test_flagged_share_is_exact_with_ties(spark):
    df = spark.range(100).select(F.col("id").alias("row_id"), F.when(F.col("id") < 60, 1.0).otherwise(0.0).alias("s"))
    out = outliers.flag_top_share(df, "s", "row_id", 0.25)
    assert sorted(r.row_id for r in out.where("NOT is_inlier").collect()) == list(range(25))


def test_rows_without_scores_or_labels_stay(spark):
    from tabforge.operators import profile

    rng = np.random.default_rng(9)
    x = rng.normal(0, 1, (200, 2))
    x[:5] = np.nan
    df = _frame(spark, x)
    for out in (
        outliers.lof_flags(df, "row_id", ["f0", "f1"], 0.1, 10),
        outliers.lof_flags(df, "row_id", ["f0", "f1"], 0.1, 10, broadcast_rows=0, rows_per_cell=16),
        outliers.envelope_flags(df, "row_id", ["f0", "f1"], 0.1),
        outliers.isolation_flags(df, "row_id", ["f0", "f1"], 0.1),
    ):
        rows = {r.row_id: r for r in out.collect()}
        assert len(rows) == 200 and all(r.is_inlier is not None for r in rows.values())
        assert sum(not r.is_inlier for r in rows.values()) in (20, round(0.1 * 195))
    labelled = df.withColumn("y", F.when(F.col("row_id") % 10 != 0, F.col("row_id") % 2))
    weighted = profile.with_class_weights(labelled, "y").collect()
    assert len(weighted) == 200 and sum(r.weight is None for r in weighted) == 20
    assert sum(r.weight for r in weighted if r.weight) == pytest.approx(180)


@pytest.mark.parametrize("method", ["forest", "envelope", "lof"])
def test_planted_outliers_are_found(spark, method):
    rng = np.random.default_rng(8)
    x = rng.normal(0, 1, (400, 3))
    x[:8] += 12.0 * rng.choice([-1, 1], (8, 3))
    df = _frame(spark, x)
    cols = ["f0", "f1", "f2"]
    if method == "forest":
        out = outliers.isolation_flags(df, "row_id", cols, 0.05, trees=50)
    elif method == "envelope":
        out = outliers.envelope_flags(df, "row_id", cols, 0.05)
    else:
        out = outliers.lof_flags(df, "row_id", cols, 0.05)
    flagged = {r.row_id for r in out.where("NOT is_inlier").collect()}
    assert len(flagged) == 20
    assert set(range(8)) <= flagged


def test_forest_does_not_depend_on_partitioning(spark):
    rng = np.random.default_rng(9)
    df = _frame(spark, rng.normal(0, 1, (300, 2)))
    scores = []
    for parts in (1, 6):
        rows = outliers.isolation_scores(df.repartition(parts), "row_id", ["f0", "f1"], trees=10).orderBy("row_id").collect()
        scores.append([r.anomaly for r in rows])
    assert scores[0] == pytest.approx(scores[1])
