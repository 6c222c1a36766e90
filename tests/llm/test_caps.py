"""Spherical-cap filters against all pairs."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabforge.llm import caps, queries
from tests.llm.plain import Classes

SCHEMA = "vec_id long, embedding array<float>, label int"


def sound(v):
    return v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(x != 0 for x in v)


def plain(rows, similarity=0.98):
    """[(vec_id, n_links, component_id, kept)] by comparing all pairs."""
    classes, links = Classes(range(len(rows))), [0] * len(rows)
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0))
    classes.up = {i: i for i in order}
    place = {i: p for p, i in enumerate(order)}
    classes = Classes(range(len(rows)))  # over places, so that the least place has the least id
    units = [np.array(v, dtype=float) / np.linalg.norm(np.array(v, dtype=float)) if lab is not None and sound(v) else None for _, v, lab in rows]
    for i in range(len(rows)):
        for j in range(i):
            if units[i] is None or units[j] is None or rows[i][2] != rows[j][2] or len(units[i]) != len(units[j]):
                continue
            if units[i] @ units[j] >= similarity:
                links[i] += 1
                links[j] += 1
                classes.join(place[i], place[j])
    out = []
    for i, (vec_id, _, _) in enumerate(rows):
        least = rows[order[classes.find(place[i])]][0]
        out.append((vec_id, links[i], least, vec_id == least))
    return out


def key(row):
    return tuple((x is None, x or 0) for x in row)


def got(df, **kw):
    return sorted(((r.vec_id, r.near.n_links, r.near.component_id, r.near.kept) for r in caps.near_vectors(df, **kw).collect()), key=key)


def near(rng, v, cosine):
    u = rng.standard_normal(len(v))
    u -= (u @ v) * v / (v @ v)
    u /= np.linalg.norm(u)
    return cosine * v / np.linalg.norm(v) + math.sqrt(1 - cosine**2) * u


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(3)
    out, n = [], 0
    vectors = [rng.standard_normal(64) for _ in range(250)]
    family = rng.standard_normal(64)
    vectors += [near(rng, family, 0.991) for _ in range(120)]  # pairs about 0.982: many but not all linked
    chain = rng.standard_normal(64)
    for _ in range(20):
        chain = near(rng, chain, 0.985)
        vectors.append(chain)
    vectors += [vectors[0] * 3.0] * 40 + [-vectors[1], np.zeros(64)]
    for v in list(vectors[:60]):
        vectors.append(near(rng, v, rng.uniform(0.95, 0.999)) * rng.uniform(0.01, 100))
    for v in vectors:
        n += 1
        out.append((1000 - n * 7 % 997, v.astype(np.float32).tolist(), int(n % 3 == 0) if n < 260 else 0))
    big = np.abs(rng.standard_normal(64)) * 1e38
    out += [(2000, big.astype(np.float32).tolist(), 0), (2001, (big * 0.5).astype(np.float32).tolist(), 0)]
    bad = [1.0] * 64
    out += [(3000, None, 0), (3001, [], 0), (3002, [None] + bad[1:], 0), (3003, [float("nan")] + bad[1:], 0), (3004, [float("inf")] + bad[1:], 0)]
    out += [(3005, bad, None), (3006, bad, None), (3007, bad, 1), (3008, bad, 0), (3009, [2.0] * 8, 0), (3010, [2.0] * 8, 0), (3011, [-1.0], 0), (3012, [-2.0], 0), (3013, [2.0], 0)]
    out += [(None, bad, 0), (None, [0.0, -1.0, 0.5], 2), (None, [0.0, -1.0, 0.5], 2), (None, None, None), (3014, [0.3, 0.1, 7.0], 2), (3014, [0.3, 0.1, 7.0], 2), (3015, [0.3, 0.1, 7.0], 2)]
    return out


def test_links_components_and_other_columns(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(c) for c in ("node", "filter", "n", "low", "part", "vector", "near")})
    assert got(df.repartition(5)) == sorted(plain(rows), key=key)
    out = caps.near_vectors(df)
    assert out.columns == df.columns and out.where("node = 'node' and filter = 'filter' and vector = 'vector'").count() == len(rows)


def test_parts_and_few_filters_give_the_same(spark, rows, monkeypatch):
    df = spark.createDataFrame(rows, SCHEMA)
    want = sorted(plain(rows), key=key)
    for part, each in ((7, 8), (1024, 2000), (50, 0)):
        monkeypatch.setattr(caps, "PART", part)
        monkeypatch.setattr(caps, "FILTERS_PER_CLASS", each)
        assert got(df) == want


def test_doubles_other_similarity_and_empty_table(spark, rows):
    df = spark.createDataFrame(rows[:200], SCHEMA).withColumn("embedding", F.col("embedding").cast("array<double>"))
    assert got(df, similarity=0.9) == sorted(plain(rows[:200], 0.9), key=key)
    assert got(df.limit(0)) == []


def test_list_decode_finds_all_filters_above_the_threshold():
    rng = np.random.default_rng(4)
    vectors = rng.standard_normal((50, 16))
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    turned = caps.rotated(vectors)
    assert np.allclose(turned @ turned.T, vectors @ vectors.T)
    words = caps.code_words(16, 3, 9)
    full = np.array([np.concatenate([words[0][:, i], words[1][:, j], words[2][:, k]]) for i in range(9) for j in range(9) for k in range(9)])
    assert np.allclose(np.linalg.norm(full, axis=1), 1)
    floor = caps.threshold(16, 20 / 729)
    lists = caps.list_decode(turned, words, floor, 12)
    for v, found in zip(turned, lists):
        products = full @ v
        assert len(found) >= 12 and set(np.flatnonzero(products >= floor)) <= set(found.tolist())
        assert products[found].min() >= np.sort(np.delete(products, found))[-1] - 1e-12
    assert 10 < np.mean([(full @ v >= floor).sum() for v in turned]) < 30


def test_recall_against_all_pairs():
    """Share of pairs of cosine 0.98 that meet in a filter, for a large table's number of filters."""
    rng = np.random.default_rng(5)
    a = rng.standard_normal((3000, 64))
    b = np.array([near(rng, v, 0.98) for v in a])
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    blocks, words = caps.code_shape(64, 16 * 10**6)
    floor, missed = caps.threshold(64, caps.LISTED / words**blocks), np.ones(len(a), dtype=bool)
    for c in range(caps.CODES):
        code = caps.code_words(64, blocks, words, c)
        left, right = (caps.list_decode(caps.rotated(x, c), code, floor, caps.LEAST) for x in (a, b))
        shared = np.array([len(np.intersect1d(x, y)) for x, y in zip(left, right)])
        assert (shared == 0).mean() < 0.03 and shared.mean() > 8
        missed &= shared == 0
    assert not missed.any()


def test_query_against_all_pairs(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    out = [tuple(r) for r in queries.QUERIES["op13_embedding_near_dedup"](spark, sf_dir).select("vec_id", "n_links", "component_id", "kept").collect()]
    assert sorted(out, key=key) == sorted(plain(rows), key=key)
