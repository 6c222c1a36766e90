"""Ranked search against scores of all documents."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tabforge.llm import queries, search as s
from tabforge.llm.words import blocks
from tests.llm.plain import LOWER


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def plain(rows, items, top=10):
    """{(item_id, text): [(rank, doc_id, score)]}."""
    bags = [(i, Counter(terms(t)), len(terms(t))) for i, t in rows]
    bags = [b for b in bags if b[2]]
    n_docs, n_words = len(bags), sum(b[2] for b in bags)
    holders = Counter(t for _, own, _ in bags for t in own)
    out = {}
    for item, text in set(items):
        scores = []
        for doc_id, own, n in bags:
            m = 100 - 75 + (75 * n * n_docs) // n_words
            score = 0
            for t in terms(text):
                if t in own:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * holders[t] + 1)))
                    score += w * ((1000000000 * own[t]) // (1000 * own[t] + 8 * m))
            if score > 0:
                scores.append((-score, doc_id is None, doc_id or 0, doc_id))
        out[item, text] = [(k + 1, x[3], -x[0]) for k, x in enumerate(sorted(scores, key=lambda x: x[:3])[:top])]
    return out


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(6)
    words = [f"w{int(300 * rng.random() ** 2)}" for _ in range(2000)] + ["Straße", "DÍA", "naïve", "42", "x"]

    def prose(n):
        return " ".join(rng.choice(words) + rng.choice(["", ",", "."]) for _ in range(n))

    rows = [(1, None), (2, ""), (3, "!! ??"), (4, "x"), (5, "the rare rare RARE word"), (None, "rare without id"), (None, prose(20)), (6, "all " * 5000), (7, prose(8000))]
    shared = prose(60)
    rows += [(100 + k, prose(rng.randint(1, 200))) for k in range(150)]
    rows += [(1000 - k, "copy of one text " + shared) for k in range(60)]
    rows += [(2000 + k, shared + " " + prose(k)) for k in range(30)]
    rows += [(8, "twice the same row"), (8, "twice the same row"), (8, "same id another text")]
    items = [(k, prose(rng.randint(1, 60))) for k in range(25)] + [(30, shared), (31, "rare RARE"), (32, None), (33, "nowhere"), (34, "same row twice"), (34, "w1"), (34, "w1"), (None, "x 42")]
    rng.shuffle(rows)
    return rows, items


def got(docs, items, **kw):
    out = {}
    for r in s.search(docs, items, **kw).collect():
        out.setdefault(r.item_id, []).append((r["rank"], r.doc_id, r.score))
    return {k: sorted(v) for k, v in out.items()}


def want(rows, items, **kw):
    out = {}
    for (item, _), found in plain(rows, items, **kw).items():
        if found:
            out.setdefault(item, []).extend(found)
    return {k: sorted(v) for k, v in out.items()}


def as_items(spark, items):
    return spark.createDataFrame(items, "item_id long, text string").withColumns({c: F.lit(c) for c in ("block", "place", "term", "n")})


def test_ranks_and_scores(spark, documents, corpus):
    rows, items = corpus
    assert got(documents(rows).repartition(3), as_items(spark, items)) == want(rows, items)


def test_small_shards_blocks_of_items_and_shuffled_candidates(spark, documents, corpus, monkeypatch):
    rows, items = corpus
    for name, value in (("SHARD_DOCUMENTS", 7), ("ITEMS", 10), ("CARRIED", 0), ("BITS_PER_ENTRY", 2), ("COUNTED", 50)):
        monkeypatch.setattr(s, name, value)
    assert got(documents(rows), as_items(spark, items), top=3) == want(rows, items, top=3)


def test_text_ids_and_empty_tables(spark, documents):
    docs = spark.createDataFrame([("b", "one two"), ("a", "two one"), (None, "one"), ("c", "three"), ("d", "four"), ("e", "five")], "doc_id string, text string")
    items = spark.createDataFrame([("i", "one")], "item_id string, text string")
    assert [r[1] for r in got(docs, items)["i"]] == [None, "a", "b"]
    assert got(docs.limit(0), items) == {} and got(docs, items.limit(0)) == {} and got(docs.where("doc_id = 'z'"), items.limit(0)) == {}


def test_bounds_are_never_below_scores(corpus):
    rows, items = corpus
    texts = [t for _, t in rows if terms(t)]
    (block,) = blocks(pa.array(texts), "alnum", True)
    text, term, n = s.bag(block)
    high = s.level(n) + 1
    entry = np.repeat(np.arange(len(n)), high)
    j = np.arange(len(entry)) - np.repeat(np.cumsum(high) - high, high)
    own = np.unique(term)
    weights = np.arange(len(own)) % 50 + 1
    asked = s.Items(own, weights, [np.arange(k, len(own), 7) for k in range(7)], [np.ones(len(range(k, len(own), 7)), dtype=np.int64) for k in range(7)], len(texts), block.n_words)
    length = np.diff(block.word_bounds)
    for bits in (64, 4096):
        bounds = s.upper_bounds(asked, s.signature_matrix(text[entry], term[entry], j, len(texts), bits), length)
        for t in range(len(texts)):
            occurs = np.zeros(len(own), dtype=np.int64)
            occurs[np.searchsorted(own, term[text == t])] = n[text == t]
            exact = [int((weights * s.gain(occurs, asked.spread(length)[t]))[p].sum()) for p in asked.places]
            assert (bounds[:, t] >= exact).all()


def test_query_against_all_scores(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows, items = ([tuple(r) for r in spark.read.parquet(f"{sf_dir}/{t}.parquet").select(k, "text").collect()] for t, k in (("documents", "doc_id"), ("benchmark", "item_id")))
    out = {}
    for r in queries.QUERIES["op11_lexical_search"](spark, sf_dir).collect():
        out.setdefault(r.item_id, []).append((r["rank"], r.doc_id, r.score))
    assert {k: sorted(v) for k, v in out.items()} == want(rows, items)
