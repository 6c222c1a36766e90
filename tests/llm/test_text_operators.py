"""Substring dedup, near dedup, decontamination and fingerprints against plain versions."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tabforge.llm import decontaminate as d, near_dedup as n, spotsigs, substrings
from tabforge.llm.graph import components
from tabforge.llm.words import blocks
from tests.llm import plain

WORDS = [f"w{i}" for i in range(400)] + ["Straße", "naïve", "día", "the", "of", "Ärger"]


def prose(rng, size):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", ",", "."]) for _ in range(size))


@pytest.fixture(scope="module")
def corpus():
    """Texts with copies, near copies, shared passages and awkward rows; a third from one family."""
    rng = random.Random(5)
    passage, line = prose(rng, 60), prose(rng, 23)
    rows = [(0, None), (1, ""), (2, "   \n\t "), (3, "!!! ???"), (4, "one two"), (5, "one  two"), (6, "one two"), (7, "the the the the the the the")]
    base = prose(rng, 200)
    for k in range(40):  # a family of near copies
        own = base.split(" ")
        for _ in range(rng.randint(0, 9)):
            own[rng.randrange(len(own))] = rng.choice(WORDS)
        rows.append((100 + k, " ".join(own)))
    rows += [(200 + k, base) for k in range(20)]
    for k in range(40):
        body = prose(rng, rng.randint(1, 300)).split(" ")
        at = rng.randrange(len(body))
        middle = [passage] if k % 2 else [line, prose(rng, 3), line]
        rows.append((300 + k, " ".join(body[:at] + middle + body[at:])))
    rows.append((400, " ".join(["again"] * 3000)))
    rows.append((401, prose(rng, 20000)))
    rng.shuffle(rows)
    return rows


def test_words_match_a_regular_expression(corpus):
    for kind, fold, pattern in (("space", False, None), ("alnum", True, "words")):
        for block in blocks(pa.array([t for _, t in corpus]), kind, fold):
            for t in range(block.n_texts):
                text = corpus[block.first + t][1]
                want = plain.words(text) if pattern else (text or "").split()
                lo, hi = block.word_bounds[t : t + 2]
                got = [bytes(block.data[a:z]).decode() for a, z in zip(block.starts[lo:hi], block.ends[lo:hi])]
                assert [g.translate(plain.LOWER) for g in got] == want if pattern else got == want


def test_equal_words_have_equal_hashes():
    (block,) = blocks(pa.array(["ab ba AB ab", "ab"]), "alnum", True)
    assert len({block.hashes[i] for i in (0, 2, 3, 4)}) == 1 and block.hashes[0] != block.hashes[1]
    assert block.ranges(np.array([0, 3]), np.array([1, 4])).tolist() == [block.ranges(np.array([4]), np.array([5]))[0]] * 2


def test_substrings(documents, corpus):
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in substrings.remove_repeats(documents(corpus)).collect()}
    assert got == plain.without_repeats(corpus)


def test_substrings_without_ids_and_repeated_rows(documents):
    text = " ".join(f"x{i}" for i in range(30))
    out = substrings.remove_repeats(documents([(None, text), (None, "other"), (5, text), (5, text), (6, "a " + text)])).collect()
    got = sorted((r.doc_id or -1, r.n_words, r.n_removed, [tuple(s) for s in r.spans]) for r in out)
    assert got == [(-1, 1, 0, []), (-1, 30, 0, []), (5, 30, 30, [(0, 30)]), (5, 30, 30, [(0, 30)]), (6, 31, 30, [(1, 31)])]


def test_first_of_equal_rows_stays(documents):
    text = " ".join(f"x{i}" for i in range(30))
    assert [r.n_removed for r in substrings.remove_repeats(documents([(5, text), (5, text)])).collect()] == [0, 0]


def test_empty_tables(documents):
    empty = documents([])
    assert substrings.remove_repeats(empty).collect() == []
    assert n.near_duplicates(empty).collect() == []
    assert spotsigs.edit_likeness(empty).collect() == []
    items = empty.select(F.col("doc_id").alias("item_id"), "text")
    assert d.decontaminate(empty, items).collect() == []
    one = d.decontaminate(documents([(1, "a b c")]), items).collect()[0]
    assert (one.n_words, one.n_hit, one["items"], one.contaminated) == (3, 0, [], False)


def test_near_duplicates(documents, corpus):
    rows = n.near_duplicates(documents(corpus)).collect()
    assert {r.doc_id: r.class_id for r in rows} == plain.near_classes(corpus)
    assert all(r.is_kept == (r.doc_id == r.class_id) for r in rows) and len(rows) == len(corpus)


def test_near_duplicates_that_no_pivot_joins(spark, documents, monkeypatch):
    monkeypatch.setitem(n.near_links.__globals__, "MATRIX_COLUMNS", 7)
    monkeypatch.setattr(n.near_links, "__defaults__", (4,))
    rng = random.Random(2)
    rows, own = [], [f"v{i}" for i in range(120)]
    for k in range(30):  # a chain: neighbours are alike, ends are not
        rows.append((k, " ".join(own)))
        own = own[2:] + [f"u{k}", f"t{k}"]
    rows += [(100 + k, t + " same words again and same words again and same words again") for k, t in rows[::3]]  # repeated shingles
    rng.shuffle(rows)
    got = {r.doc_id: r.class_id for r in n.near_duplicates(documents(rows)).collect()}
    assert got == plain.near_classes(rows) and len({got[k] for k in range(30)}) == 1


def test_texts_reach_workers_in_batches_of_bounded_bytes(spark, monkeypatch):
    whole, most = n.blocks, 6 * 1024 * 1024

    def bounded(column, *args, **named):
        assert column.nbytes < most, f"{column.nbytes} bytes in a batch"
        for block in whole(column, *args, **named):
            assert len(block.data) < 300_000 or block.n_texts == 1
            yield block

    monkeypatch.setattr(n, "blocks", bounded)
    text = F.repeat(F.concat(F.lit("w"), F.col("id"), F.lit(" ")), 5000)
    docs = spark.range(0, 500, 1, 1).select(F.col("id").alias("doc_id"), text.alias("text"))  # 14 MB in one partition
    assert {r.doc_id: r.class_size for r in n.near_duplicates(docs).collect()} == {k: 1 for k in range(500)}


def test_registers_estimate_probability_jaccard():
    rng = np.random.default_rng(3)
    ids = rng.integers(1, 2**63, 300).astype(np.uint64)
    x, y = rng.integers(1, 4, 300), rng.integers(1, 4, 300)
    x[250:], y[:40] = 0, 0
    at = [np.flatnonzero(w) for w in (x, y)]
    text = np.repeat([0, 1], [len(a) for a in at])
    regs = n.prob_minhash(text, np.concatenate([ids[a] for a in at]), np.concatenate([x[at[0]], y[at[1]]]).astype(float), 2, registers=4096)
    order = [np.argsort(ids[a]) for a in at]
    exact = n.probability_jaccard(ids[at[0]][order[0]], x[at[0]][order[0]], ids[at[1]][order[1]], y[at[1]][order[1]])
    bags = [{int(i): int(w) for i, w in zip(ids, v) if w} for v in (x, y)]
    from collections import Counter

    assert exact == pytest.approx(plain.probability_jaccard(*map(Counter, bags)))
    assert (regs[0] == regs[1]).mean() == pytest.approx(exact, abs=0.035)


def test_components_of_a_long_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5000, 4000), (4000, 4500), (7, 7)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert {got[i] for i in range(201)} == {0} and {got[i] for i in range(1000, 1300)} == {1000} and {got[i] for i in (4000, 4500, 5000)} == {4000}


@pytest.mark.parametrize("broadcast_rows", [d.BROADCAST_ROWS, 0])
def test_decontamination(spark, documents, corpus, broadcast_rows):
    long = next(t for i, t in corpus if i == 401).split()
    items = [(1, " ".join(long[40:75]).upper()), (10, " ".join(long[70:82])), (2, "one two"), (3, "W7"), (4, None), (5, ""), (6, " ".join(["again"] * 12)), (6, "one two"), (None, "the THE the")]
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("words", F.lit(1))
    rows = d.decontaminate(documents(corpus), bench, broadcast_rows=broadcast_rows).collect()
    assert {r.doc_id: (r.n_words, r.n_hit, r["items"]) for r in rows} == plain.contamination(corpus, items)
    assert len(rows) == len(corpus) and all(r.contaminated == (r.n_hit > 0) for r in rows)


def test_edit_likeness(documents, corpus):
    rows = {r.doc_id: r for r in spotsigs.edit_likeness(documents(corpus)).collect()}
    order = sorted(corpus, key=lambda r: -r[0])
    prints = {}
    for k, (doc_id, text) in enumerate(order):
        text, after = text or "", order[(k + 1) % len(order)]
        half = len(text) // 2
        got, following = rows[doc_id], rows[after[0]]
        assert got.n_chars == len(text) and got.edited == text[: len(text) - half] + (after[1] or "")[:half]
        assert prints.setdefault(text, got.signature) == got.signature
        for other, near in ((got.edited_signature, got.near_edited), (following.signature, got.near_next)):
            a, b = set(got.signature), set(other)
            assert near == pytest.approx(len(a & b) / len(a | b) if a | b else 1.0)
    assert len(rows) == len(corpus)


def test_signatures_follow_anchors(spark):
    df = spark.createDataFrame([("Alpha beta the gamma of delta epsilon",), ("the of",), ("",)], "t string")
    got = [r.s for r in spotsigs.with_signatures(df, "t", "s").collect()]
    chains = ["alpha beta gamma", "gamma delta epsilon", "delta epsilon"]
    want = spark.createDataFrame([(c,) for c in chains], "c string").select(F.hash("c")).collect()
    assert got[0] == sorted(w[0] for w in want) and got[1:] == [[], []]


def test_similar_fingerprints(documents, corpus):
    prints = spotsigs.fingerprints(documents(corpus)).select("key", "signature")
    sets = {}
    for r in sorted(prints.collect(), key=lambda r: r.key):
        sets.setdefault(tuple(r.signature), r.key)
    sets = {k: set(s) for s, k in sets.items() if s}
    want = {}
    for a in sets:
        for b in sets:
            near = len(sets[a] & sets[b]) / len(sets[a] | sets[b])
            if a < b and near >= 0.6:
                want[a, b] = near
    got = {tuple(sorted((r.a, r.b))): r.likeness for r in spotsigs.similar_pairs(prints, 0.6).collect()}
    assert got == pytest.approx(want) and len(want) > 5


def test_next_document_of_one(documents):
    (row,) = spotsigs.edit_likeness(documents([(3, "abcdef")])).collect()
    assert row.edited == "abcabc"
    assert hashlib.sha256(row.edited.encode()).hexdigest()


def test_texts_of_one_id_are_contaminated_each(spark, documents):
    item = " ".join(f"q{i}" for i in range(12))
    rows = [(5, "clean text of five"), (5, "x " + item), (6, "clean"), (None, item), (None, "clean too"), (7, item), (7, item)]
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    out = d.decontaminate(documents(rows), items).collect()
    got = sorted(((r.doc_id or 0, r.n_words, r.n_hit, r.contaminated) for r in out))
    assert got == [(0, 2, 0, False), (0, 12, 12, True), (5, 4, 0, False), (5, 13, 12, True), (6, 1, 0, False), (7, 12, 12, True), (7, 12, 12, True)]


def test_text_ids_are_contaminated_too(spark):
    item = " ".join(f"q{i}" for i in range(12))
    docs = spark.createDataFrame([("a", item), ("b", "clean"), (None, item)], "doc_id string, text string")
    out = d.decontaminate(docs, spark.createDataFrame([("i", item)], "item_id string, text string")).collect()
    assert {(r.doc_id, r.n_hit, tuple(r["items"])) for r in out} == {("a", 12, ("i",)), ("b", 0, ()), (None, 12, ("i",))}
