"""Fill-in-the-middle against a plain version over code points."""

import hashlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tabforge.llm import infill, queries

ROWS = [
    (1, "plain ascii text of some words"),
    (2, "Straße, naïve día — 東京タワー 🤦🏼‍♂️ end"),
    (3, ""),
    (4, None),
    (5, "holds <P> itself"),
    (6, "holds <M> itself"),
    (7, "x"),
    (8, "🙂"),
    (9, "<<S<<P<M< near marks <S"),
    (None, "without an id"),
    (None, "without an id, another"),
    (10, "same id"),
    (10, "same id, other text"),
    (11, "repeated"),
    (11, "repeated"),
    (12, "ab é" * 30_000),
] + [(100 + i, "añ東🙂"[: i % 5] * (i % 37) + "z" * (i % 11)) for i in range(400)]


def plain(doc_id, text):
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (len(text) + 1), h[1] % (len(text) + 1)))
    if not text or any(mark in text for mark in infill.SENTINELS) or h[2] % 100 >= 90:
        return len(text), "plain", None, None, text
    p, m, s = text[:a], text[a:b], text[b:]
    if h[3] % 100 < 20:
        return len(text), "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return len(text), "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


def test_outputs_and_restored_texts(documents):
    out = infill.fill_in_middle(documents(ROWS)).withColumn("back", infill.restored(F.col("fim.output"), F.col("fim.form"))).collect()
    assert len(out) == len(ROWS) and {r.fim.form for r in out} == {"plain", "psm", "spm"}
    for r in out:
        assert tuple(r.fim) == plain(r.doc_id, r.text) and r.back == (r.text or "")
        assert r.key == "key" and r.words == "words"


def test_text_ids_and_a_clashing_column(spark):
    df = spark.createDataFrame([("a", "some text"), (None, None)], "doc_id string, text string").withColumn("fim", F.lit(1))
    got = {r.doc_id: tuple(r.fim) for r in infill.fill_in_middle(df).collect()}
    assert got == {"a": plain("a", "some text"), None: plain(None, None)}


def test_empty_table(documents):
    assert infill.fill_in_middle(documents([])).count() == 0


def test_other_parameters(documents):
    marks = ("<PRE>", "<SUF>", "<MID>")
    docs = documents([(i, f"text {i} <P>") for i in range(60)])
    out = infill.fill_in_middle(docs, epoch=2, rate=100, suffix_first=100, sentinels=marks)
    rows = out.withColumn("back", infill.restored(F.col("fim.output"), F.col("fim.form"), marks)).collect()
    assert all(r.fim.form == "spm" and r.fim.output.startswith("<SUF>") and r.back == r.text for r in rows)
    other = {r.doc_id: r.fim.output for r in infill.fill_in_middle(docs, epoch=3, rate=100, suffix_first=100, sentinels=marks).collect()}
    assert any(other[r.doc_id] != r.fim.output for r in rows)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.characters(codec="utf-8"), max_size=40), min_size=1, max_size=12))
def test_rank_and_select(texts):
    raw = "".join(texts)
    data = np.frombuffer(raw.encode(), dtype=np.uint8)
    units = infill.Units(data)
    ends = [len(raw[:k].encode()) for k in range(len(raw) + 1)]
    assert units.select(np.arange(len(raw) + 1)).tolist() == ends
    at = np.arange(len(data) + 1)
    assert units.rank(at).tolist() == [sum(1 for e in ends[1:] if e <= p) for p in at]
    cuts = np.arange(len(texts)) * 7919
    for text, (n, lo, mid, *parts) in zip(texts, infill.cut_texts(pa.array(texts), cuts, cuts[::-1])):
        assert n == len(text) and b"".join(parts).decode() == text
        assert len(parts[0].decode()) == lo and len(parts[1].decode()) == mid


def test_blocks_do_not_change_results(monkeypatch):
    texts = [t for _, t in ROWS if t]
    cuts = np.arange(len(texts)) * 1_000_003
    whole = list(infill.cut_texts(pa.array(texts), cuts, cuts * 3))
    monkeypatch.setattr(infill, "BLOCK_BYTES", 10)
    assert list(infill.cut_texts(pa.array(texts).slice(0), cuts, cuts * 3)) == whole


@pytest.mark.parametrize("name", ["op12_fill_in_middle"])
def test_query(spark, name):
    sf_dir = "/root/testdata/sf0.001"
    got = {r.doc_id: r for r in queries.QUERIES[name](spark, sf_dir).collect()}
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(rows)
    for doc_id, text in rows:
        n, form, prefix, middle, output = plain(doc_id, text)
        r = got[doc_id]
        assert (r.n, r.form, r.prefix_chars, r.middle_chars) == (n, form, prefix, middle)
        assert r.output_sha256 == hashlib.sha256(output.encode()).hexdigest()
        assert r.restored_sha256 == hashlib.sha256((text or "").encode()).hexdigest()
