"""Each stage of the pipeline on what its predecessor kept, against plain versions; the queries on small tables."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tabforge.llm.queries import QUERIES
from tests.llm import plain
from tests.llm.test_row_operators import plain_scan

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp(name) / "out")
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs)
    return [spark.read.parquet(f"{SF}/documents.parquet"), *out]


def rows(df):
    return {r.doc_id: tuple(r) for r in df.select(*corpus_pipeline.COLUMNS).collect()}


def test_stage_names_and_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dedup", "decontamination", "secret_scans", "best_fit_packing"]
    for df in stages[1:-1]:
        assert df.columns == stages[0].columns and dict(df.dtypes) == dict(stages[0].dtypes)


def test_toxic_documents_go(spark, stages):
    before, after = rows(stages[0]), rows(stages[1])
    toxic = {r.doc_id for r in QUERIES["op6_toxicity"](spark, SF).collect() if r.predicted}
    assert after == {k: v for k, v in before.items() if k not in toxic} and toxic


def test_one_document_of_each_class_stays(stages):
    before, after = rows(stages[1]), rows(stages[2])
    classes = plain.near_classes([(k, v[1]) for k, v in before.items()])
    assert after == {k: v for k, v in before.items() if classes[k] == k} and len(after) < len(before)


def test_contaminated_documents_go(spark, stages):
    before, after = rows(stages[2]), rows(stages[3])
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    hit = plain.contamination([(k, v[1]) for k, v in before.items()], items)
    assert after == {k: v for k, v in before.items() if not hit[k][1]} and len(after) < len(before)


def test_secrets_are_replaced(stages):
    before, after = rows(stages[3]), rows(stages[4])
    assert before.keys() == after.keys()
    for k, (_, text, lang, source, n) in after.items():
        assert not plain_scan(text) and n == len(text) and (lang, source) == before[k][2:4]
        if not plain_scan(before[k][1]):
            assert text == before[k][1]


def test_every_word_is_packed(stages):
    want = {k: len(re.findall(r"[^\x20\x09-\x0D]+", v[1])) for k, v in rows(stages[4]).items()}
    got = {r.doc_id: r.n for r in stages[5].groupBy("doc_id").agg(F.sum("length").alias("n")).collect()}
    assert got == want


def test_rows_without_ids_and_repeated_rows(spark):
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    texts = ["a b c d e f", "a b c d e f", None, "", "x y"]
    docs = spark.createDataFrame([(None, texts[0], "en", "s", 1), (4, texts[1], None, None, None), (None, None, "en", "s", 0), (5, "x y", "en", "s", 3), (5, "x y", "en", "s", 3)], schema)
    out = corpus_pipeline.drop_near_duplicates(spark, docs.withColumn("key", F.lit("k")), SF).collect()
    assert sorted((r.doc_id or -1, r.text or "") for r in out) == [(-1, ""), (-1, "a b c d e f"), (5, "x y")]
    secret = docs.limit(1).withColumn("text", F.lit("my password: hunter222 ok"))
    assert [(r.text, r.n_chars) for r in corpus_pipeline.redact_secrets(spark, secret, SF).collect()] == [("my [assign] ok", 14)]
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).collect() == []


def test_different_texts_of_one_id_all_stay(spark):
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    texts = [" ".join(f"{w}{k}" for k in range(40)) for w in "abcd"]
    rows = [(5, texts[0]), (5, texts[1]), (5, texts[1]), (6, texts[1]), (6, texts[2]), (7, texts[2] + " more"), (7, texts[3]), (8, texts[3]), (8, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], schema).repartition(4)
    out = corpus_pipeline.drop_near_duplicates(spark, docs, SF).collect()
    assert sorted((r.doc_id, r.text or "") for r in out) == [(5, texts[0]), (5, texts[1]), (6, texts[2]), (7, texts[3]), (8, "")]


def test_substring_query_matches_plain(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in QUERIES["op10_substring_dedup"](spark, SF).collect()}
    want = {k: (n, gone, hashlib.sha256(kept.encode()).hexdigest()) for k, (n, gone, kept) in plain.without_repeats(docs).items()}
    assert got == want


def test_near_dedup_query_matches_plain(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert {r.doc_id: r.class_id for r in QUERIES["op1_near_dedup"](spark, SF).collect()} == plain.near_classes(docs)


@pytest.mark.parametrize("name", ["op4_quality", "op5_html_main_text", "op7_best_fit_packing", "op8_secret_scan", "op9_spotsigs"])
def test_queries_return_every_row(spark, name):
    out = QUERIES[name](spark, SF)
    key = "page_id" if name == "op5_html_main_text" else "doc_id"
    table = "pages" if key == "page_id" else "documents"
    assert {r[0] for r in out.select(key).collect()} == {r[0] for r in spark.read.parquet(f"{SF}/{table}.parquet").select(key).collect()}


def test_contamination_takes_one_text_of_an_id_only(spark):
    item = spark.read.parquet(f"{SF}/benchmark.parquet").first()["text"]
    rows = [(5, "a clean text", "en", "web", 12), (5, "x " + item, "en", "web", len(item) + 2), (6, "clean", "en", "web", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted((r.doc_id, r.text) for r in corpus_pipeline.drop_contaminated(spark, docs, SF).collect()) == [(5, "a clean text"), (6, "clean")]
