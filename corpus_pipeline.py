"""Cleaning of a document table in stages, each one operator of ``tabforge.llm``.

Every stage but the last takes the columns of documents and returns them. Rows that share an id and
a text are one document, and one of them goes on from the near-duplicate stage; different texts that
share an id are documents of their own, in that stage and in decontamination.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tabforge.llm.decontaminate import decontaminate
from tabforge.llm.near_dedup import near_duplicates, with_text_hashes
from tabforge.llm.packing import pack
from tabforge.llm.secrets import find_secrets
from tabforge.llm.tables import keyed_rows, text_key, text_of
from tabforge.llm.toxicity import toxicity
from tabforge.session import scratch_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents not predicted to be toxic; the model learns from the labels of the table."""
    rated = toxicity(docs.select(*COLUMNS), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return rated.where("predicted = 0").select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the least id, of each class of near duplicates."""
    same = ["key", "t1", "t2"]
    kept = near_duplicates(docs).where("is_kept").select(*same)
    rows = with_text_hashes(keyed_rows(docs.select(*COLUMNS)), text_of("text")).join(kept, same, "left_semi")
    return rows.groupBy(*same).agg(F.min(F.struct(*COLUMNS)).alias("row")).select("row.*")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    hit = decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).where("contaminated").select("key").distinct()
    return docs.select(*COLUMNS, text_key().alias("key")).join(hit, "key", "left_anti").select(*COLUMNS)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each secret replaced by its kind; n_chars counts the new text."""
    out = find_secrets(docs.select(*COLUMNS), redact=True)
    out = out.withColumn("text", F.when(F.col("text").isNotNull(), F.col("secrets.redacted")))
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The bin of every piece of every document."""
    return pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secret_scans", redact_secrets),
    ("best_fit_packing", pack_sequences),
]

#: Learning, hashing and bin packing are no SQL; tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
