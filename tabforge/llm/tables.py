"""Helpers that several operators share: row keys, hand-off tables, sized broadcasts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tabforge.session import cut_lineage

#: Bytes of an Arrow batch, about; one longer row is a batch of its own.
BATCH_BYTES = 4 * 1024 * 1024
_BATCH_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Keys below this stand for rows without an id.
NULL_KEYS = -(2**62)


def text_of(column: str) -> Column:
    """A text, null as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def keyed(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(key, text): an integer for each row, and its text.

    The key is the id. Rows without an id come before all others and are told apart by their
    texts. Rows that share an id are one document, so a repeated row changes nothing.
    """
    return df.select(_key(id_col, text_col).alias("key"), text_of(text_col).alias("text"))


def keyed_rows(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``df`` with the column key of ``keyed``."""
    return df.withColumn("key", _key(id_col, text_col))


def text_key(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """What tells documents apart: the id, of any type that has a string form, and two hashes of the text."""
    text = text_of(text_col)
    name = F.coalesce(F.concat(F.lit("="), F.col(id_col).cast("string")), F.lit(""))
    return F.struct(name.alias("id"), F.xxhash64(text).alias("t1"), F.xxhash64(F.length(text), F.hash(text)).alias("t2"))


def _key(id_col: str, text_col: str) -> Column:
    nameless = F.lit(-(2**63)) + F.xxhash64(text_of(text_col)).bitwiseAND(F.lit(2**62 - 1))
    return F.coalesce(F.col(id_col).cast("long"), nameless)


def id_of(key: str) -> Column:
    """The id behind a key of ``keyed``."""
    return F.when(F.col(key) >= NULL_KEYS, F.col(key))


def in_batches(df: DataFrame) -> DataFrame:
    """``df``, whose texts go to Python in batches of ``BATCH_BYTES``.

    Spark's own limit is a number of rows, however long their texts are: executors hold each batch
    outside the heap, and workers twice. The limit is the session's; one that is set already stays.
    """
    conf = df.sparkSession.conf
    if conf.get(_BATCH_LIMIT, None) is None:
        conf.set(_BATCH_LIMIT, str(BATCH_BYTES))
    return df


def settled(df: DataFrame) -> DataFrame:
    """A hand-off table in the shared checkpoint folder: read several times, computed once."""
    return cut_lineage(df)


def sized_broadcast(df: DataFrame, rows: int, limit: int) -> DataFrame:
    """Broadcast a side whose counted rows are within ``limit``; leave it to a shuffle join else."""
    return F.broadcast(df) if rows <= limit else df
