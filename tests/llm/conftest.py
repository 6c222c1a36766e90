import pytest
from pyspark.sql import functions as F


@pytest.fixture
def documents(spark):
    """Documents from (id, text) rows, with columns whose names clash with internal ones."""

    def make(rows):
        df = spark.createDataFrame(rows, "doc_id long, text string")
        return df.withColumns({c: F.lit(c) for c in ("key", "words", "spans", "n", "toxicity", "secrets", "lang", "source", "_text", "_own", "_block", "block", "row", "own", "predicted", "item")}).withColumn("n_chars", F.length("text").cast("long"))

    return make
