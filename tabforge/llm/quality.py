"""Document quality by hierarchical empirical Bayes.

A logistic classifier over surface statistics of a text, fitted on labelled rows, gives each
document a probability of being good. Sites say more: the probabilities of all documents of a
host, and of each path below it, are summed. Rates of hosts vary about the global rate, rates of
paths about that of their host; how much they vary, beyond what chance does, is estimated from
the sums (moments) and sets the strength of two Beta priors. So the posterior of a sparse path
leans on its host and that of a sparse host on the global rate. A document's own probability is
taken out of the sums before they speak about it, and its log-odds are moved by the difference
between its path's posterior and the global rate.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.pipeline import Pipeline
from pyspark.sql import Column, DataFrame, functions as F

from tabforge.llm.tables import settled, sized_broadcast, text_of
from tabforge.llm.toxicity import BROADCAST_LABELS, held_out

#: Paths that are broadcast at most; more meet the documents in a shuffle.
BROADCAST_PATHS = 100_000
#: The priors' strength, in documents, lies between these.
STRENGTH = (1.0, 10_000.0)
THRESHOLD = 0.5

FEATURES = ("log_words", "word_length", "distinct_words", "distinct_lines", "symbols", "upper", "digits", "pipes", "sentences", "links")


def with_features(df: DataFrame, text_col: str) -> DataFrame:
    """``df`` with ``features``, a struct of surface statistics; 0 where a text has nothing to count."""
    df = df.withColumn("q_text", text_of(text_col)).withColumn("q_words", F.array_remove(F.split("q_text", r"\s+"), ""))
    df = df.withColumn("q_n", F.size("q_words")).withColumn("q_chars", F.length("q_text"))
    lines = F.split("q_text", "\n")
    share = lambda pattern: F.regexp_count(F.col("q_text"), F.lit(pattern)) / F.greatest(F.col("q_chars"), F.lit(1))
    values = {
        "log_words": F.log1p("q_n"),
        "word_length": F.col("q_chars") / F.greatest(F.col("q_n"), F.lit(1)),
        "distinct_words": F.size(F.array_distinct("q_words")) / F.greatest(F.col("q_n"), F.lit(1)),
        "distinct_lines": F.size(F.array_distinct(lines)) / F.size(lines),
        "symbols": share(r"[#$%&*<>{}\[\]=~^_+@!]"),
        "upper": share(r"\p{Lu}"),
        "digits": share(r"[0-9]"),
        "pipes": share(r"[|•·]"),
        "sentences": share(r"[.?](?=\s|$)"),
        "links": share(r"://"),
    }
    return df.withColumn("features", F.struct(*[values[f].cast("double").alias(f) for f in FEATURES])).drop("q_text", "q_words", "q_n", "q_chars")


def site_of(site: Column, section: Column | None = None) -> tuple[Column, Column]:
    """Host and path of a URL or a plain name: the authority, and the authority with the first
    directory, or with ``section`` where one is given. Null is an empty host."""
    bare = F.regexp_replace(F.coalesce(site, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.lower(F.regexp_extract(bare, r"^([^/?#]*)", 1))
    below = F.coalesce(section.cast("string"), F.lit("")) if section is not None else F.regexp_extract(bare, r"^[^/?#]*/([^/?#]*)/", 1)
    return host, F.concat_ws("/", host, below)


def _log_odds(p: Column) -> Column:
    p = F.greatest(F.least(p, F.lit(1 - 1e-6)), F.lit(1e-6))
    return F.log(p / (1 - p))


def _strength(groups: DataFrame, about: Column) -> float:
    """Strength of the Beta prior for groups (n, good) whose rates vary about ``about``."""
    noise = about * (1 - about) / F.col("n")
    spread = (F.col("good") / F.col("n") - about) ** 2 - noise
    row = groups.agg((F.sum(F.col("n") * spread) / F.sum("n")).alias("between"), (F.sum(F.col("n") * about * (1 - about)) / F.sum("n")).alias("within")).first()
    if not row["within"]:
        return STRENGTH[1]
    if not row["between"] or row["between"] <= row["within"] / STRENGTH[1]:
        return STRENGTH[1]
    return min(max(row["within"] / row["between"] - 1, STRENGTH[0]), STRENGTH[1])


def quality(
    docs: DataFrame,
    labels: DataFrame,
    site: Column | str = "source",
    section: Column | str | None = "lang",
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = THRESHOLD,
    broadcast_labels: int = BROADCAST_LABELS,
) -> DataFrame:
    """(doc_id, host, path, p_text, host_posterior, path_posterior, score, keep) for each row.

    The classifier learns from ``labels`` (doc_id, quality) outside the held-out part; without both
    kinds of labels p_text is their share. Null and empty texts have all statistics 0, rows without
    a site are one empty host. Repeated rows count as often as they stand; other columns are ignored.
    """
    host, path = site_of(F.col(site) if isinstance(site, str) else site, F.col(section) if isinstance(section, str) else section)
    own = with_features(docs.select(F.col(id_col).alias("doc_id"), host.alias("host"), path.alias("path"), F.col(text_col).alias("text")), "text").drop("text")
    known = labels.where(F.col(id_col).isNotNull() & F.col("quality").isNotNull() & ~held_out(id_col))
    known = known.groupBy(F.col(id_col).alias("doc_id")).agg(F.max("quality").cast("double").alias("label"))
    rows = settled(own.select("doc_id", "host", "path", *[F.col("features")[f].alias(f) for f in FEATURES]))
    labelled = settled(rows.join(sized_broadcast(known, known.count(), broadcast_labels), "doc_id").select("label", *FEATURES))
    counts = labelled.agg(F.count("*").alias("n"), F.coalesce(F.sum("label"), F.lit(0.0)).alias("good")).first()
    if counts["good"] in (0, counts["n"]):
        scored = rows.withColumn("p_text", F.lit((counts["good"] + 0.5) / (counts["n"] + 1)))
    else:
        steps = [
            VectorAssembler(inputCols=list(FEATURES), outputCol="raw"),
            StandardScaler(inputCol="raw", outputCol="scaled", withMean=True),
            LogisticRegression(featuresCol="scaled", labelCol="label", regParam=1e-3, maxIter=100, probabilityCol="p"),
        ]
        scored = Pipeline(stages=steps).fit(labelled).transform(rows).withColumn("p_text", vector_to_array("p")[1])
    scored = settled(scored.select("doc_id", "host", "path", "p_text"))
    paths = settled(scored.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("p_text").alias("good")))
    hosts = settled(paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("good").alias("good")))
    totals = hosts.agg(F.sum("n").alias("n"), F.sum("good").alias("good")).first()
    rate = totals["good"] / totals["n"] if totals["n"] else 0.5
    a = _strength(hosts, F.lit(rate))
    with_host = paths.join(hosts.toDF("host", "host_n", "host_good"), "host")
    b = _strength(with_host.withColumn("about", (F.col("host_good") + a * rate) / (F.col("host_n") + a)), F.col("about"))
    side = settled(with_host.select("path", F.col("host").alias("h"), "n", "good", "host_n", "host_good"))
    both = scored.join(sized_broadcast(side, side.count(), BROADCAST_PATHS), ["path"]).where("host = h")
    p = F.col("p_text")
    both = both.withColumn("host_posterior", (F.col("host_good") - p + a * rate) / (F.col("host_n") - 1 + a))
    both = both.withColumn("path_posterior", (F.col("good") - p + b * F.col("host_posterior")) / (F.col("n") - 1 + b))
    score = 1 / (1 + F.exp(-(_log_odds(p) + _log_odds(F.col("path_posterior")) - _log_odds(F.lit(rate)))))
    return both.select("doc_id", "host", "path", "p_text", "host_posterior", "path_posterior", score.alias("score")).withColumn("keep", F.col("score") >= threshold)
