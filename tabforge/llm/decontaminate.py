"""Benchmark decontamination by a prefix-filtered set join, in DataFrame functions only.

A window is ``window_words`` consecutive words of a benchmark item (the whole item if it has
fewer). A window is a set of shingles at offsets, and a document holds the window only if it
holds all of them; so of each window the rarest shingle, counted over all documents, is the one
necessary prefix token. Documents are joined on those tokens alone; the length bound (the window
must end within the document) and the positional bound (the token stands at its offset) come
first, then the words are compared one by one. Windows of which a shingle stands nowhere are out
before the second scan.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from tabforge.llm.tables import settled, sized_broadcast, text_key, text_of

WINDOW_WORDS = 10
SHINGLE_WORDS = 5
#: Benchmark windows or shingles that are broadcast at most; more meet the documents in a shuffle.
BROADCAST_ROWS = 200_000

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Runs of digits, ASCII letters in lower case and anything beyond ASCII."""
    ascii_only = F.length(text) == F.octet_length(text)
    return F.array_remove(F.split(F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER)), _BETWEEN_WORDS), "")


def _shingles(df: DataFrame, size: int) -> DataFrame:
    """One row (..., at, shingle) for each shingle of ``size`` words in column ``words``."""
    n = F.size("words")
    at = df.withColumn("at", F.explode(F.when(n >= size, F.sequence(F.lit(0), n - size))))
    return at.withColumn("shingle", F.xxhash64(F.lit(size), *[F.col("words")[F.col("at") + k] for k in range(size)]))


def benchmark_windows(benchmark: DataFrame, id_col: str, text_col: str, window_words: int) -> DataFrame:
    """(window, item, n, words): each different window of each item; window is named by its words."""
    items = benchmark.select(F.col(id_col).cast("string").alias("item"), words_of(text_of(text_col)).alias("words"))
    n = F.least(F.size("words"), F.lit(window_words))
    at = items.withColumn("n", n).withColumn("at", F.explode(F.when(F.col("n") > 0, F.sequence(F.lit(1), F.size("words") - F.col("n") + 1))))
    cut = at.select("item", "n", F.slice("words", F.col("at"), F.col("n")).alias("words"))
    return cut.withColumn("window", F.md5(F.array_join("words", " "))).distinct()


def occurrences(docs: DataFrame, windows: DataFrame, shingle_words: int = SHINGLE_WORDS, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """(key, start, n, window): all places of the windows (window, n, words) in documents (key, words).

    Windows of fewer words than a shingle are shingles of their own size, so documents are read
    once for each size there is. Words are compared in the row they come from, or, where there
    are too many windows for a broadcast, after a second join; they are not carried otherwise.
    """
    size = F.least(F.lit(shingle_words), F.col("n"))
    sizes = sorted(r["size"] for r in windows.select(size.alias("size")).distinct().collect())  # at most shingle_words numbers
    if not sizes:
        return windows.select(F.lit(None).cast(docs.schema["key"].dataType).alias("key"), F.lit(0).alias("start"), "n", "window")
    every = [_shingles(windows.where(size == k), k).withColumn("size", F.lit(k)) for k in sizes]
    tokens = settled(reduce(DataFrame.union, every).select("window", "n", "size", "at", "shingle"))
    different = tokens.select("shingle").distinct()
    wanted = sized_broadcast(different, different.count(), broadcast_rows)
    found = reduce(DataFrame.union, [_shingles(docs, k).select("shingle").join(wanted, "shingle") for k in sizes])
    found = found.groupBy("shingle").agg(F.count("*").alias("rarity"))
    rated = tokens.join(found, "shingle").groupBy("window", "n", "size").agg(F.min(F.struct("rarity", "shingle", "at")).alias("t"), F.count("*").alias("held"))
    whole = F.col("held") == F.col("n") - F.col("size") + 1
    prefixes = settled(rated.where(whole).select("window", "n", "size", "t.shingle", F.col("t.at").alias("offset")))
    known = windows.select("window", F.col("words").alias("own"))
    fits = (F.col("at") >= F.col("offset")) & (F.col("at") - F.col("offset") + F.col("n") <= F.col("n_words"))
    same = F.slice("words", F.col("start") + 1, F.col("n")) == F.col("own")
    start = (F.col("at") - F.col("offset")).alias("start")
    in_row = prefixes.count() <= broadcast_rows
    parts = []
    for k in sizes:
        side = prefixes.where(F.col("size") == k)
        places = _shingles(docs, k).withColumn("n_words", F.size("words"))
        if in_row:
            met = places.join(F.broadcast(side.join(known, "window")), "shingle").where(fits).select("key", "words", start, "n", "window", "own")
            parts.append(met.where(same).select("key", "start", "n", "window"))
        else:
            parts.append(places.select("key", "at", "shingle", "n_words").join(side, "shingle").where(fits).select("key", start, "n", "window"))
    met = reduce(DataFrame.union, parts)
    return met if in_row else met.distinct().join(docs, "key").join(known, "window").where(same).select("key", "start", "n", "window")


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window_words: int = WINDOW_WORDS,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """(key, doc_id, n_words, n_hit, items, contaminated): words inside windows, and whose windows.

    ``items`` holds the ids of the items with occurring windows, as strings in order; an item
    without an id counts for hits but is not named. Null or empty texts have no words, an item
    without words has no window, an empty benchmark hits nothing. Ids may be of any type with a string form.
    Different texts that share an id are documents of their own, and ``key`` (``text_key``) tells them apart; a repeated
    row gives an equal result row, a repeated item changes nothing. Other columns are ignored.
    """
    words = docs.select(text_key(id_col, text_col).alias("key"), F.col(id_col).alias("doc_id"), words_of(text_of(text_col)).alias("words"))
    windows = settled(benchmark_windows(benchmark, item_col, item_text_col, window_words))
    places = settled(occurrences(words.select("key", "words"), windows.select("window", "n", "words").distinct(), broadcast_rows=broadcast_rows).distinct())
    ends = places.groupBy("key", "start").agg(F.max(F.col("start") + F.col("n")).alias("end"))
    before = F.max("end").over(Window.partitionBy("key").orderBy("start").rowsBetween(Window.unboundedPreceding, -1))
    covered = ends.select("key", F.greatest(F.lit(0), F.col("end") - F.greatest("start", F.coalesce(before, F.lit(0)))).alias("new"))
    hits = covered.groupBy("key").agg(F.sum("new").alias("n_hit"))
    owners = windows.where("item is not null").select("window", "item")
    named = places.select("key", "window").distinct().join(sized_broadcast(owners, owners.count(), broadcast_rows), "window")
    items = named.groupBy("key").agg(F.sort_array(F.collect_set("item")).alias("items"))
    n_words = words.select("key", "doc_id", F.size("words").cast("long").alias("n_words"))
    out = n_words.join(hits.join(items, "key", "left"), "key", "left")
    return out.select(
        "key",
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"),
    )
