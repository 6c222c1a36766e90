"""Document fingerprints by SpotSigs, in DataFrame functions only.

Common words are anchors. The content words that follow an anchor (or the start of the text), up
to ``CHAIN`` of them and over further anchors, are one signature; the fingerprint is the set of
signatures. Words of a fixed share of hash values are anchors too, so texts in a language without
listed words are cut as well.

Fingerprints are compared by Jaccard. The ratio of two set sizes bounds it from above, so
``similar_pairs`` lets only sets of the same or a neighbouring class of sizes meet, on the rare
signatures that a pair over the threshold must share, and measures what passes the exact bound.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from tabforge.llm.decontaminate import words_of
from tabforge.llm.tables import id_of, keyed, settled

CHAIN = 3
#: One word in so many is an anchor by its hash.
HASHED_ANCHORS = 16

# The anchors, common words of four languages.
ANCHORS = (
    "a an and are as at be but by for from had has have he her his in is it not of on or said she that the their there they this to was were which with you "
    "als am auf aus bei das dem den der des die ein eine einen er es für ich im ist mit nach nicht sich sie sind und von war wie zu zum "
    "au aux avec ce cette dans de du elle en est et il je la le les mais ne nous ou par pas plus pour que qui se son sur un une vous "
    "al como con del el ella en era esta este la las lo los más no para pero por que se ser si sin su sus un una y ya"
).split()

_MARK = "\u0001"


def with_signatures(df: DataFrame, text_col: str, out: str) -> DataFrame:
    """``df`` with the signature set of a text: ascending 32-bit hashes, empty without content words.

    The steps are columns of their own, so that each is computed once for a row.
    """
    anchors = sorted(set(ANCHORS))
    hashed = lambda w: F.pmod(F.xxhash64(w), F.lit(HASHED_ANCHORS)) == 0
    marked = F.transform(words_of(F.col(text_col)), lambda w: F.when(w.isin(anchors) | hashed(w), _MARK).otherwise(w))
    spots, after = f"{out}_spots", [f"{out}_after{k}" for k in range(1, CHAIN)]
    df = df.withColumn(spots, F.split(F.array_join(marked, " "), f" ?{_MARK}[ {_MARK}]*"))
    df = df.withColumn(spots, F.array_remove(spots, ""))
    df = df.withColumns({a: F.slice(spots, k + 1, F.size(spots)) for k, a in enumerate(after, 1)})
    chains = F.transform(
        F.arrays_zip(spots, *after), lambda z: F.hash(F.substring_index(F.concat_ws(" ", z[spots], *[z[a] for a in after]), " ", CHAIN))
    )
    return df.withColumn(out, F.array_sort(F.array_distinct(chains))).drop(spots, *after)


def fingerprint(signature: Column) -> Column:
    """A signature set as text: eight hex digits for each signature, in order."""
    return F.array_join(F.transform(signature, lambda s: F.lpad(F.hex(s.cast("long").bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0")), "")


def jaccard(a: Column, b: Column, least: float = 0.0) -> Column:
    """Jaccard of two signature sets; null where their sizes alone rule ``least`` out; 1 for two empty sets."""
    small, large = F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))
    shared = F.size(F.array_intersect(a, b))
    return F.when(large == 0, 1.0).when(small < least * large, F.lit(None)).when(small == 0, 0.0).otherwise(shared / (F.size(a) + F.size(b) - shared))


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(key, text, signature): one row for each document.

    Null texts are empty and have an empty set. Rows that share an id are one document with the
    greatest of their texts; rows without an id are told apart by their texts. Other columns are
    ignored.
    """
    texts = keyed(df, id_col, text_col).groupBy("key").agg(F.max("text").alias("text"))
    return with_signatures(texts, "text", "signature")


def next_documents(keys: DataFrame) -> DataFrame:
    """(key, next_key): the next smaller key; after the least comes the greatest.

    Keys are sorted into ranges by Spark. Neighbours within a range are found there; between
    ranges there is one row each, so the last step sorts as many rows as there are partitions.
    """
    ranged = settled(keys.repartitionByRange(F.desc("key")).withColumn("part", F.spark_partition_id()))
    heads = ranged.groupBy("part").agg(F.max("key").alias("head"))
    in_order = Window.orderBy("part")
    first = F.first("head").over(in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    heads = heads.select("part", F.coalesce(F.lead("head").over(in_order), first).alias("next_head"))
    inner = ranged.withColumn("next", F.lead("key").over(Window.partitionBy("part").orderBy(F.desc("key"))))
    return inner.join(F.broadcast(heads), "part").select("key", F.coalesce("next", "next_head").alias("next_key"))


def edit_likeness(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document against an edited self and against the next document.

    (doc_id, n_chars, edited, signature, edited_signature, near_edited, near_next). The edited
    text has its last half (code points, rounded down) replaced by the first as many of the next
    document in descending doc_id. A single document is its own next one.
    """
    docs = keyed(df, id_col, text_col)
    texts = docs.groupBy("key").agg(F.max("text").alias("text"))
    links = settled(next_documents(docs.select("key").distinct()))
    halves = texts.select("key", F.floor(F.length("text") / 2).cast("int").alias("half")).join(links, "key").withColumnRenamed("key", "of")
    following = with_signatures(halves.join(texts, F.col("next_key") == F.col("key")), "text", "next_signature")
    following = following.select(F.col("of").alias("key"), "half", F.expr("left(text, half)").alias("new"), "next_signature")
    both = texts.join(following, "key").withColumn("edited", F.expr("concat(left(text, length(text) - half), new)"))
    both = with_signatures(with_signatures(both, "text", "signature"), "edited", "edited_signature")
    return both.select(
        id_of("key").alias("doc_id"),
        F.length("text").cast("long").alias("n_chars"),
        "edited",
        "signature",
        "edited_signature",
        jaccard(F.col("signature"), F.col("edited_signature")).alias("near_edited"),
        jaccard(F.col("signature"), F.col("next_signature")).alias("near_next"),
    )


def similar_pairs(prints: DataFrame, least: float = 0.8) -> DataFrame:
    """(a, b, likeness) between different signature sets, and their members by ``same``.

    ``prints`` has key and signature. Equal sets are one class, named by the least key, so copies
    are not paired. Classes of sizes are powers of 1 / least: a pair over the threshold lies in
    the same class or in neighbouring ones. Signatures are ordered by rarity; a pair must share
    one of the first n - ceil(least * n) + 1 of either set.
    """
    sets = settled(prints.where(F.size("signature") > 0).groupBy("signature").agg(F.min("key").alias("same")))
    sized = sets.withColumn("n", F.size("signature")).withColumn("size_class", F.floor(F.log("n") / -math.log(least) + 1e-9).cast("int"))
    each = sized.select("same", "n", "size_class", F.explode("signature").alias("s"))
    rarity = each.groupBy("s").agg(F.count("*").alias("rarity"))
    order = Window.partitionBy("same").orderBy("rarity", "s")
    needed = F.col("n") - F.ceil(F.col("n") * least - 1e-9) + 1
    prefix = settled(each.join(rarity, "s").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= needed).select("same", "n", "size_class", "s"))
    one = prefix.select(F.col("same").alias("a"), F.col("n").alias("na"), "size_class", "s")
    two = prefix.select(F.col("same").alias("b"), F.col("n").alias("nb"), F.explode(F.array(F.col("size_class"), F.col("size_class") - 1)).alias("size_class"), "s")
    met = one.join(two, ["size_class", "s"]).where("a <> b").where((F.col("na") < F.col("nb")) | ((F.col("na") == F.col("nb")) & (F.col("a") < F.col("b"))))
    pairs = met.where(F.col("na") >= least * F.col("nb")).select("a", "b").distinct()
    own = sets.select("same", "signature")
    measured = pairs.join(own.toDF("a", "x"), "a").join(own.toDF("b", "y"), "b").select("a", "b", jaccard(F.col("x"), F.col("y"), least).alias("likeness"))
    return measured.where(F.col("likeness") >= least - 1e-12)
