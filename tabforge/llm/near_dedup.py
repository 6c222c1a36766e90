"""Near-duplicate classes by ProbMinHash, banding and exact verification.

A text is a bag of five-word shingles (lower-case ASCII letters, digits and all beyond ASCII
make words; a text of one to four words is one shingle). The likeness of two bags is their
probability Jaccard: the sum over shared shingles d of 1 / sum_e max(x_e / x_d, y_e / y_d),
which is plain Jaccard where no shingle is repeated.

1. ProbMinHash: each shingle of weight x is a Poisson process of rate x that hits random
   registers; a register keeps the shingle of its first arrival. A process ends as soon as its
   next arrival is later than all registers. Two texts agree in a register with a probability
   that is their likeness.
2. Equal texts become one class at once, by partial sums. Only one of each goes on.
3. Banding: four registers make a bucket, 32 bands. A pair at 0.8 misses them all with a
   probability of 5e-8.
4. In a bucket each member is compared with one pivot, the member with most company over all
   bands, so a bucket of like texts takes work in proportion to its size. Pairs whose registers
   agree within five standard errors are verified on the whole bags.
5. Members that are not in their pivot's component by then may still be like others of the
   bucket. They are measured against all members of the pivot's buckets, in pairs of blocks of
   bounded size: a product of two small matrices gives all shared counts of a pair of blocks,
   and only links that join something are written. Blocks hold texts of a like number of
   shingles, and blocks too different in that are not paired.
6. Connected components of the verified links are the classes.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tabforge.llm.graph import components
from tabforge.llm.tables import id_of, in_batches, keyed, settled
from tabforge.llm.words import SMALL_BLOCK_BYTES, Block, blocks, mix

SHINGLE_WORDS = 5
SIMILARITY = 0.8
REGISTERS = 128
ROWS = 4
#: Texts of a block, about.
BLOCK_TEXTS = 128
#: Shingles of a block that are held as a matrix at a time.
MATRIX_COLUMNS = 16_384


def bags(block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, shingle, count) of a block, ordered by text and shingle."""
    first = block.windows(SHINGLE_WORDS)
    words = np.diff(block.word_bounds)
    short = np.flatnonzero((words > 0) & (words < SHINGLE_WORDS))
    text = np.concatenate([block.text_of_word[first], short])
    shingle = np.concatenate([block.ranges(first, first + SHINGLE_WORDS), block.ranges(block.word_bounds[short], block.word_bounds[short + 1])])
    order = np.lexsort((shingle, text))
    text, shingle = text[order], shingle[order]
    new = np.flatnonzero(np.concatenate([[True], (text[1:] != text[:-1]) | (shingle[1:] != shingle[:-1])])) if len(text) else order
    return text[new], shingle[new], np.diff(np.append(new, len(text)))


def prob_minhash(text: np.ndarray, shingle: np.ndarray, weight: np.ndarray, n_texts: int, registers: int = REGISTERS) -> np.ndarray:
    """The registers of each text: 32 bits of the shingle that arrives first; 0 without shingles."""
    first = np.full(n_texts * registers, np.inf)
    winner = np.zeros(n_texts * registers, dtype=np.uint64)
    now = np.zeros(len(text))
    i = 0
    while len(text):
        i += 1
        draw = mix(shingle + np.uint64(i * 0x9E3779B97F4A7C15 % 2**64))
        now = now - np.log1p(-((draw >> np.uint64(11)).astype(np.float64) * 2.0**-53)) / weight
        at = text * registers + (mix(draw + np.uint64(1)) % np.uint64(registers)).astype(np.int64)
        np.minimum.at(first, at, now)
        won = first[at] == now
        winner[at[won]] = shingle[won]
        on = now < first.reshape(n_texts, registers).max(axis=1)[text]
        text, shingle, weight, now = text[on], shingle[on], weight[on], now[on]
    return (winner >> np.uint64(32)).astype(np.uint32).view(np.int32).reshape(n_texts, registers)


def probability_jaccard(a: np.ndarray, x: np.ndarray, b: np.ndarray, y: np.ndarray) -> float:
    """Likeness of the bags (a, x) and (b, y); ids ascending and distinct, weights positive."""
    both, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    if not len(both):
        return 0.0
    xs, ys = x[i].astype(float), y[j].astype(float)
    rest_x, rest_y = float(x.sum()) - xs.sum(), float(y.sum()) - ys.sum()
    total = 0.0
    ratio, own = np.unique(xs / ys, return_inverse=True)
    for k, r in enumerate(ratio):  # one value unless shingles repeat
        total += xs[own == k].sum() / (rest_x + r * rest_y + np.maximum(xs, r * ys).sum())
    return total


def with_text_hashes(docs: DataFrame, text: Column) -> DataFrame:
    """``docs`` with t1 and t2, two hashes that together stand for a text."""
    return docs.withColumns({"t1": F.xxhash64(text), "t2": F.xxhash64(F.length(text), F.hash(text))})


def _wanted_texts(docs: DataFrame, reps: DataFrame, wanted: DataFrame) -> DataFrame:
    """(key, text) of those ``reps`` whose key is wanted; a text is found by an id and its hashes."""
    own = reps.join(wanted, "key", "left_semi").select("doc_key", "t1", "t2", F.col("key").alias("rep"))
    same = ["doc_key", "t1", "t2"]
    found = docs.withColumnRenamed("key", "doc_key").join(own, same).dropDuplicates(same)
    return found.select(F.col("rep").alias("key"), "text")


def _signatures(docs: DataFrame) -> DataFrame:
    """(key, t1, t2, registers): t1 and t2 are hashes of the text, registers empty without words."""

    def sign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in blocks(batch.column("text"), "alnum", fold_case=True, most=SMALL_BLOCK_BYTES):
                text, shingle, count = bags(b)
                found = prob_minhash(text, shingle, count.astype(float), b.n_texts)
                has = np.diff(b.word_bounds) > 0
                bounds = np.concatenate([[0], np.cumsum(has * REGISTERS)]).astype(np.int32)
                rows = batch.slice(b.first, b.n_texts)
                yield pa.RecordBatch.from_arrays(
                    [rows.column(c) for c in ("key", "t1", "t2")] + [pa.ListArray.from_arrays(bounds, found[has].ravel())], ["key", "t1", "t2", "registers"]
                )

    return in_batches(docs.select("key", "t1", "t2", "text")).mapInArrow(sign, "key long, t1 long, t2 long, registers array<int>")


def _bags(docs: DataFrame) -> DataFrame:
    """(key, ids, counts): 32 bits of each distinct shingle, ascending, and how often it stands."""

    def make(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in blocks(batch.column("text"), "alnum", fold_case=True, most=SMALL_BLOCK_BYTES):
                text, shingle, count = bags(b)
                short = (shingle >> np.uint64(32)).astype(np.uint32)
                bounds = np.searchsorted(text, np.arange(b.n_texts + 1))
                ids, counts = [], []
                for lo, hi in zip(bounds[:-1], bounds[1:]):
                    own, at = np.unique(short[lo:hi], return_inverse=True)
                    sums = np.bincount(at, weights=count[lo:hi], minlength=len(own)).astype(np.uint32)
                    ids.append(own.tobytes())
                    counts.append(sums.tobytes() if (sums != 1).any() else b"")
                yield pa.RecordBatch.from_arrays([batch.column("key").slice(b.first, b.n_texts), pa.array(ids, pa.binary()), pa.array(counts, pa.binary())], ["key", "ids", "counts"])

    return in_batches(docs).mapInArrow(make, "key long, ids binary, counts binary")


def _agreeing(pairs: DataFrame, reps: DataFrame, least: float) -> DataFrame:
    """The pairs whose registers agree in a share of at least ``least``."""

    def agree(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (batch.column(c).flatten().to_numpy().reshape(-1, REGISTERS) for c in ("x", "y"))
            yield batch.select(["a", "b"]).filter(pa.array((x == y).mean(axis=1) >= least))

    both = pairs.join(reps.select(F.col("key").alias("a"), F.col("registers").alias("x")), "a").join(
        reps.select(F.col("key").alias("b"), F.col("registers").alias("y")), "b"
    )
    return in_batches(both.select("a", "b", "x", "y")).mapInArrow(agree, "a long, b long")


def _verified(pairs: DataFrame, docs: DataFrame, reps: DataFrame, similarity: float) -> DataFrame:
    """The pairs whose whole bags are alike."""

    def measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for a, x, b, y in zip(*(batch.column(c) for c in ("ids_a", "counts_a", "ids_b", "counts_b"))):
                a, b = np.frombuffer(a.as_py(), np.uint32), np.frombuffer(b.as_py(), np.uint32)
                x, y = (np.frombuffer(w.as_py(), np.uint32) if len(w.as_py()) else np.ones(len(i), np.uint32) for w, i in ((x, a), (y, b)))
                found.append(probability_jaccard(a, x, b, y))
            out = batch.select(["a", "b"]).append_column("similarity", pa.array(found, pa.float64()))
            yield out.filter(pa.array(np.array(found) >= similarity - 1e-12, pa.bool_()))

    wanted = pairs.select(F.col("a").alias("key")).union(pairs.select("b")).distinct()
    own = _bags(_wanted_texts(docs, reps, wanted))
    both = pairs.join(own.toDF("a", "ids_a", "counts_a"), "a").join(own.toDF("b", "ids_b", "counts_b"), "b")
    return in_batches(both).mapInArrow(measure, "a long, b long, similarity double")


def _shared_counts(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """How many ids each of the sets a shares with each of the sets b."""
    ids_a, ids_b = np.concatenate(a), np.concatenate(b)
    both = np.intersect1d(ids_a, ids_b)
    text_a, text_b = (np.repeat(np.arange(len(x)), [len(i) for i in x]) for x in (a, b))
    out = np.zeros((len(a), len(b)), dtype=np.float32)
    for lo in range(0, len(both), MATRIX_COLUMNS):
        part = both[lo : lo + MATRIX_COLUMNS]
        sides = []
        for ids, text, n in ((ids_a, text_a, len(a)), (ids_b, text_b, len(b))):
            at = np.searchsorted(part, ids)
            at[at == len(part)] = 0
            on = part[at] == ids
            m = np.zeros((n, len(part)), dtype=np.float32)
            m[text[on], at[on]] = 1
            sides.append(m)
        out += sides[0] @ sides[1].T
    return out


def _block_links(rows: pa.Table, similarity: float) -> list[tuple[int, int]]:
    """Links between the two sides of a pair of blocks, no more than join their components."""
    side = {}
    for flag in (0, 1):
        own = rows.filter(pa.array(rows.column("side").to_numpy() == flag))
        ids = [np.frombuffer(i, np.uint32) for i in own.column("ids").to_pylist()]
        counts = [np.frombuffer(c, np.uint32) if c else None for c in own.column("counts").to_pylist()]
        side[flag] = (own.column("key").to_pylist(), own.column("component").to_pylist(), ids, counts)
    (keys_a, parts_a, ids_a, counts_a), (keys_b, parts_b, ids_b, counts_b) = side[0], side[1]
    if not keys_a or not keys_b:
        return []
    shared = _shared_counts(ids_a, ids_b)
    sizes_a, sizes_b = (np.array([len(i) for i in ids]) for ids in (ids_a, ids_b))
    near = shared >= similarity * (sizes_a[:, None] + sizes_b[None, :] - shared) - 1e-6
    weighted = np.logical_or.outer([c is not None for c in counts_a], [c is not None for c in counts_b])
    up: dict[int, int] = {}

    def top(x: int) -> int:
        while up.get(x, x) != x:
            x = up[x]
        return x

    out = []
    for i, j in zip(*np.nonzero((near & ~weighted) | (weighted & (shared > 0)))):
        one, two = top(parts_a[i]), top(parts_b[j])
        if one == two:
            continue
        if weighted[i, j]:
            x, y = (np.ones(len(n), np.uint32) if c is None else c for n, c in ((ids_a[i], counts_a[i]), (ids_b[j], counts_b[j])))
            if probability_jaccard(ids_a[i], x, ids_b[j], y) < similarity - 1e-12:
                continue
        up[one] = two
        out.append((keys_a[i], keys_b[j]))
    return out


def _links_in_blocks(families: DataFrame, docs: DataFrame, reps: DataFrame, similarity: float, block_texts: int) -> DataFrame:
    """(a, b) between members of a family that are in different components.

    ``families`` has pivot, key, component and main, the pivot's component. Of each pair at least
    one is outside main. Where all shingles count once, sets whose sizes differ by more than
    ``similarity`` cannot be like, so only blocks of neighbouring size classes meet; texts with
    repeated shingles meet all.
    """
    apart = families.groupBy("pivot").agg(F.max(F.col("component") != F.col("main")).alias("apart")).where("apart").select("pivot")
    apart = settled(apart)  # tables of their own, here and below, so that joins on a large family can be split
    families = settled(families.join(apart, "pivot", "left_semi"))
    bags_of = settled(_bags(_wanted_texts(docs, reps, families.select("key").distinct())))
    size = F.floor(F.log(F.greatest(F.length("ids") / 4, F.lit(1))) / -math.log(similarity) + 1e-9).cast("int")
    kinds = bags_of.select("key", F.when(F.length("counts") > 0, F.lit(-1)).otherwise(size).alias("kind"))
    rows = settled(families.join(kinds, "key"))
    sides = {}
    for side, own in ((0, rows.where("component <> main")), (1, rows)):
        blocks = settled(own.groupBy("pivot", "kind").agg(F.ceil(F.count("*") / block_texts).cast("int").alias("blocks")))
        placed = own.join(blocks, ["pivot", "kind"]).withColumn("block", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
        sides[side] = (placed.select("pivot", "kind", "block", "key", "component"), blocks)
    here, there = sides[0][1].toDF("pivot", "kind_a", "blocks_a"), sides[1][1].toDF("pivot", "kind_b", "blocks_b")
    meets = (F.abs(F.col("kind_a") - F.col("kind_b")) <= 1) | (F.col("kind_a") == -1) | (F.col("kind_b") == -1)
    kind_pairs = settled(here.join(there, "pivot").where(meets))  # kinds of a family are a few sizes
    parts = []
    for side, (own, other) in enumerate((("a", "b"), ("b", "a"))):
        placed = sides[side][0].withColumnsRenamed({"kind": f"kind_{own}", "block": f"block_{own}"})
        met = placed.join(kind_pairs, ["pivot", f"kind_{own}"]).withColumn(f"block_{other}", F.explode(F.sequence(F.lit(0), F.col(f"blocks_{other}") - 1)))
        parts.append(met.select("pivot", "kind_a", "kind_b", "block_a", "block_b", "key", "component", F.lit(side).alias("side")))
    both = parts[0].union(parts[1]).join(bags_of, "key")

    def links(group: pa.Table) -> pa.Table:
        found = _block_links(group, similarity)
        return pa.table({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})

    return both.groupBy("pivot", "kind_a", "kind_b", "block_a", "block_b").applyInArrow(links, "a long, b long")


def near_links(docs: DataFrame, table: DataFrame, similarity: float, block_texts: int = BLOCK_TEXTS) -> tuple[DataFrame, DataFrame]:
    """Verified links between different texts, enough to connect every class; and those texts.

    A text has a key of its own, as an id may stand for several texts; ``doc_key`` is its least id.
    """
    reps = table.groupBy("t1", "t2").agg(F.min(F.struct("key", "registers")).alias("r"))
    reps = settled(reps.select("t1", "t2", F.col("r.key").alias("doc_key"), F.monotonically_increasing_id().alias("key"), "r.registers"))
    has = reps.where(F.size("registers") > 0)
    bands = F.explode(F.array(*[F.xxhash64(F.lit(k), *[F.col("registers")[k + i] for i in range(ROWS)]) for k in range(0, REGISTERS, ROWS)]))
    spread = has.select("key", bands.alias("bucket"))
    shared = spread.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    crowd = settled(spread.join(shared, "bucket"))
    company = settled(crowd.groupBy("key").agg(F.sum("size").alias("company")))
    members = crowd.join(company, "key").select("bucket", "key", "company")
    pivots = settled(members.groupBy("bucket").agg(F.max(F.struct("company", F.negative("key").alias("k"))).alias("p")).select("bucket", F.negative("p.k").alias("pivot")))
    families = settled(crowd.select("bucket", "key").join(pivots, "bucket").where("key <> pivot").select("pivot", "key").distinct())
    least = similarity - 5 * (similarity * (1 - similarity) / REGISTERS) ** 0.5
    pairs = families.select(F.least("key", "pivot").alias("a"), F.greatest("key", "pivot").alias("b")).distinct()
    near = settled(_agreeing(pairs, has, least))
    links = settled(_verified(near, docs, reps, similarity).select("a", "b"))
    classes = components(links)
    own, main = classes.toDF("key", "component"), classes.toDF("pivot", "main")
    rated = families.join(own, "key", "left").join(main, "pivot", "left")
    rated = rated.select("pivot", "key", F.coalesce("component", "key").alias("component"), F.coalesce("main", "pivot").alias("main"))
    return links.union(settled(_links_in_blocks(rated, docs, reps, similarity, block_texts))), reps


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """(key, t1, t2, doc_id, class_id, class_size, is_kept): the class of each document, by its key
    of ``keyed`` and the hashes of its text.

    A class is named by its least doc_id, which is kept; of texts that share that id, the one of
    the least hashes. Equal texts are one class, empty and null ones too; a text without words is
    like equal texts only. Rows that share an id and a text make one row; texts that share an id
    are documents of their own. Rows without an id are told apart by their texts, and their
    doc_id, and class_id where the class has no other, is null. Other columns are ignored.
    """
    docs = with_text_hashes(keyed(df, id_col, text_col), F.col("text"))
    table = settled(_signatures(docs))
    links, reps = near_links(docs, table, similarity)
    classes = components(links).toDF("key", "component")
    named = reps.join(classes, "key", "left").select("t1", "t2", F.coalesce("component", "key").alias("component"))
    members = settled(table.select("key", "t1", "t2").distinct().join(named, ["t1", "t2"]))
    # Both sides of the join are plain, so a large class can be split.
    sizes = settled(members.groupBy("component").agg(F.count("*").alias("class_size"), F.min(F.struct("key", "t1", "t2")).alias("first")))
    return members.join(sizes, "component").select(
        "key", "t1", "t2", id_of("key").alias("doc_id"), id_of("first.key").alias("class_id"), "class_size", (F.struct("key", "t1", "t2") == F.col("first")).alias("is_kept")
    )
