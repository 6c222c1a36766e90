"""Ranked lexical search over bit-sliced Bloom signatures.

The index holds shards of documents of about one length. A shard is a matrix of bits with a row
(slice) for each bit of the signature and a column for each document. For each term, and for each
level 2, 4, 8, ... that its number of occurrences reaches, a document has ``HASHES`` bits set. The
conjunction of an entry's slices is a bitmap over the documents that holds all that have it, and
a few others: presence, and occurrences, are overestimated and never missed.

1. One scan of the texts writes the index; numbers of documents for each term come from a second
   output of the same words, summed before the shuffle.
2. For an item the bitmaps of its terms, weighted by what a term and a level can add to the score of
   a document of that length, sum up to an upper bound of the score of each document.
3. The ``TOP`` documents of the highest bounds of each item are scored exactly, from their texts.
   The score of the last of them is a floor: the wanted documents have that score or more.
4. All documents whose bound reaches the floor, those not provably excluded, are scored exactly and
   ranked. Of documents with equal texts only the first ids can be wanted, which excludes
   the others of a large group of copies.

Texts are read by the scan and, for documents still in question, by the two scorings. Items are a
stated set of queries, met in blocks of ``ITEMS`` with all shards; what the workers are sent of a
block is its terms.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from tabforge.llm.near_dedup import with_text_hashes
from tabforge.llm.tables import settled, text_of
from tabforge.llm.words import Block, blocks, mix

TOP = 10
#: Items of a block.
ITEMS = 512
#: Bits of a signature that an entry sets, and bits of it for each entry.
HASHES, BITS_PER_ENTRY = 3, 8
#: Documents of a shard, and bits of its matrix, at most; a document that has more is a shard of its own.
SHARD_DOCUMENTS, SHARD_BITS = 1024, 2**23
#: Terms that a task counts before it hands them on.
COUNTED = 2**20
#: Levels: entry j of a term says that it occurs 2**j times or more.
LEVELS = 40
#: Up to so many rows candidates are sent to all tasks.
CARRIED = 100_000

_KEYS = ("id", "t1", "t2")


def bag(block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, term, occurrences) of a block, ordered by text and term."""
    order = np.lexsort((block.hashes, block.text_of_word))
    text, term = block.text_of_word[order], block.hashes[order]
    new = np.flatnonzero(np.concatenate([[True], (text[1:] != text[:-1]) | (term[1:] != term[:-1])])) if len(text) else order
    return text[new], term[new], np.diff(np.append(new, len(text)))


def level(occurrences: np.ndarray) -> np.ndarray:
    """The greatest j with 2**j occurrences or fewer."""
    return np.frexp(occurrences.astype(np.float64))[1] - 1


def slices(term: np.ndarray, j: int | np.ndarray, bits: int) -> np.ndarray:
    """The slices of an entry, a column for each hash."""
    own = mix(term + np.asarray(j).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return np.stack([(mix(own + np.uint64(k + 1)) % np.uint64(bits)).astype(np.int64) for k in range(HASHES)], axis=1)


def signature_matrix(document: np.ndarray, term: np.ndarray, j: np.ndarray, documents: int, bits: int) -> np.ndarray:
    """Packed bits of ``bits`` slices over ``documents``, from entries (document, term, level)."""
    out = np.zeros((bits, documents), dtype=bool)
    for column in slices(term, j, bits).T:
        out[column, document] = True
    return np.packbits(out, axis=1)


_INDEX = ["bits", "n", "id", "t1", "t2", "terms", "holders"]


class Waiting:
    """Documents of about one number of entries that will be a shard."""

    def __init__(self):
        self.n, self.terms, self.levels, self.at = [], [], [], []

    def add(self, n: int, terms: np.ndarray, levels: np.ndarray, names: tuple) -> None:
        self.n.append(n), self.terms.append(terms), self.levels.append(levels), self.at.append(names)

    def shard(self, id_type: pa.DataType) -> pa.RecordBatch:
        sizes = np.array([len(t) for t in self.terms])
        document = np.repeat(np.arange(len(sizes)), sizes)
        width = BITS_PER_ENTRY * int(sizes.max())
        matrix = signature_matrix(document, np.concatenate(self.terms), np.concatenate(self.levels), len(sizes), width)
        ids, t1, t2 = zip(*self.at)
        lists = [pa.array([list(x)], pa.list_(kind)) for x, kind in ((self.n, pa.int64()), (ids, id_type), (t1, pa.int64()), (t2, pa.int64()))]
        return pa.RecordBatch.from_arrays([pa.array([matrix.tobytes()], pa.binary()), *lists, *(pa.nulls(1, pa.list_(pa.int64())) for _ in range(2))], _INDEX)


class Counted:
    """Numbers of documents for each term, of the blocks of a task."""

    def __init__(self):
        self.terms, self.holders = [], []

    def add(self, terms: np.ndarray) -> None:
        own, n = np.unique(terms, return_counts=True)
        self.terms.append(own), self.holders.append(n)
        if sum(map(len, self.terms)) > COUNTED:
            self.merge()

    def merge(self) -> None:
        if self.terms:
            own, place = np.unique(np.concatenate(self.terms), return_inverse=True)
            n = np.zeros(len(own), dtype=np.int64)
            np.add.at(n, place, np.concatenate(self.holders))
            self.terms, self.holders = [own], [n]

    def full(self) -> bool:
        return len(self.terms) == 1 and len(self.terms[0]) > COUNTED // 2

    def rows(self, id_type: pa.DataType) -> pa.RecordBatch:
        self.merge()
        kinds = (pa.binary(), pa.list_(pa.int64()), pa.list_(id_type), pa.list_(pa.int64()), pa.list_(pa.int64()))
        own = [pa.ListArray.from_arrays(pa.array([0, len(x[0])], pa.int32()), pa.array(x[0].view(np.int64))) for x in (self.terms, self.holders)]
        self.terms, self.holders = [], []
        return pa.RecordBatch.from_arrays([*(pa.nulls(1, k) for k in kinds), *own], _INDEX)


def index(docs: DataFrame) -> DataFrame:
    """Shards (bits, n, id, t1, t2) of documents (id, t1, t2, text), and rows (terms, holders).

    A row is a shard, with its packed matrix in ``bits`` and numbers of words and names of its
    documents in lists of equal order, or lists of terms and of the documents of a task that hold each.
    """
    kind = docs.schema["id"].dataType.simpleString()

    def build(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[int, Waiting] = {}
        counted = Counted()
        id_type = pa.int64()
        for batch in batches:
            ids, one, two = (batch.column(c) for c in _KEYS)
            id_type, one, two = ids.type, one.to_numpy(), two.to_numpy()
            for b in blocks(batch.column("text"), "alnum", True):
                text, term, n = bag(b)
                counted.add(term)
                if counted.full():
                    yield counted.rows(id_type)
                high = level(n) + 1
                entry = np.repeat(np.arange(len(n)), high)
                j = (np.arange(len(entry)) - np.repeat(np.cumsum(high) - high, high)).astype(np.uint8)
                bounds = np.searchsorted(text[entry], np.arange(b.n_texts + 1))
                words = np.diff(b.word_bounds)
                for t in np.flatnonzero(words).tolist():
                    own = slice(bounds[t], bounds[t + 1])
                    size, at = int(bounds[t + 1] - bounds[t]).bit_length(), b.first + t
                    group = waiting.setdefault(size, Waiting())
                    group.add(int(words[t]), term[entry[own]], j[own], (ids[at].as_py(), int(one[at]), int(two[at])))
                    if len(group.n) >= SHARD_DOCUMENTS or (len(group.n) + 1) * (BITS_PER_ENTRY << size) > SHARD_BITS:
                        yield waiting.pop(size).shard(id_type)
        for group in waiting.values():
            yield group.shard(id_type)
        if counted.terms:
            yield counted.rows(id_type)

    shape = f"bits binary, n array<bigint>, id array<{kind}>, t1 array<bigint>, t2 array<bigint>, terms array<bigint>, holders array<bigint>"
    return docs.mapInArrow(build, shape)


@dataclass
class Items:
    """A block of items, as its workers get it."""

    terms: np.ndarray  # ascending hashes
    weights: np.ndarray  # of each term
    places: list[np.ndarray]  # for each item its terms, by place in ``terms``
    counts: list[np.ndarray]  # and how often each stands in the item
    n_docs: int
    n_words: int

    def spread(self, n: np.ndarray) -> np.ndarray:
        """m of documents of ``n`` words."""
        return 25 + (75 * n * self.n_docs) // self.n_words


def gain(occurrences: np.ndarray | int, m: np.ndarray) -> np.ndarray:
    """What a term adds to a score for each unit of its weight; it grows with its occurrences."""
    tf = np.asarray(occurrences, dtype=np.int64)
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def upper_bounds(items: Items, bits: np.ndarray, n: np.ndarray) -> np.ndarray:
    """For each item and document of a shard, a number that its score does not exceed.

    ``n`` occurrences are the most a document can have of a term, 2**(j + 1) - 1 if level j + 1 is
    not in its signature.
    """
    width, m = len(bits), items.spread(n)
    out = np.zeros((len(items.places), len(n)), dtype=np.int64)
    alive, known = np.arange(len(items.terms)), np.zeros(len(n), dtype=np.int64)
    before = None
    for j in range(LEVELS):
        own = slices(items.terms[alive], j, width)
        found = bits[own[:, 0]]
        for k in range(1, HASHES):
            found = found & bits[own[:, k]]
        if before is not None:
            found &= before
        some = found.any(axis=1)
        alive, before = alive[some], found[some]
        if not len(alive):
            break
        most = gain(np.minimum(2 ** (j + 1) - 1, n), m)
        step, known = most - known, most
        present = np.unpackbits(before, axis=1, count=len(n))
        row = np.full(len(items.terms), -1)
        row[alive] = np.arange(len(alive))
        for i, (places, counts) in enumerate(zip(items.places, items.counts)):
            at = row[places]
            on = at >= 0
            if on.any():
                weight = (items.weights[places[on]] * counts[on]).astype(np.float64)
                out[i] += (weight @ present[at[on]]).astype(np.int64) * step  # sums of integers below 2**53
    return out


def _bounded(shards: DataFrame, items: Items, floors: np.ndarray, top: int, every: bool) -> DataFrame:
    """(item, bound, id, t1, t2): documents whose bound reaches the item's floor; unless ``every``, the ``top`` of a shard.

    Of documents of a shard with equal texts only the first ``top`` go on.
    """
    kind = shards.schema["id"].dataType.elementType.simpleString()

    def bound(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                n, ids, one, two = (batch.column(c)[i].values for c in ("n", "id", "t1", "t2"))
                n, t1, t2 = n.to_numpy(), one.to_numpy(), two.to_numpy()
                bits = np.frombuffer(batch.column("bits")[i].as_buffer(), dtype=np.uint8).reshape(-1, (len(n) + 7) // 8)
                bounds = upper_bounds(items, bits, n)
                rank = _copies(ids, t1, t2)
                item, document = np.nonzero((bounds >= np.maximum(1, floors)[:, None]) & (rank < top))
                if not every:
                    order = np.lexsort((-bounds[item, document], item))
                    item, document = item[order], document[order]
                    place = np.arange(len(item)) - np.searchsorted(item, item)
                    item, document = item[place < top], document[place < top]
                arrays = [pa.array(item, pa.int32()), pa.array(bounds[item, document]), ids.take(pa.array(document)), pa.array(t1[document]), pa.array(t2[document])]
                yield pa.RecordBatch.from_arrays(arrays, ["item", "bound", *_KEYS])

    return shards.mapInArrow(bound, f"item int, bound long, id {kind}, t1 long, t2 long")


def _copies(ids: pa.Array, t1: np.ndarray, t2: np.ndarray) -> np.ndarray:
    """The rank of each document by id, ids that are null last, among those of a shard with its text."""
    order = pc.sort_indices(ids, null_placement="at_end").to_numpy().astype(np.int64)
    order = order[np.lexsort((t2[order], t1[order]))]
    new = np.concatenate([[True], (np.diff(t1[order]) != 0) | (np.diff(t2[order]) != 0)])
    out = np.empty(len(order), dtype=np.int64)
    out[order] = np.arange(len(order)) - np.flatnonzero(new)[np.cumsum(new) - 1]
    return out


def _scored(docs: DataFrame, wanted: DataFrame, items: Items) -> DataFrame:
    """(item, score, id) of each row of ``docs`` that is wanted by an item, from its text."""
    asked = wanted.groupBy(*_KEYS).agg(F.collect_set("item").alias("items"))  # at most the items of a block
    same = [docs[c].eqNullSafe(asked[c]) for c in _KEYS]
    kind = docs.schema["id"].dataType.simpleString()

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, asked_by = batch.column("id"), batch.column("items")
            rows, found, scores = [], [], []
            for b in blocks(batch.column("text"), "alnum", True):
                text, term, n = bag(b)
                bounds = np.searchsorted(text, np.arange(b.n_texts + 1))
                m = items.spread(np.diff(b.word_bounds))
                for t in range(b.n_texts):
                    own = slice(bounds[t], bounds[t + 1])
                    occurs = np.zeros(len(items.terms), dtype=np.int64)
                    at = np.minimum(np.searchsorted(items.terms, term[own]), max(len(items.terms) - 1, 0))
                    known = items.terms[at] == term[own]
                    occurs[at[known]] = n[own][known]
                    gains = items.weights * gain(occurs, m[t])
                    for i in asked_by[b.first + t].as_py():
                        rows.append(b.first + t)
                        found.append(i)
                        scores.append(int((gains[items.places[i]] * items.counts[i]).sum()))
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), pa.array(scores, pa.int64()), ids.take(pa.array(rows, pa.int64()))], ["item", "score", "id"])

    return docs.join(asked, same).select(docs["id"], "text", "items").mapInArrow(score, f"item int, score long, id {kind}")


def _ranked(scored: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return scored.where("score > 0").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def item_terms(items: DataFrame) -> DataFrame:
    """(item, term, n) of rows (item, text)."""

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column("item")
            for b in blocks(batch.column("text"), "alnum", True):
                text, term, n = bag(b)
                yield pa.RecordBatch.from_arrays([names.take(pa.array(b.first + text)), pa.array(term.view(np.int64)), pa.array(n, pa.int64())], ["item", "term", "n"])

    return items.mapInArrow(cut, "item struct<block:int,place:int>, term long, n long")


def weight(n_docs: int, holders: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * holders + 1)))


def _block(rows: list, n_items: int, n_docs: int, n_words: int) -> Items:
    """From rows (place of the item, term, n, holders)."""
    by_term = {r.term: r.holders for r in rows}
    terms = np.sort(np.array(list(by_term), dtype=np.int64).view(np.uint64))
    weights = np.array([weight(n_docs, by_term[int(t)]) for t in terms.view(np.int64)], dtype=np.int64)
    places: list[list[int]] = [[] for _ in range(n_items)]
    counts: list[list[int]] = [[] for _ in range(n_items)]
    at = np.searchsorted(terms, np.array([r.term for r in rows], dtype=np.int64).view(np.uint64))
    for r, place in zip(rows, at.tolist()):
        if weights[place] > 0:
            places[r.place].append(place)
            counts[r.place].append(r.n)
    return Items(terms, weights, [np.array(p, dtype=np.int64) for p in places], [np.array(c, dtype=np.int64) for c in counts], n_docs, n_words)


def _carried(df: DataFrame) -> DataFrame:
    df = settled(df)
    return F.broadcast(df) if df.count() <= CARRIED else df


def search(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", top: int = TOP
) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` documents of each item by score, with a score above 0.

    Terms are runs of ASCII letters and digits and of all beyond ASCII, A to Z as a to z. Terms are
    told apart by 64-bit hashes. Ties are in order of the document's id, null last. Each row of ``docs``
    is a document, so repeated rows are ranked each; a null or empty text has no terms and counts
    nowhere. Items of equal id and text are one item; items without terms, or of terms that no
    document or every document holds, have no rows. Other columns are ignored; ids may be of any
    type that can be ordered.
    """
    spark = docs.sparkSession
    named = with_text_hashes(docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text")), F.col("text"))
    built = settled(index(named))
    shards = built.where("bits is not null").select("bits", "n", *_KEYS)
    holders = built.where("terms is not null").select(F.explode(F.arrays_zip("terms", "holders")).alias("x"))
    lexicon = holders.groupBy(F.col("x.terms").alias("term")).agg(F.sum("x.holders").alias("holders"))
    total = shards.agg(F.sum(F.size("n")).alias("docs"), F.expr("sum(aggregate(n, 0L, (a, x) -> a + x))").alias("words")).first()
    asked = items.select(F.col(item_col).alias("item_id"), text_of(item_text).alias("text")).distinct()
    n_blocks = max(1, -(-asked.count() // ITEMS))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)).cast("int"))
    asked = settled(asked.withColumn("place", (F.row_number().over(Window.partitionBy("block").orderBy("item_id", "text")) - 1).cast("int")))
    item = F.struct("block", "place").alias("item")
    terms = settled(item_terms(asked.select(item, "text")).join(lexicon, "term"))  # a term of no document adds nothing
    out = None
    for k, n_items in sorted(tuple(r) for r in asked.groupBy("block").count().collect()) if total.docs else ():
        rows = terms.where(F.col("item.block") == k).select("item.place", "term", "n", "holders").collect()
        block = _block(rows, n_items, total.docs, total.words)
        best = Window.partitionBy("item").orderBy(F.desc("bound"), F.asc_nulls_last("id"), "t1", "t2")
        highest = _bounded(shards, block, np.zeros(n_items), top, False).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
        first = _ranked(_scored(named, _carried(highest.select("item", *_KEYS)), block), top).where(F.col("rank") == top)
        floors = np.zeros(n_items, dtype=np.int64)
        for r in first.select("item", "score").collect():  # at most one row an item
            floors[r["item"]] = r["score"]
        copies = Window.partitionBy("item", "t1", "t2").orderBy(F.asc_nulls_last("id"))
        rest = _bounded(shards, block, floors, top, True).withColumn("copy", F.row_number().over(copies)).where(F.col("copy") <= top)
        ranked = _ranked(_scored(named, _carried(rest.select("item", *_KEYS)), block), top)
        ranked = ranked.select(F.lit(k).alias("block"), F.col("item").alias("place"), "rank", "id", "score")
        out = ranked if out is None else out.union(ranked)
    if out is None:
        kinds = [df.schema[c].dataType.simpleString() for df, c in ((items, item_col), (docs, id_col))]
        return spark.createDataFrame([], f"item_id {kinds[0]}, rank int, doc_id {kinds[1]}, score long")
    out = out.join(asked, ["block", "place"])
    return out.select("item_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("doc_id"), "score")
