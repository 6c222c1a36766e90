"""Substring dedup by seed and extend.

A window is ``min_words`` consecutive words of one document. A word goes if a window covers it
whose words also start earlier: in a document of smaller id, or further up in the same one.

Seeds are winnowed anchors: of the ``seed_words``-word grams in a window the one of least hash.
Equal windows choose equal anchors, so all repeats of a window meet at its anchor. Neighbouring
windows that choose the same anchor form one segment: the anchor, extended to both sides as far
as its windows reach. Repeats are then settled in three steps of linear size.

0. Anchors are counted; those of one place only are out. A bitmap of the hashes that stand at
   several places, of at most ``BITMAP_BITS``, spares most other segments the shuffle. It lets some
   through that stand once, never the reverse, and the next steps are exact by themselves.
1. Segments of equal words are grouped (with partial sums, so thousands of copies are one row a
   task); all but the earliest are repeats as a whole.
2. Where one anchor stands in different segments, the earliest segment of each wording is cut
   into its windows, and those are grouped in the same way: the exact check of what is shared.

Repeats that touch or overlap merge into maximal ones. No pairs of documents are listed.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tabforge.llm.tables import id_of, keyed, settled
from tabforge.llm.words import Block, blocks

MIN_WORDS = 20
SEED_WORDS = 5
#: Bits of the anchor bitmap at most: 32 for each repeated anchor, up to 32 MB.
BITMAP_BITS = 2**28


def _first_least(values: np.ndarray, width: int) -> np.ndarray:
    """For each window of ``width`` values the place of the least, the first among equals."""
    least, at, size = values, np.arange(len(values)), 1
    while size < width:
        step = min(size, width - size)
        later = least[step:] < least[:-step]
        least, at = np.where(later, least[step:], least[:-step]), np.where(later, at[step:], at[:-step])
        size += step
    return at


def _anchors(block: Block, min_words: int, seed_words: int) -> tuple[np.ndarray, ...]:
    """Segments of a block: anchor hash, first word, number of windows."""
    windows = block.windows(min_words)
    if not len(windows):
        return windows.astype(np.uint64), windows, windows
    first = np.arange(block.n_words - seed_words + 1)
    grams = block.ranges(first, first + seed_words)
    best = _first_least(grams, min_words - seed_words + 1)[windows]
    new = np.flatnonzero(np.concatenate([[True], (best[1:] != best[:-1]) | (windows[1:] != windows[:-1] + 1)]))
    return grams[best[new]], windows[new], np.diff(np.append(new, len(windows)))


def repeated_anchors(docs: DataFrame, min_words: int, seed_words: int) -> np.ndarray:
    """A bitmap over anchor hashes, as bytes: set where an anchor stands at several places."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in blocks(batch.column("text"), "space"):
                anchor, n = np.unique(_anchors(b, min_words, seed_words)[0], return_counts=True)
                yield pa.RecordBatch.from_pydict({"anchor": anchor.view(np.int64), "n": n})

    counted = docs.select("text").mapInArrow(count, "anchor long, n long").groupBy("anchor").agg(F.sum("n").alias("n"))
    repeated = settled(counted.where("n > 1").select("anchor"))
    bits = min(max(2**15, 1 << (32 * repeated.count()).bit_length()), BITMAP_BITS)
    bit = F.pmod("anchor", F.lit(bits))
    parts = repeated.select(bit.alias("bit")).groupBy(F.shiftright("bit", 15).alias("part")).agg(F.bitmap_construct_agg(F.col("bit") % 2**15).alias("map"))
    out = np.zeros(bits // 8, dtype=np.uint8)
    for row in parts.toLocalIterator():  # at most BITMAP_BITS in all
        out[row["part"] * 4096 : (row["part"] + 1) * 4096] = np.frombuffer(row["map"], dtype=np.uint8)
    return out


def segments(docs: DataFrame, min_words: int, seed_words: int, bitmap: np.ndarray) -> DataFrame:
    """(anchor, context, key, lo, n): windows lo .. lo+n-1 of a document share an anchor.

    Segments whose anchor is not in the bitmap are left out.
    """
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            keys = batch.column("key").to_numpy()
            for b in blocks(batch.column("text"), "space"):
                anchor, lo, n = _anchors(b, min_words, seed_words)
                bit = anchor & np.uint64(8 * len(known) - 1)
                on = (known[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 == 1
                anchor, lo, n = anchor[on], lo[on], n[on]
                text = b.text_of_word[lo]
                yield pa.RecordBatch.from_pydict(
                    {
                        "anchor": anchor.view(np.int64),
                        "context": b.ranges(lo, lo + n + min_words - 1).view(np.int64) if len(lo) else lo,
                        "key": keys[b.first + text],
                        "lo": (lo - b.word_bounds[text]).astype(np.int32),
                        "n": n.astype(np.int32),
                    }
                )

    return docs.mapInArrow(cut, "anchor long, context long, key long, lo int, n int")


def _windows(docs: DataFrame, min_words: int) -> DataFrame:
    """(window, key, start) of the segments listed in column ``parts`` of each document."""

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("key").to_numpy()
            parts = batch.column("parts")
            bounds = np.concatenate([[0], np.cumsum(parts.value_lengths().to_numpy())])
            lo, n = (parts.flatten().field(k).to_numpy() for k in range(2))
            for b in blocks(batch.column("text"), "space"):
                own = slice(bounds[b.first], bounds[b.first + b.n_texts])
                text = np.repeat(np.arange(b.n_texts), np.diff(bounds[b.first : b.first + b.n_texts + 1]))
                text, start = np.repeat(text, n[own]), np.repeat(lo[own], n[own])
                start = start + np.arange(len(start)) - np.repeat(np.cumsum(n[own]) - n[own], n[own])
                at = b.word_bounds[text] + start
                fits = at + min_words <= b.word_bounds[text + 1]
                at, start, text = at[fits], start[fits], text[fits]
                yield pa.RecordBatch.from_pydict(
                    {"window": b.ranges(at, at + min_words).view(np.int64), "key": keys[b.first + text], "start": start.astype(np.int32)}
                )

    return docs.mapInArrow(cut, "window long, key long, start int")


def repeats(docs: DataFrame, min_words: int = MIN_WORDS, seed_words: int = SEED_WORDS) -> DataFrame:
    """(key, lo, hi): word ranges of ``keyed`` documents that also start earlier; they may overlap.

    Earliest places are tables of their own, so that the joins with them are plain shuffles on
    both sides and Spark can split a wording or window with very many places.
    """
    seeds = segments(docs, min_words, seed_words, repeated_anchors(docs, min_words, seed_words))
    wordings = seeds.groupBy("anchor", "context").agg(F.min(F.struct("key", "lo", "n")).alias("first"), F.count("*").alias("copies"))
    wordings = settled(wordings)
    contested = wordings.groupBy("anchor").agg(F.count("*").alias("wordings")).where("wordings > 1")
    parts = wordings.join(contested, "anchor", "left_semi").groupBy("first.key").agg(F.collect_list(F.struct("first.lo", "first.n")).alias("parts"))
    single = settled(_windows(docs.join(parts, "key"), min_words))
    earliest = single.groupBy("window").agg(F.min(F.struct("key", "start")).alias("first"), F.count("*").alias("places")).where("places > 1")
    earliest = settled(earliest.select("window", "first"))
    whole = (
        seeds.join(wordings.where("copies > 1").select("anchor", "context", "first"), ["anchor", "context"])
        .where("struct(key, lo) > struct(first.key, first.lo)")
        .select("key", "lo", (F.col("lo") + F.col("n") + (min_words - 1)).alias("hi"))
    )
    later = (
        single.join(earliest, "window").where("struct(key, start) > first").select("key", F.col("start").alias("lo"), (F.col("start") + min_words).alias("hi"))
    )
    return whole.union(later)


def remove_repeats(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS, seed_words: int = SEED_WORDS
) -> DataFrame:
    """(doc_id, n_words, n_removed, spans, kept): each document without what stands earlier.

    ``spans`` are the maximal removed word ranges [lo, hi), ``kept`` the other words joined by
    one space. Words are runs of anything but ASCII white space. A null or empty text has no
    words, one of fewer than ``min_words`` has no window and stays. Rows that share an id are one
    document; a repeated row is no earlier place and gives an equal result row. Rows without an
    id count as earlier than all others. Other columns are ignored.
    """
    docs = keyed(df, id_col, text_col)
    spans = repeats(docs, min_words, seed_words).groupBy("key").agg(F.collect_list(F.struct("lo", "hi")).alias("found"))

    def drop(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, found in zip(batch.column("text").cast(pa.binary()), batch.column("found")):
                words = (text.as_py() or b"").split()  # of bytes: at ASCII white space
                merged: list[list[int]] = []
                for part in sorted((x["lo"], x["hi"]) for x in found.as_py() or ()):
                    lo, hi = part[0], min(part[1], len(words))
                    if merged and lo <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], hi)
                    elif lo < hi:
                        merged.append([lo, hi])
                kept, at = [], 0
                for lo, hi in merged:
                    kept += words[at:lo]
                    at = hi
                kept += words[at:]
                rows.append((len(words), len(words) - len(kept), [{"lo": a, "hi": z} for a, z in merged], b" ".join(kept).decode()))
            n_words, n_removed, ranges, kept = zip(*rows) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key"),
                    pa.array(n_words, pa.int64()),
                    pa.array(n_removed, pa.int64()),
                    pa.array(ranges, pa.list_(pa.struct([("lo", pa.int32()), ("hi", pa.int32())]))),
                    pa.array(kept, pa.string()),
                ],
                ["key", "n_words", "n_removed", "spans", "kept"],
            )

    out = docs.join(spans, "key", "left").mapInArrow(drop, "key long, n_words long, n_removed long, spans array<struct<lo:int,hi:int>>, kept string")
    return out.select(id_of("key").alias("doc_id"), "n_words", "n_removed", "spans", "kept")
