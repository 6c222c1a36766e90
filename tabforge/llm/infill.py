"""Fill-in-the-middle transformation: texts cut at code points, their parts put in another order.

A text is cut twice, at numbers of code points that hashes of its id give. The cuts are found on
the UTF-8 bytes, 8 at a time, without decoding. The bytes of many texts are viewed as 64-bit
words. Shifts and masks leave a 1 in each byte that is the last of a code point (``unit_ends``);
``bitwise_count`` of each word and a running sum over the words give ranks. The k-th code point
is then looked up in two steps (``Units.select``): a binary search in the running sum for the word
that holds it, and a select inside that word, where one multiplication gives the running sums
of its 8 bytes and one subtraction compares all of them.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tabforge.llm.tables import text_of
from tabforge.llm.words import texts_of

#: Marks of prefix, suffix and middle.
SENTINELS = ("<P>", "<S>", "<M>")
#: Texts in hundred that are transformed, and of those the ones whose suffix comes first.
RATE, SUFFIX_FIRST = 90, 20
#: Bytes of text that are indexed at a time; one longer text is a block of its own.
BLOCK_BYTES = 4_000_000

PLAIN, PSM, SPM = "plain", "psm", "spm"

_ONES = np.uint64(0x0101010101010101)
_HIGH = np.uint64(0x8080808080808080)


def unit_ends(data: np.ndarray) -> np.ndarray:
    """UTF-8 bytes as words of 8, the first byte lowest: 1 in a byte that ends a code point, 0 in others.

    A byte 10xxxxxx goes on with a code point, so a byte ends one if the next is no such byte. What
    follows the data counts as ends; there is at least one word of it.
    """
    padded = np.zeros((len(data) // 8 + 2) * 8, dtype=np.uint8)
    padded[: len(data)] = data
    words = padded.view("<u8")
    starts = ((words >> np.uint64(7)) & ~(words >> np.uint64(6)) & _ONES) ^ _ONES
    return (starts[:-1] >> np.uint64(8)) | (starts[1:] << np.uint64(56))


class Units:
    """Rank and select over the code points of a byte array."""

    def __init__(self, data: np.ndarray):
        self.ends = unit_ends(data)
        self.before = np.zeros(len(self.ends) + 1, dtype=np.int64)
        np.cumsum(np.bitwise_count(self.ends), out=self.before[1:])

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Code points that end before each byte position."""
        word, byte = at >> 3, (at & 7).astype(np.uint64)
        below = (np.uint64(1) << (byte * np.uint64(8))) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.ends[word] & below)

    def select(self, k: np.ndarray) -> np.ndarray:
        """The byte position behind the k-th code point, 0 for k = 0."""
        word = np.maximum(np.searchsorted(self.before, k, side="left") - 1, 0)
        left = (k - self.before[word]).astype(np.uint64)
        running = self.ends[word] * _ONES  # byte i: ends in the bytes 0 to i
        reached = ((running | _HIGH) - left * _ONES) & _HIGH
        return np.where(k > 0, word * 8 + 9 - np.bitwise_count(reached).astype(np.int64), 0)


def _blocks(bounds: np.ndarray) -> Iterator[tuple[int, int]]:
    first, n = 0, len(bounds) - 1
    while first < n:
        last = max(int(np.searchsorted(bounds, bounds[first] + BLOCK_BYTES, side="right")) - 1, first + 1)
        yield first, min(last, n)
        first = last


def cut_texts(column: pa.Array, x: np.ndarray, y: np.ndarray) -> Iterator[tuple[int, int, int, bytes, bytes, bytes]]:
    """(n, prefix_chars, middle_chars, prefix, middle, suffix) of each text; its cuts are at x and y modulo n + 1."""
    data, bounds = texts_of(column)
    for first, last in _blocks(bounds):
        own = bounds[first : last + 1] - bounds[first]
        part = data[bounds[first] : bounds[last]]
        units = Units(part)
        base = units.rank(own)
        n = np.diff(base)
        one, two = x[first:last] % (n + 1), y[first:last] % (n + 1)
        lo, hi = np.minimum(one, two), np.maximum(one, two)
        a, b = units.select(base[:-1] + lo), units.select(base[:-1] + hi)
        raw = part.tobytes()
        for t in range(last - first):
            yield int(n[t]), int(lo[t]), int(hi[t] - lo[t]), raw[own[t] : a[t]], raw[a[t] : b[t]], raw[b[t] : own[t + 1]]


def _number(digest: Column, group: int) -> Column:
    return F.conv(F.substring(digest, 8 * group + 1, 8), 16, 10).cast("long")


def fill_in_middle(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    epoch: int = 1,
    rate: int = RATE,
    suffix_first: int = SUFFIX_FIRST,
    sentinels: Sequence[str] = SENTINELS,
) -> DataFrame:
    """``df`` with ``fim``: struct of n, form, prefix_chars, middle_chars and output.

    Cuts and form depend on the id and ``epoch`` alone, so each epoch cuts anew and a rerun gives
    equal rows. Form is plain for empty texts, texts that hold a sentinel and those not drawn by
    ``rate``; the output is the text then, and prefix_chars and middle_chars are null. Both parts and
    the middle may be empty. Null texts are empty, a null id is drawn as an empty one; rows that
    share an id are cut by the same numbers. Every row is cut by itself; other columns stay, one
    named ``fim`` is replaced.
    """
    p, s, m = (mark.encode() for mark in sentinels)

    @F.arrow_udf("struct<n:bigint,prefix_chars:bigint,middle_chars:bigint,output:string>")
    def transform(texts: pa.Array, x: pa.Array, y: pa.Array, forms: pa.Array) -> pa.Array:
        n, prefixes, middles, out = [], [], [], []
        parts = cut_texts(texts, x.to_numpy(zero_copy_only=False), y.to_numpy(zero_copy_only=False))
        for form, (size, lo, mid, prefix, middle, suffix) in zip(forms.to_pylist(), parts):
            n.append(size)
            prefixes.append(None if form == PLAIN else lo)
            middles.append(None if form == PLAIN else mid)
            if form == PLAIN:
                out.append(prefix + middle + suffix)
            else:
                out.append(b"".join((p, prefix, s, suffix, m, middle) if form == PSM else (s, suffix, p, prefix, m, middle)))
        arrays = [pa.array(n, pa.int64()), pa.array(prefixes, pa.int64()), pa.array(middles, pa.int64()), pa.array(out, pa.string())]
        return pa.StructArray.from_arrays(arrays, ["n", "prefix_chars", "middle_chars", "output"])

    text = text_of(text_col)
    digest = F.sha2(F.concat(F.lit(f"{epoch}:"), text_of(id_col)), 256)
    holds = F.lit(False)
    for mark in sentinels:
        holds = holds | F.contains(text, F.lit(mark))
    plain = (text == "") | holds | (_number(digest, 2) % 100 >= rate)
    form = F.when(plain, PLAIN).when(_number(digest, 3) % 100 < suffix_first, SPM).otherwise(PSM)
    made = transform(text, _number(digest, 0), _number(digest, 1), form)
    out = df.withColumn("fim", F.struct(form.alias("form"), made.alias("made")))
    fields = [F.col("fim.made")["n"].alias("n"), F.col("fim.form").alias("form")]
    fields += [F.col("fim.made")[c].alias(c) for c in ("prefix_chars", "middle_chars", "output")]
    return out.withColumn("fim", F.struct(*fields))


def restored(output: Column, form: Column, sentinels: Sequence[str] = SENTINELS) -> Column:
    """The text behind an output of ``fill_in_middle`` with the same sentinels.

    A transformed text holds no sentinel, so the first occurrence of each behind the one before it
    is the mark. That needs sentinels of which no end of one begins another, as in ``<X>``.
    """

    def parts(first: str, second: str, third: str) -> tuple[Column, Column, Column]:
        rest = F.substr(output, F.lit(len(first) + 1))
        one = F.substring_index(rest, second, 1)
        tail = F.substr(rest, F.length(one) + len(second) + 1)
        two = F.substring_index(tail, third, 1)
        return one, two, F.substr(tail, F.length(two) + len(third) + 1)

    p, s, m = sentinels
    prefix, suffix, middle = parts(p, s, m)
    psm = F.concat(prefix, middle, suffix)
    suffix, prefix, middle = parts(s, p, m)
    return F.when(form == PSM, psm).when(form == SPM, F.concat(prefix, middle, suffix)).otherwise(output)
