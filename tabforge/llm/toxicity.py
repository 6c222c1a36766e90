"""Toxic passages by maximum-scoring segments.

Lexicon. In the labelled training documents each word, and the first 4, 6 and 8 bytes of longer
ones, is counted by the documents that hold it, toxic and all. The share of toxic ones is
estimated down that chain: each level takes the level above as the mean of its Dirichlet prior,
the first the share over all documents. So a rare word leans on words that begin alike.

Segments. A word weighs the log-odds of its share against the overall share, less a drift that
makes ordinary text negative. One linear scan (Ruzzo and Tompa) finds all maximal segments.

Extreme values. In ordinary text the best segment of n words follows a Gumbel law:
P(S >= s) = 1 - exp(-K n exp(-lambda s)). lambda solves E[exp(lambda weight)] = 1 over the words
of non-toxic documents, K is fitted to their best segments. Segments expected less than once in
a document are passages; the score is a logistic curve over the two surprises, of the best
segment and of all passages together, fitted on the training documents. While the law and the curve are
fitted, a training document's own counts are taken out of the lexicon first, so it counts like one not seen.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tabforge.llm.tables import in_batches, settled, sized_broadcast, text_of
from tabforge.llm.words import SMALL_BLOCK_BYTES, Block, blocks, mix
from tabforge.session import scratch_path

PREFIX_BYTES = (4, 6, 8)
PRIOR = 2.0
DRIFT = 0.75
#: Words and word beginnings of a lexicon that is broadcast to the workers (24 bytes each); a larger one
#: is a table that the words of blocks of rows are joined with. No entry is left out.
LEXICON = 1_000_000
#: Rows of such a block, about.
BLOCK_ROWS = 2048
#: Bits of a bitmap of that table's entries at most: 32 for each, up to 32 MB; a fuller one spares fewer words the shuffle.
BITMAP_BITS = 2**28
LEAST_DOCUMENTS = 2
#: Labelled rows that are broadcast at most; more meet the documents in a shuffle.
BROADCAST_LABELS = 1_000_000
THRESHOLD = 0.3

_BINS, _BIN = 256, 0.0625
_SCAN = "struct<n:int,segments:array<struct<lo:int,hi:int,score:double>>,histogram:array<int>>"


@dataclass
class Lexicon:
    """Hashes in order with the number of documents and of toxic ones; documents overall."""

    hashes: np.ndarray
    documents: np.ndarray
    toxic: np.ndarray
    n: int
    n_toxic: int

    def weights(self, levels: list[np.ndarray], own: int | None) -> np.ndarray:
        """Weight of each word, given the hashes of its levels (0: none). ``own`` is the label of
        the document whose counts are left out, None for documents not in the lexicon."""
        out = 0 if own is None else 1
        base = (self.n_toxic - (own or 0) + 0.5) / (self.n - out + 1.0)
        share = np.full(len(levels[0]), base)
        for level in levels:
            at = np.searchsorted(self.hashes, level)
            at[at == len(self.hashes)] = 0
            known = (self.hashes[at] == level) & (level != 0) if len(self.hashes) else np.zeros(len(level), dtype=bool)
            documents, toxic = self.documents[at[known]] - out, self.toxic[at[known]] - (own or 0)
            share[known] = (toxic + PRIOR * share[known]) / (documents + PRIOR)
        share = np.clip(share, 1e-6, 1 - 1e-6)
        return np.log(share / (1 - share)) - math.log(base / (1 - base)) - DRIFT


@dataclass
class LexiconTable:
    """A lexicon that is too large to carry: (hash, documents, toxic) as a table."""

    table: DataFrame
    n: int
    n_toxic: int


def _sorted(entries: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    hashes = entries.column("hash").to_numpy().view(np.uint64)
    order = np.argsort(hashes)
    return hashes[order], entries.column("documents").to_numpy()[order], entries.column("toxic").to_numpy()[order]


def _levels(block: Block) -> tuple[np.ndarray, list[np.ndarray]]:
    """Which different word each word is, and the hashes of their levels, from general to special."""
    different, first, which = np.unique(block.hashes, return_index=True, return_inverse=True)
    starts, sizes = block.starts[first], (block.ends - block.starts)[first]
    levels = []
    for n in PREFIX_BYTES:
        head = np.zeros(len(first), dtype=np.uint64)
        for k in range(n):
            head = head * np.uint64(257) + block.data[np.minimum(starts + k, len(block.data) - 1)] + np.uint64(1)
        levels.append(np.where(sizes > n, mix(head + np.uint64(n << 56)) | np.uint64(1), np.uint64(0)))
    return which, [*levels, different | np.uint64(1)]


def maximal_segments(at: np.ndarray, weight: np.ndarray, before: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal segments (lo, hi, score), hi excluded, of one text in one scan.

    ``at`` are the words of positive weight, ``before`` the sum of all weights in front of each.
    """
    stack: list[tuple[float, float, int, int, int]] = []  # sums left and right, lo, hi, last with a smaller left sum
    for i, w, left in zip(at.tolist(), weight.tolist(), before.tolist()):
        right, lo = left + w, i
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][0] >= left:
                j = stack[j][4]
            if j < 0 or stack[j][1] >= right:
                stack.append((left, right, lo, i + 1, j))
                break
            left, lo = stack[j][0], stack[j][2]
            del stack[j:]
    return [(lo, hi, right - left) for left, right, lo, hi, _ in stack]


def _counts(labelled: DataFrame) -> DataFrame:
    """(hash, documents, toxic) of words and word beginnings."""

    def count(batches):
        for batch in batches:
            labels = batch.column("toxic").to_numpy()
            for b in blocks(batch.column("text"), "letter", most=SMALL_BLOCK_BYTES):
                if not b.n_words:
                    continue
                which, levels = _levels(b)
                pairs = np.unique(b.text_of_word.astype(np.int64) * len(levels[0]) + which)
                text, word = pairs // len(levels[0]), pairs % len(levels[0])
                own = [(text[level[word] != 0], level[word][level[word] != 0]) for level in levels]
                text, hashes = (np.concatenate(x) for x in zip(*own))
                order = np.lexsort((text, hashes))
                text, hashes = text[order], hashes[order]
                new = np.concatenate([[True], (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])])
                text, hashes = text[new], hashes[new]
                first = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]]))
                toxic = labels[b.first + text].astype(np.int64)
                yield pa.RecordBatch.from_pydict(
                    {"hash": hashes[first].view(np.int64), "documents": np.diff(np.append(first, len(hashes))), "toxic": np.add.reduceat(toxic, first)}
                )

    return in_batches(labelled.select("text", "toxic")).mapInArrow(count, "hash long, documents long, toxic long")


def learn_lexicon(labelled: DataFrame, size: int = LEXICON) -> Lexicon | LexiconTable:
    """The lexicon of documents (text, toxic); a table if it has more than ``size`` entries."""
    totals = labelled.agg(F.count("*").alias("n"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("t")).first()
    counted = _counts(labelled).groupBy("hash").agg(F.sum("documents").alias("documents"), F.sum("toxic").alias("toxic"))
    counted = settled(counted.where(F.col("documents") >= LEAST_DOCUMENTS))
    if counted.count() > size:
        return LexiconTable(counted, totals["n"], totals["t"])
    return Lexicon(*_sorted(counted.toArrow()), totals["n"], totals["t"])


def _scan(texts: pa.Array, labels: pa.Array | None, lexicon: Lexicon) -> pa.Array:
    """Struct of n words, maximal segments, and a histogram of weights (in the first row of a
    block, for the words of its non-toxic rows). ``labels``: where the rows are in the lexicon."""
    label = labels.to_numpy() if labels is not None else np.zeros(len(texts), dtype=int)
    rows = []
    for b in blocks(texts, "letter", most=SMALL_BLOCK_BYTES):
        mine = label[b.first : b.first + b.n_texts]
        n = np.diff(b.word_bounds)
        if b.n_words:
            which, levels = _levels(b)
            if labels is None:
                weight = lexicon.weights(levels, None)[which]
            else:
                weight = np.where(mine[b.text_of_word] == 1, lexicon.weights(levels, 1)[which], lexicon.weights(levels, 0)[which])
            total = np.concatenate([[0.0], np.cumsum(weight)])
            positive = np.flatnonzero(weight > 0)
            bounds = np.searchsorted(positive, b.word_bounds)
            ordinary = weight[mine[b.text_of_word] == 0] if labels is not None else weight[:0]
            bins = np.clip((ordinary / _BIN).astype(int) + _BINS // 2, 0, _BINS - 1)
            histogram = np.bincount(bins, minlength=_BINS).tolist() if labels is not None else []
        for t in range(b.n_texts):
            segments = []
            if n[t] and bounds[t] < bounds[t + 1]:
                at = positive[bounds[t] : bounds[t + 1]]
                first = b.word_bounds[t]
                segments = [{"lo": lo, "hi": hi, "score": s} for lo, hi, s in maximal_segments(at - first, weight[at], total[at] - total[first])]
            rows.append({"n": int(n[t]), "segments": segments, "histogram": histogram if b.n_words and t == 0 else []})
    kind = pa.struct(
        [
            ("n", pa.int32()),
            ("segments", pa.list_(pa.struct([("lo", pa.int32()), ("hi", pa.int32()), ("score", pa.float64())]))),
            ("histogram", pa.list_(pa.int32())),
        ]
    )
    return pa.array(rows, kind)


def scanned(df: DataFrame, out: str, text_col: str, lexicon: Lexicon | LexiconTable, own: str | None = None) -> DataFrame:
    """``df`` with a column ``out`` of ``_scan``. ``own``: the label's column, where the rows are in the lexicon."""
    if isinstance(lexicon, LexiconTable):
        return _scanned_by_blocks(df, out, text_col, lexicon, own)
    shared, text = in_batches(df).sparkSession.sparkContext.broadcast(lexicon), F.lower(text_of(text_col))
    if own is None:

        @F.arrow_udf(_SCAN)
        def alone(texts: pa.Array) -> pa.Array:
            return _scan(texts, None, shared.value)

        return df.withColumn(out, alone(text))

    @F.arrow_udf(_SCAN)
    def left_out(texts: pa.Array, labels: pa.Array) -> pa.Array:
        return _scan(texts, labels, shared.value)

    return df.withColumn(out, left_out(text, F.col(own)))


def _bitmap(table: DataFrame) -> np.ndarray:
    """Bytes with a bit for each entry of a lexicon; a few more words than the entries have theirs set."""
    bits = min(max(2**15, 1 << (32 * table.count()).bit_length()), BITMAP_BITS)
    bit = F.pmod("hash", F.lit(bits))
    parts = table.select(bit.alias("bit")).groupBy(F.shiftright("bit", 15).alias("part")).agg(F.bitmap_construct_agg(F.col("bit") % 2**15).alias("map"))
    out = np.zeros(bits // 8, dtype=np.uint8)
    for row in parts.toLocalIterator():  # at most BITMAP_BITS in all
        out[row["part"] * 4096 : (row["part"] + 1) * 4096] = np.frombuffer(row["map"], dtype=np.uint8)
    return out


def _scanned_by_blocks(df: DataFrame, out: str, text_col: str, lexicon: LexiconTable, own: str | None) -> DataFrame:
    """The same, each block of rows with the entries of its own words.

    Rows go to blocks by a hash of all they hold, once: the different words of a block, found behind that shuffle, are
    joined with the table, and what is found meets the block's rows, which stay where they are. Caller columns travel
    in a struct, so none of their names can clash.
    """
    blocks_ = max(1, -(-df.count() // BLOCK_ROWS))
    plain = [f"`{f.name}`" for f in df.schema.fields if isinstance(f.dataType, (T.AtomicType, T.NullType))]
    block = F.pmod(F.xxhash64(*plain), F.lit(blocks_)).cast("int")
    moved = df.select(block.alias("block"), F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")).repartition("block")
    rows = moved.select("block", "row", F.lower(text_of(f"row.`{text_col}`")).alias("text"), (F.col(f"row.`{own}`").cast("int") if own else F.lit(0)).alias("own"))

    shared = df.sparkSession.sparkContext.broadcast(_bitmap(lexicon.table))

    def words(batches):
        bitmap = shared.value
        for batch in batches:
            of = batch.column("block").to_numpy()
            bounds = [0, *(np.flatnonzero(of[1:] != of[:-1]) + 1), len(of)] if len(of) else []
            for lo, hi in zip(bounds, bounds[1:]):
                own = [np.unique(np.concatenate(_levels(b)[1])) for b in blocks(batch.column("text").slice(lo, hi - lo), "letter", most=SMALL_BLOCK_BYTES) if b.n_words]
                if own:
                    hashes = np.unique(np.concatenate(own))
                    bit = hashes & np.uint64(8 * len(bitmap) - 1)
                    held = (bitmap[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 == 1
                    hashes = hashes[held & (hashes != 0)]
                    yield pa.RecordBatch.from_pydict({"block": np.full(len(hashes), of[lo], dtype=np.int32), "hash": hashes.view(np.int64)})

    wanted = in_batches(rows.sortWithinPartitions("block")).mapInArrow(words, "block int, hash long")
    found = wanted.join(lexicon.table, "hash")
    labelled, n, n_toxic = own is not None, lexicon.n, lexicon.n_toxic

    def scan(left: pa.Table, right: pa.Table) -> pa.Table:
        part = Lexicon(*_sorted(right), n, n_toxic)
        texts, labels = (left.column(c).combine_chunks() for c in ("text", "own"))
        return left.select(["row"]).append_column("scan", _scan(texts, labels if labelled else None, part))

    kind = T.StructType([rows.schema["row"], T.StructField("scan", T.DataType.fromDDL(_SCAN))])
    met = rows.groupBy("block").cogroup(found.groupBy("block")).applyInArrow(scan, kind)
    kept = [F.col("scan").alias(out) if c == out else F.col(f"row.`{c}`").alias(c) for c in df.columns]
    return met.select(*kept, *([] if out in df.columns else [F.col("scan").alias(out)]))


def _decay(histogram: list[int]) -> float:
    """lambda: the positive root of E[exp(lambda weight)] = 1."""
    count = np.array(histogram, dtype=float)
    weight = (np.arange(_BINS) - _BINS // 2 + 0.5) * _BIN
    share = count / max(count.sum(), 1)
    lo, hi = 1e-3, 8.0
    for _ in range(60):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if (share * np.exp(np.minimum(mid * weight, 700))).sum() < 1 else (lo, mid)
    return lo


@dataclass
class ToxicityModel:
    """A lexicon, the Gumbel law of ordinary text, and the logistic curve of the score."""

    lexicon: Lexicon | LexiconTable
    decay: float
    log_k: float
    curve: list[float]

    def expected(self, segment: Column, n: Column) -> Column:
        """ln E: the log of how many such segments ordinary text of that length would hold."""
        return F.lit(self.log_k) + F.log(n) - self.decay * segment["score"]

    def surprises(self, scan: Column) -> list[Column]:
        logs = F.transform(scan["segments"], lambda s: self.expected(s, scan["n"]))
        best = F.coalesce(F.array_min(logs), F.lit(20.0))
        passages = F.aggregate(logs, F.lit(0.0), lambda total, e: total + F.greatest(-e, F.lit(0.0)))
        # -ln(1 - exp(-E)), for small E as -ln E
        p = F.when(best < -20, -best).when(best > 3, F.lit(0.0)).otherwise(-F.log(-F.expm1(-F.exp(best))))
        return [F.log1p(F.least(p, F.lit(1e6))), F.log1p(passages)]

    def score(self, df: DataFrame, text_col: str = "text") -> DataFrame:
        """``df`` with ``toxicity``: struct of score and the passages (word positions lo, hi).

        Null and empty texts have no words, no passages and the score of a text without
        surprise. Rows are scored one by one; other columns stay, one named ``toxicity`` is replaced.
        """
        scan = F.col("toxicity")
        first, second = self.surprises(scan)
        linear = self.curve[0] + self.curve[1] * first + self.curve[2] * second
        passages = F.filter(scan["segments"], lambda s: self.expected(s, scan["n"]) < 0)
        found = scanned(df, "toxicity", text_col, self.lexicon)
        return found.withColumn("toxicity", F.struct((1 / (1 + F.exp(-linear))).alias("score"), passages.alias("passages")))


def fit(labelled: DataFrame, size: int = LEXICON) -> ToxicityModel:
    """A model from documents (text, toxic) with other columns; with no toxic or no other document all scores are the prior share."""
    rows = labelled.withColumns({"text": F.lower(text_of("text")), "toxic": F.col("toxic").cast("int")})
    lexicon = learn_lexicon(rows, size)
    if lexicon.n_toxic in (0, lexicon.n):
        share = (lexicon.n_toxic + 0.5) / (lexicon.n + 1)
        return ToxicityModel(lexicon, 1.0, 0.0, [math.log(share / (1 - share)), 0.0, 0.0])
    scans = settled(scanned(rows, "s", "text", lexicon, "toxic").select("toxic", "s"))
    sums = {r["pos"]: r["n"] for r in scans.select(F.posexplode("s.histogram").alias("pos", "n")).groupBy("pos").agg(F.sum("n").alias("n")).collect()}
    decay = _decay([sums.get(k, 0) for k in range(_BINS)])
    best = F.array_max(F.transform("s.segments", lambda s: s["score"]))
    ordinary = scans.where("toxic = 0 and s.n > 0").select((decay * best - F.log("s.n")).alias("g"))
    model = ToxicityModel(lexicon, decay, (ordinary.agg(F.avg("g")).first()[0] or 0.0) - 0.5772, [0.0, 0.0, 0.0])
    first, second = model.surprises(F.col("s"))
    points = VectorAssembler(inputCols=["x", "y"], outputCol="v").transform(scans.select(F.col("toxic").cast("double").alias("label"), first.alias("x"), second.alias("y")))
    curve = LogisticRegression(featuresCol="v", labelCol="label", regParam=1e-4, maxIter=50).fit(points)
    model.curve = [float(curve.intercept), *map(float, curve.coefficients)]
    return model


def held_out(id_col: str) -> Column:
    """Rows that labels are never learnt from; rows without an id are not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, label: str, id_col: str = "doc_id", text_col: str = "text", broadcast_labels: int = BROADCAST_LABELS) -> DataFrame:
    """(key, text, ``label``) of labelled documents outside the held-out part; of repeated labels the greatest."""
    known = labels.where(F.col(label).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col))
    known = known.groupBy(F.col(id_col).cast("string").alias("key")).agg(F.max(label).alias(label))
    side = sized_broadcast(known, known.count(), broadcast_labels)
    rows = docs.where(~held_out(id_col)).select(F.col(id_col).cast("string").alias("key"), F.col(text_col).alias("text")).join(side, "key").select("key", "text", label)
    if known.count() <= broadcast_labels:
        return rows
    path = scratch_path(docs.sparkSession, "training")  # learners scan the rows several times, the texts are shuffled once
    rows.write.parquet(path)
    return docs.sparkSession.read.parquet(path)


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``toxicity`` (score, passages) and ``predicted`` (1 from the threshold on).

    The model learns from ``labels`` (doc_id, toxic) of training rows only and scores the text alone.
    """
    model = fit(training_rows(docs, labels, "toxic", id_col, text_col))
    return model.score(docs, text_col).withColumn("predicted", (F.col("toxicity.score") >= threshold).cast("int"))
