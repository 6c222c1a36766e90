"""Near-duplicate vectors by spherical-cap filters.

A filter is a direction on the sphere; the vectors whose product with it exceeds a threshold lie in
its cap, and near vectors share most of their caps. Directions are structured random product codes:
space is turned by random signs and Hadamard transforms and cut into blocks, each block has a few
random code words, and a direction is one code word of each block put together. So ``directions``
filters need only ``blocks * directions ** (1 / blocks)`` code words, and all filters that a
vector exceeds are list-decoded block by block, leaving a beginning as soon as the best words of
the blocks to come cannot lift it above the threshold.

1. Equal vectors of a label are one class with a count (partial sums, so thousands of copies are one
   row a task).
2. Each class is decoded to all filters of a code whose product is at least the threshold, which is set so
   that ``LISTED`` are expected; where fewer than ``LEAST`` reach it, it is lowered for that vector.
3. Classes join on (label, filter). Only ids meet at first, so a filter with one class in it costs
   no vector a shuffle; the others are cut into parts of ``PART`` classes by their counted size.
4. Parts, and pairs of parts of one filter, are verified by cosine in double precision, in numpy. A
   pair counts where its first common filter is, so each link counts once. What leaves a task is the
   number of links of each class, and for its component one link to the least class it hangs
   together with there: no pairs are listed.

This is done with ``CODES`` independent codes. A pair of cosine 0.98 meets in about two thirds of
the filters of each, but not independently of each other, as filters share code words: measured for
64 dimensions (tests), a code misses it with 0.3 to 2 in hundred, so all four with about 1e-7 or
less, and nearer pairs far more rarely. In few dimensions small caps would lose more, so there are
no more filters than keep caps wide for the similarity.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tabforge.llm.graph import components
from tabforge.llm.tables import settled

SIMILARITY = 0.98
#: Filters that a vector is expected to exceed, and those it has at least.
LISTED, LEAST = 16, 12
#: Independent codes; filters of each for each class, and code words of a block at most.
CODES, FILTERS_PER_CLASS, WORDS = 4, 16, 256
#: Excess over a threshold, at least, against its change between vectors of the similarity.
SPREAD = 0.8
#: Classes of one part of a filter.
PART = 1024
#: Vectors that are decoded at a time, for 64 code words.
DECODED = 1024
#: Classes of a part that is small, and products of small parts that are held at a time.
SMALL, PRODUCTS = 16, 1_000_000
#: Products this close to the similarity are computed again in a fixed order of additions.
CLOSE = 1e-9


def _signs(size: int, turn: int) -> np.ndarray:
    return np.where(np.random.default_rng([size, turn, 1]).random(size) < 0.5, -1.0, 1.0)


def rotated(vectors: np.ndarray, code: int = 0) -> np.ndarray:
    """Vectors turned at random, padded to a power of two: three times signs and a Hadamard transform."""
    n, own = vectors.shape
    size = 1 << max(own - 1, 0).bit_length()
    out = np.zeros((n, size))
    out[:, :own] = vectors
    for turn in range(3 * code, 3 * code + 3):
        out *= _signs(size, turn)
        half = 1
        while half < size:
            pairs = out.reshape(n, size // (2 * half), 2, half)
            out = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(n, size)
            half *= 2
        out /= np.sqrt(size)
    return out


def code_shape(size: int, directions: int) -> tuple[int, int]:
    """(blocks, words): so many blocks of a vector of ``size`` that a block has few code words."""
    blocks = 1
    while blocks < max(size // 2, 1) and directions > WORDS**blocks:
        blocks += 1
    return blocks, max(2, round(directions ** (1 / blocks)))


def code_words(size: int, blocks: int, words: int, code: int = 0) -> list[np.ndarray]:
    """Words of each block of a code, as columns of length 1 / sqrt(blocks)."""
    rng = np.random.default_rng([size, blocks, words, code, 2])
    out = []
    for part in np.array_split(np.arange(size), blocks):
        own = rng.standard_normal((len(part), words))
        out.append(own / (np.linalg.norm(own, axis=0) * np.sqrt(blocks)))
    return out


def _above(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Products with a fixed direction, ascending, and the share of the sphere that exceeds each."""
    grid = np.linspace(-1, 1, 200_001)
    middle = (grid[1:] + grid[:-1]) / 2
    mass = (1 - middle**2) ** ((size - 3) / 2)
    return middle, np.cumsum(mass[::-1])[::-1] / mass.sum()


def threshold(size: int, share: float) -> float:
    """The product with a fixed direction that a share of the sphere exceeds."""
    product, above = _above(size)
    return float(product[np.argmax(above <= share)])


def most_directions(size: int, similarity: float) -> int:
    """Filters beyond which caps of ``LISTED`` filters a vector are too small for the similarity.

    In a cap above t the mean excess is about (1 - t*t) / (t * size); that of a vector of the
    similarity differs by about sqrt((1 - similarity**2) * (1 - t*t) / size). Their ratio stays above ``SPREAD``.
    """
    most = 1 / np.sqrt(1 + SPREAD**2 * max(1 - similarity**2, 1e-9) * size)
    product, above = _above(size)
    return max(2, int(LISTED / above[np.searchsorted(product, most)]))


def list_decode(vectors: np.ndarray, words: list[np.ndarray], least_product: float, least: int) -> list[np.ndarray]:
    """For each vector (turned, of length 1) all filters with a product of at least ``least_product``.

    Where these are fewer than ``least``, the threshold is lowered for that vector to the product
    of the filter of that rank. Filters are numbers in the base of the block's words, ascending.
    """
    n, base = len(vectors), words[0].shape[1]
    bounds = np.cumsum([0] + [len(w) for w in words])
    products = [vectors[:, a:z] @ w for a, z, w in zip(bounds, bounds[1:], words)]
    rest = np.zeros((len(words) + 1, n))  # the most that blocks from k on can add
    for k in range(len(words) - 1, -1, -1):
        rest[k] = rest[k + 1] + products[k].max(axis=1)
    least = min(least, base ** len(words))
    out: list[np.ndarray] = [np.zeros(0, dtype=np.int64)] * n
    open_rows, floor = np.arange(n), least_product
    while len(open_rows):
        row, number, total = open_rows, np.zeros(len(open_rows), dtype=np.int64), np.zeros(len(open_rows))
        for k, own in enumerate(products):
            sums = total[:, None] + own[row]
            at, word = np.nonzero(sums + rest[k + 1][row][:, None] >= floor)
            row, number, total = row[at], number[at] * base + word, sums[at, word]
        found = np.bincount(row, minlength=n)
        ends = np.cumsum(found)
        enough = open_rows[found[open_rows] >= least]
        for i in enough:
            own = slice(ends[i] - found[i], ends[i])
            out[i] = number[own] if floor == least_product else np.sort(number[own][np.argpartition(-total[own], least - 1)[:least]])
        open_rows = open_rows[found[open_rows] < least]
        floor = floor - 0.05 if floor > -1 else -np.inf
    return out


def _vectors(column: pa.Array) -> np.ndarray:
    """Rows of equal size, in double precision, of length 1."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
    flat = flat / np.abs(flat).max(axis=1, keepdims=True)
    return flat / np.sqrt((flat * flat).sum(axis=1, keepdims=True))


def _decoded(classes: DataFrame, directions: int, similarity: float) -> DataFrame:
    """``classes`` with the filters of each."""
    fields = [f for f in classes.schema.fields]
    shape = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)

    def decode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, tuple[list[list[np.ndarray]], float]] = {}
        for batch in batches:
            column = batch.column("vector")
            sizes = column.value_lengths().to_numpy(zero_copy_only=False)
            filters: list[np.ndarray] = [np.zeros(0, dtype=np.int64)] * len(column)
            for own in np.unique(sizes):
                size = 1 << max(int(own) - 1, 0).bit_length()
                if size not in known:
                    blocks, words = code_shape(size, min(directions, most_directions(size, similarity)))
                    known[size] = [code_words(size, blocks, words, c) for c in range(CODES)], threshold(size, min(1.0, LISTED / words**blocks))
                own_codes, least_product = known[size]
                step = max(1, DECODED * 64 // own_codes[0][0].shape[1])
                rows = np.flatnonzero(sizes == own)
                for lo in range(0, len(rows), step):
                    part = rows[lo : lo + step]
                    unit = _vectors(column.take(pa.array(part)))
                    lists = [list_decode(rotated(unit, c), code, least_product, LEAST) for c, code in enumerate(own_codes)]
                    for i, *found in zip(part, *lists):
                        filters[i] = np.concatenate([f * CODES + c for c, f in enumerate(found)])
            offsets = np.concatenate([[0], np.cumsum([len(f) for f in filters])]).astype(np.int32)
            flat = np.concatenate(filters) if filters else np.zeros(0, dtype=np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], [*batch.schema.names, "filters"])

    return classes.mapInArrow(decode, f"{shape}, filters array<bigint>")


class Part:
    """Classes of one part of a filter: numbers, vectors, counts and the shared filters before it."""

    def __init__(self, rows: pa.StructArray):
        self.node = rows.field("node").to_numpy()
        self.n = rows.field("n").to_numpy().astype(np.float64)
        self.raw = rows.field("vector").flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(rows), -1)
        self.unit = _vectors(rows.field("vector"))
        filters = rows.field("filters")
        self.filters = filters.flatten().to_numpy()
        self.owner = np.repeat(np.arange(len(rows)), filters.value_lengths().to_numpy())


def _again(a: np.ndarray, b: np.ndarray) -> float:
    """Cosine with additions from first to last, vectors scaled by powers of two so that none overflows."""
    a, b = (v / 2.0 ** np.floor(np.log2(np.abs(v).max())) for v in (a, b))
    dot = np.cumsum(a * b)[-1]
    return dot / (np.sqrt(np.cumsum(a * a)[-1]) * np.sqrt(np.cumsum(b * b)[-1]))


def _links(a: Part, b: Part, similarity: float) -> np.ndarray:
    """Which classes of ``a`` and ``b`` are linked and have no common filter before this one."""
    products = a.unit @ b.unit.T
    linked = products >= similarity
    for i, j in zip(*np.nonzero(np.abs(products - similarity) <= CLOSE)):
        linked[i, j] = _again(a.raw[i], b.raw[j]) >= similarity
    if a is b:
        np.fill_diagonal(linked, False)
    rows, columns = np.flatnonzero(linked.any(axis=1)), np.flatnonzero(linked.any(axis=0))
    if not len(rows):
        return linked
    at = []
    for part, of in ((a, rows), (b, columns)):  # filters before this one, of classes with links
        place = np.full(len(part.node), -1)
        place[of] = np.arange(len(of))
        on = place[part.owner] >= 0
        at.append((part.filters[on], place[part.owner[on]], len(of)))
    shared, _, _ = np.intersect1d(at[0][0], at[1][0], return_indices=True)
    if len(shared):
        sides = []
        for filters, place, size in at:
            on = np.isin(filters, shared)
            side = np.zeros((size, len(shared)), dtype=np.float32)
            side[place[on], np.searchsorted(shared, filters[on])] = 1
            sides.append(side)
        linked[np.ix_(rows, columns)] &= sides[0] @ sides[1].T == 0
    return linked


def _roots(linked: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The least number each row and column hangs together with."""
    while True:
        rows = np.minimum(a, np.where(linked, b, a[:, None]).min(axis=1))
        columns = np.minimum(b, np.where(linked, rows[:, None], b).min(axis=0))
        if np.array_equal(rows, a) and np.array_equal(columns, b):
            return rows, columns
        a, b = rows, columns


def _without_links(column: pa.ListArray, similarity: float) -> np.ndarray:
    """Which small parts hold no two vectors near the similarity; many are measured in one product."""
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    small = np.flatnonzero(sizes <= SMALL)
    rows = column.take(pa.array(small)).flatten().field("vector")
    lengths = rows.value_lengths().to_numpy(zero_copy_only=False)
    starts = np.cumsum(sizes[small]) - sizes[small]
    out = np.zeros(len(column), dtype=bool)
    for length in np.unique(lengths):
        place = np.full(len(rows), -1)
        own = np.flatnonzero(lengths == length)
        place[own] = np.arange(len(own))
        unit = _vectors(rows.take(pa.array(own)))
        for size in np.unique(sizes[small]):
            chosen = np.flatnonzero((sizes[small] == size) & (lengths[np.minimum(starts, len(rows) - 1)] == length))
            step = max(1, PRODUCTS // (size * max(size, length)))
            for lo in range(0, len(chosen), step):
                some = chosen[lo : lo + step]
                own = unit[place[starts[some][:, None] + np.arange(size)]]
                products = own @ own.transpose(0, 2, 1)
                products[:, np.arange(size), np.arange(size)] = -1
                out[small[some]] = products.max(axis=(1, 2)) < similarity - CLOSE
    return out


def _verified(parts: DataFrame, similarity: float) -> DataFrame:
    """(node, links, root) from rows (a, b) of two parts of a filter; without b a part meets itself."""

    def verify(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = batch.column("a"), batch.column("b")
            nodes, links, roots = [], [], []
            idle = _without_links(left, similarity) & right.is_null().to_numpy(zero_copy_only=False)
            for i in np.flatnonzero(~idle).tolist():
                a = Part(left[i].values)
                b = Part(right[i].values) if right[i].is_valid else a
                linked = _links(a, b, similarity)
                of, to = np.flatnonzero(linked.any(axis=1)), np.flatnonzero(linked.any(axis=0))
                if not len(of):
                    continue
                linked = linked[np.ix_(of, to)]
                rows, columns = _roots(linked, a.node[of], b.node[to])
                nodes.append(a.node[of]), links.append(linked @ b.n[to]), roots.append(rows)
                if a is not b:
                    nodes.append(b.node[to]), links.append(a.n[of] @ linked), roots.append(columns)
            if nodes:
                out = [np.concatenate(nodes), np.concatenate(links).astype(np.int64), np.concatenate(roots)]
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], ["node", "links", "root"])

    return parts.mapInArrow(verify, "node long, links long, root long")


def _usable(vector: Column) -> Column:
    """Vectors with a direction: no null or non-finite component, and one that is not zero."""
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(sound & F.exists(vector, lambda x: x != 0), F.lit(False))


def near_vectors(
    df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", similarity: float = SIMILARITY
) -> DataFrame:
    """``df`` with ``near``: struct of n_links, component_id and kept.

    Vectors of one label link if their cosine is ``similarity`` or more; n_links are the other rows
    linked with a row, component_id is the least id that links lead to, its own included, kept says
    that this is its own. Vectors that are null, empty, zero or hold a null or non-finite component,
    and those without a label, link with nothing, and vectors of different sizes do not link. Each row is a
    vector: a repeated row links with its equal, and rows that share an id are counted each. A
    row without an id takes part; where no row of a component has an id, component_id is null and all
    are kept. Other columns stay, one named ``near`` is replaced.
    """
    vector = F.col(vector_col)
    sums = [F.xxhash64(F.lit(k), vector).alias(f"v{k}") for k in (1, 2)]
    sound = df.where(F.col(label_col).isNotNull() & _usable(vector)).select(
        F.col(label_col).alias("label"), vector.alias("vector"), F.col(id_col).alias("id")
    )
    classes = sound.groupBy("label", "vector").agg(F.count("*").alias("n"), F.min("id").alias("low"))
    classes = settled(classes.withColumn("node", F.monotonically_increasing_id()))
    directions = max(64, FILTERS_PER_CLASS * classes.count())
    lists = settled(_decoded(classes, directions, similarity))

    bucket = ["label", "size", "filter"]
    entries = lists.select("node", "label", F.size("vector").alias("size"), F.explode("filters").alias("filter"))
    sizes = entries.groupBy(*bucket).agg(F.count("*").alias("members")).where("members > 1")
    sizes = settled(sizes.withColumn("parts", F.ceil(F.col("members") / PART).cast("int")).drop("members"))
    place = F.struct("filter", "parts", F.pmod(F.xxhash64("node"), "parts").cast("int").alias("part"))
    placed = entries.join(sizes, bucket).groupBy("node").agg(F.collect_list(place).alias("places"))
    filled = lists.drop("filters").withColumn("size", F.size("vector")).join(placed, "node").withColumn("place", F.explode("places"))
    before = F.filter("places.filter", lambda f: f < F.col("place.filter")).alias("filters")  # those that others share, before this one
    filled = filled.select("label", "size", "place.*", F.struct("node", "n", "vector", before).alias("member"))
    parts = settled(filled.groupBy(*bucket, "parts", "part").agg(F.collect_list("member").alias("a")))
    alone = parts.select("a", F.lit(None).cast(parts.schema["a"].dataType).alias("b"))
    pairs = sizes.where("parts > 1").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    pairs = pairs.withColumn("other", F.explode(F.sequence(F.col("part"), F.col("parts") - 1))).where("part < other").drop("parts")
    many = parts.where("parts > 1")
    met = pairs.join(many.select(*bucket, "part", "a"), [*bucket, "part"])
    met = met.join(many.select(*bucket, F.col("part").alias("other"), F.col("a").alias("b")), [*bucket, "other"])
    found = settled(_verified(alone.union(met.select("a", "b")), similarity))

    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    together = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    linked = classes.join(links, "node", "left").join(together, "node", "left").withColumn("component", F.coalesce("component", "node"))
    lowest = linked.groupBy("component").agg(F.min("low").alias("lowest"))
    known = linked.join(lowest, "component").select(
        F.struct("label", *(F.xxhash64(F.lit(k), "vector") for k in (1, 2))).alias("_class"),
        (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("_links"),
        F.col("lowest").alias("_lowest"),
    )
    own = F.struct(F.col(label_col).alias("label"), *sums)
    rows = df.withColumn("_class", F.when(F.col(label_col).isNotNull() & _usable(vector), own))
    out = rows.join(known, "_class", "left")
    component = F.when(F.col("_links").isNull(), F.col(id_col)).otherwise(F.col("_lowest"))
    near = F.struct(
        F.coalesce("_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), component.eqNullSafe(F.col(id_col)).alias("kept")
    )
    return out.withColumn("near", near).drop("_class", "_links", "_lowest")
