"""Second-order boosted trees, many models in the same passes over one table.

Folds, classes, bases and grid points of an experiment are models over the same rows, and boosting
needs a pass for each level of each tree whatever the number of models. So all models of a batch
grow together: a pass over the cached blocks of the table returns, for every model, the sums
of gradients and second derivatives by (node, feature, bin); the driver picks the splits and the
next pass goes one level down. The number of passes is that of the largest model, the sums
are bounded by models x nodes x features x bins, and rows never leave their partition. A model
takes the rows whose column ``rows`` is true, so folds need no copies of the table.

The margins of all models are part of the cached blocks; every ``CHECKPOINT`` trees they are
checkpointed in the shared folder, so a lost executor costs at most so many trees. Rows are
sampled in ``DRAWS`` groups made by a hash of the row id, never by partition: a tree takes the
drawn groups whole, and results do not follow the partitioning, but for the order of additions.

Binned rows with the same bins are one row to these models, with their weights added up and their
labels averaged. Where the bins of all features make at most ``CELLS`` cells, one aggregate gives
that table of cells (by group, where a model samples rows), whose size the number of rows does not
change, and each model then grows in a task of its own: one scan in place of a pass a level.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, functions as F

from tabforge.operators.profile import quoted
from tabforge.session import ensure_checkpoint_dir

#: Bins of a feature, as many rows of which limits are taken, and rows of a cached block.
BINS, BLOCK_ROWS = 32, 65_536
#: Trees between two checkpoints of the margins.
CHECKPOINT = 25
#: Cells of the binned features up to which each model grows from sums by cell, in one task.
CELLS = 65_536
#: Groups of rows that a tree which samples takes or leaves; a share is rounded to so many parts.
DRAWS = 64
#: Partitions above which sums are combined on executors before the driver gets them.
WIDE = 16


@dataclass(frozen=True)
class Boosting:
    """A model of a batch.

    ``label`` names the label column, ``rows`` a boolean column (all rows if empty). ``newton`` takes second derivatives
    into gains (off: variances, as in first-order boosting). ``num_leaves`` bounds the
    leaves of a tree, the most gainful splits of a level first. ``subsample`` is the share of
    the ``DRAWS`` groups of rows that a tree sees, at least one.
    """

    label: str
    rows: str = ""
    weight: str = ""
    logistic: bool = True
    n_estimators: int = 100
    learning_rate: float = 0.1
    max_depth: int = 5
    subsample: float = 1.0
    colsample: float = 1.0
    min_child_weight: float = 0.0
    min_child_samples: int = 1
    gamma: float = 0.0
    reg_lambda: float = 0.0
    reg_alpha: float = 0.0
    num_leaves: int = 0
    newton: bool = True


def bin_limits(df: DataFrame, features: Sequence[str], bins: int = BINS) -> list[np.ndarray]:
    """Upper limits of the bins of each feature but the last, from approximate quantiles of all rows."""
    shares = [(k + 1) / bins for k in range(bins - 1)]
    found = df.select(*[F.col(c).cast("double") for c in features]).approxQuantile(list(features), shares, 0.001)
    return [np.unique(np.array(x, dtype=float)) for x in found]


def _draw_group(row_id: str) -> Column:
    return F.pmod(F.xxhash64(row_id), F.lit(DRAWS)).cast("int")


def distinct_cells(binned: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different rows of bins, in their order, and the place of each row among them; rows are compared as one number of at most ``CELLS``."""
    if not len(binned):
        return binned, np.zeros(0, dtype=np.int64)
    sizes = tuple(binned.max(axis=0) + 1)
    numbers, at = np.unique(np.ravel_multi_index(tuple(binned.T), sizes), return_inverse=True)
    return np.stack(np.unravel_index(numbers, sizes), axis=1), at.reshape(-1)


def _blocks(df: DataFrame, features: Sequence[str], limits: list[np.ndarray], specs: Sequence[Boosting], row_id: str) -> RDD:
    """Blocks (groups, bins, labels, weights) of the table; a weight of 0 marks rows that a model does not take."""
    columns = [_draw_group(row_id).alias("_h"), *(F.col(c).cast("double").alias(f"_x{i}") for i, c in enumerate(features))]
    for m, s in enumerate(specs):
        takes = F.col(s.rows).cast("double") if s.rows else F.lit(1.0)
        columns += [F.col(s.label).cast("double").alias(f"_y{m}"), (takes * (F.col(s.weight) if s.weight else F.lit(1.0))).cast("double").alias(f"_w{m}")]

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, len(batch), BLOCK_ROWS):
                get = {n: c.slice(lo, BLOCK_ROWS).to_numpy(zero_copy_only=False) for n, c in zip(batch.schema.names, batch.columns)}
                binned = np.column_stack([np.searchsorted(limits[i], get[f"_x{i}"], side="left") for i in range(len(limits))]).astype(np.uint8)
                y, w = (np.nan_to_num(np.column_stack([get[f"_{k}{m}"] for m in range(len(specs))]).astype(float)) for k in "yw")
                yield pa.RecordBatch.from_pydict({"block": pa.array([pickle.dumps((get["_h"].astype(np.uint8), binned, y, w))], pa.binary())})

    return df.select(*columns).mapInArrow(pack, "block binary").rdd.map(lambda r: pickle.loads(r[0]))


class _Trees:
    """One tree of each model, as heaps: feature (-1: leaf), bin, value."""

    def __init__(self, n_models: int, depth: int):
        size = 2 ** (depth + 1) - 1
        self.feature = np.full((n_models, size), -1, dtype=np.int16)
        self.bin = np.zeros((n_models, size), dtype=np.uint8)
        self.value = np.zeros((n_models, size))

    def places(self, binned: np.ndarray, levels: int) -> np.ndarray:
        """The node of each row and model after so many levels."""
        models = np.arange(len(self.feature))[None, :]
        node = np.zeros((len(binned), len(self.feature)), dtype=np.int64)
        for _ in range(levels):
            feature = self.feature[models, node]
            right = np.take_along_axis(binned, np.maximum(feature, 0).astype(np.int64), axis=1) > self.bin[models, node]
            node = np.where(feature >= 0, 2 * node + 1 + right, node)
        return node


def _gradients(margin: np.ndarray, y: np.ndarray, w: np.ndarray, logistic: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    p = 1.0 / (1.0 + np.exp(-np.clip(margin, -500, 500)))
    return np.where(logistic, y - p, y - margin) * w, np.where(logistic, p * (1 - p), 1.0) * w


def _sums(block: tuple, trees: _Trees, level: int, active: np.ndarray, logistic: np.ndarray, drawn: np.ndarray) -> np.ndarray:
    """[model, node of the level, feature, bin, (gradient, second derivative, weight)]"""
    groups, binned, y, w, margin = block
    n, d = binned.shape
    first = 2**level - 1
    place = trees.places(binned, level) - first
    use = (place >= 0) & drawn[:, groups].T & (w > 0) & active[None, :]
    row, model = np.nonzero(use)
    g, h = _gradients(margin[row, model], y[row, model], w[row, model], logistic[model])
    key = (model * 2**level + place[row, model]) * BINS
    out = np.zeros((w.shape[1] * 2**level, d, BINS, 3))
    for i in range(d):
        at = key + binned[row, i]
        for k, values in enumerate((g, h, w[row, model])):
            out[:, i, :, k] = np.bincount(at, values, minlength=out.shape[0] * BINS).reshape(-1, BINS)
    return out.reshape(w.shape[1], 2**level, d, BINS, 3)


def _soft(g: np.ndarray, alpha: np.ndarray) -> np.ndarray:
    return np.sign(g) * np.maximum(np.abs(g) - alpha, 0.0)


class _Batch:
    """The models of a batch while they grow; ``first`` is the number of the first one, which its draws of features follow."""

    def __init__(self, specs: Sequence[Boosting], seed: int, first: int = 0):
        self.specs, self.seed, self.first = list(specs), seed, first

        def of(name: str, shape: tuple[int, ...]) -> np.ndarray:
            return np.array([float(getattr(s, name)) for s in self.specs]).reshape(shape)

        one, four = (-1,), (-1, 1, 1, 1)
        self.logistic, self.shares, self.step = of("logistic", one) > 0, of("subsample", one), of("learning_rate", one)
        self.newton, self.lam, self.alpha = of("newton", four) > 0, of("reg_lambda", four), of("reg_alpha", four)
        self.gamma, self.least_h, self.least_n = of("gamma", one), of("min_child_weight", four), of("min_child_samples", four)
        self.depth = np.array([s.max_depth for s in self.specs])

    def columns(self, number: int, d: int) -> np.ndarray:
        """Features that a tree may use."""
        out = np.ones((len(self.specs), d), dtype=bool)
        for m, s in enumerate(self.specs):
            if s.colsample < 1.0:
                out[m] = False
                out[m, np.random.default_rng([self.seed, number, self.first + m]).permutation(d)[: max(1, round(s.colsample * d))]] = True
        return out

    def drawn(self, number: int) -> np.ndarray:
        """[model, group]: the groups of rows that a tree sees; a model of a smaller share sees part of those of a larger one."""
        places = np.random.default_rng([self.seed, number, DRAWS]).permutation(DRAWS)
        return places[None, :] < np.maximum(np.round(self.shares * DRAWS), 1.0)[:, None]

    def split(self, trees: _Trees, sums: np.ndarray, level: int, active: np.ndarray, allowed: np.ndarray, leaves: np.ndarray) -> bool:
        """Write the splits of a level and the values of its nodes' children; whether any was split."""
        first, nodes = 2**level - 1, np.arange(2**level)
        left = np.cumsum(sums, axis=3)
        whole = left[:, :, :1, -1:, :]
        right = whole - left

        def score(x: np.ndarray) -> np.ndarray:
            return _soft(x[..., 0], self.alpha) ** 2 / np.maximum(np.where(self.newton, x[..., 1], x[..., 2]) + self.lam, 1e-12)

        gain = (score(left) + score(right) - score(whole)) / 2
        fits = (np.minimum(left[..., 2], right[..., 2]) >= np.maximum(self.least_n, 1e-12)) & (np.minimum(left[..., 1], right[..., 1]) >= self.least_h)
        gain = np.where(fits & allowed[:, None, :, None], gain, -np.inf).reshape(len(sums), len(nodes), -1)
        top = np.maximum(gain.max(axis=2, keepdims=True), 1e-300)
        best = np.round(np.maximum(gain / top, 0.0), 9).argmax(axis=2)  # of gains that differ by rounding the first
        most = np.take_along_axis(gain, best[..., None], axis=2)[..., 0]
        chosen = (most > np.maximum(self.gamma, 1e-12)[:, None]) & active[:, None]
        for m, s in enumerate(self.specs):
            if s.num_leaves:  # each split adds a leaf
                order = np.argsort(-np.where(chosen[m], most[m], -np.inf), kind="stable")
                chosen[m, order[max(0, s.num_leaves - leaves[m]) :]] = False
        leaves += chosen.sum(axis=1)
        feature, at = np.divmod(best, BINS)
        model, node = np.nonzero(chosen)
        trees.feature[model, first + node] = feature[model, node]
        trees.bin[model, first + node] = at[model, node]
        for side, part in ((1, left), (2, right)):
            x = part[model, node, feature[model, node], at[model, node]]
            value = _soft(x[:, 0], self.alpha[model, 0, 0, 0]) / np.maximum(x[:, 1] + self.lam[model, 0, 0, 0], 1e-12)
            trees.value[model, 2 * (first + node) + side] = value * self.step[model]
        return bool(chosen.any())

    def grow(self, d: int, measure: Callable[..., np.ndarray], advance: Callable[[_Trees, int], None]) -> list[_Trees]:
        """All trees; ``measure`` returns the sums of a level, ``advance`` adds a tree to the margins."""
        kept, sizes = [], np.array([s.n_estimators for s in self.specs])
        for number in range(int(sizes.max(initial=0))):
            alive = sizes > number
            trees = _Trees(len(self.specs), int(self.depth.max()))
            allowed, leaves = self.columns(number, d), np.ones(len(self.specs), dtype=np.int64)
            drawn = self.drawn(number)
            for level in range(int(self.depth[alive].max())):
                active = alive & (self.depth > level)
                sums = measure(trees, level, active, self.logistic, drawn)
                if not sums.ndim or not self.split(trees, sums, level, active, allowed, leaves):
                    break
            advance(trees, number)
            kept.append(trees)
        return kept


class BoostedModel(Model):
    """A fitted model: heaps of trees over feature columns; trees add to a margin that begins at ``begin``."""

    def __init__(self, features: Sequence[str], begin: float, logistic: bool, feature: np.ndarray, limit: np.ndarray, value: np.ndarray):
        super().__init__()
        self.features, self.begin, self.logistic = list(features), begin, logistic
        self.feature, self.limit, self.value = feature, limit, value
        self.cells: tuple[list[np.ndarray], np.ndarray] | None = None

    def tabulated(self) -> "BoostedModel":
        """The model with its margins by cell, where its limits make at most ``CELLS`` cells: a row is then looked up once, not once a tree."""
        out, used = self.prefix(len(self.feature)), self.feature >= 0
        limits = [np.unique(self.limit[used & (self.feature == i)]) for i in range(len(self.features))]
        if math.prod(len(x) + 1 for x in limits) <= CELLS:
            inside = np.meshgrid(*[np.append(x, np.inf) for x in limits], indexing="ij")  # a value of each cell
            out.cells = limits, self.margins(np.stack([x.ravel() for x in inside], axis=1))
        return out

    def prefix(self, trees: int) -> "BoostedModel":
        """The model of the first trees only."""
        return BoostedModel(self.features, self.begin, self.logistic, self.feature[:trees], self.limit[:trees], self.value[:trees])

    @property
    def toDebugString(self) -> str:
        """Splits and leaves of all trees, by place in their heap."""
        def node(t: int, i: int) -> str:
            own = self.feature[t, i]
            return f"{i}: {self.features[own]} <= {self.limit[t, i]!r}" if own >= 0 else f"{i}: {self.value[t, i]!r}"

        return "\n".join(f"tree {t}: " + ", ".join(node(t, i) for i in range(self.feature.shape[1])) for t in range(len(self.feature)))

    def margins(self, x: np.ndarray) -> np.ndarray:
        if self.cells:
            limits, table = self.cells
            cell = np.zeros(len(x), dtype=np.int64)
            for i, own in enumerate(limits):  # no number is above no limit
                cell = cell * (len(own) + 1) + np.where(np.isnan(x[:, i]), 0, np.searchsorted(own, x[:, i], side="left"))
            return table[cell]
        out, rows = np.full(len(x), self.begin), np.arange(len(x))
        for feature, limit, value in zip(self.feature, self.limit, self.value):
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range(int(np.log2(len(feature) + 1)) - 1):
                own = feature[node]
                node = np.where(own >= 0, 2 * node + 1 + (x[rows, np.maximum(own, 0)] > limit[node]), node)
            out += value[node]
        return out

    def margins_at(self, sizes: Sequence[int]) -> Column:
        """The margins of a row by the first trees, for each number of trees of ``sizes``, as an array column."""
        own, d, ends = self, len(self.features), [0, *sizes]

        @F.arrow_udf("array<double>")
        def score(vectors: pa.Array) -> pa.Array:
            x = vectors.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, d)
            total, out = np.full(len(x), own.begin), []
            for lo, hi in zip(ends, ends[1:]):
                part = BoostedModel(own.features, 0.0, own.logistic, own.feature[lo:hi], own.limit[lo:hi], own.value[lo:hi])
                total = total + part.margins(x)
                out.append(total)
            offsets = np.arange(0, len(x) * len(out) + 1, len(out), dtype=np.int32)
            return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.column_stack(out).ravel()))

        return score(F.array(*[F.col(c).cast("double") for c in self.features]))

    def errors(self, df: DataFrame, label: str, sizes: Sequence[int]) -> dict[int, float]:
        """Mean squared error of the first n trees, for each n of ``sizes`` (ascending), in one scan."""
        y = F.col(label).cast("double")
        each = [F.avg((F.col("_at")[i] - y) ** 2) for i in range(len(sizes))]
        row = df.select(label, self.margins_at(sizes).alias("_at")).agg(*each).first()
        return dict(zip(sizes, row))

    def margin(self) -> Column:
        """The margin of a row, as a column."""
        own, d = self, len(self.features)

        @F.arrow_udf("double")
        def score(vectors: pa.Array) -> pa.Array:
            return pa.array(own.margins(vectors.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, d)))

        return score(F.array(*[F.col(c).cast("double") for c in self.features]))

    def _transform(self, df: DataFrame) -> DataFrame:
        if not self.logistic:
            return df.withColumn("prediction", self.margin())
        p = 1 / (1 + F.exp(-F.col("_margin")))
        out = df.withColumn("_margin", self.margin()).withColumn("probability", array_to_vector(F.array(1 - p, p)))
        return out.withColumn("prediction", (F.col("_margin") > 0).cast("double")).drop("_margin")


def _begin(total: np.ndarray, specs: Sequence[Boosting]) -> np.ndarray:
    """Start margins from the sums of labels and weights: the mean, or the log-odds of the mean."""
    total = total if total.ndim else np.zeros((2, len(specs)))
    mean = total[0] / np.maximum(total[1], 1e-300)
    odds = np.clip(mean, 1e-9, 1 - 1e-9)
    return np.where([s.logistic for s in specs], np.log(odds / (1 - odds)), mean)


def _label_sums(block: tuple) -> np.ndarray:
    return np.array([(block[2] * block[3]).sum(axis=0), block[3].sum(axis=0)])


def _added(rdd: RDD, partitions: int) -> np.ndarray:
    """The sum of arrays over all blocks."""

    def whole(blocks: Iterable[np.ndarray]) -> Iterator[np.ndarray]:
        out = None
        for b in blocks:
            out = b if out is None else out + b
        if out is not None:
            yield out

    parts = rdd.mapPartitions(whole)
    return parts.treeReduce(np.add) if partitions > WIDE else sum(parts.collect(), np.zeros(()))


def fit_many(df: DataFrame, specs: dict[str, Boosting], features: Sequence[str], row_id: str, seed: int = 42, limits: list[np.ndarray] | None = None) -> dict[str, BoostedModel]:
    """Fit all models of ``specs`` together over the rows of ``df``.

    Bins are those of all rows of ``df``, whatever rows a model takes, unless their ``limits`` are given. Features must not be null;
    a null label, weight or ``rows`` counts as 0.
    """
    names, models = list(specs), [specs[n] for n in specs]
    limits = bin_limits(df, features) if limits is None else limits
    narrow = math.prod(len(x) + 1 for x in limits) <= CELLS
    grown = _grow_by_cells(df, features, limits, models, row_id, seed) if narrow else _grow_by_passes(df, features, limits, models, row_id, seed)
    edges = [np.append(x, np.full(BINS - len(x), np.inf)) for x in limits]
    table = np.stack(edges) if edges else np.zeros((0, BINS))
    return {n: BoostedModel(features, begin, s.logistic, feature, table[np.maximum(feature, 0), bins], value) for n, s, (begin, feature, bins, value) in zip(names, models, grown)}


#: A grown model: start margin, and features, bins and values of its heaps.
_Grown = tuple[float, np.ndarray, np.ndarray, np.ndarray]


def _heaps(kept: list[_Trees], m: int, s: Boosting) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    own, width = kept[: s.n_estimators], 2 ** (s.max_depth + 1) - 1
    if not own:
        return np.zeros((0, 1), dtype=np.int16), np.zeros((0, 1), dtype=np.uint8), np.zeros((0, 1))
    return tuple(np.stack([getattr(t, part)[m, :width] for t in own]) for part in ("feature", "bin", "value"))


def _bin_sql(column: str, limits: np.ndarray, first: int = 0) -> str:
    """The number of limits below the value, by halving."""
    if not len(limits):
        return str(first)
    at = len(limits) // 2
    upper, lower = _bin_sql(column, limits[at + 1 :], first + at + 1), _bin_sql(column, limits[:at], first)
    return f"IF(double({column}) > double('{float(limits[at])!r}'), {upper}, {lower})"


def _grow_by_cells(df: DataFrame, features: Sequence[str], limits: list[np.ndarray], specs: Sequence[Boosting], row_id: str, seed: int) -> list[_Grown]:
    """Sums by cell in one aggregate, then one task a model over at most ``CELLS`` rows.

    Where a model samples rows, sums are by cell and group, at most ``CELLS`` x ``DRAWS``; each tree
    adds up those of its groups.
    """
    names = [f"b{i}" for i in range(len(features))]
    bins = [F.expr(_bin_sql(quoted(c), limits[i])).alias(names[i]) for i, c in enumerate(features)]
    sums, known = [], {}
    for m, s in enumerate(specs):
        takes = F.col(s.rows).cast("double") if s.rows else F.lit(1.0)
        w = F.nanvl(F.coalesce((takes * (F.col(s.weight) if s.weight else F.lit(1.0))).cast("double"), F.lit(0.0)), F.lit(0.0))
        y = F.nanvl(F.coalesce(F.col(s.label).cast("double"), F.lit(0.0)), F.lit(0.0))
        known.setdefault((s.label, s.rows, s.weight), []).append(m)  # grid points share their sums
        if known[s.label, s.rows, s.weight] == [m]:
            sums += [F.sum(w).alias(f"w{m}"), F.sum(w * y).alias(f"y{m}")]
    samples = any(s.subsample < 1.0 for s in specs)
    cells = df.groupBy(*bins, (_draw_group(row_id) if samples else F.lit(0)).alias("_g")).agg(*sums)
    parts = [F.struct(F.lit(m).alias("model"), F.col(f"w{own[0]}").alias("w"), F.col(f"y{own[0]}").alias("y")) for own in known.values() for m in own]
    long = cells.select(*names, "_g", F.explode(F.array(*parts)).alias("_s")).select("_s.*", *names, "_g").where("w > 0")

    def whole(m: int, binned: np.ndarray, groups: np.ndarray, w: np.ndarray, y: np.ndarray) -> _Grown:
        own = [specs[m]]
        binned, at = distinct_cells(binned)  # sums do not follow the order of arrival
        parts = np.zeros((2, len(binned), DRAWS if samples else 1))
        parts[:, at, groups] = w, y

        def block(chosen: np.ndarray, margin: np.ndarray) -> tuple:
            w, y = parts[:, :, chosen].sum(axis=2)
            return np.zeros(len(w), dtype=np.uint8), binned.astype(np.uint8), (y / np.maximum(w, 1e-300))[:, None], w[:, None], margin

        def measure(trees: _Trees, level: int, active: np.ndarray, logistic: np.ndarray, drawn: np.ndarray) -> np.ndarray:
            nonlocal rows
            if level == 0 and own[0].subsample < 1.0:
                rows = block(drawn[0], rows[4])
            return _sums(rows, trees, level, active, logistic, np.ones_like(drawn))

        def advance(trees: _Trees, number: int) -> None:
            nonlocal rows
            rows = _grown(trees)(rows)

        rows = block(np.ones(parts.shape[2], dtype=bool), np.zeros((len(binned), 1)))
        begin = _begin(_label_sums(rows), own)
        rows = (*rows[:4], np.tile(begin, (len(binned), 1)))
        kept = _Batch(own, seed, m).grow(binned.shape[1], measure, advance)
        return float(begin[0]), *_heaps(kept, 0, own[0])

    def task(pdf: pd.DataFrame) -> pd.DataFrame:
        m = int(pdf["model"].iloc[0])
        return pd.DataFrame({"model": [m], "grown": [pickle.dumps(whole(m, pdf[names].to_numpy(), pdf["_g"].to_numpy(), pdf["w"].to_numpy(), pdf["y"].to_numpy()))]})

    spread = long.repartition(max(1, len(specs)), "model").groupBy("model").applyInPandas(task, "model int, grown binary")
    found = {r["model"]: pickle.loads(r["grown"]) for r in spread.collect()}  # one row a model
    empty = np.zeros((0, len(names))), np.zeros(0, dtype=int), np.zeros(0), np.zeros(0)
    return [found[m] if m in found else whole(m, *empty) for m in range(len(specs))]


def _grow_by_passes(df: DataFrame, features: Sequence[str], limits: list[np.ndarray], specs: Sequence[Boosting], row_id: str, seed: int) -> list[_Grown]:
    """All models together, one pass over the cached blocks for each level of each tree."""
    ensure_checkpoint_dir(df.sparkSession)
    base = _blocks(df, features, limits, specs, row_id).persist(StorageLevel.MEMORY_AND_DISK)
    partitions = base.getNumPartitions()
    begin = _begin(_added(base.map(_label_sums), partitions), specs)
    state = base.map(lambda b: (*b, np.tile(begin, (len(b[0]), 1)))).persist(StorageLevel.MEMORY_AND_DISK)
    older = [base]

    def advance(trees: _Trees, number: int) -> None:
        nonlocal older, state
        for rdd in older:  # the blocks behind it are no longer read
            rdd.unpersist()
        older, state = [state], state.map(_grown(trees)).persist(StorageLevel.MEMORY_AND_DISK)
        if (number + 1) % CHECKPOINT == 0:
            state.checkpoint()

    kept = _Batch(specs, seed).grow(len(features), lambda *at: _added(state.map(_measure(*at)), partitions), advance)
    for rdd in (*older, state):
        rdd.unpersist()
    return [(float(begin[m]), *_heaps(kept, m, s)) for m, s in enumerate(specs)]


def _measure(*at) -> Callable:
    return lambda block: _sums(block, *at)


def _grown(trees: _Trees) -> Callable:
    depth = int(np.log2(trees.feature.shape[1] + 1)) - 1

    def add(block: tuple) -> tuple:
        groups, binned, y, w, margin = block
        node = trees.places(binned, depth)
        return groups, binned, y, w, margin + trees.value[np.arange(len(trees.value))[None, :], node]

    return add
