"""Exact k-nearest-neighbour join on numeric vectors with missing cells.

Distance between rows that share some observed features is the Minkowski sum over
the shared ones, scaled up by (all features / shared features). For a group of donors
it is bounded from below by what the features observed in the whole group contribute,
scaled by the most features that a row of the group can share:

1. Donors are put into cells of a quantile grid over the features of largest spread; a
   missing value is a bin of its own. A cell keeps its row count and bounding box, the
   features observed in all and in any of its rows. The number of cells grows with the
   donors, up to a table of boxes of ``BOX_BYTES``; neighbouring cells share a larger box.
2. Equal query rows are searched once, and of equal donors only the k of lowest ids are kept, as
   equal distances are ordered by donor id. Where queries ask for targets and lack features in few
   ways (``MAX_ASKS``), each way and target is a search of its own, and donors are equal if they are in the
   features that such queries have.
3. Each query first meets its home cells only, the nearest ones that hold enough donors.
   The k-th nearest found there is its radius; then it meets the cells that reach into
   that radius and no others.
4. Queries and donors are packed into blocks of bounded size per cell; pairs of blocks
   are joined on cell and both block numbers, so no cell is a hot key. A task sees one
   pair of blocks at a time, measures it in numpy and emits at most k rows per query.
5. The per-block winners are merged by a grouped rank.

On few features the work per query is then a few cells, whatever the number of donors.
On wide dense vectors the boxes of a few features bound little, and most cells are met:
exact search has no better general bound there. If the donors are few (checked, not
assumed) all this collapses to one map over the queries with the donor matrix broadcast;
results are the same.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import astuple, dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tabforge.session import handed_off, spread

BROADCAST_BYTES = 16 * 1024 * 1024
BROADCAST_ROWS = 20_000
BOX_BYTES = 64 * 1024 * 1024
MAX_CELLS = 65_536
AXES = 5
ROWS_PER_CELL = 64
BLOCK_ROWS = 1024
DEALT_ROWS = 50_000  # rows of a part of the donors before copies are left out
CELLS_PER_GROUP = 64
_SPLIT_BYTES = 8 * 1024  # each query row is dear, so even small tables are spread out
_CHUNK = 200_000  # matrix cells worked on at once, so that they stay in cache
_ROUTE_ROWS = 512  # queries whose bounds are held at once
_NEAR_GROUPS = 8  # groups of cells among which most queries find their home
_GROUPS_AT_ONCE = 2048  # pairs of a query and a group whose cells are looked at together
MAX_ASKS, ASKS_AT_ONCE = 16, 4  # pairs of missing features and target that are searched each on its own, and at a time
BROADCAST_PAIRS = 2_000_000_000  # pairs of such a search up to which its donors are broadcast
PLAIN = -1  # target index of an ordinary search

EDGE_SCHEMA = "query_id long, target int, donor_id long, power double, value double, place int"
_EDGE_ARROW = pa.schema(
    [
        ("query_id", pa.int64()),
        ("target", pa.int32()),
        ("donor_id", pa.int64()),
        ("power", pa.float64()),
        ("value", pa.float64()),
        ("place", pa.int32()),
    ]
)


# ---- numpy kernel ----------------------------------------------------------


def _power_distances(q: np.ndarray, d: np.ndarray, p: float) -> np.ndarray:
    """Scaled sum of |difference|**p for every pair; inf where nothing is shared."""
    width = q.shape[1]
    q_gap, d_gap = np.isnan(q), np.isnan(d)
    alike = not len(d) or not (d_gap != d_gap[0]).any()
    total = np.zeros((len(q), len(d)))
    shared = np.full((len(q), 1 if alike else len(d)), float(width))
    for j in range(width):
        if alike and len(d) and d_gap[0, j]:
            shared -= 1
            continue
        diff = np.subtract.outer(q[:, j], d[:, j])
        if p == 2.0:
            diff *= diff
        else:
            np.abs(diff, out=diff)
            if p != 1.0:
                diff **= p
        lost_rows = q_gap[:, j]
        if alike:
            if lost_rows.any():
                diff[lost_rows] = 0.0
                shared[lost_rows] -= 1
        elif lost_rows.any() or d_gap[:, j].any():
            lost = lost_rows[:, None] | d_gap[None, :, j]
            shared -= lost
            diff[lost] = 0.0
        total += diff
    if (shared < width).any():
        with np.errstate(divide="ignore", invalid="ignore"):
            total = np.where(shared > 0, total * (width / shared), np.inf)
    return total


def _first(rows: np.ndarray, cols: np.ndarray, dist: np.ndarray, n: int, k: int):
    """Keep the k nearest (row, column) entries of each row, with their place."""
    order = np.lexsort((cols, dist, rows))
    rows, cols, dist = rows[order], cols[order], dist[order]
    place = np.arange(len(rows)) - np.searchsorted(rows, np.arange(n))[rows] + 1
    keep = place <= k
    return rows[keep], cols[keep], dist[keep], place[keep]


def _smallest(dist: np.ndarray, k: int):
    """(row, column, distance, place) of the k smallest finite entries per row; ties to the lower column."""
    kth = np.partition(dist, min(k, dist.shape[1]) - 1, axis=1)[:, min(k, dist.shape[1]) - 1]
    rows, cols = np.nonzero((dist <= kth[:, None]) & np.isfinite(dist))
    return _first(rows, cols, dist[rows, cols], len(dist), k)


def _search(qid, qv, did, dv, dval, k, p, targets, skip_self, limit=None) -> list[pa.RecordBatch]:
    """Edges from a block of queries to a block of donors (sorted by id), none beyond the radius."""
    out = []
    step = max(1, _CHUNK // max(1, len(did)))
    for s in range(0, len(qid), step):
        ids, vectors = qid[s : s + step], qv[s : s + step]
        dist = _power_distances(vectors, dv, p)
        if skip_self:
            dist[ids[:, None] == did[None, :]] = np.inf
        for i, t in enumerate(targets):
            has = np.ones(len(did), dtype=bool) if t == PLAIN else ~np.isnan(dv[:, t])
            asks = np.ones(len(ids), dtype=bool) if t == PLAIN else np.isnan(vectors[:, t])
            values = dval if t == PLAIN else dv[:, t]
            if not has.any() or not asks.any():
                continue
            if limit is None:
                pick_q, pick_d = np.nonzero(asks)[0], np.nonzero(has)[0]
                sub = dist if t == PLAIN else dist[np.ix_(pick_q, pick_d)]
                rows, cols, power, place = _smallest(sub, k)
                rows, donors = pick_q[rows], pick_d[cols]
            else:
                # Rows that do not ask have a negative limit, so they select nothing.
                most, last_id = limit[0][s : s + step, i], limit[1][s : s + step, i]
                inside = dist <= most[:, None]
                if not has.all():
                    inside &= has
                rows, cols = np.nonzero(inside)
                power = dist[rows, cols]
                keep = np.isfinite(power) & ((power < most[rows]) | (did[cols] <= last_id[rows]))
                rows, donors, power, place = _first(rows[keep], cols[keep], power[keep], len(ids), k)
            if not len(rows):
                continue
            out.append((ids[rows], np.full(len(rows), t, dtype=np.int32), did[donors], power, values[donors], place))
    if not out:
        return []
    columns = [np.concatenate(c) for c in zip(*out)]
    columns[5] = columns[5].astype(np.int32)
    return [pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=_EDGE_ARROW)]


def _lists(matrix: np.ndarray) -> pa.Array:
    """Rows of a matrix as list cells, NaN as NULL."""
    offsets = pa.array(np.arange(0, matrix.size + 1, max(1, matrix.shape[1])), pa.int32())
    return pa.ListArray.from_arrays(offsets, pa.array(matrix.ravel(), from_pandas=True))


def _floats(arr: pa.Array) -> np.ndarray:
    return arr.to_numpy(zero_copy_only=False).astype(np.float64)


# ---- cells -----------------------------------------------------------------


@dataclass
class _Boxes:
    """Boxes of cells, and of groups of neighbouring cells: all that is broadcast at scale."""

    count: np.ndarray  # (cells, features): rows that have the feature
    low: np.ndarray
    high: np.ndarray
    every: np.ndarray  # feature observed in the whole cell
    some: np.ndarray  # feature observed somewhere in it

    def grouped(self) -> _Boxes:
        first = np.arange(0, len(self.low), CELLS_PER_GROUP)
        return _Boxes(
            np.add.reduceat(self.count, first),
            np.minimum.reduceat(np.where(self.some, self.low, np.inf), first),
            np.maximum.reduceat(np.where(self.some, self.high, -np.inf), first),
            np.logical_and.reduceat(self.every, first),
            np.logical_or.reduceat(self.some, first),
        )

    def lower(self, q: np.ndarray, p: float, cells: np.ndarray) -> np.ndarray:
        """Lower bound of the distance power from each query to each of the cells; inf where nothing is shared."""
        width = q.shape[1]
        total, shared = np.zeros((len(q), len(cells))), np.zeros((len(q), len(cells)))
        for j in range(width):
            x = q[:, j, None]
            seen = ~np.isnan(x)
            near = np.maximum(0.0, np.maximum(self.low[None, cells, j] - x, x - self.high[None, cells, j]))
            total += np.where(self.every[None, cells, j] & seen, near**p, 0.0)
            shared += self.some[None, cells, j] & seen
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(shared > 0, total * (width / shared) * (1 - 1e-9), np.inf)

    def lower_of(self, q: np.ndarray, p: float, cells: np.ndarray) -> np.ndarray:
        """The same bound for pairs: each row of ``q`` and the cell beside it."""
        width = q.shape[1]
        total, shared = np.zeros(len(q)), np.zeros(len(q))
        for j in range(width):
            x = q[:, j]
            seen = ~np.isnan(x)
            near = np.maximum(0.0, np.maximum(self.low[cells, j] - x, x - self.high[cells, j]))
            total += np.where(self.every[cells, j] & seen, near**p, 0.0)
            shared += self.some[cells, j] & seen
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(shared > 0, total * (width / shared) * (1 - 1e-9), np.inf)


def _until(rows: np.ndarray, columns: np.ndarray, bound: np.ndarray, have: np.ndarray, need: int) -> tuple[np.ndarray, np.ndarray]:
    """Of (row, column) entries, sorted by row, those of the smallest bounds of each row until ``have`` adds up to ``need``."""
    use = np.isfinite(bound) & (have > 0)
    rows, columns, bound, have = rows[use], columns[use], bound[use], have[use]
    order = np.lexsort((columns, bound, rows))
    rows, columns, have = rows[order], columns[order], have[order]
    before = np.cumsum(have) - have
    before -= before[np.searchsorted(rows, rows)]
    return rows[before < need], columns[before < need]


def _cells_of(boxes: _Boxes, rows: np.ndarray, groups: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, cell) for the cells of each (row, group)."""
    cells = (groups[:, None] * CELLS_PER_GROUP + np.arange(CELLS_PER_GROUP)).ravel()
    real = cells < len(boxes.low)
    return np.repeat(rows, CELLS_PER_GROUP)[real], cells[real]


def _home(boxes: _Boxes, groups: _Boxes, q: np.ndarray, k: int, p: float, targets: Sequence[int]) -> list[np.ndarray]:
    """For each query the nearest cells that hold twice the donors asked for, per target."""
    far, everywhere = groups.lower(q, p, np.arange(len(groups.low))), np.arange(len(groups.low))
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for t in targets:
        asks = np.arange(len(q)) if t == PLAIN else np.nonzero(np.isnan(q[:, t]))[0]
        have = groups.count.max(axis=1) if t == PLAIN else groups.count[:, t]
        few = min(_NEAR_GROUPS, len(everywhere))
        near = np.sort(np.argpartition(far[asks], few - 1, axis=1)[:, :few], axis=1) if len(asks) else np.zeros((0, few), dtype=int)
        enough = np.where(np.isfinite(np.take_along_axis(far[asks], near, axis=1)), have[near], 0).sum(axis=1) >= 4 * k
        for some, columns in ((asks[enough], near[enough]), (asks[~enough], np.broadcast_to(everywhere, (int((~enough).sum()), len(everywhere))))):
            rows, columns = np.repeat(some, columns.shape[1]), columns.ravel()
            rows, chosen = _until(rows, columns, far[rows, columns], have[columns], 4 * k)
            rows, cells = _cells_of(boxes, rows, chosen)
            held = boxes.count[cells].max(axis=1) if t == PLAIN else boxes.count[cells, t]
            found.append(_until(rows, cells, boxes.lower_of(q[rows], p, cells), held, 2 * k))
    pairs = np.unique(np.concatenate([r * len(boxes.low) + c for r, c in found])) if found else np.zeros(0, dtype=int)
    rows, cells = np.divmod(pairs, len(boxes.low))
    return np.split(cells.astype(np.int32), np.searchsorted(rows, np.arange(1, len(q))))


def _reached_parts(boxes: _Boxes, groups: _Boxes, q: np.ndarray, power: np.ndarray, p: float, targets: Sequence[int]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(query, cell) pairs of the cells that reach into a query's radius and hold a target it asks for, in parts of bounded size."""
    near, reach = groups.lower(q, p, np.arange(len(groups.low))), np.zeros((len(q), len(groups.low)), dtype=bool)
    for i, t in enumerate(targets):
        holds = np.ones(len(groups.low), dtype=bool) if t == PLAIN else groups.some[:, t]
        reach |= (near <= power[:, i, None]) & np.isfinite(near) & holds[None, :]
    which, group = np.nonzero(reach)
    for s in range(0, len(which), _GROUPS_AT_ONCE):
        rows, cells = _cells_of(boxes, which[s : s + _GROUPS_AT_ONCE], group[s : s + _GROUPS_AT_ONCE])
        bound, inside = boxes.lower_of(q[rows], p, cells), np.zeros(len(rows), dtype=bool)
        for i, t in enumerate(targets):
            inside |= (bound <= power[rows, i]) & np.isfinite(bound) & (True if t == PLAIN else boxes.some[cells, t])
        yield rows[inside], cells[inside].astype(np.int32)


def _reached(boxes: _Boxes, groups: _Boxes, q: np.ndarray, power: np.ndarray, p: float, targets: Sequence[int]) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of ``_reached_parts``."""
    parts = list(_reached_parts(boxes, groups, q, power, p, targets))
    if not parts:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int32)
    return np.concatenate([rows for rows, _ in parts]), np.concatenate([cells for _, cells in parts])


def _build_cells(donors: DataFrame, width: int, n: int, weight: list[float], max_cells: int, rows_per_cell: int):
    """The donors marked with a cell number, the boxes and the number of rows of each cell."""
    most = max(1, min(max_cells, BOX_BYTES // (width * 26)))
    wanted = max(1, min(most, -(-n // rows_per_cell)))
    axes = [int(j) for j in np.argsort(-np.array(weight), kind="stable") if weight[j]][:AXES]
    steps = int(max(1, round(wanted ** (1.0 / max(1, len(axes))))))
    key = [F.lit("")]
    if steps > 1:
        cuts = F.array(*[F.lit(i / steps) for i in range(1, steps)])
        row = donors.agg(*[F.percentile_approx(F.get("v", F.lit(j)), cuts, F.lit(2000)).alias(f"e{j}") for j in axes]).first()
        for j in axes:
            edges = F.array(*[F.lit(float(e)) for e in sorted(set(row[f"e{j}"] or []))]).cast("array<double>")
            x = F.get("v", F.lit(j))
            key.append(F.when(x.isNull(), F.lit("-")).otherwise(F.lpad(F.size(F.filter(edges, lambda e: e <= x)).cast("string"), 6, "0")))
    marked = donors.withColumn("cell_key", F.concat_ws(":", *key))
    x = [F.get("v", F.lit(j)) for j in range(width)]
    boxes = marked.groupBy("cell_key").agg(
        F.count(F.lit(1)).alias("n"), F.array(*[F.count(c) for c in x]).alias("has"), F.array(*[F.min(c) for c in x]).alias("lo"), F.array(*[F.max(c) for c in x]).alias("hi")
    )
    rows = boxes.toArrow().sort_by("cell_key")  # as many as the limits above allow

    def matrix(name: str) -> np.ndarray:
        return _floats(rows.column(name).combine_chunks().flatten()).reshape(-1, width)

    size, has = rows.column("n").to_numpy(), matrix("has")
    table = _Boxes(has, np.nan_to_num(matrix("lo")), np.nan_to_num(matrix("hi")), has == size[:, None], has > 0)
    spark = donors.sparkSession
    numbers = [(key, i, int(c)) for i, (key, c) in enumerate(zip(rows.column("cell_key").to_pylist(), size))]
    cells = spark.createDataFrame(numbers, "cell_key string, cell int, n long")
    return marked.join(F.broadcast(cells.drop("n")), "cell_key").drop("cell_key"), table, cells.drop("cell_key")


def _pack(df: DataFrame, own: DataFrame, other: DataFrame, block_rows: int, prefix: str, columns: Sequence[str]) -> DataFrame:
    """Blocks of about ``block_rows`` rows per cell, one copy for each block of the other side.

    ``own`` and ``other`` have one row (cell, n) per cell.
    """

    def blocks(n: str) -> Column:
        return F.greatest(F.lit(1), F.ceil(F.col(n) / F.lit(block_rows))).cast("int")

    there = "d_block" if prefix == "q" else "q_block"
    sizes = own.select("cell", blocks("n").alias("own_blocks")).join(other.select("cell", blocks("n").alias("other_blocks")), "cell")
    salted = df.join(F.broadcast(sizes), "cell").withColumn(f"{prefix}_block", F.pmod(F.xxhash64("id"), F.col("own_blocks")).cast("int"))
    aggs = [F.collect_list("id").alias(f"{prefix}_id"), *[F.flatten(F.collect_list(c)).alias(f"{prefix}_{c}") for c in columns]]
    packed = salted.groupBy("cell", f"{prefix}_block").agg(F.max("other_blocks").alias("other_blocks"), *aggs)
    return packed.withColumn(there, F.explode(F.sequence(F.lit(0), F.col("other_blocks") - 1))).drop("other_blocks")


# ---- public ----------------------------------------------------------------


def vector(columns: Sequence[str]) -> Column:
    return F.array(*[F.col(f"`{c}`").cast("double") for c in columns])


def knn_edges(
    queries: DataFrame,
    donors: DataFrame,
    *,
    query_id: str,
    donor_id: str,
    query_vector: Column,
    donor_vector: Column,
    width: int,
    k: int,
    p: float = 2.0,
    targets: Sequence[int] | None = None,
    value: Column | None = None,
    skip_self: bool = False,
    broadcast_rows: int = BROADCAST_ROWS,
    max_cells: int = MAX_CELLS,
    rows_per_cell: int = ROWS_PER_CELL,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """The k nearest donors of every query: (query_id, target, donor_id, power, value, place).

    Without ``targets`` this is an ordinary search. With ``targets`` (feature
    positions) each query is searched once per target it lacks, among donors that
    have it, and ``value`` is the donor's reading. ``power`` is the distance to the
    p-th power; equal distances are ordered by donor id.
    """
    wanted = [PLAIN] if targets is None else [int(t) for t in targets]
    payload = (value if value is not None else F.lit(None)).cast("double")
    q = queries.select(F.col(query_id).cast("long").alias("id"), query_vector.alias("v"))
    if targets is not None:
        lacking = F.lit(False)
        for t in wanted:
            lacking = lacking | F.get("v", F.lit(t)).isNull()
        q = q.where(lacking)
    d = donors.select(
        F.col(donor_id).cast("long").alias("id"), donor_vector.alias("v"), F.coalesce(payload, F.lit(float("nan"))).alias("value")
    )
    x = [F.get("v", F.lit(j)) for j in range(width)]
    stats = d.agg(
        F.count(F.lit(1)).alias("n"),
        *[f(c).alias(f"{name}{j}") for j, c in enumerate(x) for name, f in (("s", F.stddev_pop), ("c", F.count))],
    ).first()
    n = stats["n"]
    if n <= broadcast_rows and n * (width + 2) * 8 <= BROADCAST_BYTES:
        return _small_search(q, d, width, k, p, wanted, skip_self)
    if targets is not None:
        edges = _by_ask(q, d, n, width, k, p, wanted, broadcast_rows, max_cells, rows_per_cell, block_rows)
        if edges is not None:
            return edges
    more = k + 1 if skip_self else k  # an own row is found too, and dropped at the end
    d = handed_off(_nearest_copies(_dealt(d, n), more))
    n = d.count()
    if n <= broadcast_rows and n * (width + 2) * 8 <= BROADCAST_BYTES and not skip_self:
        return _small_search(q, d, width, k, p, wanted, skip_self)
    weight = [(stats[f"s{j}"] or 0.0) * stats[f"c{j}"] for j in range(width)]
    members = handed_off(q.withColumn("code", F.xxhash64("v")))
    distinct = handed_off(members.groupBy("code", "v").agg(F.min("id").alias("id")))
    edges = _cell_search(distinct.drop("code"), d, n, weight, width, more, p, wanted, max_cells, rows_per_cell, block_rows)
    copies = members.join(distinct.withColumnRenamed("id", "query_id"), ["code", "v"]).select("id", "query_id")
    if not skip_self:
        return edges.join(copies, "query_id").select(F.col("id").alias("query_id"), "target", "donor_id", "power", "value", "place")
    every = edges.join(copies, "query_id").where("id <> donor_id").select(F.col("id").alias("query_id"), "target", "donor_id", "power", "value")
    return _placed(every, k)


def _cell_search(
    distinct: DataFrame, d: DataFrame, n: int, weight: list[float], width: int, k: int, p: float, targets: Sequence[int], max_cells: int, rows_per_cell: int, block_rows: int
) -> DataFrame:
    """Edges of different queries (id, v) to n donors (id, v, value): a pass over the home cells for the radius, then one over the cells that reach into it."""
    marked, boxes, cells = _build_cells(d, width, n, weight, max_cells, rows_per_cell)
    marked = handed_off(marked.withColumn("value", F.array("value")))
    tables = d.sparkSession.sparkContext.broadcast(astuple(boxes))

    def home(ids: np.ndarray, vectors: np.ndarray, _: np.ndarray):
        table = _Boxes(*tables.value)
        cells_of = _home(table, table.grouped(), vectors, k, p, targets)
        yield np.repeat(np.arange(len(ids)), [len(c) for c in cells_of]), np.concatenate(cells_of)

    def reached(ids: np.ndarray, vectors: np.ndarray, power: np.ndarray):
        table = _Boxes(*tables.value)
        yield from _reached_parts(table, table.grouped(), vectors, power, p, targets)

    args = (marked, cells, width, k, p, targets, block_rows)
    near = _met(distinct.withColumns(_radius(targets)), home, *args)
    last = near.where(F.col("place") == k).groupBy("query_id").agg(F.map_from_entries(F.collect_list(F.struct("target", F.struct("power", "donor_id")))).alias("last"))
    asked = distinct.join(last.withColumnRenamed("query_id", "id"), "id", "left")
    return _met(asked.withColumns(_radius(targets, "last")).drop("last"), reached, *args)


def _by_ask(
    q: DataFrame, d: DataFrame, n: int, width: int, k: int, p: float, targets: list[int], broadcast_rows: int, max_cells: int, rows_per_cell: int, block_rows: int
) -> DataFrame | None:
    """The search with targets, for each pair of missing features and target on its own; None where there are more than ``MAX_ASKS``.

    A query sees of a donor only the features that it has itself, so of donors that are alike in those the k of lowest
    ids are enough. They are very many where donors lack features too: each that shares only a
    few equal ones is at distance 0, and a search among all of them would meet those again for every query.
    """
    x = [F.get("v", F.lit(j)) for j in range(width)]
    lost = [c.isNull() | F.isnan(c) for c in x]
    members = handed_off(q.withColumns({"code": F.xxhash64("v"), "lost": F.concat(*[F.when(c, "1").otherwise("0") for c in lost])}))
    patterns = sorted(r[0] for r in members.select("lost").distinct().limit(MAX_ASKS + 1).collect())
    asks = [(m, t) for m in patterns for t in targets if m[t] == "1"]
    if len(asks) > MAX_ASKS:
        return None
    distinct = handed_off(members.groupBy("lost", "code", "v").agg(F.min("id").alias("id")))
    seen = []
    for a, (m, t) in enumerate(asks):
        own = [x[j] if m[j] == "0" else F.lit(None).cast("double") for j in range(width)]
        useful = F.lit(False)
        for j in range(width):
            useful = useful | (~lost[j] if m[j] == "0" else F.lit(False))
        seen.append(F.when(~lost[t] & useful, F.struct(F.lit(a).alias("ask"), F.array(*own).alias("v"), x[t].alias("value"))))
    parts = _dealt(d, n).select("id", F.explode(F.filter(F.array(*seen), lambda s: s.isNotNull())).alias("s")).select("id", "s.*")
    donors = handed_off(_nearest_copies(parts, k, "ask"))
    spreads = [f(c).alias(f"{name}{j}") for j, c in enumerate(x) for name, f in (("s", F.stddev_pop), ("c", F.count))]
    stats = {r["ask"]: r for r in donors.groupBy("ask").agg(F.count(F.lit(1)).alias("n"), *spreads).collect()}
    asking = {r["lost"]: r["n"] for r in distinct.groupBy("lost").agg(F.count(F.lit(1)).alias("n")).collect()}

    def search(a: int) -> DataFrame:
        m, t = asks[a]
        rows, own, found = distinct.where(F.col("lost") == m).select("id", "v"), donors.where(F.col("ask") == a).drop("ask"), stats[a]
        few = found["n"] <= broadcast_rows and found["n"] * (width + 2) * 8 <= BROADCAST_BYTES and found["n"] * asking[m] <= BROADCAST_PAIRS
        if few:
            edges = _small_search(rows, own, width, k, p, [PLAIN], False)
        else:
            weight = [(found[f"s{j}"] or 0.0) * found[f"c{j}"] for j in range(width)]
            edges = _cell_search(rows, own, found["n"], weight, width, k, p, [PLAIN], max_cells, rows_per_cell, block_rows)
        return edges.withColumns({"target": F.lit(t), "lost": F.lit(m)})

    out = q.sparkSession.createDataFrame([], f"{EDGE_SCHEMA}, lost string")
    with ThreadPoolExecutor(ASKS_AT_ONCE) as pool:
        for edges in pool.map(search, sorted(stats)):
            out = out.unionByName(edges)
    copies = members.join(distinct.withColumnRenamed("id", "query_id"), ["lost", "code", "v"]).select("id", "query_id", "lost")
    return out.join(copies, ["query_id", "lost"]).select(F.col("id").alias("query_id"), "target", "donor_id", "power", "value", "place")


def _nearest_copies(donors: DataFrame, most: int, *by: str) -> DataFrame:
    """Of equal donors (and equal ``by``) those of the lowest ids: all that can be among the nearest ``most``."""
    w = Window.partitionBy("_code", *by, "v").orderBy(F.col("id").asc_nulls_last())  # sorting by a number first is cheap
    marked = donors.withColumn("_code", F.xxhash64("v")).withColumn("_copy", F.row_number().over(w))
    return marked.where(F.col("_copy") <= most).drop("_code", "_copy")


def _dealt(df: DataFrame, n: int) -> DataFrame:
    """Rows in parts of ``DEALT_ROWS``: a file of many rows in few splits would be few long tasks."""
    parts = -(-n // DEALT_ROWS)
    return df.repartition(parts, "id", "v") if parts > 1 else df


def _radius(targets: Sequence[int], last: str | None = None) -> dict[str, Column]:
    """Per target the power, and the donor id among equals, of the k-th nearest so far; without one, no limit."""
    no_power, no_id = F.lit(float("inf")), F.lit(2**63 - 1)
    power, last_id = [], []
    for t in targets:
        asks = F.lit(True) if t == PLAIN else F.get("v", F.lit(t)).isNull()
        found = F.try_element_at(F.col(last), F.lit(t)) if last else None
        power.append(F.when(asks, F.coalesce(found["power"], no_power) if last else no_power).otherwise(F.lit(-1.0)))
        last_id.append(F.coalesce(found["donor_id"], no_id) if last else no_id)
    return {"power": F.array(*power), "last_id": F.array(*last_id)}


def _small_search(q: DataFrame, d: DataFrame, width: int, k: int, p: float, targets: list[int], skip_self: bool) -> DataFrame:
    pdf = d.orderBy("id").toArrow()
    did = pdf.column("id").to_numpy()
    flat = pdf.column("v").combine_chunks()
    dv = _floats(flat.flatten() if len(did) else pa.array([], pa.float64())).reshape(-1, width)
    dval = _floats(pdf.column("value").combine_chunks()) if len(did) else np.empty(0)
    shared = q.sparkSession.sparkContext.broadcast((did, dv, dval))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, vectors, values = shared.value
        for b in batches:
            if b.num_rows and len(ids):
                qv = _floats(b.column("v").flatten()).reshape(-1, width)
                yield from _search(b.column("id").to_numpy(), qv, ids, vectors, values, k, p, targets, skip_self)

    return spread(q, _SPLIT_BYTES).mapInArrow(search, EDGE_SCHEMA)


def _met(queries: DataFrame, choose, marked: DataFrame, cells: DataFrame, width: int, k: int, p: float, targets: Sequence[int], block_rows: int) -> DataFrame:
    """Edges of the queries (id, v, power, last_id) to the donors of the cells that ``choose`` picks."""

    most = max(1, _CHUNK // width)  # routed rows of a batch

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for s in range(0, whole.num_rows, _ROUTE_ROWS):
                b = whole.slice(s, _ROUTE_ROWS)
                ids = b.column("id").to_numpy()
                vectors = _floats(b.column("v").flatten()).reshape(-1, width)
                power = _floats(b.column("power").flatten()).reshape(-1, len(targets))
                last_id = b.column("last_id").flatten().to_numpy().reshape(-1, len(targets))
                for every, found in choose(ids, vectors, power):
                    for at in range(0, len(every), most):
                        rows = every[at : at + most]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(ids[rows]), _lists(vectors[rows]), _lists(power[rows]), _lists(last_id[rows]), pa.array(found[at : at + most].astype(np.int32))],
                            names=["id", "v", "power", "last_id", "cell"],
                        )

    plain = queries.select("id", "v", "power", "last_id")
    routed = handed_off(spread(plain, _SPLIT_BYTES).mapInArrow(route, "id long, v array<double>, power array<double>, last_id array<long>, cell int"))
    visits = routed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"))
    visits = handed_off(visits)  # one row per cell
    donor_blocks = _pack(marked, cells, visits, block_rows, "d", ("v", "value"))
    query_blocks = _pack(routed, visits, cells, block_rows, "q", ("v", "power", "last_id"))
    parts = ("q_id", "q_v", "q_power", "q_last_id", "d_id", "d_v", "d_value")
    met = query_blocks.join(donor_blocks, ["cell", "q_block", "d_block"]).select(*parts)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                part = {name: b.column(name)[i].values for name in parts}
                did = part["d_id"].to_numpy()
                order = np.argsort(did)
                yield from _search(
                    part["q_id"].to_numpy(),
                    _floats(part["q_v"]).reshape(-1, width),
                    did[order],
                    _floats(part["d_v"]).reshape(-1, width)[order],
                    _floats(part["d_value"])[order],
                    k,
                    p,
                    targets,
                    False,
                    (_floats(part["q_power"]).reshape(-1, len(targets)), part["q_last_id"].to_numpy().reshape(-1, len(targets))),
                )

    return _placed(met.mapInArrow(measure, EDGE_SCHEMA), k)


def _placed(edges: DataFrame, k: int) -> DataFrame:
    """Merge the winners of all blocks; each group holds at most k rows per block met."""
    w = Window.partitionBy("query_id", "target").orderBy("power", "donor_id")
    return edges.withColumn("place", F.row_number().over(w)).where(F.col("place") <= k)


def neighbours(
    df: DataFrame, row_id: str, columns: Sequence[str], k: int, p: float = 2.0, **options
) -> DataFrame:
    """k nearest other rows of every row: (row_id, nbr_id, dist, place)."""
    edges = knn_edges(
        df, df, query_id=row_id, donor_id=row_id, query_vector=vector(columns), donor_vector=vector(columns),
        width=len(columns), k=k, p=p, skip_self=True, **options,
    )
    return edges.select(
        F.col("query_id").alias("row_id"), F.col("donor_id").alias("nbr_id"), F.pow("power", F.lit(1.0 / p)).alias("dist"), "place"
    )


METRIC_POWER = {"euclidean": 2.0, "manhattan": 1.0}


def metric_power(metric: str, p: float = 2.0) -> float:
    return p if metric == "minkowski" else METRIC_POWER[metric]


def weighted_mean(edges: DataFrame, by: Sequence[str], power: float, weights: str = "uniform") -> DataFrame:
    """Mean donor value per group; 'distance' weighs by 1/d and a zero distance takes all."""
    if weights == "uniform":
        return edges.groupBy(*by).agg(F.avg("value").alias("estimate"))
    d = F.pow("power", F.lit(1.0 / power))
    zero = F.col("power") == 0
    return edges.groupBy(*by).agg(
        F.coalesce(
            F.avg(F.when(zero, F.col("value"))),
            F.sum(F.when(~zero, F.col("value") / d)) / F.sum(F.when(~zero, 1.0 / d)),
        ).alias("estimate")
    )
