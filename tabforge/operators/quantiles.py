"""Exact quantiles that never gather an unbounded column in one task.

Spark's ``percentile`` is exact but keeps one map entry per distinct value, so it is
used only where the measured number of distinct values is small. For other columns
every wanted rank is bracketed with ``percentile_approx``, the bracket is checked and
counted in a second scan, and narrowed until few distinct values are left in it. All
columns and ranks share the scans of a round; a round shrinks the bracket about a
thousandfold, so two or three rounds do for any size.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

DISTINCT_LIMIT = 50_000
_ACCURACY = 10_000


@dataclass
class _Search:
    """Values between ``low`` and ``high`` still hold the wanted ranks of one column."""

    column: str
    rank: int  # 0-based, within the bracket
    last: int  # second wanted rank: the same or the next one
    size: int
    low: float | None = None
    high: float | None = None
    distinct: int | None = None
    margin: float = 3.0 / _ACCURACY
    found: tuple[float, float] | None = None

    def inside(self) -> Column:
        x, ok = F.col(self.column), F.col(self.column).isNotNull()
        if self.low is not None:
            ok = ok & (x >= F.lit(self.low))
        if self.high is not None:
            ok = ok & (x <= F.lit(self.high))
        return ok


def exact_quantiles(
    df: DataFrame,
    columns: dict[str, Column],
    probs: Sequence[float],
    distinct_limit: int | None = None,
) -> dict[str, list[float | None]]:
    """Linear-interpolated quantiles of several expressions, NULL ignored.

    Only ``len(columns) * len(probs)`` numbers reach the driver.
    """
    limit = distinct_limit or DISTINCT_LIMIT
    names = list(columns)
    base = df.select(*[columns[n].cast("double").alias(f"c{i}") for i, n in enumerate(names)])
    sizes = base.agg(
        *[F.count(f"c{i}").alias(f"n{i}") for i in range(len(names))],
        *[F.approx_count_distinct(f"c{i}").alias(f"d{i}") for i in range(len(names))],
    ).first()
    small = [i for i in range(len(names)) if sizes[f"d{i}"] <= limit]
    result: dict[str, list[float | None]] = {}
    if small:
        fractions = F.array(*[F.lit(float(p)) for p in probs])
        row = base.agg(*[F.percentile(f"c{i}", fractions).alias(f"q{i}") for i in small]).first()
        for i in small:
            result[names[i]] = list(row[f"q{i}"]) if row[f"q{i}"] is not None else [None] * len(probs)
    large = [i for i in range(len(names)) if i not in small]
    if large:
        searches = []
        for i in large:
            n = sizes[f"n{i}"]
            for p in probs:
                k = int(p * (n - 1))
                searches.append(_Search(f"c{i}", k, min(k + 1, n - 1), n))
        _resolve(base, searches, limit)
        for j, i in enumerate(large):
            values = []
            for p, s in zip(probs, searches[j * len(probs) : (j + 1) * len(probs)]):
                position = p * (sizes[f"n{i}"] - 1)
                low, high = s.found
                values.append(low + (high - low) * (position - int(position)))
            result[names[i]] = values
    return result


def value_at_rank(df: DataFrame, expr: Column, rank: int, distinct_limit: int | None = None):
    """The value of an expression with 0-based ascending ``rank``, NULL left out."""
    limit = distinct_limit or DISTINCT_LIMIT
    base = df.select(expr.alias("c0")).where(F.col("c0").isNotNull())
    if base.schema["c0"].dataType.typeName() != "double":
        return _rank_by_counts(base, rank)
    n = base.count()
    search = _Search("c0", rank, rank, n, distinct=n)
    _resolve(base, [search], limit)
    return search.found[0]


def _resolve(df: DataFrame, searches: list[_Search], limit: int) -> None:
    while True:
        open_ones = [s for s in searches if s.found is None and (s.distinct is None or s.distinct > limit)]
        if not open_ones:
            break
        _narrow(df, open_ones)
    last = [s for s in searches if s.found is None]
    if last:
        # The bracket holds few distinct values, so these maps are small.
        picks = []
        for i, s in enumerate(last):
            column = f"if({s.column} IS NOT NULL{_range_text(s)}, {s.column}, NULL)"
            for tag, rank in (("a", s.rank), ("b", s.last)):
                share = (rank + 0.5) / s.size
                picks.append(F.expr(f"percentile_disc({share!r}D) WITHIN GROUP (ORDER BY {column})").alias(f"{tag}{i}"))
        row = df.agg(*picks).first()
        for i, s in enumerate(last):
            s.found = (row[f"a{i}"], row[f"b{i}"])


def _range_text(s: _Search) -> str:
    low = "" if s.low is None else f" AND {s.column} >= {s.low!r}D"
    return low + ("" if s.high is None else f" AND {s.column} <= {s.high!r}D")


def _narrow(df: DataFrame, searches: list[_Search]) -> None:
    """One round: new brackets from the sketch, then their exact counts."""
    sketches = []
    for i, s in enumerate(searches):
        ends = [max(0.0, s.rank / s.size - s.margin), min(1.0, (s.last + 1) / s.size + s.margin)]
        sketches.append(
            F.percentile_approx(F.when(s.inside(), F.col(s.column)), F.array(*[F.lit(e) for e in ends]), F.lit(_ACCURACY)).alias(f"e{i}")
        )
    row = df.agg(*sketches).first()
    tries, counts = [], []
    for i, s in enumerate(searches):
        low, high = row[f"e{i}"]
        new = _Search(s.column, s.rank, s.last, s.size, low, high)
        if s.rank / s.size - s.margin <= 0.0:
            new.low = s.low
        if (s.last + 1) / s.size + s.margin >= 1.0:
            new.high = s.high
        tries.append(new)
        below = F.lit(0) if new.low is None or new.low == s.low else F.count_if(s.inside() & (F.col(s.column) < F.lit(new.low)))
        counts += [
            below.cast("long").alias(f"b{i}"),
            F.count_if(new.inside()).alias(f"n{i}"),
            F.approx_count_distinct(F.when(new.inside(), F.col(s.column))).alias(f"d{i}"),
        ]
    row = df.agg(*counts).first()
    for i, (s, new) in enumerate(zip(searches, tries)):
        below, size = row[f"b{i}"], row[f"n{i}"]
        missed = not (below <= s.rank and s.last < below + size)
        if missed and s.margin < 0.1:
            s.margin *= 10.0  # the sketch was off: a wider bracket next time
            continue
        if missed or size == s.size:
            # Nothing left to cut, as with two huge ties far apart: count every distinct value.
            rows = df.where(s.inside()).select(F.col(s.column).alias("c0"))
            s.found = tuple(_rank_by_counts(rows, r) for r in (s.rank, s.last))
            continue
        s.low, s.high, s.rank, s.last, s.size, s.distinct = new.low, new.high, s.rank - below, s.last - below, size, row[f"d{i}"]
        s.margin = 3.0 / _ACCURACY
        if s.low is not None and s.low == s.high:
            s.found = (s.low, s.low)


def _rank_by_counts(df: DataFrame, rank: int):
    """Rank selection over one row per distinct key, distributed whatever their number."""
    from tabforge.operators.prefix import running_totals

    counts = df.groupBy(F.col("c0").alias("key")).agg(F.count("*").alias("n"))
    running = running_totals(counts, "key", ["n"])
    return running.where(F.col("n_to") > rank).agg(F.min("key")).first()[0]
