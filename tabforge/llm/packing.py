"""Best-fit packing into sequences of several permitted lengths.

The plan needs only how many pieces there are of each length. Lengths are at most the largest
capacity, so this histogram is bounded however many documents there are, and best fit decreasing
runs on it with whole groups of equal bins at a time: pieces of one length go to the open bins
they fill best; if none has room, bins of the capacity that costs least per packed word are
opened. At the end each bin is downsized to the least permitted length that holds its contents.
The plan says which ranks among the pieces of a length go to which bins. Ranks are counted in
parallel, and each piece finds its bin by its length and rank: no piece passes the driver.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from tabforge.llm.tables import id_of, keyed, settled

CAPACITIES = (512, 1024, 2048, 4096)
#: Words one bin costs beside its capacity, whatever its size.
BIN_COST = 16.0
#: Shorter lengths that the choice of a capacity looks at; the packing itself looks at all.
LOOK_AHEAD = 64
#: Pieces that one window ranks, about.
RANK_ROWS = 100_000


@dataclass
class Plan:
    """``slots``: (length, first rank, last rank, first bin, each, offset): pieces of a length whose
    rank is in that range go to bins from the first on, so many to each bin, from that offset on.
    ``groups``: (first bin, last bin, capacity, used)."""

    slots: list[tuple[int, int, int, int, int, int]]
    groups: list[tuple[int, int, int, int]]


@dataclass
class _Group:
    """Equal bins. ``contents``: (length, first rank, each, offset)."""

    bins: int
    opened: int
    room: int
    contents: list[tuple[int, int, int, int]]

    def put(self, length: int, rank: int, each: int) -> int:
        self.contents.append((length, rank, each, self.opened - self.room))
        self.room -= each * length
        return self.bins * each

    def split(self, bins: int) -> "_Group":
        """Take all but the first ``bins`` bins away."""
        rest = _Group(self.bins - bins, self.opened, self.room, [(n, rank + bins * each, each, at) for n, rank, each, at in self.contents])
        self.bins = bins
        return rest


def opening(length: int, count: int, capacities: Sequence[int], rest: Sequence[tuple[int, int]], bin_cost: float) -> int:
    """The capacity whose bin costs least for each word it will hold.

    A bin first takes as many pieces of this length as fit; what is left is filled, as far as
    there are any, with the longest of the shorter pieces (``rest``: length, count, descending).
    """
    best, least = 0, float("inf")
    for capacity in capacities:
        if capacity < length:
            continue
        held = min(capacity // length, count) * length
        for other, there in rest:
            if held == capacity:
                break
            held += min((capacity - held) // other, there) * other
        cost = (min(c for c in capacities if c >= held) + bin_cost) / held
        if cost < least - 1e-12 or (cost < least + 1e-12 and capacity > best):
            best, least = capacity, cost
    return best


def plan_bins(histogram: Sequence[tuple[int, int]], capacities: Sequence[int] = CAPACITIES, bin_cost: float = BIN_COST) -> Plan:
    """Best fit decreasing on (length, count) rows, lengths at most the largest capacity."""
    capacities = sorted(set(capacities))
    sizes = sorted(histogram, reverse=True)
    groups: list[_Group] = []
    rooms: list[tuple[int, int]] = []  # (room, group), ascending
    for at, (length, count) in enumerate(sizes):
        rank = 0
        while rank < count:
            left = count - rank
            k = bisect_left(rooms, (length, -1))
            if k == len(rooms):
                capacity = opening(length, left, capacities, sizes[at + 1 : at + 1 + LOOK_AHEAD], bin_cost)
                each = min(capacity // length, left)
                groups.append(_Group(left // each, capacity, capacity, []))
                number = len(groups) - 1
            else:
                number = rooms.pop(k)[1]
                each = min(groups[number].room // length, left)
                if left // each < groups[number].bins:  # only some of these bins are needed
                    groups.append(groups[number].split(left // each))
                    insort(rooms, (groups[-1].room, len(groups) - 1))
            rank += groups[number].put(length, rank, each)
            insort(rooms, (groups[number].room, number))
    plan, first = Plan([], []), 0
    for g in groups:
        used = g.opened - g.room
        plan.groups.append((first, first + g.bins - 1, next(c for c in capacities if c >= used), used))
        plan.slots += [(length, rank, rank + g.bins * each - 1, first, each, offset) for length, rank, each, offset in g.contents]
        first += g.bins
    return plan


def word_count(text: Column) -> Column:
    """Runs of anything but ASCII white space."""
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+"))


def pack(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacities: Sequence[int] = CAPACITIES,
    bin_cost: float = BIN_COST,
    rank_rows: int = RANK_ROWS,
) -> DataFrame:
    """(doc_id, piece, start, length, bin, bin_offset, capacity, used): where each piece of each document goes.

    A document of more words than the largest capacity is cut into pieces of that length; start
    counts words of the document. Null and empty texts are one piece of length 0 in no bin. Each
    row is packed, also repeated ones and those without an id; other columns are ignored.
    """
    most = max(capacities)
    sized = keyed(df, id_col, text_col).select("key", word_count(F.col("text")).alias("n"))
    last = F.greatest(F.ceil(F.col("n") / most) - 1, F.lit(0)).cast("int")
    cut = sized.withColumn("piece", F.explode(F.sequence(F.lit(0), last))).withColumn("start", F.col("piece") * most)
    cut = cut.select("key", "piece", "start", F.least(F.col("n") - F.col("start"), F.lit(most)).alias("length"))
    pieces = settled(cut)
    total = pieces.count()
    histogram = pieces.where("length > 0").groupBy("length").agg(F.count("*").alias("n"))
    plan = plan_bins([(r["length"], r["n"]) for r in histogram.collect()], capacities, bin_cost)  # at most one row per length
    parts = max(1, -(-total // rank_rows))
    split = pieces.withColumn("part", F.pmod(F.xxhash64("key", "piece"), F.lit(parts)))
    sizes = split.groupBy("length", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    within = F.row_number().over(Window.partitionBy("length", "part").orderBy("key", "piece")) - 1
    ranked = split.withColumn("within", within).join(offsets, ["length", "part"]).withColumn("rank", F.col("within") + F.col("before"))
    spark = df.sparkSession
    slots = spark.createDataFrame(plan.slots, "slot_length long, first_rank long, last_rank long, first_bin long, each long, offset long")
    numbered = sorted(plan.groups)
    groups = spark.createDataFrame(numbered, "group_bin long, last_bin long, capacity long, used long")
    slots = settled(slots.join(groups, F.col("first_bin") == F.col("group_bin")))  # bounded by the number of lengths
    at = (F.col("length") == F.col("slot_length")) & F.col("rank").between(F.col("first_rank"), F.col("last_rank"))
    place = F.col("rank") - F.col("first_rank")
    return ranked.join(F.broadcast(slots), at, "left").select(
        id_of("key").alias("doc_id"),
        F.col("piece").cast("long").alias("piece"),
        F.col("start").cast("long").alias("start"),
        F.col("length").cast("long").alias("length"),
        (F.col("first_bin") + F.floor(place / F.col("each"))).alias("bin"),
        (F.col("offset") + place % F.col("each") * F.col("length")).alias("bin_offset"),
        "capacity",
        "used",
    )
