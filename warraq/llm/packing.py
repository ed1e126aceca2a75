"""Filling fixed-capacity containers, by hierarchical multi-length packing.

Every piece (a document, or a stretch of at most a container of one that alone exceeds it) is routed to the smallest context tier
that holds it: the capacity itself, a quarter of it, a sixteenth, and so on. Tiers are packed from the longest down, each in windows
of its own length: a window takes the longest piece left of its tier, and its gap is filled with the largest pieces that fit, of its
tier or of a shorter one. A tier shorter than the capacity keeps the windows that come out full but for 1 / SLACK of their length;
pieces that find no such window go up, and are packed by themselves in windows of the capacity after all tiers. Windows of shorter
tiers are stacked into containers, which they divide. Containers are then dealt to step groups so that each group has nearly the
same number of tokens.

Pieces of one size are interchangeable, so all this is decided on counts per size: at most ``capacity`` numbers, whatever the
number of documents (MAX_CAPACITY bounds them). The plan is a list of patterns (sizes in a window, and how many such windows);
each exhausts a size, so there are at most ``capacity`` of them. Documents then find their place by their rank within their size,
counted in SHARDS parts, so that a size with a third of all documents is no hot spot.
"""

from __future__ import annotations

from bisect import bisect_right

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from warraq.plans.materialize import cut

MAX_CAPACITY = 1 << 20
SHARDS = 64
TIER_STEP = 4
SLACK = 1024
GROUP_WINDOWS = 8


def tiers(capacity: int) -> list[int]:
    """Context sizes, the longest first."""
    out = [capacity]
    while out[-1] >= 4 * TIER_STEP and len(out) < 6:
        out.append(out[-1] // TIER_STEP)
    return out


class _Left:
    """How many pieces of each size are left, in order of size."""

    def __init__(self, counts: dict[int, int]):
        self.n = dict(counts)
        self.sizes = sorted(counts)

    def take(self, size: int, n: int) -> None:
        self.n[size] -= n
        if not self.n[size]:
            del self.n[size]
            self.sizes.pop(bisect_right(self.sizes, size) - 1)

    def largest(self, most: int) -> int:
        at = bisect_right(self.sizes, most)
        return self.sizes[at - 1] if at else 0


def _window(left: _Left, length: int, first: int) -> tuple[list[tuple[int, int]], int, int]:
    """[(size, pieces of it)] of one window that begins with size ``first``, how many such windows there can be, and the room left in each."""
    gap, pattern, size = length, [], first
    while size:
        n = min(gap // size, left.n[size])
        pattern.append((size, n))
        gap -= n * size
        size = left.largest(min(gap, size - 1))
    return pattern, min(left.n[s] // n for s, n in pattern), gap


def plan(counts: dict[int, int], capacity: int, limits: list[int] | None = None) -> list[tuple[int, list[tuple[int, int]], int]]:
    """Patterns (length of the window, [(size, pieces of it in a window)], windows) that place counts[size] pieces of each size. limits: the tiers, if not tiers(capacity)."""
    left = _Left({s: n for s, n in counts.items() if 0 < s <= capacity and n > 0})
    limits = tiers(capacity) if limits is None else limits
    aside: dict[int, int] = {}
    out = []
    for length, below in zip(limits, [*limits[1:], 0]):
        while (first := left.largest(length)) > below:
            pattern, windows, gap = _window(left, length, first)
            if length == capacity or gap <= length // SLACK:
                out.append((length, pattern, windows))
                for s, n in pattern:
                    left.take(s, n * windows)
            else:
                aside[first] = left.n[first]
                left.take(first, left.n[first])
    left = _Left(aside)
    while first := left.largest(capacity):
        pattern, windows, _ = _window(left, capacity, first)
        out.append((capacity, pattern, windows))
        for s, n in pattern:
            left.take(s, n * windows)
    return out


def _places(patterns: list[tuple[int, list[tuple[int, int]], int]], capacity: int) -> tuple[list[tuple], int]:
    """Where the pieces of each size go by rank, [(size, from rank, to rank, pieces in a window, first window, windows in a container, tier)], and how many containers there are.

    Windows of one tier are numbered one after another, fullest first, and those of a tier begin where the last window of the longer
    tier ends: window w of tier k lies in container w // TIER_STEP ** k.
    """
    out, seen, end = [], {}, 0
    for k, length in enumerate(tiers(capacity)):
        at = end * TIER_STEP
        for _, pattern, windows in sorted((p for p in patterns if p[0] == length), key=lambda p: -sum(s * n for s, n in p[1])):
            for s, n in pattern:
                lo = seen.get(s, 0)
                seen[s] = lo + n * windows
                out.append((s, lo, seen[s], n, at, TIER_STEP**k, length))
            at += windows
        end = at
    return out, -(-end // TIER_STEP ** (len(tiers(capacity)) - 1))


def _slots(spark: SparkSession, places: list[tuple]) -> tuple[DataFrame, DataFrame]:
    """places by size and bucket of ranks, and the width of each size's buckets: a piece meets one or two places, however many its size has."""
    p = pd.DataFrame(places, columns=["size", "lo", "hi", "per", "first", "scale", "tier"], dtype="int64")
    per = p.groupby("size").agg(n=("hi", "max"), m=("hi", "size")).reset_index()
    per["width"] = -(-per["n"] // per["m"])
    p = p.merge(per[["size", "width"]], on="size")
    p["bucket"] = [list(range(lo // w, (hi - 1) // w + 1)) for lo, hi, w in zip(p["lo"], p["hi"], p["width"])]
    p = p.explode("bucket").astype("int64").drop(columns="width")
    long = lambda df: ", ".join(f"{c} bigint" for c in df.columns)
    return spark.createDataFrame(p, long(p)), spark.createDataFrame(per[["size", "width"]], "size bigint, width bigint")


def _ranked(pieces: DataFrame) -> DataFrame:
    """Pieces with their rank (from 0) within their size, counted in shards."""
    sharded = pieces.withColumn("shard", F.pmod(F.xxhash64("id", "piece"), F.lit(SHARDS)))
    per = sharded.groupBy("size", "shard").agg(F.count("*").alias("n"))
    before = F.sum("n").over(W.partitionBy("size").orderBy("shard").rowsBetween(W.unboundedPreceding, -1))
    offsets = per.select("size", "shard", F.coalesce(before, F.lit(0)).alias("offset"))
    own = F.row_number().over(W.partitionBy("size", "shard").orderBy("id", "piece")) - 1
    return sharded.withColumn("own", own).join(offsets, ["size", "shard"]).withColumn("rank", F.col("own") + F.col("offset")).drop("own", "offset", "shard")


def pack(sizes: DataFrame, capacity: int, group_windows: int = GROUP_WINDOWS) -> DataFrame:
    """The container of every document or piece: id, piece, first_token, n_tokens, tier, window_no, container_id, step_group.

    sizes: id bigint, n_tokens bigint, ids unique. A document of more than ``capacity`` tokens is cut into pieces of ``capacity``
    and a rest; no other is split. A document without tokens takes no room and comes with window and container 0 of the longest tier.
    tier is the length of the window a piece lies in, window_no its number among windows of that length; containers are numbered from 0, those of
    longer windows first; a step group has about ``group_windows`` of them. An empty table gives no row.
    """
    if not 0 < capacity <= MAX_CAPACITY:
        raise ValueError(f"capacity must be between 1 and {MAX_CAPACITY}")
    spark = sizes.sparkSession
    n_pieces = F.greatest(F.ceil(F.col("n_tokens") / capacity), F.lit(1))
    pieces = sizes.select("id", "n_tokens", F.explode(F.sequence(F.lit(0).cast("bigint"), n_pieces.cast("bigint") - 1)).alias("piece")).select(
        "id", "piece", (F.col("piece") * capacity).alias("first_token"), F.least(F.lit(capacity), F.col("n_tokens") - F.col("piece") * capacity).cast("int").alias("size")
    )
    pieces = cut(pieces, "pieces")
    # At most capacity rows.
    counts = {r["size"]: r["n"] for r in pieces.where("size > 0").groupBy("size").agg(F.count("*").alias("n")).collect()}
    places, total = _places(plan(counts, capacity), capacity)
    groups = max(1, -(-total // group_windows))
    # widths: at most capacity rows of two numbers. slots: a row for each size in each pattern, and at most as many again for the buckets.
    slots, widths = _slots(spark, places)
    ranked = _ranked(pieces.where("size > 0")).join(F.broadcast(widths), "size").withColumn("bucket", F.floor(F.col("rank") / F.col("width")))
    placed = ranked.join(slots, ["size", "bucket"]).where("rank >= lo and rank < hi")
    window = F.col("first") + F.floor((F.col("rank") - F.col("lo")) / F.col("per"))
    container = F.floor(window / F.col("scale"))
    turn, at = F.floor(container / groups), container % groups
    group = F.when(turn % 2 == 0, at).otherwise(groups - 1 - at)
    out = placed.select(
        "id", "piece", "first_token", F.col("size").alias("n_tokens"), F.col("tier").cast("int").alias("tier"), window.cast("bigint").alias("window_no"), container.cast("bigint").alias("container_id"), group.cast("bigint").alias("step_group")
    )
    none = pieces.where("size = 0").select("id", "piece", "first_token", F.col("size").alias("n_tokens"), F.lit(capacity).alias("tier"), F.lit(0).cast("bigint").alias("window_no"), F.lit(0).cast("bigint").alias("container_id"), F.lit(0).cast("bigint").alias("step_group"))
    return out.unionByName(none)


def pack_all(sizes: DataFrame, specs: DataFrame) -> DataFrame:
    """pack() for every row of specs (spec_id int, capacity int), with spec_id and capacity. Null capacities don't count.

    Specs are read on the driver, one after another, and each is a plan of its own: thousands are possible, but slow.
    """
    sizes = cut(sizes.select("id", "n_tokens"), "sizes")
    out = None
    for spec in specs.where("capacity is not null").select("spec_id", "capacity").distinct().orderBy("spec_id", "capacity").toLocalIterator():
        one = pack(sizes, spec["capacity"]).select(F.lit(spec["spec_id"]).alias("spec_id"), F.lit(spec["capacity"]).alias("capacity"), "*")
        out = one if out is None else out.unionByName(one)
    if out is None:
        schema = "spec_id int, capacity int, id bigint, piece bigint, first_token bigint, n_tokens int, tier int, window_no bigint, container_id bigint, step_group bigint"
        return sizes.sparkSession.createDataFrame([], schema)
    return out
