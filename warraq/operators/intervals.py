"""Continuous periods and gaps of overlapping integer intervals, by compressed run bitmaps.

Every interval is laid down as a few 64-bit masks. A mask of level l covers 64 neighbouring units of 64**l time units each, so
an interval of any length needs at most two masks per level (twelve for the whole 32-bit domain): its inner part is a run of
coarse units, only its edges are fine. Masks of one entity, level and word are united by ``bit_or``, which combines before the
shuffle; after it the number of rows no longer depends on how often a place is covered, so an entity with a third of all rows
is no hot spot. Set runs and clear runs are then read off per entity and time shard of 64**3 units, and what touches a shard's
edge is joined over the shards of the entity (at most 2**32 / 64**3 = 16,384 of them).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import Window as W

LEVELS = 6  # 64**6 exceeds the 32-bit domain
SHARD_LEVEL = 3
SHARD_BITS = 6 * SHARD_LEVEL
_BIAS = 1 << 31


def _pieces(a: Column, end: Column) -> Column:
    """Masks of the half-open range [a, end) of biased units: array<struct<level, word, mask>>."""

    out = []
    for l in range(LEVELS):
        lo, hi = _ceil_shift(a, 6 * l), F.shiftright(end, 6 * l)
        up_lo, up_hi = _ceil_shift(a, 6 * (l + 1)), F.shiftright(end, 6 * (l + 1))
        single = up_lo > up_hi
        left_end = F.when(single, hi).otherwise(up_lo * 64)
        left_word = F.when(single, up_hi).otherwise(up_lo - 1)
        right_start = up_hi * 64
        out.append(F.when((lo < hi) & (lo < left_end), _piece(l, left_word, lo, left_end)))
        out.append(F.when((lo < hi) & ~single & (right_start < hi), _piece(l, up_hi, right_start, hi)))
    return F.filter(F.array(*out), lambda x: x.isNotNull())


def _ceil_shift(x: Column, bits: int) -> Column:
    return F.shiftright(x + ((1 << bits) - 1), bits)


def _piece(level: int, word: Column, lo: Column, hi: Column) -> Column:
    ones = F.lit(-1).cast("bigint")
    shift = lambda f, n: F.call_function(f, ones, n.cast("int"))
    mask = shift("shiftleft", lo - word * 64).bitwiseAND(shift("shiftrightunsigned", word * 64 + 64 - hi))
    return F.struct(F.lit(level).alias("level"), word.alias("word"), mask.alias("mask"))


def _runs(mask: Column) -> Column:
    """The runs of set bits of a 64-bit mask: array<struct<s, e>>, both included."""
    bits = F.sequence(F.lit(0), F.lit(63))
    starts = mask.bitwiseAND(F.bitwise_not(F.shiftleft(mask, 1)))
    ends = mask.bitwiseAND(F.bitwise_not(F.shiftrightunsigned(mask, 1)))
    of = lambda m: F.filter(bits, lambda i: F.getbit(m, i) == 1)
    return F.zip_with(of(starts), of(ends), lambda s, e: F.struct(s.alias("s"), e.alias("e")))


def periods_and_gaps(df: DataFrame, entity: list[Column], start: Column, end: Column) -> DataFrame:
    """The longest runs of covered units (``kind`` = period) and the uncovered units between neighbouring ones (gap), per entity.

    entity: named columns; start, end: int, both included. Result: the entity's columns, kind, from_unit, to_unit (int).
    A row with a null bound or start > end covers nothing; a null entity is an entity of its own; repeated rows change nothing;
    an empty table gives no row. Other columns of df don't matter.
    """
    keys = [f"_k{i}" for i in range(len(entity))]
    names = df.select(*entity).columns
    biased = lambda c: c.cast("bigint") + _BIAS
    rows = df.select(*(c.alias(k) for c, k in zip(entity, keys)), biased(start).alias("_a"), (biased(end) + 1).alias("_b"))
    masks = (
        rows.where("_a < _b")
        .select(*keys, F.explode(_pieces(F.col("_a"), F.col("_b"))).alias("p"))
        .groupBy(*keys, F.col("p.level").alias("level"), F.col("p.word").alias("word"))
        .agg(F.bit_or("p.mask").alias("mask"))
    )
    unit = F.expr("shiftleft(bigint(1), int(6 * level))")
    runs = masks.select(*keys, "level", "word", F.explode(_runs(F.col("mask"))).alias("r")).select(
        *keys, "level", ((F.col("word") * 64 + F.col("r.s")) * unit).alias("f"), ((F.col("word") * 64 + F.col("r.e") + 1) * unit - 1).alias("t")
    )
    shard = lambda c: F.shiftright(c, SHARD_BITS)
    # A coarse run covers whole shards: one row for each. The masks are united by now, so no shard comes more than LEVELS times.
    runs = runs.select(*keys, "f", "t", F.explode(F.sequence(shard(F.col("f")), shard(F.col("t")))).alias("shard"))
    first, last = F.shiftleft(F.col("shard"), SHARD_BITS), F.shiftleft(F.col("shard") + 1, SHARD_BITS) - 1
    runs = runs.select(*keys, "shard", F.greatest("f", first).alias("f"), F.least("t", last).alias("t"))

    in_shard = W.partitionBy(*keys, "shard").orderBy("f", "t")
    before = F.max("t").over(in_shard.rowsBetween(W.unboundedPreceding, -1))
    merged = (
        runs.withColumn("new", F.when(F.col("f") <= before + 1, 0).otherwise(1))
        .withColumn("run", F.sum("new").over(in_shard))
        .groupBy(*keys, "shard", "run")
        .agg(F.min("f").alias("f"), F.max("t").alias("t"))
    )
    merged = merged.withColumn("next", F.lead("f").over(W.partitionBy(*keys, "shard").orderBy("f")))
    inner_gaps = merged.where("next is not null").select(*keys, F.lit("gap").alias("kind"), (F.col("t") + 1).alias("f"), (F.col("next") - 1).alias("t"))
    touches = (F.col("f") == first) | (F.col("t") == last)
    inner = merged.where(~touches).select(*keys, F.lit("period").alias("kind"), "f", "t")

    over_shards = W.partitionBy(*keys).orderBy("f")
    edge = (
        merged.where(touches)
        .withColumn("new", F.when(F.lag("t").over(over_shards) == F.col("f") - 1, 0).otherwise(1))
        .withColumn("run", F.sum("new").over(over_shards))
        .groupBy(*keys, "run")
        .agg(F.min("f").alias("f"), F.max("t").alias("t"))
        .select(*keys, F.lit("period").alias("kind"), "f", "t")
    )
    outer_gaps = (
        merged.groupBy(*keys, "shard")
        .agg(F.min("f").alias("f"), F.max("t").alias("t"))
        .withColumn("next", F.lead("f").over(W.partitionBy(*keys).orderBy("shard")))
        .where("next > t + 1")
        .select(*keys, F.lit("gap").alias("kind"), (F.col("t") + 1).alias("f"), (F.col("next") - 1).alias("t"))
    )
    whole = inner.unionByName(edge).unionByName(inner_gaps).unionByName(outer_gaps)
    back = lambda c: (F.col(c) - _BIAS).cast("int")
    return whole.select(*(F.col(k).alias(n) for k, n in zip(keys, names)), "kind", back("f").alias("from_unit"), back("t").alias("to_unit"))
