"""Mixing sources to target weights: repetition rates, whole copies and a Bernoulli copy."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rates(sizes: DataFrame, targets: DataFrame, total_tokens: int | None = None) -> DataFrame:
    """source, target_share, max_repeats, n_docs, available_tokens, rate (how often to take a document, on average).

    targets: source, target_share, max_repeats. rate = min(max_repeats, target_share * total / available), total being
    ``total_tokens`` or else all tokens of the listed sources. A listed source without tokens has rate 0; a source that isn't
    listed isn't taken. Null shares and repeats count as 0; a source listed twice counts with its largest share and repeats.
    """
    t = targets.where("source is not null").groupBy("source").agg(F.coalesce(F.max("target_share"), F.lit(0.0)).alias("target_share"), F.coalesce(F.max("max_repeats"), F.lit(0)).alias("max_repeats"))
    s = sizes.groupBy("source").agg(F.count("*").alias("n_docs"), F.sum("n_tokens").alias("available_tokens"))
    both = t.join(s, "source", "left").na.fill(0, ["n_docs", "available_tokens"])
    if total_tokens is None:
        # One number for all sources, joined to the few listed ones.
        both = both.crossJoin(F.broadcast(both.agg(F.sum("available_tokens").alias("total"))))
    else:
        both = both.withColumn("total", F.lit(total_tokens))
    rate = F.least(F.col("max_repeats").cast("double"), F.col("target_share") * F.col("total") / F.col("available_tokens"))
    return both.withColumn("rate", F.when(F.col("available_tokens") > 0, rate).otherwise(0.0)).drop("total")


def mix(sizes: DataFrame, rate: DataFrame, seed: int = 42) -> DataFrame:
    """The chosen documents: id, source, n_tokens, copy_no (from 1), one row a copy.

    Every document comes floor(rate) times and once more with probability rate - floor(rate), decided by a hash of its id and
    the seed: the same on any cluster. sizes: id, source, n_tokens, ids unique.
    """
    # 53 bits of the hash, as a number in [0, 1).
    chance = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col("id")), 11) / float(1 << 53)
    copies = F.floor("rate") + F.when(chance < F.col("rate") - F.floor("rate"), 1).otherwise(0)
    taken = sizes.select("id", "source", "n_tokens").where("id is not null").join(rate.where("rate > 0").select("source", "rate"), "source").withColumn("copies", copies.cast("int")).where("copies > 0")
    return taken.select("id", "source", "n_tokens", F.explode(F.expr("sequence(1, copies)")).alias("copy_no"))


def shares(mixed: DataFrame, rate: DataFrame) -> DataFrame:
    """Of every listed source: target_share, rate, n_docs, n_copies, taken_tokens, actual_share, capped (its repeats fell short of the share)."""
    got = mixed.groupBy("source").agg(F.count("*").alias("n_copies"), F.sum("n_tokens").alias("taken_tokens"))
    both = rate.join(got, "source", "left").na.fill(0, ["n_copies", "taken_tokens"])
    both = both.crossJoin(F.broadcast(got.agg(F.sum("taken_tokens").alias("total"))))
    share = F.when(F.col("total") > 0, F.col("taken_tokens") / F.col("total")).otherwise(0.0)
    return both.select("source", "target_share", "max_repeats", "n_docs", "available_tokens", "rate", "n_copies", "taken_tokens", share.alias("actual_share"), ((F.col("target_share") > 0) & (F.col("rate") >= F.col("max_repeats"))).alias("capped"))
