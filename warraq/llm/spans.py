"""Long exact spans shared between texts, by recompression.

A text starts as one phrase per code point. Every round compresses runs (neighbouring phrases of one name) and pairs (a phrase
whose name hashes to 0, followed by one that hashes to 1), among phrases of at most CAPS[round] code points. A phrase's name is
the hash of what it expands to, so names are the same in every task without a dictionary that would have to be exchanged: the
rounds need no shuffle. Whether a border between two phrases falls in a round depends on the names of the two alone, so whether
it outlives all rounds depends on sum(CAPS) = 31 code points on either side: equal substrings keep equal borders inside.
A border that a run swallowed is still announced, so announced borders are at most 2 * CAPS[-1] = 18 apart. Of 80 shared code
points at least one border therefore lies 31 or more from both ends, in both texts: 31 + 31 + 18 = 80. Each border announces one
high-level symbol, the name of the 62 code points around it; symbols that two texts share reveal every shared span of 80 or more,
and the code points around the border verify it. No span is lost, and none is reported that isn't there.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from warraq.plans.materialize import cut

CAPS = (1, 2, 3, 4, 5, 7, 9)
REACH = sum(CAPS)
LEAST = 2 * REACH + 2 * CAPS[-1]
#: A symbol that occurs this often in one group of texts (GROUP code points) is spread over SALTS tasks.
OFTEN = 8
SALTS = 256
GROUP = 1 << 19
#: Bytes of input files for each task of the symbols' exchange, and tasks at most.
TASK_BYTES = 2 << 20
MOST_TASKS = 1 << 15
#: Ids up to this many (8 bytes each) are broadcast to the scan for texts; more are joined by shuffle.
BROADCAST_IDS = 500_000

_BASE = 0x9E3779B97F4A7C15 | 1
_SECOND_BASE = 0xD1B54A32D192ED03


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    steps = np.full(n, base, dtype=np.uint64)
    steps[0] = 1
    return np.cumprod(steps)


class _Names:
    """Names of substrings of a concatenation: position-free hashes from one running sum."""

    def __init__(self, points: np.ndarray, base: int = _BASE):
        n = len(points) + 1
        self.sums = np.zeros(n, dtype=np.uint64)
        np.cumsum(_mix(points.astype(np.uint64) + np.uint64(base & 0xFFFF)) * _powers(base, n - 1), out=self.sums[1:])
        self.back = _powers(pow(base, -1, 1 << 64), n)

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mix((self.sums[end] - self.sums[start]) * self.back[start])


def _points(texts: list[str]) -> np.ndarray:
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def borders(points: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The announced borders of texts laid end to end, starts: where each text begins."""
    names = _Names(points)
    n = len(points)
    pos = np.arange(n, dtype=np.int64)
    fixed = np.zeros(n, dtype=bool)
    fixed[starts[starts < n]] = True
    kept = []
    for k, cap in enumerate(CAPS):
        end = np.append(pos[1:], n)
        name = names(pos, end)
        short = end - pos <= cap
        bit = (_mix(name ^ np.uint64((k + 1) * 0x5851F42D4C957F2D & (1 << 63) - 1)) >> np.uint64(63)).astype(bool)
        both = np.zeros(len(pos), dtype=bool)
        both[1:] = short[1:] & short[:-1] & ~fixed[pos[1:]]
        run = both.copy()
        run[1:] &= name[1:] == name[:-1]
        pair = both.copy()
        pair[1:] &= ~bit[:-1] & bit[1:]
        kept.append(pos[run])
        pos = pos[~(run | pair)]
    return np.unique(np.concatenate([pos, *kept]))


def symbols(ids: np.ndarray, texts: list[str]) -> pd.DataFrame:
    """id, symbol, before (the symbol at the border before; null for a text's first), pos (the border, 0-based), salt, known.

    known: the symbol occurs OFTEN in these texts and in two ids, so it is shared whatever the other texts hold. Then only its first row
    here has salt 0, where all groups of texts meet; the other rows are spread over the other salts.
    """
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    ends = np.cumsum(lengths)
    starts = ends - lengths
    points = _points(texts)
    at = borders(points, starts)
    of = np.searchsorted(ends, at, side="right")
    inside = (at - starts[of] >= REACH) & (ends[of] - at >= REACH)
    at, of = at[inside], of[inside]
    symbol = _Names(points)(at - REACH, at + REACH).view(np.int64)
    first = np.ones(len(at), dtype=bool)
    first[1:] = of[1:] != of[:-1]
    before = pd.array(np.roll(symbol, 1), dtype="Int64")
    before[first] = pd.NA
    order = np.argsort(symbol, kind="stable")
    new = np.ones(len(at), dtype=bool)
    new[1:] = symbol[order][1:] != symbol[order][:-1]
    begin = np.flatnonzero(new)
    until = np.append(begin, len(at))[1:]
    often = (until - begin >= OFTEN) & (ids[of[order[begin]]] != ids[of[order[until - 1]]])
    known = np.zeros(len(at), dtype=bool)
    known[order] = np.repeat(often, until - begin)
    salt = np.where(known, 1 + np.arange(len(at)) % SALTS, 0).astype(np.int32)
    salt[order[begin]] = 0
    return pd.DataFrame({"id": ids[of], "symbol": symbol, "before": before, "pos": (at - starts[of]).astype(np.int32), "salt": salt, "known": known})


def _tasks(df: DataFrame) -> int:
    """How many tasks the symbols of df's texts need: by the bytes of the files it reads, at least as many as the session's setting."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    size = sum(int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size()))
    usual = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # What isn't read from files has no known size, which Spark gives as 2 ** 63 - 1.
    return usual if size > 1 << 60 else max(usual, min(MOST_TASKS, -(-size // TASK_BYTES)))


def _announce(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        ids, texts = b["id"].to_numpy(), b["text"].tolist()
        group: list[int] = []
        size = 0
        for i, t in enumerate(texts):
            group.append(i)
            size += len(t)
            if size > GROUP or i + 1 == len(texts):
                yield symbols(ids[group], [texts[j] for j in group])
                group, size = [], 0


def _shared_borders(texts: DataFrame, least: int) -> DataFrame:
    """id, copy_of, symbol, before, pos, left, right of every border whose symbol two distinct ids announce.

    left and right are up to ``least`` code points beside the border. copy_of is the least id of equal texts; borders come once
    for it, with its own id, and ids of equal texts come with a null symbol.
    """
    long = texts.where(F.length("text") >= least)
    schema = "id bigint, symbol bigint, before bigint, pos int, salt int, known boolean"
    told = long.mapInPandas(_announce, schema).repartition(_tasks(long), "symbol", "salt")
    # Asking for all columns keeps both sides of the join below on one exchange, so texts are parsed and symbols shuffled once.
    shared = (
        told.groupBy("symbol", "salt")
        .agg(F.min("id").alias("lo"), F.max("id").alias("hi"), F.max("before").alias("b"), F.max("pos").alias("p"), F.max("known").alias("ever"))
        .where("(ever or lo < hi) and coalesce(b, p) is not null")
        .select("symbol", "salt", "ever", "lo", "hi")
    )
    hot = cut(told.join(shared.hint("shuffle_hash"), ["symbol", "salt"]).where("known or ever or lo < hi").select("id", "symbol", "before", "pos").dropDuplicates(["id", "pos"]), "symbols")
    ids = hot.select("id").distinct()
    bounded = ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    owners = long.join(F.broadcast(ids) if bounded else ids, "id", "left_semi").groupBy("id").agg(F.min("text").alias("text"))
    hashes = [F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(1), F.reverse("text")).alias("h2"), F.length("text").alias("n")]
    owners = cut(owners.select("id", "text", *hashes), "texts")
    classes = owners.groupBy("h1", "h2", "n").agg(F.min("id").alias("copy_of"))
    owners = owners.join(classes, ["h1", "h2", "n"]).select("id", "copy_of", "text")
    beside = [
        F.expr(f"substring(text, greatest(pos - {least}, 0) + 1, least(pos, {least}))").alias("left"),
        F.expr(f"substring(text, pos + 1, {least})").alias("right"),
    ]
    spots = owners.where("id = copy_of").join(hot, "id").select("id", F.col("id").alias("copy_of"), "symbol", "before", "pos", *beside)
    none = [F.lit(None).cast(t).alias(c) for c, t in (("symbol", "bigint"), ("before", "bigint"), ("pos", "int"), ("left", "string"), ("right", "string"))]
    return cut(spots.unionByName(owners.where("id <> copy_of").select("id", "copy_of", *none)), "borders")


@F.pandas_udf(StructType([StructField("left", IntegerType()), StructField("right", IntegerType())]))
def _common(left_a: pd.Series, right_a: pd.Series, left_b: pd.Series, right_b: pd.Series) -> pd.DataFrame:
    """Code points in common before and after two borders."""

    def prefix(a: str, b: str) -> int:
        n = min(len(a), len(b))
        if a[:n] == b[:n]:
            return n
        lo, hi = 0, n
        while lo + 1 < hi:
            mid = (lo + hi) // 2
            lo, hi = (mid, hi) if a[lo:mid] == b[lo:mid] else (lo, mid)
        return lo

    pairs = zip(left_a, right_a, left_b, right_b)
    return pd.DataFrame([(prefix(la[::-1], lb[::-1]), prefix(ra, rb)) for la, ra, lb, rb in pairs], columns=["left", "right"])


def _meetings(spots: DataFrame) -> DataFrame:
    """Borders of two texts under one symbol: each shared span once, at its first border."""
    s = spots.where("symbol is not null")
    a = s.select("symbol", *(F.col(c).alias(f"{c}_a") for c in ("id", "before", "pos", "left", "right")))
    b = s.select("symbol", *(F.col(c).alias(f"{c}_b") for c in ("id", "before", "pos", "left", "right")))
    return a.join(b, "symbol").where("id_a < id_b and (before_a is null or before_b is null or before_a <> before_b)")


def shared_pairs(texts: DataFrame, least: int = LEAST) -> DataFrame:
    """Pairs of ids whose texts have a run of ``least`` or more code points in common.

    texts: id bigint, text string. least: 80 or more. Result: id_a < id_b, no pair twice; copies of a text are paired with one
    another and with all partners of the text. Null, empty and shorter texts, and a row without id, give no pair; a repeated id counts once; no row for an
    empty table.
    """
    if least < LEAST:
        raise ValueError(f"least must be {LEAST} or more")
    texts = texts.select("id", "text").where("id is not null and text is not null")
    spots = _shared_borders(texts, least)
    common = _common("left_a", "right_a", "left_b", "right_b")
    # A span's first border has no text in common further left, but where the border before is cut off by the text's start.
    pairs = _meetings(spots).withColumn("c", common).where(f"c.left + c.right >= {least}").select("id_a", "id_b").distinct()
    members = spots.select("copy_of", "id").distinct()
    wide = (
        pairs.join(members.withColumnsRenamed({"copy_of": "id_a", "id": "a"}), "id_a")
        .join(members.withColumnsRenamed({"copy_of": "id_b", "id": "b"}), "id_b")
        .select("a", "b")
    )
    of_copies = members.alias("x").join(members.alias("y"), "copy_of").where("x.id < y.id").select(F.col("x.id").alias("a"), F.col("y.id").alias("b"))
    return wide.select(F.least("a", "b").alias("id_a"), F.greatest("a", "b").alias("id_b")).unionByName(of_copies.toDF("id_a", "id_b"))


@F.pandas_udf(StructType([StructField("h", ArrayType(LongType())), StructField("g", ArrayType(LongType()))]))
def _windows(left: pd.Series, right: pd.Series, least: pd.Series) -> pd.DataFrame:
    """Names of the stretches of ``least`` code points with the border at least REACH from both ends, the leftmost border first, by two independent hashes; 0 where the text is too short."""
    texts = [a + b for a, b in zip(left, right)]
    ends = np.cumsum([len(t) for t in texts], dtype=np.int64)[:, None]
    begins = ends - np.array([len(t) for t in texts], dtype=np.int64)[:, None]
    n = int(least.iloc[0]) if len(least) else 2 * REACH
    start = begins + np.array([len(a) for a in left], dtype=np.int64)[:, None] - np.arange(REACH, n - REACH + 1)
    fits = (start >= begins) & (start + n <= ends)
    points = _points(texts)
    out = {}
    for c, base in (("h", _BASE), ("g", _SECOND_BASE)):
        name = np.zeros(start.shape, dtype=np.int64)
        name[fits] = _Names(points, base)(start[fits], start[fits] + n).view(np.int64)
        out[c] = list(name)
    return pd.DataFrame(out)


def shared_share(texts: DataFrame, least: int = LEAST) -> DataFrame:
    """Of every text, how many code points lie in runs of ``least`` or more that another id's text has too.

    Result: id, n_chars, shared_chars, shared_share (0 for an empty text). A null text gives nulls; a repeated id counts once. No pairs
    are made: of each shared border the stretches of ``least`` code points around it are named and counted, so a passage in a third of
    all texts costs no more than its occurrences. A name has 128 bits, of two independent hashes: among 10^12 stretches two different
    ones come under one name with a probability of about 10^-14.
    """
    if least < LEAST:
        raise ValueError(f"least must be {LEAST} or more")
    rows = texts.select("id", "text").where("id is not null")
    spots = _shared_borders(rows.where("text is not null"), least)
    borders_ = spots.where("symbol is not null").select("id", "pos", _windows("left", "right", F.lit(least)).alias("w"))
    each = borders_.select("id", "pos", F.posexplode(F.arrays_zip("w.h", "w.g")).alias("k", "n")).where("n.h <> 0").select("id", (F.col("pos") - REACH - F.col("k")).alias("f"), "n.h", "n.g")
    common = each.groupBy("h", "g").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo < hi").select("h", "g")
    order = W.partitionBy("id").orderBy("f")
    hit = each.join(common, ["h", "g"]).select("id", "f").distinct()
    new = F.least(F.lit(least), F.col("f") - F.coalesce(F.lag("f").over(order), F.lit(-least)))
    covered = hit.withColumn("new", new).groupBy("id").agg(F.sum("new").alias("covered")).withColumnRenamed("id", "copy_of")
    copies = spots.groupBy("copy_of").agg(F.count_distinct("id").alias("n_copies"))
    of = spots.select("id", "copy_of").distinct().join(copies, "copy_of").join(covered, "copy_of", "left")
    lengths = rows.groupBy("id").agg(F.max(F.length("text")).alias("n_chars"))
    shared = F.when(F.col("n_copies") > 1, F.col("n_chars")).otherwise(F.coalesce("covered", F.lit(0)))
    out = lengths.join(of, "id", "left").withColumn("shared_chars", F.when(F.col("n_chars").isNotNull(), F.coalesce(shared, F.lit(0)).cast("int")))
    share = F.when(F.col("n_chars") == 0, 0.0).otherwise(F.col("shared_chars") / F.col("n_chars"))
    return out.select("id", "n_chars", "shared_chars", share.alias("shared_share"))
