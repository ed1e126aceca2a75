"""Parts of Arabic personal names, and names of one person in many spellings, by metric-space partitioning.

A name is read into its parts: own name, father and forefathers, nisba, kunya and by-names, whatever their order. Parts of two names
agree when their Damerau-Levenshtein distance d, a true metric, is at most 1. All such pairs of parts come from an exact radius join
over a partition of the metric space by pivots. Pivots are words of our own making: for a set S of letters, p_S repeats the letters
of S in turn so often that every word over S stands in it. Hence d(x, p_S) = |p_S| - (letters of x that are in S), which needs no
recurrence, and a cell, the words at the same distances from all pivots, is the words of one bag of letters. Within the radius of x,
no distance to a pivot differs by more than 1 (triangle inequality), for all S at once: a neighbour's bag has at most one letter more
and one letter less. Words at a cell's boundary are therefore replicated to the bags they leave by losing one letter, where any two
words within the radius meet, and there the true metric decides. A word takes one seat for each of its distinct letters and one at
home, however many words there are; the words that can meet in one cell are bounded by the alphabet, not by the data.

Two names meet when two of their parts agree (own name and father, own name and nisba, ...), one exactly and the other within the
radius; whether they are the same person's is decided by the odds of all their parts and attributes.
"""

from __future__ import annotations

import re
import warnings

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from warraq.llm.lookalikes import ARABIC_LIKE, plain
from warraq.plans.materialize import cut

# Words inside names.
CONNECTORS = ("بن", "ابن", "بنت", "ب", "ابنه")
KUNYA = ("ابو", "ابي", "ابا", "ام")
HONORIFICS = ("رضي الله عنه", "رضي الله عنها", "رضي الله عنهما", "رحمه الله", "رحمها الله", "عليه السلام", "صلي الله عليه وسلم", "رضي الله تعالي عنه")
NAMED, KNOWN_AS = {"واسمه", "اسمه", "واسمها", "اسمها"}, {"الملقب", "المعروف", "يلقب", "الملقبه"}
OWNER = {"ذو", "ذي", "ذا", "ذات"}
SERVANT = "عبد"

_DROP = re.compile("[ؐ-ًؚ-ٰٟـﷰ-﷿]")
_OTHER = re.compile(r"[^\w\s.،,]")
_LONGEST_FIRST = sorted(HONORIFICS, key=len, reverse=True)
_SAME = str.maketrans({**ARABIC_LIKE, "أ": "ا", "إ": "ا", "آ": "ا", "ٱ": "ا", "ى": "ي", "ة": "ه", "ؤ": "و", "ئ": "ي", "گ": "ك"})
PARTS = StructType([StructField("chain", ArrayType(StringType())) if c == "chain" else StructField(c, StringType()) for c in ("own", "chain", "nisba", "kunya", "laqab", "sex")])


def simple(text: str) -> str:
    """The spelling in which names are compared: ordinary letters without marks, hamza, dots of teh marbuta and yeh set aside."""
    text = _DROP.sub("", plain(text)).translate(_SAME)
    text = " ".join(_OTHER.sub(" ", text).replace(",", "،").split())
    if "الله" in text or "السلام" in text:
        for h in _LONGEST_FIRST:
            text = text.replace(h, " ")
        text = " ".join(text.split())
    return text


def close(x: str, y: str) -> bool:
    """Whether two words are at a distance of at most 1."""
    if abs(len(x) - len(y)) > 1:
        return False
    while x and y and x[0] == y[0]:
        x, y = x[1:], y[1:]
    while x and y and x[-1] == y[-1]:
        x, y = x[:-1], y[:-1]
    return max(len(x), len(y)) <= 1 or (len(x) == len(y) == 2 and x == y[::-1])


def _tokens(text: str) -> list[str]:
    raw = text.replace("،", " ، ").split()
    out: list[str] = []
    for t, after in zip(raw, [*raw[1:], ""]):
        before = out[-1] if out else ""
        # A nisba stands after a name too, but no connector follows it.
        mistyped = t.startswith("ال") and (not t.endswith("ي") or after in CONNECTORS) and before not in CONNECTORS and before and close(before, SERVANT)
        if before == SERVANT and t != "،" and t not in CONNECTORS or mistyped:
            out[-1] = SERVANT + t
        else:
            out.append(t if "." not in t or re.fullmatch(r"\w\.", t) else t.replace(".", ""))
    return [t for t in out if t]


def _connects(t: str, between: bool) -> bool:
    """Whether t is a connector; between two names also one of which a letter is mistyped, or what is too short for a name."""
    return t in CONNECTORS or between and (len(t) <= 2 or any(close(t, c) for c in CONNECTORS if len(c) > 1))


def _leads_kunya(tokens: list[str], i: int, leading: bool) -> bool:
    """Whether a kunya begins at i; before the own name, where that and a connector follow, also with a letter mistyped."""
    t = tokens[i]
    if t not in KUNYA and (not leading or t in CONNECTORS or not any(close(t, k) for k in KUNYA)):
        return False
    after = tokens[i + 1 : i + 4]
    if not after or after[0] == "،":
        return False
    if t in KUNYA:
        return after[0] not in CONNECTORS
    if len(after) < 3:
        return False
    return not any(x == "،" or x.startswith("ال") or _connects(x, True) for x in after[:2]) and _connects(after[2], True)


def parse(name: str | None) -> tuple[str | None, list[str], str | None, str | None, str | None, str | None]:
    """own name, chain of forefathers, nisba, kunya, by-name, sex (f, m). What isn't there is None; an empty or null name has no parts."""
    own = nisba = kunya = laqab = None
    chain: list[str] = []
    sex = None
    tokens = _tokens(simple(name)) if name else []
    i, n = 0, len(tokens)
    linked = False
    while i < n:
        t = tokens[i]
        after = tokens[i + 1] if i + 1 < n else None
        if t == "،":
            linked = False
        elif t in NAMED and after:
            own, i = after, i + 1
        elif t in KNOWN_AS and after:
            laqab, i = after, i + 1
        elif (t in OWNER or len(t) == 2 and t[0] == "ذ") and after and after.startswith("ال") and not linked:
            laqab, i = after, i + 1
        elif not linked and _leads_kunya(tokens, i, own is None):
            kunya, i = after, i + 1
            sex = "f" if t.startswith("ام") else sex or "m"
        elif _connects(t, not linked and (own is not None or i > 0 and tokens[i - 1] == laqab)) and after and after != "،" and (own is not None or i == 0 or tokens[i - 1] in ("،", kunya, nisba, laqab) or len(t) > 1):
            linked = True
            sex = "f" if own and not chain and (t.startswith("بنت") or t == "بت") else sex or ("m" if own else None)
            i += 1
            continue
        elif not linked and (t.startswith("ال") and len(t) > 3 or own is None and after and (after == "،" or _leads_kunya(tokens, i + 1, True))):
            # With the article, or, its article mistyped, alone before a comma or a kunya.
            if t.endswith("ي"):
                nisba = t
            else:
                laqab = t
        elif linked:
            chain.append(t)
        elif own is None:
            own = t
        else:
            chain.append(t)
        linked = False
        i += 1
    return own, chain, nisba, kunya, laqab, sex


@F.pandas_udf(PARTS)
def parts(name: pd.Series, norm: pd.Series) -> pd.DataFrame:
    rows = [parse(a if isinstance(a, str) and a.strip() else b if isinstance(b, str) else None) for a, b in zip(name, norm)]
    return pd.DataFrame(rows, columns=["own", "chain", "nisba", "kunya", "laqab", "sex"])


@F.pandas_udf(StringType())
def kunya_of(text: pd.Series) -> pd.Series:
    """The kunya of a column that holds nothing else."""

    def one(t):
        p = parse(t) if isinstance(t, str) else (None,) * 6
        return p[3] or p[0]

    return text.map({t: one(t) for t in text.unique()}).astype(object)


@F.pandas_udf(StringType())
def place(text: pd.Series) -> pd.Series:
    return text.map({t: simple(t) or None if isinstance(t, str) else None for t in text.unique()}).astype(object)


def near(x: Column, y: Column) -> Column:
    """Whether two words are at a distance of at most 1, as close() has it."""
    at = lambda i, n=1: F.substr(y, i, F.lit(n))
    swapped = F.exists(F.sequence(F.lit(1), F.length(y) - 1), lambda i: x == F.concat(F.substr(y, F.lit(1), i - 1), at(i + 1), at(i), F.substr(y, i + 2)))
    return (F.levenshtein(x, y, 1) >= 0) | ((F.length(x) == F.length(y)) & (F.levenshtein(x, y, 2) == 2) & swapped)


def _cells(word: Column) -> Column:
    """The bag of a word's letters, and each bag that one letter less leaves, as numbers. Two bags under one number would only be words more to compare."""

    def of(bag: Column) -> Column:
        n = F.size(bag)
        # Of equal letters, sorted side by side, the first stands for all.
        less = F.transform(F.sequence(F.lit(1), n), lambda i: F.when((i == 1) | (F.get(bag, i - 1) != F.get(bag, i - 2)), F.xxhash64(F.concat(F.slice(bag, F.lit(1), i - 1), F.slice(bag, i + 1, n)))))
        return F.array_append(F.array_compact(less), F.xxhash64(bag))

    # Bound as a variable, the sorted letters are made once.
    return F.get(F.transform(F.array(F.array_sort(F.split(word, ""))), of), F.lit(0))


def near_parts(words: DataFrame) -> DataFrame:
    """All pairs x, y of distinct words within a distance of 1, both orders, and each word with itself.

    words: word string. Null and empty words don't come; a repeated word counts once; words may be of any length.
    """
    words = cut(words.where("word is not null and word <> ''").select("word").distinct(), "words")
    seats = words.select("word", F.explode(_cells(F.col("word"))).alias("cell"))
    met = seats.toDF("x", "cell").join(seats.toDF("y", "cell"), "cell").where("x < y and abs(length(x) - length(y)) <= 1")
    pairs = met.where(near(F.col("x"), F.col("y"))).select("x", "y").distinct()
    return pairs.unionByName(pairs.toDF("y", "x")).unionByName(words.select(F.col("word").alias("x"), F.col("word").alias("y")))


#: Deaths this many years apart fall into the same or neighbouring periods.
YEARS = 4
VIEWS = (("own", "father"), ("own", "nisba"), ("kunya", "nisba"), ("own", "kunya"), ("own", "town"), ("kunya", "town"))


def profiles(rows: DataFrame) -> DataFrame:
    """Records with their parts: rid, side, own, father, grandfather, great, nisba, kunya, kunya2, laqab, town, death, sex.

    rows: rid bigint, side int, name_ar, name_norm, kunya, town string, death_h int.
    """
    p = rows.select("rid", "side", parts("name_ar", "name_norm").alias("p"), kunya_of("kunya").alias("k"), place("town").alias("town"), F.col("death_h").alias("death"))
    return p.select(
        "rid", "side", "p.own", F.get("p.chain", F.lit(0)).alias("father"), F.get("p.chain", F.lit(1)).alias("grandfather"), F.get("p.chain", F.lit(2)).alias("great"),
        "p.nisba", F.coalesce("p.kunya", "k").alias("kunya"), F.when(F.col("p.kunya") != F.col("k"), F.col("k")).alias("kunya2"), "p.laqab", "town", "death", "p.sex",
    )


#: Records under one key from which on its pairs are spread over several tasks, a task for each so many of them.
HOT = 1000


def meetings(people: DataFrame, across: bool = False, hot: int = HOT) -> DataFrame:
    """Pairs of rids (a < b by side, then rid) two of whose parts agree, one exactly and one within the radius. people: profiles().

    across: only pairs of one record of side 0 and one of side 1. A key with more than ``hot`` records is salted: one of the two records of a pair
    goes to one part of the key, the other to all parts.
    """
    # All views of a record in one pass; a second kunya adds keys of its own to the views of kunyas.
    when = F.floor(F.col("death") / YEARS)
    seen = lambda k: F.concat_ws("|", "town", (when + k).cast("string"))
    key = lambda i, u, v: F.struct(F.lit(i).alias("view"), u.cast("string").alias("u"), v.alias("v"))
    views = [key(i, F.col(x), F.col(y)) for i, uv in enumerate(VIEWS) for x, y in {uv, tuple("kunya2" if c == "kunya" else c for c in uv)}]
    # Names of which only the nisba is common: by it, town and the time of death.
    timed = F.col("nisba").isNotNull() & F.col("town").isNotNull() & F.col("death").isNotNull()
    views.append(key(len(VIEWS), F.when(timed, F.col("nisba")), seen(0)))
    keyed = people.select("rid", "side", F.explode(F.filter(F.array(*views), lambda x: x.u.isNotNull() & x.v.isNotNull() & ~x.u.endswith(".") & ~x.v.endswith("."))).alias("k")).select("rid", "side", "k.*")
    keyed = cut(keyed, "keys")
    by_time = F.col("view") == len(VIEWS)
    words = keyed.select(F.explode(F.when(by_time, F.array("u")).otherwise(F.array("u", "v"))).alias("word"))
    often = cut(words.groupBy("word").agg(F.count("*").alias("n")), "words")
    near_ = near_parts(often).where("x <> y").join(often.toDF("x", "nx"), "x").join(often.toDF("y", "ny"), "y")
    # Being near is mutual, so of two records one is held as it is and the other under its neighbour's part: the one with the rarer part, which is the mistyped one as a rule.
    up = cut(near_.where("struct(nx, x) < struct(ny, y)").select("x", "y"), "near")
    same = keyed.select("rid", "side", "view", "u", "v")
    at_u = keyed.join(up.toDF("u", "w"), "u").select("rid", "side", "view", F.col("w").alias("u"), "v")
    at_v = keyed.where(~by_time).join(up.toDF("v", "w"), "v").select("rid", "side", "view", "u", F.col("w").alias("v"))
    late = people.where(timed).select("rid", "side", F.lit(len(VIEWS)).alias("view"), F.col("nisba").alias("u"), F.explode(F.array(seen(-1), seen(1))).alias("v"))
    beside = late.unionByName(late.join(up.toDF("u", "w"), "u").select("rid", "side", "view", F.col("w").alias("u"), "v"))
    # The three key columns as one number: two keys under one number would only be a pair more to grade.
    held = lambda df, own: df.select(F.col("rid").alias("a"), F.col("side").alias("side_a"), F.xxhash64("view", "u", "v").alias("key"), F.lit(own).alias("own"))
    moved = held(at_u, False).unionByName(held(at_v, False)).unionByName(held(beside, False))
    asked = held(same, True).drop("own").withColumnsRenamed({"a": "b", "side_a": "side_b"})
    crowded = cut(asked.groupBy("key").agg(F.ceil(F.count("*") / hot).cast("int").alias("parts")).where("parts > 1"), "crowded")
    none_crowded = crowded.isEmpty()

    def pairs(left: DataFrame, right: DataFrame) -> DataFrame:
        if none_crowded:
            return left.join(right, "key")
        parts = F.coalesce("parts", F.lit(1))
        one = left.join(crowded, "key", "left").withColumn("part", F.pmod(F.xxhash64("a"), parts)).drop("parts")
        every = right.join(crowded, "key", "left").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), parts.cast("long") - 1))).drop("parts")
        return one.join(every, ["key", "part"]).drop("part")

    first = (F.col("side_a") < F.col("side_b")) | ((F.col("side_a") == F.col("side_b")) & (F.col("a") < F.col("b")))
    if across:
        side = lambda df, k: df.where(F.col(df.columns[1]) == k)
        met = pairs(side(held(same, True).unionByName(moved), 1), side(asked, 0)).unionByName(pairs(side(moved, 0), side(asked, 1)))
    else:
        met = pairs(held(same, True).unionByName(moved), asked).where(F.when(F.col("own"), first).otherwise(F.col("a") != F.col("b")))
    return met.select(F.when(first, F.col("a")).otherwise(F.col("b")).alias("a"), F.when(first, F.col("b")).otherwise(F.col("a")).alias("b")).distinct()


def _grade(x: Column, y: Column) -> Column:
    """0 unknown, 1 equal, 2 near or a fitting initial, 3 different."""
    initial = (x.endswith(".") | y.endswith(".")) & (F.substring(x, 1, 1) == F.substring(y, 1, 1))
    return F.when(x.isNull() | y.isNull(), 0).when(x == y, 1).when(initial | near(x, y), 2).otherwise(3)


MOVED = 1e-4
#: log-odds of a different own name, at most.
OTHER_NAME = -4.5
FIELDS = ("own", "father", "grandfather", "great", "nisba", "kunya", "town", "death")
#: Where the estimation starts: the grades of one person's fields, and of two persons' who met. Per field: equal, near, different.
START_SAME = ((0.85, 0.12, 0.03),) * 5 + ((0.8, 0.12, 0.08), (0.85, 0.1, 0.05), (0.5, 0.4, 0.1))
START_OTHER = ((0.6, 0.1, 0.3), (0.2, 0.05, 0.75), (0.05, 0.02, 0.93), (0.05, 0.02, 0.93), (0.3, 0.05, 0.65), (0.1, 0.02, 0.88), (0.1, 0.02, 0.88), (0.02, 0.03, 0.95))


def graded(pairs: DataFrame, people: DataFrame) -> DataFrame:
    """pairs (a, b) with the grade of each field, and, if people have n, the records they stand for, n, the pairs they stand for, and persons, the records a stands for. Kunyas agree if any two do; years are near within three, or with their figures in another order."""
    of = lambda x: people.select(F.col("rid").alias(x), *(F.col(c).alias(f"{c}_{x}") for c in people.columns if c not in ("rid", "side")))
    both = pairs.join(of("a"), "a").join(of("b"), "b")
    g = {f: _grade(F.col(f"{f}_a"), F.col(f"{f}_b")) for f in FIELDS if f not in ("kunya", "death")}
    kunya = [_grade(F.col(f"{k}_a"), F.col(f"{m}_b")) for k in ("kunya", "kunya2") for m in ("kunya", "kunya2")]
    g["kunya"] = F.coalesce(F.least(*(F.when(k > 0, k) for k in kunya)), F.lit(0))
    apart = F.abs(F.col("death_a") - F.col("death_b"))
    figures = lambda x: F.array_sort(F.split(F.col(f"death_{x}").cast("string"), ""))
    g["death"] = F.when(apart.isNull(), 0).when(apart == 0, 1).when((apart <= 3) | (figures("a") == figures("b")), 2).otherwise(3)
    g["own"] = F.when(F.col("sex_a") != F.col("sex_b"), 3).otherwise(g["own"])
    n = [(F.col("n_a") * F.col("n_b")).alias("n"), F.col("n_a").alias("persons")] if "n" in people.columns else []
    return both.select("a", "b", *(g[f].cast("int").alias(f) for f in FIELDS), *n)


def odds(grades: DataFrame, rounds: int = 500) -> tuple[dict, float]:
    """log-odds of each grade of each field, and of a pair before anything is known, by expectation-maximization over all pairs.

    It ends when no probability moves by MOVED any more, and warns if that doesn't come within ``rounds``.

    At most 4 ** len(FIELDS) patterns of grades reach the driver, with their counts.
    """
    rows = grades.groupBy(*FIELDS).agg((F.sum("n") if "n" in grades.columns else F.count("*")).alias("count")).collect()
    if not rows:
        return {f: [0.0] * 4 for f in FIELDS}, 0.0
    x = np.array([[r[f] for f in FIELDS] for r in rows])
    n = np.array([r["count"] for r in rows], dtype=float)
    start = lambda t: np.array([[1.0, *g] for g in t])
    same, other, share = start(START_SAME), start(START_OTHER), 0.3
    prior_same, prior_other = 20 * same[:, 1:], 20 * other[:, 1:]
    at = np.arange(len(FIELDS))
    for _ in range(rounds):
        before = np.concatenate([same, other])
        ls, lo = np.log(same[at, x]).sum(1) + np.log(share), np.log(other[at, x]).sum(1) + np.log(1 - share)
        w = n / (1 + np.exp(np.clip(lo - ls, -500, 500)))
        share = float(np.clip(w.sum() / n.sum(), 1e-4, 1 - 1e-4))
        for f in range(len(FIELDS)):
            for table, weight, prior in ((same, w, prior_same), (other, n - w, prior_other)):
                c = np.array([weight[x[:, f] == g].sum() for g in (1, 2, 3)]) + prior[f]
                table[f, 1:] = c / c.sum()
        moved = np.abs(np.concatenate([same, other]) - before).max()
        if moved < MOVED:
            break
    else:
        warnings.warn(f"odds of names: still moving by {moved:.2g} after {rounds} rounds", stacklevel=2)
    ratio = np.log(same) - np.log(other)
    ratio[:, 0] = 0.0
    # Brothers share all but the own name, so their fields agree together: the odds of a different own name have a floor of their own.
    ratio[0, 3] = min(ratio[0, 3], OTHER_NAME)
    return {f: ratio[k].tolist() for k, f in enumerate(FIELDS)}, float(np.log(share / (1 - share)))


def scored(grades: DataFrame) -> DataFrame:
    """grades with score: the log-odds that a and b are one person."""
    of, base = odds(grades)
    score = F.lit(base)
    for f in FIELDS:
        score = score + F.element_at(F.array(*map(F.lit, of[f])), F.col(f) + 1)
    return grades.withColumn("score", score)
