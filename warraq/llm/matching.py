"""Matching entries of several dictionaries to canonical persons, by loopy belief propagation.

Candidate pairs (entry, person) have odds from their names and attributes. Two kinds of factors couple them: an entry describes one
person or nobody, and within one dictionary a person has one entry (a second one costs the factor SECOND, as numbers are now and
then entered twice). Messages go back and forth between pairs and factors through grouped sums and joins until they no longer
change; the marginal probability of each pair is its confidence.
"""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from warraq.llm import names
from warraq.plans.materialize import cut

SECOND = 0.3
ROUNDS = 200
CLOSE = 1e-3


def _messages(pairs: DataFrame, second: float, rounds: int, damping: float) -> DataFrame:
    """pairs (entry, person, persons, source) with w, the odds of the pair by itself, and nu, the person's factor's message to it once nothing moves; see propagate()."""
    alike = [F.col(c) if c in pairs.columns else F.lit(1).alias(c) for c in ("entries", "persons")]
    base = pairs.select("entry", "person", *alike, F.coalesce("source", F.lit("")).alias("source"), F.exp(F.least(F.greatest(F.col("score"), F.lit(-30.0)), F.lit(30.0))).alias("w"))
    base = cut(base.withColumn("contested", F.sum("entries").over(W.partitionBy("person", "source")) > 1), "pairs")
    # A pair that has no rival hears 1 from its person's factor, always: of an entry's such pairs only the sum counts.
    still = base.where("not contested")
    alone = still.groupBy("entry").agg(F.sum(F.col("persons") * F.col("w")).alias("alone"))
    columns = ("entry", "person", "entries", "persons", "source", "w", "alone")
    state = base.where("contested").join(alone, "entry", "left").withColumn("alone", F.coalesce("alone", F.lit(0.0))).select(*columns, F.lit(1.0).alias("nu"))
    moved = 0.0
    # nu: from the person's factor to the pair; mu: from the entry's factor to the pair.
    for _ in range(rounds):
        by_entry = state.groupBy("entry").agg(F.sum(F.col("persons") * F.col("w") * F.col("nu")).alias("all"))
        mu = F.col("w") / (1 + F.greatest(F.col("alone") + F.col("all") - F.col("w") * F.col("nu"), F.lit(0.0)))
        sent = state.join(by_entry, "entry").select(*columns, "nu", mu.alias("mu"))
        # Odds to probability: another entry of the dictionary holds the person.
        by_person = sent.groupBy("person", "source").agg(F.sum(F.col("entries") * F.col("mu")).alias("all"))
        other = F.greatest(F.col("all") - F.col("mu"), F.lit(0.0))
        new = (1 + second * other) / (1 + other)
        step = sent.join(by_person, ["person", "source"]).withColumn("new", damping * new + (1 - damping) * F.col("nu"))
        state = cut(step.select(*columns, F.abs(F.col("new") - F.col("nu")).alias("moved"), F.col("new").alias("nu")), "messages")
        before, moved = moved, state.agg(F.max("moved")).first()[0] or 0.0
        if moved < CLOSE:
            break
        if 0 < before < moved:
            damping = max(damping / 1.3, 0.5)
    else:
        warnings.warn(f"belief propagation: messages still move by {moved:.2g} after {rounds} rounds", stacklevel=3)
    return state.select("entry", "person", "persons", "source", "w", "nu").unionByName(still.select("entry", "person", "persons", "source", "w", F.lit(1.0).alias("nu")))


def propagate(pairs: DataFrame, second: float = SECOND, rounds: int = ROUNDS, damping: float = 0.85) -> DataFrame:
    """pairs with marginal, the probability that the entry describes the person.

    pairs: entry, person bigint, source string (the entry's dictionary), score (log-odds of the pair by itself); no pair twice. A
    null source is a dictionary of its own. An empty table gives no row. damping: the share of a new message in the next; it falls, to
    a half at least, when messages move more than in the round before.

    entries, persons (optional): how many entries of the dictionary, and persons, are alike and stand as this one; their messages are the same.
    """
    told = _messages(pairs, second, rounds, damping)
    by_entry = told.groupBy("entry").agg(F.sum(F.col("persons") * F.col("w") * F.col("nu")).alias("all"))
    return told.join(by_entry, "entry").select("entry", "person", "source", (F.col("w") * F.col("nu") / (1 + F.col("all"))).alias("marginal"))


def likeliest(pairs: DataFrame, second: float = SECOND, rounds: int = ROUNDS, damping: float = 0.85) -> DataFrame:
    """entry, person, marginal of the pair of each entry whose marginal, as propagate() has it, is at least a half; there is one at most. Needs no join of sums with pairs."""
    told = _messages(pairs, second, rounds, damping).withColumn("odds", F.col("w") * F.col("nu"))
    # The marginal is at most odds / (1 + odds).
    likely = F.when(F.col("odds") > 0.99, F.struct("odds", -F.col("person")))
    best = told.groupBy("entry").agg(F.sum(F.col("persons") * F.col("odds")).alias("all"), F.max(likely).alias("m"))
    return best.select("entry", (-F.col("m.col2")).alias("person"), (F.col("m.odds") / (1 + F.col("all"))).alias("marginal")).where("marginal >= 0.5")


def _once(df: DataFrame, key: str) -> DataFrame:
    """One row per key, the least by all columns: whichever task it is read in."""
    rest = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.min(F.struct(*rest)).alias("r")).select(key, "r.*")


def _records(entries: DataFrame, persons: DataFrame) -> DataFrame:
    e = entries.select(F.col("entry_id").alias("rid"), F.lit(1).alias("side"), "dict", "name_ar", "name_norm", "kunya", "town", "death_h").where("rid is not null")
    # Persons stand beside entries under negative numbers.
    p = persons.select((-F.col("ishabah_id").cast("bigint") - 1).alias("rid"), F.lit(0).alias("side"), F.lit(None).cast("int").alias("dict"), "name_ar", "name_norm", "kunya", "town", "death_h").where("rid is not null")
    return e.unionByName(p)


def _mark(columns: list[str], a: str, b: str) -> dict:
    """128 bits of the columns' values, as two numbers."""
    values = [v for c in columns for v in (F.col(c).isNull(), F.col(c))]
    return {n: F.xxhash64(F.lit(k), *values) for k, n in enumerate((a, b))}


def _alike(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """members (rid, side, dict, rep) and classes (profiles of names.profiles(), n): records that are equal in all parts and attributes have one representative, the
    least entry, or person of the smallest number, and n counts them. rows: _records(). Of repeated ids the least record by all columns and the least dict count.

    Records go by numbers; each distinct content is parsed once.
    """
    fields = ["side", "name_ar", "name_norm", "kunya", "town", "death_h"]
    marked = rows.select("rid", "dict", *fields).withColumns(_mark(fields, "h1", "h2"))
    ids = marked.groupBy("rid").agg(F.min("side").alias("side"), F.min("dict").alias("dict"), *(f(h).alias(f"{n}{h}") for h in ("h1", "h2") for n, f in (("", F.min), ("top_", F.max))))
    ids = cut(ids, "ids")
    several = ids.where("h1 <> top_h1 or h2 <> top_h2").select("rid")
    ids = ids.select("rid", "side", "dict", "h1", "h2", ((F.col("h1") == F.col("top_h1")) & (F.col("h2") == F.col("top_h2"))).alias("one"))
    if several.isEmpty():
        ids = ids.drop("one")
    else:
        least = _once(rows.join(several, "rid", "left_semi").select("rid", *fields), "rid").withColumns(_mark(fields, "h1", "h2"))
        least = least.join(ids.where("not one").select("rid", "dict"), "rid").select("rid", "side", "dict", "h1", "h2")
        ids = cut(ids.where("one").drop("one").unionByName(least), "ids")
    contents = marked.select(F.struct("h1", "h2").alias("rid"), *fields).distinct()
    parsed = names.profiles(contents)
    parts = [c for c in parsed.columns if c != "rid"]
    parsed = parsed.select("rid.*", *parts).withColumns(_mark(parts, "c1", "c2"))
    held = ids.groupBy("h1", "h2").agg(F.min("rid").alias("first"), F.max("rid").alias("last"), F.count("*").alias("m"))
    person, like = F.col("side") == 0, W.partitionBy("c1", "c2")
    rep = F.when(person, F.max("last").over(like)).otherwise(F.min("first").over(like))
    known = cut(parsed.join(held, ["h1", "h2"]).withColumns({"rep": rep, "n": F.sum("m").over(like)}), "profiles")
    classes = known.where(F.col("rep") == F.when(person, F.col("last")).otherwise(F.col("first"))).select(F.col("rep").alias("rid"), *parts, "n")
    return ids.join(known.select("h1", "h2", "rep"), ["h1", "h2"]).select("rid", "side", "dict", "rep"), classes


def resolve(entries: DataFrame, persons: DataFrame) -> DataFrame:
    """entry_id, ishabah_id, marginal, confidence (high, medium, low) of the person each entry most probably describes, where that is more probable than nobody.

    entries: entry_id bigint, source, name_ar, name_norm, kunya, town string, death_h int; persons: ishabah_id int and the same fields.
    All fields but the ids may be null; repeated ids count once. Equal marginals go to the smaller ishabah_id.
    """
    # Dictionaries go by numbers in the order of their names; one without a name is the dictionary "".
    entries = entries.select("entry_id", "source", "name_ar", "name_norm", "kunya", "town", "death_h")
    numbers = entries.select("source").where("source <> ''").distinct().withColumn("dict", F.row_number().over(W.orderBy("source")))
    coded = entries.join(cut(numbers, "numbers"), "source", "left").withColumn("dict", F.when(F.col("source") == "", 0).otherwise(F.col("dict")))
    # Records that are equal in all parts and attributes are met and graded once.
    members, classes = _alike(_records(coded, persons))
    met = names.meetings(classes, across=True)
    scores = names.scored(cut(names.graded(met, classes), "grades"))
    # Of these, entries of one dictionary get the same messages, too.
    members = cut(members.where("side = 1").select("rid", "rep", F.coalesce("dict", F.lit(0)).alias("dict")), "members")
    units = cut(members.groupBy("rep", "dict").agg(F.min("rid").alias("entry"), F.count("*").alias("entries")), "units")
    asked = units.select(F.col("rep").alias("b"), F.col("dict").cast("string").alias("source"), "entry", "entries")
    pairs = scores.select("a", "b", "persons", "score").join(asked, "b").select("entry", (-F.col("a") - 1).alias("person"), "entries", "persons", "source", "score")
    best = likeliest(pairs).join(units.select("entry", "rep", "dict"), "entry").join(members, ["rep", "dict"])
    p = F.col("marginal")
    grade = F.when(p >= 0.95, "high").when(p >= 0.8, "medium").otherwise("low")
    return best.select(F.col("rid").alias("entry_id"), F.col("person").cast("int").alias("ishabah_id"), "marginal", grade.alias("confidence"))


def _classes(entries: DataFrame, least: float) -> tuple[DataFrame, DataFrame, DataFrame]:
    """members (rid, rep): entries that are equal in all parts and attributes have one representative; links (a, b, p, together) between
    representatives, together where both belong to one canonical entry; heads (b, head): the canonical entry of a representative."""
    rows = _once(entries.select("entry_id", "canonical", "name_ar", "name_norm", "kunya", "town", "death_h").where("entry_id is not null"), "entry_id")
    people = cut(names.profiles(rows.select(F.col("entry_id").alias("rid"), F.when(F.col("canonical"), 0).otherwise(1).alias("side"), "name_ar", "name_norm", "kunya", "town", "death_h")), "profiles")
    fields = [c for c in people.columns if c != "rid"]
    classes = cut(people.groupBy(*fields).agg(F.min("rid").alias("rid")), "classes")
    same = [people[c].eqNullSafe(classes[c]) for c in fields]
    condition = same[0]
    for s in same[1:]:
        condition = condition & s
    members = cut(people.join(classes, condition).select(people["rid"].alias("rid"), classes["rid"].alias("rep")), "members")
    scores = names.scored(cut(names.graded(names.meetings(classes), classes), "grades"))
    links = cut(scores.select("a", "b", (1 / (1 + F.exp(-F.col("score")))).alias("p")).where(F.col("p") >= least), "links")
    heads = classes.where("side = 0").select(F.col("rid").alias("head"))
    # The canonical entry an entry most probably belongs to; an entry between two canonical ones belongs to the likelier.
    to_head = links.join(heads, links["a"] == heads["head"]).join(classes.where("side = 1").select(F.col("rid").alias("b")), "b")
    own = cut(to_head.groupBy("b").agg(F.max_by("head", F.struct("p", -F.col("head"))).alias("head")), "heads")
    # A link to a canonical entry other than the likeliest one is no link; nor is one between entries of two canonical persons.
    of = lambda c: own.select(F.col("b").alias(c), F.col("head").alias(f"h{c}"))
    kept = links.join(of("a"), "a", "left").join(of("b"), "b", "left").join(heads.withColumnRenamed("head", "a").withColumn("is_head", F.lit(True)), "a", "left")
    kept = kept.where("case when is_head then coalesce(hb = a, true) else coalesce(ha = hb, true) end").select("a", "b", "p", F.expr("coalesce(ha = hb, false)").alias("together"))
    return members, kept, own


def same_person(entries: DataFrame, least: float = 0.5) -> DataFrame:
    """Pairs of entries about the same person: entry_id_a < entry_id_b, probability (of the pair by itself; null where both only meet in a third entry).

    entries: entry_id, name_ar, name_norm, kunya, town, death_h. Two entries that are each linked with an entry of the canonical
    dictionary (canonical boolean) belong together too. Equal records are compared once and paired with all partners of their like;
    all pairs are as many as the entries of one person squared. linked_entries() has the same links in rows as many as the entries.
    """
    members, kept, own = _classes(entries, least)
    star = own.withColumnRenamed("b", "x").join(own.withColumnRenamed("b", "y"), "head").where("x < y").select(F.col("x").alias("a"), F.col("y").alias("b"), F.lit(None).cast("double").alias("p"))
    pairs = kept.select("a", "b", "p").unionByName(star).groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.max("p").alias("p"))
    m = lambda c, out: members.select(F.col("rep").alias(c), F.col("rid").alias(out))
    wide = pairs.join(m("a", "x"), "a").join(m("b", "y"), "b").select("x", "y", "p")
    inner = members.alias("l").join(members.alias("r"), "rep").where("l.rid < r.rid").select(F.col("l.rid").alias("x"), F.col("r.rid").alias("y"), F.lit(1.0).alias("p"))
    return wide.unionByName(inner).select(F.least("x", "y").alias("entry_id_a"), F.greatest("x", "y").alias("entry_id_b"), F.col("p").alias("probability"))


def linked_entries(entries: DataFrame, least: float = 0.5) -> DataFrame:
    """One row per entry: entry_id, class_id (the least entry that is equal in all parts and attributes), head (the canonical entry it belongs to, or null), n_links.

    n_links counts the entries that same_person() pairs the entry with, from the sizes of classes; no pairs of entries are made.
    """
    members, kept, own = _classes(entries, least)
    size = cut(members.groupBy("rep").agg(F.count("*").alias("size")), "sizes")
    of = own.withColumnRenamed("b", "rep")
    family = of.join(size, "rep").groupBy("head").agg(F.sum("size").alias("family"))
    direct = kept.where("not together").select("a", "b")
    each = direct.unionByName(direct.toDF("b", "a")).toDF("rep", "other")
    partners = each.join(size.toDF("other", "n"), "other").groupBy("rep").agg(F.sum("n").alias("direct"))
    # The class itself is in its family, or stands alone.
    per = size.join(of, "rep", "left").join(family, "head", "left").join(partners, "rep", "left")
    per = per.select("rep", "head", (F.coalesce("family", "size") + F.coalesce("direct", F.lit(0)) - 1).alias("n_links"))
    return members.join(per, "rep").select(F.col("rid").alias("entry_id"), F.col("rep").alias("class_id"), "head", "n_links")
