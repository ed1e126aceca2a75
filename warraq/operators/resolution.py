"""References and names given by users, resolved as tables: aliases, numbers and ranges, events, persons, cross references, overlays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from warraq.functions import normalise as N
from warraq.operators.search import tier, tier_label
from warraq.plans.materialize import few

# Words before a book's name that don't belong to it, and the widest range a reference may name.
PREFIXES = ("shahih", "sahih", "sunan", "imam", "kitab", "hr", "musnad")
MAX_RANGE = 2000
# Bracket groups of titles; those of the first form lose their brackets, those of the second go.
BRACKETS = (
    (r"\[(?=[^\[\]]*(?:سور|تفسير))([^\[\]]*)\]", r"\[[^\[\]]*\]"),
    (r"\((?=[^()]*(?:سور|تفسير))([^()]*)\)", r"\([^()]*\)"),
)


def resolve_aliases(inputs: DataFrame, aliases: DataFrame) -> DataFrame:
    """Inputs (qid, name) against aliases (alias, target): qid, target, how (exact, prefix dropped, unique start); null and 'ambiguous' or 'unknown' otherwise.

    Every input comes back, once. An alias of two targets is ambiguous: it names neither.
    """
    a = aliases.select(N.alias_key(F.col("alias")).alias("key"), "target").where("key <> ''").groupBy("key").agg(F.min("target").alias("least"), F.max("target").alias("most"))
    a = a.select("key", F.when(F.col("least") == F.col("most"), F.col("least")).alias("target"), F.array("least", "most").alias("targets"))
    q = inputs.select("qid", N.alias_key(F.col("name")).alias("key"))
    exact = q.join(a, "key").select("qid", "target", F.lit(1).alias("step"))
    bare = q.select("qid", F.explode(F.array(*(F.when(F.col("key").startswith(p), F.substring(F.col("key"), F.lit(len(p) + 1), F.length("key"))) for p in PREFIXES))).alias("key"))
    bare = bare.where("key is not null").join(a, "key").select("qid", "target", F.lit(2).alias("step"))
    # All starts of at least four letters, joined by equality.
    starts = a.where("length(key) >= 4").select(F.explode("targets").alias("target"), "key").select("target", F.explode(F.expr("transform(sequence(4, length(key)), n -> left(key, n))")).alias("key"))
    unique = q.join(starts, "key").groupBy("qid").agg(F.count_distinct("target").alias("n"), F.min("target").alias("target")).where("n = 1")
    tried = exact.unionByName(bare).unionByName(unique.select("qid", "target", F.lit(3).alias("step")))
    # One step may find two targets, or an alias of two: null sorts first.
    best = tried.groupBy("qid", "step").agg(F.when((F.min("target") == F.max("target")) & (F.count("*") == F.count("target")), F.min("target")).alias("target"))
    best = best.groupBy("qid").agg(F.min(F.struct("step", "target")).alias("b"))
    how = F.array(F.lit("exact"), F.lit("prefix dropped"), F.lit("unique start"))
    out = q.select("qid").distinct().join(best, "qid", "left")
    named = F.when(F.col("b").isNull(), "unknown").when(F.col("b.target").isNull(), "ambiguous").otherwise(F.get(how, F.col("b.step") - 1))
    return out.select("qid", F.col("b.target").alias("target"), named.alias("how"))


def title_targets(titles: DataFrame, aliases: DataFrame, key: str = "tid") -> DataFrame:
    """Titles (key, title) like "[commentary on] chapter NAME ..." to the target of the longest alias (alias, target) that begins NAME, word by word.

    Bracket groups go, but those that mention a chapter or a commentary lose their brackets only. status: ok, no heading (not led by the word for chapter),
    unknown, ambiguous (the longest alias has two targets). Every title comes once.
    """
    clean = F.col("title")
    for kept, whole in BRACKETS:
        clean = F.regexp_replace(F.regexp_replace(clean, kept, "$1"), whole, " ")
    words = N.title_words(clean)
    words = F.when(F.get(words, F.lit(0)) == "تفسير", F.slice(words, F.lit(2), F.size(words))).otherwise(words)
    tail = F.when(F.array_join(F.slice(words, 1, 4), " ") == "السوره التي يذكر فيها", F.slice(words, F.lit(5), F.size(words))).when(F.get(words, F.lit(0)).isin("سوره", "سورتي"), F.slice(words, F.lit(2), F.size(words)))
    t = titles.select(key, tail.alias("w"))
    a = aliases.select("target", N.title_words(F.col("alias")).alias("w")).where("size(w) > 0").select("target", F.array_join("w", " ").alias("k"))
    starts = t.select(key, F.explode(F.expr("transform(filter(sequence(0, size(w)), n -> n > 0), n -> struct(n, array_join(slice(w, 1, n), ' ') as k))")).alias("x")).select(key, "x.n", "x.k")
    hit = starts.join(a.distinct(), "k").groupBy(key, "n").agg(F.min("target").alias("least"), F.max("target").alias("most"))
    best = hit.groupBy(key).agg(F.max(F.struct("n", "least", "most")).alias("b"))
    one = F.col("b.least") == F.col("b.most")
    status = F.when(F.col("w").isNull() | (F.size("w") == 0), "no heading").when(F.col("b").isNull(), "unknown").when(one, "ok").otherwise("ambiguous")
    return t.join(best, key, "left").select(key, F.when(one, F.col("b.least")).alias("target"), status.alias("status"))


def parse_references(inputs: DataFrame) -> DataFrame:
    """R2: inputs (qid, ref) like book:4,9-11 or book:K/N: qid, book, lo, hi, sub, status (ok, malformed, reversed, too wide)."""
    ref = N.ascii_digits(F.col("ref"))
    head = inputs.select("qid", F.trim(F.regexp_extract(ref, r"^(.*):[^:]*$", 1)).alias("book"), F.explode(F.split(F.regexp_extract(ref, r":([^:]*)$", 1), ",")).alias("part"))
    pattern = r"^\s*(?:(\d+)\s*/\s*)?(\d+)\s*(?:-\s*(\d+))?\s*$"
    number = lambda k: F.nullif(F.regexp_extract("part", pattern, k), F.lit("")).cast("bigint")
    spans = head.select("qid", "book", number(1).alias("sub"), number(2).alias("lo"), F.coalesce(number(3), number(2)).alias("hi"))
    status = F.when(F.col("lo").isNull() | (F.col("book") == ""), "malformed").when(F.col("lo") > F.col("hi"), "reversed").when(F.col("hi") - F.col("lo") + 1 > MAX_RANGE, "too wide").otherwise("ok")
    return spans.withColumn("status", status)


def look_up_numbers(spans: DataFrame, rows: DataFrame) -> DataFrame:
    """Rows of the numbers asked for, and explicit rows for those that aren't there.

    spans: qid, book, lo, hi. rows: row_id, book, num, num_to (null: one number), num_label. A number is found if a row's span
    covers it, or else if it stands as a whole number in a row's label; status: found, by label, missing.
    """
    asked = spans.where("lo <= hi").select("qid", "book", F.explode(F.sequence("lo", "hi")).alias("num")).distinct()
    wide = rows.where("num is not null").select("row_id", "book", F.explode(F.sequence("num", F.greatest("num", F.coalesce("num_to", "num")))).alias("num"))
    found = asked.join(wide, ["book", "num"]).select("qid", "book", "num", "row_id", F.lit("found").alias("status"))
    rest = asked.join(found.select("qid", "book", "num").distinct(), ["qid", "book", "num"], "left_anti")
    in_label = rows.select("row_id", "book", F.explode(F.regexp_extract_all(N.ascii_digits(F.col("num_label")), F.lit(r"(\d+)"), 1)).alias("n")).select("row_id", "book", F.col("n").try_cast("bigint").alias("num")).distinct()
    by_label = rest.join(in_label, ["book", "num"]).select("qid", "book", "num", "row_id", F.lit("by label").alias("status"))
    missing = rest.join(by_label.select("qid", "book", "num").distinct(), ["qid", "book", "num"], "left_anti")
    return found.unionByName(by_label).unionByName(missing.select("qid", "book", "num", F.lit(None).cast(dict(rows.dtypes)["row_id"]).alias("row_id"), F.lit("missing").alias("status")))


def look_up_in_parts(spans: DataFrame, rows: DataFrame) -> DataFrame:
    """Numbers of books that number each part (sub) anew: K/N names part and number; a plain N names all parts that have it.

    spans: qid, book, lo, hi, sub (null: plain); rows: row_id, book, sub, num. Result: qid, book, num, sub, row_id (the least of the part), n_rows, status: found (the part
    named, or the only one that has the number), ambiguous (one row for each part that has it), missing.
    """
    asked = spans.where("lo <= hi").select("qid", "book", F.col("sub").alias("asked"), F.explode(F.sequence("lo", "hi")).alias("num")).distinct()
    per = rows.where("num is not null").groupBy("book", "sub", F.col("num").cast("bigint").alias("num")).agg(F.min("row_id").alias("row_id"), F.count("*").alias("n_rows"))
    x = asked.join(per, ["book", "num"], "left").withColumn("fits", F.col("row_id").isNotNull() & (F.col("asked").isNull() | F.coalesce(F.col("sub") == F.col("asked"), F.lit(False))))
    w = W.partitionBy("qid", "book", "num", "asked")
    n = x.withColumn("parts", F.count_if("fits").over(w)).withColumn("k", F.row_number().over(w.orderBy(F.desc("fits"), "sub")))
    kept = n.where("fits or (parts = 0 and k = 1)")
    shown = lambda c: F.when(F.col("fits"), F.col(c)).alias(c)
    status = F.when(F.col("parts") == 0, "missing").when(F.col("parts") == 1, "found").otherwise("ambiguous")
    return kept.select("qid", "book", "num", F.when(F.col("fits"), F.col("sub")).otherwise(F.col("asked")).alias("sub"), shown("row_id"), shown("n_rows"), status.alias("status"))


def resolve_persons(queries: DataFrame, persons: DataFrame, entries: DataFrame, k: int = 15) -> DataFrame:
    """Queries (qid, query) to persons: by number; by a whole name that one person bears; else through four channels: the whole name, contained in
    the person's name, all words in the name of an entry, contained in the name of an entry.

    persons: person, name; entries: person (null: of nobody), source, name. Candidates are ordered by the number of sources, of entries with the query in their names, then person;
    ``k`` are shown. status: resolved (a number, the only whole name, the only candidate), suggested (the first of several, with four sources or more while the second has two at most),
    ambiguous, absent. qid, person, n_sources, n_phrase, rank, status, n_candidates.
    """
    digits = F.trim("query").rlike(r"^\d+$")
    q = queries.select("qid", F.when(digits, F.trim("query").try_cast("bigint")).alias("number"), digits.alias("is_number"), N.name_column(F.col("query")).alias("key"), F.array_distinct(N.tokens(N.search_key(F.col("query")))).alias("words"))
    named = few(q.where("not is_number and key <> ''").select("qid", "key", "words"))
    p = persons.select(F.col("person").cast("bigint").alias("person"), N.name_column(F.col("name")).alias("name"))
    e = entries.where("person is not null").select(F.col("person").cast("bigint").alias("person"), "source", N.name_column(F.col("name")).alias("name"), F.coalesce(N.tokens(N.search_key(F.col("name"))), F.array().cast("array<string>")).alias("hay"))
    own = p.join(named, p["name"].contains(F.col("key"))).select("qid", "person", (F.col("name") == F.col("key")).alias("whole"))
    in_words = (F.size("words") > 0) & F.forall("words", lambda t: F.array_contains("hay", t))
    met = e.join(named, e["name"].contains(F.col("key")) | in_words).join(p.select("person"), "person", "left_semi")
    met = met.select("qid", "person", F.lit(False).alias("whole"))
    # A channel may find a person of several entries; by number only if there is such a person.
    number = q.where("is_number").select("qid", F.col("number").alias("person")).join(p.select("person"), "person", "left_semi").select("qid", "person", F.lit(True).alias("whole"))
    c = own.unionByName(met).unionByName(number).groupBy("qid", "person").agg(F.max("whole").alias("whole"))
    w = W.partitionBy("qid")
    c = c.withColumn("n_whole", F.count_if("whole").over(w)).where("n_whole <> 1 or whole").drop("n_whole", "whole")
    sources = e.groupBy("person").agg(F.count_distinct("source").alias("n_sources"))
    phrase = c.join(e.select("person", "name"), "person").join(q.select("qid", "key"), "qid").where((F.col("key") != "") & F.col("name").contains(F.col("key"))).groupBy("qid", "person").agg(F.count("*").alias("n_phrase"))
    s = c.join(sources, "person", "left").join(phrase, ["qid", "person"], "left").na.fill(0, ["n_sources", "n_phrase"])
    order = w.orderBy(F.desc("n_sources"), F.desc("n_phrase"), "person")
    s = s.withColumn("rank", F.row_number().over(order)).withColumn("n_candidates", F.count("*").over(w)).withColumn("_second", F.coalesce(F.lead("n_sources").over(order), F.lit(0)))
    strong = (F.col("rank") == 1) & (F.col("n_sources") >= 4) & (F.col("_second") <= 2)
    status = F.when(F.col("n_candidates") == 1, "resolved").when(strong, "suggested").otherwise("ambiguous")
    found = s.where(F.col("rank") <= k).select("qid", "person", "n_sources", "n_phrase", "rank", status.alias("status"), "n_candidates")
    none = queries.select("qid").distinct().join(found.select("qid").distinct(), "qid", "left_anti").withColumn("status", F.lit("absent"))
    return found.unionByName(none, allowMissingColumns=True)


def roll_up_year(event_id: Column) -> Column:
    """The year of a roll-up row tahun_N_h, or null: such an id asks for the year."""
    return F.regexp_extract(event_id, r"^tahun_(\d+)_h$", 1).try_cast("int")


def answer_years(years: DataFrame, registry: DataFrame, segments: DataFrame) -> DataFrame:
    """Of each year asked for (year): its segments (seg_id, year_h, source) and its registered events (event_id, year_h, seq; roll-ups left out), or a row that says which years have segments.

    Result: year, kind (segment, event, absent), id, ord, first_year, last_year. The years are few and Spark broadcasts them by size.
    """
    span = segments.where("year_h is not null").agg(F.min("year_h").alias("first_year"), F.max("year_h").alias("last_year"))
    y = years.select("year").where("year is not null").distinct()
    seg = segments.join(y, F.col("year_h") == F.col("year")).select("year", F.lit("segment").alias("kind"), F.col("seg_id").cast("string").alias("id"), F.col("seg_id").cast("bigint").alias("ord"))
    ev = registry.where(roll_up_year(F.col("event_id")).isNull()).join(y, F.col("year_h") == F.col("year")).select("year", F.lit("event").alias("kind"), F.col("event_id").alias("id"), F.col("seq").cast("bigint").alias("ord"))
    absent = y.join(seg.select("year").distinct(), "year", "left_anti").select("year", F.lit("absent").alias("kind"), F.lit(None).cast("string").alias("id"), F.lit(None).cast("bigint").alias("ord"))
    # One row of first and last year.
    return seg.unionByName(ev).unionByName(absent).crossJoin(F.broadcast(span))


def overlay(base: DataFrame, over: DataFrame, keys: list[str], order: str) -> DataFrame:
    """One row per key: of over the last, else of base the first. Both have the same columns; keys are compared null-safe."""
    b = base.groupBy(*keys).agg(F.min_by(F.struct(*base.columns), F.col(order)).alias("r")).withColumn("p", F.lit(0))
    o = over.groupBy(*keys).agg(F.max_by(F.struct(*over.columns), F.col(order)).alias("r")).withColumn("p", F.lit(1))
    return b.unionByName(o).groupBy(*keys).agg(F.max_by("r", "p").alias("r"), F.max("p").alias("from_overlay")).select("r.*", F.col("from_overlay") == 1)


def both_ways(edges: DataFrame, a: str, b: str) -> DataFrame:
    """Undirected neighbours of each node, once each, without loops."""
    one = edges.select(F.col(a).alias("node"), F.col(b).alias("neighbour"))
    return one.union(edges.select(F.col(b), F.col(a))).where("node <> neighbour").distinct()


def aliases_of(c: Column) -> Column:
    """A JSON array of names; a broken or null one is empty."""
    return F.coalesce(F.from_json(c, "array<string>"), F.array().cast("array<string>"))


def resolve_events(queries: DataFrame, registry: DataFrame) -> DataFrame:
    """Queries (qid, query) against event_id, name_norm, aliases (normalised array), name_id: candidates of the best tier.

    Tier 0: the id itself; 1: the whole name, an alias as whole words, the Latin name; 2: contained. status: resolved if tier 0 or
    1 has one candidate, ambiguous otherwise (a single candidate of tier 2 included); a query without candidates comes with status
    absent. The queries are a stated set, held against the whole registry.
    """
    q = queries.select("qid", F.col("query"), N.name_column(F.col("query")).alias("key"), F.lower("query").alias("low"))
    hay = lambda c: F.concat(F.lit(" "), c, F.lit(" "))
    r = registry.select("event_id", "name_norm", "aliases", F.lower("name_id").alias("name_id"))
    x = r.join(few(q.where("key <> ''")), F.lit(True))
    whole = (F.col("name_norm") == F.col("key")) | F.exists("aliases", lambda a: hay(a).contains(hay(F.col("key")))) | (F.col("name_id") == F.col("low"))
    part = F.col("name_norm").contains(F.col("key")) | F.exists("aliases", lambda a: a.contains(F.col("key"))) | F.col("name_id").contains(F.col("low"))
    t = F.when(F.col("event_id") == F.col("query"), 0).when(whole, 1).when(part, 2)
    hits = x.select("qid", "event_id", t.alias("tier")).where("tier is not null")
    w = W.partitionBy("qid")
    best = hits.withColumn("best", F.min("tier").over(w)).where("tier = best").withColumn("n", F.count("*").over(w))
    got = best.select("qid", "event_id", "tier", F.when((F.col("tier") < 2) & (F.col("n") == 1), "resolved").otherwise("ambiguous").alias("status"))
    none = queries.select("qid").distinct().join(got.select("qid").distinct(), "qid", "left_anti")
    return got.unionByName(none.select("qid", F.lit(None).cast("string").alias("event_id"), F.lit(None).cast("int").alias("tier"), F.lit("absent").alias("status")))


def search_registry(queries: DataFrame, registry: DataFrame, k: int = 15, roll_up: str = r"^tahun_.*_h$") -> DataFrame:
    """Registry rows per query by their best tier over name, aliases and Latin name; roll-up rows are hidden unless figures were asked for.

    Order: score, tier of the name, seq. qid, event_id, score, name_tier, label, rank, n_more (beyond k).
    """
    q = queries.select("qid", N.name_column(F.col("query")).alias("key"), F.lower("query").alias("low"))
    x = registry.join(few(q), F.lit(True)).where(~F.col("event_id").rlike(roll_up) | F.col("key").rlike(r"^\d+$"))
    name = tier(F.col("name_norm"), F.col("key"))
    alias = F.aggregate(F.transform("aliases", lambda a: tier(a, F.col("key"))), F.lit(0), lambda s, x: F.greatest(s, x))
    score = F.greatest(name, alias, tier(F.lower("name_id"), F.col("low")))
    s = x.select("qid", "event_id", "seq", score.alias("score"), name.alias("name_tier")).where("score > 0")
    w = W.partitionBy("qid")
    r = s.withColumn("rank", F.row_number().over(w.orderBy(F.desc("score"), F.desc("name_tier"), "seq"))).withColumn("n_more", F.greatest(F.count("*").over(w) - k, F.lit(0)))
    return r.where(F.col("rank") <= k).select("qid", "event_id", "score", "name_tier", tier_label(F.col("score")).alias("label"), "rank", "n_more")


def search_persons(queries: DataFrame, entries: DataFrame, k: int = 15) -> DataFrame:
    """persons by the best tier over the names of all their entries (person, source, name): score, number of sources, id."""
    q = queries.select("qid", N.name_column(F.col("query")).alias("key")).where("key <> ''")
    x = entries.where("person is not null").select("person", "source", N.name_column(F.col("name")).alias("name"))
    s = x.join(few(q), x["name"].contains(q["key"])).groupBy("qid", "person").agg(F.max(tier(F.col("name"), F.col("key"))).alias("score"), F.count_distinct("source").alias("n_sources"))
    rank = F.row_number().over(W.partitionBy("qid").orderBy(F.desc("score"), F.desc("n_sources"), "person"))
    return s.withColumn("rank", rank).where(F.col("rank") <= k)


def search_names(queries: DataFrame, registry: DataFrame, persons: DataFrame, entries: DataFrame, k: int = 15, most: int = 20, roll_up: str = r"^tahun_.*_h$") -> DataFrame:
    """all that queries (qid, query) find under a name, through every channel: contained in a name, alias or Latin name, or all words anywhere in it.

    persons: person, name; entries: entry_id, person (null: unlinked), source, entry_num, name. kind: event, hidden (roll-up rows not shown, as the
    query is no number and names no year; counted in n_more), person, unlinked (entries of no person, by source and number, ``most`` shown).
    qid, kind, id, score (null: hidden, unlinked), rank, n_more (beyond those shown).
    """
    every = F.array_distinct(N.tokens(N.search_key(F.col("query"))))
    q = few(queries.where("trim(query) <> ''").select("qid", N.name_column(F.col("query")).alias("key"), F.lower(F.trim("query")).alias("low"), every.alias("words")))
    in_words = (F.size("words") > 0) & F.forall("words", lambda t: F.array_contains("hay", t))
    words = lambda c: F.coalesce(N.tokens(N.search_key(c)), F.array().cast("array<string>"))
    within = (F.col("key") != "") & F.col("name").contains(F.col("key"))
    shown = lambda df, n, *order: df.withColumn("rank", F.row_number().over(W.partitionBy("qid").orderBy(*order))).withColumn("n_more", F.greatest(F.count("*").over(W.partitionBy("qid")) - n, F.lit(0))).where(F.col("rank") <= n)
    out = lambda df, kind, id_, score: df.select("qid", F.lit(kind).alias("kind"), id_.cast("string").alias("id"), score.cast("int").alias("score"), "rank", "n_more")
    none = F.lit(None)

    x = registry.select("event_id", "seq", "name_norm", "aliases", F.lower("name_id").alias("name_id"), words(F.concat_ws(" ", "name_norm", "aliases")).alias("hay")).join(q, F.lit(True))
    name = tier(F.col("name_norm"), F.col("key"))
    alias = F.coalesce(F.array_max(F.transform("aliases", lambda a: tier(a, F.col("key")))), F.lit(0))
    year = F.col("key").rlike(r"^\p{Nd}+$") | F.col("key").contains("سنه") | F.col("low").contains("tahun")
    ev = x.select("qid", "event_id", "seq", F.greatest(name, alias, tier(F.col("name_id"), F.col("low"))).alias("score"), name.alias("name_tier"), in_words.alias("all"), (F.col("event_id").rlike(roll_up) & ~year).alias("hide")).where("score > 0 or all")
    events = out(shown(ev.where("not hide"), k, F.desc("score"), F.desc("name_tier"), "seq", "event_id"), "event", F.col("event_id"), F.col("score"))
    hidden = out(ev.where("hide").groupBy("qid").agg(F.count("*").alias("n_more")).withColumn("rank", F.lit(1)), "hidden", none, none)

    e = entries.select("entry_id", "person", "source", "entry_num", F.col("name").alias("stored"), N.name_column(F.col("name")).alias("name"), words(F.col("name")).alias("hay"))
    p = persons.select("person", F.lit(None).cast("string").alias("source"), N.name_column(F.col("name")).alias("name"))
    hit = e.where("person is not null").join(q, within | in_words).select("qid", "person").union(p.join(q, within).select("qid", "person")).distinct()
    named = e.where("person is not null").select("person", "source", "name").unionByName(p)
    s = hit.join(named, "person").join(q, "qid").groupBy("qid", "person").agg(F.max(tier(F.col("name"), F.col("key"))).alias("score"), F.count_distinct("source").alias("n_sources"))
    people = out(shown(s, k, F.desc("score"), F.desc("n_sources"), "person"), "person", F.col("person"), F.col("score"))
    u = e.where("person is null").join(q, in_words | ((F.size("words") == 0) & within)).groupBy("qid", "source", "entry_num", "stored").agg(F.min("entry_id").alias("entry_id"))
    unlinked = out(shown(u, most, "source", "entry_num", "entry_id"), "unlinked", F.col("entry_id"), none)
    return events.unionByName(hidden).unionByName(people).unionByName(unlinked)


def with_fixes(rows: DataFrame, fixes: DataFrame) -> DataFrame:
    """Rows (row_id, num, grade, grade_by) with a note on a corrected number and on the stored grade and its authority; fixes: row_id, printed_label, reason.

    A grade is shown as stored and never inferred. Of several fixes of a row the least counts; the fixes are few and Spark broadcasts them by size.
    """
    f = fixes.groupBy("row_id").agg(F.min(F.struct("printed_label", "reason")).alias("_f"))
    note = F.when(F.col("_f").isNotNull(), F.concat_ws("", F.lit("printed as "), F.coalesce("_f.printed_label", F.lit("?")), F.concat(F.lit(": "), F.col("_f.reason"))))
    grade = F.when(F.col("grade").isNotNull(), F.concat_ws(" - ", "grade", "grade_by"))
    return rows.join(f, "row_id", "left").withColumn("number_note", note).withColumn("grade_note", grade).drop("_f")


def address_section(sections: DataFrame, ref: str) -> DataFrame:
    """Sections (seg_id, section, title) by number, or by the start of the title; several: status ambiguous, none: no row."""
    if ref.strip().isdigit():
        return sections.where(F.col("section") == int(ref)).withColumn("status", F.lit("found"))
    hit = sections.where((F.lit(ref.strip()) != "") & N.name_column(F.col("title")).startswith(N.name_column(F.lit(ref))))
    n = F.count("*").over(W.partitionBy("seg_id"))
    return hit.withColumn("status", F.when(n == 1, "found").otherwise("ambiguous"))
