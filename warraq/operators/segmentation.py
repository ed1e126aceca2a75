"""Segments cut out of ordered paragraphs: by anchors, headings, numbered entries, titles and displayed verses; checks of the result."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from warraq.functions import normalise as N
from warraq.functions import paragraphs as P
from warraq.operators.slicing import slice_intervals

# Headers over verses (in the verse profile), and how far a printed number may be off.
RANGE_HEADER = r"^\[+\s*سورت\s+[^\]]+?\s*\(\s*([٠-٩]+)\s*\)\s*:\s*(?:الايات|ايات)\s+([٠-٩]+)\s+الي\s+([٠-٩]+)\s*\]+"
SINGLE_HEADER = r"^\[+\s*سورت\s+[^\]]+?\s*\(\s*([٠-٩]+)\s*\)\s*:\s*ايت\s+([٠-٩]+)\s*\]+"
DRIFT = 3
NAME_LETTERS = 12


def anchors_to_segments(anchors: DataFrame, bounds: DataFrame, keys: list[str]) -> DataFrame:
    """Each anchor (keys, pos, label) reaches to the position before the next one, the last to its group's end (bounds: keys, first, last).

    Positions before a group's first anchor form a segment with label intro. Groups without an anchor give no row; of anchors at one
    place the least label counts.
    """
    one = anchors.where("pos is not null").groupBy(*keys, "pos").agg(F.min("label").alias("label"))
    w = W.partitionBy(*keys).orderBy("pos")
    body = one.withColumn("_n", F.lead("pos").over(w)).join(bounds, keys).where("pos <= last")
    body = body.select(*keys, "label", F.col("pos").alias("from_pos"), F.least(F.coalesce(F.col("_n") - 1, F.col("last")), F.col("last")).alias("to_pos"))
    lead = one.groupBy(*keys).agg(F.min("pos").alias("_p")).join(bounds, keys).where("_p > first")
    return body.unionByName(lead.select(*keys, F.lit("intro").alias("label"), F.col("first").alias("from_pos"), (F.col("_p") - 1).alias("to_pos")))


def heading_segments(heads: DataFrame, keys: list[str], event: str) -> DataFrame:
    """Runs of an event's headings that join page to page, each with its tail on the page where the run ends.

    heads: keys, hid, event (null: of no event), page, para_idx (null: not located), end_excl (null: to the last page). The tail
    reaches into page end_excl up to the first located heading there that isn't of the run, if that stands below the page's top;
    otherwise the segment ends on the page before. Result: keys, event, start_page, para_start, last_page, para_end (excluded), n_heads.
    """
    last = heads.groupBy(*keys).agg(F.max("page").alias("_max"))
    own = heads.where(F.col(event).isNotNull() & F.col("page").isNotNull())
    w = W.partitionBy(*keys, event).orderBy("page", F.col("para_idx").asc_nulls_last(), "hid")
    new = F.when(F.col("page") <= F.coalesce(F.lag("end_excl").over(w), F.when(F.lag("page").over(w).isNotNull(), F.lit(2**31 - 1))), 0).otherwise(1)
    run = own.withColumn("_new", new).withColumn("_run", F.sum("_new").over(w))
    per = run.groupBy(*keys, event, "_run").agg(
        F.min(F.struct("page", F.coalesce("para_idx", F.lit(2**31 - 1)).alias("o"), "hid", "para_idx")).alias("f"),
        F.max(F.struct("page", F.coalesce("para_idx", F.lit(2**31 - 1)).alias("o"), "hid", "end_excl")).alias("l"),
        F.count("*").alias("n_heads"),
    )
    per = per.withColumn("end_excl", F.col("l.end_excl"))
    cuts = run.select(*keys, "hid", F.col(event).alias("_ce"), F.col("_run").alias("_cr"))
    cuts = heads.where("para_idx is not null").select(*keys, "hid", F.col("page").alias("_page"), F.col("para_idx").alias("_para")).join(cuts, [*keys, "hid"], "left")
    at = per.select(*keys, event, "_run", "end_excl").join(cuts, keys).where("_page = end_excl").where(~(F.col("_ce").eqNullSafe(F.col(event)) & F.col("_cr").eqNullSafe(F.col("_run"))))
    tail = at.groupBy(*keys, event, "_run").agg(F.min("_para").alias("_cut"))
    out = per.join(tail, [*keys, event, "_run"], "left").join(last, keys)
    inside = F.col("_cut") > 0
    last_page = F.when(F.col("end_excl").isNull(), F.col("_max")).when(inside, F.col("end_excl")).otherwise(F.col("end_excl") - 1)
    return out.select(*keys, event, F.col("f.page").alias("start_page"), F.col("f.para_idx").alias("para_start"), last_page.alias("last_page"), F.when(inside & F.col("end_excl").isNotNull(), F.col("_cut")).alias("para_end"), "n_heads")


def entry_starts(entries: DataFrame, lines: DataFrame, keys: list[str]) -> DataFrame:
    """Where each numbered entry begins: on its page, then the one before, then the one after; by its number, then by a number at most
    three off that isn't another entry's of these pages, then by the start of its name.

    entries: keys, i (order), num, page, name_key; lines: keys, page, para_idx, number, name_key. Result: entries with start_page,
    para_start (null: not found, then start_page is the entry's page), step.
    """
    e = entries.select(*keys, "i", "num", "page", "name_key")
    near = e.select("*", F.posexplode(F.array(F.col("page"), F.col("page") - 1, F.col("page") + 1)).alias("_rank", "_page"))
    l = lines.select(*keys, F.col("page").alias("_page"), "para_idx", "number", F.col("name_key").alias("_line"))
    hit = near.join(l, [*keys, "_page"])
    others = e.where("num is not null").select(*keys, F.col("num").alias("number"), F.col("page").alias("_owner")).groupBy(*keys, "number").agg(F.min("_owner").alias("_owner"))
    hit = hit.join(others, [*keys, "number"], "left")
    free = F.col("_owner").isNull() | (F.col("number") == F.col("num")) | (F.abs(F.col("_owner") - F.col("page")) > 1)
    start = F.substring("name_key", 1, NAME_LETTERS)
    step = F.when(F.col("number") == F.col("num"), 1).when((F.abs(F.col("number") - F.col("num")) <= DRIFT) & free, 2).when((start != "") & F.col("_line").contains(start), 3)
    best = hit.withColumn("_step", step).where("_step is not null").groupBy(*keys, "i").agg(F.min(F.struct("_rank", "_step", "para_idx", "_page")).alias("b"))
    return e.join(best, [*keys, "i"], "left").select(*keys, "i", "num", F.coalesce("b._page", "page").alias("start_page"), F.col("b.para_idx").alias("para_start"), F.col("b._step").alias("step"))


def entry_ends(entries: DataFrame, lines: DataFrame, keys: list[str]) -> DataFrame:
    """Where each entry ends: before the next entry's heading on page end_excl: by its number, by a number at most three off, by its
    name, else before the first numbered line of that page; a heading at the page's top ends it on the page before.

    entries as for entry_starts, with end_excl. Result: keys, i, last_page, para_end (excluded; null: to the page's end), how.
    """
    w = W.partitionBy(*keys).orderBy("i")
    e = entries.select(*keys, "i", F.coalesce("end_excl", F.col("page") + 1).alias("end_excl"), F.lead("num").over(w).alias("num"), F.substring(F.lead("name_key").over(w), 1, NAME_LETTERS).alias("start"), F.lead("i").over(w).alias("_next"))
    l = lines.select(*keys, F.col("page").alias("end_excl"), "para_idx", "number", "name_key")
    hit = e.where("_next is not null").join(l, [*keys, "end_excl"])
    step = (
        F.when(F.col("number") == F.col("num"), 1).when(F.abs(F.col("number") - F.col("num")) <= DRIFT, 2)
        .when((F.col("start") != "") & F.col("name_key").contains(F.col("start")), 3).when(F.col("number").isNotNull(), 4)
    )
    best = hit.withColumn("_step", step).where("_step is not null").groupBy(*keys, "i").agg(F.min(F.struct("_step", "para_idx")).alias("b"))
    out = e.join(best, [*keys, "i"], "left")
    how = F.when(F.col("_next").isNull(), "last entry").when(F.col("b").isNull(), "not found").otherwise(F.get(F.array(F.lit("number"), F.lit("near number"), F.lit("name"), F.lit("first number")), F.col("b._step") - 1))
    inside = F.col("b.para_idx") > 0
    return out.select(*keys, "i", F.when(inside, F.col("end_excl")).otherwise(F.col("end_excl") - 1).alias("last_page"), F.when(inside, F.col("b.para_idx")).alias("para_end"), how.alias("how"))


def year_segments(toc: DataFrame, keys: list[str], max_depth: int = 2) -> DataFrame:
    """Rows of a table of contents (keys, i, page, end_excl, depth, title) whose titles name a year, down to a depth: year, start_page, last_page."""
    year = P.year_of_title(F.col("title"))
    named = N.heading_key(F.col("title")).startswith("سنه")
    return toc.where((F.col("depth") <= max_depth) & (named | year.isNotNull())).select(*keys, "i", year.alias("year"), F.col("page").alias("start_page"), (F.col("end_excl") - 1).alias("last_page"))


def year_in_heading(text: Column) -> Column:
    """The year a heading names, in words or, right after the word for year, in figures; or null."""
    figures = F.regexp_extract(N.ascii_digits(N.name_column(text)), r"(?:^|\s)سنه ([0-9]{1,4})(?:\D|$)", 1).try_cast("int")
    return F.coalesce(P.year_of_title(text), figures)


def flattened(segments: DataFrame, paragraphs: DataFrame, keys: list[str]) -> DataFrame:
    """The paragraphs of each group's segments (keys, with source, from_page, from_para, to_page, to_para) in order, each once: keys, pos (0, 1, ...), web_page, para_idx, text."""
    s = segments.select(*keys, "source", "from_page", "from_para", "to_page", "to_para") if "source" not in keys else segments.select(*keys, "from_page", "from_para", "to_page", "to_para")
    rows = slice_intervals(s.withColumn("seg_id", F.xxhash64(*s.columns)), paragraphs)
    hashed = s.withColumn("seg_id", F.xxhash64(*s.columns)).select("seg_id", *keys).distinct()
    own = [k for k in keys if k not in rows.columns]
    once = rows.select("seg_id", "source", "web_page", "para_idx", "text").join(hashed.select("seg_id", *own), "seg_id").select(*dict.fromkeys([*keys, "source"]), "web_page", "para_idx", "text").distinct()
    return once.withColumn("pos", F.row_number().over(W.partitionBy(*keys).orderBy("source", "web_page", "para_idx")) - 1)


def whole_as_intro(flat: DataFrame, rules: DataFrame, keys: list[str]) -> DataFrame:
    """Groups (keys, web_page, pos) that stand on one page alone, where a rule (keys, page) names that page: one segment with label intro. Others give no row."""
    per = flat.groupBy(*keys).agg(F.min("web_page").alias("first"), F.max("web_page").alias("last"), F.min("pos").alias("from_pos"), F.max("pos").alias("to_pos"))
    return per.join(rules.select(*keys, "page").distinct(), keys).where("first = page and last = page").select(*keys, "from_pos", "to_pos", F.lit("intro").alias("label"))


def header_range(text: Column) -> Column:
    """struct<surah, lo, hi> of a bracketed header over verses, however its letters are spelled, or null."""
    t = N.verse_key(text)
    number = lambda p, k: N.ascii_digits(F.regexp_extract(t, p, k)).cast("int")
    of = lambda p, last: F.struct(number(p, 1).alias("surah"), number(p, 2).alias("lo"), number(p, last).alias("hi"))
    return F.when(t.rlike(RANGE_HEADER), of(RANGE_HEADER, 3)).when(t.rlike(SINGLE_HEADER), of(SINGLE_HEADER, 2))


def verse_index(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Verse number to text, from blocks that a header opens and a line led by a bracket closes; pairs "text (N)"; the last of a number counts.

    rows: keys, order columns, text. Result: keys, ayah, text.
    """
    w = W.partitionBy(*keys).orderBy(*order)
    head = header_range(F.col("text")).isNotNull()
    r = rows.where("text is not null").withColumn("_event", F.when(head, 1).when(F.col("text").startswith("["), 2))
    state = F.last("_event", ignorenulls=True).over(w.rowsBetween(W.unboundedPreceding, 0))
    inside = r.withColumn("_state", state).where("_state = 1 and _event is null").withColumn("_ord", F.struct(*order))
    pattern = r"([\x{0621}-\x{064A}][\x{0621}-\x{064A}\s]+?)\s*\(([٠-٩]+)\)"
    t = N.block_key(F.col("text"))
    pairs = F.arrays_zip(F.regexp_extract_all(t, F.lit(pattern), 1).alias("t"), F.regexp_extract_all(t, F.lit(pattern), 2).alias("n"))
    x = inside.select(*keys, "_ord", F.posexplode(pairs).alias("_k", "p")).select(*keys, "_ord", "_k", N.ascii_digits(F.col("p.n")).cast("int").alias("ayah"), F.trim("p.t").alias("text"))
    return x.groupBy(*keys, "ayah").agg(F.max_by("text", F.struct("_ord", "_k")).alias("text"))


def phrase_verse(phrases: DataFrame, verses: DataFrame, keys: list[str]) -> DataFrame:
    """Each phrase (keys, pid, phrase) to a verse (keys, ayah, verse) of its chapter: by how they begin one another (the phrase of at least
    eight letters if the verse is shorter), the same without blanks, by the first two words, or one inside the other (verses of twelve
    letters and more); the best tier, then the least number. Texts in the verse profile. Result: keys, pid, ayah, tier; all phrases come, unmatched ones with nulls.
    """
    x = phrases.where("phrase <> ''").join(verses.where("verse <> ''"), keys)
    p, v = F.col("phrase"), F.col("verse")
    bare = lambda c: F.replace(c, F.lit(" "), F.lit(""))
    two = F.array_join(F.slice(F.split(p, " "), 1, 2), " ")
    t = (
        F.when(v.startswith(p) | ((F.length(v) >= 8) & p.startswith(v)), 1)
        .when(bare(v).startswith(bare(p)) | ((F.length(bare(v)) >= 8) & bare(p).startswith(bare(v))), 2)
        .when((F.size(F.split(p, " ")) >= 2) & v.startswith(two), 3)
        .when(v.contains(p) | ((F.length(v) >= 12) & p.contains(v)), 4)
    )
    best = x.withColumn("tier", t).where("tier is not null").groupBy(*keys, "pid").agg(F.min(F.struct("tier", "ayah")).alias("b"))
    return phrases.select(*keys, "pid").join(best, [*keys, "pid"], "left").select(*keys, "pid", F.col("b.ayah").alias("ayah"), F.col("b.tier").alias("tier"))


def title_labels(titles: DataFrame, names: DataFrame, prefix: str) -> DataFrame:
    """(tid, title) like "prefix name 3-7", "prefix name 4" or "prefix name Introduction" to surah and label; names: surah, name.

    status: ok, unknown pattern, unknown name. Every title comes once.
    """
    rest = F.when(F.col("title").startswith(prefix), F.trim(F.substring("title", len(prefix) + 1, 10_000)))
    pattern = r"^(.*?)\s+(?:(\d+)(?:-(\d+))?|(Introduction(?: of \w+)?))$"
    t = titles.select("tid", rest.alias("r"))
    parts = t.select("tid", F.regexp_extract("r", pattern, 1).alias("n"), F.regexp_extract("r", pattern, 2).alias("lo"), F.regexp_extract("r", pattern, 3).alias("hi"), F.regexp_extract("r", pattern, 4).alias("intro"))
    parts = parts.withColumn("key", N.canonical_name(F.col("n")))
    known = names.select("surah", N.canonical_name(F.col("name")).alias("key")).groupBy("key").agg(F.min("surah").alias("surah"))
    label = F.when(F.col("intro") != "", "intro").when((F.col("hi") != "") & (F.col("hi") != F.col("lo")), F.concat_ws("-", "lo", "hi")).when(F.col("lo") != "", F.col("lo"))
    status = F.when(F.coalesce(F.col("n"), F.lit("")) == "", "unknown pattern").when(F.col("surah").isNull(), "unknown name").otherwise("ok")
    return parts.join(known, "key", "left").select("tid", "surah", F.when(status == "ok", label).alias("label"), status.alias("status"))


def segment_checks(segments: DataFrame, keys: list[str], order: list[str], lo: str, hi: str) -> DataFrame:
    """Per group: n segments, how many go back behind an earlier one (disorder), how many have no number, the widest and the share of one-verse segments."""
    w = W.partitionBy(*keys).orderBy(*order)
    before = F.max(hi).over(w.rowsBetween(W.unboundedPreceding, -1))
    x = segments.withColumn("_back", F.coalesce((F.col(lo) < before).cast("int"), F.lit(0)))
    return x.groupBy(*keys).agg(F.count("*").alias("n"), F.sum("_back").alias("n_back"), F.count_if(F.col(lo).isNull()).alias("n_unnumbered"), F.max(F.col(hi) - F.col(lo) + 1).alias("widest"), F.round(F.avg((F.col(lo) == F.col(hi)).cast("int")), 4).alias("single_share"))


# How many times the average pages of a verse a segment may have, and from where on more is an error.
DENSITY, MARGINAL = 8, 1.5


def findings(segments: DataFrame, texts: DataFrame, verses: DataFrame, chapters: DataFrame, probes: DataFrame) -> DataFrame:
    """What is wrong with the labelled segments of each book and chapter: source, surah, finding, at (a segment or verse), level (error, warning).

    segments: seg_id, source, surah, lo, hi, from_page, from_para, to_page; texts: seg_id, text of its paragraphs; verses: source, surah, ayah that labels cover; chapters: surah, n_ayat;
    probes: surah, ayah, phrase. density: a segment has more pages than DENSITY times its verses' average; an error from MARGINAL times that on. uncovered: a verse after the first label that no label
    covers, or, a warning, before it. unlabelled, not found: a probe's verse has no segment, or none with its phrase (verse profile), in a book that treats the chapter.
    """
    group = W.partitionBy("source", "surah")
    s = segments.where("lo is not null and from_page <= to_page").join(chapters, "surah").withColumn("pages", F.max("to_page").over(group) - F.min("from_page").over(group) + 1)
    span, limit = F.col("to_page") - F.col("from_page") + 1, F.col("pages") / F.col("n_ayat") * (F.col("hi") - F.col("lo") + 1) * DENSITY
    level = lambda bad: F.when(bad, "error").otherwise("warning").alias("level")
    dense = s.where(span > limit).select("source", "surah", F.lit("density").alias("finding"), F.col("seg_id").cast("string").alias("at"), level(span > MARGINAL * limit))
    first = segments.where("lo is not null").groupBy("source", "surah").agg(F.min_by("lo", F.struct("from_page", "from_para", "seg_id")).alias("first"))
    every = first.join(chapters, "surah").select("source", "surah", "first", F.explode(F.expr("sequence(1, n_ayat)")).alias("ayah"))
    gaps = every.join(verses.select("source", "surah", "ayah").distinct(), ["source", "surah", "ayah"], "left_anti").where("ayah <> first")
    gaps = gaps.select("source", "surah", F.lit("uncovered").alias("finding"), F.col("ayah").cast("string").alias("at"), level(F.col("ayah") > F.col("first")))
    asked = first.join(probes, "surah").select("source", "surah", "ayah", N.verse_key(F.col("phrase")).alias("phrase"))
    labelled = asked.join(segments.where("lo is not null").select("source", "surah", "lo", "hi", "seg_id"), ["source", "surah"]).where("ayah between lo and hi")
    found = labelled.join(texts.select("seg_id", N.verse_key(F.col("text")).alias("t")), "seg_id").where(F.col("t").contains(F.col("phrase"))).select("source", "surah", "ayah", "phrase").distinct()
    key = ["source", "surah", "ayah", "phrase"]
    have = labelled.select(*key).distinct()
    probe = lambda df, what: df.select("source", "surah", F.lit(what).alias("finding"), F.col("ayah").cast("string").alias("at"), F.lit("error").alias("level"))
    return dense.unionByName(gaps).unionByName(probe(asked.join(have, key, "left_anti"), "unlabelled")).unionByName(probe(have.join(found, key, "left_anti"), "not found"))


def merge_reviewed(reviewed: DataFrame, asked: DataFrame) -> DataFrame:
    """Reviewed links (source, number, cid, confidence) checked against what was asked (source, number, candidates): ok, rejected (not among the candidates), null, unknown question.

    A rejected or null link is unresolved. Reviews of one question: the last by confidence and id.
    """
    r = reviewed.groupBy("source", "number").agg(F.max(F.struct("confidence", "cid")).alias("r")).select("source", "number", "r.*")
    x = r.join(asked.withColumn("_asked", F.lit(True)), ["source", "number"], "left")
    outcome = F.when(F.col("_asked").isNull(), "unknown question").when(F.col("cid").isNull(), "null").when(~F.array_contains("candidates", F.col("cid")), "rejected").otherwise("ok")
    ok = outcome == "ok"
    return x.select("source", "number", F.when(ok, F.col("cid")).alias("cid"), F.coalesce("confidence", F.lit("low")).alias("confidence"), F.when(ok, "resolved").otherwise("unresolved").alias("status"), outcome.alias("outcome"))


def copy_to_pairs(resolved: DataFrame, open_rows: DataFrame) -> DataFrame:
    """Links (key, cid) copied to all open rows (rid, key) of the other edition under the same name key; of several links the least."""
    one = resolved.where("cid is not null and key <> ''").groupBy("key").agg(F.min("cid").alias("cid"))
    return open_rows.join(one, "key").select("rid", "cid")
