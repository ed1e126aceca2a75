"""Quoted verses as landmarks: headings that quote, numbered quotation blocks, cycles of sections, and what must not count as one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from warraq.functions import normalise as N
from warraq.operators.alignment import best_chain

# Openings and quotation marks, in the verse profile where letters are compared.
OPENING = r"^[()\[\]«»،. ـ]*القول في تاويل"
QUOTE = r"[﴿«]([^﴾»]{2,}?)[﴾»]"
BRACED = r"[﴿{]([^﴾}]{2,}?)[﴾}]"
NUMBER = r"\(([٠-٩]+)\)"
BLOCK_OPEN = r"^\s*[﴿{]"
CROSS_REFERENCE = r"[﴾}]\s*\[[^\]\n]{2,40}:\s*[٠-٩]+\s*\]"
SECTION_HEADS = (
    ("intro", "بين يدي السورت"), ("intro", "بينا يدي"), ("intro", "فضله"), ("intro", "فضلها"), ("section", "التسميت"), ("section", "المناسبت"),
    ("section", "اللغت"), ("tafsir", "التفسير"), ("section", "البلاغت"), ("section", "الفوائد"), ("closing", "خاتمت"),
)
BASMALAH, REFUGE = ("﷽", "بسم الله الرحمن الرحيم"), "اعوذ بالله"
CLOSING = r"^(خاتمت|اللهم امين|امين|رب يسر|رب اعن|رب يسرك واعن)"
CHAPTER = "سورت "
BEFORE_HEADING, BEFORE_CLOSING = "*[]()﴾﴿.،:; ٠١٢٣٤٥٦٧٨٩", "*[]() "


def _basmalah(key: Column) -> Column:
    # Only what holds its first word is looked at closely.
    return key.isin(*BASMALAH) | (key.contains("بسم") & (F.length(key) < 60) & (N.collapse(F.regexp_replace(key, r"[^\p{L}\s]+", " ")) == BASMALAH[1]))


def _closing(key: Column) -> Column:
    return F.ltrim(key, F.lit(BEFORE_CLOSING)).rlike(CLOSING)


def _chapter_heading(key: Column, name_key: Column) -> Column:
    t = F.ltrim(key, F.lit(BEFORE_HEADING))
    own = F.concat(F.lit(CHAPTER), name_key)
    near = F.substring(t, 1, 30).contains(CHAPTER.strip()) & t.contains(own) & (F.length(t) < 140)
    return (name_key != "") & ~_basmalah(key) & ((t == own) | t.startswith(F.concat(F.lit("تفسير "), own)) | near)


def is_basmalah(c: Column) -> Column:
    """Nothing but the basmalah, brackets and punctuation aside."""
    return _basmalah(N.verse_key(c))


def is_refuge(c: Column) -> Column:
    """Led by the formula of refuge."""
    return N.verse_key(c).startswith(REFUGE)


def is_closing(c: Column) -> Column:
    """Led by a closing phrase, brackets and asterisks aside."""
    return _closing(N.verse_key(c))


def is_chapter_heading(c: Column, name: Column) -> Column:
    """C12: "chapter NAME", the same led by "commentary on", or a short heading with "chapter" near its beginning that holds it; a null or empty name has none."""
    return _chapter_heading(N.verse_key(c), N.verse_key(name))


def guarded_segments(rows: DataFrame, anchors: DataFrame, names: DataFrame, keys: list[str], pos: str = "pos", text: str = "text") -> DataFrame:
    """All paragraphs of each group as segments: what stands before its own chapter heading and after the next one's is out of scope, then intro and
    refuge, one segment an anchor, and the closing.

    rows: keys, pos (0, 1, ... in each group), text; anchors: keys, pos, label, kind; names: keys, own_name, next_name (either may be null). Of neighbouring anchors with equal label and
    kind the first counts, of anchors at one place the least label. The last own heading before the first anchor ends the leading part; the first heading of the
    next chapter after the last anchor, or a basmalah more than one paragraph after it, begins the trailing part; the first closing phrase
    after the last anchor, before that, begins the closing. Groups without an anchor give no row. Result: keys, from_pos, to_pos, label, kind.
    """
    w = W.partitionBy(*keys).orderBy("pos")
    one = anchors.where("pos is not null").groupBy(*keys, "pos").agg(F.min(F.struct("label", "kind")).alias("a")).select(*keys, "pos", "a.*")
    same = F.lag("label").over(w).eqNullSafe(F.col("label")) & F.lag("kind").over(w).eqNullSafe(F.col("kind")) & F.lag("pos").over(w).isNotNull()
    kept = one.withColumn("_same", same).where("not _same").drop("_same").withColumn("_next", F.lead("pos").over(w))
    ends = one.groupBy(*keys).agg(F.min("pos").alias("_first"), F.max("pos").alias("_last"))
    known = names.select(*keys, N.verse_key(F.col("own_name")).alias("_own"), N.verse_key(F.col("next_name")).alias("_nextname"))
    r = rows.select(*keys, F.col(pos).alias("_p"), N.verse_key(F.col(text)).alias("_t")).join(ends, keys).join(known, keys, "left")
    p, first, last = F.col("_p"), F.col("_first"), F.col("_last")
    # A paragraph that heads its own chapter isn't taken for the next one's heading.
    own, nxt = F.coalesce(_chapter_heading(F.col("_t"), F.col("_own")), F.lit(False)), F.coalesce(_chapter_heading(F.col("_t"), F.col("_nextname")), F.lit(False))
    cuts = r.groupBy(*keys).agg(
        F.max(p).alias("_end"), F.max(F.when(own & (p < first), p)).alias("_lead"),
        F.min(F.when((nxt & ~own & (p > last)) | (_basmalah(F.col("_t")) & (p > last + 1)), p)).alias("_trail"),
        F.min(F.when((p > last) & _closing(F.col("_t")), p)).alias("_close"), F.collect_set(F.when((p < first) & F.col("_t").startswith(REFUGE), p)).alias("_refuges"), F.max("_first").alias("_first"),
    )
    cuts = cuts.withColumn("_trail", F.coalesce("_trail", F.col("_end") + 1)).withColumn("_close", F.when(F.col("_close") < F.col("_trail"), F.col("_close"))).withColumn("_zone", F.coalesce(F.col("_lead") + 1, F.lit(0)))
    cuts = cuts.withColumn("_refuge", F.array_min(F.filter("_refuges", lambda x: x >= F.col("_zone"))))
    split = F.when(F.col("_refuge") > F.col("_zone"), F.col("_refuge"))
    part = lambda a, b, label: F.struct(a.cast("long").alias("from_pos"), b.cast("long").alias("to_pos"), F.lit(label).alias("label"), F.lit(label).alias("kind"))
    around = F.array(
        part(F.when(F.col("_lead").isNotNull(), F.lit(0)), F.col("_lead"), "out_of_scope"), part(F.col("_zone"), F.coalesce(split, F.col("_first")) - 1, "intro"), part(split, F.col("_first") - 1, "istiadhah"),
        part(F.col("_close"), F.col("_trail") - 1, "closing"), part(F.col("_trail"), F.col("_end"), "out_of_scope"),
    )
    zones = cuts.select(*keys, F.explode(around).alias("s")).select(*keys, "s.*")
    stop = F.coalesce(F.col("_next"), F.coalesce("_close", "_trail")) - 1
    body = kept.join(cuts.select(*keys, "_trail", "_close"), keys).select(*keys, F.col("pos").cast("long").alias("from_pos"), stop.cast("long").alias("to_pos"), "label", "kind")
    return zones.unionByName(body).where("from_pos <= to_pos")


def is_verse_block(c: Column, verse: Column, n: int = 24) -> Column:
    """C11, X11: a displayed block without brackets: its text without printed numbers and the verse begin with the same ``n`` letters, or the shorter one begins the other."""
    body, v = F.btrim(N.verse_key(F.regexp_replace(c, NUMBER, "")), F.lit(" .،:؛-﴿﴾")), N.verse_key(verse)
    start = lambda x: F.substring(x, 1, n)
    return (v != "") & (start(body).startswith(start(v)) | start(v).startswith(start(body)))


def section_kind(c: Column) -> Column:
    """The kind that a heading of the section cycle opens, or null."""
    t = N.verse_key(c)
    return F.coalesce(*(F.when(t.startswith(head), F.lit(kind)) for kind, head in SECTION_HEADS))


def printed_numbers(c: Column) -> Column:
    """Numbers in brackets inside the first quotation (or up to the end, if it isn't closed), ascending."""
    span = F.regexp_extract(c, r"(?s)^([^﴾}]*)", 1)
    return F.array_sort(F.array_distinct(F.transform(F.regexp_extract_all(span, F.lit(NUMBER), 1), lambda n: N.ascii_digits(n).cast("int"))))


def quoting_headings(rows: DataFrame, keys: list[str], pos: str, text: str = "text") -> DataFrame:
    """Headings that open a discussion of a quoted verse: keys, pos, phrase (verse profile, numbers dropped), lo, hi (printed numbers, or null)."""
    t = F.col(text)
    h = rows.where(N.verse_key(t).rlike(OPENING) & t.rlike(QUOTE)).withColumn("_q", F.regexp_extract(t, QUOTE, 1))
    n = F.array_sort(F.transform(F.regexp_extract_all("_q", F.lit(NUMBER), 1), lambda x: N.ascii_digits(x).cast("int")))
    phrase = F.btrim(N.verse_key(F.regexp_replace("_q", NUMBER, "")), F.lit(" .،:؛"))
    return h.select(*keys, F.col(pos).alias("pos"), phrase.alias("phrase"), F.array_min(n).alias("lo"), F.array_max(n).alias("hi"))


def numbered_blocks(rows: DataFrame, keys: list[str], pos: str, text: str = "text") -> DataFrame:
    """X11, C11: paragraphs that are quotation blocks with printed numbers, not followed by a reference to another chapter; the best ascending chain of them."""
    t = F.col(text)
    n = printed_numbers(t)
    block = t.rlike(BLOCK_OPEN) & (F.size(n) > 0) & ~t.rlike(CROSS_REFERENCE)
    return best_chain(rows.where(block).select(*keys, F.col(pos).cast("bigint").alias("pos"), F.array_min(n).alias("lo"), F.array_max(n).alias("hi")), keys)


def inline_quotes(rows: DataFrame, keys: list[str], pos: str, text: str = "text", marks: str = BRACED) -> DataFrame:
    """Quotations inside paragraphs, between ``marks``: keys, pos, k (place in the paragraph), phrase (verse profile), to be matched by segmentation.phrase_verse."""
    x = rows.select(*keys, F.col(pos).alias("pos"), F.posexplode(F.regexp_extract_all(text, F.lit(marks), 1)).alias("k", "q"))
    return x.select(*keys, "pos", "k", F.btrim(N.verse_key(F.col("q")), F.lit(" .،:")).alias("phrase")).where("length(phrase) >= 2")


def section_units(rows: DataFrame, quotes: DataFrame, keys: list[str], pos: str, text: str = "text") -> DataFrame:
    """Units between headings of the section cycle, with labels from the verses they quote.

    quotes: keys, pos, k (place in the paragraph), ayah. A tafsir unit's label runs from its first quoted verse to the greatest one
    before the next tafsir unit's first; without a quote, and for notes, the label of the tafsir unit before holds on; before the first it
    is intro. Result: keys, unit, kind, from_pos, to_pos, lo, hi (null: intro or closing).
    """
    r = rows.select(*keys, F.col(pos).alias("pos"), section_kind(F.col(text)).alias("head"))
    r = r.withColumn("unit", F.sum(F.col("head").isNotNull().cast("int")).over(W.partitionBy(*keys).orderBy("pos")))
    units = r.groupBy(*keys, "unit").agg(F.coalesce(F.max("head"), F.lit("intro")).alias("kind"), F.min("pos").alias("from_pos"), F.max("pos").alias("to_pos"))
    q = quotes.join(r.select(*keys, "pos", "unit"), [*keys, "pos"])
    first = q.groupBy(*keys, "unit").agg(F.min_by("ayah", F.struct("pos", "k")).alias("lo"))
    x = units.join(first, [*keys, "unit"], "left").withColumn("lo", F.when(F.col("kind") == "tafsir", F.col("lo")))
    order = W.partitionBy(*keys).orderBy("unit")
    following = F.last("lo", ignorenulls=True).over(W.partitionBy(*keys).orderBy(F.desc("unit")).rowsBetween(W.unboundedPreceding, -1))
    x = x.withColumn("bound", F.greatest("lo", F.coalesce(following, F.lit(10_000))))
    inside = q.join(x.select(*keys, "unit", "lo", "bound"), [*keys, "unit"]).where("ayah >= lo and ayah < bound").groupBy(*keys, "unit").agg(F.max("ayah").alias("hi"))
    x = x.join(inside, [*keys, "unit"], "left").withColumn("own", F.when(F.col("lo").isNotNull(), F.struct("lo", F.coalesce("hi", "lo").alias("hi"))))
    held = F.last("own", ignorenulls=True).over(order.rowsBetween(W.unboundedPreceding, 0))
    kind = F.when(F.col("kind") == "closing", "closing").when(held.isNull(), F.when(F.col("kind") == "section", "section").otherwise("intro")).when(F.col("kind") == "intro", "section").otherwise(F.col("kind"))
    y = x.withColumn("held", held).withColumn("k2", kind)
    label = F.when(F.col("k2") != "closing", F.col("held"))
    return y.select(*keys, "unit", F.col("k2").alias("kind"), "from_pos", "to_pos", label.lo.alias("lo"), label.hi.alias("hi"))


def loadable(segments: DataFrame) -> DataFrame:
    """Segments to load: those out of scope are dropped; section from the label where it is special, else from kind, else tafsir."""
    special = F.when(F.col("label").isin("intro", "istiadhah", "closing"), F.col("label"))
    return segments.where("label is null or label <> 'out_of_scope'").withColumn("section", F.coalesce(special, F.col("kind"), F.lit("tafsir")))


def page_range_segments(ranges: DataFrame, paragraphs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Half-open page ranges (axis, source, start, end) to their paragraphs, each once per axis, and the (axis, source) pairs without any."""
    r = ranges.select("axis", F.col("source").alias("_s"), F.col("start").alias("_a"), F.col("end").alias("_b"))
    pages = r.where("_a < _b").select("axis", "_s", F.explode(F.sequence(F.col("_a"), F.col("_b") - 1)).alias("_p")).distinct()
    hit = paragraphs.join(pages, (F.col("source") == F.col("_s")) & (F.col("web_page") == F.col("_p"))).drop("_s", "_p")
    absent = ranges.select("axis", "source").distinct().join(hit.select("axis", "source").distinct(), ["axis", "source"], "left_anti")
    return hit, absent
