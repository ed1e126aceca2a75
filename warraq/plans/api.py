"""The corpus as its readers ask for it: by verse, event, person, year, number, words. Every answer is a table; what isn't there is a row that says so.

A Corpus reads the tables of one folder: pages, segments, event_registry, event_segments, persons, person_entries, sources; a table that
is missing raises CorpusMissing when a question needs it, a question that makes no sense raises InputError.
"""

from __future__ import annotations

import re
from functools import cached_property

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from warraq.functions import normalise as N
from warraq.functions import paragraphs as P
from warraq.operators import labels, resolution, search, segmentation, slicing
from warraq.plans.materialize import cut, table

#: A range of paragraphs, or a verse. Fixed patterns.
RANGE, VERSE = re.compile(r"\s*(\d+)\s*-\s*(\d+)\s*"), re.compile(r"\s*(\d+)\s*(?::\s*(\d+))?\s*")


class InputError(ValueError):
    """The question is malformed or ambiguous."""


class CorpusMissing(FileNotFoundError):
    """A table of the corpus isn't there."""


class Corpus:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def _table(self, name: str) -> DataFrame:
        try:
            return table(self.spark, self.folder, name)
        except AnalysisException as e:
            raise CorpusMissing(f"{self.folder}/{name}.parquet") from e

    @cached_property
    def paragraphs(self) -> DataFrame:
        return self._table("pages").drop("loaded_at").distinct()

    @cached_property
    def segments(self) -> DataFrame:
        return slicing.latest_rows(self._table("segments"), "seg_id").drop("loaded_at")

    @cached_property
    def event_segments_table(self) -> DataFrame:
        return slicing.latest_rows(self._table("event_segments"), "seg_id").drop("loaded_at")

    @cached_property
    def entries(self) -> DataFrame:
        return slicing.latest_rows(self._table("person_entries"), "entry_id").drop("loaded_at")

    @cached_property
    def registry(self) -> DataFrame:
        r = self._table("event_registry")
        return r.withColumn("aliases", F.transform(resolution.aliases_of(F.col("aliases_ar")), N.name_column)).withColumn("name_norm", N.name_column(F.col("name_ar")))

    @cached_property
    def sources(self) -> DataFrame:
        return self._table("sources")

    def resolve_sources(self, names: str | None) -> DataFrame:
        """The sources of a list like "a, b" by id or title, with their place in the order of display (ord), whatever the order of the list; all without one. Unknown and ambiguous names raise InputError."""
        if not names or not names.strip():
            return self.sources.withColumn("ord", F.row_number().over(W.orderBy("book_id", "source")))
        wanted = [n for n in re.split(r"[,;]", names) if n.strip()]
        aliases = self.sources.select(F.col("source").alias("target"), F.explode(F.array("source", "title_ar", "title_id")).alias("alias"))
        got = resolution.resolve_aliases(self.spark.createDataFrame([(n, n) for n in wanted], "qid string, name string"), aliases).collect()  # as many rows as names were typed
        if bad := [r.qid.strip() for r in got if r.target is None]:
            raise InputError(f"unknown source: {', '.join(bad)}")
        return self.sources.withColumn("ord", F.row_number().over(W.orderBy("book_id", "source"))).where(F.col("source").isin(*{r.target for r in got}))

    # Q1, Q2
    def verse(self, ref: str, sources: str | None = None, budget: int = 0) -> DataFrame:
        """Paragraphs on a verse (S:A) or a whole chapter (S), segment by segment within the budget; sources without any come with status absent."""
        m = VERSE.fullmatch(ref)
        if not m or not 1 <= int(m[1]) <= len(labels.VERSES):
            raise InputError(f"no verse: {ref}")
        if m[2] and not 1 <= int(m[2]) <= (n := labels.VERSES[int(m[1]) - 1]):
            raise InputError(f"chapter {m[1]} has {n} verses: {ref}")
        chapter = s = self.segments.where(F.col("surah") == int(m[1]))
        if m[2]:
            s = s.join(labels.verse_map(s).where(F.col("ayah") == int(m[2])).select("seg_id").distinct(), "seg_id")
        return self._answer(s, sources, budget, ["label", "seg_section"], chapter).withColumn("label_note", labels.label_note(F.col("label")))

    def intro(self, surah: int, sources: str | None = None, budget: int = 0) -> DataFrame:
        """Segments of a chapter that stand before its first verse: label intro or section intro."""
        s = self.segments.where((F.col("surah") == surah) & (F.col("label").isin("intro", "istiadhah") | (F.col("seg_section") == "intro")))
        return self._answer(s, sources, budget, ["label", "seg_section"], self.segments.where(F.col("surah") == surah))

    def _answer(self, segs: DataFrame, sources: str | None, budget: int, keep: list[str], around: DataFrame | None = None) -> DataFrame:
        """Rows of the answer, and for every source without any why (P18): it has no pages here, nothing at all of what lies around (the chapter), or so many segments there, but none on this."""
        wanted = self.resolve_sources(sources).select("source", "ord")
        segs = segs.join(wanted.select("source"), "source")
        rows = slicing.slice_intervals(segs, self.paragraphs).join(segs.select("seg_id", *keep), "seg_id")
        rows = slicing.within_budget(rows, ["seg_id"], ["web_page", "para_idx"], F.length("text"), budget)
        cite = slicing.citation(F.col("printed_juz"), F.col("printed_page"), F.col("url"))
        found = rows.join(wanted, "source").select("source", "ord", "seg_id", *keep, "rel_idx", "is_page_break", cite.alias("citation"), "text", F.lit("found").alias("status"))
        absent = wanted.join(rows.select("source").distinct(), "source", "left_anti")
        paged = self.paragraphs.select("source").distinct().withColumn("_paged", F.lit(True))
        near = (segs if around is None else around).groupBy("source").agg(F.count("*").alias("_near"))
        n = F.coalesce("_near", F.lit(0))
        why = F.when(F.col("_paged").isNull(), "no pages of this source").when(n == 0, "nothing on this here").otherwise(F.concat(n.cast("string"), F.lit(" segments near it, none with text on this")))
        none = absent.join(paged, "source", "left").join(near, "source", "left").select("source", "ord", why.alias("reason"), F.lit("absent").alias("status"))
        return found.unionByName(none, allowMissingColumns=True)

    # Q3
    def verse_coverage(self, surah: int | None = None) -> DataFrame:
        v = labels.verse_map(self.segments if surah is None else self.segments.where(F.col("surah") == surah)).where("surah is not null")
        totals = labels.chapters(self.spark)
        missing = slicing.compressed(labels.missing_verses(v, totals, ["source", "surah"]), ["source", "surah"], "ayah")
        return labels.coverage(v, totals, ["source", "surah"]).join(missing.select("source", "surah", F.col("numbers").alias("missing")), ["source", "surah"], "left")

    # Q4, Q5, Q12
    def toc(self, seg_ids: list[int] | None, events: bool = False) -> DataFrame:
        """Sub-headings of segments (None: of all) with relative index, and the section each opens."""
        rows = slicing.slice_intervals(self._chosen(seg_ids, events), self.paragraphs)
        parts = slicing.sections(rows, ["seg_id"], "rel_idx")
        return parts.select("seg_id", "section", "title", "from_idx", "to_idx", "n_chars", "kind")

    def text(self, seg_id: int, events: bool = False, paras: str | None = None, skip_verse: bool = False) -> DataFrame:
        """Full text of a segment; paras "A-B" takes relative paragraphs A to B (B past the end means the end; a beginning past it is an error), skip_verse leaves verse out."""
        rows = slicing.slice_intervals(self._chosen([seg_id], events), self.paragraphs)
        rows = slicing.verse_flags(rows, ["seg_id"], ["rel_idx"])
        if paras is not None:
            m = RANGE.fullmatch(paras)
            if not m or int(m[1]) > int(m[2]):
                raise InputError(f"no range of paragraphs: {paras}")
            rows = slicing.paragraph_range(rows, ["seg_id"], int(m[1]), int(m[2]))
            if not rows.where("status = 'out of range'").isEmpty():
                raise InputError(f"segment {seg_id} ends before paragraph {m[1]}")
        if skip_verse:
            rows = rows.where("not is_verse")
        cite = slicing.citation(F.col("printed_juz"), F.col("printed_page"), F.col("url"))
        return rows.select("seg_id", "rel_idx", "is_page_break", cite.alias("citation"), "is_verse", "text").orderBy("rel_idx")

    def _chosen(self, seg_ids: list[int] | None, events: bool) -> DataFrame:
        s = self.event_segments_table if events else self.segments
        return s if seg_ids is None else s.where(F.col("seg_id").isin(*seg_ids))

    # Q6, R9
    def event(self, query: str, sources: str | None = None, budget: int = 0) -> DataFrame:
        """Paragraphs on an event, by id or name; a roll-up of a year answers as the year does. An ambiguous name gives its candidates, with status ambiguous."""
        self.resolve_sources(sources)  # an unknown source is an error whatever the name finds
        got = resolution.resolve_events(self.spark.createDataFrame([(1, query)], "qid int, query string"), self.registry)
        hit = got.where("status = 'resolved'").select("event_id", resolution.roll_up_year(F.col("event_id")).alias("year")).limit(1).collect()
        if not hit:
            return got.join(self.registry.select("event_id", "name_ar", "name_id"), "event_id", "left").select("event_id", "name_ar", "name_id", "status")
        if hit[0].year is not None:
            return self.year(hit[0].year)
        return self._answer(self.event_segments_table.where(F.col("event_id") == hit[0].event_id), sources, budget, ["event_id", "basis"])

    def events(self) -> DataFrame:
        return self.registry.select("seq", "event_id", "name_ar", "name_id", "era", "year_h").orderBy("seq")

    # Q7, R7
    def person(self, query: str) -> DataFrame:
        """All entries of a person, by number or name, the canonical one first; of several persons the candidates by their sources, the first with status suggested if it stands out."""
        persons = self._table("persons").select(F.col("ishabah_id").alias("person"), F.col("name_ar").alias("name"))
        e = self.entries.select(F.col("ishabah_id").alias("person"), "source", F.col("name_ar").alias("name"))
        got = resolution.resolve_persons(self.spark.createDataFrame([(1, query)], "qid int, query string"), persons, e)
        top = got.orderBy("rank").limit(1).collect()
        if not top or top[0].status == "absent":
            return self.spark.createDataFrame([("absent",)], "status string")
        if top[0].status != "resolved":
            return got.join(persons, "person").drop("qid").orderBy("rank")
        note = F.when(F.col("link_confidence").isin("medium", "low"), F.concat(F.lit("link of "), "link_confidence", F.lit(" confidence")))
        rows = self.entries.where(F.col("ishabah_id") == top[0].person)
        return rows.select("source", "entry_num", "name_ar", "link_status", "link_method", note.alias("note"), "from_page", "to_page", F.lit("found").alias("status")).orderBy(F.col("link_status") != "canonical", "source", "entry_num")

    # Q8, R8
    @cached_property
    def year_segments(self) -> DataFrame:
        """The paragraphs from one heading that names a year to the next, per source: seg_id, year_h, source, from_page, from_para, to_page, to_para."""
        p = self.paragraphs.where("text is not null")
        # Few rows are headings; the years are read from those alone.
        heads = cut(p.where(P.is_heading(F.col("text"))).select("para_id", "source", "web_page", "para_idx", "text"), "headings")
        named = cut(heads.withColumn("year_h", segmentation.year_in_heading(F.col("text"))).where("year_h is not null").drop("text"), "years")
        at = F.struct("web_page", "para_idx")
        last = p.groupBy("source").agg(F.max(at).alias("_last"))
        w = W.partitionBy("source").orderBy("web_page", "para_idx", "para_id")
        x = named.withColumn("_next", F.lead(at).over(w)).join(last, "source")
        to_page = F.when(F.col("_next").isNull(), F.col("_last.web_page")).when(F.col("_next.para_idx") > 0, F.col("_next.web_page")).otherwise(F.col("_next.web_page") - 1)
        to_para = F.when(F.col("_next").isNull(), F.col("_last.para_idx")).when(F.col("_next.para_idx") > 0, F.col("_next.para_idx") - 1)
        return x.select(F.col("para_id").alias("seg_id"), "year_h", "source", F.col("web_page").alias("from_page"), F.col("para_idx").alias("from_para"), to_page.alias("to_page"), to_para.alias("to_para"))

    def year(self, year: int) -> DataFrame:
        """Segments and registered events of a year; without segments, the first and last year that have some (kind absent)."""
        got = resolution.answer_years(self.spark.createDataFrame([(year,)], "year int"), self.registry, self.year_segments)
        names = self.registry.select(F.col("event_id").alias("id"), "name_ar", "name_id", "era", "year_note")
        status = F.when(F.col("kind") == "absent", "absent").otherwise("found")
        return got.join(names, "id", "left").select("kind", "id", "name_ar", "name_id", "era", "year_note", "first_year", "last_year", status.alias("status"))

    # Q9
    def search(self, query: str) -> DataFrame:
        """Events, persons and entries of no person under a name, by tier of match; a row of kind hidden counts the roll-ups that aren't shown."""
        q = self.spark.createDataFrame([(1, query)], "qid int, query string")
        e = self.entries.select("entry_id", F.col("ishabah_id").alias("person"), "source", "entry_num", F.col("name_ar").alias("name"))
        p = self._table("persons").select(F.col("ishabah_id").alias("person"), F.col("name_ar").alias("name"))
        found = resolution.search_names(q, self.registry, p, e).drop("qid")
        return found.withColumn("tier", F.when(F.col("score").isNotNull(), search.tier_label(F.col("score")))).orderBy("kind", "rank")

    # Q10, Q11, Q16
    def coverage(self) -> DataFrame:
        """Per source: events treated and absent, entries and linked share."""
        total = self.registry.where(~F.col("event_id").rlike("^tahun_.*_h$")).agg(F.count("*").alias("n_registered"))
        ev = self.event_segments_table.where("event_id is not null").groupBy("source").agg(F.count_distinct("event_id").alias("n_events"))
        li = self.entries.groupBy("source").agg(F.count("*").alias("n_entries"), F.count_if(F.col("link_status").isin("resolved", "canonical")).alias("n_linked"))
        out = self.sources.select("source", "book_role").join(ev, "source", "left").join(li, "source", "left").crossJoin(F.broadcast(total))
        zero = out.na.fill(0, ["n_events", "n_entries", "n_linked"])
        return zero.withColumn("n_absent", F.col("n_registered") - F.col("n_events")).withColumn("linked_percent", F.when(F.col("n_entries") > 0, F.round(100.0 * F.col("n_linked") / F.col("n_entries"), 1)))

    def info(self) -> DataFrame:
        """Every source with its size and the numbers of its entries, or without pages."""
        p = self.paragraphs.groupBy("source").agg(F.count("*").alias("n_paras"), F.count_distinct("web_page").alias("n_pages"), F.sum(F.length("text")).alias("n_chars"))
        e = self.entries.groupBy("source").agg(F.count("*").alias("n_entries"), F.min("entry_num").alias("first_number"), F.max("entry_num").alias("last_number"))
        return self.sources.join(p, "source", "left").join(e, "source", "left").withColumn("status", F.when(F.col("n_paras").isNull(), "no pages").otherwise("ok")).orderBy("source")

    # Q13
    def entries_by_number(self, ref: str, offset: int = 0, budget: int = 0) -> DataFrame:
        """Entries of a reference like book:1-5,7, from item ``offset`` on while their names fit into ``budget`` characters (0: all); the last row shown has next_offset, if more follow.

        Numbers that aren't there come with status missing and a note on the numbers that are; a number under which several entries stand gives them all, with status ambiguous.
        """
        spans = resolution.parse_references(self.spark.createDataFrame([("q", ref)], "qid string, ref string"))
        bad = spans.where("status <> 'ok'").limit(1).collect()
        if bad:
            raise InputError(f"{bad[0].status}: {ref}")
        e = self.entries.select(F.col("entry_id").alias("row_id"), F.col("source").alias("book"), F.col("entry_num").cast("bigint").alias("num"), F.lit(None).cast("bigint").alias("num_to"), F.lit(None).cast("string").alias("num_label"))
        got = resolution.look_up_numbers(spans, e)
        rows = got.join(self.entries.select(F.col("entry_id").alias("row_id"), "name_ar", "from_page", "to_page"), "row_id", "left").drop("qid")
        span = e.groupBy("book").agg(F.concat_ws(" to ", F.min("num").cast("string"), F.max("num").cast("string")).alias("_span"), F.count("*").alias("_n"))
        several = F.count("row_id").over(W.partitionBy("book", "num"))
        status = F.when((F.col("status") != "missing") & (several > 1), "ambiguous").otherwise(F.col("status"))
        note = F.when(F.col("status") == "missing", F.coalesce(F.concat(F.lit("numbers here: "), "_span", F.lit(", in "), F.col("_n").cast("string"), F.lit(" entries")), F.lit("no such book here"))).when(F.col("status") == "by label", "found in the label")
        rows = rows.join(span, "book", "left").withColumn("note", note).withColumn("status", status).drop("_span", "_n")
        at = W.orderBy("book", "num", "row_id")
        rows = rows.withColumn("item", F.row_number().over(at) - 1).withColumn("_n", F.count("*").over(W.partitionBy())).where(F.col("item") >= offset)
        shown = slicing.within_budget(rows.withColumn("_one", F.lit(1)), ["_one"], ["item"], F.coalesce(F.length("name_ar"), F.lit(0)), budget)
        last = F.max("item").over(W.partitionBy())
        return shown.withColumn("next_offset", F.when((F.col("item") == last) & (F.col("item") + 1 < F.col("_n")), F.col("item") + 1)).drop("_one", "cum_size", "_n").orderBy("item")

    # Q14
    def full_text(self, query: str, sources: str | None = None, any_term: bool = False, limit: int = 10) -> DataFrame:
        """The most relevant paragraphs: with the phrase, else with all words (or with any of them), with snippet and citation."""
        p = self.paragraphs.join(self.resolve_sources(sources).select("source"), "source")
        postings = search.index(p, F.col("para_id"), F.col("text"))
        q = self.spark.createDataFrame([(1, query)], "qid int, query string")
        terms = search.query_terms(q)
        if terms.isEmpty():
            raise InputError("no word to look for")
        hits = search.boolean_hits(postings, terms, every=False).select("qid", "id", F.lit("any").alias("match_mode")) if any_term else search.ladder(postings, terms)
        best = search.ranked(postings.join(hits.select("id").distinct(), "id", "left_semi"), terms, limit).join(hits, ["qid", "id"])
        rows = best.join(p.select(F.col("para_id").alias("id"), "source", "printed_juz", "printed_page", "url", "text"), "id").join(F.broadcast(q), "qid")
        cite = slicing.citation(F.col("printed_juz"), F.col("printed_page"), F.col("url"))
        return rows.select("rank", "match_mode", "score", "source", F.col("id").alias("para_id"), cite.alias("citation"), search.snippet("text", "query").alias("snippet")).orderBy("rank")

    # Q15
    def headings(self, query: str, limit: int = 20) -> DataFrame:
        """Headings that contain every word of the query, first come first."""
        h = self.paragraphs.where(P.is_heading(F.col("text"))).select("source", "text", F.col("para_id").alias("ord"))
        return search.title_hits(h, ["source", "text"], F.col("text"), self.spark.createDataFrame([(1, query)], "qid int, query string"), limit).drop("qid").orderBy("rank")
