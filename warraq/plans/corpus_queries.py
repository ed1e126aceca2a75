"""Registered queries for the operators on paragraphs, segments, events and dictionary entries, over the corpus tables.

Each query is one operator over its whole tables; its equivalent in SQL, where there is one, stands right after it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from warraq.functions import normalise as N
from warraq.functions import paragraphs as P
from warraq.operators import alignment, entities, labels, resolution, search, segmentation, slicing
from warraq.plans.core_queries import ORACLE, query
from warraq.plans.materialize import cut, table
from warraq.sources import pages as src
from warraq.sources import sinks

# Search terms of the registered queries: words that the corpus' vocabulary has at every size.
PHRASES = [(1, "قال حدثنا"), (2, "أبو"), (3, "سنة"), (4, "بن عبد"), (5, "فقال إن"), (6, "كان في"), (7, "لا شيء هنا البتة"), (8, "")]
EVENT_QUERIES = [(1, "بيعة"), (2, "صلح"), (3, "hari"), (4, "baiat_00000001"), (5, "خطبة وادي"), (6, "لا يوجد"), (7, ""), (8, "يوم")]
BUDGET = 4000


def _values(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def _sql_values(rows: list[tuple]) -> str:
    return "(VALUES " + ", ".join(f"({a}, '{b}')" for a, b in rows) + ")"


def _pages(spark: SparkSession, d: str) -> DataFrame:
    """Paragraphs, each once."""
    return slicing.latest_rows(table(spark, d, "pages"), "para_id")


def _slim(spark: SparkSession, d: str, *cols: str) -> DataFrame:
    """Columns of the paragraphs; redelivered rows are equal but for loaded_at, so distinct rows are the paragraphs."""
    return table(spark, d, "pages").select(*cols).distinct()


#: For the twins alone, which don't read the constants of the profiles here.
_PHRASES = (
    "صلي الله عليه وسلم|صلي الله عليه واله وسلم|صلي الله عليه|عليه السلام|عليها السلام|عليهما السلام|رضي الله عنه|رضي الله عنها|رضي الله عنهما|رضي الله عنهم|"
    "رضي الله عنهن|رضي الله|رضوان الله عليه|رحمة الله عليه|رحمه الله|غفر الله له|اسلام رضي الله عنه|امراه|امراه ا|زوجه|زوجه النبي"
)


def _sql(profile: str, c: str) -> str:
    """A normalisation profile in DuckDB's SQL."""
    drop = lambda x, what: f"regexp_replace({x}, '{what}', '', 'g')"
    space = lambda x: f"trim(regexp_replace({x}, '{N.SPACE}', ' ', 'g'))"
    tr = lambda x, a, b: f"translate({x}, '{a}', '{b}')"
    digits = lambda x: tr(x, N.DIGITS + N.PERSIAN_DIGITS, N.ASCII_DIGITS * 2)
    if profile == "N1":
        return space(tr(drop(c, N.MARKS_QURAN), "أإآٱىة", "اااايه"))
    if profile == "N2":
        return space(tr(drop(c, N.MARKS_ALL), "أإآىة", "ااايه"))
    if profile == "N3":
        return drop(c, N.MARKS)
    if profile == "N4":
        return space(tr(drop(c, N.MARKS_QURAN), "أإآىة", "ااايت"))
    if profile == "N5":
        return space(drop(c, N.MARKS_TATWEEL))
    if profile == "N6":
        return space(digits(drop(c, N.MARKS_ALL)))
    if profile == "N6k":
        return space(f"regexp_replace({tr(f"regexp_replace({_sql('N6', c)}, '{N.MATCH_PUNCTUATION}', ' ', 'g')", 'أإآةى', 'اااهي')}, '[0-9]+', ' ', 'g')")
    if profile == "N7":
        return space(tr(tr(drop(c, N.MARKS_ALL), N.DIGITS, N.ASCII_DIGITS), "أإآةى", "اااهي"))
    if profile == "N8":
        letters = tr(drop(f"regexp_replace({c}, '{N.PRESENTATION}', ' ', 'g')", N.MARKS_ALL), "أإآٱةىؤئ", "ااااهيوي")
        only = rf"regexp_replace({letters}, '[^\x{{0621}}-\x{{064A}}\s]', ' ', 'g')"
        out = rf"regexp_replace({only}, '(^|\s)عبدال', '\1عبد ال', 'g')"
        for phrase in _PHRASES.split("|"):
            out = f"replace({out}, '{phrase}', ' ')"
        return space(out)
    if profile == "N11":
        return space(rf"regexp_replace({tr(drop(c, N.MARKS_ALL), 'أإآىة', 'ااايه')}, '[\s()\[\]«»:،؛.,\-–—]+', ' ', 'g')")
    if profile == "N12":
        return rf"regexp_replace(lower({_sql('N1', digits(c))}), '[^\p{{L}}\p{{N}}]+', '', 'g')"
    raise KeyError(profile)


_STRIP = lambda c: f"regexp_replace(regexp_replace({c}, '^{N.SPACE}', ''), '{N.SPACE}$', '')"
_N2T = _sql("N2", "text")
_HEADING_SQL = f"""(t <> '' AND (string_split(t, ' ')[1] IN ({', '.join(f"'{w}'" for w in P.HEADING_WORDS)}) OR starts_with(t, 'ما نزل') OR regexp_matches(t, '^\\(.*[):]$') OR regexp_matches(t, '^\\[.*\\]$'))
  AND (length(t) <= 70 OR (length(t) <= 120 AND NOT regexp_matches(t, '{'|'.join(P.NARRATION)}') AND NOT regexp_matches(t, '[«»"،,]$'))))"""
_T_SQL = f"trim(regexp_replace(regexp_replace({_N2T}, 'صلي الله عليه وسلم|ﷺ|--', ' ', 'g'), '{N.SPACE}', ' ', 'g'))"
_BARE = _STRIP(f"regexp_replace({_STRIP(_sql('N3', 'text'))}, '{P.ORNAMENTS}', '')")
_SUB_SQL = rf"""length(s) <= 70 AND bare <> '' AND (regexp_matches(bare, '^\((?s:.*)\)$') OR regexp_matches(bare, '^\[(?s:.*)\]$') OR regexp_matches(bare, '^({'|'.join(P.SUB_HEADINGS)})') OR regexp_matches(lower(bare), '^({'|'.join(P.LATIN_SUB_HEADINGS)})'))"""
_LATEST = """(SELECT * FROM pages QUALIFY row_number() OVER (PARTITION BY para_id ORDER BY loaded_at DESC) = 1)"""


# ---- paragraphs and slices


@query
def paragraph_explode(spark: SparkSession, d: str) -> DataFrame:
    """Lines of the documents as paragraphs, blank ones dropped, positions kept."""
    docs = table(spark, d, "documents").select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("para_idx", "line"))
    return docs.where(~P.is_blank(F.col("line"))).select("doc_id", "para_idx", F.length("line").alias("n_chars"), F.md5("line").alias("digest"))


ORACLE["paragraph_explode"] = f"""
WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS x FROM documents WHERE text IS NOT NULL),
e AS (SELECT doc_id, unnest(range(len(x))) AS i, x FROM l)
SELECT doc_id, CAST(i AS INTEGER) AS para_idx, length(x[i + 1]) AS n_chars, md5(x[i + 1]) AS digest FROM e WHERE {_STRIP('x[i + 1]')} <> ''
"""


def _records(p: DataFrame) -> DataFrame:
    """Page records with ordered paragraph arrays."""
    meta = [F.min(c).alias(c) for c in ("book_id", "printed_juz", "printed_page", "url")]
    per = p.groupBy("source", "web_page").agg(*meta, F.array_sort(F.collect_list(F.struct("para_idx", "text"))).alias("x"))
    return per.select("source", "book_id", "web_page", "printed_juz", "printed_page", "url", F.transform("x", lambda r: r.text).alias("paras"))


@query
def page_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Page records with ordered paragraph arrays, taken apart again."""
    p = _pages(spark, d).where("text is not null")
    return src.paragraphs(_records(p)).select("source", "web_page", "para_idx", F.md5("text").alias("digest"))


ORACLE["page_round_trip"] = f"""
SELECT source, web_page, CAST(row_number() OVER (PARTITION BY source, web_page ORDER BY para_idx, text) - 1 AS INTEGER) AS para_idx, md5(text) AS digest
FROM {_LATEST} WHERE text IS NOT NULL
"""


def _slices(spark: SparkSession, d: str) -> DataFrame:
    segs = table(spark, d, "event_segments").drop("loaded_at").distinct()
    return slicing.slice_intervals(segs, _slim(spark, d, "para_id", "source", "web_page", "para_idx", "printed_juz", "printed_page", "url", "text"))


_SLICE_SQL = f"""
s AS (SELECT DISTINCT seg_id, source, from_page, coalesce(from_para, 0) AS from_para, to_page, coalesce(to_para, 2147483647) AS to_para FROM event_segments WHERE from_page <= to_page),
p AS (SELECT DISTINCT para_id, source, web_page, para_idx, printed_juz, printed_page, url, text FROM pages WHERE {_STRIP('text')} <> ''),
x AS (SELECT s.seg_id, p.* FROM s JOIN p ON s.source = p.source AND p.web_page BETWEEN s.from_page AND s.to_page
      AND (p.web_page > s.from_page OR p.para_idx >= s.from_para) AND (p.web_page < s.to_page OR p.para_idx <= s.to_para)),
r AS (SELECT *, row_number() OVER w - 1 AS rel_idx, coalesce(lag(web_page) OVER w <> web_page, true) AS is_page_break, sum(length(text)) OVER w AS cum_chars FROM x
      WINDOW w AS (PARTITION BY seg_id ORDER BY web_page, para_idx ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
"""


@query
def segment_slice(spark: SparkSession, d: str) -> DataFrame:
    """Flagship: the paragraphs of every event segment, with relative index, page breaks and citation, cut at a character budget."""
    cite = slicing.citation(F.col("printed_juz"), F.col("printed_page"), F.col("url"))
    kept = slicing.within_budget(_slices(spark, d), ["seg_id"], ["web_page", "para_idx"], F.length("text"), BUDGET)
    return kept.select("seg_id", "para_id", F.col("rel_idx").cast("bigint").alias("rel_idx"), "web_page", "is_page_break", F.length("text").alias("n_chars"), F.col("cum_size").alias("cum_chars"), cite.alias("citation"))


ORACLE["segment_slice"] = f"""WITH {_SLICE_SQL}
SELECT seg_id, para_id, rel_idx, web_page, is_page_break, length(text) AS n_chars, CAST(cum_chars AS BIGINT) AS cum_chars,
  CASE WHEN printed_page IS NULL THEN 'page not printed' ELSE concat_ws(', ', CASE WHEN printed_juz IS NOT NULL THEN 'vol. ' || printed_juz END, 'p. ' || printed_page) END || CASE WHEN url IS NULL THEN '' ELSE ' - ' || url END AS citation
FROM r WHERE cum_chars <= {BUDGET} OR rel_idx = 0
"""


@query
def segment_toc(spark: SparkSession, d: str) -> DataFrame:
    """Sub-headings inside every event segment, with their relative index."""
    return _slices(spark, d).where(P.is_heading(F.col("text")) | P.is_sub_heading(F.col("text"))).select("seg_id", F.col("rel_idx").cast("bigint").alias("rel_idx"), "para_id")


ORACLE["segment_toc"] = rf"""WITH {_SLICE_SQL},
h AS (SELECT seg_id, rel_idx, para_id, text, {_T_SQL} AS t, {_STRIP(_sql('N3', 'text'))} AS s, {_BARE} AS bare FROM r)
SELECT seg_id, rel_idx, para_id FROM h WHERE {_HEADING_SQL} OR ({_SUB_SQL})
"""


@query
def segment_budget_items(spark: SparkSession, d: str) -> DataFrame:
    """The first answer page of every document source: items within the budget, offset of the next page."""
    docs = table(spark, d, "documents").where("text is not null and source is not null")
    return slicing.budget_pages(docs, ["source"], ["doc_id"], F.length("text"), BUDGET)


ORACLE["segment_budget_items"] = f"""
WITH r AS (SELECT source, row_number() OVER w - 1 AS i, count(*) OVER (PARTITION BY source) AS n, sum(length(text)) OVER w AS used FROM documents
  WHERE text IS NOT NULL AND source IS NOT NULL WINDOW w AS (PARTITION BY source ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
k AS (SELECT * FROM r WHERE used <= {BUDGET} OR i = 0)
SELECT source, count(*) AS n_shown, CAST(max(used) AS BIGINT) AS used, CASE WHEN max(i) + 1 < max(n) THEN max(i) + 1 END AS next_offset, max(n) AS n_total FROM k GROUP BY source
"""


@query
def page_meta_first(spark: SparkSession, d: str) -> DataFrame:
    """Citation of every page, from its first paragraph."""
    return slicing.page_meta(_slim(spark, d, "para_id", "source", "web_page", "para_idx", "printed_juz", "printed_page", "url"))


ORACLE["page_meta_first"] = """
SELECT source, web_page, printed_juz, printed_page, url FROM (SELECT DISTINCT para_id, source, web_page, para_idx, printed_juz, printed_page, url FROM pages)
QUALIFY row_number() OVER (PARTITION BY source, web_page ORDER BY para_idx, para_id) = 1
"""


@query
def half_open_positions(spark: SparkSession, d: str) -> DataFrame:
    """Dictionary entries' half-open positions as inclusive ones, with missing ends filled from the page."""
    n = _slim(spark, d, "source", "web_page", "para_idx").groupBy("source", "web_page").agg((F.max("para_idx") + 1).alias("n"))
    e = table(spark, d, "person_entries").select("entry_id", "source", F.col("from_page").alias("start_page"), F.col("from_para").alias("para_start"), F.col("to_page").alias("last_page"), (F.col("to_para") + 1).alias("para_end")).distinct()
    return slicing.inclusive(e, n).select("entry_id", "source", "start_page", "from_para", "last_page", "to_para")


ORACLE["half_open_positions"] = """
WITH n AS (SELECT source, web_page, max(para_idx) + 1 AS n FROM pages GROUP BY source, web_page),
e AS (SELECT DISTINCT entry_id, source, from_page, from_para, to_page, to_para + 1 AS para_end FROM person_entries)
SELECT e.entry_id, e.source, e.from_page AS start_page, coalesce(e.from_para, 0) AS from_para, e.to_page AS last_page, coalesce(e.para_end - 1, n.n - 1) AS to_para
FROM e LEFT JOIN n ON e.source = n.source AND e.to_page = n.web_page
"""


@query
def normalise_text(spark: SparkSession, d: str) -> DataFrame:
    """Digests of every paragraph under the normalisation profiles."""
    t = F.col("text")
    profiles = {"n1": N.search_key(t), "n2": N.name_column(t), "n3": N.without_vowels(t), "n4": N.verse_key(t), "n5": N.block_key(t), "n6": N.heading_text(t), "n6k": N.heading_key(t), "n7": N.numbered_name(t), "n8": N.person_key(t), "n11": N.pair_key(t), "n12": N.alias_key(t)}
    return _slim(spark, d, "para_id", "text").select("para_id", *(F.md5(c).alias(k) for k, c in profiles.items()))


ORACLE["normalise_text"] = "SELECT para_id, " + ", ".join(f"md5({_sql(k if k != 'N6K' else 'N6k', 'text')}) AS {k.lower()}" for k in ("N1", "N2", "N3", "N4", "N5", "N6", "N6K", "N7", "N8", "N11", "N12")) + " FROM (SELECT DISTINCT para_id, text FROM pages)"


@query
def token_stats(spark: SparkSession, d: str) -> DataFrame:
    """Terms of all paragraphs: in how many, how often, and whether rare."""
    postings = search.index(_slim(spark, d, "para_id", "text"), F.col("para_id"), F.col("text"))
    per = postings.groupBy("id", "term").agg(F.count("*").alias("tf")).groupBy("term").agg(F.count("*").alias("df"), F.sum("tf").alias("cf"))
    return per.withColumn("is_rare", F.col("df") <= 10)


_TERMS = rf"""
d AS (SELECT DISTINCT para_id AS id, {_sql('N1', 'text')} AS t FROM pages WHERE text IS NOT NULL),
w AS (SELECT id, regexp_extract_all(t, '[\p{{L}}\p{{N}}_]+') AS a FROM d),
p AS (SELECT id, unnest(range(len(a))) AS pos, unnest(a) AS term FROM w)
"""
ORACLE["token_stats"] = f"WITH {_TERMS} SELECT term, count(DISTINCT id) AS df, count(*) AS cf, count(DISTINCT id) <= 10 AS is_rare FROM p GROUP BY term"


@query
def script_guard(spark: SparkSession, d: str) -> DataFrame:
    """Paragraphs and characters of foreign scripts per source."""
    p = _slim(spark, d, "para_id", "source", "text").where("text is not null")
    return p.groupBy("source").agg(F.count("*").alias("n"), F.count_if(P.has_foreign_script(F.col("text"))).alias("n_foreign"), F.sum(F.regexp_count("text", F.lit(P.FOREIGN))).alias("n_characters"))


_FOREIGN = r"[\x{370}-\x{3FF}\x{400}-\x{4FF}\x{590}-\x{5FF}\x{E00}-\x{E7F}\x{3000}-\x{9FFF}\x{FF00}-\x{FFEF}]"
ORACLE["script_guard"] = f"""
SELECT source, count(*) AS n, count(*) FILTER (WHERE regexp_matches(text, '{_FOREIGN}')) AS n_foreign, CAST(sum(len(regexp_extract_all(text, '{_FOREIGN}'))) AS BIGINT) AS n_characters
FROM (SELECT DISTINCT para_id, source, text FROM pages WHERE text IS NOT NULL) GROUP BY source
"""


@query
def classify_paragraphs(spark: SparkSession, d: str) -> DataFrame:
    """What kind of paragraph each is."""
    t = F.col("text")
    return _slim(spark, d, "para_id", "text").where("text is not null").select(
        "para_id", P.is_sub_heading(t).alias("sub_heading"), P.is_heading(t).alias("heading"), P.is_verse_line(t).alias("verse_line"), P.is_genealogy(t).alias("genealogy"),
        P.is_footnote(t).alias("footnote"), P.entry_number(t).alias("entry_number"), P.is_keyword_heading(t).alias("keyword_heading"),
    )


ORACLE["classify_paragraphs"] = rf"""
WITH a AS (SELECT DISTINCT para_id, text FROM pages WHERE text IS NOT NULL),
b AS (SELECT para_id, text, {_T_SQL} AS t, {_STRIP(_sql('N3', 'text'))} AS s, {_BARE} AS bare, string_split({_N2T}, ' ') AS w, {_sql('N6', 'text')} AS h,
  translate(regexp_replace(text, '{N.MARKS_ALL}', '', 'g'), '{N.DIGITS}', '{N.ASCII_DIGITS}') AS num FROM a),
c AS (SELECT *, string_split(h, ' ')[1] IN ({', '.join(f"'{w}'" for w in P.KEYWORD_HEADINGS)}) AS led FROM b)
SELECT para_id,
  {_SUB_SQL} AS sub_heading,
  {_HEADING_SQL} AS heading,
  contains(text, ' ... ') OR contains(text, ' … ') AS verse_line,
  len(w) >= 5 AND len(list_filter(w[1:4], lambda x: x = 'بن')) >= 1 AND len(list_filter(w[1:8], lambda x: x = 'بن')) >= 2 AS genealogy,
  regexp_matches(text, '^[\s\x{{A0}}]*(\(\d+\)|\[\d+\])') AS footnote,
  TRY_CAST(nullif(regexp_extract(num, '^\[?\s*\(?\s*(\d+)\s*[-)\]]\s*(.+)$', 1), '') AS BIGINT) AS entry_number,
  h <> '' AND length(CASE WHEN led AND contains(h, ':') THEN string_split(h, ':')[1] ELSE h END) <= 60 AND NOT contains(h, ' ... ') AND NOT regexp_matches(h, '^\(?[0-9]+\)') AND (ends_with(h, ':') OR led) AS keyword_heading
FROM c
"""


@query
def section_toc(spark: SparkSession, d: str) -> DataFrame:
    """Sections between headings of every page's paragraphs, with kind and size."""
    p = _slim(spark, d, "source", "web_page", "para_idx", "text").where(~P.is_blank(F.col("text")))
    return slicing.sections(p, ["source", "web_page"], "para_idx").select("source", "web_page", "section", "from_idx", "to_idx", "n_chars", "kind")


ORACLE["section_toc"] = f"""
WITH a AS (SELECT DISTINCT source, web_page, para_idx, text FROM pages WHERE {_STRIP('text')} <> ''),
b AS (SELECT *, {_T_SQL} AS t, string_split({_N2T}, ' ') AS w FROM a),
c AS (SELECT *, {_HEADING_SQL} AS head FROM b),
e AS (SELECT *, sum(CASE WHEN head THEN 1 ELSE 0 END) OVER (PARTITION BY source, web_page ORDER BY para_idx ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS section FROM c)
SELECT source, web_page, CAST(section AS BIGINT) AS section, min(para_idx) AS from_idx, max(para_idx) AS to_idx, CAST(sum(length(text)) AS BIGINT) AS n_chars,
  CASE WHEN avg(CASE WHEN NOT head THEN CAST(regexp_matches(text, '^[\\s\\x{{A0}}]*(\\(\\d+\\)|\\[\\d+\\])') AS INTEGER) END) >= 0.6 THEN 'note'
       WHEN avg(CASE WHEN NOT head THEN CAST(contains(text, ' ... ') OR contains(text, ' … ') AS INTEGER) END) >= 0.6 THEN 'poem'
       WHEN avg(CASE WHEN NOT head THEN CAST(len(w) >= 5 AND len(list_filter(w[1:4], lambda x: x = 'بن')) >= 1 AND len(list_filter(w[1:8], lambda x: x = 'بن')) >= 2 AS INTEGER) END) >= 0.6 THEN 'genealogy' ELSE 'text' END AS kind
FROM e GROUP BY source, web_page, section
"""


def _verse_rows(spark: SparkSession, d: str) -> DataFrame:
    p = _slim(spark, d, "para_id", "source", "web_page", "para_idx", "text").where("text is not null")
    return slicing.verse_flags(p, ["source", "web_page"], ["para_idx", "para_id"])


@query
def carry_forward_flag(spark: SparkSession, d: str) -> DataFrame:
    """Verse lines and the short lines that carry them on, page by page."""
    return _verse_rows(spark, d).select("para_id", "is_verse")


_VERSE_SQL = f"""
a AS (SELECT DISTINCT para_id, source, web_page, para_idx, text FROM pages WHERE text IS NOT NULL),
b AS (SELECT *, {_T_SQL} AS t, {_STRIP('text')} AS s FROM a),
c AS (SELECT *, contains(text, ' ... ') OR contains(text, ' … ') AS core, length(s) <= 70 AND NOT {_HEADING_SQL} AS short FROM b),
e AS (SELECT *, sum(CASE WHEN NOT core AND NOT short THEN 1 ELSE 0 END) OVER (PARTITION BY source, web_page ORDER BY para_idx, para_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS blk FROM c),
f AS (SELECT *, (core OR short) AND max(CASE WHEN core THEN 1 ELSE 0 END) OVER (PARTITION BY source, web_page, blk ORDER BY para_idx, para_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) = 1 AS is_verse FROM e)
"""
ORACLE["carry_forward_flag"] = f"WITH {_VERSE_SQL} SELECT para_id, is_verse FROM f"


@query
def skipped_runs(spark: SparkSession, d: str) -> DataFrame:
    """Runs of verse paragraphs that a reader may skip, per page."""
    return slicing.runs(_verse_rows(spark, d).where("is_verse"), ["source", "web_page"], "para_idx")


ORACLE["skipped_runs"] = f"""WITH {_VERSE_SQL},
g AS (SELECT source, web_page, para_idx, para_idx - row_number() OVER (PARTITION BY source, web_page ORDER BY para_idx) AS k FROM (SELECT DISTINCT source, web_page, para_idx FROM f WHERE is_verse))
SELECT source, web_page, min(para_idx) AS from_idx, max(para_idx) AS to_idx, count(*) AS n FROM g GROUP BY source, web_page, k
"""


# ---- labels, coverage, runs


def _segments(spark: SparkSession, d: str) -> DataFrame:
    return slicing.latest_rows(table(spark, d, "segments"), "seg_id")


_SEG = "(SELECT * FROM segments QUALIFY row_number() OVER (PARTITION BY seg_id ORDER BY loaded_at DESC) = 1)"
_SPANS = rf"""
l AS (SELECT seg_id, source, surah, unnest(regexp_split_to_array(label, '\s*,\s*')) AS part FROM {_SEG}),
b AS (SELECT *, CAST(nullif(regexp_extract(part, '^~?(\d+)(-\d+)?$', 1), '') AS INTEGER) AS lo, CAST(coalesce(nullif(regexp_extract(part, '^~?\d+-(\d+)$', 1), ''), nullif(regexp_extract(part, '^~?(\d+)(-\d+)?$', 1), '')) AS INTEGER) AS hi FROM l),
v AS (SELECT DISTINCT seg_id, source, surah, unnest(range(lo, hi + 1)) AS ayah FROM b WHERE lo <= hi)
"""


@query
def verse_map_expand(spark: SparkSession, d: str) -> DataFrame:
    """Verses of every segment's label."""
    return labels.verse_map(_segments(spark, d))


ORACLE["verse_map_expand"] = f"WITH {_SPANS} SELECT seg_id, source, surah, CAST(ayah AS INTEGER) AS ayah FROM v"


@query
def verse_segments(spark: SparkSession, d: str) -> DataFrame:
    """Which segments of which books explain each verse: verse map joined with segments."""
    s = _segments(spark, d)
    return labels.verse_map(s).join(s.select("seg_id", "seg_section", "from_page", "to_page"), "seg_id").select("surah", "ayah", "source", "seg_id", "seg_section", "from_page", "to_page").distinct()


ORACLE["verse_segments"] = f"WITH {_SPANS} SELECT DISTINCT v.surah, CAST(v.ayah AS INTEGER) AS ayah, v.source, s.seg_id, s.seg_section, s.from_page, s.to_page FROM v JOIN {_SEG} s USING (seg_id)"


#: Verses of the chapters, for the twins.
_AYAT = (
    "7 286 200 176 120 165 206 75 129 109 123 111 43 52 99 128 111 110 98 135 112 78 118 64 77 227 93 88 69 60 34 30 73 54 45 83 182 88 75 85 54 53 89 59 37 35 38 29 18 45 60 49 62 55 78 96 29 "
    "22 24 13 14 11 11 18 12 12 30 52 52 44 28 28 20 56 40 31 50 40 46 42 29 19 36 25 22 17 19 26 30 20 15 21 11 8 8 19 5 8 8 11 11 8 3 9 5 4 7 3 6 3 5 4 5 6"
)
_CHAPTERS = f"c AS (SELECT CAST(i AS INTEGER) AS surah, CAST(n AS INTEGER) AS n_ayat FROM (SELECT unnest(range(1, 115)) AS i, unnest([{_AYAT.replace(' ', ', ')}]) AS n))"


@query
def coverage_percent(spark: SparkSession, d: str) -> DataFrame:
    """Verses of every chapter that each book covers, of all that the chapter has."""
    v = labels.verse_map(_segments(spark, d))
    return labels.coverage(v, labels.chapters(spark), ["source", "surah"]).select("source", "surah", "n_ayat", "covered", "percent")


ORACLE["coverage_percent"] = f"""WITH {_SPANS}, {_CHAPTERS}
SELECT source, surah, n_ayat, count(DISTINCT ayah) FILTER (WHERE ayah BETWEEN 1 AND n_ayat) AS covered, round(100.0 * count(DISTINCT ayah) FILTER (WHERE ayah BETWEEN 1 AND n_ayat) / n_ayat, 2) AS percent
FROM v JOIN c USING (surah) GROUP BY source, surah, n_ayat
"""


@query
def missing_verse_runs(spark: SparkSession, d: str) -> DataFrame:
    """The verses that each book leaves out, as runs in one text."""
    v = labels.verse_map(_segments(spark, d))
    return slicing.compressed(labels.missing_verses(v, labels.chapters(spark), ["source", "surah"]), ["source", "surah"], "ayah")


ORACLE["missing_verse_runs"] = f"""WITH {_SPANS}, {_CHAPTERS}, k AS (SELECT DISTINCT source, surah FROM v),
a AS (SELECT source, surah, unnest(range(1, n_ayat + 1)) AS ayah FROM k JOIN c USING (surah)),
m AS (SELECT a.* FROM a LEFT JOIN (SELECT DISTINCT source, surah, ayah FROM v) w USING (source, surah, ayah) WHERE w.ayah IS NULL),
g AS (SELECT *, ayah - row_number() OVER (PARTITION BY source, surah ORDER BY ayah) AS k FROM m),
r AS (SELECT source, surah, min(ayah) AS lo, max(ayah) AS hi, count(*) AS c FROM g GROUP BY source, surah, k)
SELECT source, surah, string_agg(CASE WHEN lo = hi THEN CAST(lo AS VARCHAR) ELSE lo || '-' || hi END, ',' ORDER BY lo) AS numbers, CAST(sum(c) AS BIGINT) AS n_numbers FROM r GROUP BY source, surah
"""


@query
def verse_reference(spark: SparkSession, d: str) -> DataFrame:
    """First and last verse of every segment's label held against the chapters: ok, no chapter, no verse."""
    lo, hi = labels.bounds(F.col("label"))
    s = _segments(spark, d)
    refs = s.select("seg_id", "surah", F.lit("first").alias("end"), lo.alias("ayah")).unionByName(s.select("seg_id", "surah", F.lit("last").alias("end"), hi.alias("ayah")))
    return labels.check_verses(refs).select("seg_id", "end", "surah", "ayah", "n_ayat", "status")


ORACLE["verse_reference"] = rf"""WITH {_CHAPTERS},
b AS (SELECT seg_id, surah, regexp_matches(label, '^~?\d+(-\d+)?$') AS num, CAST(nullif(regexp_extract(label, '^~?(\d+)', 1), '') AS INTEGER) AS lo, CAST(nullif(regexp_extract(label, '-(\d+)$', 1), '') AS INTEGER) AS hi FROM {_SEG}),
r AS (SELECT seg_id, surah, 'first' AS end, CASE WHEN num THEN lo END AS ayah FROM b UNION ALL SELECT seg_id, surah, 'last', CASE WHEN num THEN coalesce(hi, lo) END FROM b)
SELECT seg_id, r."end", r.surah, ayah, n_ayat, CASE WHEN n_ayat IS NULL THEN 'no chapter' WHEN ayah IS NULL OR ayah BETWEEN 1 AND n_ayat THEN 'ok' ELSE 'no verse' END AS status FROM r LEFT JOIN c ON c.surah = r.surah
"""


@query
def absence_matrix(spark: SparkSession, d: str) -> DataFrame:
    """(source, event) pairs that were looked for and aren't there."""
    s = table(spark, d, "event_segments")
    return labels.absences(table(spark, d, "event_registry").select("event_id"), s.select("source").distinct(), s, ["source", "event_id"]).select("source", "event_id")


ORACLE["absence_matrix"] = """
SELECT s.source, e.event_id FROM event_registry e CROSS JOIN (SELECT DISTINCT source FROM event_segments) s
WHERE NOT EXISTS (SELECT 1 FROM event_segments x WHERE x.source = s.source AND x.event_id = e.event_id)
"""


@query
def orphan_rows(spark: SparkSession, d: str) -> DataFrame:
    """Rows that name what isn't there: event segments and entries that begin on a page without rows, documents of a source without a target."""
    pages = table(spark, d, "pages").select("source", F.col("web_page").alias("from_page")).distinct()
    of = lambda tab, key: table(spark, d, tab).where("from_page is not null").join(pages, ["source", "from_page"], "left_anti").select(F.lit(tab).alias("tab"), F.col(key).cast("string").alias("key"))
    docs = table(spark, d, "documents").join(table(spark, d, "mix_targets").select("source"), "source", "left_anti").select(F.lit("documents").alias("tab"), F.col("doc_id").cast("string").alias("key"))
    return of("event_segments", "seg_id").unionByName(of("person_entries", "entry_id")).unionByName(docs).distinct()


ORACLE["orphan_rows"] = """
WITH p AS (SELECT DISTINCT source, web_page FROM pages)
SELECT DISTINCT 'event_segments' AS tab, CAST(seg_id AS VARCHAR) AS key FROM event_segments e WHERE from_page IS NOT NULL AND NOT EXISTS (SELECT 1 FROM p WHERE p.source = e.source AND p.web_page = e.from_page)
UNION SELECT DISTINCT 'person_entries', CAST(entry_id AS VARCHAR) FROM person_entries e WHERE from_page IS NOT NULL AND NOT EXISTS (SELECT 1 FROM p WHERE p.source = e.source AND p.web_page = e.from_page)
UNION SELECT DISTINCT 'documents', CAST(doc_id AS VARCHAR) FROM documents d WHERE NOT EXISTS (SELECT 1 FROM mix_targets t WHERE t.source = d.source)
"""


@query
def coverage_events(spark: SparkSession, d: str) -> DataFrame:
    """Events that each source treats, of all registered ones."""
    s = table(spark, d, "event_segments").where("event_id is not null")
    total = table(spark, d, "event_registry").where(~F.col("event_id").rlike("^tahun_.*_h$")).agg(F.count("*").alias("total"))
    per = s.groupBy("source").agg(F.count_distinct("event_id").alias("n_events")).crossJoin(F.broadcast(total))
    return per.select("source", "n_events", F.round(100.0 * F.col("n_events") / F.col("total"), 1).alias("percent"))


ORACLE["coverage_events"] = "SELECT source, count(DISTINCT event_id) AS n_events, round(100.0 * count(DISTINCT event_id) / (SELECT count(*) FROM event_registry WHERE NOT regexp_matches(event_id, '^tahun_.*_h$')), 1) AS percent FROM event_segments WHERE event_id IS NOT NULL GROUP BY source"


@query
def status_histogram(spark: SparkSession, d: str) -> DataFrame:
    """Link status of each dictionary's entries, and the linked share."""
    e = table(spark, d, "person_entries").select("entry_id", "source", "link_status").distinct()
    of = lambda s: F.count_if(F.coalesce(F.col("link_status"), F.lit("none")) == s).alias(s)
    linked = F.count_if(F.col("link_status").isin("resolved", "canonical"))
    return e.groupBy("source").agg(F.count("*").alias("n"), *map(of, ("canonical", "resolved", "unresolved", "ambiguous", "none")), F.round(100.0 * linked / F.count("*"), 1).alias("percent"))


ORACLE["status_histogram"] = "SELECT source, count(*) AS n, " + ", ".join(f"count(*) FILTER (WHERE coalesce(link_status, 'none') = '{s}') AS {s}" for s in ("canonical", "resolved", "unresolved", "ambiguous", "none")) + ", round(100.0 * count(*) FILTER (WHERE link_status IN ('resolved', 'canonical')) / count(*), 1) AS percent FROM (SELECT DISTINCT entry_id, source, link_status FROM person_entries) GROUP BY source"


@query
def label_extend(spark: SparkSession, d: str) -> DataFrame:
    """Each label's end raised to the next anchor, per book and surah."""
    lo, hi = labels.bounds(F.col("label"))
    a = _segments(spark, d).withColumn("lo", lo).withColumn("hi", hi).where("lo is not null and from_page is not null")
    last = F.max("hi").over(W.partitionBy("surah"))
    a = a.withColumn("n_ayat", last)
    return labels.extend_labels(a, ["source", "surah"], ["from_page", "from_para", "seg_id"], "lo", "hi", F.col("n_ayat")).select("seg_id", "lo", "hi", "new_hi")


_ANCHORS = rf"""
a AS (SELECT *, CAST(regexp_extract(label, '^~?(\d+)', 1) AS INTEGER) AS lo, CAST(coalesce(nullif(regexp_extract(label, '-(\d+)$', 1), ''), regexp_extract(label, '^~?(\d+)', 1)) AS INTEGER) AS hi
      FROM {_SEG} WHERE regexp_matches(label, '^~?\d+(-\d+)?$') AND from_page IS NOT NULL)
"""
ORACLE["label_extend"] = f"""WITH {_ANCHORS}, b AS (SELECT *, max(hi) OVER (PARTITION BY surah) AS n, lead(lo) OVER (PARTITION BY source, surah ORDER BY from_page, from_para NULLS FIRST, seg_id) AS nx FROM a)
SELECT seg_id, lo, hi, greatest(hi, least(coalesce(nx - 1, n), n)) AS new_hi FROM b
"""


@query
def merge_overlaps(spark: SparkSession, d: str) -> DataFrame:
    """Labels that run into one another, merged in order of their place."""
    lo, hi = labels.bounds(F.col("label"))
    a = _segments(spark, d).withColumn("lo", lo).withColumn("hi", hi).where("lo is not null and from_page is not null")
    return labels.merge_labels(a, ["source", "surah"], ["from_page", "from_para", "seg_id"], "lo", "hi")


ORACLE["merge_overlaps"] = f"""WITH {_ANCHORS},
b AS (SELECT *, max(hi) OVER (PARTITION BY source, surah ORDER BY from_page, from_para NULLS FIRST, seg_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM a),
c AS (SELECT *, sum(CASE WHEN lo <= reach THEN 0 ELSE 1 END) OVER (PARTITION BY source, surah ORDER BY from_page, from_para NULLS FIRST, seg_id) AS g FROM b)
SELECT source, surah, min(lo) AS lo, max(hi) AS hi, count(*) AS n_merged FROM c GROUP BY source, surah, g
"""


@query
def page_chain_runs(spark: SparkSession, d: str) -> DataFrame:
    """Runs of event segments that join end to start."""
    s = slicing.latest_rows(table(spark, d, "event_segments"), "seg_id").where("from_page is not null").withColumn("end_excl", F.col("to_page") + 1)
    return labels.page_chains(s, ["source", "event_id"], "from_page", "end_excl", ["from_page", "seg_id"])


ORACLE["page_chain_runs"] = """
WITH s AS (SELECT * FROM event_segments WHERE from_page IS NOT NULL QUALIFY row_number() OVER (PARTITION BY seg_id ORDER BY loaded_at DESC) = 1),
a AS (SELECT source, event_id, seg_id, from_page, coalesce(to_page + 1, 2147483647) AS e FROM s),
b AS (SELECT *, CASE WHEN from_page <= lag(e) OVER w THEN 0 ELSE 1 END AS nw FROM a WINDOW w AS (PARTITION BY source, event_id ORDER BY from_page, seg_id)),
c AS (SELECT *, sum(nw) OVER (PARTITION BY source, event_id ORDER BY from_page, seg_id) AS run FROM b)
SELECT source, event_id, CAST(run AS BIGINT) AS run, min(from_page) AS first_page, nullif(max(e), 2147483647) AS last_end, count(*) AS n FROM c GROUP BY source, event_id, run
"""


@query
def longest_block(spark: SparkSession, d: str) -> DataFrame:
    """The densest block of pages on which a source treats an event."""
    s = table(spark, d, "event_segments").select("seg_id", "source", "event_id", "from_page").distinct()
    return labels.longest_block(s, ["source", "event_id"], "from_page")


ORACLE["longest_block"] = """
WITH s AS (SELECT DISTINCT seg_id, source, event_id, from_page FROM event_segments WHERE from_page IS NOT NULL),
b AS (SELECT *, CASE WHEN from_page - lag(from_page) OVER (PARTITION BY source, event_id ORDER BY from_page) <= 3 THEN 0 ELSE 1 END AS nw FROM s),
c AS (SELECT *, sum(nw) OVER (PARTITION BY source, event_id ORDER BY from_page) AS g FROM b),
p AS (SELECT source, event_id, g, min(from_page) AS from_page, max(from_page) AS to_page, count(*) AS n FROM c GROUP BY source, event_id, g)
SELECT source, event_id, from_page, to_page, n FROM p QUALIFY row_number() OVER (PARTITION BY source, event_id ORDER BY n DESC, from_page) = 1
"""


def _toc(spark: SparkSession, d: str) -> DataFrame:
    s = _segments(spark, d).where("from_page is not null and surah is not null")
    i = F.row_number().over(W.partitionBy("source").orderBy("from_page", F.coalesce("from_para", F.lit(-1)), "seg_id"))
    return s.select("source", i.alias("i"), F.col("from_page").alias("page"), F.coalesce(F.length("label"), F.lit(0)).alias("depth"))


_TOC_SQL = f"t AS (SELECT source, row_number() OVER (PARTITION BY source ORDER BY from_page, coalesce(from_para, -1), seg_id) AS i, from_page AS page, coalesce(length(label), 0) AS depth FROM {_SEG} WHERE from_page IS NOT NULL AND surah IS NOT NULL)"


@query
def next_shallower(spark: SparkSession, d: str) -> DataFrame:
    """Where each row of a table of contents ends: at the next row of no greater depth, at the next row at all."""
    return labels.toc_ends(_toc(spark, d), ["source"])


ORACLE["next_shallower"] = f"""WITH {_TOC_SQL}
SELECT a.source, CAST(a.i AS INTEGER) AS i, a.page, a.depth, (SELECT min(b.page) FROM t b WHERE b.source = a.source AND b.page > a.page AND b.depth <= a.depth) AS end_excl,
  (SELECT min(b.page) FROM t b WHERE b.source = a.source AND b.page > a.page) AS end_any FROM t a
"""


@query
def toc_parents(spark: SparkSession, d: str) -> DataFrame:
    """Parents in a pre-order table of contents."""
    return labels.toc_parents(_toc(spark, d), ["source"])


ORACLE["toc_parents"] = f"""WITH {_TOC_SQL}
SELECT a.source, CAST(a.i AS INTEGER) AS i, a.page, a.depth, CAST((SELECT max(b.i) FROM t b WHERE b.source = a.source AND b.i < a.i AND b.depth < a.depth) AS INTEGER) AS parent FROM t a
"""


@query
def interval_contains(spark: SparkSession, d: str) -> DataFrame:
    """How many of its book's pages each segment covers: intervals against page numbers."""
    pages = _slim(spark, d, "source", "web_page").select("source", "web_page", F.lit(0).alias("para_idx"), F.lit("page").alias("text"))
    whole = _segments(spark, d).select("seg_id", "source", "from_page", F.lit(0).alias("from_para"), "to_page", F.lit(0).alias("to_para"))
    return slicing.slice_intervals(whole, pages).groupBy("seg_id").agg(F.count("*").alias("n_pages"))


ORACLE["interval_contains"] = f"""
SELECT s.seg_id, count(*) AS n_pages FROM {_SEG} s JOIN (SELECT DISTINCT source, web_page FROM pages) p ON p.source = s.source AND p.web_page BETWEEN s.from_page AND s.to_page GROUP BY s.seg_id
"""


# ---- duplicates, overlays, aggregates


@query
def dedupe_first_last(spark: SparkSession, d: str) -> DataFrame:
    """First and last delivery of every paragraph."""
    p = table(spark, d, "pages").select("para_id", "loaded_at", "source")
    first = slicing.first_rows(p, "para_id").select("para_id", F.col("loaded_at").alias("first_at"))
    last = slicing.latest_rows(p, "para_id").select("para_id", F.col("loaded_at").alias("last_at"))
    day = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c)
    return first.join(last, "para_id").select("para_id", day("first_at"), day("last_at"))


ORACLE["dedupe_first_last"] = "SELECT para_id, strftime(min(loaded_at AT TIME ZONE 'UTC'), '%Y-%m-%d %H:%M:%S') AS first_at, strftime(max(loaded_at AT TIME ZONE 'UTC'), '%Y-%m-%d %H:%M:%S') AS last_at FROM pages GROUP BY para_id"


@query
def overlay_precedence(spark: SparkSession, d: str) -> DataFrame:
    """Links per entry number: reviewed ones override, the last wins; of the others the first wins."""
    e = table(spark, d, "person_entries").select("source", "entry_num", "entry_id", "ishabah_id", "link_method", F.struct("loaded_at", "entry_id").alias("at"))
    over = e.where("link_method = 'review'")
    base = e.where("link_method is null or link_method <> 'review'")
    out = resolution.overlay(base, over, ["source", "entry_num"], "at")
    return out.select("source", "entry_num", "entry_id", "ishabah_id", "link_method")


ORACLE["overlay_precedence"] = """
WITH e AS (SELECT *, coalesce(link_method = 'review', false) AS o FROM person_entries),
r AS (SELECT *, row_number() OVER (PARTITION BY source, entry_num, o ORDER BY CASE WHEN o THEN -epoch_us(loaded_at) ELSE epoch_us(loaded_at) END, CASE WHEN o THEN -entry_id ELSE entry_id END) AS k FROM e)
SELECT source, entry_num, entry_id, ishabah_id, link_method FROM r WHERE k = 1 QUALIFY row_number() OVER (PARTITION BY source, entry_num ORDER BY o DESC) = 1
"""


@query
def compress_runs(spark: SparkSession, d: str) -> DataFrame:
    """Entry numbers of every dictionary as runs."""
    return slicing.compressed(table(spark, d, "person_entries").select("source", "entry_num"), ["source"], "entry_num")


ORACLE["compress_runs"] = """
WITH a AS (SELECT DISTINCT source, entry_num AS n FROM person_entries WHERE entry_num IS NOT NULL), g AS (SELECT *, n - row_number() OVER (PARTITION BY source ORDER BY n) AS k FROM a),
r AS (SELECT source, min(n) AS lo, max(n) AS hi, count(*) AS c FROM g GROUP BY source, k)
SELECT source, string_agg(CASE WHEN lo = hi THEN CAST(lo AS VARCHAR) ELSE lo || '-' || hi END, ',' ORDER BY lo) AS numbers, CAST(sum(c) AS BIGINT) AS n_numbers FROM r GROUP BY source
"""


@query
def duplicate_policy(spark: SparkSession, d: str) -> DataFrame:
    """What to do with dictionary entries under one number."""
    e = table(spark, d, "person_entries").select("entry_id", F.concat_ws("#", "source", "entry_num").alias("key"), "name_norm").where("entry_num is not null").distinct()
    return entities.duplicate_policy(e, "key", "name_norm", "entry_id")


ORACLE["duplicate_policy"] = """
WITH e AS (SELECT DISTINCT entry_id, source || '#' || entry_num AS key, name_norm FROM person_entries WHERE entry_num IS NOT NULL AND name_norm IS NOT NULL),
p AS (SELECT key, count(*) AS n, count(DISTINCT name_norm) AS m, min(entry_id) AS least, arg_max(name_norm, length(name_norm) * 1000000000 + 0) AS any_long FROM e GROUP BY key),
l AS (SELECT key, name_norm AS longest FROM e QUALIFY row_number() OVER (PARTITION BY key ORDER BY length(name_norm) DESC, name_norm DESC) = 1),
s AS (SELECT key, entry_id AS short_id FROM e QUALIFY row_number() OVER (PARTITION BY key ORDER BY length(name_norm), name_norm, entry_id) = 1),
f AS (SELECT key, bool_and(starts_with(longest, name_norm)) AS nested FROM e JOIN l USING (key) GROUP BY key),
c AS (SELECT key, array_to_string(list_sort(list(DISTINCT entry_id))[1:6], ',') AS candidates FROM e GROUP BY key)
SELECT key, n, CASE WHEN m = 1 THEN 'dup_norm' WHEN nested THEN 'prefix' ELSE 'ambiguous' END AS how, CASE WHEN m = 1 THEN least WHEN nested THEN short_id END AS chosen, candidates
FROM p JOIN f USING (key) JOIN s USING (key) JOIN c USING (key)
"""


@query
def length_profile(spark: SparkSession, d: str) -> DataFrame:
    """Lengths of paragraphs and frequency of a probe term per source."""
    p = _slim(spark, d, "para_id", "source", "text").where("text is not null")
    n = F.length("text")
    return p.groupBy("source").agg(F.count("*").alias("n"), F.min(n).alias("shortest"), F.median(n).alias("median"), F.max(n).alias("longest"), F.round(F.sum(n) / 1000, 1).alias("kchars"), F.sum(F.regexp_count("text", F.lit("قال"))).alias("n_said"))


ORACLE["length_profile"] = "SELECT source, count(*) AS n, min(length(text)) AS shortest, CAST(median(length(text)) AS DOUBLE) AS median, max(length(text)) AS longest, round(sum(length(text)) / 1000, 1) AS kchars, CAST(sum(len(regexp_extract_all(text, 'قال'))) AS BIGINT) AS n_said FROM (SELECT DISTINCT para_id, source, text FROM pages WHERE text IS NOT NULL) GROUP BY source"


@query
def ordered_concat(spark: SparkSession, d: str) -> DataFrame:
    """Text of every page, its paragraphs in order."""
    p = _slim(spark, d, "para_id", "source", "web_page", "para_idx", "text").where("text is not null")
    x = F.array_sort(F.collect_list(F.struct("para_idx", "para_id", "text")))
    return p.groupBy("source", "web_page").agg(F.array_join(F.transform(x, lambda r: r.text), "\n").alias("t")).select("source", "web_page", F.length("t").alias("n_chars"), F.md5("t").alias("digest"))


ORACLE["ordered_concat"] = "SELECT source, web_page, length(t) AS n_chars, md5(t) AS digest FROM (SELECT source, web_page, string_agg(text, chr(10) ORDER BY para_idx, para_id) AS t FROM (SELECT DISTINCT para_id, source, web_page, para_idx, text FROM pages WHERE text IS NOT NULL) GROUP BY source, web_page)"


@query
def list_sources(spark: SparkSession, d: str) -> DataFrame:
    """Every source with its pages and paragraphs, or none."""
    p = _slim(spark, d, "para_id", "source", "web_page").groupBy("source").agg(F.count("*").alias("n_paras"), F.count_distinct("web_page").alias("n_pages"), F.min("web_page").alias("first_page"), F.max("web_page").alias("last_page"))
    return table(spark, d, "sources").select("source", "book_role").join(p, "source", "left").select("source", "book_role", F.coalesce("n_paras", F.lit(0)).alias("n_paras"), F.coalesce("n_pages", F.lit(0)).alias("n_pages"), "first_page", "last_page")


ORACLE["list_sources"] = "SELECT s.source, s.book_role, count(p.para_id) AS n_paras, count(DISTINCT p.web_page) AS n_pages, min(p.web_page) AS first_page, max(p.web_page) AS last_page FROM sources s LEFT JOIN (SELECT DISTINCT para_id, source, web_page FROM pages) p USING (source) GROUP BY s.source, s.book_role"


@query
def batch_files(spark: SparkSession, d: str) -> DataFrame:
    """Review batches of 120 entries per dictionary."""
    e = table(spark, d, "person_entries").select("source", "entry_id").distinct()
    return sinks.batches(e, "source", ["entry_id"], 120).groupBy("source", "batch_no").agg(F.count("*").alias("n"), F.min("entry_id").alias("first_entry"))


ORACLE["batch_files"] = "SELECT source, (k - 1) // 120 AS batch_no, count(*) AS n, min(entry_id) AS first_entry FROM (SELECT source, entry_id, row_number() OVER (PARTITION BY source ORDER BY entry_id) AS k FROM (SELECT DISTINCT source, entry_id FROM person_entries)) GROUP BY source, (k - 1) // 120"


@query
def equal_parts(spark: SparkSession, d: str) -> DataFrame:
    """Each source's pages in parts of about equal size."""
    pages = _slim(spark, d, "para_id", "source", "web_page", "text").groupBy("source", "web_page").agg(F.sum(F.coalesce(F.length("text"), F.lit(0))).alias("n_chars"))
    parts = sinks.equal_parts(pages, "source", ["web_page"], F.col("n_chars"), 50_000)
    return parts.groupBy("source", F.col("part_no").cast("bigint").alias("part_no")).agg(F.sum("n_chars").alias("n_chars"), F.min("web_page").alias("first_page"))


ORACLE["equal_parts"] = """
WITH p AS (SELECT source, web_page, CAST(sum(coalesce(length(text), 0)) AS BIGINT) AS s FROM (SELECT DISTINCT para_id, source, web_page, text FROM pages) GROUP BY source, web_page),
a AS (SELECT *, CAST(sum(s) OVER (PARTITION BY source) AS BIGINT) AS total, CAST(sum(s) OVER (PARTITION BY source ORDER BY web_page) - s AS BIGINT) AS before FROM p),
b AS (SELECT *, greatest(CAST(ceil(total / 50000.0) AS BIGINT), 1) AS n FROM a)
SELECT source, CASE WHEN total > 0 THEN least((before * n) // total, n - 1) ELSE 0 END AS part_no, CAST(sum(s) AS BIGINT) AS n_chars, min(web_page) AS first_page FROM b GROUP BY ALL
"""


@query
def split_export(spark: SparkSession, d: str) -> DataFrame:
    """Export files of each source, cut at chapter beginnings where they come in time."""
    pages = _slim(spark, d, "para_id", "source", "web_page", "text").groupBy("source", "web_page").agg(F.sum(F.coalesce(F.size(F.split(F.trim("text"), " +")), F.lit(0))).alias("n_words"), F.sum(F.coalesce(F.octet_length("text"), F.lit(0))).alias("n_bytes"))
    starts = table(spark, d, "event_segments").select("source", F.col("from_page").alias("web_page")).union(table(spark, d, "segments").select("source", "from_page")).distinct().withColumn("is_start", F.lit(True))
    rows = pages.join(starts, ["source", "web_page"], "left").withColumn("is_start", F.coalesce("is_start", F.lit(False)))
    files = sinks.split_export(rows, "source", ["web_page"], 8000, most_bytes=70_000)
    return files.groupBy("source", "file_no", "header").agg(F.sum("n_words").alias("n_words"), F.sum("n_bytes").alias("n_bytes"), F.min("web_page").alias("first_page"))


# ---- search and resolution


def _postings(spark: SparkSession, d: str) -> DataFrame:
    return search.index(_slim(spark, d, "para_id", "text"), F.col("para_id"), F.col("text"))


def _terms(spark: SparkSession) -> DataFrame:
    return search.query_terms(_values(spark, PHRASES, "qid int, query string"))


_QUERY = rf"""{_TERMS}, q AS (SELECT CAST(qid AS INTEGER) AS qid, regexp_extract_all({_sql('N1', 'query')}, '[\p{{L}}\p{{N}}_]+') AS a FROM {_sql_values(PHRASES)} AS v(qid, query)),
k AS (SELECT qid, len(a) AS n, unnest(range(len(a))) AS k, unnest(a) AS term FROM q),
ph AS (SELECT qid, id, n, pos - k AS start, count(*) AS c FROM p JOIN k USING (term) GROUP BY ALL HAVING count(*) = n),
dk AS (SELECT DISTINCT qid, term FROM k), nk AS (SELECT qid, count(*) AS need FROM dk GROUP BY qid),
bo AS (SELECT qid, id, count(DISTINCT term) AS n_terms, need FROM p JOIN dk USING (term) JOIN nk USING (qid) GROUP BY qid, id, need)
"""


@query
def fts_phrase(spark: SparkSession, d: str) -> DataFrame:
    """Paragraphs with a phrase, and how often."""
    return search.phrase_hits(_postings(spark, d), _terms(spark))


ORACLE["fts_phrase"] = f"WITH {_QUERY} SELECT qid, id, count(*) AS tf FROM ph GROUP BY qid, id"


@query
def fts_all_any(spark: SparkSession, d: str) -> DataFrame:
    """Paragraphs with any of a query's terms, how many, and whether all."""
    p, t = cut(_postings(spark, d), "postings"), _terms(spark)
    all_ = search.boolean_hits(p, t, every=True).select("qid", "id", F.lit(True).alias("has_all"))
    return search.boolean_hits(p, t, every=False).join(all_, ["qid", "id"], "left").select("qid", "id", "n_terms", F.coalesce("has_all", F.lit(False)).alias("has_all"))


ORACLE["fts_all_any"] = f"WITH {_QUERY} SELECT qid, id, n_terms, n_terms = need AS has_all FROM bo"


@query
def fts_ladder(spark: SparkSession, d: str) -> DataFrame:
    """Phrase hits, or where there are none the paragraphs with all terms."""
    return search.ladder(cut(_postings(spark, d), "postings"), _terms(spark))


ORACLE["fts_ladder"] = f"WITH {_QUERY} SELECT DISTINCT qid, id, 'phrase' AS match_mode FROM ph UNION ALL SELECT qid, id, 'all' FROM bo WHERE n_terms = need AND qid NOT IN (SELECT qid FROM ph)"


@query
def fts_bm25_topk(spark: SparkSession, d: str) -> DataFrame:
    """The ten most relevant paragraphs per query."""
    return search.ranked(cut(_postings(spark, d), "postings"), _terms(spark), 10)


ORACLE["fts_bm25_topk"] = f"""WITH {_QUERY}, ln AS (SELECT id, count(*) AS len FROM p GROUP BY id), st AS (SELECT count(*) AS docs, avg(len) AS al FROM ln),
tf AS (SELECT id, term, count(*) AS tf FROM p WHERE term IN (SELECT term FROM dk) GROUP BY id, term), df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
sc AS (SELECT qid, id, round(sum(CASE WHEN ln((docs - df + 0.5) / (df + 0.5)) > 0 THEN ln((docs - df + 0.5) / (df + 0.5)) ELSE 1e-6 END * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len / al))), 6) AS score
  FROM tf JOIN df USING (term) JOIN ln USING (id) CROSS JOIN st JOIN dk USING (term) GROUP BY qid, id)
SELECT qid, id, score, CAST(row_number() OVER (PARTITION BY qid ORDER BY score DESC, id) AS INTEGER) AS rank FROM sc QUALIFY rank <= 10
"""


@query
def fts_snippet(spark: SparkSession, d: str) -> DataFrame:
    """Snippets of the ten most relevant paragraphs."""
    top = fts_bm25_topk(spark, d)
    text = _slim(spark, d, "para_id", "text").withColumnRenamed("para_id", "id")
    q = _values(spark, PHRASES, "qid int, query string")
    return top.join(text, "id").join(F.broadcast(q), "qid").select("qid", "id", "rank", search.snippet("text", "query").alias("snippet"))


def _registry(spark: SparkSession, d: str) -> DataFrame:
    r = table(spark, d, "event_registry")
    return r.withColumn("aliases", F.transform(resolution.aliases_of(F.col("aliases_ar")), N.name_column)).withColumn("name_norm", N.name_column(F.col("name_ar")))


_REG = f"""r AS (SELECT event_id, seq, name_id, {_sql('N2', 'name_ar')} AS name_norm,
  CASE WHEN json_valid(aliases_ar) THEN list_transform(from_json(aliases_ar, '["VARCHAR"]'), lambda x: {_sql('N2', 'x')}) ELSE [] END AS aliases FROM event_registry),
q AS (SELECT CAST(qid AS INTEGER) AS qid, query, {_sql('N2', 'query')} AS key, lower(query) AS low FROM {_sql_values(EVENT_QUERIES)} AS v(qid, query))"""
_TIER = lambda k, q: f"(CASE WHEN {q} = '' OR {k} IS NULL THEN 0 WHEN {k} = {q} THEN 100 WHEN contains(' ' || {k} || ' ', ' ' || {q} || ' ') THEN 60 WHEN NOT contains({q}, ' ') AND contains(' ' || {k} || ' ', ' ' || {q}) THEN 40 WHEN contains({k}, {q}) THEN 10 ELSE 0 END)"


@query
def tier_search(spark: SparkSession, d: str) -> DataFrame:
    """Registered events per query by tier of match."""
    return resolution.search_registry(_values(spark, EVENT_QUERIES, "qid int, query string"), _registry(spark, d))


ORACLE["tier_search"] = f"""WITH {_REG},
x AS (SELECT qid, event_id, seq, {_TIER('name_norm', 'key')} AS name_tier, coalesce(list_max(list_transform(aliases, lambda a: {_TIER('a', 'key')})), 0) AS alias_tier, {_TIER('lower(name_id)', 'low')} AS latin_tier
      FROM r CROSS JOIN q WHERE NOT regexp_matches(event_id, '^tahun_.*_h$') OR regexp_matches(key, '^\\d+$')),
s AS (SELECT qid, event_id, seq, name_tier, greatest(name_tier, alias_tier, latin_tier) AS score FROM x),
k AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, name_tier DESC, seq) AS rank, count(*) OVER (PARTITION BY qid) AS c FROM s WHERE score > 0)
SELECT qid, event_id, score, name_tier, CASE WHEN score >= 100 THEN 'exact' WHEN score >= 60 THEN 'word' ELSE 'partial' END AS label, CAST(rank AS INTEGER) AS rank, greatest(c - 15, 0) AS n_more FROM k WHERE rank <= 15
"""


@query
def resolve_status(spark: SparkSession, d: str) -> DataFrame:
    """Events that user queries resolve to, or their candidates, or an explicit absence."""
    return resolution.resolve_events(_values(spark, EVENT_QUERIES, "qid int, query string"), _registry(spark, d))


ORACLE["resolve_status"] = f"""WITH {_REG},
x AS (SELECT qid, event_id, CASE WHEN event_id = query THEN 0 WHEN name_norm = key OR len(list_filter(aliases, lambda a: contains(' ' || a || ' ', ' ' || key || ' '))) > 0 OR lower(name_id) = low THEN 1
   WHEN contains(name_norm, key) OR len(list_filter(aliases, lambda a: contains(a, key))) > 0 OR contains(lower(name_id), low) THEN 2 END AS tier FROM r CROSS JOIN q WHERE key <> ''),
b AS (SELECT * FROM x WHERE tier IS NOT NULL QUALIFY tier = min(tier) OVER (PARTITION BY qid)),
c AS (SELECT *, count(*) OVER (PARTITION BY qid) AS n FROM b)
SELECT qid, event_id, tier, CASE WHEN tier < 2 AND n = 1 THEN 'resolved' ELSE 'ambiguous' END AS status FROM c
UNION ALL SELECT qid, NULL, NULL, 'absent' FROM q WHERE qid NOT IN (SELECT qid FROM c)
"""


@query
def title_search(spark: SparkSession, d: str) -> DataFrame:
    """Event titles that contain every word of a query, first come first."""
    t = table(spark, d, "event_registry").select("event_id", "name_ar", F.col("seq").alias("ord")).where("name_ar is not null")
    return search.title_hits(t, ["event_id"], F.col("name_ar"), _values(spark, EVENT_QUERIES, "qid int, query string"))


ORACLE["title_search"] = rf"""
WITH t AS (SELECT event_id, {_sql('N1', 'name_ar')} AS hay, seq FROM event_registry WHERE name_ar IS NOT NULL),
q AS (SELECT CAST(qid AS INTEGER) AS qid, regexp_extract_all({_sql('N1', 'query')}, '[\p{{L}}\p{{N}}_]+') AS a FROM {_sql_values(EVENT_QUERIES)} AS v(qid, query)),
h AS (SELECT qid, event_id, min(seq) AS first_ord, count(*) AS n_rows FROM t JOIN q ON len(a) > 0 AND len(list_filter(a, lambda x: NOT contains(hay, x))) = 0 GROUP BY qid, event_id, hay)
SELECT qid, event_id, first_ord, n_rows, CAST(row_number() OVER (PARTITION BY qid ORDER BY first_ord, event_id) AS INTEGER) AS rank FROM h QUALIFY rank <= 20
"""


@query
def person_search(spark: SparkSession, d: str) -> DataFrame:
    """Persons by the best match of any of their entries' names."""
    e = table(spark, d, "person_entries").select(F.col("ishabah_id").alias("person"), "source", F.col("name_ar").alias("name"))
    q = [(1, "عبد"), (2, "بن"), (3, "أبو"), (4, "بنت")]
    return resolution.search_persons(_values(spark, q, "qid int, query string"), e)


ORACLE["person_search"] = f"""
WITH e AS (SELECT ishabah_id AS person, source, {_sql('N2', 'name_ar')} AS name FROM person_entries WHERE ishabah_id IS NOT NULL),
q AS (SELECT CAST(qid AS INTEGER) AS qid, {_sql('N2', 'query')} AS key FROM (VALUES (1, 'عبد'), (2, 'بن'), (3, 'أبو'), (4, 'بنت')) AS v(qid, query)),
s AS (SELECT qid, person, max({_TIER('name', 'key')}) AS score, count(DISTINCT source) AS n_sources FROM e JOIN q ON contains(name, key) GROUP BY qid, person)
SELECT qid, person, score, n_sources, CAST(row_number() OVER (PARTITION BY qid ORDER BY score DESC, n_sources DESC, person) AS INTEGER) AS rank FROM s QUALIFY rank <= 15
"""


@query
def name_search(spark: SparkSession, d: str) -> DataFrame:
    """All that names find: events with the hidden roll-ups counted, persons, entries of no person; contained, or all words anywhere."""
    e = table(spark, d, "person_entries").select("entry_id", F.col("ishabah_id").alias("person"), "source", "entry_num", F.col("name_ar").alias("name")).distinct()
    p = table(spark, d, "persons").select(F.col("ishabah_id").alias("person"), F.col("name_ar").alias("name"))
    q = EVENT_QUERIES + [(11, "عبد"), (12, "بن"), (13, "أبو"), (14, "بنت"), (15, "بنت عبد"), (16, "بن أبو"), (17, "سنة"), (18, "هجرة سنة")]
    return resolution.search_names(_values(spark, q, "qid int, query string"), _registry(spark, d), p, e)


@query
def alias_resolve(spark: SparkSession, d: str) -> DataFrame:
    """User-typed book names to sources."""
    s = table(spark, d, "sources")
    aliases = s.select(F.col("source").alias("target"), F.explode(F.array("source", "title_ar", "title_id")).alias("alias"))
    inputs = s.select(F.concat(F.lit("a"), "source").alias("qid"), F.concat(F.lit("kitab "), "source").alias("name")).unionByName(s.select(F.concat(F.lit("b"), "source").alias("qid"), F.upper("title_id").alias("name")))
    inputs = inputs.unionByName(s.select(F.concat(F.lit("c"), "source").alias("qid"), F.substring("source", 1, 9).alias("name")))
    return resolution.resolve_aliases(inputs, aliases)


ORACLE["alias_resolve"] = f"""
WITH ak AS (SELECT DISTINCT {_sql('N12', 'alias')} AS key, source AS target FROM (SELECT source, unnest([source, title_ar, title_id]) AS alias FROM sources) WHERE {_sql('N12', 'alias')} <> ''),
al AS (SELECT key, CASE WHEN count(*) = 1 THEN min(target) END AS target FROM ak GROUP BY key),
i AS (SELECT 'a' || source AS qid, 'kitab ' || source AS name FROM sources UNION ALL SELECT 'b' || source, upper(title_id) FROM sources UNION ALL SELECT 'c' || source, substr(source, 1, 9) FROM sources),
q AS (SELECT qid, {_sql('N12', 'name')} AS key FROM i),
e AS (SELECT qid, target, 1 AS step FROM q JOIN al USING (key)),
b AS (SELECT qid, target, 2 AS step FROM q JOIN al ON EXISTS (SELECT 1 FROM (VALUES {', '.join(f"('{p}')" for p in resolution.PREFIXES)}) AS p(p) WHERE starts_with(q.key, p.p) AND al.key = substr(q.key, length(p.p) + 1))),
u AS (SELECT qid, min(target) AS target, 3 AS step FROM q JOIN ak ON length(q.key) >= 4 AND starts_with(ak.key, q.key) GROUP BY qid HAVING count(DISTINCT target) = 1),
t AS (SELECT qid, step, CASE WHEN count(*) = count(target) AND min(target) = max(target) THEN min(target) END AS target FROM (SELECT * FROM e UNION ALL SELECT * FROM b UNION ALL SELECT * FROM u) GROUP BY qid, step),
w AS (SELECT * FROM t QUALIFY row_number() OVER (PARTITION BY qid ORDER BY step) = 1)
SELECT q.qid, w.target, CASE WHEN w.step IS NULL THEN 'unknown' WHEN w.target IS NULL THEN 'ambiguous' WHEN w.step = 1 THEN 'exact' WHEN w.step = 2 THEN 'prefix dropped' ELSE 'unique start' END AS how FROM (SELECT DISTINCT qid FROM q) q LEFT JOIN w USING (qid)
"""


def _references(spark: SparkSession, d: str) -> DataFrame:
    """A reference for every numbered entry: a range forwards or backwards from its number, its number in Arabic figures, a part with a number, or nonsense."""
    e = table(spark, d, "person_entries").where("entry_num is not null").select("entry_id", "source", "entry_num").distinct()
    n, k = F.col("entry_num"), F.col("entry_id") % 6
    arabic = F.translate(n.cast("string"), "0123456789", "٠١٢٣٤٥٦٧٨٩")
    part = F.when(k == 0, F.concat(n.cast("string"), F.lit(" - "), (n + 3).cast("string"))).when(k == 1, F.concat((n + 3).cast("string"), F.lit("-"), n.cast("string"))).when(k == 2, arabic)
    part = part.when(k == 3, F.concat(F.lit("2/"), n.cast("string"))).when(k == 4, F.concat(n.cast("string"), F.lit("-"), (n + 5000).cast("string"))).otherwise(F.concat(F.lit("x"), n.cast("string")))
    return e.select(F.col("entry_id").cast("string").alias("qid"), F.concat("source", F.lit(":"), part, F.lit(","), n.cast("string")).alias("ref"))


_REFS = """
r0 AS (SELECT DISTINCT entry_id, source, entry_num AS n, entry_id % 6 AS k FROM person_entries WHERE entry_num IS NOT NULL),
r AS (SELECT CAST(entry_id AS VARCHAR) AS qid, source AS book, CASE WHEN k = 3 THEN 2 END AS sub, CASE WHEN k = 5 THEN NULL WHEN k = 1 THEN n + 3 ELSE n END AS lo, CASE WHEN k = 5 THEN NULL WHEN k = 0 THEN n + 3 WHEN k = 4 THEN n + 5000 ELSE n END AS hi,
  CASE k WHEN 1 THEN 'reversed' WHEN 4 THEN 'too wide' WHEN 5 THEN 'malformed' ELSE 'ok' END AS status FROM r0 UNION ALL SELECT CAST(entry_id AS VARCHAR), source, NULL, n, n, 'ok' FROM r0)
"""


@query
def ref_expand_missing(spark: SparkSession, d: str) -> DataFrame:
    """References to every entry's number and those after it, with the numbers that aren't there; an entry spans the numbers up to its page's end."""
    spans = resolution.parse_references(_references(spark, d)).where("status = 'ok' and sub is null")
    to = F.when(F.col("to_page") > F.col("from_page"), F.col("entry_num") + F.col("to_page") - F.col("from_page"))
    e = table(spark, d, "person_entries").select(F.col("entry_id").alias("row_id"), F.col("source").alias("book"), F.col("entry_num").cast("bigint").alias("num"), to.cast("bigint").alias("num_to"), F.lit(None).cast("string").alias("num_label")).distinct()
    return resolution.look_up_numbers(cut(spans, "spans"), e)


ORACLE["ref_expand_missing"] = f"""
WITH {_REFS}, s AS (SELECT DISTINCT qid, book, CAST(unnest(range(lo, hi + 1)) AS BIGINT) AS num FROM r WHERE status = 'ok' AND sub IS NULL),
e AS (SELECT DISTINCT entry_id, source, entry_num AS n, CASE WHEN to_page > from_page THEN entry_num + to_page - from_page ELSE entry_num END AS m FROM person_entries)
SELECT s.qid, s.book, s.num, e.entry_id AS row_id, CASE WHEN e.entry_id IS NULL THEN 'missing' ELSE 'found' END AS status FROM s LEFT JOIN e ON e.source = s.book AND s.num BETWEEN e.n AND e.m
"""


@query
def ref_grammar(spark: SparkSession, d: str) -> DataFrame:
    """What each part of a reference means, or what is wrong with it."""
    return resolution.parse_references(_references(spark, d))


ORACLE["ref_grammar"] = f"WITH {_REFS} SELECT qid, book, CAST(sub AS BIGINT) AS sub, CAST(lo AS BIGINT) AS lo, CAST(hi AS BIGINT) AS hi, status FROM r"


@query
def xref_both_ways(spark: SparkSession, d: str) -> DataFrame:
    """Events that follow one another on a page of a source, as undirected neighbours."""
    s = table(spark, d, "event_segments").where("from_page is not null and event_id is not null").select("source", "event_id", "from_page").distinct()
    pairs = s.select(F.col("event_id").alias("a"), F.lead("event_id").over(W.partitionBy("source", "from_page").orderBy("event_id")).alias("b")).where("b is not null")
    return resolution.both_ways(pairs, "a", "b")


ORACLE["xref_both_ways"] = """
WITH s AS (SELECT DISTINCT source, event_id, from_page FROM event_segments WHERE from_page IS NOT NULL AND event_id IS NOT NULL), p AS (SELECT event_id AS a, lead(event_id) OVER (PARTITION BY source, from_page ORDER BY event_id) AS b FROM s)
SELECT a AS node, b AS neighbour FROM p WHERE b IS NOT NULL UNION SELECT b, a FROM p WHERE b IS NOT NULL
"""


@query
def year_lookup(spark: SparkSession, d: str) -> DataFrame:
    """Registered events per year, with the years available in their era."""
    r = table(spark, d, "event_registry").where("year_h is not null")
    span = r.groupBy("era").agg(F.min("year_h").alias("first_year"), F.max("year_h").alias("last_year"))
    per = r.groupBy("era", "year_h").agg(F.count("*").alias("n_events"), F.min("event_id").alias("first_event"))
    return per.alias("p").join(span.alias("s"), F.col("p.era").eqNullSafe(F.col("s.era"))).select("p.era", "year_h", "n_events", "first_event", "first_year", "last_year")


ORACLE["year_lookup"] = "WITH r AS (SELECT * FROM event_registry WHERE year_h IS NOT NULL) SELECT era, year_h, count(*) AS n_events, min(event_id) AS first_event, (SELECT min(year_h) FROM r b WHERE b.era IS NOT DISTINCT FROM a.era) AS first_year, (SELECT max(year_h) FROM r b WHERE b.era IS NOT DISTINCT FROM a.era) AS last_year FROM r a GROUP BY era, year_h"


def _year_titles() -> list[tuple[str, int | None]]:
    units = list(P.UNITS.items())
    rows: list[tuple[str, int | None]] = [(f"سنة {w}", n) for w, n in units] + [(f"سنة {w} عشرة", n + 10) for w, n in units if n < 10]
    rows += [(f"سنه {w} و{t}", n + m) for w, n in units for t, m in P.TENS.items() if n < 10 and n + m <= 40]
    rows += [(f"ذكر السنة {w} من الهجرة", i + 1) for i, w in enumerate(P.ORDINALS)]
    return rows + [("ذكر ما كان في أول سنة من الهجرة", 1), ("باب آخر", None), ("سنة", None), ("سنة تسع واربعين", None)]


@query
def year_titles(spark: SparkSession, d: str) -> DataFrame:
    """Years named in words by chapter titles: every number word up to 40 made into a title, and read back."""
    t = _values(spark, [(t,) for t, _ in _year_titles()], "title string")
    return t.select("title", P.year_of_title(F.col("title")).alias("year"))


ORACLE["year_titles"] = "SELECT title, CAST(year AS INTEGER) AS year FROM (VALUES " + ", ".join(f"('{t}', {'NULL' if n is None else n})" for t, n in _year_titles()) + ") AS v(title, year)"


@query
def ordered_fallback(spark: SparkSession, d: str) -> DataFrame:
    """Where each canonical person's article begins: on its page, the one before or after, by number, else by name."""
    p = _slim(spark, d, "source", "web_page", "para_idx", "text").where("source = 'kamus_asl' and text is not null").select("web_page", "para_idx", P.entry_number(F.col("text")).alias("number"), N.numbered_name(F.col("text")).alias("key"))
    e = table(spark, d, "persons").select("ishabah_id", "from_page", F.substring(N.numbered_name(F.col("name_ar")), 1, 12).alias("start"))
    near = e.select("*", F.posexplode(F.array(F.col("from_page"), F.col("from_page") - 1, F.col("from_page") + 1)).alias("page_rank", "web_page"))
    step = F.when(F.col("number") == F.col("ishabah_id"), 1).when(F.col("key").contains(F.col("start")), 2)
    hits = near.join(p, "web_page").withColumn("step", step).where("step is not null")
    best = hits.groupBy("ishabah_id").agg(F.min(F.struct("page_rank", "step", "para_idx", "web_page")).alias("b"))
    return e.select("ishabah_id").join(best, "ishabah_id", "left").select("ishabah_id", F.col("b.web_page").alias("found_page"), F.col("b.para_idx").alias("para_idx"), F.col("b.step").alias("step"))


ORACLE["ordered_fallback"] = rf"""
WITH p AS (SELECT DISTINCT web_page, para_idx, TRY_CAST(nullif(regexp_extract(translate(regexp_replace(text, '{N.MARKS_ALL}', '', 'g'), '{N.DIGITS}', '{N.ASCII_DIGITS}'), '^\[?\s*\(?\s*(\d+)\s*[-)\]]\s*(.+)$', 1), '') AS BIGINT) AS number, {_sql('N7', 'text')} AS key FROM pages WHERE source = 'kamus_asl' AND text IS NOT NULL),
e AS (SELECT ishabah_id, from_page, substr({_sql('N7', 'name_ar')}, 1, 12) AS start FROM persons),
h AS (SELECT ishabah_id, p.web_page, para_idx, CASE p.web_page - from_page WHEN 0 THEN 0 WHEN -1 THEN 1 ELSE 2 END AS page_rank, CASE WHEN number = ishabah_id THEN 1 WHEN contains(key, start) THEN 2 END AS step FROM e JOIN p ON p.web_page BETWEEN from_page - 1 AND from_page + 1),
b AS (SELECT * FROM h WHERE step IS NOT NULL QUALIFY row_number() OVER (PARTITION BY ishabah_id ORDER BY page_rank, step, para_idx, web_page) = 1)
SELECT ishabah_id, b.web_page AS found_page, b.para_idx, b.step FROM e LEFT JOIN b USING (ishabah_id)
"""


# ---- entities


@query
def fuzzy_block_join(spark: SparkSession, d: str) -> DataFrame:
    """Words of all entries' names, from four letters on, at most one edit apart."""
    names = table(spark, d, "person_entries").select("name_ar").unionByName(table(spark, d, "persons").select("name_ar"))
    t = names.select(F.explode(F.split(N.person_key(F.col("name_ar")), " ")).alias("token")).where("length(token) >= 4").distinct()
    return entities.near_tokens(t, t).where("a < b")


_BYTES = "translate(t, '" + "".join(map(chr, range(0x621, 0x64B))) + "', '" + "".join(map(chr, range(65, 65 + 42))).replace("'", "~") + "')"
ORACLE["fuzzy_block_join"] = f"""
WITH t AS (SELECT DISTINCT t FROM (SELECT unnest(string_split({_sql('N8', 'name_ar')}, ' ')) AS t FROM (SELECT name_ar FROM person_entries UNION ALL SELECT name_ar FROM persons)) WHERE length(t) >= 4)
-- levenshtein counts bytes here, so each letter becomes one.
SELECT x.t AS a, y.t AS b FROM (SELECT t, {_BYTES} AS k FROM t) x JOIN (SELECT t, {_BYTES} AS k FROM t) y ON x.t < y.t AND abs(length(x.t) - length(y.t)) <= 1 AND levenshtein(x.k, y.k) <= 1
"""


@query
def fuzzy_words(spark: SparkSession, d: str) -> DataFrame:
    """Words of the documents in all scripts, from four letters on, at most one edit apart."""
    return entities.near_words(table(spark, d, "documents"), "text")


def _canon(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "persons").select(F.col("ishabah_id").alias("cid"), F.col("name_ar").alias("name"))


def _open(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "person_entries").where("link_status is null or link_status <> 'canonical'").select(F.col("entry_id").alias("qid"), F.col("name_ar").alias("name")).distinct()


@query
def rule_cascade(spark: SparkSession, d: str) -> DataFrame:
    """Entries to canonical persons by the cascade of ever weaker keys."""
    return entities.cascade(cut(_open(spark, d), "open"), _canon(spark, d))


@query
def kunya_titles(spark: SparkSession, d: str) -> DataFrame:
    """Entries titled by a kunya to canonical persons, by the name that the title or the article's first paragraphs give them, or by kunya and nisba."""
    e = table(spark, d, "person_entries").where("link_status is null or link_status <> 'canonical'")
    articles = e.select(F.col("entry_id").alias("seg_id"), "source", "from_page", "from_para", "to_page", "to_para").distinct()
    heads = entities.head_and_body(slicing.slice_intervals(articles, _slim(spark, d, "source", "web_page", "para_idx", "text")), P.is_heading(F.col("text"))).select(F.col("seg_id").alias("qid"), "head_text")
    q = e.select(F.col("entry_id").alias("qid"), F.col("name_ar").alias("title")).distinct().join(heads, "qid", "left").select("qid", "title", F.concat_ws(" ", "title", "head_text").alias("body"))
    canon = table(spark, d, "persons").select(F.col("ishabah_id").alias("cid"), F.concat_ws(" ", "kunya", "name_ar").alias("name"))
    return entities.kunya_titled(cut(q, "titles"), canon)


@query
def candidate_topk(spark: SparkSession, d: str) -> DataFrame:
    """Up to eight candidates per entry by all shared words of the names; the canonical persons with their stored kunya and their articles' heads."""
    p = table(spark, d, "persons")
    article = p.select(F.col("ishabah_id").alias("seg_id"), F.lit("kamus_asl").alias("source"), "from_page", "from_para", "to_page", "to_para")
    text = _slim(spark, d, "source", "web_page", "para_idx", "text").where("source = 'kamus_asl'")
    heads = entities.head_and_body(slicing.slice_intervals(article, text), P.is_heading(F.col("text"))).select(F.col("seg_id").alias("cid"), "head_text")
    aliases = entities.title_aliases(p.select(F.col("ishabah_id").alias("cid"), F.col("name_ar").alias("title")).join(heads, "cid", "left"))
    canon = p.select(F.col("ishabah_id").alias("cid"), F.col("name_ar").alias("name"), "kunya")
    return entities.candidate_list(cut(_open(spark, d), "open"), canon, cut(aliases, "aliases"))


def _named(spark: SparkSession, d: str) -> DataFrame:
    """Numbered entries with the key under which editions are paired."""
    return table(spark, d, "person_entries").where("entry_num is not null").select("entry_id", "source", "entry_num", N.pair_key(F.col("name_ar")).alias("name"), "ishabah_id", "link_status").distinct()


@query
def pair_editions(spark: SparkSession, d: str) -> DataFrame:
    """The canonical dictionary's entries paired one to one with each other dictionary's under the same name, nearest number within five first."""
    e = table(spark, d, "person_entries").where("entry_num is not null").select("source", F.col("entry_num").alias("num"), N.pair_key(F.col("name_ar")).alias("name"))
    others = e.where("source <> 'kamus_asl'").select("source", F.concat("source", F.lit("#"), "name").alias("key"), "num")
    # An entry is held only under the keys that its name has in another dictionary. A key is read at each of its marks, as a name may hold one too.
    words = F.split("key", "#")
    part = lambda start, n: F.array_join(F.slice(words, start, n), "#")
    ways = F.transform(F.sequence(F.lit(1), F.size(words) - 1), lambda i: F.struct(part(F.lit(1), i).alias("o"), part(i + 1, F.size(words)).alias("name")))
    keys = others.select("key").where("key is not null").distinct().select("key", F.explode(ways).alias("w")).select("key", "w.*")
    keys = keys.join(others.select(F.col("source").alias("o")).distinct(), "o", "left_semi")
    left = e.where("source = 'kamus_asl'").join(keys, "name").select("key", "num")
    return alignment.pair_editions(left, others)


ORACLE["pair_editions"] = f"""
WITH RECURSIVE e AS (SELECT DISTINCT source, entry_num AS num, {_sql('N11', 'name_ar')} AS name FROM person_entries WHERE entry_num IS NOT NULL),
r AS (SELECT source || '#' || name AS key, list(DISTINCT num) AS free FROM e WHERE source <> 'kamus_asl' AND name IS NOT NULL GROUP BY 1),
l AS (SELECT DISTINCT o.source || '#' || name AS key, num FROM e CROSS JOIN (SELECT DISTINCT source FROM e WHERE source <> 'kamus_asl') o WHERE e.source = 'kamus_asl'),
k AS (SELECT key, CAST(num AS BIGINT) AS num, row_number() OVER (PARTITION BY key ORDER BY num) AS i FROM l JOIN r USING (key)),
w AS (SELECT key, CAST(0 AS BIGINT) AS i, list_transform(free, lambda x: CAST(x AS BIGINT)) AS free, CAST(NULL AS BIGINT) AS a, CAST(NULL AS BIGINT) AS b FROM r
  UNION ALL SELECT key, i, list_filter(free, lambda x: x IS DISTINCT FROM b), num, b FROM (
    SELECT w.key, k.i, w.free, k.num, list_filter([num, num + 1, num - 1, num + 2, num - 2, num + 3, num - 3, num + 4, num - 4, num + 5, num - 5], lambda x: list_contains(free, x))[1] AS b FROM w JOIN k ON k.key = w.key AND k.i = w.i + 1))
SELECT a AS num_left, b AS num_right, key FROM w WHERE b IS NOT NULL
"""


@query
def pair_propagation(spark: SparkSession, d: str) -> DataFrame:
    """Open entries that take over the link of the entry of another dictionary that bears the same name."""
    e = cut(_named(spark, d), "named")
    links = e.groupBy(F.col("entry_id").alias("num")).agg(F.max("ishabah_id").alias("cid"), F.max(F.coalesce("link_status", F.lit("none"))).alias("status"))
    l, r = (e.select(F.col("entry_id").alias(n), F.col("source").alias(f"s_{n}"), "name") for n in ("num_left", "num_right"))
    pairs = l.join(r, "name").where("name <> '' and s_num_left <> s_num_right").select("num_left", "num_right")
    return entities.propagate_pairs(links, pairs)


ORACLE["pair_propagation"] = f"""
WITH e AS (SELECT DISTINCT entry_id, source, {_sql('N11', 'name_ar')} AS name, ishabah_id, link_status FROM person_entries WHERE entry_num IS NOT NULL),
k AS (SELECT entry_id AS num, max(ishabah_id) AS cid, max(coalesce(link_status, 'none')) AS status FROM e GROUP BY entry_id),
g AS (SELECT b.entry_id AS num, min(k.cid) AS given FROM e a JOIN e b ON a.name = b.name AND a.name <> '' AND a.source <> b.source JOIN k ON k.num = a.entry_id AND k.status = 'resolved' GROUP BY b.entry_id)
SELECT k.num, CASE WHEN status <> 'resolved' AND given IS NOT NULL THEN given ELSE cid END AS cid, CASE WHEN status <> 'resolved' AND given IS NOT NULL THEN 'resolved' ELSE status END AS status, status <> 'resolved' AND given IS NOT NULL AS by_pair FROM k LEFT JOIN g USING (num)
"""


# ---- order-dependent choices


@query
def monotone_select(spark: SparkSession, d: str) -> DataFrame:
    """Dictionary entries in page order whose numbers increase."""
    e = table(spark, d, "person_entries").select("entry_id", "source", "entry_num", "from_page").distinct().where("entry_num is not null and from_page is not null")
    return alignment.increasing(e, ["source"], ["from_page", "entry_num", "entry_id"], "entry_num", "from_page").select("entry_id", "accepted")


ORACLE["monotone_select"] = """
WITH RECURSIVE e AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY from_page, entry_num, entry_id) AS i FROM (SELECT DISTINCT entry_id, source, entry_num, from_page FROM person_entries WHERE entry_num IS NOT NULL AND from_page IS NOT NULL)),
w AS (SELECT entry_id, source, i, entry_num = 1 AS accepted, CASE WHEN entry_num = 1 THEN entry_num END AS last, CASE WHEN entry_num = 1 THEN from_page END AS at_page FROM e WHERE i = 1
  UNION ALL SELECT e.entry_id, e.source, e.i, CASE WHEN last IS NULL THEN e.entry_num = 1 ELSE e.entry_num > last AND e.from_page > at_page END,
    CASE WHEN CASE WHEN last IS NULL THEN e.entry_num = 1 ELSE e.entry_num > last AND e.from_page > at_page END THEN e.entry_num ELSE last END,
    CASE WHEN CASE WHEN last IS NULL THEN e.entry_num = 1 ELSE e.entry_num > last AND e.from_page > at_page END THEN e.from_page ELSE at_page END
  FROM w JOIN e ON e.source = w.source AND e.i = w.i + 1)
SELECT entry_id, accepted FROM w
"""


@query
def best_chain(spark: SparkSession, d: str) -> DataFrame:
    """The widest chain of ascending labels per book and surah."""
    lo, hi = labels.bounds(F.col("label"))
    a = _segments(spark, d).where("from_page is not null").select("source", "surah", (F.col("from_page") * 1000 + F.coalesce("from_para", F.lit(0))).alias("pos"), lo.alias("lo"), hi.alias("hi")).where("lo <= hi")
    return alignment.best_chain(a, ["source", "surah"])


ORACLE["best_chain"] = rf"""
WITH RECURSIVE s AS (SELECT source, surah, from_page * 1000 + coalesce(from_para, 0) AS pos, CASE WHEN regexp_matches(label, '^~?\d+(-\d+)?$') THEN CAST(regexp_extract(label, '^~?(\d+)', 1) AS INTEGER) END AS lo,
  CASE WHEN regexp_matches(label, '^~?\d+(-\d+)?$') THEN CAST(coalesce(nullif(regexp_extract(label, '-(\d+)$', 1), ''), regexp_extract(label, '^~?(\d+)', 1)) AS INTEGER) END AS hi FROM {_SEG} WHERE from_page IS NOT NULL),
a AS (SELECT *, row_number() OVER (PARTITION BY source, surah ORDER BY pos, lo, hi) AS j FROM s WHERE lo <= hi),
w AS (SELECT DISTINCT source, surah, CAST(0 AS BIGINT) AS j, CAST([] AS STRUCT("start" INTEGER, neg BIGINT, j BIGINT, hi INTEGER, prev BIGINT)[]) AS st FROM a
  UNION ALL SELECT source, surah, j, list_append(st, {{'start': coalesce(best."start", lo), 'neg': coalesce(best.neg, 0) - 1, 'j': j, 'hi': hi, 'prev': best.j}}) FROM (
    SELECT w.source, w.surah, a.j, a.lo, a.hi, st, list_min(list_filter(st, lambda x: x.hi < a.lo)) AS best FROM w JOIN a ON a.source IS NOT DISTINCT FROM w.source AND a.surah IS NOT DISTINCT FROM w.surah AND a.j = w.j + 1)),
f AS (SELECT * FROM w QUALIFY row_number() OVER (PARTITION BY source, surah ORDER BY j DESC) = 1),
e AS (SELECT source, surah, st, list_min(list_transform(st, lambda x: {{'span': x."start" - x.hi, 'neg': x.neg, 'j': x.j}})).j AS j FROM f),
t AS (SELECT source, surah, st, j FROM e UNION ALL SELECT source, surah, st, st[j].prev FROM t WHERE st[j].prev IS NOT NULL)
SELECT a.source, a.surah, a.pos, a.lo, a.hi FROM t JOIN a ON a.source IS NOT DISTINCT FROM t.source AND a.surah IS NOT DISTINCT FROM t.surah AND a.j = t.j
"""


@query
def align_monotone(spark: SparkSession, d: str) -> DataFrame:
    """Segments of each book and surah, in order, aligned with verse numbers of non-decreasing order by their labels."""
    lo, hi = labels.bounds(F.col("label"))
    s = _segments(spark, d).where("from_page is not null and surah is not null").withColumn("lo", lo).withColumn("hi", hi)
    pos = F.row_number().over(W.partitionBy("source", "surah").orderBy("from_page", F.coalesce("from_para", F.lit(0)), "seg_id")) - 1
    heads = cut(s.select("source", "surah", "lo", "hi", pos.alias("pos")), "heads")
    scores = heads.where("lo <= hi").select("source", "surah", "pos", F.explode(F.array(F.struct(F.col("lo").alias("ayah"), F.lit(100).alias("score")), F.struct(F.col("hi").alias("ayah"), F.lit(60).alias("score")))).alias("x")).select("source", "surah", "pos", "x.ayah", "x.score")
    best = scores.groupBy("source", "surah", "pos", "ayah").agg(F.max("score").alias("score"))
    return alignment.align(best, heads, ["source", "surah"])


@query
def heading_match_scores(spark: SparkSession, d: str) -> DataFrame:
    """Scores of neighbouring paragraphs as heading and verse."""
    p = _slim(spark, d, "source", "web_page", "para_idx", "text").where("text is not null")
    w = W.partitionBy("source", "web_page").orderBy("para_idx")
    rows = p.select("source", "web_page", "para_idx", N.verse_key(F.col("text")).alias("phrase"), F.lead(N.verse_key(F.col("text"))).over(w).alias("verse"))
    return rows.select("source", "web_page", "para_idx", alignment.match_score(F.col("phrase"), F.col("web_page") % 7, F.col("verse"), F.col("para_idx") + 1).alias("score"))


ORACLE["heading_match_scores"] = f"""
WITH p AS (SELECT source, web_page, para_idx, {_sql('N4', 'text')} AS ph, {_sql('N4', 'text')} AS t FROM (SELECT DISTINCT source, web_page, para_idx, text FROM pages WHERE text IS NOT NULL)),
q AS (SELECT *, lead(t) OVER (PARTITION BY source, web_page ORDER BY para_idx) AS v FROM p),
w AS (SELECT *, string_split(ph, ' ') AS a, string_split(v, ' ') AS b FROM q),
c AS (SELECT *, list_transform(range(1, least(len(a), len(b)) + 1), lambda i: a[i] = b[i]) AS eq FROM w)
SELECT source, web_page, para_idx, CASE WHEN v IS NULL OR ph = '' OR v = '' THEN 0 WHEN starts_with(v, ph) THEN CASE WHEN len(a) >= 3 THEN 60 ELSE 30 END
  WHEN length(replace(v, ' ', '')) >= 8 AND starts_with(ph, v) THEN 60 WHEN coalesce(nullif(list_position(eq, false), 0) - 1, len(eq)) >= 3 THEN 40 ELSE 0 END + CASE WHEN web_page % 7 = para_idx + 1 THEN 100 ELSE 0 END AS score FROM c
"""


@query
def located_headings(spark: SparkSession, d: str) -> DataFrame:
    """A table of contents of every source, its pages off by one now and then, located in the source's paragraphs, in order."""
    p = cut(_slim(spark, d, "para_id", "source", "web_page", "para_idx", "text").where("text is not null").withColumn("k", N.heading_key(F.col("text"))), "keys")
    i = F.row_number().over(W.partitionBy("source").orderBy("web_page", "para_idx", "para_id"))
    t = p.where(P.is_heading(F.col("text"))).select("source", i.alias("i"), "web_page", F.col("k").alias("tkey")).select("source", "i", (F.col("web_page") + F.col("i") % 3 - 1).cast("int").alias("page"), "tkey")
    return alignment.located(t, p.select("source", F.col("web_page").alias("page"), "para_idx", F.col("k").alias("pkey")), ["source"])


ORACLE["located_headings"] = f"""
WITH RECURSIVE p AS (SELECT *, {_sql('N6k', 'text')} AS pk, {_T_SQL} AS t FROM (SELECT DISTINCT para_id, source, web_page, para_idx, text FROM pages WHERE text IS NOT NULL)),
h AS (SELECT source, row_number() OVER (PARTITION BY source ORDER BY web_page, para_idx, para_id) AS i, web_page, pk AS tk FROM p WHERE {_HEADING_SQL}), g AS (SELECT source, i, web_page + i % 3 - 1 AS page, tk FROM h),
m AS (SELECT g.source, g.i, g.page, list_sort(list(p.para_idx) FILTER (WHERE p.web_page = g.page)) AS own, min(p.para_idx) FILTER (WHERE p.web_page = g.page - 1) AS before, min(p.para_idx) FILTER (WHERE p.web_page = g.page + 1) AS after
  FROM g LEFT JOIN p ON p.source = g.source AND p.web_page BETWEEN g.page - 1 AND g.page + 1 AND p.pk <> '' AND g.tk <> '' AND (starts_with(p.pk, substr(g.tk, 1, 15)) OR starts_with(substr(g.tk, 1, 15), substr(p.pk, 1, 15))) GROUP BY ALL),
w AS (SELECT DISTINCT source, CAST(0 AS BIGINT) AS i, CAST(-1 AS BIGINT) AS ap, CAST(-1 AS BIGINT) AS ax, CAST(NULL AS BIGINT) AS fp, CAST(NULL AS BIGINT) AS fx FROM g
  UNION ALL SELECT source, i, coalesce(fp, ap), CASE WHEN fp IS NULL THEN ax ELSE fx END, fp, fx FROM (
    SELECT *, CASE WHEN n IS NOT NULL OR len(own) > 0 THEN page WHEN before IS NOT NULL THEN page - 1 WHEN after IS NOT NULL THEN page + 1 END AS fp, coalesce(n, own[1], before, after) AS fx FROM (
      SELECT m.source, m.i, m.page, coalesce(own, []) AS own, before, after, ap, ax, list_filter(coalesce(own, []), lambda x: ap <> m.page OR x > ax)[1] AS n FROM w JOIN m ON m.source = w.source AND m.i = w.i + 1)))
SELECT source, CAST(i AS INTEGER) AS i, CAST(fp AS INTEGER) AS found_page, CAST(fx AS INTEGER) AS para_idx FROM w WHERE i > 0
"""


# ---- scans


def _html(spark: SparkSession, d: str) -> DataFrame:
    """Pages as HTML files, made from the corpus' own text."""
    esc = lambda c: F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    p = _slim(spark, d, "para_id", "source", "book_id", "web_page", "para_idx", "printed_juz", "printed_page", "url", "text").where("text is not null")
    per = p.groupBy("source", "book_id", "web_page").agg(F.array_sort(F.collect_list(F.struct("para_idx", "para_id", "text"))).alias("x"), F.min("url").alias("url"), F.min("printed_juz").alias("juz"), F.min("printed_page").alias("pp"))
    body = F.array_join(F.transform("x", lambda r: F.concat(F.lit('<p>'), esc(r.text), F.lit('<a class="btn_tag">x</a></p>'))), "")
    head = F.concat(F.lit("<title>"), F.concat_ws(" - ", F.concat(F.lit("ج"), F.col("juz").cast("string")), F.concat(F.lit("ص"), F.col("pp").cast("string"))), F.lit('</title><p>menu</p><div class="nass" data-page-num="'), F.coalesce(F.col("pp"), F.lit(0)).cast("string"), F.lit('">'))
    return per.select("source", "book_id", "web_page", "url", F.concat(head, body, F.lit("</div><p>foot</p>")).alias("html"))


@query
def html_paragraphs(spark: SparkSession, d: str) -> DataFrame:
    """Paragraphs read back from HTML pages."""
    got = src.paragraphs(src.html_pages(_html(spark, d)))
    return got.select("source", "web_page", "para_idx", F.md5("text").alias("digest"))


ORACLE["html_paragraphs"] = rf"""
WITH a AS (SELECT DISTINCT para_id, source, web_page, para_idx, text FROM pages WHERE text IS NOT NULL),
b AS (SELECT *, trim(regexp_replace(text, '{N.SPACE}', ' ', 'g')) AS t FROM a)
SELECT source, web_page, CAST(row_number() OVER (PARTITION BY source, web_page ORDER BY para_idx, para_id) - 1 AS INTEGER) AS para_idx, md5(t) AS digest FROM b WHERE t <> ''
"""


@query
def toc_links(spark: SparkSession, d: str) -> DataFrame:
    """Links of generated tables of contents, by pattern and by nested lists."""
    p = table(spark, d, "segments").where("from_page is not null and label is not null").select("source", "from_page", "label").distinct()
    html = p.groupBy("source").agg(F.array_sort(F.collect_list(F.struct("from_page", "label"))).alias("x"))
    links = F.array_join(F.transform("x", lambda r: F.concat(F.lit('<li><a href="https://maktaba.example/book/7/'), r.from_page.cast("string"), F.lit('">'), r.label, F.lit("</a></li>"))), "")
    return html.select("source", F.explode(src.toc_links(F.concat(F.lit("<ul>"), links, F.lit("</ul>")), "7")).alias("l")).select("source", "l.page", "l.title")


ORACLE["toc_links"] = "SELECT DISTINCT source, from_page AS page, label AS title FROM segments WHERE from_page IS NOT NULL AND label IS NOT NULL"


@query
def incremental_ingest(spark: SparkSession, d: str) -> DataFrame:
    """Page records written as JSON Lines and taken in by the file stream."""
    import uuid

    from warraq.plans.materialize import shared_folder
    from warraq.streaming.ingest import ingest

    folder = f"{shared_folder(spark)}/warraq-{spark.sparkContext.applicationId}-{uuid.uuid4().hex[:12]}-ingest"
    p = _pages(spark, d).where("text is not null")
    sinks.write_json_lines(_records(p), f"{folder}/in")
    ingest(spark, f"{folder}/in", f"{folder}/out", f"{folder}/state")
    return spark.read.parquet(f"{folder}/out").select("source", "web_page", "para_idx", F.md5("text").alias("digest"))


ORACLE["incremental_ingest"] = ORACLE["page_round_trip"]


# ---- segmentation


def _heads(spark: SparkSession, d: str) -> DataFrame:
    s = slicing.latest_rows(table(spark, d, "event_segments"), "seg_id").where("from_page is not null")
    return s.select("source", F.col("seg_id").alias("hid"), F.when(F.col("basis") != "para", F.col("event_id")).alias("event_id"), F.col("from_page").alias("page"), F.col("from_para").alias("para_idx"), (F.col("to_page") + 1).alias("end_excl"))


@query
def heading_segments(spark: SparkSession, d: str) -> DataFrame:
    """Event segments from headings: runs page by page, with their tails."""
    return segmentation.heading_segments(_heads(spark, d), ["source"], "event_id")


ORACLE["heading_segments"] = """
WITH h AS (SELECT source, seg_id AS hid, CASE WHEN basis <> 'para' THEN event_id END AS event_id, from_page AS page, from_para AS para_idx, to_page + 1 AS end_excl
  FROM (SELECT * FROM event_segments QUALIFY row_number() OVER (PARTITION BY seg_id ORDER BY loaded_at DESC) = 1) WHERE from_page IS NOT NULL),
mx AS (SELECT source, max(page) AS mx FROM h GROUP BY source),
a AS (SELECT *, row_number() OVER w AS k, CASE WHEN page <= coalesce(lag(end_excl) OVER w, CASE WHEN lag(page) OVER w IS NOT NULL THEN 2147483647 END) THEN 0 ELSE 1 END AS nw FROM h WHERE event_id IS NOT NULL
  WINDOW w AS (PARTITION BY source, event_id ORDER BY page, para_idx NULLS LAST, hid)),
b AS (SELECT *, sum(nw) OVER (PARTITION BY source, event_id ORDER BY k) AS run FROM a),
p AS (SELECT source, event_id, run, arg_min(page, k) AS start_page, min(k) AS k0, max(k) AS k1, count(*) AS n_heads FROM b GROUP BY source, event_id, run),
q AS (SELECT p.*, f.para_idx AS para_start, l.end_excl FROM p JOIN b f ON f.source = p.source AND f.event_id = p.event_id AND f.k = p.k0 JOIN b l ON l.source = p.source AND l.event_id = p.event_id AND l.k = p.k1),
t AS (SELECT q.source, q.event_id, q.run, min(h.para_idx) AS cut FROM q JOIN h ON h.source = q.source AND h.page = q.end_excl AND h.para_idx IS NOT NULL
  LEFT JOIN b ON b.source = h.source AND b.hid = h.hid WHERE NOT coalesce(b.event_id = q.event_id AND b.run = q.run, false) GROUP BY ALL)
SELECT q.source, q.event_id, start_page, para_start, CASE WHEN end_excl IS NULL THEN mx WHEN cut > 0 THEN end_excl ELSE end_excl - 1 END AS last_page, CASE WHEN cut > 0 THEN cut END AS para_end, n_heads
FROM q LEFT JOIN t USING (source, event_id, run) JOIN mx USING (source)
"""


def _dictionary(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    e = table(spark, d, "persons").where("from_page is not null").select(F.lit("kamus_asl").alias("source"), F.col("ishabah_id").alias("i"), F.col("ishabah_id").cast("bigint").alias("num"), F.col("from_page").alias("page"), (F.col("to_page") + 1).alias("end_excl"), N.numbered_name(F.col("name_ar")).alias("name_key"))
    l = _slim(spark, d, "source", "web_page", "para_idx", "text").where("source = 'kamus_asl' and text is not null")
    return e, l.select("source", F.col("web_page").alias("page"), "para_idx", P.entry_number(F.col("text")).alias("number"), N.numbered_name(F.col("text")).alias("name_key"))


@query
def dictionary_segments(spark: SparkSession, d: str) -> DataFrame:
    """Articles of the canonical dictionary from their headings: start, end and how they were found."""
    e, l = _dictionary(spark, d)
    l = cut(l, "lines")
    return segmentation.entry_starts(e, l, ["source"]).join(segmentation.entry_ends(e, l, ["source"]), ["source", "i"]).select("source", "i", "start_page", "para_start", "step", "last_page", "para_end", "how")


_N7 = lambda c: _sql("N7", c)
ORACLE["dictionary_segments"] = rf"""
WITH l AS (SELECT DISTINCT web_page AS page, para_idx, TRY_CAST(nullif(regexp_extract(translate(regexp_replace(text, '{N.MARKS_ALL}', '', 'g'), '{N.DIGITS}', '{N.ASCII_DIGITS}'), '^\[?\s*\(?\s*(\d+)\s*[-)\]]\s*(.+)$', 1), '') AS BIGINT) AS number, {_N7('text')} AS key FROM pages WHERE source = 'kamus_asl' AND text IS NOT NULL),
e AS (SELECT ishabah_id AS i, ishabah_id AS num, from_page AS page, to_page + 1 AS end_excl, {_N7('name_ar')} AS name_key FROM persons WHERE from_page IS NOT NULL),
o AS (SELECT num AS number, min(page) AS owner FROM e GROUP BY num),
h AS (SELECT i, CASE l.page - e.page WHEN 0 THEN 0 WHEN -1 THEN 1 ELSE 2 END AS rk, l.page, para_idx,
  CASE WHEN l.number = num THEN 1 WHEN abs(l.number - num) <= 3 AND (owner IS NULL OR l.number = num OR abs(owner - e.page) > 1) THEN 2 WHEN substr(name_key, 1, 12) <> '' AND contains(key, substr(name_key, 1, 12)) THEN 3 END AS step
  FROM e JOIN l ON l.page BETWEEN e.page - 1 AND e.page + 1 LEFT JOIN o ON o.number = l.number),
s AS (SELECT * FROM h WHERE step IS NOT NULL QUALIFY row_number() OVER (PARTITION BY i ORDER BY rk, step, para_idx, page) = 1),
n AS (SELECT i, coalesce(end_excl, page + 1) AS ee, lead(num) OVER (ORDER BY i) AS num, substr(lead(name_key) OVER (ORDER BY i), 1, 12) AS st, lead(i) OVER (ORDER BY i) AS nx FROM e),
k AS (SELECT n.i, para_idx, CASE WHEN number = num THEN 1 WHEN abs(number - num) <= 3 THEN 2 WHEN st <> '' AND contains(key, st) THEN 3 WHEN number IS NOT NULL THEN 4 END AS step FROM n JOIN l ON l.page = ee WHERE nx IS NOT NULL),
z AS (SELECT * FROM k WHERE step IS NOT NULL QUALIFY row_number() OVER (PARTITION BY i ORDER BY step, para_idx) = 1)
SELECT 'kamus_asl' AS source, e.i, coalesce(s.page, e.page) AS start_page, s.para_idx AS para_start, s.step AS step, CASE WHEN z.para_idx > 0 THEN ee ELSE ee - 1 END AS last_page, CASE WHEN z.para_idx > 0 THEN z.para_idx END AS para_end,
  CASE WHEN nx IS NULL THEN 'last entry' WHEN z.i IS NULL THEN 'not found' ELSE ['number', 'near number', 'name', 'first number'][z.step] END AS how
FROM e LEFT JOIN s USING (i) JOIN n USING (i) LEFT JOIN z USING (i)
"""


@query
def anchor_segments(spark: SparkSession, d: str) -> DataFrame:
    """Headings of each page as anchors of segments over its paragraphs."""
    p = _slim(spark, d, "source", "web_page", "para_idx", "text").where("text is not null")
    bounds = p.groupBy("source", "web_page").agg(F.min("para_idx").alias("first"), F.max("para_idx").alias("last"))
    anchors = cut(p.where(P.is_heading(F.col("text"))).select("source", "web_page", F.col("para_idx").alias("pos"), F.md5("text").alias("label")), "anchors")
    return segmentation.anchors_to_segments(anchors, bounds, ["source", "web_page"])


ORACLE["anchor_segments"] = f"""
WITH a AS (SELECT DISTINCT source, web_page, para_idx, text FROM pages WHERE text IS NOT NULL),
b AS (SELECT *, {_T_SQL} AS t FROM a), h AS (SELECT source, web_page, para_idx AS pos, min(md5(text)) AS label FROM b WHERE {_HEADING_SQL} GROUP BY ALL),
o AS (SELECT source, web_page, min(para_idx) AS f, max(para_idx) AS l FROM a GROUP BY ALL),
s AS (SELECT h.*, f, l, lead(pos) OVER (PARTITION BY source, web_page ORDER BY pos) AS nx FROM h JOIN o USING (source, web_page))
SELECT source, web_page, label, pos AS from_pos, coalesce(nx - 1, l) AS to_pos FROM s
UNION ALL SELECT source, web_page, 'intro', f, min(pos) - 1 FROM s GROUP BY source, web_page, f HAVING min(pos) > f
"""


@query
def phrase_verse_tiers(spark: SparkSession, d: str) -> DataFrame:
    """The first three words of every paragraph looked for in the other paragraphs of its page, by tiers."""
    p = _slim(spark, d, "para_id", "source", "web_page", "para_idx", "text").where("text is not null").withColumn("key", N.verse_key(F.col("text")))
    phrases = p.select("source", "web_page", F.col("para_id").alias("pid"), F.array_join(F.slice(F.split("key", " "), 1, 3), " ").alias("phrase"))
    verses = p.select("source", "web_page", F.col("para_idx").alias("ayah"), F.col("key").alias("verse"))
    return segmentation.phrase_verse(phrases, verses, ["source", "web_page"])


ORACLE["phrase_verse_tiers"] = f"""
WITH p AS (SELECT para_id, source, web_page, para_idx, {_sql('N4', 'text')} AS v FROM (SELECT DISTINCT para_id, source, web_page, para_idx, text FROM pages WHERE text IS NOT NULL)),
q AS (SELECT source, web_page, para_id AS pid, array_to_string(string_split(v, ' ')[1:3], ' ') AS ph FROM p),
x AS (SELECT q.*, p.para_idx AS ayah, v, replace(v, ' ', '') AS bv, replace(ph, ' ', '') AS bp FROM q JOIN p USING (source, web_page) WHERE ph <> '' AND v <> ''),
t AS (SELECT source, web_page, pid, ayah, CASE WHEN starts_with(v, ph) OR (length(v) >= 8 AND starts_with(ph, v)) THEN 1 WHEN starts_with(bv, bp) OR (length(bv) >= 8 AND starts_with(bp, bv)) THEN 2
  WHEN len(string_split(ph, ' ')) >= 2 AND starts_with(v, array_to_string(string_split(ph, ' ')[1:2], ' ')) THEN 3 WHEN contains(v, ph) OR (length(v) >= 12 AND contains(ph, v)) THEN 4 END AS tier FROM x),
b AS (SELECT * FROM t WHERE tier IS NOT NULL QUALIFY row_number() OVER (PARTITION BY source, web_page, pid ORDER BY tier, ayah) = 1)
SELECT q.source, q.web_page, q.pid, b.ayah, b.tier FROM q LEFT JOIN b USING (source, web_page, pid)
"""


@query
def title_labels(spark: SparkSession, d: str) -> DataFrame:
    """Page titles of a digital commentary to chapter and verse label."""
    s = _segments(spark, d).where("label is not null and surah is not null")
    titles = s.select(F.col("seg_id").alias("tid"), F.concat(F.lit("Commentary - Chapter"), F.col("surah").cast("string"), F.lit(" "), F.when(F.col("label").rlike("^\\d"), F.col("label")).otherwise("Introduction of chapter")).alias("title"))
    names = s.select("surah").distinct().select("surah", F.concat(F.lit("CHAPTER"), F.col("surah").cast("string")).alias("name"))
    return segmentation.title_labels(titles, names, "Commentary - ")


ORACLE["title_labels"] = rf"""
WITH s AS (SELECT seg_id AS tid, surah, CASE WHEN regexp_matches(label, '^\d') THEN label END AS l FROM {_SEG} WHERE label IS NOT NULL AND surah IS NOT NULL),
b AS (SELECT *, l IS NULL OR regexp_matches(l, '^\d+(-\d+)?$') AS fits FROM s)
SELECT tid, CASE WHEN fits THEN surah END AS surah, CASE WHEN NOT fits THEN NULL WHEN l IS NULL THEN 'intro' WHEN contains(l, '-') AND split_part(l, '-', 1) = split_part(l, '-', 2) THEN split_part(l, '-', 1) ELSE l END AS label,
  CASE WHEN fits THEN 'ok' ELSE 'unknown pattern' END AS status FROM b
"""


@query
def segment_checks(spark: SparkSession, d: str) -> DataFrame:
    """Order, numbering and density of every book's segments per surah."""
    lo, hi = labels.bounds(F.col("label"))
    s = _segments(spark, d).withColumn("lo", lo).withColumn("hi", hi)
    return segmentation.segment_checks(s, ["source", "surah"], ["from_page", "from_para", "seg_id"], "lo", "hi")


ORACLE["segment_checks"] = rf"""
WITH a AS (SELECT *, CASE WHEN regexp_matches(label, '^~?\d+(-\d+)?$') THEN CAST(regexp_extract(label, '^~?(\d+)', 1) AS INTEGER) END AS lo, CASE WHEN regexp_matches(label, '^~?\d+(-\d+)?$') THEN CAST(coalesce(nullif(regexp_extract(label, '-(\d+)$', 1), ''), regexp_extract(label, '^~?(\d+)', 1)) AS INTEGER) END AS hi FROM {_SEG}),
b AS (SELECT *, max(hi) OVER (PARTITION BY source, surah ORDER BY from_page NULLS FIRST, from_para NULLS FIRST, seg_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m FROM a)
SELECT source, surah, count(*) AS n, count(*) FILTER (WHERE lo < m) AS n_back, count(*) FILTER (WHERE lo IS NULL) AS n_unnumbered, max(hi - lo + 1) AS widest, round(avg(CASE WHEN lo IS NOT NULL THEN CAST(lo = hi AS INTEGER) END), 4) AS single_share FROM b GROUP BY source, surah
"""


@query
def reviewed_links(spark: SparkSession, d: str) -> DataFrame:
    """Reviewed links checked against questions with a town and candidates with a kunya."""
    e = table(spark, d, "person_entries").where("entry_num is not null")
    reviewed = e.where("link_method = 'review'").select("source", F.col("entry_num").alias("number"), F.col("ishabah_id").alias("cid"), F.col("link_confidence").alias("confidence"))
    asked = e.where("town is not null").groupBy("source", F.col("entry_num").alias("number")).agg(F.array_sort(F.collect_set(F.when(F.col("kunya").isNotNull(), F.col("ishabah_id")))).alias("candidates"))
    return segmentation.merge_reviewed(reviewed, asked)


ORACLE["reviewed_links"] = """
WITH e AS (SELECT * FROM person_entries WHERE entry_num IS NOT NULL),
r AS (SELECT source, entry_num AS number, ishabah_id AS cid, link_confidence AS confidence FROM e WHERE link_method = 'review' QUALIFY row_number() OVER (PARTITION BY source, entry_num ORDER BY link_confidence DESC NULLS LAST, ishabah_id DESC NULLS LAST) = 1),
k AS (SELECT source, entry_num AS number, list(DISTINCT ishabah_id) FILTER (WHERE kunya IS NOT NULL) AS c FROM e WHERE town IS NOT NULL GROUP BY ALL),
x AS (SELECT r.*, CASE WHEN k.number IS NULL THEN 'unknown question' WHEN cid IS NULL THEN 'null' WHEN NOT coalesce(list_contains(c, cid), false) THEN 'rejected' ELSE 'ok' END AS outcome FROM r LEFT JOIN k ON k.source = r.source AND k.number = r.number)
SELECT source, number, CASE WHEN outcome = 'ok' THEN cid END AS cid, coalesce(confidence, 'low') AS confidence, CASE WHEN outcome = 'ok' THEN 'resolved' ELSE 'unresolved' END AS status, outcome FROM x
"""
