"""Registered queries of the readers' questions and of the operators around them, over the whole tables; each with its equivalent in SQL.

The twins spell patterns and constants for themselves; they share only the SQL of normalisation and slices with corpus_queries.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from warraq.functions import normalise as N
from warraq.functions import paragraphs as P
from warraq.operators import alignment, entities, labels, quotations, resolution, segmentation, slicing
from warraq.plans.api import Corpus
from warraq.plans.core_queries import ORACLE, query
from warraq.plans.corpus_queries import _CHAPTERS, _HEADING_SQL, _QUERY, _REG, _SEG, _SLICE_SQL, _SPANS, _STRIP, _T_SQL, EVENT_QUERIES, _registry, _segments, _slices, _slim, _sql, _values
from warraq.plans.materialize import cut, shared_folder, table
from warraq.sources import pages as src
from warraq.sources import sinks

VERSES = ("2:3", "16", "78:1")
_EVENTS = "(SELECT * FROM event_segments QUALIFY row_number() OVER (PARTITION BY seg_id ORDER BY loaded_at DESC) = 1)"
_ENTRIES = "(SELECT * FROM person_entries QUALIFY row_number() OVER (PARTITION BY entry_id ORDER BY loaded_at DESC) = 1)"
#: Slices of the verse segments, as _SLICE_SQL has them of the event segments.
_VERSE_SLICE = _SLICE_SQL.replace("SELECT DISTINCT seg_id, source, from_page", "SELECT seg_id, source, from_page").replace("FROM event_segments WHERE", f"FROM {_SEG} WHERE")


# ---- questions


def _asked(spark: SparkSession, d: str, f) -> DataFrame:
    c = Corpus(spark, d)
    out = None
    for ref in VERSES:
        one = f(c, ref).withColumn("ref", F.lit(ref))
        out = one if out is None else out.unionByName(one)
    return out


@query
def read_verses(spark: SparkSession, d: str) -> DataFrame:
    """Q1: paragraphs on a verse or a chapter, segment by segment within a budget, with a reason for every source that has none."""
    got = _asked(spark, d, lambda c, ref: c.verse(ref, budget=4000))
    return got.select("ref", "source", "ord", "seg_id", "label", "label_note", F.col("rel_idx").cast("bigint").alias("rel_idx"), "is_page_break", F.md5("text").alias("digest"), "reason", "status")


_ASKED = "q AS (SELECT * FROM (VALUES ('2:3', 2, 3), ('16', 16, NULL), ('78:1', 78, 1)) AS v(ref, surah, ayah))"
_ORD = "o AS (SELECT source, CAST(row_number() OVER (ORDER BY book_id, source) AS INTEGER) AS ord FROM sources)"
ORACLE["read_verses"] = f"""WITH {_VERSE_SLICE}, {_SPANS}, {_ASKED}, {_ORD},
g AS (SELECT DISTINCT q.ref, sg.seg_id, sg.source, sg.label FROM q JOIN {_SEG} sg ON sg.surah = q.surah LEFT JOIN v ON v.seg_id = sg.seg_id AND v.ayah = q.ayah WHERE q.ayah IS NULL OR v.seg_id IS NOT NULL),
f AS (SELECT g.ref, g.source, o.ord, g.seg_id, g.label, r.rel_idx, r.is_page_break, r.text FROM g JOIN r ON r.seg_id = g.seg_id JOIN o ON o.source = g.source WHERE cum_chars <= 4000 OR rel_idx = 0),
n AS (SELECT q.ref, sg.source, count(*) AS n FROM q JOIN {_SEG} sg ON sg.surah = q.surah GROUP BY ALL),
w AS (SELECT q.ref, o.source, o.ord, n.n, o.source IN (SELECT source FROM pages) AS paged FROM q CROSS JOIN o LEFT JOIN n ON n.ref = q.ref AND n.source = o.source WHERE NOT EXISTS (SELECT 1 FROM f WHERE f.ref = q.ref AND f.source = o.source))
SELECT ref, source, ord, seg_id, label, CASE WHEN contains(label, ',') THEN 'one of these verses' WHEN starts_with(label, '~') THEN 'verses inferred from the neighbours' END AS label_note, CAST(rel_idx AS BIGINT) AS rel_idx, is_page_break, md5(text) AS digest, NULL AS reason, 'found' AS status FROM f
UNION ALL SELECT ref, source, ord, NULL, NULL, NULL, NULL, NULL, NULL, CASE WHEN NOT paged THEN 'no pages of this source' WHEN n IS NULL THEN 'nothing on this here' ELSE n || ' segments near it, none with text on this' END, 'absent' FROM w
"""


@query
def read_intro(spark: SparkSession, d: str) -> DataFrame:
    """Q2: what books say on a chapter before its first verse."""
    c = Corpus(spark, d)
    got = c.intro(78).withColumn("surah", F.lit(78)).unionByName(c.intro(16).withColumn("surah", F.lit(16)))
    return got.where("status = 'found'").select("surah", "source", "seg_id", "label", "seg_section", F.col("rel_idx").cast("bigint").alias("rel_idx"), F.md5("text").alias("digest"))


ORACLE["read_intro"] = f"""WITH {_VERSE_SLICE}
SELECT sg.surah, sg.source, sg.seg_id, sg.label, sg.seg_section, CAST(rel_idx AS BIGINT) AS rel_idx, md5(text) AS digest FROM {_SEG} sg JOIN r USING (seg_id) JOIN sources o ON o.source = sg.source
WHERE sg.surah IN (16, 78) AND (sg.label IN ('intro', 'istiadhah') OR sg.seg_section = 'intro')
"""


@query
def read_verse_coverage(spark: SparkSession, d: str) -> DataFrame:
    """Q3: of every book and chapter, how many verses it covers and which it leaves out."""
    return Corpus(spark, d).verse_coverage().select("source", "surah", "n_ayat", "covered", "percent", "missing")


ORACLE["read_verse_coverage"] = f"""WITH {_SPANS}, {_CHAPTERS}, k AS (SELECT DISTINCT source, surah FROM v WHERE surah IS NOT NULL),
h AS (SELECT source, surah, count(DISTINCT ayah) AS covered FROM v JOIN c USING (surah) WHERE ayah BETWEEN 1 AND n_ayat GROUP BY source, surah),
a AS (SELECT source, surah, unnest(range(1, n_ayat + 1)) AS ayah FROM k JOIN c USING (surah)),
m AS (SELECT a.* FROM a ANTI JOIN v USING (source, surah, ayah)),
g AS (SELECT *, ayah - row_number() OVER (PARTITION BY source, surah ORDER BY ayah) AS x FROM m),
z AS (SELECT source, surah, min(ayah) AS lo, max(ayah) AS hi FROM g GROUP BY source, surah, x),
t AS (SELECT source, surah, string_agg(CASE WHEN lo = hi THEN CAST(lo AS VARCHAR) ELSE lo || '-' || hi END, ',' ORDER BY lo) AS missing FROM z GROUP BY source, surah)
SELECT source, surah, n_ayat, coalesce(covered, 0) AS covered, round(100.0 * coalesce(covered, 0) / n_ayat, 2) AS percent, missing FROM k JOIN c USING (surah) LEFT JOIN h USING (source, surah) LEFT JOIN t USING (source, surah)
"""


@query
def read_toc(spark: SparkSession, d: str) -> DataFrame:
    """Q4, Q12: the sections of every event segment, by its headings."""
    return Corpus(spark, d).toc(None, events=True).select("seg_id", "section", F.col("from_idx").cast("bigint").alias("from_idx"), F.col("to_idx").cast("bigint").alias("to_idx"), "n_chars", "kind")


_LATEST_SLICE = _SLICE_SQL.replace("SELECT DISTINCT seg_id, source, from_page", "SELECT seg_id, source, from_page").replace("FROM event_segments WHERE", f"FROM {_EVENTS} WHERE")
ORACLE["read_toc"] = f"""WITH {_LATEST_SLICE},
b AS (SELECT *, {_T_SQL} AS t, string_split({_sql('N2', 'text')}, ' ') AS w FROM r), c AS (SELECT *, {_HEADING_SQL} AS head FROM b),
e AS (SELECT *, sum(CASE WHEN head THEN 1 ELSE 0 END) OVER (PARTITION BY seg_id ORDER BY rel_idx) AS section FROM c)
SELECT seg_id, CAST(section AS BIGINT) AS section, CAST(min(rel_idx) AS BIGINT) AS from_idx, CAST(max(rel_idx) AS BIGINT) AS to_idx, CAST(sum(length(text)) AS BIGINT) AS n_chars,
  CASE WHEN avg(CASE WHEN NOT head THEN CAST(regexp_matches(text, '^[\\s\\x{{A0}}]*(\\(\\d+\\)|\\[\\d+\\])') AS INTEGER) END) >= 0.6 THEN 'note'
       WHEN avg(CASE WHEN NOT head THEN CAST(contains(text, ' ... ') OR contains(text, ' … ') AS INTEGER) END) >= 0.6 THEN 'poem'
       WHEN avg(CASE WHEN NOT head THEN CAST(len(w) >= 5 AND len(list_filter(w[1:4], lambda x: x = 'بن')) >= 1 AND len(list_filter(w[1:8], lambda x: x = 'بن')) >= 2 AS INTEGER) END) >= 0.6 THEN 'genealogy' ELSE 'text' END AS kind
FROM e GROUP BY seg_id, section
"""


@query
def paragraph_ranges(spark: SparkSession, d: str) -> DataFrame:
    """Paragraphs 3 to 6 of every event segment; segments that end before say so."""
    got = slicing.paragraph_range(_slices(spark, d), ["seg_id"], 3, 6)
    return got.select("seg_id", F.col("rel_idx").cast("bigint").alias("rel_idx"), "para_id", "is_page_break", "status")


ORACLE["paragraph_ranges"] = f"""WITH {_SLICE_SQL}
SELECT seg_id, rel_idx, para_id, is_page_break, 'found' AS status FROM r WHERE rel_idx BETWEEN 3 AND 6
UNION ALL SELECT seg_id, NULL, NULL, NULL, 'out of range' FROM r GROUP BY seg_id HAVING max(rel_idx) < 3
"""


@query
def read_events(spark: SparkSession, d: str) -> DataFrame:
    """Q6: what each source has on the events that queries resolve to: segments and paragraphs, or an explicit absence."""
    got = resolution.resolve_events(_values(spark, EVENT_QUERIES + [(9, "perdamaian_00000002"), (10, "BAIAT MIZIḌUKH")], "qid int, query string"), _registry(spark, d)).where("status = 'resolved'")
    per = _slices(spark, d).groupBy("seg_id").agg(F.count("*").alias("n_paras"))
    s = table(spark, d, "event_segments").select("seg_id", "source", "event_id").distinct().join(per, "seg_id").groupBy("source", "event_id").agg(F.count("*").alias("n_segments"), F.sum("n_paras").alias("n_paras"))
    every = got.select("qid", "event_id").crossJoin(F.broadcast(table(spark, d, "sources").select("source")))
    found = F.col("n_segments").isNotNull()
    return every.join(s, ["source", "event_id"], "left").select("qid", "event_id", "source", "n_segments", "n_paras", F.when(found, "found").otherwise("absent").alias("status"))


ORACLE["read_events"] = f"""WITH {_REG.replace('AS v(qid, query))', "AS v(qid, query) UNION ALL SELECT qid, query, " + _sql('N2', 'query') + ", lower(query) FROM (VALUES (9, 'perdamaian_00000002'), (10, 'BAIAT MIZIḌUKH')) AS v(qid, query))")},
x AS (SELECT qid, event_id, CASE WHEN event_id = query THEN 0 WHEN name_norm = key OR len(list_filter(aliases, lambda a: contains(' ' || a || ' ', ' ' || key || ' '))) > 0 OR lower(name_id) = low THEN 1
   WHEN contains(name_norm, key) OR len(list_filter(aliases, lambda a: contains(a, key))) > 0 OR contains(lower(name_id), low) THEN 2 END AS tier FROM r CROSS JOIN q WHERE key <> ''),
b AS (SELECT * FROM x WHERE tier IS NOT NULL QUALIFY tier = min(tier) OVER (PARTITION BY qid)), c AS (SELECT *, count(*) OVER (PARTITION BY qid) AS n FROM b),
y AS (SELECT qid, event_id FROM c WHERE tier < 2 AND n = 1),
sl AS (WITH {_SLICE_SQL} SELECT seg_id, count(*) AS n_paras FROM r GROUP BY seg_id),
z AS (SELECT source, event_id, count(*) AS n_segments, CAST(sum(n_paras) AS BIGINT) AS n_paras FROM (SELECT DISTINCT seg_id, source, event_id FROM event_segments) JOIN sl USING (seg_id) GROUP BY ALL)
SELECT y.qid, y.event_id, s.source, n_segments, n_paras, CASE WHEN n_segments IS NULL THEN 'absent' ELSE 'found' END AS status FROM y CROSS JOIN sources s LEFT JOIN z ON z.source = s.source AND z.event_id = y.event_id
"""


@query
def read_persons(spark: SparkSession, d: str) -> DataFrame:
    """Every fiftieth entry's name, and its number, as questions after a person."""
    e = table(spark, d, "person_entries").select("entry_id", F.col("ishabah_id").alias("person"), "source", F.col("name_ar").alias("name")).distinct()
    asked = e.where("entry_id % 50 = 0 and name is not null")
    q = asked.select(F.concat(F.lit("name "), "entry_id").alias("qid"), F.col("name").alias("query")).unionByName(asked.select(F.concat(F.lit("number "), "entry_id").alias("qid"), F.col("entry_id").cast("string").alias("query")))
    q = q.unionByName(_values(spark, [("two", "بن أبو"), ("none", "لا يوجد"), ("empty", "")], "qid string, query string"))
    p = table(spark, d, "persons").select(F.col("ishabah_id").alias("person"), F.col("name_ar").alias("name"))
    return resolution.resolve_persons(cut(q, "questions"), p, cut(e.drop("entry_id"), "entries"))


ORACLE["read_persons"] = rf"""
WITH e0 AS (SELECT DISTINCT entry_id, ishabah_id, source, name_ar FROM person_entries),
q0 AS (SELECT 'name ' || entry_id AS qid, name_ar AS query FROM e0 WHERE entry_id % 50 = 0 AND name_ar IS NOT NULL UNION ALL SELECT 'number ' || entry_id, CAST(entry_id AS VARCHAR) FROM e0 WHERE entry_id % 50 = 0 AND name_ar IS NOT NULL
  UNION ALL SELECT * FROM (VALUES ('two', 'بن أبو'), ('none', 'لا يوجد'), ('empty', ''))),
q AS (SELECT qid, regexp_matches(trim(query), '^\d+$') AS num, TRY_CAST(CASE WHEN regexp_matches(trim(query), '^\d+$') THEN trim(query) END AS BIGINT) AS id, {_sql('N2', 'query')} AS key, list_distinct(regexp_extract_all({_sql('N1', 'query')}, '[\p{{L}}\p{{N}}_]+')) AS words FROM q0),
p AS (SELECT ishabah_id AS person, {_sql('N2', 'name_ar')} AS name FROM persons),
e AS (SELECT ishabah_id AS person, source, {_sql('N2', 'name_ar')} AS name, coalesce(regexp_extract_all({_sql('N1', 'name_ar')}, '[\p{{L}}\p{{N}}_]+'), []) AS hay FROM (SELECT DISTINCT ishabah_id, source, name_ar, entry_id FROM e0) WHERE ishabah_id IS NOT NULL),
c AS (SELECT qid, person, name = key AS whole FROM p JOIN q ON NOT num AND key <> '' AND contains(name, key)
  UNION ALL SELECT qid, person, false FROM e JOIN q ON NOT num AND key <> '' AND (contains(name, key) OR (len(words) > 0 AND list_has_all(hay, words))) WHERE person IN (SELECT person FROM p)
  UNION ALL SELECT qid, id, true FROM q WHERE num AND id IN (SELECT person FROM p)),
a AS (SELECT qid, person, bool_or(whole) AS whole FROM c GROUP BY qid, person),
b AS (SELECT *, count(*) FILTER (WHERE whole) OVER (PARTITION BY qid) AS nw FROM a),
k AS (SELECT qid, person FROM b WHERE nw <> 1 OR whole),
ns AS (SELECT person, count(DISTINCT source) AS n FROM e GROUP BY person),
np AS (SELECT k.qid, k.person, count(*) AS n FROM k JOIN e USING (person) JOIN q USING (qid) WHERE key <> '' AND contains(e.name, key) GROUP BY ALL),
s AS (SELECT k.qid, k.person, coalesce(ns.n, 0) AS n_sources, coalesce(np.n, 0) AS n_phrase FROM k LEFT JOIN ns USING (person) LEFT JOIN np ON np.qid = k.qid AND np.person = k.person),
t AS (SELECT *, row_number() OVER w AS rank, count(*) OVER (PARTITION BY qid) AS n_candidates, coalesce(lead(n_sources) OVER w, 0) AS second FROM s WINDOW w AS (PARTITION BY qid ORDER BY n_sources DESC, n_phrase DESC, person))
SELECT qid, person, n_sources, n_phrase, CAST(rank AS INTEGER) AS rank, CASE WHEN n_candidates = 1 THEN 'resolved' WHEN rank = 1 AND n_sources >= 4 AND second <= 2 THEN 'suggested' ELSE 'ambiguous' END AS status, n_candidates FROM t WHERE rank <= 15
UNION ALL SELECT qid, NULL, NULL, NULL, NULL, 'absent', NULL FROM q0 WHERE qid NOT IN (SELECT qid FROM t)
"""


@query
def read_years(spark: SparkSession, d: str) -> DataFrame:
    """Of every year up to 500, the segments under a heading that names it and the registered events."""
    c = Corpus(spark, d)
    return resolution.answer_years(spark.range(1, 501).selectExpr("cast(id as int) as year"), c.registry, c.year_segments)


_YEARS = rf"""
yp AS (SELECT DISTINCT para_id, source, web_page, para_idx, text FROM pages WHERE text IS NOT NULL), yh AS (SELECT *, {_T_SQL} AS t FROM yp),
yy AS (SELECT para_id, source, web_page, para_idx, TRY_CAST(nullif(regexp_extract(translate({_sql('N2', 'text')}, '٠١٢٣٤٥٦٧٨٩۰۱۲۳۴۵۶۷۸۹', '01234567890123456789') || ' ', '(?:^|\s)سنه ([0-9]{{1,4}})(?:[^0-9])', 1), '') AS INTEGER) AS year_h FROM yh WHERE {_HEADING_SQL})
"""
ORACLE["read_years"] = f"""WITH {_YEARS}, s AS (SELECT * FROM yy WHERE year_h IS NOT NULL), n AS (SELECT unnest(range(1, 501)) AS year), b AS (SELECT min(year_h) AS f, max(year_h) AS l FROM s)
SELECT CAST(year AS INTEGER) AS year, kind, id, ord, f AS first_year, l AS last_year FROM (
  SELECT year, 'segment' AS kind, CAST(para_id AS VARCHAR) AS id, para_id AS ord FROM n JOIN s ON year_h = year
  UNION ALL SELECT year, 'event', event_id, seq FROM n JOIN event_registry ON year_h = year WHERE NOT regexp_matches(event_id, '^tahun_[0-9]+_h$')
  UNION ALL SELECT year, 'absent', NULL, NULL FROM n WHERE year NOT IN (SELECT year_h FROM s)) CROSS JOIN b
"""


@query
def year_segments(spark: SparkSession, d: str) -> DataFrame:
    """Segments from one heading that names a year to the next, per source."""
    return Corpus(spark, d).year_segments


ORACLE["year_segments"] = f"""WITH {_YEARS}, m AS (SELECT source, max((web_page, para_idx)) AS m FROM yp GROUP BY source),
x AS (SELECT yy.*, lead(web_page) OVER w AS np, lead(para_idx) OVER w AS nq FROM yy WHERE year_h IS NOT NULL WINDOW w AS (PARTITION BY source ORDER BY web_page, para_idx, para_id)),
l AS (SELECT source, web_page AS lp, para_idx AS lq FROM yp QUALIFY row_number() OVER (PARTITION BY source ORDER BY web_page DESC, para_idx DESC) = 1)
SELECT para_id AS seg_id, year_h, source, web_page AS from_page, para_idx AS from_para, CASE WHEN np IS NULL THEN lp WHEN nq > 0 THEN np ELSE np - 1 END AS to_page, CASE WHEN np IS NULL THEN lq WHEN nq > 0 THEN nq - 1 END AS to_para FROM x JOIN l USING (source)
"""


@query
def read_coverage(spark: SparkSession, d: str) -> DataFrame:
    """Q10: of every source, events treated and absent, entries and the linked share."""
    return Corpus(spark, d).coverage()


ORACLE["read_coverage"] = f"""
WITH t AS (SELECT count(*) AS n FROM event_registry WHERE NOT regexp_matches(event_id, '^tahun_.*_h$')),
ev AS (SELECT source, count(DISTINCT event_id) AS n_events FROM {_EVENTS} WHERE event_id IS NOT NULL GROUP BY source),
li AS (SELECT source, count(*) AS n_entries, count(*) FILTER (WHERE link_status IN ('resolved', 'canonical')) AS n_linked FROM {_ENTRIES} GROUP BY source)
SELECT s.source, s.book_role, coalesce(n_events, 0) AS n_events, coalesce(n_entries, 0) AS n_entries, coalesce(n_linked, 0) AS n_linked, t.n AS n_registered, t.n - coalesce(n_events, 0) AS n_absent, round(100.0 * n_linked / n_entries, 1) AS linked_percent
FROM sources s LEFT JOIN ev USING (source) LEFT JOIN li USING (source) CROSS JOIN t
"""


@query
def read_info(spark: SparkSession, d: str) -> DataFrame:
    """Q11, Q16: every source with its size and the numbers of its entries."""
    return Corpus(spark, d).info().select("source", "book_role", "n_paras", "n_pages", "n_chars", "n_entries", "first_number", "last_number", "status")


ORACLE["read_info"] = f"""
WITH p AS (SELECT source, count(*) AS n_paras, count(DISTINCT web_page) AS n_pages, CAST(sum(length(text)) AS BIGINT) AS n_chars FROM (SELECT DISTINCT * EXCLUDE (loaded_at) FROM pages) GROUP BY source),
e AS (SELECT source, count(*) AS n_entries, min(entry_num) AS first_number, max(entry_num) AS last_number FROM {_ENTRIES} GROUP BY source)
SELECT source, book_role, n_paras, n_pages, n_chars, n_entries, first_number, last_number, CASE WHEN n_paras IS NULL THEN 'no pages' ELSE 'ok' END AS status FROM sources LEFT JOIN p USING (source) LEFT JOIN e USING (source)
"""


@query
def read_numbers(spark: SparkSession, d: str) -> DataFrame:
    """Q13: entries of a reference, with what is missing or ambiguous, notes and the offset of the next answer page."""
    return Corpus(spark, d).entries_by_number("kamus_asl:1-40,999990-999992", offset=2, budget=600).select("book", "num", "row_id", "status", "note", F.col("item").cast("bigint").alias("item"), F.col("next_offset").cast("bigint").alias("next_offset"))


ORACLE["read_numbers"] = f"""
WITH e AS (SELECT entry_id, source, entry_num, name_ar FROM {_ENTRIES}), n AS (SELECT unnest(range(1, 41)) AS num UNION ALL SELECT unnest(range(999990, 999993))),
b AS (SELECT min(entry_num) AS lo, max(entry_num) AS hi, count(*) AS n FROM e WHERE source = 'kamus_asl'),
x AS (SELECT 'kamus_asl' AS book, CAST(num AS BIGINT) AS num, entry_id AS row_id, name_ar, CASE WHEN entry_id IS NULL THEN 'missing' WHEN count(*) OVER (PARTITION BY num) > 1 THEN 'ambiguous' ELSE 'found' END AS status FROM n LEFT JOIN e ON source = 'kamus_asl' AND entry_num = num),
i AS (SELECT *, row_number() OVER (ORDER BY num, row_id NULLS FIRST) - 1 AS item, count(*) OVER () AS c FROM x),
s AS (SELECT *, sum(coalesce(length(name_ar), 0)) OVER (ORDER BY item) AS used FROM i WHERE item >= 2), k AS (SELECT * FROM s WHERE used <= 600 OR item = 2)
SELECT book, num, row_id, status, CASE WHEN status = 'missing' THEN 'numbers here: ' || lo || ' to ' || hi || ', in ' || b.n || ' entries' END AS note, item, CASE WHEN item = max(item) OVER () AND item + 1 < c THEN item + 1 END AS next_offset FROM k CROSS JOIN b
"""


@query
def numbers_in_parts(spark: SparkSession, d: str) -> DataFrame:
    """Every number of every dictionary, the generations taken for parts that number anew: found, or ambiguous with all parts that have it."""
    part = F.when(F.col("generation") == "sahabah", 1).when(F.col("generation") == "unknown", 2).when(F.col("generation").isNotNull(), 3)
    e = table(spark, d, "person_entries").where("entry_num is not null").select(F.col("entry_id").alias("row_id"), F.col("source").alias("book"), part.alias("sub"), F.col("entry_num").alias("num")).distinct()
    plain = e.select(F.col("book").alias("qid"), "book", F.col("num").cast("bigint").alias("lo")).distinct().withColumn("sub", F.lit(None).cast("int"))
    named = plain.withColumn("qid", F.concat(F.lit("2/"), "book")).withColumn("sub", F.lit(2))
    return resolution.look_up_in_parts(plain.unionByName(named).withColumn("hi", F.col("lo")), e)


ORACLE["numbers_in_parts"] = """
WITH e AS (SELECT DISTINCT entry_id, source, CASE WHEN generation = 'sahabah' THEN 1 WHEN generation = 'unknown' THEN 2 WHEN generation IS NOT NULL THEN 3 END AS sub, entry_num FROM person_entries WHERE entry_num IS NOT NULL),
g AS (SELECT source, sub, entry_num AS num, min(entry_id) AS row_id, count(*) AS n_rows FROM e GROUP BY ALL), n AS (SELECT DISTINCT source, num FROM g),
a AS (SELECT source AS qid, g.source AS book, g.num, g.sub, row_id, n_rows, CASE WHEN count(*) OVER (PARTITION BY source, num) = 1 THEN 'found' ELSE 'ambiguous' END AS status FROM g)
SELECT qid, book, CAST(num AS BIGINT) AS num, sub, row_id, n_rows, status FROM a
UNION ALL SELECT '2/' || n.source, n.source, n.num, 2, row_id, n_rows, CASE WHEN row_id IS NULL THEN 'missing' ELSE 'found' END FROM n LEFT JOIN g ON g.source = n.source AND g.num = n.num AND g.sub = 2
"""


@query
def numbers_in_labels(spark: SparkSession, d: str) -> DataFrame:
    """The numbers 1 to 400 of every source looked for in its headings, in whatever figures these are written."""
    p = _slim(spark, d, "para_id", "source", "text")
    rows = p.where(P.is_heading(F.col("text"))).select(F.col("para_id").alias("row_id"), F.col("source").alias("book"), F.lit(None).cast("bigint").alias("num"), F.lit(None).cast("bigint").alias("num_to"), F.col("text").alias("num_label"))
    spans = table(spark, d, "sources").select(F.col("source").alias("qid"), F.col("source").alias("book"), F.lit(1).cast("bigint").alias("lo"), F.lit(400).cast("bigint").alias("hi"))
    return resolution.look_up_numbers(spans, rows)


ORACLE["numbers_in_labels"] = rf"""
WITH p AS (SELECT DISTINCT para_id, source, text FROM pages), h AS (SELECT *, {_T_SQL} AS t FROM p), k AS (SELECT para_id, source, regexp_extract_all(translate(text, '٠١٢٣٤٥٦٧٨٩۰۱۲۳۴۵۶۷۸۹', '01234567890123456789'), '[0-9]+') AS a FROM h WHERE {_HEADING_SQL}),
x AS (SELECT DISTINCT para_id, source, TRY_CAST(u AS BIGINT) AS num FROM (SELECT para_id, source, unnest(a) AS u FROM k)), n AS (SELECT source, unnest(range(1, 401)) AS num FROM sources)
SELECT n.source AS qid, n.source AS book, CAST(n.num AS BIGINT) AS num, x.para_id AS row_id, CASE WHEN x.para_id IS NULL THEN 'missing' ELSE 'by label' END AS status FROM n LEFT JOIN x ON x.source = n.source AND x.num = n.num
"""


@query
def read_full_text(spark: SparkSession, d: str) -> DataFrame:
    """The fifty most relevant paragraphs of two sources for a phrase."""
    return Corpus(spark, d).full_text("أبو", sources="kamus_asl; tarikh_rawdah", limit=50).select("rank", "match_mode", "score", "source", "para_id", "citation")


ORACLE["read_full_text"] = rf"""
WITH d AS (SELECT DISTINCT para_id AS id, source, printed_juz, printed_page, url, {_sql('N1', 'text')} AS t FROM pages WHERE text IS NOT NULL AND source IN ('kamus_asl', 'tarikh_rawdah')),
w AS (SELECT id, regexp_extract_all(t, '[\p{{L}}\p{{N}}_]+') AS a FROM d), p AS (SELECT id, unnest(a) AS term FROM w), hit AS (SELECT id, count(*) AS tf FROM p WHERE term = 'ابو' GROUP BY id),
ln AS (SELECT id, count(*) AS len FROM p WHERE id IN (SELECT id FROM hit) GROUP BY id), st AS (SELECT count(*) AS docs, avg(len) AS al FROM ln),
sc AS (SELECT id, round(1e-6 * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len / al)), 6) AS score FROM hit JOIN ln USING (id) CROSS JOIN st)
SELECT CAST(row_number() OVER (ORDER BY score DESC, id) AS INTEGER) AS rank, 'phrase' AS match_mode, score, source, id AS para_id,
  CASE WHEN printed_page IS NULL THEN 'page not printed' ELSE concat_ws(', ', CASE WHEN printed_juz IS NOT NULL THEN 'vol. ' || printed_juz END, 'p. ' || printed_page) END || CASE WHEN url IS NULL THEN '' ELSE ' - ' || url END AS citation
FROM sc JOIN d USING (id) QUALIFY rank <= 50
"""


@query
def read_headings(spark: SparkSession, d: str) -> DataFrame:
    """Q15, F8: headings with every word of a question, first come first."""
    return Corpus(spark, d).headings("ذكر بن", limit=100).select("source", F.md5("text").alias("digest"), "first_ord", "n_rows", "rank")


ORACLE["read_headings"] = rf"""
WITH p AS (SELECT DISTINCT * EXCLUDE (loaded_at) FROM pages), h AS (SELECT *, {_T_SQL} AS t FROM p),
k AS (SELECT source, text, min(para_id) AS first_ord, count(*) AS n_rows FROM h WHERE {_HEADING_SQL} AND contains({_sql('N1', 'text')}, 'ذكر') AND contains({_sql('N1', 'text')}, 'بن') GROUP BY source, text)
SELECT source, md5(text) AS digest, first_ord, n_rows, CAST(row_number() OVER (ORDER BY first_ord, source, text) AS INTEGER) AS rank FROM k QUALIFY rank <= 100
"""


# ---- operators around them


@query
def tuple_counts(spark: SparkSession, d: str) -> DataFrame:
    """A3: distinct pages of all sources, as tuples; a row with a null part doesn't count."""
    p = table(spark, d, "pages")
    return p.groupBy("book_id").agg(F.count_distinct("source", "web_page").alias("n_pages"), F.count_distinct("printed_juz", "printed_page").alias("n_printed"))


ORACLE["tuple_counts"] = """SELECT book_id, count(DISTINCT (source, web_page)) FILTER (WHERE source IS NOT NULL AND web_page IS NOT NULL) AS n_pages,
  count(DISTINCT (printed_juz, printed_page)) FILTER (WHERE printed_juz IS NOT NULL AND printed_page IS NOT NULL) AS n_printed FROM pages GROUP BY book_id"""


@query
def observed_load(spark: SparkSession, d: str) -> DataFrame:
    """A18, SNK10: counters of a load, filled while the table is written, with pass flags."""
    p, seen = sinks.observed(table(spark, d, "pages"), n_rows=F.count("*"), n_blank=F.count_if(F.col("text").isNull() | P.is_blank(F.col("text"))), n_chars=F.sum(F.length("text")), last_page=F.max("web_page"))
    p.write.format("noop").mode("overwrite").save()
    got = seen.get
    rows = [(k, int(got[k]), got[k] > 0) for k in ("n_rows", "n_blank", "n_chars", "last_page")]
    return _values(spark, rows, "counter string, n bigint, passed boolean")


ORACLE["observed_load"] = f"""
WITH c AS (SELECT count(*) AS n_rows, count(*) FILTER (WHERE text IS NULL OR {_STRIP('text')} = '') AS n_blank, CAST(sum(length(text)) AS BIGINT) AS n_chars, CAST(max(web_page) AS BIGINT) AS last_page FROM pages)
SELECT counter, n, n > 0 AS passed FROM (UNPIVOT c ON n_rows, n_blank, n_chars, last_page INTO NAME counter VALUE n)
"""


@query
def duplicate_report(spark: SparkSession, d: str) -> DataFrame:
    """SNK3: dictionary numbers under which several entries came: the first, which is kept, and the others."""
    return sinks.duplicates(table(spark, d, "person_entries").where("entry_num is not null"), ["source", "entry_num"], "entry_id")


ORACLE["duplicate_report"] = """
WITH k AS (SELECT source, entry_num, list_sort(list(DISTINCT entry_id)) AS a FROM person_entries WHERE entry_num IS NOT NULL GROUP BY ALL)
SELECT source, entry_num, CAST(len(a) AS INTEGER) AS n, a[1] AS first, array_to_string(a[2:], ',') AS others FROM k WHERE len(a) > 1
"""


@query
def partitioned_scan(spark: SparkSession, d: str) -> DataFrame:
    """SRC2, SNK4, SNK5: the paragraphs as a table parted by source, of which a scan reads the dictionaries alone."""
    path = f"{shared_folder(spark)}/warraq-{spark.sparkContext.applicationId}-{uuid.uuid4().hex[:12]}-parted"
    sinks.rebuild(_slim(spark, d, "para_id", "source", "web_page", "para_idx", "text"), path, "source", ["web_page", "para_idx"])
    p = spark.read.parquet(path).where(F.col("source").startswith("kamus"))
    return p.groupBy("source").agg(F.count("*").alias("n"), F.count_distinct("web_page").alias("n_pages"), F.sum(F.length("text")).alias("n_chars"))


ORACLE["partitioned_scan"] = "SELECT source, count(*) AS n, count(DISTINCT web_page) AS n_pages, CAST(sum(length(text)) AS BIGINT) AS n_chars FROM (SELECT DISTINCT para_id, source, web_page, para_idx, text FROM pages) WHERE starts_with(source, 'kamus') GROUP BY source"


@query
def conformed_rows(spark: SparkSession, d: str) -> DataFrame:
    """Persons in the columns of dictionary entries; what they lack is null."""
    return src.conform(table(spark, d, "persons"), "ishabah_id bigint, name_ar string, generation string, death_h bigint, entry_num int")


ORACLE["conformed_rows"] = "SELECT CAST(ishabah_id AS BIGINT) AS ishabah_id, name_ar, CAST(NULL AS VARCHAR) AS generation, CAST(death_h AS BIGINT) AS death_h, CAST(NULL AS INTEGER) AS entry_num FROM persons"


@query
def json_rows(spark: SparkSession, d: str) -> DataFrame:
    """SNK9: persons as JSON texts, nulls included."""
    return sinks.as_json(table(spark, d, "persons").select("ishabah_id", "name_norm", "kunya", "death_h"))


ORACLE["json_rows"] = "SELECT CAST(to_json({'ishabah_id': ishabah_id, 'name_norm': name_norm, 'kunya': kunya, 'death_h': death_h}) AS VARCHAR) AS json FROM persons"


@query
def nested_toc(spark: SparkSession, d: str) -> DataFrame:
    """SRC5: nested tables of contents of every tafsir book (chapters over segments) as HTML, read in pre-order."""
    s = _segments(spark, d).where("surah is not null and from_page is not null and label is not null")
    link = lambda page, title: F.concat(F.lit('<a href="https://maktaba.example/book/'), F.col("source"), F.lit("/"), page.cast("string"), F.lit('">'), title, F.lit("</a>"))
    inner = s.groupBy("source", "surah").agg(F.min("from_page").alias("page"), F.array_sort(F.collect_list(F.struct("from_page", "seg_id", "label"))).alias("x"))
    leaf = F.array_join(F.transform("x", lambda r: F.concat(F.lit("<li>"), link(r.from_page, r.label), F.lit("</li>"))), "")
    chapter = inner.select("source", "surah", F.concat(F.lit("<li>"), link(F.col("page"), F.col("surah").cast("string")), F.lit("<ul>"), leaf, F.lit('</ul></li><li><a href="/book/elsewhere/1">x</a></li>')).alias("h"))
    html = chapter.groupBy(F.col("source").alias("book_id")).agg(F.concat(F.lit("<ul>"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("surah", "h"))), lambda r: r.h), ""), F.lit("</ul>")).alias("html"))
    return src.nested_toc(html)


ORACLE["nested_toc"] = f"""
WITH s AS (SELECT * FROM {_SEG} WHERE surah IS NOT NULL AND from_page IS NOT NULL AND label IS NOT NULL),
r AS (SELECT source, surah, 0 AS lv, CAST(NULL AS INTEGER) AS p, CAST(NULL AS BIGINT) AS sid, min(from_page) AS page, CAST(surah AS VARCHAR) AS title, 0 AS depth FROM s GROUP BY source, surah UNION ALL SELECT source, surah, 1, from_page, seg_id, from_page, label, 1 FROM s)
SELECT source AS book_id, CAST(row_number() OVER (PARTITION BY source ORDER BY surah, lv, p, sid) - 1 AS INTEGER) AS i, page, title, depth FROM r
"""


@query
def shared_budgets(spark: SparkSession, d: str) -> DataFrame:
    """One budget over all segments of an event, in the order of sources: what an earlier segment used is gone for a later one."""
    own = table(spark, d, "event_segments").select("seg_id", "event_id").where("event_id is not null").distinct()
    rows = _slices(spark, d).join(own, "seg_id")
    return slicing.shared_budget(rows, ["event_id"], ["source", "seg_id", "rel_idx"], F.length("text"), 20_000).select("event_id", "seg_id", F.col("rel_idx").cast("bigint").alias("rel_idx"), F.col("cum_size").alias("used"))


ORACLE["shared_budgets"] = f"""WITH {_SLICE_SQL}, e AS (SELECT DISTINCT seg_id, event_id FROM event_segments WHERE event_id IS NOT NULL),
y AS (SELECT event_id, seg_id, rel_idx, sum(length(text)) OVER w AS used, row_number() OVER w AS k FROM r JOIN e USING (seg_id) WINDOW w AS (PARTITION BY event_id ORDER BY source, seg_id, rel_idx ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT event_id, seg_id, rel_idx, CAST(used AS BIGINT) AS used FROM y WHERE used <= 20000 OR k = 1
"""


def _flat(spark: SparkSession, d: str) -> DataFrame:
    return segmentation.flattened(_segments(spark, d).where("surah is not null"), _slim(spark, d, "source", "web_page", "para_idx", "text"), ["source", "surah"])


_FLAT = f"""WITH {_VERSE_SLICE}, fl AS (SELECT DISTINCT r.source, surah, web_page, para_idx, text FROM r JOIN (SELECT seg_id, surah FROM {_SEG} WHERE surah IS NOT NULL) USING (seg_id)),
f AS (SELECT *, row_number() OVER (PARTITION BY source, surah ORDER BY web_page, para_idx) - 1 AS pos FROM fl)"""


@query
def flattened_chapters(spark: SparkSession, d: str) -> DataFrame:
    """The paragraphs of every book and chapter in one order."""
    return _flat(spark, d).select("source", "surah", F.col("pos").cast("bigint").alias("pos"), "web_page", "para_idx")


ORACLE["flattened_chapters"] = f"{_FLAT} SELECT source, surah, pos, web_page, para_idx FROM f"


@query
def single_page_chapters(spark: SparkSession, d: str) -> DataFrame:
    """Chapters that stand on one page alone, as one introduction, where a rule names the page: here the page on which the book first treats another chapter too."""
    s = _segments(spark, d).where("surah is not null and from_page is not null")
    rules = s.join(s.select("source", F.col("surah").alias("o"), "from_page").distinct(), ["source", "from_page"]).where("surah <> o").select("source", "surah", F.col("from_page").alias("page")).distinct()
    return segmentation.whole_as_intro(_flat(spark, d), rules, ["source", "surah"]).select("source", "surah", F.col("from_pos").cast("bigint").alias("from_pos"), F.col("to_pos").cast("bigint").alias("to_pos"), "label")


ORACLE["single_page_chapters"] = f"""{_FLAT}, sx AS (SELECT * FROM {_SEG} WHERE surah IS NOT NULL AND from_page IS NOT NULL),
u AS (SELECT DISTINCT a.source, a.surah, a.from_page AS page FROM sx a JOIN sx b ON a.source = b.source AND a.from_page = b.from_page AND a.surah <> b.surah)
SELECT source, surah, min(pos) AS from_pos, max(pos) AS to_pos, 'intro' AS label FROM f JOIN u USING (source, surah) GROUP BY source, surah, page HAVING min(web_page) = page AND max(web_page) = page
"""


@query
def loaded_segments(spark: SparkSession, d: str) -> DataFrame:
    """Segments as they are loaded: without what is out of scope (here: reversed bounds), with a section from label or kind."""
    s = _segments(spark, d).withColumn("label", F.when(F.col("from_page") > F.col("to_page"), "out_of_scope").otherwise(F.col("label")))
    return quotations.loadable(s.withColumn("kind", F.col("seg_section"))).select("seg_id", "label", "section")


ORACLE["loaded_segments"] = f"""
SELECT seg_id, label, CASE WHEN label IN ('intro', 'istiadhah', 'closing') THEN label ELSE coalesce(seg_section, 'tafsir') END AS section FROM {_SEG} WHERE NOT coalesce(from_page > to_page, false)
"""


@query
def page_range_axes(spark: SparkSession, d: str) -> DataFrame:
    """Half-open page ranges per axis (how a segment was found) and source to their pages' paragraphs, each once, and what has none."""
    r = table(spark, d, "event_segments").select(F.coalesce("basis", F.lit("none")).alias("axis"), "source", F.col("from_page").alias("start"), (F.col("to_page") + 1).alias("end"))
    hit, absent = quotations.page_range_segments(r, _slim(spark, d, "para_id", "source", "web_page"))
    per = hit.groupBy("axis", "source").agg(F.count("*").alias("n_paras"), F.count_distinct("web_page").alias("n_pages"))
    return per.unionByName(absent, allowMissingColumns=True)


ORACLE["page_range_axes"] = """
WITH r AS (SELECT coalesce(basis, 'none') AS axis, source, from_page, to_page FROM event_segments), k AS (SELECT DISTINCT axis, source FROM r),
p AS (SELECT DISTINCT para_id, source, web_page FROM pages), h AS (SELECT DISTINCT axis, p.* FROM r JOIN p ON p.source = r.source AND p.web_page BETWEEN from_page AND to_page)
SELECT k.axis, k.source, CASE WHEN count(h.para_id) > 0 THEN count(h.para_id) END AS n_paras, CASE WHEN count(h.para_id) > 0 THEN count(DISTINCT h.web_page) END AS n_pages FROM k LEFT JOIN h ON h.axis = k.axis AND h.source = k.source GROUP BY k.axis, k.source
"""


PROBES = [(78, 1, "قال"), (16, 3, "كان في"), (37, 2, "لا يوجد هذا"), (29, 69, "قال"), (51, 1, "سنة")]


@query
def segment_findings(spark: SparkSession, d: str) -> DataFrame:
    """X22, SNK10: segments too long for their verses, verses that labels leave out, and probes whose phrase isn't where it should be."""
    lo, hi = labels.bounds(F.col("label"))
    s = cut(_segments(spark, d).where("surah is not null").select("seg_id", "source", "surah", lo.alias("lo"), hi.alias("hi"), "from_page", "from_para", "to_page", "to_para", "label"), "segments")
    texts = slicing.slice_intervals(s, _slim(spark, d, "source", "web_page", "para_idx", "text")).select("seg_id", "text")
    return segmentation.findings(s, texts, labels.verse_map(s), labels.chapters(spark), _values(spark, PROBES, "surah int, ayah int, phrase string"))


ORACLE["segment_findings"] = rf"""
WITH {_CHAPTERS}, {_SPANS.replace('b AS (', 'bb AS (').replace('FROM b ', 'FROM bb ')}, sl AS (WITH {_VERSE_SLICE} SELECT seg_id, {_sql('N4', 'text')} AS t FROM r),
g AS (SELECT seg_id, source, surah, from_page, from_para, to_page, CAST(regexp_extract(label, '^~?(\d+)', 1) AS INTEGER) AS lo, CAST(coalesce(nullif(regexp_extract(label, '-(\d+)$', 1), ''), regexp_extract(label, '^~?(\d+)', 1)) AS INTEGER) AS hi FROM {_SEG} WHERE regexp_matches(label, '^~?\d+(-\d+)?$') AND surah IS NOT NULL),
x AS (SELECT g.*, n_ayat, max(to_page) OVER (PARTITION BY source, g.surah) - min(from_page) OVER (PARTITION BY source, g.surah) + 1 AS pages FROM g JOIN c ON c.surah = g.surah WHERE from_page <= to_page),
f AS (SELECT source, surah, lo AS first FROM g QUALIFY row_number() OVER (PARTITION BY source, surah ORDER BY from_page NULLS FIRST, from_para NULLS FIRST, seg_id) = 1),
e AS (SELECT source, f.surah, first, unnest(range(1, n_ayat + 1)) AS ayah FROM f JOIN c ON c.surah = f.surah),
a AS (SELECT source, f.surah, p.ayah, {_sql('N4', 'phrase')} AS phrase FROM f JOIN (VALUES {', '.join(f"({x}, {y}, '{z}')" for x, y, z in PROBES)}) AS p(surah, ayah, phrase) ON p.surah = f.surah),
h AS (SELECT a.*, bool_or(g.seg_id IS NOT NULL) AS labelled, bool_or(sl.seg_id IS NOT NULL) AS found FROM a LEFT JOIN g ON g.source = a.source AND g.surah = a.surah AND a.ayah BETWEEN lo AND hi LEFT JOIN sl ON sl.seg_id = g.seg_id AND contains(t, phrase) GROUP BY ALL)
SELECT source, surah, 'density' AS finding, CAST(seg_id AS VARCHAR) AS at, CASE WHEN to_page - from_page + 1 > 1.5 * 8 * pages / n_ayat * (hi - lo + 1) THEN 'error' ELSE 'warning' END AS level FROM x WHERE to_page - from_page + 1 > 8.0 * pages / n_ayat * (hi - lo + 1)
UNION ALL SELECT source, surah, 'uncovered', CAST(ayah AS VARCHAR), CASE WHEN ayah > first THEN 'error' ELSE 'warning' END FROM e WHERE ayah <> first AND NOT EXISTS (SELECT 1 FROM v WHERE v.source = e.source AND v.surah = e.surah AND v.ayah = e.ayah)
UNION ALL SELECT source, surah, CASE WHEN labelled THEN 'not found' ELSE 'unlabelled' END, CAST(ayah AS VARCHAR), 'error' FROM h WHERE NOT found
"""


@query
def article_pages(spark: SparkSession, d: str) -> DataFrame:
    """SRC4: pages of the second dialect, made of every page's paragraphs with marked ones between them, read back with their titles."""
    esc = lambda c: F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    p = _slim(spark, d, "para_id", "source", "book_id", "web_page", "para_idx", "text").where("text is not null")
    per = p.groupBy("source", "book_id", "web_page").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("para_idx", "para_id", esc(F.col("text")).alias("t")))), lambda r: F.concat(F.lit("<p>"), r.t, F.lit("</p><p>Copyright x</p>"))), "").alias("body"))
    # Every third page has no article element: the whole page is taken.
    whole = F.col("web_page") % 3 == 0
    html = F.concat(F.lit("<title> "), "source", F.lit("  p. "), F.col("web_page").cast("string"), F.lit("</title>"), F.when(whole, "").otherwise("<p>menu</p><article>"), "body", F.when(whole, "").otherwise("</article>"), F.lit("<p>ALDORAR</p>"))
    files = per.select("source", "book_id", "web_page", F.lit(None).cast("string").alias("url"), html.alias("html"))
    got = src.paragraphs(src.html_pages(files, "article")).select("source", "web_page", "para_idx", F.md5("text").alias("digest"))
    return got.join(src.page_titles(files), ["source", "web_page"])


ORACLE["article_pages"] = rf"""
WITH a AS (SELECT DISTINCT para_id, source, web_page, para_idx, text FROM pages WHERE text IS NOT NULL), b AS (SELECT *, trim(regexp_replace(text, '{N.SPACE}', ' ', 'g')) AS t FROM a)
SELECT source, web_page, CAST(row_number() OVER (PARTITION BY source, web_page ORDER BY para_idx, para_id) - 1 AS INTEGER) AS para_idx, md5(t) AS digest, source || ' p. ' || web_page AS title FROM b WHERE t <> '' AND NOT contains(t, 'ALDORAR') AND NOT contains(lower(t), 'copyright')
"""


@query
def record_json(spark: SparkSession, d: str) -> DataFrame:
    """P17, SNK9: every entry as one record, with its citation as a structure and the other entries of its person as a list."""
    e = table(spark, d, "person_entries").select("entry_id", "source", "from_page", "ishabah_id", "link_confidence").distinct()
    cite = slicing.page_meta(_slim(spark, d, "para_id", "source", "web_page", "para_idx", "printed_juz", "printed_page", "url"))
    others = e.where("ishabah_id is not null").select("ishabah_id", F.col("entry_id").alias("o"))
    near = e.join(others, "ishabah_id").where("entry_id <> o").groupBy("entry_id").agg(F.array_sort(F.collect_set("o")).alias("xref"))
    x = e.join(cite, (e["source"] == cite["source"]) & (e["from_page"] == cite["web_page"]), "left").drop(cite["source"]).join(near, "entry_id", "left")
    return sinks.as_json(x.select("entry_id", "source", F.col("link_confidence").alias("grade_stored"), F.struct("printed_juz", "printed_page", "url").alias("citation"), F.coalesce("xref", F.array().cast("array<bigint>")).alias("xref")))


ORACLE["record_json"] = """
WITH e AS (SELECT DISTINCT entry_id, source, from_page, ishabah_id, link_confidence FROM person_entries),
m AS (SELECT source, web_page, printed_juz, printed_page, url FROM (SELECT DISTINCT para_id, source, web_page, para_idx, printed_juz, printed_page, url FROM pages) QUALIFY row_number() OVER (PARTITION BY source, web_page ORDER BY para_idx, para_id) = 1),
n AS (SELECT e.entry_id, list_sort(list(DISTINCT o.entry_id)) AS xref FROM e JOIN e o ON o.ishabah_id = e.ishabah_id AND o.entry_id <> e.entry_id GROUP BY e.entry_id)
SELECT CAST(to_json({'entry_id': e.entry_id, 'source': e.source, 'grade_stored': link_confidence, 'citation': {'printed_juz': printed_juz, 'printed_page': printed_page, 'url': url}, 'xref': coalesce(xref, [])}) AS VARCHAR) AS json FROM e LEFT JOIN m ON m.source = e.source AND m.web_page = e.from_page LEFT JOIN n ON n.entry_id = e.entry_id
"""


@query
def alignment_checks(spark: SparkSession, d: str) -> DataFrame:
    """Whether each book's labels on a chapter begin and end where its verses do."""
    lo, _ = labels.bounds(F.col("label"))
    a = _segments(spark, d).select("source", "surah", lo.alias("ayah")).where("ayah is not null").join(labels.chapters(spark), "surah")
    return alignment.alignment_ok(a, ["source", "surah"], F.col("n_ayat"))


ORACLE["alignment_checks"] = rf"""WITH {_CHAPTERS}, a AS (SELECT source, surah, CAST(regexp_extract(label, '^~?(\d+)', 1) AS INTEGER) AS ayah FROM {_SEG} WHERE regexp_matches(label, '^~?\d+(-\d+)?$'))
SELECT source, surah, min(ayah) AS first, max(ayah) AS last, n_ayat AS n, min(ayah) <= 3 AND n_ayat - max(ayah) <= greatest(12, n_ayat // 2) AS ok FROM a JOIN c USING (surah) GROUP BY source, surah, n_ayat
"""


@query
def prefix_agrees(spark: SparkSession, d: str) -> DataFrame:
    """Linked entries whose name begins as their person's does, in the first fifteen letters of both."""
    e = table(spark, d, "person_entries").select("entry_id", "ishabah_id", F.col("name_ar").alias("name")).distinct()
    p = table(spark, d, "persons").select("ishabah_id", F.col("name_ar").alias("own"))
    return e.join(p, "ishabah_id").where(P.same_prefix(F.col("name"), F.col("own"))).select("entry_id", "ishabah_id")


ORACLE["prefix_agrees"] = f"""
WITH e AS (SELECT DISTINCT entry_id, ishabah_id, {_sql('N6k', 'name_ar')} AS t FROM person_entries), p AS (SELECT ishabah_id, {_sql('N6k', 'name_ar')} AS p FROM persons)
SELECT entry_id, ishabah_id FROM e JOIN p USING (ishabah_id) WHERE t <> '' AND p <> '' AND substr(p, 1, least(15, length(p), length(t))) = substr(t, 1, least(15, length(p), length(t)))
"""


@query
def copied_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Links of resolved entries copied to the open entries of other dictionaries under the same name."""
    e = table(spark, d, "person_entries").select("entry_id", "ishabah_id", "link_status", N.pair_key(F.col("name_ar")).alias("key")).distinct()
    return segmentation.copy_to_pairs(e.where("link_status = 'resolved'").select("key", F.col("ishabah_id").alias("cid")), e.where("ishabah_id is null").select(F.col("entry_id").alias("rid"), "key"))


ORACLE["copied_pairs"] = f"""
WITH e AS (SELECT DISTINCT entry_id, ishabah_id, link_status, {_sql('N11', 'name_ar')} AS key FROM person_entries), r AS (SELECT key, min(ishabah_id) AS cid FROM e WHERE link_status = 'resolved' AND ishabah_id IS NOT NULL AND key <> '' GROUP BY key)
SELECT entry_id AS rid, cid FROM e JOIN r USING (key) WHERE e.ishabah_id IS NULL
"""


def _names(spark: SparkSession, d: str) -> DataFrame:
    """Names of all entries, each put after its person's as a clause of its own: with a comma, as kin, or carried on."""
    e = table(spark, d, "person_entries").select("entry_id", "name_ar", "kunya", F.col("entry_id").alias("k")).distinct()
    more = F.when(F.col("k") % 4 == 1, F.concat(F.lit("، "), F.coalesce("kunya", F.lit("")))).when(F.col("k") % 4 == 2, F.concat(F.lit(" - أمه "), "name_ar")).when(F.col("k") % 4 == 3, F.concat(F.lit("؛ ابن "), "name_ar")).otherwise("")
    return e.select("entry_id", F.concat("name_ar", more).alias("name"))


@query
def name_structures(spark: SparkSession, d: str) -> DataFrame:
    """Chain, kunyas, nisbas and title of every entry's name, with a second clause: an apposition, kin, or the chain carried on."""
    got = entities.name_structures(_names(spark, d), "entry_id")
    text = lambda c: F.array_join(c, "|").alias(c)
    return got.select("entry_id", text("chain"), text("kunyas"), "father_kunya", text("nisbas"), "titled", "head", "norm")


@query
def body_chains(spark: SparkSession, d: str) -> DataFrame:
    """The longest chain of forefathers in every paragraph, and how many there are."""
    p = _slim(spark, d, "para_id", "text").where("text is not null").select("para_id", entities.body_chains(F.col("text")).alias("c"))
    return p.where("size(c) > 0").select("para_id", F.size("c").alias("n_chains"), F.size(F.get("c", F.lit(0))).alias("n_names"), F.md5(F.array_join(F.get("c", F.lit(0)), "|")).alias("digest"))


@query
def article_heads(spark: SparkSession, d: str) -> DataFrame:
    """E5: of every dictionary entry's article, its first paragraphs up to the next heading and the first of its body."""
    e = table(spark, d, "person_entries").select(F.col("entry_id").alias("seg_id"), "source", "from_page", "from_para", "to_page", "to_para").distinct()
    rows = slicing.slice_intervals(e, _slim(spark, d, "source", "web_page", "para_idx", "text"))
    return entities.head_and_body(rows, P.is_heading(F.col("text"))).select("seg_id", F.md5("head_text").alias("head"), F.md5("body_text").alias("body"))


_N10 = lambda c: rf"trim(regexp_replace(regexp_replace(regexp_replace({c}, '[\x{{FB50}}-\x{{FDFF}}\x{{FE70}}-\x{{FEFF}}]', ' ', 'g'), '[\x{{610}}-\x{{61A}}\x{{64B}}-\x{{65F}}\x{{670}}\x{{6D6}}-\x{{6ED}}\x{{640}}]', '', 'g'), '{N.SPACE}', ' ', 'g'))"
_ARTICLES = _SLICE_SQL.replace("SELECT DISTINCT seg_id, source", "SELECT DISTINCT entry_id AS seg_id, source").replace("FROM event_segments WHERE", "FROM person_entries WHERE").replace("SELECT DISTINCT para_id, source", "SELECT DISTINCT source").replace(", printed_juz, printed_page, url, text FROM pages", ", text FROM pages")
ORACLE["article_heads"] = f"""WITH {_ARTICLES}, b AS (SELECT *, {_T_SQL} AS t FROM r), h AS (SELECT seg_id, rel_idx, text, {_HEADING_SQL} AS head FROM b),
k AS (SELECT *, max(CASE WHEN head AND rel_idx > 0 THEN 1 ELSE 0 END) OVER (PARTITION BY seg_id ORDER BY rel_idx) AS stop FROM h),
a AS (SELECT seg_id, md5(string_agg(text, chr(10) ORDER BY rel_idx)) AS head FROM k WHERE stop = 0 AND rel_idx < 6 GROUP BY seg_id),
o AS (SELECT seg_id, md5(substr({_N10('arg_min(text, rel_idx)')}, 1, 300)) AS body FROM k WHERE NOT head AND rel_idx > 0 AND length(trim(text)) > 8 GROUP BY seg_id)
SELECT seg_id, head, body FROM a LEFT JOIN o USING (seg_id)
"""


@query
def review_questions(spark: SparkSession, d: str) -> DataFrame:
    """E19, SRC9: open entries as blocks for review, with the persons of their town and year as candidates, and what reading the blocks gives."""
    e = table(spark, d, "person_entries").where("ishabah_id is null and entry_num is not null").groupBy("source", F.col("entry_num").alias("number")).agg(F.min(F.struct("entry_id", "name_ar", "kunya", "town", "death_h")).alias("e")).select("source", "number", "e.*")
    p = table(spark, d, "persons").select(F.col("ishabah_id").alias("cid"), F.col("name_ar").alias("name"), F.col("kunya").alias("body"), "town", "death_h")
    c = e.select("source", "number", "town", "death_h").join(p, ["town", "death_h"]).withColumn("rank", F.col("cid"))
    blocks = entities.review_text(e.select("source", "number", F.col("name_ar").alias("title"), F.col("kunya").alias("body")), c)
    got = blocks.select(F.explode(src.review_blocks(F.col("block"))).alias("b"), F.length("block").alias("n_chars"))
    return got.select("b.source", "b.number", F.array_join(F.transform("b.candidates", lambda x: x.cast("string")), ",").alias("candidates"), "n_chars")


ORACLE["review_questions"] = f"""
WITH e AS (SELECT * FROM person_entries WHERE ishabah_id IS NULL AND entry_num IS NOT NULL QUALIFY row_number() OVER (PARTITION BY source, entry_num ORDER BY entry_id, loaded_at DESC) = 1),
l AS (SELECT e.source, e.entry_num, p.ishabah_id AS cid, '  [' || p.ishabah_id || '] ' || coalesce({_N10('p.name_ar')}, '') || ' | ' || substr(coalesce({_N10('p.kunya')}, ''), 1, 120) AS line FROM e JOIN persons p ON p.town = e.town AND p.death_h = e.death_h),
c AS (SELECT source, entry_num, string_agg(CAST(cid AS VARCHAR), ',' ORDER BY cid) AS ids, string_agg(line, chr(10) ORDER BY cid) AS lines FROM l GROUP BY ALL)
SELECT e.source, e.entry_num AS number, coalesce(ids, '') AS candidates, length('### Q ' || e.source || '#' || e.entry_num || chr(10) || 'judul: ' || coalesce({_N10('e.name_ar')}, '') || chr(10) || 'nasab: ' || coalesce(substr({_N10('e.kunya')}, 1, 300), '')) + coalesce(length(lines) + 1, 0) AS n_chars
FROM e LEFT JOIN c ON c.source = e.source AND c.entry_num = e.entry_num
"""


@query
def longest_titles(spark: SparkSession, d: str) -> DataFrame:
    """Chapter headings made of every event's name to the event whose name or alias is the longest that begins them."""
    r = _registry(spark, d).where("name_ar is not null")
    titles = r.select(F.col("event_id").alias("tid"), F.concat(F.lit("[تفسير] سورة "), "name_ar", F.lit(" ("), F.coalesce("era", F.lit("x")), F.lit(")")).alias("title"))
    aliases = r.select(F.col("event_id").alias("target"), F.col("name_ar").alias("alias")).unionByName(r.select(F.col("event_id").alias("target"), F.explode("aliases").alias("alias")))
    return resolution.title_targets(titles, aliases)


_N9 = lambda c: rf"list_filter(string_split(trim(regexp_replace(regexp_replace(translate(regexp_replace(regexp_replace({c}, '[\x{{FB50}}-\x{{FDFF}}\x{{FE70}}-\x{{FEFF}}]', ' ', 'g'), '[\x{{64B}}-\x{{65F}}\x{{670}}\x{{640}}]', '', 'g'), 'أإآٱءةىؤئ', 'اااااهيوي'), '[^\p{{L}}\p{{N}}]+', ' ', 'g'), ' +', ' ', 'g')), ' '), lambda x: x <> '')"
ORACLE["longest_titles"] = f"""
WITH r AS (SELECT event_id, name_ar, CASE WHEN json_valid(aliases_ar) THEN list_transform(from_json(aliases_ar, '["VARCHAR"]'), lambda x: {_sql('N2', 'x')}) ELSE [] END AS aliases FROM event_registry WHERE name_ar IS NOT NULL),
t AS (SELECT event_id AS tid, {_N9(r"regexp_replace(regexp_replace(name_ar, '\[[^\[\]]*\]', ' ', 'g'), '\([^()]*\)', ' ', 'g')")} AS w FROM r),
a AS (SELECT DISTINCT event_id AS target, {_N9('alias')} AS w FROM (SELECT event_id, name_ar AS alias FROM r UNION ALL SELECT event_id, unnest(aliases) FROM r)),
h AS (SELECT tid, target, len(a.w) AS n FROM t JOIN a ON len(a.w) > 0 AND t.w[1] = a.w[1] AND t.w[1:len(a.w)] = a.w),
b AS (SELECT tid, min(target) AS least, max(target) AS most FROM h WHERE n = (SELECT max(n) FROM h g WHERE g.tid = h.tid) GROUP BY tid)
SELECT t.tid, CASE WHEN least = most THEN least END AS target, CASE WHEN len(t.w) = 0 THEN 'no heading' WHEN least IS NULL THEN 'unknown' WHEN least = most THEN 'ok' ELSE 'ambiguous' END AS status FROM t LEFT JOIN b USING (tid)
"""


@query
def number_notes(spark: SparkSession, d: str) -> DataFrame:
    """Dictionary entries with a note on a number that two of them bear, and on the stored confidence and its method."""
    e = table(spark, d, "person_entries").select("entry_id", "source", "entry_num", "link_confidence", "link_method").distinct()
    twice = e.where("entry_num is not null").groupBy("source", "entry_num").agg(F.max("entry_id").alias("row_id"), F.count("*").alias("n")).where("n > 1")
    fixes = twice.select("row_id", F.col("entry_num").cast("string").alias("printed_label"), F.lit("entered twice").alias("reason"))
    rows = e.select(F.col("entry_id").alias("row_id"), F.col("entry_num").alias("num"), F.col("link_confidence").alias("grade"), F.col("link_method").alias("grade_by"))
    return resolution.with_fixes(rows, fixes).select("row_id", "number_note", "grade_note")


ORACLE["number_notes"] = """
WITH e AS (SELECT DISTINCT entry_id, source, entry_num, link_confidence, link_method FROM person_entries), x AS (SELECT max(entry_id) AS row_id, entry_num FROM e WHERE entry_num IS NOT NULL GROUP BY source, entry_num HAVING count(*) > 1)
SELECT e.entry_id AS row_id, CASE WHEN x.row_id IS NOT NULL THEN 'printed as ' || x.entry_num || ': entered twice' END AS number_note, CASE WHEN link_confidence IS NOT NULL THEN concat_ws(' - ', link_confidence, link_method) END AS grade_note FROM e LEFT JOIN x ON x.row_id = e.entry_id
"""


@query
def addressed_sections(spark: SparkSession, d: str) -> DataFrame:
    """Sections of every page by the beginning of their title, and by number."""
    p = _slim(spark, d, "source", "web_page", "para_idx", "text").where(~P.is_blank(F.col("text")))
    s = slicing.sections(p, ["source", "web_page"], "para_idx").select(F.concat_ws("#", "source", "web_page").alias("seg_id"), "section", "title")
    s = cut(s, "sections")
    by = lambda ref: resolution.address_section(s, ref).select(F.lit(ref).alias("ref"), "seg_id", "section", "status")
    return by("باب").unionByName(by("2")).unionByName(by("لا يوجد"))


ORACLE["addressed_sections"] = f"""
WITH a AS (SELECT DISTINCT source, web_page, para_idx, text FROM pages WHERE {_STRIP('text')} <> ''), b AS (SELECT *, {_T_SQL} AS t FROM a), c AS (SELECT *, {_HEADING_SQL} AS head FROM b),
e AS (SELECT source || '#' || web_page AS seg_id, text, head, sum(CASE WHEN head THEN 1 ELSE 0 END) OVER (PARTITION BY source, web_page ORDER BY para_idx) AS section FROM c),
s AS (SELECT seg_id, section, max(CASE WHEN head THEN text END) AS title FROM e GROUP BY seg_id, section), h AS (SELECT * FROM s WHERE starts_with({_sql('N2', 'title')}, 'باب'))
SELECT 'باب' AS ref, seg_id, CAST(section AS BIGINT) AS section, CASE WHEN count(*) OVER (PARTITION BY seg_id) = 1 THEN 'found' ELSE 'ambiguous' END AS status FROM h
UNION ALL SELECT '2', seg_id, section, 'found' FROM s WHERE section = 2
"""


@query
def quoted_phrases(spark: SparkSession, d: str) -> DataFrame:
    """What every paragraph quotes between guillemets, in the verse profile."""
    q = quotations.inline_quotes(_slim(spark, d, "para_id", "text"), ["para_id"], "para_id", marks="«([^»]{2,}?)»")
    return q.select("para_id", "k", F.md5("phrase").alias("digest"))


ORACLE["quoted_phrases"] = f"""
WITH p AS (SELECT DISTINCT para_id, text FROM pages), x AS (SELECT para_id, regexp_extract_all(text, '«([^»]{{2,}}?)»', 1) AS a FROM p), y AS (SELECT para_id, unnest(range(len(a))) AS k, unnest(a) AS q FROM x)
SELECT para_id, CAST(k AS INTEGER) AS k, md5(phrase) AS digest FROM (SELECT para_id, k, trim({_sql('N4', 'q')}, ' .،:') AS phrase FROM y) WHERE length(phrase) >= 2
"""


@query
def guarded_pages(spark: SparkSession, d: str) -> DataFrame:
    """Every page's paragraphs as segments at its headings (by their first word), with what stands before and after them."""
    p = _slim(spark, d, "para_id", "source", "web_page", "para_idx", "text").where("text is not null")
    pos = F.row_number().over(W.partitionBy("source", "web_page").orderBy("para_idx", "para_id")) - 1
    rows = cut(p.select("source", "web_page", pos.alias("pos"), "text"), "rows")
    anchors = cut(rows.where(P.is_heading(F.col("text"))).select("source", "web_page", "pos", F.split(N.name_column(F.col("text")), " ")[0].alias("label"), F.lit("heading").alias("kind")), "anchors")
    names = rows.select("source", "web_page").distinct().select("source", "web_page", F.lit(None).cast("string").alias("own_name"), F.lit(None).cast("string").alias("next_name"))
    return quotations.guarded_segments(rows, anchors, names, ["source", "web_page"])


ORACLE["guarded_pages"] = f"""
WITH a AS (SELECT DISTINCT para_id, source, web_page, para_idx, text FROM pages WHERE text IS NOT NULL),
p AS (SELECT source, web_page, text, row_number() OVER (PARTITION BY source, web_page ORDER BY para_idx, para_id) - 1 AS pos, {_sql('N4', 'text')} AS v FROM a), b AS (SELECT *, {_T_SQL} AS t FROM p),
h AS (SELECT source, web_page, pos, string_split({_sql('N2', 'text')}, ' ')[1] AS label FROM b WHERE {_HEADING_SQL}),
e AS (SELECT source, web_page, min(pos) AS f, max(pos) AS l FROM h GROUP BY ALL),
c AS (SELECT source, web_page, f, max(pos) AS z, min(CASE WHEN pos > l + 1 AND v IN ('﷽', 'بسم الله الرحمن الرحيم') THEN pos END) AS tr, min(CASE WHEN pos > l AND regexp_matches(ltrim(v, '*[]() '), '^(خاتمت|اللهم امين|امين|رب يسر|رب اعن)') THEN pos END) AS cl,
  min(CASE WHEN pos < f AND starts_with(v, 'اعوذ بالله') THEN pos END) AS rf FROM p JOIN e USING (source, web_page) GROUP BY source, web_page, f),
g AS (SELECT source, web_page, f, z, coalesce(tr, z + 1) AS tr, CASE WHEN cl < coalesce(tr, z + 1) THEN cl END AS cl, CASE WHEN rf > 0 THEN rf END AS rf FROM c),
k AS (SELECT * FROM (SELECT *, lag(label) OVER (PARTITION BY source, web_page ORDER BY pos) AS before FROM h) WHERE before IS NULL OR before <> label),
s AS (SELECT k.source, k.web_page, pos AS from_pos, coalesce(lead(pos) OVER (PARTITION BY k.source, k.web_page ORDER BY pos), cl, tr) - 1 AS to_pos, label, 'heading' AS kind FROM k JOIN g USING (source, web_page)
  UNION ALL SELECT source, web_page, 0, coalesce(rf, f) - 1, 'intro', 'intro' FROM g UNION ALL SELECT source, web_page, rf, f - 1, 'istiadhah', 'istiadhah' FROM g WHERE rf IS NOT NULL
  UNION ALL SELECT source, web_page, cl, tr - 1, 'closing', 'closing' FROM g WHERE cl IS NOT NULL UNION ALL SELECT source, web_page, tr, z, 'out_of_scope', 'out_of_scope' FROM g)
SELECT source, web_page, from_pos, to_pos, label, kind FROM s WHERE from_pos <= to_pos
"""


# ---- twins of what corpus_queries registers without one

_NEW_FILE = "(f.used > 0 AND (f.used >= 8000 OR f.size >= 70000 OR (f.used >= 6800 AND start)))"
ORACLE["split_export"] = f"""
WITH RECURSIVE n AS (SELECT source, web_page, CAST(sum(coalesce(len(regexp_split_to_array(trim(text), ' +')), 0)) AS BIGINT) AS w, CAST(sum(coalesce(strlen(text), 0)) AS BIGINT) AS b FROM (SELECT DISTINCT para_id, source, web_page, text FROM pages) GROUP BY source, web_page),
b AS (SELECT source, from_page AS web_page FROM event_segments UNION SELECT source, from_page FROM segments),
p AS (SELECT n.*, b.web_page IS NOT NULL AS start, row_number() OVER (PARTITION BY n.source ORDER BY n.web_page) AS k FROM n LEFT JOIN b ON b.source = n.source AND b.web_page = n.web_page),
f AS (SELECT source, k, web_page, w, b, w AS used, b AS size, 0 AS file_no FROM p WHERE k = 1
  UNION ALL SELECT p.source, p.k, p.web_page, p.w, p.b, p.w + CASE WHEN {_NEW_FILE} THEN 0 ELSE f.used END, p.b + CASE WHEN {_NEW_FILE} THEN 0 ELSE f.size END, f.file_no + CASE WHEN {_NEW_FILE} THEN 1 ELSE 0 END FROM f JOIN p ON p.source = f.source AND p.k = f.k + 1)
SELECT source, CAST(file_no AS INTEGER) AS file_no, CASE WHEN file_no > 0 THEN '# ' || source || ', continued, part ' || (file_no + 1) END AS header, CAST(sum(w) AS BIGINT) AS n_words, CAST(sum(b) AS BIGINT) AS n_bytes, min(web_page) AS first_page FROM f GROUP BY source, file_no
"""
_PLAIN = "translate(text, 'أإآٱىة', 'اااايه')"
ORACLE["fts_snippet"] = rf"""
WITH top AS ({ORACLE['fts_bm25_topk']}), qq AS (SELECT qid, array_to_string(a, ' ') AS ph, a FROM (WITH {_QUERY} SELECT qid, a FROM q)),
x AS (SELECT top.qid, top.id, top.rank, p.text, ph, a, regexp_replace({_PLAIN}, '[\x{{64B}}-\x{{652}}\x{{670}}\x{{640}}\x{{6D6}}-\x{{6ED}}]', '', 'g') AS plain,
  list_filter(range(0, length(p.text)), lambda i: NOT regexp_matches(substr(p.text, i + 1, 1), '[\x{{64B}}-\x{{652}}\x{{670}}\x{{640}}\x{{6D6}}-\x{{6ED}}]')) AS ix FROM top JOIN qq USING (qid) JOIN (SELECT DISTINCT para_id AS id, text FROM pages) p USING (id)),
y AS (SELECT *, coalesce(list_filter(list_transform(list_concat([ph], a), lambda w: strpos(plain, w)), lambda k: k > 0)[1], 0) AS k FROM x),
z AS (SELECT *, CASE WHEN k = 0 THEN 0 ELSE greatest(ix[k] - 100, 0) END AS s0, CASE WHEN k = 0 THEN least(length(text), 340) ELSE least(ix[least(k + length(ph), len(ix))] + 240, length(text)) END AS e0 FROM y),
w AS (SELECT *, CASE WHEN s0 > 0 AND strpos(substr(text, s0 + 1, 40), ' ') > 0 THEN s0 + strpos(substr(text, s0 + 1, 40), ' ') ELSE s0 END AS s FROM z),
v AS (SELECT *, greatest(e0 - 40, s) AS lo FROM w),
u AS (SELECT *, CASE WHEN e0 < length(text) AND strpos(reverse(substr(text, lo + 1, e0 - lo)), ' ') > 0 THEN e0 - strpos(reverse(substr(text, lo + 1, e0 - lo)), ' ') ELSE e0 END AS e FROM v)
SELECT qid, id, rank, CASE WHEN s > 0 THEN '…' ELSE '' END || {_STRIP('substr(text, s + 1, e - s)')} || CASE WHEN e < length(text) THEN '…' ELSE '' END AS snippet FROM u
"""
