"""The registered queries of the operators for training text, and their equivalents in SQL where there are any."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from warraq.functions import normalise
from warraq.llm import encodings, lookalikes, matching, mixing, names, packing, spans, splitting, tokens
from warraq.plans.materialize import cut, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


def _paragraphs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").select(F.col("para_id").alias("id"), "text")


@query
def p6_found(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of paragraphs that share 80 or more consecutive code points."""
    return spans.shared_pairs(_paragraphs(spark, d)).toDF("para_id_a", "para_id_b")


_GRAMS = """
t AS (SELECT DISTINCT para_id, text FROM pages WHERE length(text) >= 80),
i AS (SELECT para_id, text, unnest(range(1, length(text) - 78)) AS pos FROM t),
g AS (SELECT para_id, pos, substr(text, pos, 80) AS s FROM i)
"""
ORACLE["p6_found"] = f"WITH {_GRAMS} SELECT DISTINCT a.para_id AS para_id_a, b.para_id AS para_id_b FROM g a JOIN g b ON a.s = b.s AND a.para_id < b.para_id"


@query
def p6_shared_share(spark: SparkSession, d: str) -> DataFrame:
    """Of every paragraph, how much of its text occurs in others."""
    return spans.shared_share(_paragraphs(spark, d)).withColumnRenamed("id", "para_id")


def _text_pieces(spark: SparkSession, d: str) -> DataFrame:
    return splitting.split_texts(_paragraphs(spark, d))


def _page_pieces(spark: SparkSession, d: str) -> DataFrame:
    ranges = table(spark, d, "event_segments").select(F.col("seg_id").alias("id"), "source", "from_page", "to_page")
    grades = splitting.page_grades(table(spark, d, "pages").select("source", "web_page", "para_idx", "text"))
    return splitting.split_page_ranges(ranges, grades)


@query
def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """Paragraphs of more than 1,500 code points and event segments of more than 8 pages: those cut into pieces."""
    of = lambda item, pieces: pieces.where("piece_no = 1").select(F.lit(item).alias("item"), F.col("id").alias("item_id"))
    return of("paragraph", _text_pieces(spark, d)).unionByName(of("event_segment", _page_pieces(spark, d)))


ORACLE["p3_found"] = """
SELECT DISTINCT 'paragraph' AS item, para_id AS item_id FROM pages WHERE length(text) > 1500
UNION ALL SELECT DISTINCT 'event_segment', seg_id FROM event_segments WHERE to_page - from_page + 1 > 8
"""


@query
def p3_text_pieces(spark: SparkSession, d: str) -> DataFrame:
    """The pieces of the long paragraphs."""
    return _text_pieces(spark, d).withColumnRenamed("id", "para_id")


@query
def p3_page_pieces(spark: SparkSession, d: str) -> DataFrame:
    """The pieces of the long event segments."""
    return _page_pieces(spark, d).withColumnRenamed("id", "seg_id")


_WS = r"[\s\x{0B}\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
_CUTS = ((4, r"\n+"), (3, rf"[.!?؟][»\"'')\]”]*[¹²³]?{_WS}+"), (2, rf"[،؛,;:][»\"'')\]”]*{_WS}+|{_WS}\.\.\.{_WS}+"), (1, f"{_WS}+"))
#: Where a match ends: what was split off before it, and all matches so far.
_ENDS = " UNION ALL ".join(
    f"SELECT id, {g} AS grade, unnest(list_transform(range(1, len(m) + 1), lambda i: CAST(list_sum(list_transform(s[1:i], lambda x: length(x))) + list_sum(list_transform(m[1:i], lambda x: length(x))) AS BIGINT))) AS pos FROM (SELECT id, regexp_split_to_array(text, '{p}') AS s, regexp_extract_all(text, '{p}') AS m FROM t)"
    for g, p in _CUTS
)
#: The greedy walk over boundaries l (a list of pos, grade), piece by piece.
_WALK = """
c AS (SELECT id, n, CAST(0 AS BIGINT) AS piece_no, CAST(0 AS BIGINT) AS st, l FROM i
  UNION ALL SELECT id, n, piece_no + 1, list_max(list_transform(list_filter(l, lambda x: x.pos <= e - {overlap}), lambda x: x.pos)), l FROM (
    SELECT *, list_max(list_transform(list_filter(l, lambda x: x.pos > st + {limit} // 2 AND x.pos <= st + {limit}), lambda x: x.grade * 1099511627776 + x.pos)) % 1099511627776 AS e FROM c WHERE n - st > {limit})),
d AS (SELECT *, CASE WHEN n - st <= {limit} THEN n ELSE list_max(list_transform(list_filter(l, lambda x: x.pos > st + {limit} // 2 AND x.pos <= st + {limit}), lambda x: x.grade * 1099511627776 + x.pos)) % 1099511627776 END AS en FROM c)
"""
ORACLE["p3_text_pieces"] = f"""
WITH RECURSIVE t AS (SELECT DISTINCT para_id AS id, text FROM pages WHERE length(text) > 1500), ends AS ({_ENDS} UNION ALL SELECT id, 5, 0 FROM t UNION ALL SELECT id, 5, length(text) FROM t),
b AS (SELECT id, pos, max(grade) AS grade FROM ends GROUP BY id, pos), g AS (SELECT *, lead(pos) OVER (PARTITION BY id ORDER BY pos) AS nx FROM b),
h AS (SELECT id, pos, grade FROM b UNION ALL SELECT id, unnest(range(pos + 50, nx, 50)), 0 FROM g WHERE nx - pos > 50),
i AS (SELECT id, length(any_value(text)) AS n, list({{'pos': CAST(pos AS BIGINT), 'grade': CAST(grade AS BIGINT)}}) AS l FROM h JOIN t USING (id) GROUP BY id), {_WALK.format(limit=1500, overlap=100)}
SELECT d.id AS para_id, piece_no, st AS start, en AS "end", substr(text, st + 1, en - st) AS piece FROM d JOIN t USING (id)
"""
ORACLE["p3_page_pieces"] = f"""
WITH RECURSIVE p AS (SELECT DISTINCT source, web_page, para_idx, text FROM pages WHERE trim(text) <> ''),
hd AS (SELECT source, web_page, length(text) AS n, right(rtrim(text), 1) AS last FROM p QUALIFY row_number() OVER (PARTITION BY source, web_page ORDER BY para_idx, length(text), right(rtrim(text), 1)) = 1),
tl AS (SELECT source, web_page, right(regexp_replace(rtrim(text), '[»"'')\\]¹²³]+$', ''), 1) AS last FROM p QUALIFY row_number() OVER (PARTITION BY source, web_page ORDER BY para_idx DESC, right(regexp_replace(rtrim(text), '[»"'')\\]¹²³]+$', ''), 1) DESC) = 1),
gr AS (SELECT source, page, max(g) AS g FROM (SELECT source, web_page AS page, 2 AS g FROM hd WHERE n <= 70 AND last NOT IN ('.', '؟', '،', '؛') UNION ALL SELECT source, web_page + 1, 1 FROM tl WHERE last IN ('.', '؟', '!', '?')) GROUP BY ALL),
r AS (SELECT DISTINCT seg_id AS id, source, from_page, to_page - from_page + 1 AS n FROM event_segments WHERE to_page - from_page + 1 > 8),
u AS (SELECT *, unnest(range(0, n + 1)) AS pos FROM r),
i AS (SELECT u.id, CAST(u.n AS BIGINT) AS n, list({{'pos': CAST(pos AS BIGINT), 'grade': CAST(CASE WHEN pos = 0 OR pos = u.n THEN 5 ELSE coalesce(gr.g, 0) END AS BIGINT)}}) AS l FROM u LEFT JOIN gr ON gr.source = u.source AND gr.page = from_page + pos GROUP BY u.id, u.n), {_WALK.format(limit=8, overlap=1)}
SELECT d.id AS seg_id, piece_no, from_page + st AS from_page, from_page + en - 1 AS to_page FROM d JOIN r USING (id)
"""
ORACLE["p6_shared_share"] = f"""WITH {_GRAMS},
c AS (SELECT s FROM g GROUP BY s HAVING count(DISTINCT para_id) > 1),
h AS (SELECT DISTINCT para_id, pos FROM g JOIN c USING (s)),
n AS (SELECT para_id, least(80, pos - coalesce(lag(pos) OVER (PARTITION BY para_id ORDER BY pos), -100)) AS new FROM h),
k AS (SELECT para_id, CAST(sum(new) AS INTEGER) AS shared FROM n GROUP BY para_id)
SELECT p.para_id, length(p.text) AS n_chars, CASE WHEN p.text IS NOT NULL THEN coalesce(k.shared, 0) END AS shared_chars, CASE WHEN length(p.text) = 0 THEN 0.0 WHEN p.text IS NOT NULL THEN coalesce(k.shared, 0) / length(p.text) END AS shared_share
FROM (SELECT DISTINCT para_id, text FROM pages) p LEFT JOIN k USING (para_id)
"""


def _spelled(spark: SparkSession, d: str) -> DataFrame:
    of = lambda tab, key, text: table(spark, d, tab).select(F.lit(tab).alias("tab"), F.col(key).cast("string").alias("row_key"), F.col(text).alias("text"))
    return of("pages", "para_id", "text").unionByName(of("event_registry", "event_id", "name_ar")).unionByName(of("person_entries", "entry_id", "name_ar"))


@query
def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """Rows whose text is stored with characters that look like the ordinary ones."""
    return lookalikes.one_form(_spelled(spark, d)).select("tab", "row_key").distinct()


@query
def p4_one_form(spark: SparkSession, d: str) -> DataFrame:
    """These rows with their text in the one consistent form."""
    return lookalikes.one_form(_spelled(spark, d))


def _documents(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select(F.col("doc_id").alias("id"), "source", "text")


@query
def p9_found(spark: SparkSession, d: str) -> DataFrame:
    """Documents with a stretch of text that was read in another encoding than it was written in."""
    return encodings.garbled(_documents(spark, d)).select(F.col("id").alias("doc_id")).distinct()


@query
def p9_restored(spark: SparkSession, d: str) -> DataFrame:
    """These documents with their text restored as far as it can be."""
    return encodings.restore(_documents(spark, d)).withColumnRenamed("id", "doc_id")


@query
def p7_containers(spark: SparkSession, d: str) -> DataFrame:
    """The container of every document or piece, for every capacity."""
    packed = packing.pack_all(tokens.with_sizes(_documents(spark, d)), table(spark, d, "pack_specs"))
    return packed.withColumnRenamed("id", "doc_id")


@query
def p7_fill(spark: SparkSession, d: str) -> DataFrame:
    """Containers, tokens and unused room of every capacity."""
    per = p7_containers(spark, d).groupBy("spec_id", "capacity", "container_id").agg(F.sum("n_tokens").alias("used"))
    return per.groupBy("spec_id", "capacity").agg(
        F.count("*").alias("n_containers"), F.sum("used").alias("n_tokens"), F.max("used").alias("fullest"), (1 - F.sum("used") / (F.count("*") * F.col("capacity"))).alias("unused_share")
    )


def _mix(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    sizes = cut(tokens.with_sizes(_documents(spark, d)), "sizes")
    rate = cut(mixing.rates(sizes, table(spark, d, "mix_targets")), "rates")
    return mixing.mix(sizes, rate), rate


@query
def p8_mixture(spark: SparkSession, d: str) -> DataFrame:
    """The chosen documents, one row a copy."""
    return _mix(spark, d)[0].withColumnRenamed("id", "doc_id")


@query
def p8_shares(spark: SparkSession, d: str) -> DataFrame:
    """Target and actual share of every listed source."""
    return mixing.shares(*_mix(spark, d))


def _entries(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "person_entries").withColumn("canonical", F.coalesce(F.col("link_status") == "canonical", F.lit(False)))


def _resolved(spark: SparkSession, d: str) -> DataFrame:
    return matching.resolve(_entries(spark, d).where("not canonical"), table(spark, d, "persons"))


@query
def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """The person of every entry whose stored ishabah_id is null, where there is one."""
    open_ = _entries(spark, d).where("ishabah_id is null").select("entry_id").distinct()
    return _resolved(spark, d).join(open_, "entry_id").select("ishabah_id", "entry_id")


@query
def p2_links(spark: SparkSession, d: str) -> DataFrame:
    """The person of every entry of the later dictionaries, with marginal probability and confidence."""
    return _resolved(spark, d)


@query
def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of entries about the same person whose names as stored aren't identical."""
    entries = _entries(spark, d)
    name = cut(entries.groupBy("entry_id").agg(F.min("name_ar").alias("name_ar")), "names")
    of = lambda x: name.select(F.col("entry_id").alias(f"entry_id_{x}"), F.col("name_ar").alias(x))
    pairs = matching.same_person(entries).join(of("a"), "entry_id_a").join(of("b"), "entry_id_b")
    return pairs.where("not a <=> b").select("entry_id_a", "entry_id_b")


@query
def p5_linked(spark: SparkSession, d: str) -> DataFrame:
    """Every entry with its class of equal records, its canonical entry and the number of entries about the same person: the links of p5_found without making pairs."""
    return matching.linked_entries(_entries(spark, d))


@query
def p5_near_words(spark: SparkSession, d: str) -> DataFrame:
    """The radius join by itself: words of all entries' names within a Damerau-Levenshtein distance of 1, x < y."""
    words = table(spark, d, "person_entries").select(F.explode(F.split(normalise.person_key(F.col("name_ar")), " ")).alias("word"))
    return names.near_parts(words).where("x < y")


_LETTERS = "regexp_replace(translate(regexp_replace(regexp_replace(name_ar, '[\\x{FB50}-\\x{FDFF}\\x{FE70}-\\x{FEFF}\\x{200B}-\\x{200F}\\x{061C}]', ' ', 'g'), '[\\x{0610}-\\x{061A}\\x{064B}-\\x{065F}\\x{0670}\\x{06D6}-\\x{06ED}\\x{0640}]', '', 'g'), 'أإآٱةىؤئ', 'ااااهيوي'), '[^\\x{0621}-\\x{064A}]', ' ', 'g')"
_PHRASES = "صلي الله عليه وسلم|صلي الله عليه واله وسلم|صلي الله عليه|عليه السلام|عليها السلام|عليهما السلام|رضي الله عنه|رضي الله عنها|رضي الله عنهما|رضي الله عنهم|رضي الله عنهن|رضي الله|رضوان الله عليه|رحمة الله عليه|رحمه الله|غفر الله له|اسلام رضي الله عنه|امراه|امراه ا|زوجه|زوجه النبي"
_KEY = f"regexp_replace({_LETTERS}, '(^|\\s)عبدال', '\\1عبد ال', 'g')"
for _phrase in _PHRASES.split("|"):
    _KEY = f"replace({_KEY}, '{_phrase}', ' ')"
ORACLE["p5_near_words"] = f"""
WITH t AS (SELECT DISTINCT t FROM (SELECT unnest(regexp_split_to_array({_KEY}, ' +')) AS t FROM person_entries) WHERE t <> ''), i AS (SELECT t, unnest(range(1, length(t) + 1)) AS i FROM t),
d AS (SELECT t, i, substr(t, 1, i - 1) || substr(t, i + 1) AS k FROM i), w AS (SELECT t, substr(t, 1, i - 1) || substr(t, i + 1, 1) || substr(t, i, 1) || substr(t, i + 2) AS k FROM i WHERE i < length(t)),
p AS (SELECT d.t AS x, t.t AS y FROM d JOIN t ON d.k = t.t UNION SELECT a.t, b.t FROM d a JOIN d b ON a.k = b.k AND a.i = b.i AND length(a.t) = length(b.t) UNION SELECT w.t, t.t FROM w JOIN t ON w.k = t.t)
SELECT DISTINCT least(x, y) AS x, greatest(x, y) AS y FROM p WHERE x <> y
"""


def _lengths(spark: SparkSession, d: str) -> DataFrame:
    """Documents sized in code points: what SQL can count too."""
    return table(spark, d, "documents").select(F.col("doc_id").alias("id"), "source", F.coalesce(F.length("text"), F.lit(0)).cast("bigint").alias("n_tokens")).distinct()


@query
def p7_placed(spark: SparkSession, d: str) -> DataFrame:
    """Documents sized in code points, packed for every capacity: pieces and size of each, whether pieces follow one another without a gap, and whether any of its containers is overfull."""
    packed = cut(packing.pack_all(_lengths(spark, d), table(spark, d, "pack_specs")), "packed")
    full = packed.groupBy("spec_id", "container_id").agg((F.sum("n_tokens") > F.first("capacity")).alias("overfull"))
    per = packed.join(full, ["spec_id", "container_id"]).groupBy("spec_id", F.col("id").alias("doc_id"))
    return per.agg(F.count("*").alias("n_pieces"), F.sum("n_tokens").alias("size"), (F.max(F.col("first_token") + F.col("n_tokens")) == F.sum("n_tokens")).alias("whole"), F.max("overfull").alias("overfull"))


ORACLE["p7_placed"] = """
SELECT DISTINCT spec_id, doc_id, CAST(greatest(ceil(coalesce(length(text), 0) / capacity), 1) AS BIGINT) AS n_pieces, CAST(coalesce(length(text), 0) AS BIGINT) AS size, true AS whole, false AS overfull FROM documents CROSS JOIN pack_specs
"""


@query
def p8_rates(spark: SparkSession, d: str) -> DataFrame:
    """How often to take a document of each listed source, sized in code points, and the bounds of the copies that gives."""
    rate = cut(mixing.rates(_lengths(spark, d), table(spark, d, "mix_targets")), "rates")
    per = mixing.mix(_lengths(spark, d), rate).groupBy("source", "id").agg(F.count("*").alias("copies"), F.max("copy_no").alias("last"))
    seen = per.groupBy("source").agg(F.min("copies").alias("fewest"), F.max("copies").alias("most"), F.min(F.col("copies") == F.col("last")).alias("counted"))
    x = rate.join(seen, "source", "left")
    within = F.when(F.col("fewest").isNotNull(), (F.col("fewest") >= F.greatest(F.floor("rate"), F.lit(1))) & (F.col("most") <= F.ceil("rate")) & F.col("counted"))
    return x.select("source", "target_share", "max_repeats", "n_docs", "available_tokens", F.round("rate", 9).alias("rate"), F.coalesce(within, F.lit(True)).alias("within"))


ORACLE["p8_rates"] = """
WITH z AS (SELECT DISTINCT doc_id, source, CAST(coalesce(length(text), 0) AS BIGINT) AS n FROM documents), s AS (SELECT source, count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS a FROM z GROUP BY source),
x AS (SELECT t.*, coalesce(n_docs, 0) AS n_docs, coalesce(a, 0) AS available_tokens FROM mix_targets t LEFT JOIN s USING (source)), y AS (SELECT *, sum(available_tokens) OVER () AS total FROM x)
SELECT source, target_share, max_repeats, n_docs, available_tokens, CASE WHEN available_tokens > 0 THEN round(least(CAST(max_repeats AS DOUBLE), target_share * total / available_tokens), 9) ELSE 0.0 END AS rate, true AS within FROM y
"""
