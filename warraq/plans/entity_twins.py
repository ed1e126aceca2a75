"""SQL equivalents of the entity queries and of the order-dependent choices, spelled for themselves."""

from __future__ import annotations

from warraq.plans.core_queries import ORACLE
from warraq.plans.corpus_queries import _HEADING_SQL, _REG, _SEG, _SLICE_SQL, _T_SQL, _TIER, EVENT_QUERIES, _sql

_LINKS = "('بن', 'ابن', 'بنت', 'ابنه', 'ب', 'مولي')"
_KUNYAS = "('ابو', 'ابي', 'ابا', 'ام')"
_STOPS = "('و', 'ف', 'ثم', 'يكني', 'ويكني', 'كني', 'الملقب', 'لقب', 'الشهير', 'المشهور', 'هو', 'هي', 'وهو', 'وهي', 'المعروف', 'بقيه')"
_TITLES = "امير المومنين|ام المومنين|خليفه رسول الله|خاتم النبيين|سيدنا|حبيب الله|صفوه الله|نقيب بني|حليف بني|حليف"


def _words(key: str) -> str:
    """Words of a name in the person profile, servant names as one word."""
    return rf"coalesce(list_filter(string_split(regexp_replace({key}, '(^|\s)عبد ', '\1عبد_', 'g'), ' '), lambda x: x <> ''), [])"


def _pick(condition: str, a: str = "w", take: str = "{a}[i]") -> str:
    """Of the list a, what ``take`` makes of the places i that meet the condition."""
    return f"list_transform(list_filter(range(1, len({a}) + 1), lambda i: {condition.format(a=a)}), lambda i: {take.format(a=a)})"


_IS_LINK, _AFTER_LINK, _AFTER_KUNYA = f"{{a}}[i] IN {_LINKS}", f"coalesce({{a}}[i - 1] IN {_LINKS}, false)", f"coalesce({{a}}[i - 1] IN {_KUNYAS}, false)"
_OPEN = "SELECT DISTINCT entry_id AS qid, name_ar AS name FROM person_entries WHERE link_status IS NULL OR link_status <> 'canonical'"


def _less(t: str) -> str:
    """The forms of t with one letter less, by place."""
    return f"list_transform(range(1, length({t}) + 1), lambda i: substr({t}, 1, i - 1) || substr({t}, i + 1))"


#: Pairs of words of tk(t) at most one edit apart, words under four letters only with themselves: one is the other with a letter less, or both are equal but for the letter at one place.
_NEAR = f"""
dl AS (SELECT t, unnest(range(1, length(t) + 1)) AS i, unnest({_less('t')}) AS k FROM tk WHERE length(t) >= 4),
near AS (SELECT t AS a, t AS b FROM tk UNION SELECT d.t, tk.t FROM dl d JOIN tk ON tk.t = d.k AND length(tk.t) >= 4 UNION SELECT tk.t, d.t FROM dl d JOIN tk ON tk.t = d.k AND length(tk.t) >= 4
  UNION SELECT x.t, y.t FROM dl x JOIN dl y ON x.k = y.k AND x.i = y.i AND length(x.t) = length(y.t))
"""

ORACLE["fuzzy_words"] = rf"""
WITH tk AS (SELECT DISTINCT t FROM (SELECT unnest(regexp_extract_all({_sql('N1', 'lower(text)')}, '[\p{{L}}\p{{M}}]+')) AS t FROM documents) WHERE length(t) >= 4), {_NEAR}
SELECT a, b FROM near WHERE a < b
"""


def _parts(name: str, rows: str, key: str) -> str:
    return f"""
{name}0 AS (SELECT {key}, {_sql('N8', 'name')} AS full_ FROM ({rows})), {name}1 AS (SELECT *, {_words('full_')} AS w FROM {name}0),
{name} AS (SELECT {key}, full_, w, {_pick(f"{{a}}[i] NOT IN {_LINKS} AND {{a}}[i] NOT IN {_KUNYAS} AND ({_AFTER_LINK} OR (NOT starts_with({{a}}[i], 'ال') AND NOT {_AFTER_KUNYA}))")} AS c,
  {_pick(f"starts_with({{a}}[i], 'ال') AND ends_with({{a}}[i], 'ي') AND NOT {_AFTER_LINK}")} AS s, {_pick(_AFTER_KUNYA)} AS k,
  CASE WHEN coalesce(list_position(list_transform(w, lambda x: x IN {_LINKS}), true), 0) > 1 AND w[list_position(list_transform(w, lambda x: x IN {_LINKS}), true) + 1] IN {_KUNYAS}
    THEN CASE WHEN w[list_position(list_transform(w, lambda x: x IN {_LINKS}), true) + 1] = 'ام' THEN 'ام ' ELSE 'ابو ' END || w[list_position(list_transform(w, lambda x: x IN {_LINKS}), true) + 2] END AS f FROM {name}1)"""


def _keys(name: str, key: str, fathers: str) -> str:
    varied = lambda n, i: "list_transform(list_distinct(list_concat([c[{i}]], {less})), lambda v: concat_ws(' ', {parts}, '#{k}'))".format(i=i, less=_less(f"c[{i}]"), k=i - 1, parts=", ".join("v" if j == i else f"c[{j}]" for j in range(1, n + 1)))
    some = lambda n, x: f"CASE WHEN len(c) >= {n} THEN {x} ELSE [] END"
    per = {
        1: "[full_]", 2: "[array_to_string(list_filter(string_split(full_, ' '), lambda x: NOT (starts_with(x, 'ال') AND ends_with(x, 'ي'))), ' ')]", 3: some(3, "[array_to_string(c[1:3], ' ')]"), 4: some(3, f"list_concat({varied(3, 2)}, {varied(3, 3)})"),
        5: some(2, "[array_to_string(c[1:2], ' ')]"), 6: some(2, varied(2, 2)), 7: some(1, f"list_transform({fathers}, lambda x: c[1] || '+' || x)"), 8: some(1, "list_transform(k, lambda x: c[1] || '+' || x)"), 9: some(1, "list_transform(s, lambda x: c[1] || '+' || x)"),
    }
    return f"SELECT DISTINCT * FROM ({' UNION ALL '.join(f'SELECT {key}, {stage} AS stage, unnest({x}) AS key FROM {name}' for stage, x in per.items())}) WHERE key <> ''"


def _cascade(queries: str, canon: str) -> str:
    """CTEs up to d, the stage that decides each query (rows: qid, name) among canonical names (rows: cid, name)."""
    return f"""
{_parts('q', queries, 'qid')}, {_parts('p', canon, 'cid')},
qk AS ({_keys('q', 'qid', "CASE WHEN f IS NULL THEN [] ELSE [string_split(f, ' ')[2]] END")}), pk AS ({_keys('p', 'cid', 'w')}),
m AS (SELECT DISTINCT qid, cid, stage FROM qk JOIN pk USING (stage, key)),
x AS (SELECT m.*, list_transform(range(2, greatest(least(len(q.c), 6), least(len(p.c), 6)) + 1), lambda i: coalesce(q.c[i] = p.c[i], false)) AS same, list_has_any(q.s, p.s) AS nisba, list_has_any(q.k, p.k) AS kunya, coalesce(q.f = p.f, false) AS own,
  coalesce(list_contains(p.w, string_split(q.f, ' ')[2]), false) AS there FROM m JOIN q USING (qid) JOIN p USING (cid)),
y AS (SELECT *, CASE WHEN stage = 7 THEN 4 + 2 * own::INT + (nisba OR kunya)::INT ELSE 4 * coalesce(nullif(list_position(same, false), 0) - 1, len(same)) + 3 * nisba::INT + 2 * kunya::INT + (own OR there)::INT END AS score FROM x),
t AS (SELECT qid, stage, min(cid) AS cid, count(*) AS n, max(score) AS score FROM (SELECT *, max(score) OVER (PARTITION BY qid, stage) AS top FROM y) WHERE score = top GROUP BY qid, stage),
d AS (SELECT * FROM t WHERE n = 1 OR stage <= 3 OR stage = 7 QUALIFY row_number() OVER (PARTITION BY qid ORDER BY stage) = 1)
"""


_DECIDED = "d.n = 1 AND (stage <> 7 OR score >= 5)"
ORACLE["rule_cascade"] = f"""
WITH {_cascade(_OPEN, 'SELECT ishabah_id AS cid, name_ar AS name FROM persons')}
SELECT q.qid, CASE WHEN {_DECIDED} THEN cid END AS cid, CAST(stage AS INTEGER) AS stage, CASE WHEN {_DECIDED} THEN 'resolved' WHEN q.qid IN (SELECT qid FROM t) THEN 'ambiguous' ELSE 'unresolved' END AS status
FROM (SELECT DISTINCT qid FROM q) q LEFT JOIN d USING (qid)
"""


def _profile(name: str, rows: str, key: str) -> str:
    """E18, in steps."""
    inner = f"NOT (given AND i = 1) AND NOT {_IS_LINK} AND {{a}}[i] NOT IN {_STOPS}"
    phrase = "CASE WHEN {a}[i - 1] = 'ام' THEN 'ام ' ELSE 'ابو ' END || {a}[i]"
    called = f"{_AFTER_KUNYA} AND NOT {_IS_LINK}"
    bare = "CASE WHEN starts_with(z, 'ال') AND length(z) > 3 THEN substr(z, 3) ELSE z END"
    return f"""
{name}0 AS (SELECT {key}, regexp_replace(regexp_replace(' ' || {_sql('N8', 'name')} || ' ', ' ({_TITLES}) ', ' ', 'g'), '^ | $', '', 'g') AS f1, {_sql('N8', 'kunya')} AS f2 FROM ({rows})),
{name}1 AS (SELECT {key}, {_words('f1')} AS w, {_words('f2')} AS x FROM {name}0),
{name}2 AS (SELECT *, coalesce(w[2] IN {_LINKS} AND (w[1] IN {_KUNYAS} OR (starts_with(w[1], 'ال') AND length(w[1]) > 3 AND NOT ends_with(w[1], 'ي'))), false) AS given FROM {name}1),
{name}3 AS (SELECT {key}, given, coalesce(w[1] IN {_KUNYAS} AND NOT given AND len(w) > 1, false) AS titled, list_transform(list_concat(CASE WHEN given THEN [w[1]] ELSE [] END, {_pick(f"{inner} AND {{a}}[i] NOT IN {_KUNYAS} AND ({_AFTER_LINK} OR (NOT starts_with({{a}}[i], 'ال') AND NOT {_AFTER_KUNYA}))")}), lambda z: {bare}) AS chain,
  list_distinct(list_concat({_pick(called)}, {_pick(called, 'x')})) AS called, list_distinct(list_concat({_pick(called, take=phrase)}, {_pick(called, 'x', phrase)})) AS kunyas,
  {_pick(f"{inner} AND NOT {_AFTER_LINK} AND starts_with({{a}}[i], 'ال') AND length({{a}}[i]) > 3")} AS named, {_pick(f"{inner} AND {{a}}[i] NOT IN {_KUNYAS}")} AS all_, {_pick(called, take=phrase)}[1] AS head_ FROM {name}2),
{name} AS (SELECT {key}, chain, coalesce(chain[1], CASE WHEN NOT titled THEN all_[1] END) AS first_, list_concat(named, called) AS other, list_filter(named, lambda z: NOT ends_with(z, 'ي')) AS epithets, list_distinct(list_concat(all_, chain, called)) AS any_, kunyas,
  CASE WHEN titled THEN head_ END AS head, titled OR coalesce(chain[1], CASE WHEN NOT titled THEN all_[1] END) IS NULL OR starts_with(coalesce(chain[1], all_[1]), 'ال') AS free FROM {name}3)"""


_HEADS = _SLICE_SQL.replace("SELECT DISTINCT seg_id, source", "SELECT ishabah_id AS seg_id, 'kamus_asl' AS source").replace("FROM event_segments WHERE", "FROM persons WHERE").replace("SELECT DISTINCT para_id, source", "SELECT DISTINCT source").replace(", printed_juz, printed_page, url, text FROM pages", ", text FROM pages")
_ENTRY_HEADS = _SLICE_SQL.replace("SELECT DISTINCT seg_id, source", "SELECT DISTINCT entry_id AS seg_id, source").replace("FROM event_segments WHERE", "FROM person_entries WHERE (link_status IS NULL OR link_status <> 'canonical') AND").replace("SELECT DISTINCT para_id, source", "SELECT DISTINCT source").replace(", printed_juz, printed_page, url, text FROM pages", ", text FROM pages")
ORACLE["kunya_titles"] = rf"""
WITH hd AS (WITH {_ENTRY_HEADS}, b AS (SELECT *, {_T_SQL} AS t FROM r), h AS (SELECT seg_id, rel_idx, text, {_HEADING_SQL} AS head FROM b), k AS (SELECT *, max(CASE WHEN head AND rel_idx > 0 THEN 1 ELSE 0 END) OVER (PARTITION BY seg_id ORDER BY rel_idx) AS stop FROM h)
  SELECT seg_id AS qid, string_agg(text, chr(10) ORDER BY rel_idx) AS head_text FROM k WHERE stop = 0 AND rel_idx < 6 GROUP BY seg_id),
tt AS (SELECT o.qid, name AS title, concat_ws(' ', name, head_text) AS body FROM ({_OPEN}) o LEFT JOIN hd USING (qid) WHERE regexp_matches({_sql('N8', 'name')}, '^(ابو|ابي|ابا|ام) ')),
gv AS (SELECT qid, nullif(trim(regexp_extract({_sql('N8', 'body')}, '(?:^|\s)و?اسمه[ا]?\s+((?:\S+\s*){{1,8}})', 1)), '') AS name FROM tt),
{_cascade("SELECT qid, name FROM gv WHERE name IS NOT NULL", "SELECT ishabah_id AS cid, concat_ws(' ', kunya, name_ar) AS name FROM persons")},
{_parts('z', 'SELECT qid, title AS name FROM tt', 'qid')},
bk AS (SELECT qid, min(cid) AS cid FROM (SELECT qid, s AS zs, unnest(k) AS kk FROM z) JOIN (SELECT cid, s AS ps, unnest(k) AS kk FROM p) USING (kk) WHERE len(zs) = 0 OR list_has_any(zs, ps) GROUP BY qid HAVING count(DISTINCT cid) = 1)
SELECT tt.qid, coalesce(n.cid, bk.cid) AS cid, CASE WHEN n.cid IS NOT NULL THEN 'name in text' WHEN bk.cid IS NOT NULL THEN 'kunya' ELSE 'unresolved' END AS how FROM (SELECT DISTINCT qid FROM tt) tt LEFT JOIN (SELECT qid, cid FROM d WHERE {_DECIDED}) n USING (qid) LEFT JOIN bk USING (qid)
"""
_PLACES = "list_filter(range(2, len(chain) + 1), lambda i: chain[i] = t)"
ORACLE["candidate_topk"] = f"""
WITH hd AS (WITH {_HEADS}, b AS (SELECT *, {_T_SQL} AS t FROM r), h AS (SELECT seg_id, rel_idx, text, {_HEADING_SQL} AS head FROM b), k AS (SELECT *, max(CASE WHEN head AND rel_idx > 0 THEN 1 ELSE 0 END) OVER (PARTITION BY seg_id ORDER BY rel_idx) AS stop FROM h)
  SELECT seg_id AS cid, string_agg(text, chr(10) ORDER BY rel_idx) AS head_text FROM k WHERE stop = 0 AND rel_idx < 6 GROUP BY seg_id),
an AS (SELECT ishabah_id AS cid, {_sql('N8', 'name_ar')} AS own, {_sql('N8', 'head_text')} AS h FROM persons LEFT JOIN hd ON cid = ishabah_id),
al AS (SELECT t.cid, min(m.cid) AS main FROM an t JOIN an m ON t.cid <> m.cid AND m.own <> t.own AND regexp_matches(t.own, '^(ابو|ابي|ابا|ام) ') AND contains(' ' || m.h || ' ', ' ' || t.own || ' ') GROUP BY t.cid HAVING count(DISTINCT m.cid) = 1),
{_profile('q', _OPEN.replace('name_ar AS name', 'name_ar AS name, CAST(NULL AS VARCHAR) AS kunya'), 'qid')}, {_profile('p', 'SELECT ishabah_id AS cid, name_ar AS name, kunya FROM persons', 'cid')},
qt AS (SELECT *, unnest(list_distinct(list_filter(list_concat([first_], chain, other), lambda z: z <> ''))) AS t FROM q),
qw AS (SELECT qid, free AS qfree, t, coalesce(t = first_, false) AS qfirst, {_PLACES} AS qat, CASE WHEN list_contains(other, t) THEN 2 WHEN len({_PLACES}) > 0 THEN 1 ELSE 0 END AS kind, list_contains(epithets, t) AS qep FROM qt),
pt AS (SELECT *, unnest(any_) AS t FROM p), rr AS (SELECT t FROM (SELECT unnest(list_distinct(epithets)) AS t FROM p) GROUP BY t HAVING count(*) <= 10),
p4 AS (SELECT cid, cid AS via, free AS pfree, t, coalesce(t = first_, false) AS pfirst, {_PLACES} AS pat, list_contains(epithets, t) AND t IN (SELECT t FROM rr) AS pep FROM pt),
pw AS (SELECT * FROM p4 UNION ALL SELECT al.main, p4.via, p.free, p4.t, pfirst, pat, pep FROM p4 JOIN al ON al.cid = p4.via JOIN p ON p.cid = al.main),
tk AS (SELECT t FROM qw UNION SELECT t FROM pw), {_NEAR},
wd AS (SELECT qid, cid, via, qw.t AS qt, max(qfirst AND pfirst) AS first, max(kind) AS kind, max(qep AND qw.t = pw.t AND pep) AS epithet, max(qfree OR pfree) AS free, sum(len(list_intersect(qat, pat))) AS placed
  FROM qw JOIN near ON near.a = qw.t JOIN pw ON pw.t = near.b GROUP BY qid, cid, via, qw.t),
sc AS (SELECT qid, cid, CAST(sum(3 * first::INT + 2 * placed + (kind = 2 OR (kind = 1 AND placed = 0))::INT + 2 * epithet::INT) AS INTEGER) AS score, max(free OR (first AND via = cid)) AS gate FROM wd GROUP BY qid, cid),
sh AS (SELECT DISTINCT qid, cid FROM (SELECT qid, head FROM q WHERE head IS NOT NULL) JOIN (SELECT cid, unnest(kunyas) AS head FROM p) USING (head)),
s1 AS (SELECT sc.*, sh.cid IS NOT NULL AS force FROM sc LEFT JOIN sh ON sh.qid = sc.qid AND sh.cid = sc.cid WHERE score > 0),
s2 AS (SELECT *, row_number() OVER (PARTITION BY qid, force ORDER BY score DESC, cid) AS n FROM s1),
s3 AS (SELECT *, CASE WHEN force AND n <= 4 THEN 1 WHEN gate THEN 2 ELSE 3 END AS bucket FROM s2),
s4 AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY bucket, score DESC, cid) AS rank FROM s3)
SELECT qid, cid, score, CAST(rank AS INTEGER) AS rank, ['kunya', 'gated', 'fill'][bucket] AS how FROM s4 WHERE rank <= 8
UNION ALL SELECT DISTINCT qid, NULL, NULL, NULL, 'none' FROM q WHERE qid NOT IN (SELECT qid FROM s4)
"""

ORACLE["align_monotone"] = rf"""
WITH RECURSIVE g AS (SELECT source, surah, from_page, coalesce(from_para, 0) AS fp, seg_id, CASE WHEN regexp_matches(label, '^~?\d+(-\d+)?$') THEN CAST(regexp_extract(label, '^~?(\d+)', 1) AS INTEGER) END AS lo,
  CASE WHEN regexp_matches(label, '^~?\d+(-\d+)?$') THEN CAST(coalesce(nullif(regexp_extract(label, '-(\d+)$', 1), ''), regexp_extract(label, '^~?(\d+)', 1)) AS INTEGER) END AS hi FROM {_SEG} WHERE from_page IS NOT NULL AND surah IS NOT NULL),
h AS (SELECT source, surah, row_number() OVER (PARTITION BY source, surah ORDER BY from_page, fp, seg_id) - 1 AS pos, lo, hi FROM g),
e AS (SELECT source, surah, pos, ayah, max(s) AS s FROM (SELECT source, surah, pos, lo AS ayah, 100 AS s FROM h WHERE lo <= hi UNION ALL SELECT source, surah, pos, hi, 60 FROM h WHERE lo <= hi) GROUP BY ALL),
v AS (SELECT source, surah, list_sort(list(DISTINCT ayah)) AS vs FROM e GROUP BY ALL), n AS (SELECT source, surah, max(pos) + 1 AS n FROM h GROUP BY ALL),
sc AS (SELECT h.source, h.surah, h.pos, list_filter(list({{'a': ayah, 's': s}}), lambda x: x.a IS NOT NULL) AS sc FROM h LEFT JOIN e ON e.source = h.source AND e.surah = h.surah AND e.pos = h.pos GROUP BY ALL),
w AS (SELECT n.source, n.surah, CAST(0 AS BIGINT) AS k, coalesce(vs, []) AS vs, list_concat([CAST(0 AS BIGINT)], list_transform(coalesce(vs, []), lambda x: CAST(-1000000000 AS BIGINT))) AS top, CAST([] AS BIGINT[][]) AS trace FROM n LEFT JOIN v ON v.source = n.source AND v.surah = n.surah
  UNION ALL SELECT source, surah, k, vs, list_transform(range(1, len(top) + 1), lambda i: greatest(top[i], coalesce(list_max(top[1:i]) + list_filter(sc, lambda x: x.a = vs[i - 1])[1].s, top[i]))),
    list_append(trace, list_transform(range(1, len(top) + 1), lambda i: CASE WHEN list_max(top[1:i]) + list_filter(sc, lambda x: x.a = vs[i - 1])[1].s > top[i] THEN CAST(list_position(top, list_max(top[1:i])) AS BIGINT) END)) FROM (
    SELECT w.source, w.surah, w.k + 1 AS k, vs, top, trace, sc.sc FROM w JOIN sc ON sc.source = w.source AND sc.surah = w.surah AND sc.pos = w.k)),
f AS (SELECT w.* FROM w JOIN n ON n.source = w.source AND n.surah = w.surah AND n.n = w.k),
b AS (SELECT source, surah, k, vs, trace, CAST(list_position(top, list_max(top)) AS BIGINT) AS ix, CAST(NULL AS INTEGER) AS ayah FROM f
  UNION ALL SELECT source, surah, k - 1, vs, trace, coalesce(trace[k][ix], ix), CASE WHEN trace[k][ix] IS NOT NULL THEN vs[ix - 1] END FROM b WHERE k > 0)
SELECT b.source, b.surah, CAST(b.k AS INTEGER) AS pos, b.ayah FROM b JOIN n ON n.source = b.source AND n.surah = b.surah WHERE b.k < n.n
"""

_NAMES = EVENT_QUERIES + [(11, "عبد"), (12, "بن"), (13, "أبو"), (14, "بنت"), (15, "بنت عبد"), (16, "بن أبو"), (17, "سنة"), (18, "هجرة سنة")]
_TOKENS = lambda c: rf"coalesce(regexp_extract_all({_sql('N1', c)}, '[\p{{L}}\p{{N}}_]+'), [])"
ORACLE["name_search"] = rf"""
WITH {_REG.split('q AS (SELECT')[0]} q AS (SELECT CAST(qid AS INTEGER) AS qid, {_sql('N2', 'query')} AS key, lower(trim(query)) AS low, list_distinct({_TOKENS('query')}) AS words FROM (VALUES {', '.join(f"({a}, '{b}')" for a, b in _NAMES)}) AS v(qid, query) WHERE trim(query) <> ''),
x AS (SELECT qid, event_id, seq, {_TIER('name_norm', 'key')} AS name_tier, greatest({_TIER('name_norm', 'key')}, coalesce(list_max(list_transform(aliases, lambda a: {_TIER('a', 'key')})), 0), {_TIER('lower(name_id)', 'low')}) AS score,
  len(words) > 0 AND list_has_all({_TOKENS("concat_ws(' ', name_norm, array_to_string(aliases, ' '))")}, words) AS every_, regexp_matches(event_id, '^tahun_.*_h$') AND NOT (regexp_matches(key, '^\p{{Nd}}+$') OR contains(key, 'سنه') OR contains(low, 'tahun')) AS hide FROM r CROSS JOIN q),
ev AS (SELECT * FROM x WHERE score > 0 OR every_),
e AS (SELECT DISTINCT entry_id, ishabah_id AS person, source, entry_num, name_ar, {_sql('N2', 'name_ar')} AS name, {_TOKENS('name_ar')} AS hay FROM person_entries), p AS (SELECT ishabah_id AS person, {_sql('N2', 'name_ar')} AS name FROM persons),
hit AS (SELECT qid, person FROM e JOIN q ON (key <> '' AND contains(name, key)) OR (len(words) > 0 AND list_has_all(hay, words)) WHERE person IS NOT NULL UNION SELECT qid, person FROM p JOIN q ON key <> '' AND contains(name, key)),
nm AS (SELECT person, source, name FROM e WHERE person IS NOT NULL UNION ALL SELECT person, NULL, name FROM p),
ps AS (SELECT qid, person, max({_TIER('nm.name', 'key')}) AS score, count(DISTINCT source) AS n_sources FROM hit JOIN nm USING (person) JOIN q USING (qid) GROUP BY qid, person),
un AS (SELECT qid, source, entry_num, name_ar, min(entry_id) AS entry_id FROM e JOIN q ON (len(words) > 0 AND list_has_all(hay, words)) OR (len(words) = 0 AND key <> '' AND contains(name, key)) WHERE person IS NULL GROUP BY ALL)
SELECT qid, 'event' AS kind, event_id AS id, CAST(score AS INTEGER) AS score, CAST(row_number() OVER (PARTITION BY qid ORDER BY score DESC, name_tier DESC, seq, event_id) AS INTEGER) AS rank, greatest(count(*) OVER (PARTITION BY qid) - 15, 0) AS n_more FROM ev WHERE NOT hide QUALIFY rank <= 15
UNION ALL SELECT qid, 'hidden', NULL, NULL, 1, count(*) FROM ev WHERE hide GROUP BY qid
UNION ALL (SELECT qid, 'person', CAST(person AS VARCHAR), CAST(score AS INTEGER), CAST(row_number() OVER (PARTITION BY qid ORDER BY score DESC, n_sources DESC, person) AS INTEGER) AS rank, greatest(count(*) OVER (PARTITION BY qid) - 15, 0) FROM ps QUALIFY rank <= 15)
UNION ALL (SELECT qid, 'unlinked', CAST(entry_id AS VARCHAR), NULL, CAST(row_number() OVER (PARTITION BY qid ORDER BY source, entry_num NULLS FIRST, entry_id) AS INTEGER) AS rank, greatest(count(*) OVER (PARTITION BY qid) - 20, 0) FROM un QUALIFY rank <= 20)
"""

_KIN = "('امه', 'امها', 'امهما', 'زوجه', 'زوجها', 'اخته', 'اختهما', 'اخوه', 'ابوه', 'ابنته', 'بنته', 'امهاتهم', 'امهاتهن')"
_BARE_T = lambda t: f"CASE WHEN starts_with({t}, 'ال') AND length({t}) > 3 THEN substr({t}, 3) ELSE {t} END"
_AL = lambda t: f"(starts_with({t}, 'ال') AND length({t}) > 3)"
ORACLE["name_structures"] = rf"""
WITH a AS (SELECT DISTINCT entry_id, name_ar, kunya FROM person_entries),
b AS (SELECT entry_id, name_ar || CASE entry_id % 4 WHEN 1 THEN '، ' || coalesce(kunya, '') WHEN 2 THEN ' - أمه ' || name_ar WHEN 3 THEN '؛ ابن ' || name_ar ELSE '' END AS name FROM a),
c AS (SELECT entry_id, list_filter(regexp_split_to_array(name, '[،؛]|\s[-–—]+\s'), lambda x: trim(x) <> '') AS cl FROM b), d AS (SELECT entry_id, unnest(range(len(cl))) AS ci, unnest(cl) AS clause FROM c),
e AS (SELECT entry_id, ci, regexp_replace(regexp_replace(' ' || {_sql('N8', 'clause')} || ' ', ' ({_TITLES}) ', ' ', 'g'), '^ | $', '', 'g') AS own FROM d),
f AS (SELECT *, list_filter(string_split(own, ' '), lambda x: x <> '' AND x NOT IN {_STOPS}) AS t FROM e),
g AS (SELECT *, ci > 0 AND t[1] IN ('بن', 'ابن', 'ب') AND len(t) > 1 AS goes_on FROM f WHERE len(t) > 0 AND NOT (ci > 0 AND (t[1] IN {_KIN} OR (t[1] = 'ابن' AND len(t) = 1)))),
h AS (SELECT entry_id, ci, own, ci = 0 OR goes_on AS mine, list_filter(list_transform(string_split(array_to_string(list_transform(CASE WHEN goes_on THEN t[2:] ELSE t END, lambda x: CASE WHEN x IN {_LINKS} THEN '|' ELSE x END), ' '), '|'), lambda x: trim(x)), lambda x: x <> '') AS parts FROM g),
i AS (SELECT entry_id, ci, mine, len(parts) AS n, unnest(range(len(parts))) AS i, string_split(unnest(parts), ' ') AS t FROM h),
j AS (SELECT *, coalesce(list_position(list_transform(t, lambda x: x IN {_KUNYAS}), true), 0) AS k FROM i),
l AS (SELECT *, CASE WHEN k > 0 THEN t[1:k - 1] ELSE t END AS np, k = 0 AND i = n - 1 AS last, CASE WHEN k > 0 THEN t[k + 1:] ELSE [] END AS after FROM j),
m AS (SELECT *, coalesce(starts_with(np[1], 'عبد'), false) AS whole, list_transform(range(1, len(np) + 1), lambda x: {_AL('np[x]')} AND (ends_with({_BARE_T('np[x]')}, 'ي') OR (last AND x > 1))) AS out_, list_transform(after, lambda x: {_AL('x')}) AS stops FROM l),
o AS (SELECT *, nullif(array_to_string(CASE WHEN whole THEN np ELSE list_transform(list_filter(range(1, len(np) + 1), lambda x: NOT out_[x]), lambda x: {_BARE_T('np[x]')}) END, ' '), '') AS link,
  list_concat(CASE WHEN whole THEN [] ELSE list_transform(list_filter(range(1, len(np) + 1), lambda x: out_[x]), lambda x: np[x]) END, list_filter(after, lambda x: {_AL('x')})) AS apart,
  CASE WHEN k > 0 THEN concat_ws(' ', CASE WHEN t[k] = 'ام' THEN 'ام' ELSE 'ابو' END, nullif(array_to_string(after[1:least(coalesce(nullif(list_position(stops, true), 0) - 1, len(after)), CASE WHEN t[k] = 'ام' THEN 2 ELSE 3 END)], ' '), '')) END AS phrase, k = 1 AND i = 0 AS leads FROM m),
q AS (SELECT entry_id, string_agg(link, '|' ORDER BY ci, i) FILTER (WHERE mine AND link IS NOT NULL) AS chain, string_agg(DISTINCT phrase, '|' ORDER BY phrase) FILTER (WHERE NOT leads) AS kunyas, arg_min(phrase, ci * 1000 + i) FILTER (WHERE mine AND k = 1 AND i = 1) AS father_kunya,
  arg_max(phrase, ci * 1000 + i) FILTER (WHERE mine AND leads) AS head, bool_or(mine AND leads) AS titled, array_to_string(list_sort(list_distinct(flatten(list(apart)))), '|') AS nisbas FROM o GROUP BY entry_id),
z AS (SELECT entry_id, string_agg(own, ' ' ORDER BY ci) AS norm FROM h GROUP BY entry_id)
SELECT b.entry_id, coalesce(chain, '') AS chain, coalesce(kunyas, '') AS kunyas, father_kunya, coalesce(nisbas, '') AS nisbas, coalesce(titled, false) AS titled, head, coalesce(norm, '') AS norm FROM b LEFT JOIN q USING (entry_id) LEFT JOIN z USING (entry_id)
"""
ORACLE["body_chains"] = rf"""
WITH p AS (SELECT DISTINCT para_id, text FROM pages WHERE text IS NOT NULL), a AS (SELECT para_id, array_to_string(list_transform(list_filter(string_split({_sql('N8', 'text')}, ' '), lambda x: x <> '' AND x NOT IN {_STOPS}), lambda x: CASE WHEN x IN ('بن', 'ابن', 'بنت', 'ابنه', 'مولي') THEN '|' ELSE x END), ' ') AS m FROM p),
b AS (SELECT para_id, regexp_split_to_array(m, '\|(?: \|)+') AS runs FROM a), r AS (SELECT para_id, unnest(range(len(runs))) AS i, unnest(runs) AS run FROM b),
c AS (SELECT para_id, i, list_filter(list_transform(string_split(run, '|'), lambda x: trim(x)), lambda x: x <> '') AS parts FROM r),
d AS (SELECT para_id, i, list_filter(list_transform(parts, lambda s: CASE WHEN starts_with(s, 'عبد') THEN s ELSE array_to_string(list_transform(list_filter(string_split(s, ' '), lambda t: NOT ({_AL('t')} AND ends_with({_BARE_T('t')}, 'ي'))), lambda t: {_BARE_T('t')}), ' ') END), lambda s: s <> '')[1:6] AS flat FROM c WHERE len(parts) >= 2),
e AS (SELECT para_id, i, flat, count(*) OVER (PARTITION BY para_id) AS n FROM d WHERE len(flat) >= 2)
SELECT para_id, CAST(n AS INTEGER) AS n_chains, CAST(len(flat) AS INTEGER) AS n_names, md5(array_to_string(flat, '|')) AS digest FROM e QUALIFY row_number() OVER (PARTITION BY para_id ORDER BY len(flat) DESC, i) = 1
"""
