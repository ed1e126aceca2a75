"""Core operators: edge cases on small tables, and those without a SQL twin against plain Python."""

import itertools
import json
import random

from pyspark.sql import functions as F

from warraq.functions import normalise as N
from warraq.functions import paragraphs as P
from warraq.operators import alignment, entities, labels, resolution, search, slicing
from warraq.sources import pages, sinks
from warraq.streaming.ingest import ingest


def col(spark, values, f):
    return [r[0] for r in spark.createDataFrame([(v,) for v in values], "t string").select(f(F.col("t"))).collect()]


def test_profiles_disagree_where_they_should(spark):
    text = ["قَالَ رَسُولُ  اللَّهِ ٱلْمَدِينَةُ إلى ١٢", None, ""]
    assert col(spark, text, N.search_key) == ["قال رسول الله المدينه الي ١٢", None, ""]
    assert col(spark, text, N.name_column)[0] == "قال رسول الله ٱلمدينه الي ١٢"
    assert col(spark, text, N.verse_key)[0] == "قال رسول الله ٱلمدينت الي ١٢"
    assert col(spark, text, N.heading_text)[0].endswith(" إلى 12")
    assert col(spark, ["عبدالله بن ﺃحمد رضي الله عنه 5"], N.person_key) == ["عبد الله بن حمد"]
    assert col(spark, ["Sunan  Abī-Dāwud ٣"], N.alias_key) == ["sunanabīdāwud3"]
    assert col(spark, ["ﷺ سُورَةُ الفَاتِحَةِ!"], N.title_words) == [["سوره", "الفاتحه"]]
    assert col(spark, ["Nu’mān"], N.canonical_name) == ["nu'mān"]


def test_paragraph_kinds(spark):
    assert col(spark, ["(باب في الماء)", "ذكر الخبر", "قال " * 40, "", None], P.is_heading) == [True, True, False, False, None]
    assert col(spark, ["* القول في كذا", "[تفسير]", "Tafsir ayat", "قال"], P.is_sub_heading) == [True, True, True, False]
    assert col(spark, ["(1) x", "[2] x", "(3] x", "1) x"], P.is_footnote) == [True, True, False, False]
    assert col(spark, ["٤٨٣٥ - عبد الله", "(7) زيد", "زيد"], P.entry_number) == [4835, 7, None]
    assert col(spark, ["زيد بن عمرو بن خالد القرشي", "زيد بن عمرو", "قال زيد"], P.is_genealogy) == [True, False, False]
    assert col(spark, ["ثم دخلت سنة", "سنة إحدى عشرة", "سنة ست وثلاثين", "السنة الثالثة من الهجرة", "سنة خمسين"], P.year_of_title) == [None, 11, 36, 3, None]


PARAS = "source string, web_page int, para_idx int, para_id bigint, text string, printed_juz int, printed_page int, url string, rel_idx int"


def paras(spark):
    rows = [("s", p, i, p * 10 + i, "  " if (p, i) == (2, 1) else f"p{p}i{i}", None, p, "u", 9) for p in (1, 2, 3) for i in range(4)]
    return spark.createDataFrame(rows, PARAS).drop("rel_idx")


def test_slices(spark):
    segs = spark.createDataFrame(
        [(1, "s", 1, 2, 3, 0), (2, "s", 2, 1, 2, 3), (3, "s", 3, 2, 1, 0), (4, "s", None, 0, 2, 0), (5, "s", -9, None, 2_000_000_000, None), (6, "t", 1, 0, 2, 0), (7, "s", 8, 0, 9, 0)],
        "seg_id int, source string, from_page int, from_para int, to_page int, to_para int",
    )
    got = {}
    for r in slicing.slice_intervals(segs, paras(spark)).orderBy("seg_id", "rel_idx").collect():
        got.setdefault(r.seg_id, []).append((r.rel_idx, r.text, r.is_page_break))
    assert got[1] == [(0, "p1i2", True), (1, "p1i3", False), (2, "p2i0", True), (3, "p2i2", False), (4, "p2i3", False), (5, "p3i0", True)]
    assert [t for _, t, _ in got[2]] == ["p2i2", "p2i3"]
    assert len(got[5]) == 11 and set(got) == {1, 2, 5}
    assert slicing.slice_intervals(segs.limit(0), paras(spark)).count() == 0
    assert slicing.slice_intervals(segs, paras(spark).limit(0)).count() == 0


def test_budget_keeps_at_least_one(spark):
    df = spark.createDataFrame([(1, 1, 50), (1, 2, 5), (2, 1, 4), (2, 2, 4), (2, 3, 4)], "k int, i int, n int")
    kept = lambda b: {(r.k, r.i) for r in slicing.within_budget(df, ["k"], ["i"], F.col("n"), b).collect()}
    assert kept(8) == {(1, 1), (2, 1), (2, 2)}
    assert len(kept(0)) == 5
    pages_ = {r.k: (r.n_shown, r.used, r.next_offset, r.n_total) for r in slicing.budget_pages(df, ["k"], ["i"], F.col("n"), 8).collect()}
    assert pages_ == {1: (1, 50, 1, 2), 2: (2, 8, 2, 3)}
    later = {r.k: (r.n_shown, r.next_offset) for r in slicing.budget_pages(df, ["k"], ["i"], F.col("n"), 8, offset=2).collect()}
    assert later == {2: (1, None)}


def test_verse_flags_follow_the_sequential_rule(spark):
    rng = random.Random(2)
    kinds = ["x ... y", "short", "w" * 80, "ذكر خبر", "a … b", ""]
    texts = [rng.choice(kinds) for _ in range(300)]
    want = []
    for i, t in enumerate(texts):
        core = " ... " in t or " … " in t
        want.append(core or (i > 0 and want[-1] and len(t.strip()) <= 70 and t != "ذكر خبر"))
    df = spark.createDataFrame([("k", i, t) for i, t in enumerate(texts)], "k string, i int, text string")
    got = [r.is_verse for r in slicing.verse_flags(df, ["k"], ["i"]).orderBy("i").collect()]
    assert got == want


def test_labels(spark):
    df = spark.createDataFrame([(1, "s", 2, "3"), (2, "s", 2, "7-9"), (3, "s", 2, "5-2"), (4, "s", 2, "intro"), (5, "s", 2, None), (6, "s", 2, "~11-12"), (7, "s", 2, "1,4")], "seg_id int, source string, surah int, label string")
    got = sorted((r.seg_id, r.ayah) for r in labels.verse_map(df).collect())
    assert got == [(1, 3), (2, 7), (2, 8), (2, 9), (6, 11), (6, 12), (7, 1), (7, 4)]
    spans = spark.createDataFrame([("b", 1, 1, 1), ("b", 2, 3, 3), ("b", 3, 5, 7), ("b", 4, 6, 6)], "k string, o int, lo int, hi int")
    assert [r.new_hi for r in labels.extend_labels(spans, ["k"], ["o"], "lo", "hi", F.lit(12)).orderBy("o").collect()] == [2, 4, 7, 12]
    assert [(r.lo, r.hi) for r in labels.merge_labels(spans, ["k"], ["o"], "lo", "hi").orderBy("lo").collect()] == [(1, 1), (3, 3), (5, 7)]


def test_inclusive_positions(spark):
    n = spark.createDataFrame([("s", 2, 4)], "source string, web_page int, n int")
    df = spark.createDataFrame([("s", 1, None, 2, 3), ("s", 1, 2, 2, None), ("s", 1, 0, 9, None)], "source string, start_page int, para_start int, last_page int, para_end int")
    got = [(r.from_para, r.to_para) for r in slicing.inclusive(df, n).orderBy("last_page", F.col("para_start")).collect()]
    assert got == [(0, 2), (2, 3), (0, None)]


def test_search_edges(spark):
    docs = spark.createDataFrame([(1, "قال حدثنا زيد"), (2, "حدثنا قال"), (3, None), (4, ""), (5, "قال حدثنا قال حدثنا")], "id int, t string")
    p = search.index(docs, F.col("id"), F.col("t"))
    q = search.query_terms(spark.createDataFrame([(1, "قَالَ حدثنا"), (2, ""), (3, "غيب"), (4, "زيد قال")], "qid int, query string"))
    assert {(r.qid, r.id, r.tf) for r in search.phrase_hits(p, q).collect()} == {(1, 1, 1), (1, 5, 2)}
    assert {(r.qid, r.id, r.match_mode) for r in search.ladder(p, q).collect()} == {(1, 1, "phrase"), (1, 5, "phrase"), (4, 1, "all")}
    assert search.ranked(p.limit(0), q, 3).count() == 0
    snip = docs.withColumn("q", F.lit("زيد")).select(search.snippet("t", "q").alias("s")).collect()
    assert [r.s for r in snip][:3] == ["قال حدثنا زيد", "حدثنا قال", None]


def test_references(spark):
    spans = resolution.parse_references(spark.createDataFrame([("a", "b k:4,9-11"), ("b", "m:2/7"), ("c", "x"), ("d", None), ("e", "m:9-2,1-5000")], "qid string, ref string"))
    assert {(r.qid, r.book, r.sub, r.lo, r.hi, r.status) for r in spans.collect()} == {("a", "b k", None, 4, 4, "ok"), ("a", "b k", None, 9, 11, "ok"), ("b", "m", 2, 7, 7, "ok"), ("c", "", None, None, None, "malformed"), ("e", "m", None, 9, 2, "reversed"), ("e", "m", None, 1, 5000, "too wide")}
    rows = spark.createDataFrame([(1, "b", 1, None, None), (2, "b", 3, 5, None), (3, "b", None, None, "٨ مكرر"), (4, "b", None, None, "18")], "row_id int, book string, num bigint, num_to bigint, num_label string")
    asked = spark.createDataFrame([("q", "b", 3, 4), ("q", "b", 8, 9), ("q", "b", 5, 1)], "qid string, book string, lo bigint, hi bigint")
    assert {(r.num, r.row_id, r.status) for r in resolution.look_up_numbers(asked, rows).collect()} == {(3, 2, "found"), (4, 2, "found"), (8, 3, "by label"), (9, None, "missing")}


def test_overlay_and_neighbours(spark):
    base = spark.createDataFrame([("k", 1, "b1"), ("k", 2, "b2"), (None, 1, "n")], "key string, at int, v string")
    over = spark.createDataFrame([("k", 1, "o1"), ("k", 2, "o2")], "key string, at int, v string")
    assert {r.v for r in resolution.overlay(base, over, ["key"], "at").collect()} == {"o2", "n"}
    assert {r.v for r in resolution.overlay(base, over.limit(0), ["key"], "at").collect()} == {"b1", "n"}
    e = spark.createDataFrame([("a", "b"), ("b", "a"), ("a", "a"), ("a", None)], "x string, y string")
    assert {tuple(r) for r in resolution.both_ways(e, "x", "y").collect()} == {("a", "b"), ("b", "a")}


def test_broken_aliases(spark):
    assert col(spark, ['["a","b"]', "[", None, ""], resolution.aliases_of) == [["a", "b"], [], [], []]


def brute_alignment(heads, verses, score):
    best = None
    for choice in itertools.product([None, *verses], repeat=heads):
        taken = [c for c in choice if c is not None]
        if taken == sorted(taken) and all(c is None or score.get((h, c), 0) > 0 for h, c in enumerate(choice)):
            total = sum(score[(h, c)] for h, c in enumerate(choice) if c is not None)
            best = total if best is None else max(best, total)
    return best


def test_alignment_is_optimal(spark):
    rng = random.Random(4)
    heads, scores, want = [], [], {}
    for g in range(25):
        n = rng.randrange(1, 6)
        table = {(h, a): rng.choice([30, 40, 60, 100]) for h in range(n) for a in range(1, 5) if rng.random() < 0.5}
        heads += [(g, h) for h in range(n)]
        scores += [(g, h, a, s) for (h, a), s in table.items()]
        want[g] = (brute_alignment(n, range(1, 5), table), table)
    h = spark.createDataFrame(heads, "g int, pos int")
    s = spark.createDataFrame(scores, "g int, pos int, ayah int, score int")
    got = {}
    for r in alignment.align(s, h, ["g"]).orderBy("g", "pos").collect():
        got.setdefault(r.g, []).append((r.pos, r.ayah))
    for g, (best, table) in want.items():
        taken = [a for _, a in got[g] if a is not None]
        assert taken == sorted(taken)
        assert sum(table[(p, a)] for p, a in got[g] if a is not None) == best


def test_chain_greedy_and_pairs(spark):
    c = spark.createDataFrame([("k", 0, 1, 3), ("k", 1, 9, 9), ("k", 2, 4, 6), ("k", 3, 7, 8), ("n", 0, None, 2)], "k string, pos int, lo int, hi int")
    assert [(r.lo, r.hi) for r in alignment.best_chain(c, ["k"]).orderBy("pos").collect()] == [(1, 3), (9, 9)]
    rows = spark.createDataFrame([("b", 1, 5, 9), ("b", 2, 1, 10), ("b", 3, 2, 10), ("b", 4, 2, 11), ("b", 5, None, 12), ("b", 6, 4, 13)], "k string, o int, num int, page int")
    got = alignment.increasing(rows, ["k"], ["o"], "num", "page").orderBy("o").collect()
    assert [r.accepted for r in got] == [False, True, False, True, False, True]
    left = spark.createDataFrame([(1, "a"), (2, "a"), (None, "a"), (3, None), (7, "z")], "num int, key string")
    right = spark.createDataFrame([(2, "a"), (3, "a"), (20, "z")], "num int, key string")
    assert {(r.num_left, r.num_right) for r in alignment.pair_editions(left, right).collect()} == {(1, 2), (2, 3)}


def test_entities(spark):
    assert col(spark, ["أبو محمد زيد بن عبد الله بن عمرو القرشي", "", None], entities.chain)[0] == ["زيد", "عبد_الله", "عمرو"]
    assert col(spark, ["زيد بن عمرو القرشي"], entities.nisbas) == [["القرشي"]]
    assert col(spark, ["أبو محمد زيد"], entities.kunyas) == [["محمد"]]
    canon = spark.createDataFrame([(1, "زيد بن عمرو بن خالد القرشي"), (2, "زيد بن عمرو بن بكر"), (3, "أسماء بنت يزيد"), (4, "حارث بن معمر بن حبيب"), (5, None)], "cid int, name string")
    q = spark.createDataFrame([(1, "زيد بن عمرو بن خالد القرشي"), (2, "زيد بن عمرو"), (3, "حارث بن معمرر بن حبيب"), (4, "غيره"), (5, None), (6, "زيد بن عمرو القرشي")], "qid int, name string")
    got = {r.qid: (r.cid, r.status) for r in entities.cascade(q, canon).collect()}
    assert got[1] == (1, "resolved") and got[2] == (None, "ambiguous") and got[3] == (4, "resolved") and got[4] == (None, "unresolved") and got[5] == (None, "unresolved") and got[6] == (1, "resolved")
    dup = spark.createDataFrame([("a", 2, "x"), ("a", 1, "x"), ("b", 3, "x y"), ("b", 4, "x"), ("c", 5, "x"), ("c", 6, "z"), ("d", 7, None)], "k string, id int, n string")
    assert {r.k: (r.how, r.chosen) for r in entities.duplicate_policy(dup, "k", "n", "id").collect()} == {"a": ("dup_norm", 1), "b": ("prefix", 4), "c": ("ambiguous", None)}


def test_html(spark):
    page = '<html><title>كتاب ج3 - ص45</title><p>menu</p><div class="x nass" data-page-num="45"><p>واحد <b>اثنان</b><a class="btn_tag">+</a></p><p> </p><div><p>ثلاثة\n أربعة</p></div></div><p>end</p></html>'
    assert pages.parse_page(page) == (3, 45, ["واحد اثنان", "ثلاثة أربعة"])
    assert pages.parse_page("<p>x</p>") is None
    assert pages.parse_page("<article><p>x</p></article>", "article") == (None, None, ["x"])
    df = spark.createDataFrame([("s", "b", 1, "u", page), ("s", "b", 2, "u", None), ("s", "b", 3, "u", "<p>x</p>")], "source string, book_id string, web_page int, url string, html string")
    assert [(r.web_page, r.paras) for r in pages.html_pages(df).collect()] == [(1, ["واحد اثنان", "ثلاثة أربعة"])]
    toc = '<ul><li><a href="/book/7/1">A</a><ul><li><a href="/book/7/5">B  b</a></li><li><a href="/book/8/5">no</a></li></ul></li><li><a href="/book/7/9">C</a></li></ul>'
    t = pages.nested_toc(spark.createDataFrame([("7", toc), ("7", None)], "book_id string, html string"))
    assert [(r.i, r.page, r.title, r.depth) for r in t.orderBy("i").collect()] == [(0, 1, "A", 0), (1, 5, "B b", 1), (2, 9, "C", 0)]


def test_json_and_stream(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.json").write_text('{"source":"s","web_page":1,"paras":["x","y"]}\n\n{broken\n{"source":"s","web_page":2,"paras":[]}\n', encoding="utf-8")
    df = pages.read_pages(spark, str(folder))
    assert df.where("web_page is not null").count() == 2 and pages.paragraphs(df).count() == 2
    ingest(spark, str(folder), str(tmp_path / "out"), str(tmp_path / "state"))
    (folder / "b.json").write_text('{"source":"t","web_page":3,"paras":["z"]}\n', encoding="utf-8")
    ingest(spark, str(folder), str(tmp_path / "out"), str(tmp_path / "state"))
    assert sorted(r.text for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["x", "y", "z"]
    (tmp_path / "r").mkdir()
    (tmp_path / "r" / "book_001.rb.json").write_text(json.dumps([{"label": "1", "kind": "k"}]), encoding="utf-8")
    (tmp_path / "r" / "book_002.rb.json").write_text("[{", encoding="utf-8")
    got = {(r.book, r.number, r.bad, r.label) for r in pages.read_results(spark, str(tmp_path / "r"), "label: string, kind: string").collect()}
    assert ("book", 1, False, "1") in got and len(got) == 2


def test_review_blocks_and_conform(spark):
    text = "### Q a#12\njudul: x\n  [4] n | b\n  [9] m\n### Q b#3\n"
    got = col(spark, [text, None], pages.review_blocks)
    assert [(b.source, b.number, b.candidates) for b in got[0]] == [("a", 12, [4, 9]), ("b", 3, [])] and got[1] is None
    df = pages.conform(spark.createDataFrame([(1, "x")], "a int, c string"), "c string, b double")
    assert [tuple(r) for r in df.collect()] == [("x", None)]


def test_exports(spark):
    rows = spark.createDataFrame([("s", i, 10, i == 5) for i in range(12)], "source string, web_page int, n_words int, is_start boolean")
    got = [r.file_no for r in sinks.split_export(rows, "source", ["web_page"], 60).orderBy("web_page").collect()]
    assert got == [0] * 6 + [1] * 6  # the sixth page is full at 60 words; a chapter at page 5 comes before 85 % of them
    parts = sinks.equal_parts(rows, "source", ["web_page"], F.col("n_words"), 45).orderBy("web_page").collect()
    assert [r.part_no for r in parts] == [0] * 4 + [1] * 4 + [2] * 4
    assert sinks.equal_parts(rows.limit(0), "source", ["web_page"], F.col("n_words"), 45).count() == 0


def test_runs_as_text(spark):
    df = spark.createDataFrame([("k", i) for i in (1, 2, 3, 7, 7, 9, 10)] + [("k", None)], "k string, n int")
    assert [r.numbers for r in slicing.compressed(df, ["k"], "n").collect()] == ["1-3,7,9-10"]


def test_located_in_order(spark):
    titles = spark.createDataFrame([("b", 1, 1, "باب الماء"), ("b", 2, 1, "باب الماء"), ("b", 3, 2, "باب النار"), ("b", 4, 9, "باب الهواء"), ("b", 5, 3, None)], "k string, i int, page int, tkey string")
    lines = spark.createDataFrame([("b", 1, 0, "باب الماء وما فيه"), ("b", 1, 1, "نص"), ("b", 1, 2, "باب الماء"), ("b", 3, 0, "باب النار"), ("b", 3, 1, None)], "k string, page int, para_idx int, pkey string")
    got = alignment.located(titles, lines, ["k"]).orderBy("i").collect()
    assert [(r.found_page, r.para_idx) for r in got] == [(1, 0), (1, 2), (3, 0), (None, None), (None, None)]


def brute_candidates(queries, canon, chains, k):
    def near(a, b):
        if a == b:
            return True
        if len(a) < 4 or len(b) < 4:
            return False
        s, l = sorted((a, b), key=len)
        if len(s) == len(l):
            return sum(x != y for x, y in zip(s, l)) == 1
        return len(l) == len(s) + 1 and any(l[:i] + l[i + 1 :] == s for i in range(len(l)))

    df = {}
    for c in canon:
        for t in set(chains[c]):
            df[t] = df.get(t, 0) + 1
    out = set()
    for q in queries:
        scores = []
        for c in canon:
            total = 0
            for i, t in enumerate(chains[q]):
                hits = [(j, u) for j, u in enumerate(chains[c]) if near(t, u)]
                if hits:
                    same = any(j == i for j, _ in hits)
                    total += (3 if same and i == 0 else 2 if same else 0) + 1 + (2 if min(df[u] for _, u in hits) <= 2 else 0)
            if total:
                scores.append((-total, c))
        out |= {(q, c, -s, r + 1) for r, (s, c) in enumerate(sorted(scores)[:k])}
    return out


def test_candidates_against_plain_python(spark):
    rng = random.Random(7)
    pool = ["زيد", "عمرو", "خالد", "خالدد", "معمر", "معمرر", "حارث", "حرث", "سعيد", "بكر"]
    names = {i: [rng.choice(pool) for _ in range(rng.randrange(1, 4))] for i in range(40)}
    df = lambda ids, key: spark.createDataFrame([(i, " بن ".join(names[i])) for i in ids] + [(900, None), (901, "")], f"{key} int, name string")
    q, c = list(range(20)), list(range(20, 40))
    got = {(r.qid, r.cid, r.score, r["rank"]) for r in entities.candidates(df(q, "qid"), df(c, "cid"), k=3, rare=2).collect()}
    assert got == brute_candidates(q, c, names, 3)


def test_candidate_list(spark):
    """Kunya, nisba, epithets, the gate, previous and forced candidates, evidence for the main entry, entries without candidates."""
    canon = spark.createDataFrame(
        [(1, "زيد بن خالد القرشي", "أبو جوفخ"), (2, "عمرو بن زيد", None), (3, "أبو طالب", None), (4, "عمار بن بكر", None), (5, "كعب بن مالك الصديق", None), (6, "أبي بن كعب", None), (7, "زيد بن بشر", None)]
        + [(i, "سهل بن هند", "أبو ليث") for i in range(11, 17)],
        "cid int, name string, kunya string",
    )
    q = spark.createDataFrame([(1, "أبو جوفخ القرشي"), (2, "زيد بن خالد"), (3, "أبو طالب"), (4, "مالك الصديق"), (5, "أبي بن كعب"), (6, None), (7, "ظظظ"), (8, "أبو ليث")], "qid int, name string")
    aliases = spark.createDataFrame([(3, 4)], "cid int, main int")
    previous = spark.createDataFrame([(2, 5, 0)], "qid int, cid int, place int")
    got = {}
    for r in entities.candidate_list(q, canon, aliases, previous).collect():
        got.setdefault(r.qid, []).append((r["rank"], r.cid, r.score, r.how))
    got = {k: sorted(v, key=lambda x: x[0] or 0) for k, v in got.items()}
    assert got[1] == [(1, 1, 2, "kunya")]
    # The previous one first though it scores nothing; 7 shares the first word; 2 has it as a forefather's, which scores nothing.
    assert got[2] == [(1, 5, 0, "previous"), (2, 1, 5, "gated"), (3, 7, 3, "gated")]
    assert got[3] == [(1, 3, 1, "kunya"), (2, 4, 1, "gated")]
    assert got[4][0] == (1, 5, 3, "fill")
    assert got[5][0] == (1, 6, 5, "gated")
    assert got[6] == got[7] == [(None, None, None, "none")]
    assert [x[3] for x in got[8]] == ["kunya"] * 4 + ["gated"] * 2 and [x[1] for x in got[8]] == list(range(11, 17))


def test_cascade_father_kunya(spark):
    """The father's kunya as a stage of its own, at least five points, and the score of a common prefix."""
    assert col(spark, ["أسماء بنت أبي بكر", "زيد بن عمرو", "أبو بكر بن عمرو", None], entities.father_kunya) == ["ابو بكر", None, None, None]
    canon = spark.createDataFrame(
        [(1, "أسماء بنت أبي بكر الصديق"), (2, "أسماء بنت يزيد"), (3, "هند بنت زيد أبو طالب"), (4, "زيد بن عمرو بن خالد بن بكر بن سعد"), (5, "زيد بن عمرو بن معمر بن بكر بن سعد"), (6, "سهل بن هود بن صالح بن نوح بن سام بن حام بن شيث"), (7, "سهل بن هود بن صالح بن نوح بن سام بن يافث بن شيث"), (8, "حمزة بن أبي ليث القيسي"), (9, "حمزة بن أبي ليث الأسدي")],
        "cid int, name string",
    )
    q = spark.createDataFrame([(1, "أسماء بنت أبي بكر"), (2, "هند بنت أبي عمر"), (3, "هند بنت أبي خلف بن زيد أبو طالب"), (4, "سهل بن هود بن صالح بن نوح بن سام بن يافث"), (5, "زيد بن عمرو بن غالب بن بكر"), (6, "حمزة مولى أبي ليث العبسي"), (7, "هند بنت أبي طالب")], "qid int, name string")
    got = {r.qid: (r.cid, r.stage, r.status) for r in entities.cascade(q, canon).collect()}
    assert got[1] == (1, 7, "resolved") and got[2] == (None, None, "unresolved")
    assert got[4] == (7, 3, "resolved"), "five forefathers"
    assert got[5][2] == "ambiguous", "what stands behind a difference doesn't count"
    assert got[6] == (None, 7, "ambiguous") and got[7] == (3, 7, "resolved"), "its kunya word stands in the name, and is shared"


def test_near_words_against_brute_force(spark):
    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    words = ["محمد", "محمود", "احمد", "مَحْمَدٌ", "محمدا", "ṭabarī", "ṭabari", "ṭabarīy", "kitab", "kitāb", "Kitab", "book", "boot", "иван", "ивана", "ab", "abc", "abd", "بن", "ابن"]
    texts = spark.createDataFrame([(" ، ".join(words[:12]),), ("-".join(words[8:]),), (None,), ("",)], "text string")
    keys = {w.lower().translate({c: None for c in range(0x64B, 0x653)}) for w in words}
    want = {(a, b) for a in keys for b in keys if a < b and min(len(a), len(b)) >= 4 and near(a, b)}
    got = [tuple(r) for r in entities.near_words(texts, "text").collect()]
    assert sorted(got) == sorted(want) and ("محمد", "محمود") in want and ("book", "boot") in want and ("ṭabari", "ṭabarī") in want


def test_search_names(spark):
    """Words that stand apart, unlinked entries, sources over all of a person's entries, roll-ups hidden and counted or asked for."""
    reg = spark.createDataFrame([("a", 1, "خطبه كبيره في وادي", "x", ["يوم"]), ("tahun_1_h", 2, "سنه واحد يوم", "Tahun 1", [])], "event_id string, seq int, name_norm string, name_id string, aliases array<string>")
    persons = spark.createDataFrame([(1, "زيد بن خالد بن عمرو"), (2, "بكر")], "person int, name string")
    e = spark.createDataFrame([(10, 1, "s", 1, "زيد بن خالد بن عمرو"), (11, 1, "t", 1, "غيره"), (12, None, "t", 2, "زيد الطويل عمرو"), (13, None, "s", 9, "زيدان عمرو"), (14, None, "t", 3, None)], "entry_id int, person int, source string, entry_num int, name string")
    q = spark.createDataFrame([(1, "خطبة وادي"), (2, "زيد عمرو"), (3, "يوم"), (4, "سنة يوم"), (5, " "), (6, "tahun")], "qid int, query string")
    got = {(r.qid, r.kind, r.id, r.score, r["rank"], r.n_more) for r in resolution.search_names(q, reg, persons, e).collect()}
    assert got == {
        (1, "event", "a", 0, 1, 0), (2, "person", "1", 0, 1, 0), (2, "unlinked", "12", None, 1, 0), (3, "event", "a", 100, 1, 0), (3, "hidden", None, None, 1, 1), (4, "event", "tahun_1_h", 0, 1, 0),
        (6, "event", "tahun_1_h", 60, 1, 0),
    }
    many = spark.createDataFrame([(i, None, "s", i, "زيد") for i in range(23)], "entry_id int, person int, source string, entry_num int, name string")
    rows = resolution.search_names(spark.createDataFrame([(1, "زيد")], "qid int, query string"), reg, persons.where("person = 2"), many).collect()
    assert sorted(int(r.id) for r in rows) == list(range(20)) and {(r.kind, r.n_more) for r in rows} == {("unlinked", 3)}


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("s", 2, None), ("s", 1, "x"), ("t", 1, "y")], "source string, i int, t string")
    sinks.write_json_lines(df, str(tmp_path / "j"))
    lines = [json.loads(x) for f in (tmp_path / "j").glob("*.json") for x in f.read_text(encoding="utf-8").splitlines()]
    assert sorted(x["i"] for x in lines) == [1, 1, 2] and all("t" in x for x in lines)
    sinks.rebuild(df, str(tmp_path / "p"), "source", ["i"])
    sinks.rebuild(df, str(tmp_path / "p"), "source", ["i"])
    assert spark.read.parquet(str(tmp_path / "p")).count() == 3
    assert sorted(r.json for r in sinks.as_json(df.limit(1)).collect()) == ['{"source":"s","i":2,"t":null}']
    assert [r.batch_no for r in sinks.batches(df, "source", ["i"], 1).orderBy("source", "i").collect()] == [0, 1, 0]


def test_toc(spark):
    rng = random.Random(3)
    rows, page = [], 1
    for i in range(60):
        page += rng.choice([0, 0, 1, 3])
        rows.append(("b", i, page, rng.randrange(0, 4)))
    toc = spark.createDataFrame(rows, "k string, i int, page int, depth int")
    ends = {r.i: (r.end_excl, r.end_any) for r in labels.toc_ends(toc, ["k"]).collect()}
    parents = {r.i: r.parent for r in labels.toc_parents(toc, ["k"]).collect()}
    for _, i, p, d in rows:
        assert ends[i][0] == next((q for _, j, q, e in rows if j > i and q > p and e <= d), None)
        assert ends[i][1] == next((q for _, j, q, _ in rows if j > i and q > p), None)
        assert parents[i] == next((j for _, j, _, e in reversed(rows[:i]) if e < d), None)


def test_kunya_titles(spark):
    canon = spark.createDataFrame([(1, "زيد بن عمرو بن خالد القرشي"), (2, "أبو بكر سعد بن مالك الأزدي"), (3, "أبو بكر بشر الكندي"), (4, "أبو طالب عمار")], "cid int, name string")
    q = spark.createDataFrame([(1, "أبو محمد", "أبو محمد واسمه زيد بن عمرو بن خالد"), (2, "أبو بكر الأزدي", "لا يعرف"), (3, "أبو بكر", None), (4, "أبو طالب", None), (5, "زيد", "اسمه زيد"), (6, None, None), (7, "أبو مكرر كذا", "x")], "qid int, title string, body string")
    got = {r.qid: (r.cid, r.how) for r in entities.kunya_titled(q, canon, skip="أبو مكرر").collect()}
    assert got == {1: (1, "name in text"), 2: (2, "kunya"), 3: (None, "unresolved"), 4: (4, "kunya")}
