"""Rules of order and resolution against plain Python: deep trees, chains, verses, titles, snippets."""

import itertools
import random

from pyspark.sql import functions as F

from warraq.functions import normalise as N
from warraq.functions import paragraphs as P
from warraq.operators import alignment, entities, labels, resolution, search, segmentation, slicing


def test_deep_trees(spark):
    rng = random.Random(1)
    rows, page = [], 0
    for i in range(300):
        page += rng.randrange(2)
        rows.append(("k" if i < 200 else None, i, page, rng.choice([None, -1, *range(30)])))
    toc = spark.createDataFrame(rows, "k string, i int, page int, depth int")
    own = lambda r: max(r[3] or 0, 0)
    ends = {r.i: (r.end_excl, r.end_any) for r in labels.toc_ends(toc, ["k"]).collect()}
    parents = {r.i: r.parent for r in labels.toc_parents(toc, ["k"]).collect()}
    assert len(ends) == len(parents) == 300
    for r in rows:
        later = [x for x in rows if x[0] == r[0] and x[2] > r[2]]
        assert ends[r[1]] == (min((x[2] for x in later if own(x) <= own(r)), default=None), min((x[2] for x in later), default=None))
        assert parents[r[1]] == max((x[1] for x in rows if x[0] == r[0] and x[1] < r[1] and own(x) < own(r)), default=None)
    assert labels.toc_ends(toc.limit(0), ["k"]).count() == labels.toc_parents(toc.limit(0), ["k"]).count() == 0


def chains(c):
    """All chains of candidates (pos, lo, hi), as tuples of places."""
    for n in range(1, len(c) + 1):
        for at in itertools.combinations(range(len(c)), n):
            if all(c[b][1] > c[a][2] for a, b in zip(at, at[1:])):
                yield at


def test_best_chain_against_all_chains(spark):
    rng = random.Random(4)
    for _ in range(12):
        c = sorted((pos, lo, lo + rng.randrange(4)) for pos in range(rng.randrange(1, 9)) for lo in [rng.randrange(1, 15)])
        best = max((c[at[-1]][2] - c[at[0]][1], len(at)) for at in chains(c))
        got = sorted(tuple(r)[1:] for r in alignment.best_chain(spark.createDataFrame([("k", *x) for x in c], "k string, pos bigint, lo int, hi int"), ["k"]).collect())
        assert (got[-1][2] - got[0][1], len(got)) == best and all(b[1] > a[2] for a, b in zip(got, got[1:]))


def test_verses(spark):
    rows = [(1, 7), (1, 8), (2, 286), (2, 999), (114, None), (115, 1), (0, 1), (None, 3)]
    got = {(r.surah, r.ayah): r.status for r in labels.check_verses(spark.createDataFrame(rows, "surah int, ayah int")).collect()}
    assert got == {(1, 7): "ok", (1, 8): "no verse", (2, 286): "ok", (2, 999): "no verse", (114, None): "ok", (115, 1): "no chapter", (0, 1): "no chapter", (None, 3): "no chapter"}
    notes = spark.createDataFrame([("3,4",), ("~3-4",), ("3",), (None,)], "l string").select(labels.label_note(F.col("l")).alias("n")).collect()
    assert [r.n for r in notes] == ["one of these verses", "verses inferred from the neighbours", None, None]


def test_titles(spark):
    aliases = spark.createDataFrame([("البقرة", 2), ("الحج", 22), ("الحج الأكبر", 9), ("سبحان", 17), ("الإسراء", 17), ("حم", 41), ("حم", 40), ("", 1), (None, 3)], "alias string, target int")
    titles = ["تفسير سُورَةِ البقرة (مدنية)", "[تفسير سورة سبحان وهي مكية]", "سورة الحج الأكبر آخر", "سورة الحج وهي", "السورة التي يذكر فيها البقرة", "سورة حم", "سورة ما ليس", "باب البقرة", "سورة", "", None]
    got = {r.tid: (r.target, r.status) for r in resolution.title_targets(spark.createDataFrame(list(enumerate(titles)), "tid int, title string"), aliases).collect()}
    ok = lambda n: (n, "ok")
    assert got == {0: ok(2), 1: ok(17), 2: ok(9), 3: ok(22), 4: ok(2), 5: (None, "ambiguous"), 6: (None, "unknown"), **{k: (None, "no heading") for k in (7, 8, 9, 10)}}


def test_aliases_of_two_targets(spark):
    aliases = spark.createDataFrame([("Kitab A", "a"), ("both", "a"), ("both", "b"), ("bothandmore", "b"), ("only", "c"), (None, "d")], "alias string, target string")
    inputs = spark.createDataFrame([(i, n) for i, n in enumerate(["KITAB a", "Both", "Imam both", "bothan", "onl", "only", "x", None])], "qid int, name string")
    got = {r.qid: (r.target, r.how) for r in resolution.resolve_aliases(inputs, aliases).collect()}
    assert got == {0: ("a", "exact"), 1: (None, "ambiguous"), 2: (None, "ambiguous"), 3: ("b", "unique start"), 4: (None, "unknown"), 5: ("c", "exact"), 6: (None, "unknown"), 7: (None, "unknown")}


def test_snippet_window(spark):
    text = "ab " * 60 + "قَالَ زيد " + "cd " * 120
    rows = [(text, "قال زيد"), (text, "لا زيد"), (text, "لا"), ("قال", "قال"), ("", "قال"), (None, "x"), (text, None)]
    got = [r.s for r in spark.createDataFrame(rows, "t string, q string").select(search.snippet("t", "q").alias("s")).collect()]
    at = text.index("قَ")
    assert got[0].startswith("…ab") and got[0].endswith("cd…") and text[at:].startswith(got[0][got[0].index("قَ") : -1]) and 96 <= got[0].index("قَ") <= 101
    assert len(got[0]) - got[0].index("قَ") > 236 and "زيد" in got[1]
    assert got[2] == got[6] == text[: text.rfind(" ", 300, 340)].strip() + "…" and got[3:6] == ["قال", "", None]


def test_headers_in_all_spellings(spark):
    texts = ["[سورة البقرة (٢): الآيات ٣ إلى ٥]", "[سُورَة البقرة (٢) : الايات ٣ الى ٥]", "[[سورة البقرة (٢): آيات ٣ إلي ٥]", "[سورة هود (١١): آية ٧]", "سورة هود (١١): آية ٧", None]
    got = [r.h and tuple(r.h) for r in spark.createDataFrame([(t,) for t in texts], "t string").select(segmentation.header_range(F.col("t")).alias("h")).collect()]
    assert got == [(2, 3, 5)] * 3 + [(11, 7, 7), None, None]


def test_foreign_scripts_and_honorifics(spark):
    col = lambda values, f: [r[0] for r in spark.createDataFrame([(v,) for v in values], "t string").select(f(F.col("t"))).collect()]
    assert col(["。", "㐂", "漢", "Ж", "قال", None], P.has_foreign_script) == [True, True, True, True, False, None]
    assert col(["زيد رضي الله عنه", "امرأة زيد", "زوجة عمرو", "زيد صلى الله عليه وسلم"], N.person_key) == ["زيد", "زيد", "عمرو", "زيد"]


def test_prefix_sums_over_blocks(spark):
    rng = random.Random(2)
    rows = [(rng.choice(["a", "a", "b", None]), rng.choice([None, *range(40)]), i, rng.choice([None, 0, *range(9)])) for i in range(300)]
    df = spark.createDataFrame(rows, "k string, o int, i int, n int")
    got = {r.i: (r.before, r.whole) for r in slicing.prefix_sums(df, ["k"], ["o", "i"], F.col("n"), "before", "whole", width=7).collect()}
    order = lambda r: (r[1] is not None, r[1] or 0, r[2])
    for r in rows:
        same = [x for x in rows if x[0] == r[0]]
        assert got[r[2]] == (sum(x[3] or 0 for x in same if order(x) < order(r)), sum(x[3] or 0 for x in same))
    assert slicing.prefix_sums(df.limit(0), ["k"], ["o"], F.col("n"), "x").count() == 0


def test_name_structures(spark):
    names = [
        (1, "أبو بكر الصديق عبد الله بن أبي قحافة عثمان التيمي، أمه سلمى بنت صخر، أبو العتيق"), (2, "زيد بن حارثة الكلبي؛ ابن شراحيل بن كعب"), (3, "أم سلمة هند"), (4, ""), (5, None), (6, "، - ،"), (7, "عبد الرحمن بن عوف - الزهري"), (8, "بن بن"),
    ]
    rows = {r.qid: r for r in entities.name_structures(spark.createDataFrame(names, "qid int, name string"), "qid").collect()}
    assert set(rows) == set(range(1, 9))
    assert (rows[1].titled, rows[1]["head"], rows[1].father_kunya) == (True, "ابو بكر", "ابو قحافه عثمان") and "التيمي" in rows[1].nisbas and "سلمي" not in rows[1].norm
    assert rows[2].chain == ["زيد", "حارثه", "شراحيل", "كعب"] and rows[2].nisbas == ["الكلبي"] and not rows[2].titled
    assert (rows[3].titled, rows[3]["head"]) == (True, "ام سلمه هند") and rows[7].chain == ["عبد الرحمن", "عوف"] and rows[7].nisbas == ["الزهري"]
    for k in (4, 5, 6, 8):
        assert (rows[k].chain, rows[k].kunyas, rows[k].father_kunya, rows[k].nisbas, rows[k].titled) == ([], [], None, [], False)
    texts = ["قال زيد بن عمرو بن خالد ثم", "بن بن", "زيد", "", None, "زيد بن عمرو بن بن علي ابن حسن ابن علي القرشي"]
    got = [r.c for r in spark.createDataFrame([(t,) for t in texts], "t string").select(entities.body_chains(F.col("t")).alias("c")).collect()]
    assert got == [[["قال زيد", "عمرو", "خالد"]], [], [], [], [], [["علي", "حسن", "علي"], ["زيد", "عمرو"]]]


def test_verse_index(spark):
    rows = [(1, "[سورة هود (١١): الآيات ١ إلى ٢]"), (2, "الر كتاب (١) ألا تعبدوا (٢)"), (3, "[التفسير]"), (4, "قال (٣) كذا"), (5, "[سورة هود (١١): آية ٢]"), (6, "الا تعبدوا الا (٢)"), (7, None)]
    got = {r.ayah: r.text for r in segmentation.verse_index(spark.createDataFrame([("b", *r) for r in rows], "book string, i int, text string"), ["book"], ["i"]).collect()}
    assert got == {1: "الر كتاب", 2: "الا تعبدوا الا"}


def test_title_aliases(spark):
    rows = [(1, "أبو بكر", "أبو بكر"), (2, "عبد الله بن عثمان بن عامر", "عبد الله بن عثمان وهو أبو بكر"), (3, "أبو ذر", "أبو ذر واسمه جندب بن جنادة بن سفيان"), (4, "جندب بن جنادة بن سفيان", "جندب"), (5, "أم كذا", None), (6, "أبو زيد", "x"), (7, "عمرو", "أبو زيد"), (8, "خالد", "أبو زيد")]
    got = entities.title_aliases(spark.createDataFrame(rows, "cid int, title string, head_text string"))
    assert {(r.cid, r.main) for r in got.collect()} == {(1, 2), (3, 4)}
