from pyspark.sql import functions as F

from warraq.operators import entities, quotations as Q, resolution


def col(spark, values, f):
    return [r[0] for r in spark.createDataFrame([(v,) for v in values], "t string").select(f(F.col("t"))).collect()]


def test_guards(spark):
    assert col(spark, ["﴿بِسْمِ اللَّهِ الرَّحْمَنِ الرَّحِيمِ﴾", "بسم الله", None], Q.is_basmalah) == [True, False, None]
    assert col(spark, ["أعوذ بالله من الشيطان الرجيم، قال", "قال"], Q.is_refuge) == [True, False]
    # A heading may go on after the name, if it is short.
    assert col(spark, ["(سورة الفاتحة)", "سورة الفاتحة نزلت", "[تفسير] [١] سورة الفاتحة [مكية]", "ذكر سورة الفاتحة " + "كلام " * 40, "سورة البقرة"], lambda c: Q.is_chapter_heading(c, F.lit("الفاتحة"))) == [True, True, True, False, False]
    assert col(spark, ["﷽", "سُبْحَانَ"], Q.is_basmalah) == [True, False] and col(spark, ["*[خاتمة] كذا", "آمين", "قال آمين"], Q.is_closing) == [True, True, False]


def test_guarded_segments(spark):
    rows = [("a", i, t) for i, t in enumerate(["نهاية السورة قبلها", "سورة الفاتحة", "مقدمة", "أعوذ بالله من الشيطان", "١", "شرح", "٢", "شرح", "خاتمة", "آخر", "سورة البقرة", "ذيل"])]
    rows += [("b", i, t) for i, t in enumerate(["١", "بسم الله الرحمن الرحيم", "شرح", "بسم الله الرحمن الرحيم", "ذيل"])] + [("c", 0, "x")]
    anchors = [("a", 4, "1", "tafsir"), ("a", 5, "1", "tafsir"), ("a", 6, "2", "tafsir"), ("b", 0, "1", "tafsir")]
    names = [("a", "الفاتحة", "البقرة"), ("b", None, None), ("c", "y", "z")]
    of = lambda r, s: spark.createDataFrame(r, s)
    got = Q.guarded_segments(of(rows, "k string, pos int, text string"), of(anchors, "k string, pos int, label string, kind string"), of(names, "k string, own_name string, next_name string"), ["k"])
    assert sorted(tuple(r) for r in got.collect()) == [
        ("a", 0, 1, "out_of_scope", "out_of_scope"), ("a", 2, 2, "intro", "intro"), ("a", 3, 3, "istiadhah", "istiadhah"), ("a", 4, 5, "1", "tafsir"), ("a", 6, 7, "2", "tafsir"),
        ("a", 8, 9, "closing", "closing"), ("a", 10, 11, "out_of_scope", "out_of_scope"), ("b", 0, 2, "1", "tafsir"), ("b", 3, 4, "out_of_scope", "out_of_scope"),
    ]
    assert col(spark, ["التفسير: كذا", "اللغة:", "خاتمة", "قال"], Q.section_kind) == ["tafsir", "section", "closing", None]


def test_quoting_headings(spark):
    rows = [("b", 1, "القول في تأويل قوله تعالى: ﴿الحمد لله (٢) رب العالمين (٣)﴾"), ("b", 2, "القول في تأويل"), ("b", 3, "﴿x y﴾"), ("b", 4, None)]
    got = Q.quoting_headings(spark.createDataFrame(rows, "k string, i int, text string"), ["k"], "i").collect()
    assert [(r.pos, r.phrase, r.lo, r.hi) for r in got] == [(1, "الحمد لله رب العالمين", 2, 3)]


def test_numbered_blocks(spark):
    rows = [("b", 1, "﴿ا (١) ب (٢)﴾."), ("b", 2, "قال (٩)"), ("b", 3, "﴿ج (٩)﴾ [الصافات: ١٤٧]"), ("b", 4, "﴿د (٣)"), ("b", 5, "{ه (٧)}")]
    got = Q.numbered_blocks(spark.createDataFrame(rows, "k string, i int, text string"), ["k"], "i").orderBy("pos").collect()
    assert [(r.pos, r.lo, r.hi) for r in got] == [(1, 1, 2), (4, 3, 3), (5, 7, 7)]


def test_inline_quotes(spark):
    rows = spark.createDataFrame([("b", 1, "قال {الحمدُ لله} ثم ﴿رب العالمين.﴾ {x}"), ("b", 2, None)], "key string, i int, text string")
    assert [(r.pos, r.k, r.phrase) for r in Q.inline_quotes(rows, ["key"], "i").orderBy("k").collect()] == [(1, 0, "الحمد لله"), (1, 1, "رب العالمين")]


def test_section_units(spark):
    texts = ["فضلها", "التفسير", "x", "اللغة", "التفسير", "y", "البلاغة", "خاتمة"]
    rows = spark.createDataFrame([("b", i, t) for i, t in enumerate(texts)], "k string, i int, text string")
    quotes = spark.createDataFrame([("b", 1, 0, 1), ("b", 2, 0, 9), ("b", 2, 1, 3), ("b", 5, 0, 5), ("b", 5, 1, 4), ("b", 5, 2, 8), ("b", 3, 0, 2)], "k string, pos int, k_ int, ayah int").withColumnRenamed("k_", "kk")
    got = Q.section_units(rows.withColumnRenamed("k", "key"), quotes.withColumnRenamed("k", "key").withColumnRenamed("kk", "k"), ["key"], "i")
    assert [(r.kind, r.from_pos, r.to_pos, r.lo, r.hi) for r in got.orderBy("unit").collect()] == [("intro", 0, 0, None, None), ("tafsir", 1, 2, 1, 3), ("section", 3, 3, 1, 3), ("tafsir", 4, 5, 5, 8), ("section", 6, 6, 5, 8), ("closing", 7, 7, None, None)]


def test_loading_and_ranges(spark):
    s = spark.createDataFrame([("1", "k"), ("intro", None), ("out_of_scope", None), (None, None)], "label string, kind string")
    assert [r.section for r in Q.loadable(s).collect()] == ["k", "intro", "tafsir"]
    p = spark.createDataFrame([("s", 1, "a"), ("s", 2, "b")], "source string, web_page int, text string")
    r = spark.createDataFrame([("x", "s", 1, 2), ("x", "s", 1, 3), ("x", "t", 1, 9), ("y", "s", 3, 3)], "axis string, source string, start int, end int")
    hit, absent = Q.page_range_segments(r, p)
    assert sorted((x.axis, x.text) for x in hit.collect()) == [("x", "a"), ("x", "b")] and sorted((x.axis, x.source) for x in absent.collect()) == [("x", "t"), ("y", "s")]


def test_articles(spark):
    assert col(spark, ["سيدنا زيد أمير المؤمنين", "حليفة"], entities.without_titles) == ["زيد", "حليفه"]
    rows = spark.createDataFrame([(1, 0, "ذكر زيد"), (1, 1, "متن طويل كاف"), (1, 2, "ذكر عمرو"), (1, 3, "آخر"), (2, 0, "ذكر وحده")], "seg_id int, rel_idx int, text string")
    got = {r.seg_id: (r.head_text, r.body_text) for r in entities.head_and_body(rows, F.col("text").startswith("ذكر")).collect()}
    assert got == {1: ("ذكر زيد\nمتن طويل كاف", "متن طويل كاف"), 2: ("ذكر وحده", None)}
    e = spark.createDataFrame([(1, "أبو محمد", "أبو محمد ذكره"), (2, "زيد بن عمرو", "زيد بن عمرو يكنى أبا محمد وقيل أبو محمد"), (3, "أبو خالد", "x"), (4, "بكر", "أبو خالد"), (5, "سعد", "أبو خالد"), (6, None, None)], "cid int, title string, head_text string")
    assert [(r.cid, r.main) for r in entities.title_aliases(e).collect()] == [(1, 2)]


def test_notes_and_sections(spark):
    rows = spark.createDataFrame([(1, 5, "sahih", "X"), (2, 6, None, None)], "row_id int, num int, grade string, grade_by string")
    fixes = spark.createDataFrame([(2, "66", "slip"), (2, "67", "z")], "row_id int, printed_label string, reason string")
    assert [(r.number_note, r.grade_note) for r in resolution.with_fixes(rows, fixes).orderBy("row_id").collect()] == [(None, "sahih - X"), ("printed as 66: slip", None)]
    s = spark.createDataFrame([(1, 1, "باب الماء"), (1, 2, "باب النار"), (1, 3, None)], "seg_id int, section int, title string")
    assert [r.section for r in resolution.address_section(s, "2").collect()] == [2]
    assert [r.status for r in resolution.address_section(s, "بابُ الماء").collect()] == ["found"]
    assert {r.status for r in resolution.address_section(s, "باب").collect()} == {"ambiguous"}
