"""Look-alikes and encodings."""

import os
import random

import pytest

from warraq.llm import encodings, lookalikes

AR = "قال الشيخ في الكتاب ان الحديث صحيح وروي عن ابيه ثم مضى الى المدينة وكان من اهل العلم والفضل رحمه الله ولم يذكر غيره من الناس شيئا في هذا الباب"
LATIN = "the witness returned to the city and copied the chapter about the scholars of the road quietly before the prayer Ṣāliḥ bin Ṭāhā wrote it down"


@pytest.mark.parametrize(
    "stored, plain",
    [
        ("ﻗﺎﻝ", "قال"), ("ﻻ", "لا"), ("Ｍｓ． １", "Ms. 1"), ("a b c d", "a b c d"), ("م⁠ن​", "من"), ("آل", "آل"), ("سأل", "سأل"),
        ("āṣ", "āṣ"), ("ق‍ال", "قال"), ("و‌قد", "وقد"), ("صلى ﷺ", "صلى ﷺ"), ("ن¹", "ن¹"), ("قَالَ", "قَالَ"), ("ـــ", "ـــ"), ("ه‍", "ه‍"), ("می‌خواهد", "می‌خواهد"),
    ],
)
def test_fixed_forms(stored, plain):
    assert lookalikes.plain(stored) == plain
    assert lookalikes.plain(plain) == plain


def test_candidates_keep_foreign_words():
    assert lookalikes.candidates("(Сборник Залужья) codd. δ et ψ, рук. Шелмач, л. 7") == []
    assert [w for *_, w in lookalikes.candidates("bіn Jіdīzī В 314")] == ["bin", "Jidīzī", "B"]
    assert [w for *_, w in lookalikes.candidates("الکتاب ۱۳٥")] == ["الكتاب", "١٣٥"]
    assert lookalikes.candidates("گفتگوی") == []


def test_one_form(spark):
    rows = [("t", "1", "الکتاب"), ("t", "2", "الكتاب"), ("t", "3", "bіn"), ("t", "4", "ibn bin"), ("t", "5", None), ("t", "6", ""), ("t", "7", "том Сборник"), ("t", "1", "الکتاب"), (None, "8", "ﻗ"), ("t", "9", "ﻗ" * 100_000), ("t", "10", "qһzx")]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], "tab string, row_key string, text string, base string, known string")
    got = {r.row_key: r.repaired for r in lookalikes.one_form(df).collect()}
    assert got == {"1": "الكتاب", "3": "bin", "9": "ق" * 100_000}
    again = spark.createDataFrame([("t", k, v) for k, v in got.items()], "tab string, row_key string, text string")
    assert lookalikes.one_form(again).count() == 0
    assert lookalikes.one_form(df.limit(0)).count() == 0


def garble(text, chain):
    _, kind, written, read, times = encodings.CHAINS[chain]
    table = {b: c for c, b in reversed(list(encodings._bytes_of(read).items()))}
    for _ in range(times):
        text = "".join(chr(b) if b < 0x80 else table[b] for b in text.encode(written))
    return text


def test_every_chain_is_undone():
    for k, (_, kind, written, _, _) in enumerate(encodings.CHAINS):
        if kind in ("multi", "single"):
            for text in (AR, "Ṣāliḥ – ʿĀʾisha", "Издание", "à é ü"):
                try:
                    bad = garble(text, k)
                except (UnicodeEncodeError, KeyError):
                    continue
                if kind == "multi":
                    assert encodings.undo(bad, k) == text
                else:
                    assert all(encodings.undo(w, k) in (v, w) for w, v in zip(bad.split(" "), text.split(" ")))


def test_found_and_restored(spark):
    rng = random.Random(6)
    pick = lambda t, n: " ".join(rng.choice(t.split()) for _ in range(n))
    rows = [(i, "s" if i % 3 else None, pick(AR if i % 2 else LATIN, 40)) for i in range(300)]
    true = {}
    by_name = {c[0]: k for k, c in enumerate(encodings.CHAINS)}
    for i, name in [(1000, "utf-8 read as cp1252"), (1001, "utf-8 read as cp1252 twice"), (1002, "cp1256 read as cp1252"), (1003, "iso-8859-6 read as cp1252"), (1004, "utf-8 read as cp1256"), (1005, "utf-8 read as cp1251")]:
        start, middle, end = pick(AR, 8), pick(AR, 9), pick(AR, 8)
        if name.startswith("iso"):
            middle = middle.replace("،", "")
        true[i] = f"{start} {middle} {end}"
        rows.append((i, "s", f"{start} {garble(middle, by_name[name])} {end}"))
    innocent = {2000: "Étude de l’âme, édition d’Ézanne, p. 12.", 2001: "Relação da viagem à Sãobira, cap. Â.", 2002: "قال: «هذا الباب». وكانت؟ ثم قال", 2003: "Издание Ветлугорья, том Ш.", 2004: None, 2005: ""}
    rows += [(i, "s", None if t is None else f"{pick(LATIN, 5)}. {t} {pick(LATIN, 5)}" if t else t) for i, t in innocent.items()]
    rows += [(1000, "s", rows[300][2]), (None, "s", "Ø§Ù„")]
    df = spark.createDataFrame([(*r, 0.5, "z") for r in rows], "id bigint, source string, text string, pool double, post string")
    got = {r.id: r.restored_text for r in encodings.restore(df).collect()}
    assert got == true
    assert encodings.restore(df.limit(0)).count() == 0


RUSSIAN = "КНИГА О ВОЙНЕ И МИРЕ ИЗДАНИЕ ВТОРОЕ КНИГИ СБОРНИКА ВОЙНА МИРА НАРОДОВ ГОРОДА ДОРОГА"


def test_capitals_that_leave_only_letters_of_another_script(spark):
    """Cyrillic capitals read as Arabic leave nothing but Arabic letters: the letters' order alone gives them away."""
    rng = random.Random(8)
    pick = lambda t, n: " ".join(rng.choice(t.split()) for _ in range(n))
    rows = [(i, "s", pick(RUSSIAN if i % 5 == 0 else AR, 40)) for i in range(400)]
    chain = {c[0]: k for k, c in enumerate(encodings.CHAINS)}["cp1251 read as cp1256"]
    bad = garble("КНИГА ВОЙНА МИРА", chain)
    assert not encodings.stretches(bad)
    rows += [(1000 + i, "s", f"{pick(AR, 6)} {bad} {pick(AR, 6)}") for i in range(3)]
    got = {r.id: r.restored_text for r in encodings.restore(spark.createDataFrame(rows, "id bigint, source string, text string")).collect()}
    assert set(got) == {1000, 1001, 1002} and all("КНИГА ВОЙНА МИРА" in t for t in got.values())


def test_latin_letters_read_as_arabic():
    chain = {c[0]: k for k, c in enumerate(encodings.CHAINS)}["cp1252 read as cp1256"]
    assert garble("Relação", chain) == "Relaçمo" and encodings.undo("Relaçمo", chain) == "Relação"


@pytest.mark.parametrize("word", ["ğüzel", "Ωμέγα", "漢字", "😀", "Ǧāmiʿ"])
@pytest.mark.parametrize("chain", [1, 3, 5])
def test_all_first_bytes(word, chain):
    try:
        bad = garble(word, chain)
    except KeyError:
        return
    assert encodings.undo(bad, chain) == word and encodings.stretches(bad) == [(0, len(bad))]


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.1"), reason="no test tables")
def test_what_the_choice_of_tokens_leaves_out(spark):
    """Of every fiftieth document, all tokens judged instead of the chosen ones: none is left out but ordinary words that happen to be bytes of another letter, with the punctuation after them."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").selectExpr("doc_id as id", "source", "text").where("text is not null")
    model = encodings._Model(encodings.clean_model(docs))
    tokens = encodings._Tokens(model)
    missed = []
    for r in docs.where("id % 50 = 0").collect():
        chosen = tokens.read([r.text])[0]
        for t in encodings._split(r.text) - chosen - {""}:
            own = model(t)
            for k in range(1, encodings.K):
                back = encodings.undo(t, k)
                if back != t and model(back) - 4.0 * back.count(encodings.LOST) > own and encodings._ORDINARY.search(t):
                    missed.append((r.id, t, back))
    assert not missed, missed[:10]
