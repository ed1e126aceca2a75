"""What kind of paragraph a text is: headings, verse lines, genealogies, footnotes, numbered entries. Column predicates; null for null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from warraq.functions import normalise as N

# How headings begin, in stored spelling and in the spelling of the name profile.
SUB_HEADINGS = (
    "القول", "ذكر", "باب", "فصل", "مسألة", "تفسير", "المعنى", "قوله", "البلاغة", "البلاغه", "الفائدة", "الفائده", "اللغة", "اللغه",
    "تنبيه", "المناسبة", "المناسبه", "سبب النزول", "الإعراب", "الاعراب", "فائدة", "فائده", "لطيفة", "لطيفه",
)
LATIN_SUB_HEADINGS = ("tafsir", "ayat")
ORNAMENTS = r"^[*\-–—•· ]+"
HEADING_WORDS = (
    "غزوه", "سريه", "ذكر", "حديث", "امر", "قصه", "خبر", "باب", "فصل", "شعر", "سنه", "مقتل", "اسلام", "هجره", "وفاه", "بيعه", "خطبه", "تسميه", "القول",
)
NARRATION = ("قال:", "حدثنا", "اخبرنا")
KEYWORD_HEADINGS = (
    "غزوة", "سرية", "أمر", "حديث", "ذكر", "شأن", "قصة", "خبر", "إسلام", "هجرة", "وفاة", "مقتل", "بعث", "عمرة", "حجة", "بيعة", "فتح", "يوم",
)
UNITS = {
    "واحده": 1, "احدي": 1, "اثنتين": 2, "اثنتي": 2, "اثنين": 2, "ثلاث": 3, "اربع": 4, "خمس": 5, "ست": 6, "سبع": 7, "ثمان": 8, "ثماني": 8, "تسع": 9, "عشر": 10,
}
TENS = {"عشرين": 20, "ثلاثين": 30, "اربعين": 40}
ORDINALS = ("الاولي", "الثانيه", "الثالثه", "الرابعه", "الخامسه", "السادسه", "السابعه", "الثامنه", "التاسعه", "العاشره")
FOREIGN = r"[\x{0370}-\x{03FF}\x{0400}-\x{04FF}\x{0590}-\x{05FF}\x{0E00}-\x{0E7F}\x{3000}-\x{9FFF}\x{FF00}-\x{FFEF}]"


def strip(c: Column) -> Column:
    """Without white space of Unicode at both ends."""
    return F.regexp_replace(c, f"^{N.SPACE}|{N.SPACE}$", "")


def _bound(value: Column, of) -> Column:
    """of(value), with the value made once a row: a filter has no common subexpressions, and would make it anew wherever it is named."""
    return F.get(F.transform(F.array(value), of), F.lit(0))


def is_blank(c: Column) -> Column:
    return strip(c) == ""


def is_sub_heading(c: Column) -> Column:
    """At most 70 code points without vowel marks, in brackets or led by a keyword."""

    def of(bare: Column) -> Column:
        bracketed = bare.rlike(r"(?s)^\(.*\)$") | bare.rlike(r"(?s)^\[.*\]$")
        led = bare.rlike("^(" + "|".join(SUB_HEADINGS) + ")") | F.lower(bare).rlike("^(" + "|".join(LATIN_SUB_HEADINGS) + ")")
        return (bare != "") & (bracketed | led)

    return _bound(strip(N.without_vowels(c)), lambda s: (F.length(s) <= 70) & of(strip(F.regexp_replace(s, ORNAMENTS, ""))))


def is_heading(c: Column) -> Column:
    """Short and in brackets or led by a heading word; up to 120 code points if it neither narrates nor breaks off."""

    def of(t: Column) -> Column:
        led = F.split(t, " ", 2)[0].isin(*HEADING_WORDS) | t.startswith("ما نزل")
        bracketed = t.rlike(r"^\(.*[):]$") | t.rlike(r"^\[.*\]$")
        long = ~t.rlike("|".join(NARRATION)) & ~t.rlike('[«»"،,]$')
        return (t != "") & (F.length(t) <= 120) & (led | bracketed) & ((F.length(t) <= 70) | long)

    return _bound(N.collapse(F.regexp_replace(N.name_column(c), "صلي الله عليه وسلم|ﷺ|--", " ")), of)


def is_verse_line(c: Column) -> Column:
    """Two hemistichs with dots between them."""
    return c.contains(" ... ") | c.contains(" … ")


def is_genealogy(c: Column) -> Column:
    """C4: five tokens or more, a "son of" in the first four and two in the first eight."""

    def of(t: Column) -> Column:
        n = lambda k: F.size(F.filter(F.slice(t, 1, k), lambda x: x == "بن"))
        return (F.size(t) >= 5) & (n(4) >= 1) & (n(8) >= 2)

    # What comes after the eighth word is one piece.
    return _bound(F.split(N.name_column(c), " ", 9), of)


def is_footnote(c: Column) -> Column:
    """Led by a number in brackets that match."""
    return c.rlike(r"^[\s\x{A0}]*(\(\d+\)|\[\d+\])")


def entry_number(c: Column) -> Column:
    """The number of a numbered entry heading; null without one."""
    return F.nullif(F.regexp_extract(N.numbered_text(c), r"^\[?\s*\(?\s*(\d+)\s*[-)\]]\s*(.+)$", 1), F.lit("")).cast("bigint")


def is_keyword_heading(c: Column) -> Column:
    """At most 60 code points, no verse, no footnote; ends with a colon or begins with a keyword."""

    def of(t: Column) -> Column:
        led = F.split(t, " ", 2)[0].isin(*KEYWORD_HEADINGS)
        head = F.when(led & t.contains(":"), F.split(t, ":", 2)[0]).otherwise(t)
        return (t != "") & (F.length(head) <= 60) & ~t.contains(" ... ") & ~t.rlike(r"^\(?[0-9]+\)") & (t.endswith(":") | led)

    return _bound(N.heading_text(c), of)


def same_prefix(paragraph: Column, title: Column, n: int = 15) -> Column:
    """The first n code points of the keys (fewer, if a key is shorter) are equal."""
    p, t = N.heading_key(paragraph), N.heading_key(title)
    k = F.least(F.lit(n), F.length(p), F.length(t))
    return (k > 0) & (F.substring(p, F.lit(1), k) == F.substring(t, F.lit(1), k))


def has_foreign_script(c: Column) -> Column:
    """Greek, Cyrillic, Hebrew, Thai, CJK or full-width characters."""
    return c.rlike(FOREIGN)


def year_of_title(c: Column) -> Column:
    """The year (1 to 40) that a chapter title names in words, or null."""
    words = F.split(N.heading_key(c), " ")
    table = lambda d: F.create_map(*(F.lit(x) for kv in d.items() for x in kv))
    ordinals = table({w: i + 1 for i, w in enumerate(ORDINALS)})
    units, tens = table(UNITS), table(TENS)
    year_at = F.array_position(words, "السنه").cast("int")
    named = F.when((year_at > 0) & F.array_contains(words, "الهجره"), F.element_at(ordinals, F.get(words, year_at)))
    first = F.when(F.array_contains(words, "اول") & F.array_contains(words, "سنه") & F.array_contains(words, "الهجره") & (words[0] != "سنه"), 1)
    # Number words after the leading word for year; the sum stops at the first other word.
    rest = F.transform(F.filter(F.slice(words, 2, 100), lambda w: w != "و"), lambda w: F.when((F.length(w) > 1) & w.startswith("و") & ~F.array_contains(F.map_keys(units), w), F.substring(w, F.lit(2), F.length(w))).otherwise(w))
    start = F.struct(F.lit(0).alias("sum"), F.lit(False).alias("done"), F.lit(False).alias("unit"))

    def step(s: Column, w: Column) -> Column:
        teen = s.unit & (w == "عشره")
        value = F.coalesce(F.element_at(units, w), F.element_at(tens, w), F.when(teen, 10))
        stop = s.done | value.isNull()
        return F.struct((s.sum + F.when(stop, 0).otherwise(value)).alias("sum"), stop.alias("done"), (~stop & F.array_contains(F.map_keys(units), w)).alias("unit"))

    total = F.aggregate(rest, start, step, lambda s: s.sum)
    return F.coalesce(named, first, F.when((words[0] == "سنه") & total.between(1, 40), total))
