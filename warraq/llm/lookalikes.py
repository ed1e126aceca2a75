"""One stored form for texts that look the same, by script-aware repair.

Three kinds of characters are brought to the ordinary form. Those whose ordinary form is fixed by their identity (full-width and
presentation forms, special spaces, marks that Unicode composes with their letter) are replaced wherever they stand. Invisible
ones are dropped where that changes no joining of letters. Look-alike letters and digits of another script are substituted only in
tokens of mixed script, towards the token's dominant script, and only when the result exists in the corpus vocabulary, which is
gathered over all texts (or, for words that occur once, when all its pairs of neighbouring letters do). Vowel marks, tatweel, raised figures, one-character honorifics and words wholly in another script stay.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from warraq.plans.materialize import cut

# Characters and what they look like.
SPACES = "\u00A0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200A\u202F\u205F\u3000\t"
BREAKS = "\u0085\u2028\u2029\u000b\u000c"
INVISIBLE = "\u00AD\u034F\u061C\u180E\u200B\u200E\u200F\u202A\u202B\u202C\u202D\u202E\u2060\u2061\u2062\u2063\u2064\u2066\u2067\u2068\u2069\uFE0E\uFE0F\uFEFF"
JOINER, NON_JOINER = "\u200D", "\u200C"
ARABIC_LIKE = {"ی": "ي", "ک": "ك", "ہ": "ه", "ھ": "ه", "ە": "ه"}
FINAL_YEH = {"ی": "ى"}
DIGIT_LIKE = {"۰": "٠", "۱": "١", "۲": "٢", "۳": "٣", "۷": "٧", "۸": "٨", "۹": "٩"}
LATIN_LIKE = {
    **dict(zip("АВЕЅІЈКМНОРСТХУаеѕіјорсхуԁһԛԝ", "ABESIJKMHOPCTXYaesijopcxydhqw")),
    **dict(zip("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧονιϲ", "ABEZHIKMNOPTYXovic")),
    "ӏ": "l", "Ӏ": "I", "Α": "A", "Ϳ": "J", "Ү": "Y", "ү": "y",
}
NOT_JOINING_LEFT = set("اأإآٱءدذرزوؤةى")
PUNCTUATION_LIKE = {"\u2010": "-", "\u2011": "-", "\u2024": ".", "\u037E": ";"}

_IDENTITY = "".join(map(re.escape, SPACES + BREAKS + "".join(PUNCTUATION_LIKE)))
_CLASS = f"{_IDENTITY}{re.escape(INVISIBLE)}\u200C\u200D\uFB50-\uFDCF\uFDF0-\uFDF9\uFE70-\uFEFC\uFF01-\uFF5E\u0300-\u036F\u0653-\u0655"
_LIKE = "".join([*ARABIC_LIKE, *DIGIT_LIKE, *LATIN_LIKE])
#: Texts without any of these are as they should be; the test runs in the scan's stage, on Spark's side.
ODD = f"[{_CLASS}{_LIKE}]"
#: Texts of these alone, the most, are as they should be too; few ranges, the commonest first, and none of them in ODD.
USUAL = "[ء-ي -~\n\r\u064b-\u0652٠-٩،؛؟«»‘’“”–—…ĀāĪīŪūḌḍḤḥṢṣṬṭʿʾ\ufdfa]"
_TOKEN = re.compile(r"[^\W_]+(?:[\u0610-\u061A\u064B-\u065F\u0670ـʿʾ'’]+[^\W_]+)*[\u064B-\u065F\u0670]*")
_PLAIN = re.compile(f"{USUAL}*")
_MARKS = re.compile(r"[\u0610-\u061A\u064B-\u065F\u0670ـ]")


def _arabic(c: str) -> bool:
    return "ؠ" <= c <= "ي" or "ٮ" <= c <= "ۓ" or c == "ە"


def script(c: str) -> str:
    """arabic, latin, greek, cyrillic, arabic digit, or '' for what belongs to all scripts."""
    o = ord(c)
    if 0x0660 <= o <= 0x0669 or 0x06F0 <= o <= 0x06F9:
        return "arabic digit"
    if not c.isalpha() or 0x2B0 <= o <= 0x2FF:
        return ""
    if o < 0x250 or 0x1E00 <= o <= 0x1EFF or o in (0x251, 0x261):
        return "latin"
    if 0x370 <= o < 0x400:
        return "greek"
    if 0x400 <= o < 0x530:
        return "cyrillic"
    return "arabic" if _arabic(c) else "other"


def plain(text: str) -> str:
    """The first two kinds repaired: identity and invisibility."""
    if _PLAIN.fullmatch(text):
        return text
    out = []
    n = len(text)
    for i, c in enumerate(text):
        o = ord(c)
        if c in SPACES:
            out.append(" ")
        elif c in BREAKS:
            out.append("\n")
        elif c in INVISIBLE:
            pass
        elif c in (JOINER, NON_JOINER):
            if not _drops(text, i, n):
                out.append(c)
        elif 0xFF01 <= o <= 0xFF5E:
            out.append(chr(o - 0xFEE0))
        elif 0xFB50 <= o <= 0xFDCF or 0xFE70 <= o <= 0xFEFC or 0xFDF0 <= o <= 0xFDF9:
            out.append(c if 0xFDF0 <= o <= 0xFDF9 else unicodedata.normalize("NFKC", c).lstrip(" "))
        elif c in PUNCTUATION_LIKE:
            out.append(PUNCTUATION_LIKE[c])
        else:
            out.append(c)
    return _composed("".join(out))


def _near(text: str, at: int, step: int, n: int) -> str:
    at += step
    while 0 <= at < n and (text[at] in INVISIBLE or text[at] in (JOINER, NON_JOINER) or _MARKS.match(text[at]) and text[at] != "ـ"):
        at += step
    return unicodedata.normalize("NFKC", text[at])[-1 if step < 0 else 0] if 0 <= at < n else ""


def _drops(text: str, i: int, n: int) -> bool:
    """Whether a joiner or non-joiner at i can go without changing how the letters beside it join."""
    before, after = _near(text, i, -1, n), _near(text, i, 1, n)
    joins = bool(before) and (_arabic(before) or before == "ـ") and before not in NOT_JOINING_LEFT and bool(after) and (_arabic(after) or after == "ـ") and after != "ء"
    if text[i] == NON_JOINER:
        return not joins
    left = bool(before) and _arabic(before) and before not in NOT_JOINING_LEFT
    right = bool(after) and _arabic(after) and after != "ء"
    return joins or not (left or right)


def _composed(text: str) -> str:
    """A base and the marks right after it as one letter where Unicode has it; all else in its place."""
    if not re.search("[\u0300-\u036F\u0653-\u0655]", text):
        return text

    def one(m: re.Match) -> str:
        stay, base = [], m[0][0]
        for mark in sorted(m[0][1:], key=unicodedata.combining) if unicodedata.name(base, "").startswith("LATIN") else m[0][1:]:
            both = unicodedata.normalize("NFC", base + mark)
            if len(both) == 1 and (mark < "Ͱ" or mark in "\u0653\u0654\u0655"):
                base = both
            else:
                stay.append(mark)
        return base + "".join(stay)

    return re.sub(r"[^\W\d_][\u0300-\u036F\u064B-\u0655]+", one, text)


def candidates(text: str) -> list[tuple[int, int, str]]:
    """(start, end, repaired) of tokens in which letters of another script look like the dominant one's."""
    found = []
    tokens = list(_TOKEN.finditer(text))
    kinds = [[script(c) for c in m[0]] for m in tokens]
    for k, (m, of) in enumerate(zip(tokens, kinds)):
        token = m[0]
        if not any(c in _LIKE for c in token):
            continue
        count = {s: of.count(s) for s in set(of) if s and s != "arabic digit"}
        foreign = count.get("cyrillic", 0) + count.get("greek", 0)
        new = token
        if all(s == "arabic digit" for s in of):
            new = "".join(DIGIT_LIKE.get(c, c) for c in token)
        elif count.get("arabic"):
            if all("ء" <= c <= "ي" or c in ARABIC_LIKE or _MARKS.match(c) for c in token):
                last = max((i for i, c in enumerate(token) if not _MARKS.match(c)), default=-1)
                new = "".join(FINAL_YEH.get(c, ARABIC_LIKE.get(c, c)) if i == last else ARABIC_LIKE.get(c, c) for i, c in enumerate(token))
        elif foreign and all(s in ("", "latin", "arabic digit") or c in LATIN_LIKE for c, s in zip(token, of)):
            own = count.get("latin", 0)
            # Wholly foreign but look-alike throughout: mixed with the words beside it, if these are Latin and it is one letter.
            beside = [kinds[j] for j in (k - 1, k + 1) if 0 <= j < len(tokens) and not re.search(r"[\n()\[\]]", text[min(m.end(), tokens[j].end()) : max(m.start(), tokens[j].start())])]
            latin = sum("latin" in b for b in beside)
            alien = sum("latin" not in b and ("cyrillic" in b or "greek" in b) for b in beside)
            if own or (len(token) == 1 and latin and not alien):
                new = "".join(LATIN_LIKE.get(c, c) for c in token)
        if new != token:
            found.append((m.start(), m.end(), new))
    return found


def _first(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        done = [plain(t) for t in b["text"]]
        yield pd.DataFrame({"tab": b["tab"], "row_key": b["row_key"], "text": b["text"], "base": done, "wanted": [sorted({w for *_, w in candidates(t)}) for t in done]})


@F.pandas_udf(StringType())
def _second(base: pd.Series, known: pd.Series) -> pd.Series:
    def one(text: str, words) -> str:
        have = set(words) if words is not None else set()
        for start, end, new in reversed(candidates(text)):
            if new in have:
                text = text[:start] + new + text[end:]
        return text

    return pd.Series([one(t, w) for t, w in zip(base, known)], dtype=object)


def vocabulary(texts: DataFrame) -> DataFrame:
    """Distinct words of all texts (column word), as they are stored."""
    word = r"[\p{L}\p{Nd}]+(?:[\u0610-\u061A\u064B-\u065F\u0670ـʿʾ'’]+[\p{L}\p{Nd}]+)*[\u064B-\u065F\u0670]*"
    return texts.select(F.explode(F.array_distinct(F.expr(f"regexp_extract_all(text, r\"{word}\", 0)"))).alias("word")).distinct()


def one_form(texts: DataFrame) -> DataFrame:
    """tab, row_key, text, repaired of every row whose text changes; all other texts already are in the one form.

    texts: tab, row_key, text. Null and empty texts don't change. A row without tab or row_key doesn't come; a
    repeated row counts once. Applied to its own result nothing changes.
    """
    texts = texts.select("tab", "row_key", "text").where("text is not null and tab is not null and row_key is not null")
    odd = texts.where(F.col("text").rlike(USUAL.replace("[", "[^", 1)) & F.col("text").rlike(ODD)).dropDuplicates()
    first = cut(odd.mapInPandas(_first, "tab string, row_key string, text string, base string, wanted array<string>"), "first")
    wanted = first.select(F.explode("wanted").alias("word")).distinct()
    # Digits have no vocabulary: a number is a word of its script whatever its digits.
    numbers = wanted.where(F.col("word").rlike("^[٠-٩]+$"))
    words = cut(vocabulary(texts), "vocabulary")
    whole = cut(wanted.join(words, "word", "left_semi").unionByName(numbers).distinct(), "known")
    # A name that occurs once can't be in the vocabulary; it is taken if every two neighbouring letters of it are, the first and the last at their place in a word.
    parts = F.explode(F.expr("transform(sequence(1, length(word) + 1), i -> substring(concat('^', word, '$'), i, 2))")).alias("part")
    rest = wanted.join(whole, "word", "left_anti").where("length(word) > 1").select("word", parts)
    unknown = rest.join(words.select(parts).distinct(), "part", "left_anti").select("word").distinct()
    known = whole.unionByName(rest.select("word").distinct().join(unknown, "word", "left_anti"))
    per_row = first.select("tab", "row_key", "text", F.explode("wanted").alias("word")).join(known, "word").groupBy("tab", "row_key", "text").agg(F.collect_set("word").alias("known"))
    both = first.join(per_row, ["tab", "row_key", "text"], "left")
    both = both.withColumn("repaired", F.when(F.col("known").isNull(), F.col("base")).otherwise(_second("base", "known")))
    return both.where("repaired <> text").select("tab", "row_key", "text", "repaired")
