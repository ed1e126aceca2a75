r"""Normalisation profiles of Arabic text: derived keys and shadow columns; the stored text is never changed.

The profiles disagree on purpose (on teh marbuta, on marks, on what is dropped), as each serves another comparison. All are
column expressions: no Python runs per row. White space means Unicode's here, also in regular expressions of Java and RE2, where
``\s`` doesn't.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Code points that the profiles drop, and letters that they take for one another.
SPACE = r"[\s\x{0B}\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"
MARKS = r"[\x{064B}-\x{0652}\x{0670}]"
MARKS_TATWEEL = r"[\x{064B}-\x{0652}\x{0670}\x{0640}]"
MARKS_QURAN = r"[\x{064B}-\x{0652}\x{0670}\x{0640}\x{06D6}-\x{06ED}]"
MARKS_ALL = r"[\x{0610}-\x{061A}\x{064B}-\x{065F}\x{0670}\x{06D6}-\x{06ED}\x{0640}]"
MARKS_TITLE = r"[\x{064B}-\x{065F}\x{0670}\x{0640}]"
PRESENTATION = r"[\x{FB50}-\x{FDFF}\x{FE70}-\x{FEFF}\x{200B}-\x{200F}\x{061C}]"
PRESENTATION_FORMS = r"[\x{FB50}-\x{FDFF}\x{FE70}-\x{FEFF}]"
MATCH_PUNCTUATION = r"[()\[\]«»{}:،؛.,!؟?\-–—_\x{0640}\x{FD3E}\x{FD3F}\x{FDF0}-\x{FDFF}]"
DIGITS, PERSIAN_DIGITS, ASCII_DIGITS = "٠١٢٣٤٥٦٧٨٩", "۰۱۲۳۴۵۶۷۸۹", "0123456789"
#: Dropped one after another in this order.
HONORIFICS = (
    "صلي الله عليه وسلم", "صلي الله عليه واله وسلم", "صلي الله عليه", "عليه السلام", "عليها السلام", "عليهما السلام",
    "رضي الله عنه", "رضي الله عنها", "رضي الله عنهما", "رضي الله عنهم", "رضي الله عنهن", "رضي الله", "رضوان الله عليه",
    "رحمة الله عليه", "رحمه الله", "غفر الله له", "اسلام رضي الله عنه", "امراه", "امراه ا", "زوجه", "زوجه النبي",
)
APOSTROPHES = "‘’ʼ`´ʿʾ"


def collapse(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, SPACE, " "))


def ascii_digits(c: Column) -> Column:
    return F.translate(c, DIGITS + PERSIAN_DIGITS, ASCII_DIGITS * 2)


def _drop(c: Column, what: str) -> Column:
    return F.regexp_replace(c, what, "")


def search_key(c: Column) -> Column:
    """For full-text search over reports and chapter titles."""
    return collapse(F.translate(_drop(c, MARKS_QURAN), "أإآٱىة", "اااايه"))


def name_column(c: Column) -> Column:
    """For stored normalised names; alef wasla stays."""
    return collapse(F.translate(_drop(c, MARKS_ALL), "أإآىة", "ااايه"))


def without_vowels(c: Column) -> Column:
    """For the test of sub-headings; only vowel marks go."""
    return _drop(c, MARKS)


def verse_key(c: Column) -> Column:
    """For matching verses; teh marbuta becomes teh."""
    return collapse(F.translate(_drop(c, MARKS_QURAN), "أإآىة", "ااايت"))


def block_key(c: Column) -> Column:
    """For displayed verse blocks; letters stay."""
    return collapse(_drop(c, MARKS_TATWEEL))


def heading_text(c: Column) -> Column:
    """N6 as stored: marks go, figures become ASCII."""
    return collapse(ascii_digits(_drop(c, MARKS_ALL)))


def heading_key(c: Column) -> Column:
    """N6 for matching: also one alef, no punctuation, no figures."""
    letters = F.translate(F.regexp_replace(heading_text(c), MATCH_PUNCTUATION, " "), "أإآةى", "اااهي")
    return collapse(F.regexp_replace(letters, "[0-9]+", " "))


def numbered_text(c: Column) -> Column:
    """For numbered headings; white space stays."""
    return F.translate(_drop(c, MARKS_ALL), DIGITS, ASCII_DIGITS)


def numbered_name(c: Column) -> Column:
    """N7 for names."""
    return collapse(F.translate(numbered_text(c), "أإآةى", "اااهي"))


def person_key(c: Column) -> Column:
    """For persons' names; letters only, servant names in two words, honorifics dropped."""
    letters = F.translate(_drop(F.regexp_replace(c, PRESENTATION, " "), MARKS_ALL), "أإآٱةىؤئ", "ااااهيوي")
    words = F.regexp_replace(F.regexp_replace(letters, r"[^\x{0621}-\x{064A}\s]", " "), r"(^|\s)عبدال", "$1عبد ال")
    for phrase in HONORIFICS:
        words = F.replace(words, F.lit(phrase), F.lit(" "))
    return collapse(words)


def title_words(c: Column) -> Column:
    """The words of a chapter title."""
    letters = F.translate(_drop(F.regexp_replace(c, PRESENTATION_FORMS, " "), MARKS_TITLE), "أإآٱءةىؤئ", "اااااهيوي")
    text = collapse(F.regexp_replace(letters, r"[^\p{L}\p{N}]+", " "))
    return F.filter(F.split(text, " "), lambda w: w != "")


def snippet_text(c: Column) -> Column:
    """For what reviewers read; letters stay."""
    return collapse(_drop(F.regexp_replace(c, PRESENTATION_FORMS, " "), MARKS_ALL))


def pair_key(c: Column) -> Column:
    """For pairing rows of two editions."""
    letters = F.translate(_drop(c, MARKS_ALL), "أإآىة", "ااايه")
    return collapse(F.regexp_replace(letters, r"[\s()\[\]«»:،؛.,\-–—]+", " "))


def alias_key(c: Column) -> Column:
    """For aliases; digits ASCII, lower case, letters and figures only."""
    return F.regexp_replace(F.lower(search_key(ascii_digits(c))), r"[^\p{L}\p{N}]+", "")


def canonical_name(c: Column) -> Column:
    """N12 for transliterated names: one apostrophe, lower case."""
    return collapse(F.lower(F.translate(c, APOSTROPHES, "'" * len(APOSTROPHES))))


def tokens(c: Column) -> Column:
    """Runs of letters and figures: the same in Python, Java and RE2."""
    return F.regexp_extract_all(c, F.lit(r"([\p{L}\p{N}_]+)"), 1)
