"""Scans: page records, HTML pages and tables of contents, result files; schemas that tolerate missing columns."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from warraq.functions import normalise as N

PAGE = "source string, book_id string, web_page int, printed_juz int, printed_page int, url string, paras array<string>"


def conform(df: DataFrame, schema: str) -> DataFrame:
    """The columns of schema, in its order and types; missing ones as nulls."""
    wanted = StructType.fromDDL(schema)
    return df.select(*((F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in wanted))


def read_pages(spark: SparkSession, path: str, sources: list[str] | None = None) -> DataFrame:
    """SRC1, SRC2: page records from JSON Lines; blank lines are skipped, broken ones too, absent fields are null."""
    df = spark.read.schema(PAGE).option("mode", "DROPMALFORMED").json(path)
    return df if sources is None else df.where(F.col("source").isin(*sources))


def paragraphs(pages: DataFrame) -> DataFrame:
    """One row per paragraph of page records."""
    return pages.select("source", "book_id", "web_page", "printed_juz", "printed_page", "url", F.posexplode("paras").alias("para_idx", "text"))


def read_results(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """SRC7, SRC8: a folder of JSON arrays, with (book, number) from names like book_001.rb.json; unreadable files give one row with bad = true."""
    raw = spark.read.text(path, wholetext=True).select(F.col("value"), F.col("_metadata.file_name").alias("file"))
    rows = raw.select("file", F.from_json("value", f"array<struct<{schema}>>").alias("r"))
    out = rows.select("file", F.col("r").isNull().alias("bad"), F.explode_outer("r").alias("r"))
    name = r"^(.+)_(\d{3})\.rb\.json$"
    return out.select("file", "bad", F.regexp_extract("file", name, 1).alias("book"), F.regexp_extract("file", name, 2).cast("int").alias("number"), "r.*")


def review_blocks(text: Column) -> Column:
    """SRC9: blocks led by "### Q source#number", with the ids of their candidate lines "[id] name"."""
    block = F.filter(F.split(text, r"(?m)^### Q "), lambda b: b != "")
    return F.transform(
        block,
        lambda b: F.struct(
            F.regexp_extract(b, r"^([^#\s]+)#(\d+)", 1).alias("source"),
            F.regexp_extract(b, r"^([^#\s]+)#(\d+)", 2).cast("int").alias("number"),
            F.transform(F.regexp_extract_all(b, F.lit(r"(?m)^\s*\[(\d+)\]"), 1), lambda x: x.cast("int")).alias("candidates"),
        ),
    )


def toc_links(html: Column, book: str) -> Column:
    """SRC6: (page, title) of every link to a page of the book, titles of 1 to 150 characters."""
    pattern = rf'href="[^"]*/book/{re.escape(book)}/(\d+)[^"]*"[^>]*>([^<]{{1,150}})<'
    pages, titles = F.regexp_extract_all(html, F.lit(pattern), 1), F.regexp_extract_all(html, F.lit(pattern), 2)
    return F.zip_with(pages, titles, lambda p, t: F.struct(p.cast("int").alias("page"), F.trim(t).alias("title")))


class _Page(HTMLParser):
    """Paragraphs of the container: a div of class nass, or an article; link buttons are left out."""

    def __init__(self, container: str):
        super().__init__(convert_charrefs=True)
        self.container, self.depth, self.skip = container, 0, 0
        self.paras: list[list[str]] = []
        self.open, self.seen, self.title, self.in_title, self.number = False, False, "", False, None

    def _is_container(self, tag, attrs):
        return (tag == "article") if self.container == "article" else (tag == "div" and self.container in (attrs.get("class") or "").split())

    def handle_starttag(self, tag, attrs):
        attrs = dict(attrs)
        if (n := attrs.get("data-page-num")) and n.isdigit() and int(n):
            self.number = int(n)
        if tag == "title":
            self.in_title = True
        if self.depth and tag in ("div", "article"):
            self.depth += 1
        elif not self.depth and self._is_container(tag, attrs):
            self.depth, self.seen = 1, True
        if self.depth and tag == "p":
            self.open = True
            self.paras.append([])
        if self.depth and (self.skip or tag in ("script", "style") or tag == "a" and "btn_tag" in (attrs.get("class") or "").split()):
            self.skip += tag in ("script", "style", "a")

    def handle_endtag(self, tag):
        if tag == "title":
            self.in_title = False
        if self.skip and tag in ("script", "style", "a"):
            self.skip -= 1
        elif tag == "p":
            self.open = False
        elif self.depth and tag in ("div", "article"):
            self.depth -= 1

    def handle_data(self, data):
        if self.in_title:
            self.title += data
        elif self.open and self.depth and not self.skip:
            self.paras[-1].append(data)


#: Words of paragraphs that aren't text, in the dialect "article". Fixed values.
MARKS = ("ALDORAR", "copyright")
_VOLUME = re.compile(r"ج(\d+)\s*-\s*ص(\d+)")


def parse_page(html: str, container: str = "nass") -> tuple[int | None, int | None, list[str]] | None:
    """Volume, printed page and paragraphs; None without the container."""
    page = _Page(container)
    page.feed(html)
    page.close()
    if not page.seen and container == "article":
        page = _Page("")
        page.depth, page.seen = 1, True
        page.feed(html)
        page.close()
    if not page.seen:
        return None
    paras = [" ".join(" ".join(p).split()) for p in page.paras]
    if container == "article":
        paras = [p for p in paras if MARKS[0] not in p and MARKS[1] not in p.lower()]
    m = _VOLUME.search(page.title)
    return int(m[1]) if m else None, page.number, [p for p in paras if p]


def html_pages(files: DataFrame, container: str = "nass") -> DataFrame:
    """SRC3, SRC4: page records of HTML files (source, book_id, web_page, url, html). Pages without the container, and null ones, are dropped.

    The dialect "article" takes the whole page where it has no article, and leaves out paragraphs with a word of MARKS.
    """

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            got = [parse_page(h, container) if isinstance(h, str) else None for h in b["html"]]
            b = b.assign(printed_juz=pd.array([g[0] if g else None for g in got], dtype="Int32"), printed_page=pd.array([g[1] if g else None for g in got], dtype="Int32"), paras=[g[2] if g else None for g in got])
            yield b.loc[[g is not None for g in got], ["source", "book_id", "web_page", "printed_juz", "printed_page", "url", "paras"]]

    return files.select("source", "book_id", "web_page", "url", "html").mapInPandas(of, PAGE)


def page_titles(files: DataFrame) -> DataFrame:
    """SRC4: source, web_page and the title that each HTML file gives itself, blanks collapsed; null without one."""
    title = N.collapse(F.regexp_replace(F.regexp_extract("html", r"(?is)<title[^>]*>(.*?)</title>", 1), "<[^>]*>", " "))
    return files.select("source", "web_page", F.nullif(title, F.lit("")).alias("title"))


class _Toc(HTMLParser):
    def __init__(self, book: str):
        super().__init__(convert_charrefs=True)
        self.link = re.compile(rf"/book/{re.escape(book)}/(\d+)")
        self.depth, self.at, self.rows = -1, None, []

    def handle_starttag(self, tag, attrs):
        if tag == "ul":
            self.depth += 1
        elif tag == "a" and (m := self.link.search(dict(attrs).get("href") or "")):
            self.at = [len(self.rows), int(m[1]), "", max(self.depth, 0)]

    def handle_endtag(self, tag):
        if tag == "ul":
            self.depth -= 1
        elif tag == "a" and self.at:
            self.at[2] = " ".join(self.at[2].split())
            self.rows.append(tuple(self.at))
            self.at = None

    def handle_data(self, data):
        if self.at:
            self.at[2] += data


def nested_toc(files: DataFrame) -> DataFrame:
    """SRC5: the pre-order list (i, page, title, depth) of nested lists, per row (book_id, html); only links to the book itself count."""

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for book, html in zip(b["book_id"], b["html"]):
                if isinstance(html, str):
                    toc = _Toc(book)
                    toc.feed(html)
                    out += [(book, *r) for r in toc.rows]
            yield pd.DataFrame(out, columns=["book_id", "i", "page", "title", "depth"])

    return files.select("book_id", "html").mapInPandas(of, "book_id string, i int, page int, title string, depth int")
