"""Cutting oversized items at natural boundaries, by pointer doubling.

Every item is a line of positions 0..length with boundaries on it, each of a grade: the higher, the more natural a cut there.
Between boundaries farther apart than the grid step, boundaries of grade 0 (a hard cut) are laid on the grid, so some cut is
always within reach. Each boundary p is joined to its farthest legal successor: a piece from p ends at end(p), the farthest
boundary of the best grade in (p + limit / 2, p + limit], and the next piece starts at next(p), the last boundary at or before
end(p) - overlap. next is one table for all items. Squaring it (next o next, and so on) doubles the reach of a row; meanwhile
the starts reached so far are joined to each power, which doubles their number. All cuts of all items are there after
log2(most pieces of an item) rounds, wherever they lie.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from warraq.plans.materialize import cut

#: Cuts after these, the best first. Fixed values.
TEXT_GRADES = (
    (4, re.compile(r"\n+")),
    (3, re.compile(r"[.!?؟][»\"')\]”]*[¹²³]?\s+")),
    (2, re.compile(r"[،؛,;:][»\"')\]”]*\s+|\s\.\.\.\s+")),
    (1, re.compile(r"\s+")),
)
MAX_ROUNDS = 40
#: Positions of one item that a task takes together, at least.
BLOCK = 1 << 15


def _text_boundaries(grid: int):
    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for item, text in zip(b["item_key"], b["text"]):
                n = len(text)
                grade = np.full(n + 1, -1, dtype=np.int8)
                for g, pattern in reversed(TEXT_GRADES):
                    at = [m.end() for m in pattern.finditer(text)]
                    grade[at] = g
                grade[0] = grade[n] = 5
                at = np.flatnonzero(grade >= 0)
                wide = np.flatnonzero(np.diff(at) > grid)
                for a, z in zip(at[wide], at[wide + 1]):
                    grade[a + grid : z : grid] = 0
                at = np.flatnonzero(grade >= 0)
                for k in range(0, len(at), 50_000):
                    part = at[k : k + 50_000]
                    yield pd.DataFrame({"item_key": item, "pos": part, "grade": grade[part], "length": n})

    return of


def text_boundaries(texts: DataFrame, grid: int) -> DataFrame:
    """Boundaries of texts (item_key, text): after line breaks, sentences, clauses and words."""
    return texts.select("item_key", "text").mapInPandas(_text_boundaries(grid), "item_key bigint, pos bigint, grade int, length bigint")


def cut_pieces(boundaries: DataFrame, limit: int, overlap: int) -> DataFrame:
    """Pieces of every item longer than limit.

    boundaries: item_key bigint, pos, grade, length; 0 and length are boundaries of every item, and no two neighbours are more
    than limit / 2 - overlap apart. Result: item_key, piece_no (from 0), start, end: [start, end) is at most limit long;
    neighbours overlap by at least ``overlap`` and by no more than the next boundary asks for. Items of at most ``limit`` give
    no row, repeated boundaries count once.
    """
    if not 0 <= overlap < limit / 2:
        raise ValueError("overlap must be less than half the limit")
    b = boundaries.where(F.col("length") > limit).groupBy("item_key", "pos").agg(F.max("grade").alias("grade"), F.max("length").alias("length"))
    # Lines are looked at block by block, each with the positions within reach of it, so an item with a third of all boundaries is many groups.
    block = max(BLOCK, 4 * limit)
    at = F.floor(F.col("pos") / block)
    ahead = F.when(F.col("pos") % block <= limit, F.array(at, at - 1)).otherwise(F.array(at))
    line = W.partitionBy("item_key", "block").orderBy("pos")
    # The best grade, and of it the farthest: one maximum of both in one number (positions stay below 2**40).
    best = F.max(F.shiftleft(F.col("grade").cast("bigint"), 40) + F.col("pos")).over(line.rangeBetween(limit // 2 + 1, limit)).bitwiseAND((1 << 40) - 1)
    end = F.when(F.col("length") - F.col("pos") <= limit, F.col("length")).otherwise(best)
    ended = b.withColumn("block", F.explode(ahead)).withColumn("end", end).where(F.col("block") == at).drop("block")
    ended = cut(ended.select("item_key", "pos", "end", "length"), "ends")
    # next(p): the last boundary at or before end(p) - overlap, over both kinds of points on one line.
    behind = F.when(block - F.col("pos") % block <= limit, F.array(at, at + 1)).otherwise(F.array(at))
    marks = ended.select("item_key", "pos", F.col("pos").alias("boundary"), F.lit(None).cast("bigint").alias("p"), F.lit(0).alias("kind"), F.explode(behind).alias("block"))
    wants = ended.where("end < length").select("item_key", (F.col("end") - overlap).alias("pos"), F.lit(None).cast("bigint").alias("boundary"), F.col("pos").alias("p"), F.lit(1).alias("kind")).withColumn("block", at)
    upto = W.partitionBy("item_key", "block").orderBy("pos", "kind").rowsBetween(W.unboundedPreceding, 0)
    succ = marks.unionByName(wants).withColumn("q", F.max("boundary").over(upto)).where("kind = 1").select("item_key", "p", "q")
    power = cut(succ, "next0")
    starts = ended.where("pos = 0").select("item_key", "pos", F.lit(0).cast("bigint").alias("piece_no"))
    for k in range(MAX_ROUNDS):
        # Starts of the pieces below 2**k are known; their 2**k-th successors are those of the pieces up to 2**(k + 1).
        reached = starts.join(power.withColumnRenamed("p", "pos"), ["item_key", "pos"]).select("item_key", F.col("q").alias("pos"), (F.col("piece_no") + (1 << k)).alias("piece_no"))
        starts = cut(starts.unionByName(reached), f"starts{k + 1}")
        power = cut(power.alias("x").join(power.select("item_key", F.col("p").alias("q"), F.col("q").alias("r")), ["item_key", "q"]).select("item_key", "p", F.col("r").alias("q")), f"next{k + 1}")
        if power.isEmpty():
            # No boundary has a 2**(k + 1)-th successor, and starts has all that lie fewer pieces on.
            break
    else:
        raise RuntimeError(f"an item has more than 2**{MAX_ROUNDS} pieces")
    return starts.join(ended.select("item_key", "pos", "end"), ["item_key", "pos"]).select("item_key", "piece_no", F.col("pos").alias("start"), "end")


def split_texts(texts: DataFrame, limit: int = 1500, overlap: int = 100, grid: int = 50) -> DataFrame:
    """Pieces of every text of more than ``limit`` code points: id, piece_no, start, end (0-based, end excluded), piece.

    texts: id bigint, text. A null or short text, the empty one included, and a null id give no row; a repeated id counts once. Where a text has no white
    space it is cut hard.
    """
    long = texts.select(F.col("id").alias("item_key"), "text").where(F.length("text") > limit).where("item_key is not null").groupBy("item_key").agg(F.min("text").alias("text"))
    long = cut(long, "long")
    pieces = cut_pieces(text_boundaries(long, grid), limit, overlap)
    piece = F.expr("substring(text, int(start) + 1, int(end - start))")
    return pieces.join(long, "item_key").select(F.col("item_key").alias("id"), "piece_no", "start", "end", piece.alias("piece"))


def split_page_ranges(ranges: DataFrame, page_grades: DataFrame, limit: int = 8, overlap: int = 1) -> DataFrame:
    """Pieces of every page range of more than ``limit`` pages: id, piece_no, from_page, to_page (both included).

    ranges: id bigint, source, from_page, to_page int. page_grades: source, page, grade of a cut before that page; pages without a
    grade have 0. A null bound or a reversed or short range gives no row, a repeated id counts once.
    """
    n = F.col("to_page").cast("bigint") - F.col("from_page") + 1
    long = ranges.select("id", "source", "from_page", "to_page").where(n > limit).where("id is not null").groupBy("id").agg(F.min(F.struct("source", "from_page", "to_page")).alias("r")).select("id", "r.*")
    long = long.select(F.col("id").alias("item_key"), "source", F.col("from_page").cast("bigint").alias("from_page"), n.alias("length"))
    blocks = long.select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor(F.col("length") / BLOCK))).alias("_b"))
    at = blocks.select("*", F.explode(F.sequence(F.col("_b") * BLOCK, F.least((F.col("_b") + 1) * BLOCK - 1, F.col("length")))).alias("pos")).drop("_b")
    grades = page_grades.groupBy("source", "page").agg(F.max("grade").alias("g"))
    at = at.join(grades, (at["source"] == grades["source"]) & (at["from_page"] + at["pos"] == grades["page"]), "left")
    edge = (F.col("pos") == 0) | (F.col("pos") == F.col("length"))
    boundaries = at.select("item_key", "pos", F.when(edge, 5).otherwise(F.coalesce("g", F.lit(0))).cast("int").alias("grade"), "length")
    pieces = cut_pieces(boundaries, limit, overlap).join(long.select("item_key", "from_page"), "item_key")
    return pieces.select(F.col("item_key").alias("id"), "piece_no", (F.col("from_page") + F.col("start")).alias("from_page"), (F.col("from_page") + F.col("end") - 1).alias("to_page"))


def page_grades(paragraphs: DataFrame) -> DataFrame:
    """How natural a cut before a page is: 2 where it begins with a short unpunctuated line (a heading), 1 where the page before ends a sentence.

    paragraphs: source, web_page, para_idx, text. Blank and null texts don't count; equal positions are settled by the text.
    """
    p = paragraphs.where("trim(text) <> ''").groupBy("source", "web_page").agg(
        F.min(F.struct("para_idx", F.length("text").alias("n"), F.substring(F.rtrim("text"), -1, 1).alias("last"))).alias("head"),
        F.max(F.struct("para_idx", F.substring(F.regexp_replace(F.rtrim("text"), "[»\"')\\]¹²³]+$", ""), -1, 1).alias("last"))).alias("tail"),
    )
    heads = p.where((F.col("head.n") <= 70) & ~F.col("head.last").isin(".", "؟", "،", "؛")).select("source", F.col("web_page").alias("page"), F.lit(2).alias("grade"))
    tails = p.where(F.col("tail.last").isin(".", "؟", "!", "?")).select("source", (F.col("web_page") + 1).alias("page"), F.lit(1).alias("grade"))
    return heads.unionByName(tails)
