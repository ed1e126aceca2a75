"""Labels of segments: expansion to single verses, extension to the next anchor, merging, runs over pages, tables of contents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Verses of each chapter, 6,236 in all. Fixed values.
VERSES = (
    7, 286, 200, 176, 120, 165, 206, 75, 129, 109, 123, 111, 43, 52, 99, 128, 111, 110, 98, 135, 112, 78, 118, 64, 77, 227, 93, 88, 69, 60, 34, 30, 73, 54, 45, 83, 182, 88,
    75, 85, 54, 53, 89, 59, 37, 35, 38, 29, 18, 45, 60, 49, 62, 55, 78, 96, 29, 22, 24, 13, 14, 11, 11, 18, 12, 12, 30, 52, 52, 44, 28, 28, 20, 56, 40, 31,
    50, 40, 46, 42, 29, 19, 36, 25, 22, 17, 19, 26, 30, 20, 15, 21, 11, 8, 8, 19, 5, 8, 8, 11, 11, 8, 3, 9, 5, 4, 7, 3, 6, 3, 5, 4, 5, 6,
)


def chapters(spark: SparkSession) -> DataFrame:
    """Surah, n_ayat of the 114 chapters."""
    return spark.createDataFrame([(i + 1, n) for i, n in enumerate(VERSES)], "surah int, n_ayat int")


def check_verses(refs: DataFrame) -> DataFrame:
    """Refs (with surah, ayah; a null ayah means the whole chapter) with n_ayat and status: ok, no chapter, no verse."""
    x = refs.join(F.broadcast(chapters(refs.sparkSession)), "surah", "left")
    status = F.when(F.col("n_ayat").isNull(), "no chapter").when(F.col("ayah").isNull() | F.col("ayah").between(1, F.col("n_ayat")), "ok").otherwise("no verse")
    return x.withColumn("status", status)


def label_note(label: Column) -> Column:
    """Q1: what a label that is no plain verse or range means, or null."""
    return F.when(label.contains(","), "one of these verses").when(label.startswith("~"), "verses inferred from the neighbours")


def bounds(label: Column) -> tuple[Column, Column]:
    """Lower and upper number of a label N or A-B, or of an interpolated ~A-B; null for any other label."""
    number = label.rlike(r"^~?\d+(-\d+)?$")
    lo = F.when(number, F.regexp_extract(label, r"^~?(\d+)", 1).cast("int"))
    hi = F.when(number, F.coalesce(F.nullif(F.regexp_extract(label, r"-(\d+)$", 1), F.lit("")).cast("int"), lo))
    return lo, hi


def verse_map(segments: DataFrame) -> DataFrame:
    """One row per segment and verse that its label covers; special and reversed labels cover none.

    Labels of two alternatives (a,b) cover both.
    """
    part = segments.select("seg_id", "source", "surah", F.explode(F.split("label", r"\s*,\s*")).alias("part"))
    lo, hi = bounds(F.col("part"))
    spans = part.withColumn("lo", lo).withColumn("hi", hi).where("lo <= hi")
    return spans.select("seg_id", "source", "surah", F.explode(F.sequence("lo", "hi")).alias("ayah")).distinct()


def extend_labels(df: DataFrame, keys: list[str], order: list[str], lo: str, hi: str, last: Column) -> DataFrame:
    """Hi is raised to the next anchor's lo - 1, the last one's to ``last``; overlaps stay. Adds new_hi."""
    following = F.lead(lo).over(W.partitionBy(*keys).orderBy(*order))
    return df.withColumn("new_hi", F.greatest(F.col(hi), F.least(F.coalesce(following - 1, last), last)))


def merge_labels(df: DataFrame, keys: list[str], order: list[str], lo: str, hi: str) -> DataFrame:
    """Neighbouring labels (in order) of which the next begins at or before the end so far become one, at the first's place."""
    w = W.partitionBy(*keys).orderBy(*order)
    reach = F.max(hi).over(w.rowsBetween(W.unboundedPreceding, -1))
    grouped = df.withColumn("_new", F.when(F.col(lo) <= reach, 0).otherwise(1)).withColumn("_g", F.sum("_new").over(w))
    return grouped.groupBy(*keys, "_g").agg(F.min(lo).alias("lo"), F.max(hi).alias("hi"), F.count("*").alias("n_merged")).drop("_g")


def page_chains(df: DataFrame, keys: list[str], page: str, end_excl: str, order: list[str]) -> DataFrame:
    """A new run begins where a page lies beyond the end of the row before; a null end reaches everything.

    Result: keys, run, first_page, last_end (null if open), n.
    """
    w = W.partitionBy(*keys).orderBy(*order)
    open_end = F.coalesce(F.col(end_excl), F.lit(2**31 - 1))
    new = F.when(F.col(page) <= F.lag(open_end).over(w), 0).otherwise(1)
    marked = df.withColumn("_e", open_end).withColumn("_new", new).withColumn("run", F.sum("_new").over(w))
    return marked.groupBy(*keys, "run").agg(F.min(page).alias("first_page"), F.nullif(F.max("_e"), F.lit(2**31 - 1)).alias("last_end"), F.count("*").alias("n"))


def longest_block(df: DataFrame, keys: list[str], page: str, gap: int = 3) -> DataFrame:
    """Of the blocks of pages at most ``gap`` apart, the one with most rows; the first of equal ones."""
    w = W.partitionBy(*keys).orderBy(page)
    new = F.when(F.col(page) - F.lag(page).over(w) <= gap, 0).otherwise(1)
    blocks = df.where(F.col(page).isNotNull()).withColumn("_new", new).withColumn("_b", F.sum("_new").over(w))
    per = blocks.groupBy(*keys, "_b").agg(F.min(page).alias("from_page"), F.max(page).alias("to_page"), F.count("*").alias("n"))
    return per.groupBy(*keys).agg(F.max_by(F.struct("from_page", "to_page", "n"), F.struct("n", -F.col("from_page"))).alias("b")).select(*keys, "b.*")


def _levels(toc: DataFrame, keys: list[str], depth: str) -> DataFrame:
    """Each row once for every level from its own depth down to its group's deepest: _r (the row), _own (its depth), _level. A null depth is 0.

    Within one level the rows that count for it stand side by side, so what asks for rows of at most a given depth is one window, without a limit to the depth.
    """
    own = F.greatest(F.coalesce(F.col(depth), F.lit(0)), F.lit(0)).cast("int")
    x = toc.select(*(F.col(k).alias(f"_{k}") for k in keys), F.struct(*toc.columns).alias("_r"), own.alias("_own"))
    deepest = F.max("_own").over(W.partitionBy(*(f"_{k}" for k in keys)))
    return x.withColumn("_max", deepest).withColumn("_level", F.explode(F.sequence("_own", "_max")))


def toc_ends(toc: DataFrame, keys: list[str], i: str = "i", page: str = "page", depth: str = "depth") -> DataFrame:
    """end_excl, the page of the first later row of the same or a lesser depth on a later page; end_any, of any depth.

    Rows are in page order, so the first such row has the least page. A tree may be of any depth.
    """
    # From the last page backwards, so that the minimum grows with the frame instead of being taken anew.
    at = W.partitionBy(*(f"_{k}" for k in keys), "_level").orderBy(F.desc(f"_r.{page}")).rangeBetween(W.unboundedPreceding, -1)
    every = W.partitionBy(*keys).orderBy(F.desc(page)).rangeBetween(W.unboundedPreceding, -1)
    x = _levels(toc, keys, depth).withColumn("end_excl", F.min(f"_r.{page}").over(at)).where("_own = _level")
    return x.select("_r.*", "end_excl").withColumn("end_any", F.min(page).over(every))


def toc_parents(toc: DataFrame, keys: list[str], i: str = "i", depth: str = "depth") -> DataFrame:
    """Parent of each row of a pre-order list, the last row before it of a lesser depth; null for roots. A tree may be of any depth."""
    at = W.partitionBy(*(f"_{k}" for k in keys), "_level").orderBy(f"_r.{i}").rowsBetween(W.unboundedPreceding, -1)
    x = _levels(toc, keys, depth).withColumn("parent", F.max(F.when(F.col("_own") < F.col("_level"), F.col(f"_r.{i}"))).over(at))
    return x.where("_own = _level").select("_r.*", "parent")


def coverage(verses: DataFrame, totals: DataFrame, keys: list[str]) -> DataFrame:
    """Covered distinct verses of the total, the missing ones as runs. totals: surah, n_ayat. Every combination of keys is there, none is silently empty."""
    base = verses.select(*keys).distinct().join(totals, "surah")
    hit = verses.select(*keys, "ayah").distinct().join(totals, "surah").where(F.col("ayah").between(1, F.col("n_ayat")))
    counts = hit.groupBy(*keys).agg(F.count("*").alias("covered"))
    out = base.join(counts, keys, "left").withColumn("covered", F.coalesce("covered", F.lit(0)))
    return out.withColumn("percent", F.round(100.0 * F.col("covered") / F.col("n_ayat"), 2))


def missing_verses(verses: DataFrame, totals: DataFrame, keys: list[str]) -> DataFrame:
    """The verses 1..n_ayat of each combination of keys that aren't covered."""
    all_ = verses.select(*keys).distinct().join(totals, "surah").select(*keys, F.explode(F.expr("sequence(1, n_ayat)")).alias("ayah"))
    return all_.join(verses.select(*keys, "ayah").distinct(), [*keys, "ayah"], "left_anti")


def absences(items: DataFrame, sources: DataFrame, present: DataFrame, on: list[str]) -> DataFrame:
    """(source, item) pairs that were looked for and aren't there. items and sources are dimensions; the smaller one is broadcast by Spark's size check."""
    return items.crossJoin(sources).join(present.select(*on).distinct(), on, "left_anti")
