"""Slices of an ordered paragraph table: intervals to paragraphs, page breaks, citations, character budgets, runs.

paragraphs: source, web_page, para_idx, text and citation columns; (source, web_page, para_idx) identifies a paragraph once
redelivered rows are gone (latest_rows).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from warraq.functions import paragraphs as P

PAGE_BUCKET = 16
LAST_PARA = 2**31 - 1


def latest_rows(df: DataFrame, *keys: str, by: str = "loaded_at") -> DataFrame:
    """One row per key: the one loaded last (SNK2). Among rows loaded at once, the greatest by all columns; combines before the shuffle."""
    order = [by, *(c for c in df.columns if c not in (*keys, by))]
    best = df.groupBy(*keys).agg(F.max(F.struct(*order)).alias("_r"))
    return best.select(*(c if c in keys else F.col(f"_r.{c}").alias(c) for c in df.columns))


def first_rows(df: DataFrame, *keys: str, by: str = "loaded_at") -> DataFrame:
    """One row per key: the one loaded first (SNK3)."""
    order = [by, *(c for c in df.columns if c not in (*keys, by))]
    best = df.groupBy(*keys).agg(F.min(F.struct(*order)).alias("_r"))
    return best.select(*(c if c in keys else F.col(f"_r.{c}").alias(c) for c in df.columns))


def page_meta(paragraphs: DataFrame) -> DataFrame:
    """Citation of each page: that of its first paragraph."""
    first = F.min_by(F.struct("printed_juz", "printed_page", "url"), F.struct("para_idx", "para_id"))
    return paragraphs.groupBy("source", "web_page").agg(first.alias("m")).select("source", "web_page", "m.*")


def inclusive(df: DataFrame, n_paras: DataFrame) -> DataFrame:
    """Half-open positions (start_page, para_start, last_page, para_end) as inclusive ones.

    A null start is paragraph 0; a null end is the last paragraph of its page, null if the page has none. n_paras: source, web_page, n.
    """
    n = n_paras.select(F.col("source").alias("_s"), F.col("web_page").alias("_p"), "n")
    joined = df.join(n, (df["source"] == n["_s"]) & (df["last_page"] == n["_p"]), "left")
    return joined.withColumn("from_para", F.coalesce("para_start", F.lit(0))).withColumn("to_para", F.coalesce(F.col("para_end") - 1, F.col("n") - 1)).drop("_s", "_p", "n")


def slice_intervals(segments: DataFrame, paragraphs: DataFrame) -> DataFrame:
    """Paragraphs of each interval (P1, J2), with rel_idx counted after blank ones are dropped, and is_page_break (P5).

    segments: seg_id, source, from_page, from_para, to_page, to_para (inclusive; null from_para: from the page's start, null to_para:
    to its end; null pages or reversed intervals are empty). Joined by equality on page buckets, which are cut to the pages that
    the source has, so an interval of any length costs no more than the source has pages.
    """
    extent = paragraphs.groupBy("source").agg(F.min("web_page").alias("_lo"), F.max("web_page").alias("_hi"))
    bucket = lambda c: F.floor(c / PAGE_BUCKET)
    s = segments.select("seg_id", "source", "from_page", "from_para", "to_page", "to_para").join(extent, "source")
    s = s.withColumn("_a", F.greatest("from_page", "_lo")).withColumn("_b", F.least("to_page", "_hi")).where("from_page <= to_page and _a <= _b")
    s = s.withColumn("_bucket", F.explode(F.sequence(bucket(F.col("_a")), bucket(F.col("_b"))))).drop("_lo", "_hi", "_a", "_b")
    p = paragraphs.where(F.col("text").isNotNull() & ~P.is_blank(F.col("text"))).withColumn("_bucket", bucket(F.col("web_page")))
    inside = (
        F.col("web_page").between(F.col("from_page"), F.col("to_page"))
        & ((F.col("web_page") > F.col("from_page")) | (F.col("para_idx") >= F.coalesce("from_para", F.lit(0))))
        & ((F.col("web_page") < F.col("to_page")) | (F.col("para_idx") <= F.coalesce("to_para", F.lit(LAST_PARA))))
    )
    rows = s.join(p, ["source", "_bucket"]).where(inside).drop("_bucket")
    order = W.partitionBy("seg_id").orderBy("web_page", "para_idx")
    before = F.lag("web_page").over(order)
    return rows.withColumn("rel_idx", F.row_number().over(order) - 1).withColumn("is_page_break", before.isNull() | (before != F.col("web_page")))


def citation(juz: Column, page: Column, url: Column) -> Column:
    """Volume, page and address in one text; a book of one volume names no volume, an unknown page says so."""
    place = F.when(page.isNull(), F.lit("page not printed")).otherwise(F.concat_ws(", ", F.when(juz.isNotNull(), F.concat(F.lit("vol. "), juz.cast("string"))), F.concat(F.lit("p. "), page.cast("string"))))
    return F.concat_ws(" - ", place, url)


def prefix_sums(df: DataFrame, keys: list[str], order: list[str], size: Column, name: str, total: str | None = None, width: int = 4096) -> DataFrame:
    """Adds ``name``, the sum of ``size`` over the rows of the key that come before in order, and ``total``, that over all its rows.

    In two passes, so that a key with a third of all rows is no single task: sums per block of ``width`` values of the first order column (a number) are added up
    first, and within a block the window is short. Null sizes count as 0; null keys are a key.
    """
    x = df.withColumn("_ps_block", F.floor(F.col(order[0]) / width)).withColumn("_ps_size", F.coalesce(size, F.lit(0)))
    per = x.groupBy(*keys, "_ps_block").agg(F.sum("_ps_size").alias("_ps_sum"))
    w = W.partitionBy(*keys)
    before = F.coalesce(F.sum("_ps_sum").over(w.orderBy("_ps_block").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    at = per.select(*(F.col(k).alias(f"_ps_k{i}") for i, k in enumerate(keys)), F.col("_ps_block").alias("_ps_at"), before.alias("_ps_before"), F.sum("_ps_sum").over(w).alias("_ps_total"))
    same = x["_ps_block"].eqNullSafe(at["_ps_at"])
    for i, k in enumerate(keys):
        same = same & x[k].eqNullSafe(at[f"_ps_k{i}"])
    own = F.coalesce(F.sum("_ps_size").over(W.partitionBy(*keys, "_ps_block").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    out = x.join(at, same).withColumn(name, F.col("_ps_before") + own)
    if total:
        out = out.withColumn(total, F.col("_ps_total"))
    return out.drop("_ps_block", "_ps_size", "_ps_at", "_ps_before", "_ps_total", *(f"_ps_k{i}" for i in range(len(keys))))


def within_budget(df: DataFrame, keys: list[str], order: list[str], size: Column, budget: int) -> DataFrame:
    """Rows whose running size stays within the budget, at least one a key; 0 or less: all rows. Adds cum_size."""
    w = W.partitionBy(*keys).orderBy(*order)
    sized = df.withColumn("cum_size", F.sum(size).over(w.rowsBetween(W.unboundedPreceding, 0)))
    if budget <= 0:
        return sized
    return sized.withColumn("_rn", F.row_number().over(w)).where((F.col("cum_size") <= budget) | (F.col("_rn") == 1)).drop("_rn")


def budget_pages(df: DataFrame, keys: list[str], order: list[str], size: Column, budget: int, offset: int = 0) -> DataFrame:
    """One answer page per key: items from offset on while they fit; n_shown, used, next_offset (null at the end). The first order column is a number; keys may be large."""
    items = prefix_sums(df, keys, order, F.lit(1), "_i", "_n").where(F.col("_i") >= offset)
    sized = prefix_sums(items, keys, order, size, "_used").withColumn("cum_size", F.col("_used") + F.coalesce(size, F.lit(0)))
    shown = sized.where((F.col("cum_size") <= budget) | (F.col("_i") == offset)) if budget > 0 else sized
    return shown.groupBy(*keys).agg(F.count("*").alias("n_shown"), F.max("cum_size").alias("used"), F.max("_i").alias("_last"), F.max("_n").alias("n_total")).select(
        *keys, "n_shown", "used", F.when(F.col("_last") + 1 < F.col("n_total"), F.col("_last") + 1).alias("next_offset"), "n_total"
    )


def paragraph_range(df: DataFrame, keys: list[str], first: int, last: int, index: str = "rel_idx") -> DataFrame:
    """Rows first to last (0-based, inclusive; a last past the end means the end) of each key; status found. A key that ends before ``first`` comes once, with nulls and status out of range."""
    inside = df.where(F.col(index).between(first, last)).withColumn("status", F.lit("found"))
    short = df.groupBy(*keys).agg(F.max(index).alias("_max")).where(F.col("_max") < first).select(*keys, F.lit("out of range").alias("status"))
    return inside.unionByName(short, allowMissingColumns=True)


def shared_budget(df: DataFrame, keys: list[str], order: list[str], size: Column, budget: int) -> DataFrame:
    """One budget over all groups of a key, in display order: what an earlier group used is gone for a later one."""
    return within_budget(df, keys, order, size, budget)


def verse_flags(df: DataFrame, keys: list[str], order: list[str], text: str = "text") -> DataFrame:
    """Adds is_verse: a verse line, or a short line after one that is no heading. A run without a core line before it isn't verse."""
    w = W.partitionBy(*keys).orderBy(*order)
    core = F.coalesce(P.is_verse_line(F.col(text)), F.lit(False))
    short = F.coalesce((F.length(P.strip(F.col(text))) <= 70) & ~P.is_heading(F.col(text)), F.lit(False))
    blocks = df.withColumn("_core", core).withColumn("_reset", (~core & ~short).cast("int"))
    blocks = blocks.withColumn("_block", F.sum("_reset").over(w.rowsBetween(W.unboundedPreceding, 0)))
    inside = W.partitionBy(*keys, "_block").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    seen = F.max(F.col("_core").cast("int")).over(inside) == 1
    return blocks.withColumn("is_verse", seen & (F.col("_reset") == 0)).drop("_core", "_reset", "_block")


def runs(df: DataFrame, keys: list[str], index: str) -> DataFrame:
    """Maximal runs of consecutive integers per key: from_idx, to_idx, n. Repeated integers count once."""
    one = df.select(*keys, index).where(F.col(index).isNotNull()).distinct()
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(index))
    return one.withColumn("_g", F.col(index) - rank).groupBy(*keys, "_g").agg(F.min(index).alias("from_idx"), F.max(index).alias("to_idx"), F.count("*").alias("n")).drop("_g")


def compressed(df: DataFrame, keys: list[str], index: str) -> DataFrame:
    """The runs of each key as one text, like 1-3,7."""
    text = F.when(F.col("n") == 1, F.col("from_idx").cast("string")).otherwise(F.concat_ws("-", "from_idx", "to_idx"))
    parts = F.array_sort(F.collect_list(F.struct(F.col("from_idx"), text.alias("t"))))
    return runs(df, keys, index).groupBy(*keys).agg(F.array_join(F.transform(parts, lambda x: x.t), ",").alias("numbers"), F.sum("n").alias("n_numbers"))


def sections(df: DataFrame, keys: list[str], index: str, text: str = "text") -> DataFrame:
    """The ranges between headings, with kind (note, poem, genealogy, text) and size. Rows before the first heading form section 0."""
    w = W.partitionBy(*keys).orderBy(index)
    head = F.coalesce(P.is_heading(F.col(text)), F.lit(False))
    s = df.withColumn("_head", head).withColumn("section", F.sum(F.col("_head").cast("int")).over(w.rowsBetween(W.unboundedPreceding, 0)))
    share = lambda c: F.avg(F.when(~F.col("_head"), c.cast("int")))
    per = s.groupBy(*keys, "section").agg(
        F.min(index).alias("from_idx"), F.max(index).alias("to_idx"), F.max(F.when(F.col("_head"), F.col(text))).alias("title"),
        F.sum(F.length(text)).alias("n_chars"), share(P.is_footnote(F.col(text))).alias("_f"), share(P.is_verse_line(F.col(text))).alias("_v"), share(P.is_genealogy(F.col(text))).alias("_g"),
    )
    kind = F.when(F.col("_f") >= 0.6, "note").when(F.col("_v") >= 0.6, "poem").when(F.col("_g") >= 0.6, "genealogy").otherwise("text")
    return per.select(*keys, "section", "from_idx", "to_idx", "title", "n_chars", kind.alias("kind"))
