"""Order-dependent choices that relational operators can't express: one bounded group (a chapter, a book) at a time, in Arrow batches."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, StructType

NUMBER, LONG_PHRASE, SHORT_PHRASE, LEADING_WORDS = 100, 60, 30, 40


def match_score(phrase: Column, number: Column, verse: Column, verse_no: Column) -> Column:
    """How well a heading (quoted phrase, printed number) fits a verse; texts in the verse profile, null parts score 0."""
    words = F.split(phrase, " ")
    verse_words = F.split(verse, " ")
    common = F.aggregate(F.zip_with(words, verse_words, lambda x, y: x == y), F.struct(F.lit(0).alias("n"), F.lit(True).alias("on")), lambda s, e: F.struct((s.n + (s.on & F.coalesce(e, F.lit(False))).cast("int")).alias("n"), (s.on & F.coalesce(e, F.lit(False))).alias("on")), lambda s: s.n)
    text = (
        F.when(phrase.isNull() | verse.isNull() | (phrase == "") | (verse == ""), 0)
        .when(verse.startswith(phrase), F.when(F.size(words) >= 3, LONG_PHRASE).otherwise(SHORT_PHRASE))
        .when((F.length(F.replace(verse, F.lit(" "), F.lit(""))) >= 8) & phrase.startswith(verse), LONG_PHRASE)
        .when(common >= 3, LEADING_WORDS)
        .otherwise(0)
    )
    return text + F.when(number == verse_no, NUMBER).otherwise(0)


def _best_path(heads: int, verses: np.ndarray, pos: np.ndarray, ayah: np.ndarray, score: np.ndarray) -> list[int | None]:
    """The non-decreasing assignment of greatest total; equal totals go to the assignment that leaves later headings out."""
    top = np.concatenate([[0.0], np.full(len(verses), -np.inf)])  # best total ending at verse index k; 0: none yet
    trace: list[dict[int, int]] = []
    slot = {int(v): k + 1 for k, v in enumerate(verses)}
    by_head: dict[int, list[tuple[int, float]]] = {}
    for p, a, s in zip(pos, ayah, score):
        by_head.setdefault(int(p), []).append((slot[int(a)], float(s)))
    for h in range(heads):
        reach = np.maximum.accumulate(top)
        first = np.flatnonzero(np.concatenate([[True], reach[1:] > reach[:-1]]))
        new, step = top.copy(), {}
        for k, s in by_head.get(h, ()):
            if reach[k] + s > new[k]:
                new[k] = reach[k] + s
                step[k] = int(first[np.searchsorted(first, k, side="right") - 1])
        trace.append(step)
        top = new
    k = int(np.argmax(top))
    out: list[int | None] = [None] * heads
    for h in range(heads - 1, -1, -1):
        if k in trace[h]:
            out[h] = int(verses[k - 1])
            k = trace[h][k]
    return out


def align(scores: DataFrame, heads: DataFrame, keys: list[str]) -> DataFrame:
    """Headings to verses in non-decreasing order, of greatest total score; a heading may stay without.

    heads: keys, pos (0..n-1 in each group); scores: keys, pos, ayah, score > 0. Result: keys, pos, ayah (null: none). A group is a
    chapter: its headings times its verses bound the work.
    """
    schema = heads.select(*keys, "pos").schema.add("ayah", IntegerType())

    def one(key: tuple, h: pd.DataFrame, s: pd.DataFrame) -> pd.DataFrame:
        order = h["pos"].sort_values().tolist()
        place = {p: i for i, p in enumerate(order)}
        s = s[s["pos"].isin(place.keys()) & (s["score"] > 0)]
        path = _best_path(len(order), np.sort(s["ayah"].unique()), s["pos"].map(place).to_numpy(), s["ayah"].to_numpy(), s["score"].to_numpy())
        out = pd.DataFrame({k: [v] * len(order) for k, v in zip(keys, key)})
        out["pos"], out["ayah"] = order, pd.array(path, dtype="Int64")
        return out

    left = heads.select(*keys, "pos").distinct().groupBy(*keys)
    return left.cogroup(scores.select(*keys, "pos", "ayah", "score").groupBy(*keys)).applyInPandas(one, schema)


def alignment_ok(aligned: DataFrame, keys: list[str], totals: Column) -> DataFrame:
    """Whether a group's alignment is plausible: it starts by verse 3 and ends within max(12, n // 2) of the last. totals: n verses, a column of aligned."""
    per = aligned.groupBy(*keys).agg(F.min("ayah").alias("first"), F.max("ayah").alias("last"), F.max(totals).alias("n"))
    return per.withColumn("ok", (F.col("first") <= 3) & (F.col("n") - F.col("last") <= F.greatest(F.lit(12), F.floor(F.col("n") / 2))))


def best_chain(candidates: DataFrame, keys: list[str]) -> DataFrame:
    """The chain of candidates (pos, lo, hi), each beginning after the one before ends, of the widest span, then of most members; the first of equals."""

    def one(key: tuple, c: pd.DataFrame) -> pd.DataFrame:
        c = c.sort_values(["pos", "lo", "hi"]).reset_index(drop=True)
        ends = np.unique(c["hi"])
        # Of the chains so far, by where they end: (first number, -members, place of the last member), the least of all that end up to a rank, in a binary indexed tree.
        tree: list[tuple | None] = [None] * (len(ends) + 1)
        link: list[tuple] = []
        for j, (lo, hi) in enumerate(zip(c["lo"], c["hi"])):
            at, best = int(np.searchsorted(ends, lo)), None
            while at:
                best = min(filter(None, (best, tree[at])), default=None)
                at &= at - 1
            mine = (best[0], best[1] - 1, j) if best else (lo, -1, j)
            link.append((mine, best[2] if best else None))
            at = int(np.searchsorted(ends, hi)) + 1
            while at < len(tree):
                tree[at] = min(filter(None, (tree[at], mine)))
                at += at & -at
        # The widest span, then most members, then the first.
        j = min(range(len(link)), key=lambda k: (link[k][0][0] - c["hi"][k], link[k][0][1], k)) if link else None
        taken = []
        while j is not None:
            taken.append(j)
            j = link[j][1]
        return c.loc[taken[::-1]]

    cols = [*keys, "pos", "lo", "hi"]
    return candidates.select(*cols).where("pos is not null and lo is not null and hi is not null").groupBy(*keys).applyInPandas(one, candidates.select(*cols).schema)


def increasing(rows: DataFrame, keys: list[str], order: list[str], number: str, page: str) -> DataFrame:
    """Walks each group in order from its first row of number 1 and accepts rows whose number and page both exceed the last accepted ones'; adds accepted (false before the start).

    Without a 1 nothing is accepted.
    """

    def one(key: tuple, g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values(order, kind="stable")
        last, at, ok = None, None, []
        for n, p in zip(g[number], g[page]):
            good = (last is None and n == 1) or (last is not None and pd.notna(n) and pd.notna(p) and n > last and p > at)
            if good:
                last, at = n, p
            ok.append(bool(good))
        return g.assign(accepted=ok)

    schema = StructType([*rows.schema.fields]).add("accepted", BooleanType())
    return rows.groupBy(*keys).applyInPandas(one, schema)


OFFSETS = (0, 1, -1, 2, -2, 3, -3, 4, -4, 5, -5)


def pair_editions(left: DataFrame, right: DataFrame) -> DataFrame:
    """Entries of two editions (num, key) paired one to one on equal keys, lefts in order of number, nearest offset first (0, +1, -1, ... -5); each right once.

    Result: num_left, num_right, key. The numbers of one key, each once, are one row; only keys of both editions reach Python, many in a batch. Null keys and numbers aren't paired.
    """

    def paired(batches):
        for batch in batches:
            out = []
            for key, lefts, rights in zip(batch["key"], batch["lefts"], batch["rights"]):
                free = set(rights.tolist())
                for n in sorted(lefts.tolist()):
                    d = next((d for d in OFFSETS if n + d in free), None)
                    if d is not None:
                        free.remove(n + d)
                        out.append((n, n + d, key))
            yield pd.DataFrame(out, columns=["num_left", "num_right", "key"])

    of = lambda df, name: df.where("key is not null and num is not null").groupBy("key").agg(F.collect_set(F.col("num").cast("bigint")).alias(name))
    return of(left, "lefts").join(of(right, "rights"), "key").mapInPandas(paired, "num_left bigint, num_right bigint, key string")


def located(titles: DataFrame, lines: DataFrame, keys: list[str]) -> DataFrame:
    """Each title (i, page, tkey) in order to the first line (page, para_idx, pkey) after the one located before, on its page, then from its page's start, then on the pages beside.

    A line matches if its key begins with the title's first 15 letters, or its key begins the title's. Result: keys, i, found_page, para_idx (null: not found).
    """

    def one(key: tuple, t: pd.DataFrame, p: pd.DataFrame) -> pd.DataFrame:
        on = {q: g.sort_values("para_idx")[["para_idx", "pkey"]].to_numpy().tolist() for q, g in p.groupby("page")}
        at, out = (-1, -1), []

        def hit(page, start, want):
            k = want[:15]
            return next((i for i, line in on.get(page, ()) if i > start and line and k and (line.startswith(k) or k.startswith(line[:15]))), None)

        for i, page, want in t.sort_values("i")[["i", "page", "tkey"]].itertuples(index=False):
            want = want or ""
            tries = [(page, at[1] if at[0] == page else -1), (page, -1), (page - 1, -1), (page + 1, -1)]
            where = next(((q, x) for q, s in tries if (x := hit(q, s, want)) is not None), None)
            if where:
                at = where
            out.append((*key, i, *(where or (None, None))))
        return pd.DataFrame(out, columns=[*keys, "i", "found_page", "para_idx"]).astype({"found_page": "Int64", "para_idx": "Int64"})

    schema = titles.select(*keys, "i").schema.add("found_page", IntegerType()).add("para_idx", IntegerType())
    return titles.select(*keys, "i", "page", "tkey").groupBy(*keys).cogroup(lines.select(*keys, "page", "para_idx", "pkey").groupBy(*keys)).applyInPandas(one, schema)
