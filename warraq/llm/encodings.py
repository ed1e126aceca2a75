"""Garbled text from a wrong character encoding: found and restored by expectation-maximization over encoding chains.

A chain says how a stretch of text came about: written in one encoding, read in another, once or twice. Undoing a chain gives one
original, and the probability of the stretch under the chain is that of the original under a model of clean text (letter pairs,
counted over all documents). Which chain is at work is latent. Its share differs by source and field: each (source, field) pool has
its own shares, estimated by expectation-maximization from all stretches of the pool and, by weight SHRINK, from the whole corpus.
So a short or ambiguous stretch is judged with what the rest of its source shows. Every stretch is then restored by its posterior.
"""

from __future__ import annotations

import re
import unicodedata
import warnings
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from warraq.plans.materialize import cut

#: Chains: (name, kind, written in, read in, times). Fixed values; the first is no garbling at all, the last is text that has lost bytes.
CHAINS = (
    ("clean", "none", "", "", 0),
    ("utf-8 read as cp1252", "multi", "utf-8", "cp1252", 1),
    ("utf-8 read as cp1252 twice", "multi", "utf-8", "cp1252", 2),
    ("utf-8 read as cp1256", "multi", "utf-8", "cp1256", 1),
    ("utf-8 read as cp1256 twice", "multi", "utf-8", "cp1256", 2),
    ("utf-8 read as cp1251", "multi", "utf-8", "cp1251", 1),
    ("utf-8 read as cp1251 twice", "multi", "utf-8", "cp1251", 2),
    ("cp1256 read as cp1252", "single", "cp1256", "cp1252", 1),
    ("iso-8859-6 read as cp1252", "single", "iso8859_6", "cp1252", 1),
    ("cp1251 read as cp1252", "single", "cp1251", "cp1252", 1),
    ("cp1256 read as cp1251", "single", "cp1256", "cp1251", 1),
    ("cp1251 read as cp1256", "single", "cp1251", "cp1256", 1),
    ("cp1252 read as cp1256", "single", "cp1252", "cp1256", 1),
    ("bytes lost", "lost", "", "", 0),
)
K = len(CHAINS)
#: First bytes of UTF-8 sequences of two, three and four bytes. Fixed values.
LEADS = (range(0xC2, 0xE0), range(0xE0, 0xF0), range(0xF0, 0xF5))
SHRINK = 20.0
#: log-probability of a change of script between a stretch and the letter beside it.
SWITCH = -4.0
ROUNDS = 100
#: A token is judged too if an original has a log-probability of at least this much less than its own.
MARGIN = 3.0
#: Tokens that a worker remembers as judged; it forgets all and begins anew beyond.
REMEMBERED = 2_000_000
LOST = "�"
_TOKEN = re.compile(r"[^ \n\r\t]+")


def _once(f):
    """Keeps results by arguments; unlike functools' it travels to workers by value."""
    kept: dict = {}

    def g(*args):
        if args not in kept:
            kept[args] = f(*args)
        return kept[args]

    return g


@_once
def _bytes_of(read: str) -> dict[str, int]:
    """The byte of each upper character of an encoding; C1 controls stand for bytes that it leaves undefined."""
    out = {chr(b): b for b in range(0x80, 0xA0)} if read in ("cp1252", "cp1251", "cp1256") else {}
    if read == "cp1252":
        out |= {chr(b): b for b in range(0xA0, 0x100)}
    for b in range(0x80, 0x100):
        c = bytes([b]).decode(read, "replace")
        if c != LOST:
            out[c] = b
    return out


@_once
def _sequence(read: str) -> re.Pattern:
    """Runs of characters whose bytes in ``read`` are UTF-8 of more than one byte; a lost character may stand for a following byte."""
    of: dict[int, list[str]] = {}
    for c, b in _bytes_of(read).items():
        of.setdefault(b, []).append(c)
    chars = lambda *bs: "[" + "".join(re.escape(c) for b in bs for c in of.get(b, [])) + "]"
    cont = chars(*range(0x80, 0xC0))[:-1] + LOST + "]"
    return re.compile("(?:" + "|".join(f"{chars(*leads)}{cont}{{{n}}}" for n, leads in enumerate(LEADS, 1) if any(b in of for b in leads)) + ")+")


def _undo_multi(text: str, read: str) -> str:
    table = _bytes_of(read)

    def one(m: re.Match) -> str:
        raw = bytes(table.get(c, 0xFF) for c in m[0])
        # A lost byte (0xFF) makes its sequence undecodable: one lost character comes back for the whole sequence.
        return re.sub(f"{LOST}+", LOST, raw.decode("utf-8", "replace"))

    return _sequence(read).sub(one, text)


@_once
def _single(written: str, read: str) -> dict[int, str]:
    out = {}
    for c, b in _bytes_of(read).items():
        back = bytes([b]).decode(written, "replace")
        out[ord(c)] = back if back != LOST else "\0"
    return out


_ASCII_LETTER = re.compile("[A-Za-z]")


def undo(text: str, chain: int) -> str:
    """The original of text if chain made it; text itself where the chain can't have made any of it."""
    _, kind, written, read, times = CHAINS[chain]
    if kind == "multi":
        for _ in range(times):
            text = _undo_multi(text, read)
    elif kind == "single" and (written == "cp1252" or not _ASCII_LETTER.search(text)):
        table = _single(written, read)
        if all(ord(c) < 0x80 or ord(c) in table for c in text):
            back = text.translate(table)
            return text if "\0" in back else back
    return text


# The alphabet of the model: code points that occur in the corpus' scripts each for itself, all others by category.
_WIDE = ((0x0, 0x700), (0x1E00, 0x1F00), (0x2000, 0x2070), (0x20A0, 0x20C0), (0x2100, 0x2150), (0xFD00, 0xFE00))
_CATEGORIES = ("Lu", "Ll", "Lo", "Lm", "Mn", "Nd", "Po", "So")
SIZE = sum(b - a for a, b in _WIDE) + len(_CATEGORIES) + 2


@_once
def _lookup() -> np.ndarray:
    table = np.full(0x110000, SIZE - 1, dtype=np.int32)
    at = 0
    for a, b in _WIDE:
        table[a:b] = np.arange(at, at + b - a)
        at += b - a
    for o in range(0x110000):
        if table[o] == SIZE - 1 and o < 0x30000 and (c := unicodedata.category(chr(o))) in _CATEGORIES:
            table[o] = at + _CATEGORIES.index(c)
    return table


def _codes(text: str) -> np.ndarray:
    return _lookup()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)]


_MULTI = [k for k, c in enumerate(CHAINS) if c[1] == "multi" and c[4] == 1]
_C1 = re.compile("[\u0080-\u0084\u0086-\u009f]")
_UPPER = re.compile("[À-ÖØ-öø-ÿ]")


_ORDINARY = re.compile("[^ -~ء-ي\u064b-\u0652،؛؟«»‘’“”–—…٠-٩]")
_ARABIC_LETTER = re.compile("[ء-ي]")


def _sequences(token: str) -> bool:
    """Whether characters of the token are UTF-8 read otherwise. Letters and punctuation that are ordinary throughout count in a token of two scripts only."""
    mixed = bool(_ASCII_LETTER.search(token) and _ARABIC_LETTER.search(token))
    return any(mixed or _ORDINARY.search(m[0]) for k in _MULTI for m in _sequence(CHAINS[k][3]).finditer(token))


def _suspect(token: str) -> bool:
    """Whether a token looks garbled by its characters alone."""
    if LOST in token or _C1.search(token) or _sequences(token):
        return True
    return not _ASCII_LETTER.search(token) and (bool(_UPPER.search(token)) or any("Ѐ" <= c <= "џ" for c in token))


def _script(c: str) -> str:
    return "arabic" if "ء" <= c <= "ۓ" else "cyrillic" if "Ѐ" <= c <= "ӿ" else "latin"


def _beside(text: str, start: int, end: int) -> list[str]:
    """Scripts of the letters nearest to a stretch on its line."""
    before = re.search(r"([^\W\d_])[\W\d_]*$", text[max(0, start - 40) : start].rpartition("\n")[2])
    after = re.search(r"[^\W\d_]", text[end : end + 40].partition("\n")[0])
    return [_script(m[0][0]) for m in (before, after) if m]


def _switches(stretch: str, beside: list[str]) -> float:
    letters = [c for c in stretch if c.isalpha()]
    if not letters or not beside:
        return 0.0
    return SWITCH * (sum(_script(e) != s for e, s in zip((letters[0], letters[-1]), beside)) if len(beside) == 2 else min(_script(e) != beside[0] for e in (letters[0], letters[-1])))


def _split(text: str) -> set[str]:
    return set(text.replace("\n", " ").replace("\r", " ").replace("\t", " ").split(" "))


@_once
def _single_codes(chain: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each code point: the model's symbol for its original under a chain of single bytes, -1 where it has none; and whether that is another character."""
    table = _single(CHAINS[chain][2], CHAINS[chain][3])
    codes = np.full(0x110000, -1, dtype=np.int32)
    codes[:0x80] = _lookup()[:0x80]
    other = np.zeros(0x110000, dtype=bool)
    for o, back in table.items():
        if back != "\0":
            codes[o], other[o] = _lookup()[ord(back)], back != chr(o)
    if CHAINS[chain][2] != "cp1252":
        codes[[*range(65, 91), *range(97, 123)]] = -1
    return codes, other


#: Chains that leave nothing but letters of another script: only the letters' order gives them away.
_HIDDEN = [k for k, c in enumerate(CHAINS) if c[1] == "single" and c[3] == "cp1256"]


class _Tokens:
    """Which tokens are to be judged: those that _suspect() names and, given a model, those of which an original is nearly as probable. Each is looked at once a worker."""

    def __init__(self, model: _Model | None = None):
        self.model, self.fine, self.strange = model, {""}, set()

    def read(self, texts: list[str]) -> list[set[str]]:
        """Of each text, its tokens that are to be judged."""
        words = [_split(t) for t in texts]
        new = list(set().union(*words) - self.fine - self.strange)
        if new:
            found = {t for t in new if not t.isascii() and _suspect(t)}
            rest = [t for t in new if t not in found]
            if self.model is not None and rest:
                found.update(t for t, hidden in zip(rest, self.model.hidden(rest)) if hidden)
            self.strange |= found
            self.fine.update(t for t in new if t not in found)
        out = [w & self.strange for w in words]
        if len(self.fine) > REMEMBERED:
            self.fine, self.strange = {""}, set()
        return out


def stretches(text: str, strange: set[str] | None = None) -> list[tuple[int, int]]:
    """(start, end) of runs of neighbouring tokens that could be garbled: strange, or else those that look so."""
    out: list[list[int]] = []
    last = -9
    for k, m in enumerate(_TOKEN.finditer(text)):
        if _suspect(m[0]) if strange is None else m[0] in strange:
            if last == k - 1 and out:
                out[-1][1] = m.end()
            else:
                out.append([m.start(), m.end()])
            last = k
    return [(a, b) for a, b in out]


def _unclean(token: str) -> bool:
    """Whether a suspect token stays out of the model of clean text. Lone letters of Latin-1 (sigla) and Cyrillic words are in it."""
    return LOST in token or bool(_C1.search(token)) or _sequences(token) or len(_UPPER.findall(token)) > 1


def _count_pairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    total = np.zeros(SIZE * SIZE, dtype=np.int64)
    tokens = _Tokens()
    for b in batches:
        clean = []
        for t, strange in zip(b["text"], tokens.read(b["text"].tolist())):
            if strange:
                for a, z in reversed(stretches(t, strange)):
                    if any(map(_unclean, t[a:z].split())):
                        t = t[:a] + " " + t[z:]
            clean.append(t)
        codes = _codes(" \n" + "\n".join(clean) + " ")
        for k in range(0, len(codes) - 1, 1 << 21):
            part = codes[k : k + (1 << 21) + 1].astype(np.int64)
            total += np.bincount(part[:-1] * SIZE + part[1:], minlength=SIZE * SIZE)
    at = np.flatnonzero(total)
    yield pd.DataFrame({"pair": at, "n": total[at]})


def clean_model(texts: DataFrame) -> dict[str, np.ndarray]:
    """Counts of letter pairs outside suspect stretches over all texts. At most SIZE ** 2 pairs of the fixed alphabet reach the driver, as arrays."""
    rows = texts.select("text").where("text is not null").mapInPandas(_count_pairs, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n"))
    got = rows.toPandas().sort_values("pair")
    return {"pair": got["pair"].to_numpy(np.int64), "n": got["n"].to_numpy(np.float64)}


class _Model:
    def __init__(self, counts: dict[str, np.ndarray]):
        self.pair, self.n = counts["pair"], counts["n"]
        first = np.bincount(self.pair // SIZE, self.n, SIZE)
        second = np.bincount(self.pair % SIZE, self.n, SIZE)
        self.first = first
        self.single = (second + 0.05) / (second.sum() + 0.05 * SIZE)

    def _steps(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """log P(b after a)."""
        p = a.astype(np.int64) * SIZE + b
        at = np.minimum(np.searchsorted(self.pair, p), len(self.pair) - 1)
        n = np.where(self.pair[at] == p, self.n[at], 0.0)
        return np.log((n + 2.0 * self.single[b]) / (self.first[a] + 2.0))

    def __call__(self, text: str) -> float:
        """log P(text), between blanks."""
        if len(self.pair) == 0:
            return 0.0
        c = _codes(" " + text + " ")
        return float(self._steps(c[:-1], c[1:]).sum())

    def hidden(self, tokens: list[str]) -> np.ndarray:
        """Whether each token could well come from a chain of single bytes."""
        out = np.zeros(len(tokens), dtype=bool)
        if len(self.pair) == 0:
            return out
        points = np.frombuffer((" " + " ".join(tokens) + " ").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        raw = _lookup()[points]
        ends = np.cumsum([len(t) + 1 for t in tokens])
        starts = ends - [len(t) + 1 for t in tokens]
        own = np.add.reduceat(self._steps(raw[:-1], raw[1:]), starts)
        for k in _HIDDEN:
            codes, other = _single_codes(k)
            back = codes[points]
            fits = ~np.logical_or.reduceat(back[1:] < 0, starts) & (np.add.reduceat(other[points[1:]].astype(np.int32), starts) > 0)
            back = np.maximum(back, 0)
            out |= fits & (np.add.reduceat(self._steps(back[:-1], back[1:]), starts) > own - MARGIN)
        return out


def _weigh(counts):
    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = _Model(counts.value)
        tokens = _Tokens(model)
        for b in batches:
            out = []
            for doc, pool, text, strange in zip(b["id"], b["pool"], b["text"], tokens.read(b["text"].tolist())):
                for start, end in stretches(text, strange) if strange else ():
                    raw = text[start:end]
                    beside = _beside(text, start, end)
                    base = model(raw) + _switches(raw, beside)
                    back: list[str | None] = [None] * K
                    fit: list[float | None] = [None] * K
                    fit[0] = base
                    for k in range(1, K):
                        if CHAINS[k][1] == "lost":
                            if LOST in raw:
                                fit[k] = model(raw.replace(LOST, "")) - 2.0 + _switches(raw, beside)
                            continue
                        if CHAINS[k][1] == "single" and sum(c.isalpha() for c in raw) < 2:
                            continue  # one letter alone shows nothing
                        new = " ".join(undo(t, k) for t in raw.split(" ")) if CHAINS[k][1] == "single" else undo(raw, k)
                        if new != raw and new not in back:
                            back[k] = new
                            lost = new.count(LOST)
                            fit[k] = model(new.replace(LOST, "")) - 4.0 * lost + _switches(new, beside)
                    if any(f is not None for f in fit[1:]):
                        out.append((doc, pool, start, end, fit, back))
            yield pd.DataFrame(out, columns=["id", "pool", "start", "end", "fit", "back"])

    return of


def _posterior(fit: str, share: str) -> str:
    w = f"transform({fit}, (f, i) -> if(f is null, cast(null as double), f + ln({share}[i])))"
    top = f"array_max({w})"
    e = f"transform({w}, x -> if(x is null, 0D, exp(x - {top})))"
    return f"transform({e}, y -> y / aggregate({e}, 0D, (s, z) -> s + z))"


def judged_stretches(texts: DataFrame, field: str = "text") -> DataFrame:
    """id, pool, start, end, back, post of every stretch that some chain could have made; post: the chains' posteriors, in the order of CHAINS.

    texts: id bigint, source, text. A null source is a pool of its own.
    """
    spark = texts.sparkSession
    rows = texts.select("id", F.concat_ws("\x1f", F.coalesce("source", F.lit("\x00")), F.lit(field)).alias("pool"), "text").where("id is not null and text is not null")
    counts = spark.sparkContext.broadcast(clean_model(rows))
    fits = cut(rows.mapInPandas(_weigh(counts), "id bigint, pool string, start int, end int, fit array<double>, back array<string>"), "fits").dropDuplicates(["id", "start"])
    fits = cut(fits, "stretches")
    start = [0.7] + [0.3 / (K - 1)] * (K - 1)
    overall = start
    shares: DataFrame | None = None
    moved = 0.0
    for _ in range(ROUNDS):
        one = F.array(*map(F.lit, overall))
        # Few rows: one a pool. Joined by hash; Spark broadcasts them while they are small, and splits a pool with a third of all stretches.
        joined = fits.withColumn("share", one) if shares is None else fits.join(shares, "pool")
        post = joined.select("pool", F.expr(_posterior("fit", "share")).alias("post"))
        sums = [F.sum(F.col("post")[k]).alias(f"s{k}") for k in range(K)]
        pools = cut(post.groupBy("pool").agg(F.count("*").alias("n"), *sums), "shares")
        total = pools.agg(F.sum("n").alias("n"), *(F.sum(f"s{k}").alias(f"s{k}") for k in range(K))).first()
        before = overall
        overall = [((total[f"s{k}"] or 0.0) + 0.5) / ((total["n"] or 0) + 0.5 * K) for k in range(K)]
        shares = pools.select("pool", F.array(*((F.col(f"s{k}") + SHRINK * overall[k]) / (F.col("n") + SHRINK) for k in range(K))).alias("share"))
        moved = max(abs(a - b) for a, b in zip(before, overall))
        if moved < 1e-4:
            break
    else:
        warnings.warn(f"shares of encoding chains: still moving by {moved:.2g} after {ROUNDS} rounds", stacklevel=2)
    return fits.join(shares, "pool").select("id", "pool", "start", "end", "back", F.expr(_posterior("fit", "share")).alias("post"))


def garbled(texts: DataFrame) -> DataFrame:
    """Stretches that were more probably garbled than not: id, start, end, chain, confidence, restored.

    restored is null where bytes were lost and nothing can be regained; a sequence with a lost byte comes back as U+FFFD. Null and
    empty texts have no stretches; a repeated id counts once.
    """
    best = judged_stretches(texts).withColumn("clean", F.col("post")[0]).where("clean < 0.5")
    k = F.expr(f"array_position(slice(post, 2, {K - 1}), array_max(slice(post, 2, {K - 1})))")
    names = F.array(*(F.lit(c[0]) for c in CHAINS))
    return best.withColumn("k", k.cast("int")).select("id", "start", "end", F.get(names, F.col("k")).alias("chain"), (1 - F.col("clean")).alias("confidence"), F.get("back", F.col("k")).alias("restored"))


@F.pandas_udf(StringType())
def _mended(text: pd.Series, edits: pd.Series) -> pd.Series:
    out = []
    for t, es in zip(text, edits):
        for e in sorted(es, key=lambda e: -e["start"]):
            t = t[: e["start"]] + e["restored"] + t[e["end"] :]
        out.append(t)
    return pd.Series(out, dtype=object)


def restore(texts: DataFrame) -> DataFrame:
    """id, chains, confidence (of the surest stretch), n_stretches, text, restored_text of every affected text."""
    found = garbled(texts).groupBy("id").agg(
        F.array_sort(F.collect_set("chain")).alias("chains"),
        F.max("confidence").alias("confidence"),
        F.count("*").alias("n_stretches"),
        F.collect_list(F.when(F.col("restored").isNotNull(), F.struct("start", "end", "restored"))).alias("edits"),
    )
    own = texts.select("id", "text").where("text is not null").join(found, "id").groupBy("id").agg(F.min("text").alias("text"), *(F.first(c).alias(c) for c in found.columns if c != "id"))
    return own.select("id", "chains", "confidence", "n_stretches", "text", _mended("text", "edits").alias("restored_text"))
