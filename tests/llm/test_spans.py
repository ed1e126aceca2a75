import random

from warraq.llm import spans

SCHEMA = "id bigint, text string, symbol int, before string, left string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, "x", "y") for i, t in rows], SCHEMA)


def brute(rows, least=80):
    at = {}
    for i, t in rows:
        if i is not None and t:
            for k in range(len(t) - least + 1):
                at.setdefault(t[k : k + least], set()).add(i)
    return {(a, b) for ids in at.values() for a in ids for b in ids if a < b}


def brute_share(rows, least=80):
    at = {}
    for i, t in rows:
        for k in range(len(t or "") - least + 1):
            at.setdefault(t[k : k + least], set()).add(i)
    out = {}
    for i, t in rows:
        hit = [False] * len(t or "")
        for k in range(len(t or "") - least + 1):
            if len(at[t[k : k + least]]) > 1:
                hit[k : k + least] = [True] * least
        out[i] = (None if t is None else len(t), None if t is None else sum(hit))
    return out


def corpus(seed):
    rng = random.Random(seed)
    alphabet = "ابتثجحخ دذرز" if seed % 2 else "ab "
    text = lambda n: "".join(rng.choice(alphabet) for _ in range(n))
    shared = [text(n) for n in (79, 80, 81, 90, 120, 300)] + ["." * 200, "ab" * 90, "abc " * 60]
    rows = []
    for i in range(60):
        t = text(rng.randrange(0, 120))
        for _ in range(rng.randrange(0, 3)):
            s = rng.choice(shared)
            cut = rng.randrange(0, 30)
            t += s[cut:] + text(rng.randrange(0, 60))
        rows.append((i, t))
    return rows + [(100, rows[0][1]), (101, rows[0][1]), (102, None), (103, ""), (104, shared[4]), (105, shared[4])]


def test_pairs_are_exact(spark):
    for seed in range(4):
        rows = corpus(seed)
        got = [tuple(r) for r in spans.shared_pairs(frame(spark, rows)).collect()]
        assert len(got) == len(set(got))
        assert set(got) == brute(rows)


def test_astral_characters_and_periods(spark):
    rows = [(1, "😀" * 100), (2, "x" + "😀" * 85), (3, "😀" * 79), (4, "xy" * 200), (5, "yx" * 41), (6, "-" * 80), (7, "a" + "-" * 80 + "b"), (8, "-" * 79)]
    got = {tuple(r) for r in spans.shared_pairs(frame(spark, rows)).collect()}
    assert got == brute(rows)


def test_shares_are_exact(spark):
    rows = corpus(3)
    got = {r.id: (r.n_chars, r.shared_chars) for r in spans.shared_share(frame(spark, rows)).collect()}
    assert got == brute_share(rows)


def test_repeats_nulls_and_long_texts(spark):
    rng = random.Random(9)
    long = "".join(rng.choice("abcdefgh ") for _ in range(1_500_000))
    rows = [(1, long), (1, long), (2, long[700_000:700_080]), (3, long[10:89]), (None, long), (4, None)]
    assert {tuple(r) for r in spans.shared_pairs(frame(spark, rows)).collect()} == {(1, 2)}


def test_a_passage_in_a_third_of_all_texts(spark):
    """Its symbols are spread over many tasks, and meet the rows of texts in which they are rare."""
    import numpy as np

    rng = random.Random(5)
    text = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    passage = text(110)
    rows = [(i, text(60) + (passage[rng.randrange(20) :] if i % 3 == 0 else "") + text(50)) for i in range(240)] + [(999, "x" + passage)]
    told = spans.symbols(np.arange(240), [t for _, t in rows[:240]])
    assert told["known"].any() and (told["salt"] > 0).sum() > 50
    # Each row a partition of its own or all in one: the same pairs.
    for parts in (1, 16):
        df = frame(spark, rows).repartition(parts)
        assert {tuple(r) for r in spans.shared_pairs(df).collect()} == brute(rows)
    assert {r.id: (r.n_chars, r.shared_chars) for r in spans.shared_share(frame(spark, rows)).collect()} == brute_share(rows)


def test_empty(spark):
    assert spans.shared_pairs(frame(spark, [])).count() == 0
    assert spans.shared_share(frame(spark, [])).count() == 0


def test_borders_are_never_far_apart():
    import numpy as np

    rng = random.Random(1)
    for alphabet in ("ab", "abcdefghijkl", "a"):
        t = "".join(rng.choice(alphabet) for _ in range(20_000))
        points = np.frombuffer(t.encode("utf-32-le"), dtype=np.uint32)
        at = spans.borders(points, np.array([0]))
        assert int(np.diff(np.append(at, len(t))).max()) <= 2 * spans.CAPS[-1]
