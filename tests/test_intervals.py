import random

from pyspark.sql import functions as F

from warraq.operators.intervals import periods_and_gaps

SCHEMA = "e string, a int, b int, _k0 string, level int, mask bigint, f int"


def by_hand(rows):
    out = set()
    for e in {r[0] for r in rows}:
        spans = sorted((a, b) for x, a, b, *_ in rows if x == e and a is not None and b is not None and a <= b)
        merged = []
        for a, b in spans:
            if merged and a <= merged[-1][1] + 1:
                merged[-1][1] = max(merged[-1][1], b)
            else:
                merged.append([a, b])
        out |= {(e, "period", a, b) for a, b in merged}
        out |= {(e, "gap", x[1] + 1, y[0] - 1) for x, y in zip(merged, merged[1:])}
    return out


def run(spark, rows):
    full = [(*r, "x", 1, 2, 3) for r in rows]
    df = spark.createDataFrame(full, SCHEMA)
    got = [tuple(r) for r in periods_and_gaps(df, [F.col("e")], F.col("a"), F.col("b")).collect()]
    assert len(got) == len(set(got))
    assert set(got) == by_hand(rows)


def test_random_intervals(spark):
    rng = random.Random(5)
    rows = []
    for e in "abcdefgh":
        width = rng.choice([5, 70, 5000, 300_000, 2**30])
        for _ in range(60):
            a = rng.randrange(-width, width)
            rows.append((e, a, min(2**31 - 1, a + rng.randrange(0, max(1, width // 8)))))
    rows += [("hot", i * 3, i * 3 + rng.randrange(3)) for i in range(2000)]
    run(spark, rows)


def test_extremes_nulls_and_repeats(spark):
    lo, hi = -(2**31), 2**31 - 1
    run(spark, [("all", lo, hi), ("all", 5, 6), ("edge", lo, lo), ("edge", hi, hi), ("edge", 262143, 262144), (None, 1, 2), (None, 4, 4), ("n", None, 3), ("n", 3, None), ("r", 5, 4), ("t", 1, 2), ("t", 1, 2), ("t", 3, 3)])


def test_empty(spark):
    run(spark, [])
