import os
import random

import pytest

from warraq.llm import mixing, packing, tokens

SIZES = "id bigint, source string, n_tokens bigint, piece string, size int, rate double"


def sizes(spark, values):
    return spark.createDataFrame([(i, s, n, "x", 7, 0.1) for i, (s, n) in enumerate(values)], SIZES)


def check(rows, lengths, capacity):
    used, whole = {}, {}
    for r in rows:
        used[r.container_id] = used.get(r.container_id, 0) + r.n_tokens
        whole.setdefault(r.id, []).append((r.piece, r.first_token, r.n_tokens))
    assert max(used.values()) <= capacity
    assert set(whole) == set(range(len(lengths)))
    for i, n in enumerate(lengths):
        parts = sorted(whole[i])
        assert sum(p[2] for p in parts) == n
        assert len(parts) == max(1, -(-n // capacity))
        assert [p[1] for p in parts] == [k * capacity for k in range(len(parts))]
    return used


def test_nothing_lost_little_unused(spark):
    rng = random.Random(2)
    lengths = [int(rng.lognormvariate(5, 1.2)) for _ in range(4000)] + [0, 0, 512, 513, 1024, 99_999] + [100] * 2000
    rows = packing.pack(sizes(spark, [("s", n) for n in lengths]), 512).collect()
    used = check(rows, lengths, 512)
    assert sum(used.values()) / (len(used) * 512) > 0.97
    groups = {}
    for r in rows:
        groups.setdefault(r.step_group, 0)
        groups[r.step_group] += r.n_tokens
    full = [v for v in groups.values()]
    assert max(full) - min(full) <= 2 * 512
    windows = {}
    for r in rows:
        windows[(r.tier, r.window_no)] = windows.get((r.tier, r.window_no), 0) + r.n_tokens
        k = packing.tiers(512).index(r.tier)
        assert r.n_tokens == 0 or r.container_id == r.window_no // packing.TIER_STEP**k
    assert len({t for t, _ in windows}) > 1 and all(n <= t and (t == 512 or n >= t - t // packing.SLACK) for (t, _), n in windows.items())


def test_ties_and_extremes(spark):
    for values, capacity in (([300] * 5, 512), ([512] * 3, 512), ([1], 1), ([0], 10), ([5, 5, 5, 5], 10), ([7] * 4 + [3] * 4, 10)):
        used = check(packing.pack(sizes(spark, [("s", n) for n in values]), capacity).collect(), values, capacity)
        best = {(300,) * 5: 5, (512,) * 3: 3, (1,): 1, (0,): 1, (5,) * 4: 2, (7,) * 4 + (3,) * 4: 4}[tuple(values)]
        assert len(used) == best
    assert packing.pack(sizes(spark, []), 10).count() == 0
    with pytest.raises(ValueError):
        packing.pack(sizes(spark, []), 0)


def test_plan_places_all():
    rng = random.Random(4)
    for capacity in (7, 64, 1000):
        counts = {rng.randrange(1, capacity + 1): rng.randrange(1, 500) for _ in range(60)}
        got = {}
        for _, pattern, windows in packing.plan(counts, capacity):
            assert sum(s * n for s, n in pattern) <= capacity and windows > 0
            for s, n in pattern:
                got[s] = got.get(s, 0) + n * windows
        assert got == counts


def test_tiers_decide():
    """Without tiers the windows are others; with them, short ones come out full."""
    rng = random.Random(7)
    counts = {}
    for _ in range(20_000):
        n = min(2048, max(1, int(rng.lognormvariate(5, 1.1))))
        counts[n] = counts.get(n, 0) + 1
    with_, without = packing.plan(counts, 2048), packing.plan(counts, 2048, [2048])
    assert with_ != without and {p[0] for p in without} == {2048} and len({p[0] for p in with_}) >= 3
    places, total = packing._places(with_, 2048)
    assert sum(s * n for s, n in counts.items()) / (total * 2048) > 0.998
    assert total <= packing._places(without, 2048)[1] + 3
    # Every container of the shorter windows but the last holds as many as it can.
    held = {}
    for _, pattern, windows in with_:
        assert sum(s * n for s, n in pattern) <= _
    for s, lo, hi, per, first, scale, tier in places:
        held.setdefault(tier, set()).update(range(first, first + (hi - lo) // per))
    ends = [(max(w) + 1) for t, w in sorted(held.items(), reverse=True)]
    starts = [min(w) for t, w in sorted(held.items(), reverse=True)]
    assert starts[0] == 0 and all(b == a * packing.TIER_STEP for a, b in zip(ends, starts[1:]))


def test_all_specs(spark):
    specs = spark.createDataFrame([(1, 8), (2, None), (1, 8), (3, 100)], "spec_id int, capacity int")
    out = packing.pack_all(sizes(spark, [("s", 9), ("s", 3)]), specs)
    assert {(r.spec_id, r.id, r.piece) for r in out.collect()} == {(1, 0, 0), (1, 0, 1), (1, 1, 0), (3, 0, 0), (3, 1, 0)}
    assert packing.pack_all(sizes(spark, [("s", 9)]), specs.limit(0)).count() == 0


def test_mixture(spark):
    docs = [("big", 10)] * 4000 + [("small", 10)] * 200 + [("unlisted", 10)] * 50 + [(None, 10)] * 5 + [("empty", 0)] * 3
    targets = spark.createDataFrame([("big", 0.5, 2), ("small", 0.5, 3), ("absent", 0.2, 2), ("empty", 0.1, 2), ("none", None, None), (None, 0.1, 1)], "source string, target_share double, max_repeats int")
    s = sizes(spark, docs)
    rate = mixing.rates(s, targets)
    got = {r.source: r.rate for r in rate.collect()}
    assert got["small"] == 3.0 and abs(got["big"] - 0.525) < 1e-9 and got["absent"] == got["empty"] == got["none"] == 0.0
    mixed = mixing.mix(s, rate).collect()
    copies = {}
    for r in mixed:
        copies.setdefault(r.id, []).append(r.copy_no)
    assert all(sorted(c) == list(range(1, len(c) + 1)) for c in copies.values())
    assert sum(r.source == "small" for r in mixed) == 600
    assert abs(sum(r.source == "big" for r in mixed) - 2100) < 150
    assert {r.source for r in mixed} == {"big", "small"}
    again = {(r.id, r.copy_no) for r in mixing.mix(s.repartition(7), rate).collect()}
    assert again == {(r.id, r.copy_no) for r in mixed}
    report = {r.source: r for r in mixing.shares(mixing.mix(s, rate), rate).collect()}
    assert report["small"].capped and not report["big"].capped and abs(sum(r.actual_share for r in report.values()) - 1) < 1e-9
    assert mixing.shares(mixing.mix(s.limit(0), rate), rate).count() == 5


@pytest.mark.skipif(not os.path.isdir(tokens.TOKENIZERS), reason="no vocabularies")
def test_sizes(spark):
    text = "قال الشيخ word " * 40_000
    df = spark.createDataFrame([(1, "s", "hello world"), (1, "s", "hello world"), (2, None, None), (3, "s", ""), (4, "s", text), (None, "s", "x"), (5, "s", "<|endoftext|>")], "id bigint, source string, text string").selectExpr("*", "1 as n_tokens")
    got = {r.id: r.n_tokens for r in tokens.with_sizes(df).collect()}
    encoding = tokens.tokenizer(f"{tokens.TOKENIZERS}/{tokens.VOCABULARY}")
    assert got[1] == len(encoding.encode_ordinary("hello world")) and got[2] == got[3] == 0 and set(got) == {1, 2, 3, 4, 5}
    assert got[4] == len(encoding.encode_ordinary(text)) and got[5] > 1
    rng = random.Random(3)
    for _ in range(300):
        odd = "".join(rng.choice(["a", "ب", " ", "  ", "\n", "\u00a0", "1", "٣", "'", "'s", ".", "…", "é", "e\u0301", "\u200b", "漢", "😀"]) for _ in range(rng.randrange(200)))
        assert tokens.count(encoding, odd, 7) == len(encoding.encode_ordinary(odd)), repr(odd)
    assert tokens.with_sizes(df.limit(0)).count() == 0


def test_many_specs(spark):
    sizes = spark.createDataFrame([(1, 5)], "id bigint, n_tokens int")
    specs = spark.range(30).selectExpr("cast(id as int) spec_id", "8 capacity")
    assert packing.pack_all(sizes, specs).count() == 30
