import itertools
import math
import os
import random

import pytest
from pyspark.sql import functions as F

from warraq.llm import matching, names


def damerau(a, b):
    last, big = {}, len(a) + len(b)
    d = [[big] * (len(b) + 2) for _ in range(len(a) + 2)]
    for i in range(len(a) + 1):
        d[i + 1][1] = i
    for j in range(len(b) + 1):
        d[1][j + 1] = j
    for i in range(1, len(a) + 1):
        l = 0
        for j in range(1, len(b) + 1):
            k, same = last.get(b[j - 1], 0), a[i - 1] == b[j - 1]
            d[i + 1][j + 1] = min(d[i][j] + (not same), d[i + 1][j] + 1, d[i][j + 1] + 1, d[k][l] + (i - k - 1) + 1 + (j - l - 1))
            l = j if same else l
        last[a[i - 1]] = i
    return d[-1][-1]


def words(n, seed, alphabet="ابتثج", longest=7):
    rng = random.Random(seed)
    return ["".join(rng.choice(alphabet) for _ in range(rng.randrange(1, longest))) for _ in range(n)]


def test_within_the_radius(spark):
    many = words(60, 1) + ["", "ابتث", "اتبث", "بااتث", "ا" * 3000 + "ب", "ا" * 2999 + "با", "ا" * 2999 + "بت"]
    pairs = [(x, y) for x in words(40, 2) + many[-7:] for y in many]
    got = spark.createDataFrame(pairs, "x string, y string").select(names.near(F.col("x"), F.col("y")).alias("n")).collect()
    for (x, y), r in zip(pairs, got):
        want = damerau(x, y) <= 1 if len(x) + len(y) < 50 else names.close(x, y)
        assert names.close(x, y) == want and bool(r.n) == want, (x, y)


def test_distances_to_pivots():
    """A pivot repeats the letters of a set; the distance to it counts a word's letters outside the set."""
    for w in words(25, 5, longest=5):
        for letters in ("ا", "بت", "ابج", "ابتثج"):
            pivot = letters * 9
            assert damerau(w, pivot) == len(pivot) - sum(c in letters for c in w)


def test_radius_join_is_exact(spark):
    long = ["x" * 60, "x" * 61, "y" * 5000, "y" * 5001, "y" * 4999 + "xy"]
    some = sorted(set(words(250, 3))) + long
    rows = [(w, "cell") for w in some + some[:40]] + [(None, "x"), ("", "x")]
    got = {tuple(r) for r in names.near_parts(spark.createDataFrame(rows, "word string, cell string")).collect()}
    want = {(a, b) for a in some for b in some if names.close(a, b)}
    assert got == want and ("x" * 60, "x" * 61) in got and ("y" * 5001, "y" * 4999 + "xy") in got
    assert names.near_parts(spark.createDataFrame([], "word string")).count() == 0


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.1"), reason="no test tables")
def test_every_fiftieth_name_against_all(spark):
    """The radius join's neighbours of every fiftieth entry's parts, against brute force over all parts."""
    entries = spark.read.parquet("/root/testdata/sf0.1/person_entries.parquet").select("entry_id", names.parts("name_ar", "name_norm").alias("p"))
    rows = entries.select("entry_id", F.explode(F.concat(F.array("p.own", "p.nisba", "p.kunya"), F.coalesce("p.chain", F.array()))).alias("word")).where("word is not null").distinct()
    all_ = {r.word for r in rows.select("word").distinct().collect()}
    asked = {r.word for r in rows.where("entry_id % 50 = 0").select("word").distinct().collect()}
    want = {(x, y) for x in asked for y in all_ if abs(len(x) - len(y)) <= 1 and names.close(x, y)}
    near = {tuple(r) for r in names.near_parts(rows).collect()}
    assert len(asked) > 100 and {p for p in near if p[0] in asked} == want


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.1"), reason="no test tables")
def test_candidates_of_every_fiftieth_entry_against_all_pairs(spark):
    """Pairs that the odds link, with the prior of all pairs instead of those that met, among every fiftieth entry and all entries: nearly all of them meet."""
    rows = spark.read.parquet("/root/testdata/sf0.1/person_entries.parquet").select(F.col("entry_id").alias("rid"), F.lit(0).alias("side"), "name_ar", "name_norm", "kunya", "town", "death_h").distinct()
    people = names.profiles(rows).cache()
    met = names.meetings(people).cache()
    of, base = names.odds(names.graded(met, people))
    asked = people.where("rid % 50 = 0").select(F.col("rid").alias("a"))
    every = names.graded(asked.join(people.select(F.col("rid").alias("b")), F.col("a") != F.col("b")), people)
    score = F.lit(base - math.log(people.count() ** 2 / 2 / met.count()))
    for f in names.FIELDS:
        score = score + F.element_at(F.array(*map(F.lit, of[f])), F.col(f) + 1)
    linked = {(r.a, r.b) for r in every.where(score >= 0).select("a", "b").collect()}
    pairs = {(r.a, r.b) for r in met.collect()}
    found = sum(p in pairs or p[::-1] in pairs for p in linked)
    assert len(linked) > 100 and found >= 0.98 * len(linked), (found, len(linked))


@pytest.mark.parametrize(
    "name, own, chain, nisba, kunya",
    [
        ("ايو تاخث موخف بن لوغط الزقاغي", "موخف", ["لوغط"], "الزقاغي", "تاخث"), ("شبو صحاط طرو اليرذي", "شبو", ["صحاط", "طرو"], "اليرذي", None),
        ("ابن لثاخ، شبو الموطي", "شبو", ["لثاخ"], "الموطي", None), ("ذتاه اب معذر بن خوبز", "ذتاه", ["معذر", "خوبز"], None, None), ("زيد بنن عمرو", "زيد", ["عمرو"], None, None),
        ("عند اللييت بن مويت القخابي", "عبداللييت", ["مويت"], "القخابي", None), ("عبيد القرشي", "عبيد", [], "القرشي", None),
    ],
)
def test_mistyped_words_between_names(name, own, chain, nisba, kunya):
    assert names.parse(name)[:4] == (own, chain, nisba, kunya)


@pytest.mark.parametrize(
    "name, own, chain, nisba, kunya, laqab, sex",
    [
        ("زيد بن عمرو بن خالد القرشي", "زيد", ["عمرو", "خالد"], "القرشي", None, None, "m"),
        ("القرشي، زيد بن عمرو", "زيد", ["عمرو"], "القرشي", None, None, "m"),
        ("ابن عمرو، زيد القرشي", "زيد", ["عمرو"], "القرشي", None, None, None),
        ("أبو محمد القرشي واسمه زيد", "زيد", [], "القرشي", "محمد", None, "m"),
        ("القرشي أبو عبد الله زيد ابن عمرو رضي الله عنه", "زيد", ["عمرو"], "القرشي", "عبدالله", None, "m"),
        ("أُمّ سَلَمة هند بنت أمية", "هند", ["اميه"], None, "سلمه", None, "f"),
        ("ذو اليدين، زيد ب عمرو", "زيد", ["عمرو"], None, None, "اليدين", "m"),
        ("زيد بن ع. القرشي", "زيد", ["ع."], "القرشي", None, None, "m"),
        ("ﺯﻳﺪ ب⁠ن عبدالله", "زيد", ["عبدالله"], None, None, None, "m"),
        ("", None, [], None, None, None, None), (None, None, [], None, None, None, None), ("بن", None, [], None, None, None, None), ("،", None, [], None, None, None, None),
    ],
)
def test_parse(name, own, chain, nisba, kunya, laqab, sex):
    got = names.parse(name)
    if name == "بن":
        assert got[1] == []
    elif name and name.startswith("ابن"):
        assert got[0] == own and got[1] == chain and got[2] == nisba
    else:
        assert got == (own, chain, nisba, kunya, laqab, sex)


def exhaustive(pairs, second):
    """Marginals by summing over all assignments."""
    entries = sorted({e for e, *_ in pairs})
    options = {e: [None, *[(p, s, w) for x, p, s, w in pairs if x == e]] for e in entries}
    total, mass = 0.0, {}
    for choice in itertools.product(*(options[e] for e in entries)):
        weight, held = 1.0, {}
        for c in choice:
            if c:
                weight *= math.exp(c[2])
                held[(c[0], c[1])] = held.get((c[0], c[1]), 0) + 1
        for n in held.values():
            weight *= second ** (n - 1)
        total += weight
        for e, c in zip(entries, choice):
            if c:
                mass[(e, c[0])] = mass.get((e, c[0]), 0.0) + weight
    return {k: v / total for k, v in mass.items()}


def test_belief_propagation_on_a_tree_is_exact(spark):
    pairs = [(1, 10, "a", 1.0), (2, 10, "a", 0.5), (2, 11, "a", 0.2), (3, 12, "a", -1.0), (4, 12, "b", 2.0), (5, 13, None, 0.3)]
    df = spark.createDataFrame([(*p, 9.0, 9.0) for p in pairs], "entry bigint, person bigint, source string, score double, w double, nu double")
    got = {(r.entry, r.person): r.marginal for r in matching.propagate(df, rounds=40).collect()}
    want = exhaustive([(e, p, s or "", w) for e, p, s, w in pairs], matching.SECOND)
    assert set(got) == set(want)
    for k, v in want.items():
        assert abs(got[k] - v) < 0.02
    assert matching.propagate(df.limit(0)).count() == 0


def people(spark, seed=1, n=60):
    rng = random.Random(seed)
    pool = sorted(set(words(400, seed, "بتثجحخدذرزسشصضطظعغفقكلمنهو", 7)) - {"ب"})
    pool = [w for w in pool if len(w) > 3]
    persons, entries, true = [], [], {}
    for i in range(n):
        own, father, grand, nisba, kunya, town = rng.sample(pool, 6)
        persons.append((i, f"{own} بن {father} بن {grand} ال{nisba}ي", None, f"أبو {kunya}", town, 100 + i))
        forms = [f"{own} بن {father} ال{nisba}ي", f"ال{nisba}ي، {own} بن {father} بن {grand}", f"أبو {kunya} ال{nisba}ي واسمه {own}", f"{own} بن {father[:1] + father[2:]} ال{nisba}ي"]
        for k in range(2):
            e = 1000 + 2 * i + k
            true[e] = i
            entries.append((e, f"d{k}", rng.choice(forms), None, f"أبو {kunya}" if rng.random() < 0.6 else None, town if rng.random() < 0.7 else None, 100 + i if rng.random() < 0.7 else None))
    for j in range(20):
        own, father, nisba = rng.sample(pool, 3)
        entries.append((5000 + j, "d0", f"{own} بن {father} ال{nisba}ي", None, None, None, None))
    return persons, entries, true


PERSON = "ishabah_id int, name_ar string, name_norm string, kunya string, town string, death_h int"
ENTRY = "entry_id bigint, source string, name_ar string, name_norm string, kunya string, town string, death_h int"


def test_resolve(spark):
    persons, entries, true = people(spark)
    odd = [(9000, None, None, None, None, None, None), (9001, "d0", "", "", "", "", None), (9002, "d0", "ا" * 20_000, None, None, None, None), (None, "d0", "زيد", None, None, None, None), entries[0]]
    e = spark.createDataFrame([(*r, "x") for r in entries + odd], ENTRY + ", score string")
    p = spark.createDataFrame([(*r, "x") for r in [*persons, (None, "زيد", None, None, None, None), (999, None, None, None, None, None)]], PERSON + ", side string")
    got = {r.entry_id: (r.ishabah_id, r.confidence) for r in matching.resolve(e, p).collect()}
    right = sum(got.get(k, (None,))[0] == v for k, v in true.items())
    assert right >= 0.95 * len(true)
    assert sum(k not in true for k in got) <= 2
    assert matching.resolve(e.limit(0), p).count() == 0
    assert matching.resolve(e, p.limit(0)).count() == 0


def test_crowded_keys_are_spread(spark):
    """Salted or not, the same pairs meet; here a third of all entries bear one name."""
    persons, entries, _ = people(spark, 3, 30)
    crowd = [(7000 + i, "d0", "زيد بن عمرو القرشي" if i % 5 else "زيد بن عمر القرشي", None, "أبو خالد", f"بلد{i % 7}", 100 + i) for i in range(40)]
    rows = [(r[0], 1, *r[2:]) for r in entries + crowd] + [(-r[0] - 1, 0, *r[1:]) for r in [*persons, (99, "زيد بن عمرو القرشي", None, "أبو خالد", None, None)]]
    p = names.profiles(spark.createDataFrame(rows, "rid bigint, side int, name_ar string, name_norm string, kunya string, town string, death_h int")).cache()
    for across in (False, True):
        plain, salted = ({tuple(r) for r in names.meetings(p, across, hot).collect()} for hot in (10**9, 4))
        assert plain == salted and len(plain) >= (40 if across else 40 * 39 // 2)


def test_same_person(spark):
    persons, entries, true = people(spark, 2)
    rows = [(*r, False) for r in entries] + [(i, "c", *r[1:], True) for i, r in enumerate(persons)]
    df = spark.createDataFrame([*rows, rows[0], (7777, *rows[0][1:]), (None, "d", "زيد", None, None, None, None, False), (8888, None, None, None, None, None, None, None)], ENTRY + ", canonical boolean")
    got = [(r.entry_id_a, r.entry_id_b) for r in matching.same_person(df).collect()]
    assert len(got) == len(set(got)) and all(a < b for a, b in got)
    whose = {**true, **{i: i for i in range(len(persons))}, 7777: true[rows[0][0]]}
    want = {(a, b) for a in whose for b in whose if a < b and whose[a] == whose[b]}
    assert len(want & set(got)) >= 0.95 * len(want) and len(set(got) - want) <= 0.02 * len(want)
    rows = matching.linked_entries(df).collect()
    n_links = {r.entry_id: r.n_links for r in rows}
    assert len(n_links) == len(rows) and n_links == {e: sum(e in p for p in got) for e in n_links}
    assert matching.linked_entries(df.limit(0)).count() == 0
    assert matching.same_person(df.limit(0)).count() == 0


