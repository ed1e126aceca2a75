"""Entries and persons that are alike, in matching."""

import math
import random

from warraq.llm import matching, names

ENTRY = "entry_id bigint, source string, name_ar string, name_norm string, kunya string, town string, death_h int"
PERSON = ENTRY.replace("entry_id bigint, source string", "ishabah_id int")
WORDS = ["زيد", "عمرو", "خالد", "سعد", "مالك", "بشر", "بكر", "سهيل", "عامر", "طلحة", "حمزة", "ليث"]


def test_alike_in_propagation(spark):
    """Messages among entries and persons that are alike are those of the pairs written out."""
    units = [(10, 1, 2, 1, "x", 1.0), (10, 2, 2, 3, "x", 0.5), (20, 2, 1, 3, "x", 2.0), (20, 3, 1, 1, "x", -1.0), (30, 1, 3, 1, None, 0.2), (40, 3, 1, 1, "y", 1.5)]
    short = spark.createDataFrame(units, "entry bigint, person bigint, entries bigint, persons bigint, source string, score double")
    long = [(e * 10 + i, p * 10 + j, s, x) for e, p, n, m, s, x in units for i in range(n) for j in range(m)]
    whole = spark.createDataFrame(long, "entry bigint, person bigint, source string, score double")
    got = {(r.entry, r.person): r.marginal for r in matching.propagate(short).collect()}
    want = {(r.entry, r.person): r.marginal for r in matching.propagate(whole).collect()}
    assert len(want) == len(long) and all(abs(got[e // 10, p // 10] - m) < 1e-9 for (e, p), m in want.items())


def test_alike_meet_once(spark, monkeypatch):
    """Persons and entries that are repeated make no more pairs, and each gets the link that the first has."""
    r = random.Random(3)
    of = lambda: (" بن ".join(r.sample(WORDS, 4)), None, None, r.choice(("مكة", "البصرة")), r.randint(50, 300))
    persons = [(i, *of()) for i in range(1, 31)]
    entries = [(100 + i, r.choice("xyz"), *p[1:]) for i, p in enumerate(persons)]
    copies = [(e[0] + 1000 * k, f"{e[1]}{k}", *e[2:]) for k in range(20) for e in entries]
    seen = []
    plain = names.graded
    monkeypatch.setattr(names, "graded", lambda pairs, people: seen.append(pairs.count()) or plain(pairs, people))
    run = lambda e: {x.entry_id: (x.ishabah_id, x.confidence) for x in matching.resolve(spark.createDataFrame(e, ENTRY), spark.createDataFrame(persons, PERSON)).collect()}
    run(entries)
    got = run(copies)
    assert len(got) == len(copies) and all(got[100 + i + 1000 * k][0] == i + 1 for k in range(20) for i in range(30))
    assert seen[0] == seen[1]


def test_alike_are_parsed_once(spark, monkeypatch):
    """Names of records that are stored alike are parsed once; of an id with several records the least counts."""
    r = random.Random(4)
    of = lambda: (" بن ".join(r.sample(WORDS, 4)), None, None, r.choice(("مكة", "البصرة")), r.randint(50, 300))
    persons = [(i, *of()) for i in range(1, 31)]
    entries = [(100 + i, r.choice("xyz"), *p[1:]) for i, p in enumerate(persons)]
    copies = [(e[0] + 1000 * k, f"{e[1]}{k}", *e[2:]) for k in range(20) for e in entries]
    seen = []
    plain = names.profiles
    monkeypatch.setattr(names, "profiles", lambda rows: seen.append(rows.count()) or plain(rows))
    run = lambda e: {x.entry_id: x.ishabah_id for x in matching.resolve(spark.createDataFrame(e, ENTRY), spark.createDataFrame(persons, PERSON)).collect()}
    run(entries)
    # Twice the same, and with another record: a null name comes before a name, and has nobody.
    got = run([*copies, copies[3], (copies[5][0], "x0", None, None, None, None, None), (None, "x", "زيد", None, None, None, None)])
    assert seen[1] - seen[0] <= 2
    assert got == {100 + i + 1000 * k: i + 1 for k in range(20) for i in range(30) if (k, i) != (0, 5)}


def test_pairs_without_rivals_send_no_messages(spark, monkeypatch):
    """Of an entry that has a rival for one person, the pairs with other persons stay out of the rounds, and count all the same."""
    pairs = [(1, 10, "a", 1.0), (2, 10, "a", 0.5), *((2, 20 + i, "a", 0.1 * i) for i in range(5)), *((1, 30 + i, "a", -0.2 * i) for i in range(5))]
    seen = []
    plain = matching.cut
    monkeypatch.setattr(matching, "cut", lambda df, name: (lambda t: (seen.append(t.count()) if name == "messages" else None, t)[1])(plain(df, name)))
    df = spark.createDataFrame(pairs, "entry bigint, person bigint, source string, score double")
    got = {(r.entry, r.person): r.marginal for r in matching.propagate(df).collect()}
    assert set(seen) == {2} and len(got) == len(pairs)
    for entry in (1, 2):
        assert sum(m for (e, _), m in got.items() if e == entry) < 1
    best = {r.entry: (r.person, r.marginal) for r in matching.likeliest(df.where("entry = 1 and person = 10")).collect()}
    assert best[1][0] == 10 and abs(best[1][1] - math.e / (1 + math.e)) < 1e-9
