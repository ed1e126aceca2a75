"""Editions paired by name, against SQL, on rows that are odd."""

import duckdb
import pandas as pd

import __spark_entry__ as entry
from warraq.operators import alignment


def test_pair_editions_against_sql(spark, tmp_path):
    """No name, a mark in names and in dictionaries, several numbers under one name; and no entry times dictionary that doesn't have its name."""
    rows = [("kamus_asl", 1, "زيد"), ("kamus_asl", 2, "زيد"), ("kamus_asl", 9, "زيد"), ("kamus_asl", 3, None), ("kamus_asl", 4, "c"), ("kamus_asl", 5, "b#c"), ("kamus_asl", None, "زيد"), ("kamus_asl", 6, "لا أحد")]
    rows += [("a", 8, "زيد"), ("a", 15, "زيد"), ("a", 4, "b#c"), ("a", 6, None), ("a#b", 5, "c"), ("c", None, "زيد"), ("c", 13, "زيد"), (None, 1, "زيد"), ("d", 1, "غيره")]
    pd.DataFrame(rows, columns=["source", "entry_num", "name_ar"]).astype({"entry_num": "Int32"}).to_parquet(tmp_path / "person_entries.parquet")
    con = duckdb.connect()
    con.sql(f"create view person_entries as select * from '{tmp_path}/person_entries.parquet'")
    got = entry.queries()["pair_editions"](spark, str(tmp_path))
    want = con.sql(entry.oracle_sql()["pair_editions"]).fetchall()
    assert sorted((r.num_left, r.num_right, r.key) for r in got.collect()) == sorted(want) and len(want) == 4
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Cross" not in plan and "Join Inner\n" not in plan


def test_pair_editions_by_whole_numbers(spark, tmp_path):
    """Any number of entries of one name take part, each under its own number; numbers further apart than five are no pair."""
    rows = [("kamus_asl", n, "زيد") for n in range(1, 41)] + [("a", n, "زيد") for n in range(3, 43)] + [("b", 100, "زيد"), ("b", 46, "زيد"), ("kamus_asl", 50, "c"), ("a", 57, "c")]
    pd.DataFrame(rows, columns=["source", "entry_num", "name_ar"]).astype({"entry_num": "Int32"}).to_parquet(tmp_path / "person_entries.parquet")
    con = duckdb.connect()
    con.sql(f"create view person_entries as select * from '{tmp_path}/person_entries.parquet'")
    got = sorted((r.num_left, r.num_right, r.key) for r in entry.queries()["pair_editions"](spark, str(tmp_path)).collect())
    assert got == sorted(con.sql(entry.oracle_sql()["pair_editions"]).fetchall())
    free, want = set(range(3, 43)), []
    for n in range(1, 41):
        near = [m for m in sorted(free, key=lambda m: (abs(m - n), m < n)) if abs(m - n) <= 5]
        if near:
            free.remove(near[0])
            want.append((n, near[0], "a#زيد"))
    assert got == sorted(want) and len(want) > 7


def test_pair_editions_one_row_a_key(spark):
    """Keys of one edition only don't reach Python."""
    left = spark.range(2000).selectExpr("cast(id as int) as num", "concat('k', id) as key")
    right = spark.createDataFrame([(3, "k3"), (9, "k4")], "num int, key string")
    got = alignment.pair_editions(left, right)
    assert [(r.num_left, r.num_right, r.key) for r in got.collect()] == [(3, 3, "k3"), (4, 9, "k4")]
    assert "FlatMapCoGroups" not in got._jdf.queryExecution().optimizedPlan().toString()
