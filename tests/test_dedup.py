"""Deduplication against plain models."""

import random

import pandas as pd
import pytest
from conftest import rows

from refloom.operators.dedup import _Greedy, dedup_either, dedup_first, dedup_last, suffix_duplicates, upsert


def greedy(data, original=None):
    """Accept rows in order unless an accepted one shares a present key."""
    kept, seen, shown = [], set(), {(str(r[0]), r[1]): r for r in original or ()}
    for g, i, a, b in sorted(data, key=lambda r: (r[0], r[1])):
        keys = {(g, "a", a)} if a else set()
        keys |= {(g, "b", b)} if b else set()
        if not keys & seen:
            kept.append(shown.get((g, i), (g, i, a, b)))
            seen |= keys
    return sorted(kept, key=repr)


def test_either_key_chain(table):
    data = [("g", 1, "x", "p"), ("g", 2, "x", "q"), ("g", 3, "y", "q"), ("g", 4, None, None), ("g", 5, "", ""), ("g", 6, "y", "z")]
    df = table(data, "g string, i int, a string, b string")
    # Row 2 falls to row 1, so its second key does not block row 3.
    assert [r[1] for r in rows(dedup_either(df, ["g"], "a", "b", ["i"]))] == [1, 3, 4, 5]


def test_either_key_random(table):
    rnd = random.Random(5)
    for rounds, walk in ((0, 10_000), (1, 10_000), (3, 10_000), (0, 5), (1, 1), (0, 60)):
        data = [
            (rnd.choice([None, "u", "v"]), i, rnd.choice([None, "", *"abcdefghijkl"]), rnd.choice([None, *"ABCDEFGHIJKL"])) for i in range(150)
        ]
        df = table(data, "g string, i int, a string, b string").repartition(4)
        assert rows(dedup_either(df, ["g"], "a", "b", ["i"], rounds=rounds, walk=walk)) == greedy([(str(g), *r) for g, *r in data], data)


def ladder(n):
    """Every row waits for two earlier ones, so that neither first rows nor chains decide much."""
    return [("g", i, f"a{i // 2 * 7 % n}" if i % 2 else f"a{i // 3}", f"b{i // 3}" if i % 2 else f"b{i // 2 * 5 % n}") for i in range(n)]


@pytest.mark.parametrize("walk", [7, 40])
def test_either_key_ladder(table, walk):
    data = ladder(200) + [("g", 1000 + i, f"x{i // 2}", f"x{(i + 1) // 2}") for i in range(60)]
    df = table(data, "g string, i int, a string, b string").repartition(4)
    assert rows(dedup_either(df, ["g"], "a", "b", ["i"], walk=walk)) == greedy(data)


def test_either_key_prefixes_alone(table):
    data = ladder(120)
    df = table(data, "g string, i int, a string, b string")
    slim = df.selectExpr("g", "a as _a", "b as _b", "struct(i) as _at", "cast(i as long) as _id")
    steps = _Greedy(slim, ["g"])
    while not steps.open.isEmpty():
        steps.prefixes(16)
    assert sorted(r[0] for part in steps.accepted for r in part.collect()) == sorted(i for _, i, _, _ in greedy(data))


def test_either_key_long_chain(spark):
    """Every second row of a chain falls; a chain needs no round per row, and no task holds it."""
    n = 100_000
    df = spark.range(n).selectExpr("'g' as g", "id as i", "concat('a', (id + 1) div 2) as a", "concat('b', id div 2) as b").repartition(8)
    got = [r.i for r in dedup_either(df, ["g"], "a", "b", ["i"]).select("i").collect()]
    assert sorted(got) == list(range(0, n, 2))


def test_either_key_large_component(spark):
    """One component of a third of all rows, ten times what a task may walk through."""
    rnd = random.Random(8)
    data = [("big", i, f"a{rnd.randrange(40_000)}", f"b{rnd.randrange(40_000)}") for i in range(100_000)]
    data += [(f"g{i % 5000}", i, f"a{rnd.randrange(9)}", f"b{rnd.randrange(9)}") for i in range(200_000)]
    df = spark.createDataFrame(pd.DataFrame(data, columns=["g", "i", "a", "b"])).repartition(8)
    got = dedup_either(df, ["g"], "a", "b", ["i"]).toPandas()
    assert sorted(zip(got.g, got.i)) == sorted((g, i) for g, i, _, _ in greedy(data))


def test_first_last(table):
    df = table([("a", 2, "x"), ("a", 1, "y"), ("b", 1, "z"), (None, 5, "n"), (None, 6, "m")], "k string, at int, v string")
    assert rows(dedup_first(df, ["k"], ["at"])) == rows(table([("a", 1, "y"), ("b", 1, "z"), (None, 5, "n")], df.schema))
    assert rows(dedup_last(df, ["k"], ["at"])) == rows(table([("a", 2, "x"), ("b", 1, "z"), (None, 6, "m")], df.schema))


def test_upsert_keeps_listed_columns(table):
    ddl = "k int, name string, state string, at int"
    base = table([(1, "one", "old", 1), (2, "two", "old", 1)], ddl)
    delta = table([(1, "renamed", "new", 2), (1, "again", "newest", 3), (3, "three", "new", 1)], ddl)
    got = rows(upsert(base, delta, ["k"], ["at"], keep=["name"]))
    assert got == [(1, "one", "newest", 3), (2, "two", "old", 1), (3, "three", "new", 1)]


def test_suffixes(table):
    data = [(1, 0, "k", "a"), (1, 1, "k", "a"), (1, 2, "k", "b"), (1, 3, "k", "b"), (1, 4, "j", "b"), (2, 0, "k", "b")]
    df = table(data, "id int, pos int, label string, value string")
    for limit in (1, 100):
        got = rows(suffix_duplicates(df, ["id"], "label", "value", ["pos"], limit), "id", "label", "value")
        want = [(1, "j", "b"), (1, "k", "a"), (1, "k (2)", "b"), (1, "k (3)", "b"), (2, "k", "b")]
        assert got == sorted(want, key=repr)
