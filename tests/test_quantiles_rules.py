"""Quantiles in two scans against sorting, and rules held as data against a contains join."""

import random

import pytest
from pyspark.sql import Window, functions as F

from provisio.operators import monitoring, quantiles, rule_match

RNG = random.Random(8)
NAN = float("nan")


@pytest.mark.parametrize("accuracy, in_window", [(8, 100_000), (10_000, 0)])
def test_ranks_of_several_columns(spark, monkeypatch, accuracy, in_window):
    monkeypatch.setattr(quantiles, "ACCURACY", accuracy)
    monkeypatch.setattr(quantiles, "RANK_ROWS", in_window)
    rows = [(RNG.choice([None, NAN, 7.0, RNG.randrange(100) / 1.0]), RNG.randrange(10**6), None) for _ in range(900)]
    df = spark.createDataFrame(rows, "a double, b long, c double").repartition(5)
    sorted_a = sorted(r[0] for r in rows if r[0] is not None and r[0] == r[0])
    sorted_b = sorted(float(r[1]) for r in rows)
    ranks = [1, 2, 100, len(sorted_a) // 2, len(sorted_a), len(sorted_a) + 5000, 0]
    got = quantiles.exact_ranks(df, {"a": ranks, "b": [1, 450, 451, 900], "c": [1]})
    assert got["c"] == {} and sorted(got["a"]) == sorted({r for r in ranks if 1 <= r <= len(sorted_a)})
    for values, found in ((sorted_a, got["a"]), (sorted_b, got["b"])):
        for r, x in found.items():
            v = values[r - 1]
            assert (x.value, x.before, x.at) == (v, values.index(v), values.count(v))
    exact = df.select(F.median(F.when(~F.isnan("a"), F.col("a"))), F.median("b")).first()
    assert list(quantiles.medians(df, ["a", "b", "c"]).values()) == [exact[0], exact[1], None]
    assert quantiles.medians(df.limit(0), ["a"]) == {"a": None}


def test_a_rank_outside_its_bracket_is_still_found(spark):
    df = spark.createDataFrame([(float(i),) for i in range(100)], "x double")
    got = quantiles._selected(df, {"x": [10, 60]}, {"x": [(55.0, 70.0)]})["x"]
    assert (got[10].value, got[60].value) == (9.0, 59.0)
    for n in range(1, 9):
        few = df.where(F.col("x") < n)
        assert quantiles.medians(few, ["x"])["x"] == few.select(F.median("x")).first()[0]


@pytest.mark.parametrize("case", ["ties", "distinct", "few", "nulls", "empty"])
def test_deciles_equal_ntile(spark, case):
    score = {"ties": lambda i: RNG.choice([0.1, 0.2, 0.5, 0.5, 0.5]), "distinct": lambda i: RNG.random(), "few": lambda i: RNG.random(),
             "nulls": lambda i: RNG.choice([None, None, NAN, 0.3, RNG.random()]), "empty": lambda i: 0.0}[case]
    rows = [(i, score(i)) for i in range({"few": 7, "empty": 0}.get(case, 333))]
    df = spark.createDataFrame(rows, "k long, s double").repartition(4)
    want = {r.k: r.d for r in df.select("k", F.ntile(10).over(Window.orderBy("s", "k")).alias("d")).collect()}
    assert {r.k: r.decile for r in monitoring.deciles(df, "s", "k").collect()} == want


@pytest.mark.parametrize("block", [100_000, 37])
def test_ten_thousand_rules(spark, block):
    letters = "abcde"
    n = 10_000 if block > 37 else 150
    rules = [(i * 3 % 10_007, "".join(RNG.choice(letters) for _ in range(RNG.randrange(3, 7)))) for i in range(n)] + [(5, None), (None, "abc"), (20_000, "🙂é")]
    texts = ["".join(RNG.choice(letters + " z") for _ in range(RNG.randrange(0, 25))) for _ in range(300)] + [None, "", "x🙂éx", "same text"] + ["same text abcd"] * 100
    table = spark.createDataFrame(rules, "rule_order long, key string")
    df = spark.createDataFrame([(i, t, "kept") for i, t in enumerate(texts)], "i int, t string, rule_order string").repartition(3)
    got = rule_match.first_rule(df, "t", table, out="hit", block=block)
    assert got.columns == ["i", "t", "rule_order", "hit"]
    usable = [(o, k) for o, k in rules if k is not None and o is not None]
    for r in got.collect():
        hits = [o for o, k in usable if r.t is not None and k in r.t]
        assert r.hit == (min(hits) if hits else None)
    empty_key = spark.createDataFrame([(9, "")], "rule_order long, key string")
    assert {r.hit for r in rule_match.first_rule(df.where("t is not null"), "t", empty_key, out="hit").collect()} == {9}
    assert rule_match.first_rule(df, "t", table.limit(0), out="hit").where("hit is not null").count() == 0
