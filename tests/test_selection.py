"""Selection by counting against sorting, and the sorted merge of bins."""

import random
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from provisio.operators import features as feat, ordered, selection
from provisio.sources import tables

from conftest import SF_SMOKE

RNG = random.Random(5)
INF = float("inf")
COLUMNS = {
    "long": [RNG.choice([None, 2**63 - 1, -2**63, 2**62, 2**62 + 1, 0, *range(40)]) for _ in range(400)],
    "int": [RNG.choice([None, -5, 0, *range(1000)]) for _ in range(400)],
    "double": [RNG.choice([None, float("nan"), INF, -INF, 0.0, 5e-324, 1e-323, 1.7e308, -1.7e308, RNG.random(), 1 + 2**-52, 1.0]) for _ in range(400)],
    "string": [RNG.choice([None, "", "a", "a\0", "ab", "é", "same prefix here", "same prefix here and on", "same prefix here and off", str(RNG.randrange(50))]) for _ in range(400)],
    "boolean": [RNG.choice([None, True, False]) for _ in range(400)],
    "date": [RNG.choice([None, date(1999, 1, 1 + RNG.randrange(28)), date(2400, 1, 1)]) for _ in range(400)],
    "timestamp_ntz": [RNG.choice([None, datetime(2020, 1, 1, 0, 0, 0, RNG.randrange(5)), datetime(1960, 5, 5)]) for _ in range(400)],
    "decimal(38,2)": [RNG.choice([None, Decimal("12345678901234567890.12"), Decimal("12345678901234567890.13"), Decimal(RNG.randrange(9))]) for _ in range(400)],
}


@pytest.mark.parametrize("kind", COLUMNS)
def test_every_type_by_counting(spark, monkeypatch, kind):
    monkeypatch.setattr(selection, "RANK_ROWS", 7)
    monkeypatch.setattr(selection, "BUCKETS", 12)
    df = spark.createDataFrame([(v, i % 3) for i, v in enumerate(COLUMNS[kind])], f"v {kind}, w int").repartition(3)
    ordered_rows = [tuple(r) for r in df.orderBy(F.col("v").asc_nulls_first(), "w").collect()]
    stored = spark.read.parquet(tables.land(df))
    for n in (60, 399):
        cut = selection.nth(stored, ["v", "w"], n)
        want = ordered_rows[n - 1]
        assert repr(cut.values) == repr(want)
        assert cut.before == [repr(r) for r in ordered_rows].index(repr(want)) and cut.at == sum(repr(r) == repr(want) for r in ordered_rows)
    assert selection.nth(stored, ["v", "w"], 401) is None


def test_first_rows_with_ties_by_counting(spark, monkeypatch):
    monkeypatch.setattr(selection, "RANK_ROWS", 5)
    df = spark.createDataFrame([(i % 7 or None, f"row {i % 90}") for i in range(400)], "k int, t string").repartition(4)
    for n in (1, 57, 58, 100, 399):
        got = tables.head_n(df, "k", n).collect()
        assert len(got) == n
        keys = sorted(r.k or 0 for r in got)
        assert keys == sorted((i % 7) for i in range(400))[:n]
    again = [sorted(map(tuple, tables.head_n(df.repartition(p), "k", 100).collect()), key=repr) for p in (1, 6)]
    assert again[0] == again[1]


def test_selection_never_ranges_all_rows(spark, monkeypatch):
    """The recorded jobs of a head and of a sample hold no range shuffle; the one
    sort is of the last range's rows."""
    from pyspark.sql import DataFrameWriter
    from pyspark.sql.classic.dataframe import DataFrame

    plans = []

    def record(owner, name, frame):
        original = getattr(owner, name)

        def run(self, *args, **kwargs):
            plans.append(frame(self)._jdf.queryExecution().executedPlan().toString())
            return original(self, *args, **kwargs)

        monkeypatch.setattr(owner, name, run)

    for name in ("collect", "count", "first", "checkpoint"):
        record(DataFrame, name, lambda df: df)
    record(DataFrameWriter, "parquet", lambda w: w._df)
    monkeypatch.setattr(selection, "RANK_ROWS", 100)
    orders = tables.read_table(spark, SF_SMOKE, "orders")
    tables.head_n(orders, ["o_totalprice", "o_orderkey"], 700).collect()
    tables.sample_n(orders, "o_orderkey", 300).collect()
    assert len(plans) > 6 and not any("rangepartitioning" in p for p in plans)


def test_a_million_bins_with_hot_values(spark):
    bins = spark.range(1_000_000).select(F.concat(F.lit("b"), F.col("id")).alias("label"), (F.col("id") * 2.0).alias("lo"), (F.col("id") * 2.0 + 1.5).alias("hi"))
    df = spark.range(60_000).select("id", F.when(F.col("id") % 3 == 0, 777_777.0).when(F.col("id") % 50 == 1, None).otherwise(
        (F.col("id") * 7919) % 2_100_000 / 1.0).alias("v"), F.lit("kept").alias("label"))
    got = feat.bin_by_range_join(df, "v", bins, out="bin", null_label="none")
    assert got.columns == ["id", "v", "label", "bin"]
    want = F.when(F.col("v").isNull(), "none").when((F.col("v") < 2_000_000) & (F.col("v") % 2 < 1.5), F.concat(F.lit("b"), F.floor(F.col("v") / 2)))
    assert got.count() == 60_000 and got.where(~F.col("bin").eqNullSafe(want)).count() == 0


@pytest.mark.parametrize("inclusive_lo", [True, False])
def test_sorted_merge_equals_the_broadcast_form(spark, inclusive_lo):
    rows = [("low", None, 0.0), ("a", 0.0, 1.0), ("b", 1.0, 2.5), ("gap after", 4.0, 5.0), ("top", 9.0, None)]
    bins = spark.createDataFrame(rows, "label string, lo double, hi double")
    values = [None, float("nan"), INF, -INF, -3.0, 0.0, 0.5, 1.0, 2.5, 3.0, 4.0, 5.0, 8.9, 9.0, 1e9] * 20
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x double").repartition(5)
    a = feat.bin_by_range_join(df, "x", bins, out="bin", null_label="none", inclusive_lo=inclusive_lo)
    for parts in (1, 3, 16):
        b = feat.bin_by_sorted_merge(df, "x", bins, out="bin", null_label="none", inclusive_lo=inclusive_lo, num_partitions=parts)
        assert sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))
    none = feat.bin_by_sorted_merge(df, "x", bins.limit(0), out="bin", null_label="none", inclusive_lo=inclusive_lo)
    assert {(r.x is None, r.bin) for r in none.collect()} == {(True, "none"), (False, None)}


@pytest.mark.parametrize("parts", [1, 4, 40])
def test_carry_forward_over_partition_edges(spark, parts):
    rng = random.Random(parts)
    rows = [(i, rng.choice([None, "x", "y", f"m{i}"]), rng.random() < 0.05) for i in range(500)]
    df = spark.createDataFrame(rows, "i int, t string, open boolean").repartition(7)
    got = {r.i: r.last_t for r in ordered.carry_forward(df, ["i"], ["t"], F.col("open"), prefix="last_", num_partitions=parts).collect()}
    last = None
    for i, t, is_open in rows:
        last = t if is_open else last
        assert got[i] == last
