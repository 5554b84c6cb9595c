"""The range-partitioned running total equals the window forms, also when
one key or value holds a third of all rows."""

from pyspark.sql import Window, functions as F

from conftest import SF_SMALL
from provisio.operators.ordered import exact_median, row_number_global, running_total


def test_running_total_matches_window_per_group(spark):
    df = spark.read.parquet(f"{SF_SMALL}/orders.parquet").select("o_orderkey", "o_custkey", "o_totalprice")
    # a third of all rows share one customer (hot key)
    df = df.withColumn("o_custkey", F.when(F.col("o_orderkey") % 3 == 0, F.lit(7)).otherwise(F.col("o_custkey")))
    got = running_total(df, ["o_orderkey"], value="o_totalprice", partition_by=["o_custkey"], out="rt")
    w = Window.partitionBy("o_custkey").orderBy("o_orderkey").rowsBetween(Window.unboundedPreceding, 0)
    ref = df.select("o_orderkey", F.sum("o_totalprice").over(w).alias("ref"))
    bad = got.join(ref, "o_orderkey").where(F.abs(F.col("rt") - F.col("ref")) > 1e-6 * F.abs(F.col("ref")))
    assert bad.count() == 0
    assert got.count() == df.count()


def test_row_number_global(spark):
    df = spark.read.parquet(f"{SF_SMALL}/orders.parquet").select("o_orderkey")
    got = row_number_global(df, ["o_orderkey"], out="rn")
    ref = df.select("o_orderkey", F.row_number().over(Window.orderBy("o_orderkey")).alias("ref"))
    assert got.join(ref, "o_orderkey").where("rn <> ref").count() == 0


def test_exact_median_with_hot_value(spark):
    df = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    for frame in (df.select(F.col("o_totalprice").alias("x")),
                  df.select(F.when(F.col("o_orderkey") % 3 == 0, F.lit(1.0)).otherwise(F.col("o_totalprice")).alias("x")),
                  df.where("o_orderkey < 1001").select(F.col("o_totalprice").alias("x"))):
        assert exact_median(frame, "x").first()[0] == frame.select(F.median("x")).first()[0]


def test_exact_median_empty(spark):
    df = spark.createDataFrame([], "x double")
    assert exact_median(df, "x").first()[0] is None


def test_checked_broadcast(spark):
    from provisio.operators.sizing import checked_broadcast

    big = spark.range(50_000).withColumnRenamed("id", "k")
    small = spark.range(10).withColumnRenamed("id", "k")

    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    assert "BroadcastHashJoin" in plan(big.join(checked_broadcast(small, max_rows=100), "k"))
    left = spark.range(50_000).withColumnRenamed("id", "k")
    joined = left.join(checked_broadcast(big, max_rows=100), "k")
    assert joined.count() == 50_000
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" not in plan(left.join(checked_broadcast(big, max_rows=100), "k"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_first_n_with_null_and_tied_keys(spark):
    from provisio.sources import tables

    df = spark.read.parquet(f"{SF_SMALL}/orders.parquet").select(
        "o_orderkey", F.when(F.col("o_orderkey") % 5 > 0, F.col("o_custkey") % 7).alias("k"))
    for n in (1, 7, 700, 12_345):
        want = sorted(df.orderBy(F.col("k").asc_nulls_first(), "o_orderkey").limit(n).collect(), key=repr)
        assert sorted(tables.head_n(df, ["k", "o_orderkey"], n).collect(), key=repr) == want
        only = tables.head_n(df, "k", n)            # the key alone has ties and NULLs
        assert only.count() == n and sorted(map(repr, (r.k for r in only.collect()))) == sorted(repr(r.k) for r in want)
    twice = df.unionByName(df)
    assert tables.head_n(twice, "o_orderkey", 9).count() == 9        # whole rows repeat
    assert tables.head_n(df, "o_orderkey", 10**9).count() == df.count()
    assert tables.head_n(df, "o_orderkey", 0).count() == 0
    want = sorted(r.o_orderkey for r in df.orderBy(tables.sample_key(7, "o_orderkey"), "o_orderkey").limit(700).collect())
    assert sorted(r.o_orderkey for r in tables.sample_n(df, "o_orderkey", 700, seed=7).collect()) == want


def test_exact_median_cuts_large_buckets_again(spark, monkeypatch):
    from provisio.operators import ordered

    monkeypatch.setattr(ordered, "MEDIAN_ROWS", 50)
    monkeypatch.setattr(ordered, "MEDIAN_BUCKETS", 16)
    df = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    for frame in (df.select(F.col("o_totalprice").alias("x")), df.where("o_orderkey < 1000").select(F.col("o_totalprice").alias("x")),
                  df.select(F.when(F.col("o_orderkey") % 3 == 0, F.lit(1.0)).otherwise(F.exp(F.col("o_totalprice") / 1e4)).alias("x"))):
        assert exact_median(frame, "x").first()[0] == frame.select(F.median("x")).first()[0]


def test_range_join_with_thousands_of_bins(spark):
    from provisio.operators.features import bin_by_range_join

    bins = spark.range(3000).select(F.concat(F.lit("b"), F.col("id").cast("string")).alias("label"),
                                    F.when(F.col("id") > 0, F.col("id") * 2.0).alias("lo"),
                                    F.when(F.col("id") < 2999, F.col("id") * 2.0 + 2).alias("hi"))
    df = spark.range(-5, 6100).select((F.col("id") + 0.5).alias("v")).unionByName(spark.createDataFrame([(None,), (4.0,), (1e9,)], "v double"))
    got = {r.v: r.bin for r in bin_by_range_join(df, "v", bins, out="bin", null_label="none").collect()}
    assert len(got) == df.count()
    for v, label in got.items():
        assert label == ("none" if v is None else f"b{min(2999, max(0, int(v // 2)))}")


def test_scale_conf():
    from provisio.session import scale_conf

    c = scale_conf(100 * 1024 ** 4)          # 100 TiB
    assert int(c["spark.sql.shuffle.partitions"]) == 409600
    assert scale_conf(10)["spark.sql.shuffle.partitions"] == "200"


def test_running_total_with_null_hot_group(spark):
    df = spark.read.parquet(f"{SF_SMALL}/orders.parquet").select("o_orderkey", "o_custkey", "o_totalprice")
    df = df.withColumn("g", F.when(F.col("o_orderkey") % 3 == 0, F.lit(None).cast("long")).otherwise(F.col("o_custkey")))
    got = running_total(df, ["o_orderkey"], value="o_totalprice", partition_by=["g"], out="rt")
    w = Window.partitionBy("g").orderBy("o_orderkey").rowsBetween(Window.unboundedPreceding, 0)
    ref = df.select("o_orderkey", F.sum("o_totalprice").over(w).alias("ref"))
    bad = got.join(ref, "o_orderkey").where(F.abs(F.col("rt") - F.col("ref")) > 1e-6 * F.abs(F.col("ref")))
    assert bad.count() == 0 and got.count() == df.count()
