"""Table access (S-1 … S-11): Parquet/CSV readers, ordered heads, exact
seeded samples, landing writers and catalog checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..session import scratch_path

TEST_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
               "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """S-4: Parquet scan of one test table; projections and filters applied
    later are pushed into this scan by Catalyst."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_loans_csv(spark: SparkSession, path: str, schema: T.StructType | str, *,
                   quoted_line_breaks: bool = False) -> DataFrame:
    """S-1: full CSV scan with a declared schema (no inference pass). Text
    keeps its surrounding blanks (``' 36 months'``), as the source has them.
    Files are split over many tasks; ``quoted_line_breaks`` is for files whose
    quoted text spans lines, which Spark must read one file to a task."""
    return (spark.read.schema(schema)
            .option("header", True).option("multiLine", quoted_line_breaks).option("escape", '"')
            .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
            .option("mode", "PERMISSIVE").csv(path))


def write_csv(df: DataFrame, path: str) -> str:
    """Write a CSV extract keeping blanks inside text values."""
    (df.write.mode("overwrite").option("header", True).option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
    return path


def _first_n(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """The first ``n`` rows in the order of the ``order`` columns (ascending,
    NULLs first), ties broken by a hash of the whole row.

    The order columns are written once (nothing is shuffled) and the n-th
    tuple is found by counting (:mod:`provisio.operators.selection`). Rows
    before it are kept by a narrow NULL-safe filter. Only if rows tie with it,
    those rows' hashes are selected from in the same way; rows that agree in
    the hash too agree in every column, so any of them fill up to exactly ``n``.
    """
    from ..operators.selection import before_and_at, nth

    if n <= 0:
        return df.limit(0)
    spark = df.sparkSession
    keys = spark.read.parquet(land(df.select(*order), name="order-keys"))
    cut = nth(keys, order, n)
    if cut is None:                      # fewer than n rows: keep all
        return df
    before, same = before_and_at(df, order, cut.values)
    if cut.before + cut.at <= n:
        return df.where(before | same)
    tied = df.where(same).withColumn("_first_tie", F.xxhash64(*df.columns))
    ties = spark.read.parquet(land(tied.select("_first_tie"), name="order-ties"))
    last = nth(ties, ["_first_tie"], n - cut.before)
    sooner, equal = before_and_at(tied, ["_first_tie"], last.values)
    fill = tied.where(equal).limit(n - cut.before - last.before)
    return df.where(before).unionByName(tied.where(sooner).drop("_first_tie")).unionByName(fill.drop("_first_tie"))


def head_n(df: DataFrame, order_key: str | Sequence[str], n: int) -> DataFrame:
    """S-2: the first ``n`` rows in key order ("first chunk" of a file).
    A bare ``limit`` has no defined order on a distributed scan; the key, then
    a hash of the row, make it reproducible. One path for every ``n``: the cut
    is found by counting, and a narrow filter keeps what lies before it."""
    return _first_n(df, [order_key] if isinstance(order_key, str) else list(order_key), n)


def sample_key(seed: int, key: str) -> F.Column:
    """Seeded pseudo-random order of rows, identical in any engine with md5."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")))


def sample_n(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """S-3: exactly ``n`` rows without replacement, reproducible for a seed.
    ``df.sample`` only approximates the size; taking the first ``n`` in the
    order of a keyed hash is exact."""
    return _first_n(df.withColumn("_sample_h", sample_key(seed, key)), ["_sample_h", key], n).drop("_sample_h")


def land(df: DataFrame, path: str | None = None, name: str = "landing") -> str:
    """S-6/S-7/S-8: overwrite-load a layer as Parquet; returns the path.
    Without a path the table goes to the shared checkpoint folder."""
    target = path or scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(target)
    return target


def materialise_view(df: DataFrame, name: str) -> DataFrame:
    """S-9: a lazy layer, re-planned on every read, like a SQL view."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def layer_objects(spark: SparkSession, names: Sequence[str]) -> DataFrame:
    """S-11: which layer objects the catalog has, with their row counts; one
    row per name. Reads the catalog and the layers, never changes either."""
    out = None
    for name in names:
        if spark.catalog.tableExists(name):
            row = spark.table(name).agg(F.count(F.lit(1)).alias("row_count")).select(
                F.lit(name).alias("name"), F.lit(True).alias("present"), "row_count")
        else:
            row = spark.range(1).select(F.lit(name).alias("name"), F.lit(False).alias("present"),
                                        F.lit(None).cast("long").alias("row_count"))
        out = row if out is None else out.unionByName(row)
    return out
