"""Size-checked broadcast: broadcast a side only when its size is proven small."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import scratch_path

# A side with at most this many rows and written bytes is shipped to every task;
# anything larger is left to the planner (sort-merge join, or a broadcast AQE
# picks at run time). Only the plan depends on it, never the result.
DEFAULT_MAX_BROADCAST_ROWS = 100_000
DEFAULT_MAX_BROADCAST_BYTES = 16 << 20


def written_bytes(spark: SparkSession, path: str) -> int:
    """Size of a written table in whatever store ``path`` names."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(p).getLength()


def checked_broadcast(df: DataFrame, max_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
                      max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and mark it for
    broadcast only when both its written bytes and its row count (read from
    the file footers) pass the limits. The join that follows reads the
    written copy instead of re-running its plan.
    """
    spark = df.sparkSession
    schema = df.schema
    path = scratch_path(spark, "side")
    df.write.parquet(path)
    written = spark.read.schema(schema).parquet(path)
    small = written_bytes(spark, path) <= max_bytes and written.count() <= max_rows
    return F.broadcast(written) if small else written
