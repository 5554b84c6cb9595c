"""A state table that micro-batches are merged into (X-1, X-2, X-3).

Rows lie in buckets: ``<path>/bucket=<b>/batch=<n>``. A micro-batch reads the
newest earlier version of the buckets it touches, merges its own rows with
``merge`` and writes those buckets once more under its own number; other
buckets stay as they are. A version is removed when a newer one has been
followed by another batch, so a bucket has at most two, however many batches
came. A retried batch starts from the versions before it and replaces its own
output, so nothing counts twice.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

BUCKET, BATCH = "bucket", "batch"


@dataclass(frozen=True)
class MergedTable:
    path: str
    bucket: Column                                  # of a row, as text or a number
    merge: Callable[[DataFrame], DataFrame]         # rows of old and new versions -> one row a key

    def versions(self, spark: SparkSession) -> dict[str, list[int]]:
        """Batch numbers of every bucket, oldest first (one listing of folders)."""
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        glob = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{BUCKET}=*/{BATCH}=*")
        found: dict[str, list[int]] = {}
        for status in glob.getFileSystem(conf).globStatus(glob) or []:
            folder = status.getPath()
            found.setdefault(folder.getParent().getName().partition("=")[2], []).append(int(folder.getName().partition("=")[2]))
        return {b: sorted(ns) for b, ns in found.items()}

    def _read(self, spark: SparkSession, wanted: dict[str, int], schema) -> DataFrame:
        paths = [f"{self.path}/{BUCKET}={b}/{BATCH}={n}" for b, n in wanted.items()]
        return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)

    def upsert(self, rows: DataFrame, batch_id: int) -> None:
        """Merge one micro-batch."""
        spark = rows.sparkSession
        touched = {str(r[0]) for r in rows.select(self.bucket.cast("string")).distinct().collect()}     # at most one row a bucket
        versions = self.versions(spark)
        base = {b: max(n for n in versions[b] if n < batch_id) for b in touched if any(n < batch_id for n in versions.get(b, []))}
        merged = self.merge(self._read(spark, base, rows.schema).unionByName(rows))
        (merged.withColumn(BUCKET, self.bucket.cast("string")).withColumn(BATCH, F.lit(batch_id)).hint("rebalance", BUCKET)
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET, BATCH).parquet(self.path))
        self._remove(spark, {b: [n for n in versions[b] if n < base[b]] for b in base})

    def _remove(self, spark: SparkSession, old: dict[str, list[int]]) -> None:
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        for b, numbers in old.items():
            for n in numbers:
                path = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{BUCKET}={b}/{BATCH}={n}")
                path.getFileSystem(conf).delete(path, True)

    def read(self, spark: SparkSession, schema) -> DataFrame:
        """The merged rows: every bucket's newest version."""
        return self._read(spark, {b: ns[-1] for b, ns in self.versions(spark).items()}, schema)
