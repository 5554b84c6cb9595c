"""Session helpers: a configured SparkSession and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on: UTC wall clock (timestamps are compared with the
# oracle engine), adaptive execution with skew-join splitting, no web UI.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "provisio", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the library's defaults."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting it up when needed.

    On a cluster the folder must come from ``spark.checkpoint.dir`` (a shared
    file system every executor can read). Only a local-mode session without
    that setting (tests, benchmarks) gets a fresh folder of its own.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
    elif sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="provisio-ckpt-", dir=os.environ.get("TMPDIR", "/tmp")))
    else:
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    return sc.getCheckpointDir()


_SCRATCH: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for written tables."""
    import uuid

    base = checkpoint_dir(spark).rstrip("/")
    path = f"{base}/tables/{name}-{uuid.uuid4().hex[:12]}"
    _SCRATCH.append(path)
    return path


def scratch_paths() -> frozenset[str]:
    """The tables this process wrote under :func:`scratch_path` and still keeps."""
    return frozenset(_SCRATCH)


def clear_scratch(spark: SparkSession) -> int:
    """Remove the tables this process wrote under :func:`scratch_path`; call it
    when no frame that reads them is needed any more. Returns how many there were."""
    jvm, conf, n = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration(), 0
    while _SCRATCH:
        path = jvm.org.apache.hadoop.fs.Path(_SCRATCH.pop())
        n += bool(path.getFileSystem(conf).delete(path, True))
    return n


def scale_conf(input_bytes: int, *, partition_bytes: int = 256 << 20, min_partitions: int = 200) -> dict[str, str]:
    """Settings sized for reading ``input_bytes`` of Parquet: scan splits and
    shuffle partitions of about ``partition_bytes`` each (they must fit an
    executor's share of memory without spilling), AQE's target size and
    skew threshold derived from the same number. Pass the result as
    ``build_session(extra=...)`` or put it in the cluster's defaults."""
    parts = max(min_partitions, -(-input_bytes // partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    }
