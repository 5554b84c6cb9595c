"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator, Sequence
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import scratch_path

ASCII_SPACE = b" \t\n\x0b\x0c\r"   # the word separators of every contract: x20 and x09-x0D


def utf8(text: str = "text") -> Column:
    """A text column as UTF-8 bytes, null as empty (bytes reach Python without decoding)."""
    return F.coalesce(F.col(text).cast("binary"), F.lit(b""))


def land(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared checkpoint folder and read it
    back: lineage is cut, and a lost executor cannot change what was written."""
    path = scratch_path(df.sparkSession, name)
    schema = df.schema
    df.write.parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package: with ``addPyFile``, once a
    context, unless PYTHONPATH already names its folder."""
    root = Path(__file__).resolve().parents[2]
    sc = spark.sparkContext
    if str(root) in os.environ.get("PYTHONPATH", "").split(os.pathsep) or getattr(sc, "_provisio_shipped", False):
        return
    archive = os.path.join(tempfile.mkdtemp(prefix="provisio-code-"), "provisio.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for path in sorted((root / "provisio").rglob("*.py")):
            z.write(path, str(path.relative_to(root)))
    sc.addPyFile(archive)
    sc._provisio_shipped = True


def map_batches(df: DataFrame, fn: Callable[[Iterator[dict[str, list]]], Iterator[dict[str, list]]],
                schema: str, max_bytes: int = 16 << 20) -> DataFrame:
    """``mapInArrow`` over dicts of Python lists.

    ``fn`` gets an iterator of column dicts and yields column dicts in
    ``schema``. Incoming Arrow batches are cut into slices of about
    ``max_bytes`` so that very long texts do not pile up in one worker.
    """
    ship_package(df.sparkSession)
    arrow_schema = _arrow_schema(schema)
    names = list(arrow_schema.names)

    def slices(batches):
        for batch in batches:
            n = batch.num_rows
            if n == 0:
                continue
            step = max(1, min(n, int(n * max_bytes / max(batch.nbytes, 1))))
            for lo in range(0, n, step):
                part = batch.slice(lo, step)
                yield {f: c.to_pylist() for f, c in zip(part.schema.names, part.columns)}

    def run(batches):
        for out in fn(slices(batches)):
            yield pa.RecordBatch.from_arrays(
                [out[n] if isinstance(out[n], pa.Array) else pa.array(out[n], type=arrow_schema.field(n).type)
                 for n in names], schema=arrow_schema)

    return df.mapInArrow(run, schema)


def _arrow_schema(ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(ddl))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that ``df`` does not have yet, so that
    helper columns never clash with a caller's extra columns."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def kept_fields(df: DataFrame, keep: Sequence[str], results: str) -> tuple[list[str], str]:
    """The ``keep`` columns without those that a result column replaces, and
    the schema text of both together."""
    taken = {name.lower() for name in _arrow_schema(results).names}
    names = [c for c in keep if c.lower() not in taken]
    return names, ", ".join([*(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in names), results])
