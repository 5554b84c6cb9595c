"""Data checks (S-12, S-14, S-15): row counts, declared schemas, key uniqueness."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def key_violations(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """S-15: keys that occur more than once, with their multiplicity (a
    distributed aggregate; a hot key is pre-counted in every task)."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def key_violation_summary(df: DataFrame, key: Sequence[str], name: str) -> DataFrame:
    """One row: how many keys are duplicated and the largest multiplicity."""
    v = key_violations(df, key)
    return v.agg(F.count(F.lit(1)).alias("duplicate_keys"),
                 F.coalesce(F.max("n"), F.lit(0).cast("long")).alias("max_multiplicity")) \
        .select(F.lit(name).alias("key_name"), "duplicate_keys", "max_multiplicity")
