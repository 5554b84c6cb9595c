"""Profile A, end to end: raw loans → features → PD → IFRS 9 stage + ECL → reports.

One lazy plan from the Parquet scan to each report; the staging frame is the
only thing several reports share, and it is a narrow projection of the scan
(no join: the PD is computed on the feature rows themselves).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import features as feat, reports, score, staging
from ..sources import fixtures


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.raw_loans(spark, sf_dir)


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feat.features_a(raw(spark, sf_dir))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score.score_loans_fixed(features(spark, sf_dir))


def staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.staging_a(scored(spark, sf_dir))


def run(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All reports of profile A. The three stage reports come from one
    per-stage summary (one scan, a few rows, checkpointed in the shared
    folder); the two loan lists are distributed top-k scans."""
    from ..session import checkpoint_dir

    st = staged(spark, sf_dir)
    checkpoint_dir(spark)
    summary = reports.stage_summary(st).checkpoint(eager=True)
    return {
        "stage_distribution": reports.stage_distribution_from(summary),
        "portfolio_by_stage": reports.portfolio_by_stage_from(summary),
        "portfolio_overall": reports.portfolio_overall_from(summary),
        "staging_sample": reports.staging_sample(st),
        "top_ecl": reports.top_ecl(st),
    }
