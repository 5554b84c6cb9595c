"""Profile B, end to end: landing zone → clean layer → feature view → PD →
IFRS 9 stage + ECL (lifetime PD in stage 2) → reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import clean, features as feat, reports, score, staging
from ..sources import fixtures


def landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.raw_landing_zone(spark, sf_dir)


def cleaned(spark: SparkSession, sf_dir: str, income_mode: str = "strict") -> DataFrame:
    return clean.clean_loans_b(landing(spark, sf_dir), income_mode=income_mode)


def features(spark: SparkSession, sf_dir: str, income_mode: str = "strict") -> DataFrame:
    return feat.features_b(cleaned(spark, sf_dir, income_mode))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deterministic 12-month PD (fixed-coefficient formula) on the feature rows."""
    return features(spark, sf_dir).withColumn(
        "pd_12m", score.pd_loans_fixed("dti_ratio", "fico_score", "loan_amount"))


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score.predictions_b(scored(spark, sf_dir))


def staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staging scored in place: same rows and values as the features ⋈
    predictions join of the reference, without the join."""
    sc = scored(spark, sf_dir).withColumn("pd_lifetime", score.lifetime_pd("pd_12m"))
    return sc.select(
        "loan_id", "loan_amount", "default_flag", "grade", "fico_score", "pd_12m", "pd_lifetime",
        staging.ifrs9_stage("default_flag", "pd_12m").alias("stage"),
        staging.ecl("default_flag", "loan_amount", "pd_12m", "pd_lifetime").alias("ecl"),
    )


def staged_by_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reference's shape: predictions written as their own table, then joined (J-1)."""
    return staging.staging_b(features(spark, sf_dir), predictions(spark, sf_dir))


def run(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All reports of profile B from one per-stage summary (one scan)."""
    from ..session import checkpoint_dir

    checkpoint_dir(spark)
    summary = reports.stage_summary(staged(spark, sf_dir), pd_col="pd_12m").checkpoint(eager=True)
    return {
        "stage_distribution": reports.stage_distribution_from(summary, with_description=True),
        "portfolio_by_stage": reports.portfolio_by_stage_from(summary),
        "portfolio_overall": reports.portfolio_overall_from(summary, count_defaulted=False),
    }


