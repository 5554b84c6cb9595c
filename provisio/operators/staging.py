"""IFRS 9 staging and expected credit loss (M-14 … M-16, J-1)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.scalars import col_

# Fixed values of the staging rules.
STAGE2_PD_THRESHOLD = 0.02
LGD = 0.45
STAGE1_FACTOR = 0.5
STAGE_DESCRIPTIONS = {1: "Stage 1: Performing",
                      2: "Stage 2: Significant Increase in Credit Risk",
                      3: "Stage 3: Defaulted"}


def ifrs9_stage(default_flag: str | Column, pd: str | Column, threshold: float = STAGE2_PD_THRESHOLD) -> Column:
    """M-14: defaulted → 3; PD ≥ threshold → 2; else 1 (a NULL PD is stage 1)."""
    return F.when(col_(default_flag) == 1, 3).when(col_(pd) >= threshold, 2).otherwise(1)


def ecl(default_flag: str | Column, amount: str | Column, pd_12m: str | Column,
        pd_stage2: str | Column | None = None, *, threshold: float = STAGE2_PD_THRESHOLD,
        lgd: float = LGD, stage1_factor: float = STAGE1_FACTOR) -> Column:
    """M-15 / M-16: stage 3 amount·LGD; stage 2 amount·PD₂·LGD; stage 1
    amount·PD·LGD·factor. Profile B passes the lifetime PD as ``pd_stage2``.
    Products keep the left-to-right order of the reference formula."""
    flag, amt, p = col_(default_flag), col_(amount), col_(pd_12m)
    p2 = p if pd_stage2 is None else col_(pd_stage2)
    return (F.when(flag == 1, amt * F.lit(lgd))
            .when(p >= threshold, amt * p2 * F.lit(lgd))
            .otherwise(amt * p * F.lit(lgd) * F.lit(stage1_factor)))


def stage_description(stage: str | Column) -> Column:
    """P-25: stage text; NULL for an unknown stage (no ELSE)."""
    s = col_(stage)
    expr = None
    for k, text in STAGE_DESCRIPTIONS.items():
        expr = F.when(s == k, text) if expr is None else expr.when(s == k, text)
    return expr


def staging_a(scored: DataFrame, *, pd_col: str = "pd") -> DataFrame:
    """``loan_staging`` of profile A from a scored feature frame (no join:
    the PD was computed on the same rows)."""
    return scored.select(
        "loan_id", "loan_amount", "default_flag", F.col(pd_col).alias("pd"),
        ifrs9_stage("default_flag", pd_col).alias("stage"),
        ecl("default_flag", "loan_amount", pd_col).alias("ecl"),
    )


def join_predictions(features: DataFrame, predictions: DataFrame, key: str = "loan_id") -> DataFrame:
    """J-1: features ⋈ predictions on the key (1:1). Sort-merge at scale;
    AQE switches to broadcast when one side is small at run time."""
    return features.join(predictions, on=key, how="inner")


def staging_a_from_tables(features: DataFrame, predictions: DataFrame) -> DataFrame:
    """Profile A staging when predictions are a separate table (J-1 + M-14/15)."""
    return staging_a(join_predictions(features.select("loan_id", "loan_amount", "default_flag"),
                                      predictions.select("loan_id", "pd")))


def staging_b(features: DataFrame, predictions: DataFrame) -> DataFrame:
    """``loan_staging`` of profile B (J-1, M-14, M-16)."""
    j = join_predictions(features.select("loan_id", "loan_amount", "default_flag", "grade", "fico_score"),
                         predictions.select("loan_id", "pd_12m", "pd_lifetime"))
    return j.select(
        "loan_id", "loan_amount", "default_flag", "grade", "fico_score", "pd_12m", "pd_lifetime",
        ifrs9_stage("default_flag", "pd_12m").alias("stage"),
        ecl("default_flag", "loan_amount", "pd_12m", "pd_lifetime").alias("ecl"),
    )
