"""Portfolio reports (R-1 … R-5) and the aggregates behind them (A-1 … A-9, K-*).

Every grouped report is one hash aggregation with a partial (map-side)
phase: a stage holding most loans is pre-aggregated in every task before
the shuffle, which then moves one row per task and stage. Shares of the
total are taken on the aggregated rows (one per stage), not on the loans.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from .staging import stage_description


def _stage_aggs(pd_col: str):
    return [F.count(F.lit(1)).alias("loan_count"),
            F.sum("loan_amount").alias("_exposure"),
            F.sum("ecl").alias("_ecl"),
            F.avg(pd_col).alias("_avg_pd")]


def stage_distribution(staging: DataFrame, *, pd_col: str = "pd", with_description: bool = False) -> DataFrame:
    """R-1: count, share of all loans (%), total ECL and average PD per stage.
    The grand total (J-4) is a sum over the aggregated stage rows."""
    agg = staging.groupBy("stage").agg(*_stage_aggs(pd_col))
    everything = Window.partitionBy()  # over the handful of stage rows only
    cols = [F.col("stage")]
    if with_description:
        cols.append(stage_description("stage").alias("stage_description"))
    cols += [F.col("loan_count"),
             F.round(F.col("loan_count") * F.lit(100.0) / F.sum("loan_count").over(everything), 2).alias("pct"),
             F.round("_ecl", 2).alias("total_ecl"),
             F.round("_avg_pd", 4).alias("avg_pd")]
    return agg.select(*cols).orderBy(F.col("stage").asc_nulls_first())


def portfolio_by_stage(staging: DataFrame, *, pd_col: str = "pd") -> DataFrame:
    """R-2: exposure, ECL, ECL rate and average PD per stage, with the stage text."""
    agg = staging.groupBy("stage").agg(*_stage_aggs(pd_col))
    return agg.select(
        "stage", stage_description("stage").alias("stage_description"), "loan_count",
        F.round("_exposure", 2).alias("total_exposure"),
        F.round("_ecl", 2).alias("total_ecl"),
        F.round(F.try_divide(F.col("_ecl"), F.col("_exposure")) * 100, 2).alias("ecl_rate_pct"),
        F.round("_avg_pd", 4).alias("avg_pd"),
    ).orderBy(F.col("stage").asc_nulls_first())


def portfolio_overall(staging: DataFrame, *, pd_col: str = "pd", count_defaulted: bool = True) -> DataFrame:
    """R-3: one-row portfolio totals (profile A also counts stage-3 loans)."""
    aggs = [F.count(F.lit(1)).alias("total_loans"),
            F.round(F.sum("loan_amount"), 2).alias("total_exposure"),
            F.round(F.sum("ecl"), 2).alias("total_ecl"),
            F.round(F.try_divide(F.sum("ecl"), F.sum("loan_amount")) * 100, 2).alias("portfolio_ecl_rate_pct"),
            F.round(F.avg(pd_col), 4).alias("portfolio_avg_pd")]
    if count_defaulted:
        aggs.append(F.sum(F.when(F.col("stage") == 3, 1).otherwise(0)).cast("long").alias("defaulted_loans"))
    return staging.agg(*aggs)


def portfolio_rollup(staging: DataFrame, *, pd_col: str = "pd") -> DataFrame:
    """A-9: per-stage rows and the portfolio row from one scan (ROLLUP)."""
    agg = staging.rollup("stage").agg(*_stage_aggs(pd_col), F.grouping_id().alias("_gid"))
    return agg.select(
        F.when(F.col("_gid") == 1, "portfolio").otherwise("stage").alias("level"),
        "stage", "loan_count",
        F.round("_exposure", 2).alias("total_exposure"),
        F.round("_ecl", 2).alias("total_ecl"),
        F.round(F.try_divide(F.col("_ecl"), F.col("_exposure")) * 100, 2).alias("ecl_rate_pct"),
        F.round("_avg_pd", 4).alias("avg_pd"),
    )


def staging_sample(staging: DataFrame, n: int = 10, *, pd_col: str = "pd") -> DataFrame:
    """R-4 (F-5, K-2): first ``n`` loans by stage, then PD descending; the
    loan id breaks ties. Plans as a distributed top-k (TakeOrderedAndProject)."""
    return (staging.where(F.col("stage").isin(1, 2, 3))
            .orderBy(F.col("stage").asc_nulls_first(), F.col(pd_col).desc_nulls_last(), F.col("loan_id").asc())
            .limit(n)
            .select("loan_id", "loan_amount", pd_col, "stage", F.round("ecl", 2).alias("ecl")))


def top_ecl(staging: DataFrame, n: int = 10, *, pd_col: str = "pd") -> DataFrame:
    """R-5 (K-3): the ``n`` largest expected losses (loan id breaks ties)."""
    return (staging.orderBy(F.col("ecl").desc_nulls_last(), F.col("loan_id").asc()).limit(n)
            .select("loan_id", "loan_amount", pd_col, "stage", F.round("ecl", 2).alias("ecl")))


def feature_preview_a(features: DataFrame, n: int = 5) -> DataFrame:
    """K-4: deterministic preview of engineered features (first ids)."""
    return (features.orderBy(F.col("loan_id").asc()).limit(n)
            .select("loan_id", "dti_ratio", "fico_category", "loan_to_income_ratio", "default_flag"))


def layer_counts(layers: dict[str, DataFrame]) -> DataFrame:
    """S-12 (A-1): one ``(layer, row_count)`` row per layer; each count is a
    distributed aggregate, the union holds one row per layer."""
    frames = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("layer"), "row_count")
              for name, df in layers.items()]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def pd_summary(scored: DataFrame, pd_col: str = "pd") -> DataFrame:
    """A-6: min / max / mean PD."""
    return scored.agg(F.min(pd_col).alias("min_pd"), F.max(pd_col).alias("max_pd"),
                      F.avg(pd_col).alias("avg_pd"))


def load_profile(raw: DataFrame) -> DataFrame:
    """S-13 (A-7): rows, default rate and average FICO / income / amount."""
    return raw.agg(F.count(F.lit(1)).alias("row_count"),
                   F.avg("default_flag").alias("default_rate"),
                   F.avg("fico_score").alias("avg_fico"),
                   F.avg("income").alias("avg_income"),
                   F.avg("loan_amount").alias("avg_loan_amount"))


# ---------------------------------------------------------------- one-scan form
def stage_summary(staging: DataFrame, *, pd_col: str = "pd") -> DataFrame:
    """Additive per-stage totals (one scan of the staging rows, one row per
    stage). Every stage report below is derived from these few rows, so a
    flow that prints several reports reads the loans once."""
    return staging.groupBy("stage").agg(
        F.count(F.lit(1)).alias("loan_count"), F.sum("loan_amount").alias("_exposure"),
        F.sum("ecl").alias("_ecl"), F.sum(pd_col).alias("_pd_sum"), F.count(pd_col).alias("_pd_n"))


def _avg_pd(sum_col: str = "_pd_sum", n_col: str = "_pd_n"):
    return F.try_divide(F.col(sum_col), F.col(n_col))


def stage_distribution_from(summary: DataFrame, *, with_description: bool = False) -> DataFrame:
    """R-1 from a stage summary."""
    everything = Window.partitionBy()
    cols = [F.col("stage")]
    if with_description:
        cols.append(stage_description("stage").alias("stage_description"))
    cols += [F.col("loan_count"),
             F.round(F.col("loan_count") * F.lit(100.0) / F.sum("loan_count").over(everything), 2).alias("pct"),
             F.round("_ecl", 2).alias("total_ecl"), F.round(_avg_pd(), 4).alias("avg_pd")]
    return summary.select(*cols).orderBy(F.col("stage").asc_nulls_first())


def portfolio_by_stage_from(summary: DataFrame) -> DataFrame:
    """R-2 from a stage summary."""
    return summary.select(
        "stage", stage_description("stage").alias("stage_description"), "loan_count",
        F.round("_exposure", 2).alias("total_exposure"), F.round("_ecl", 2).alias("total_ecl"),
        F.round(F.try_divide(F.col("_ecl"), F.col("_exposure")) * 100, 2).alias("ecl_rate_pct"),
        F.round(_avg_pd(), 4).alias("avg_pd"),
    ).orderBy(F.col("stage").asc_nulls_first())


def portfolio_overall_from(summary: DataFrame, *, count_defaulted: bool = True) -> DataFrame:
    """R-3 from a stage summary (sums of the per-stage sums)."""
    t = summary.agg(F.sum("loan_count").alias("total_loans"), F.sum("_exposure").alias("_e"),
                    F.sum("_ecl").alias("_l"), F.sum("_pd_sum").alias("_ps"), F.sum("_pd_n").alias("_pn"),
                    F.sum(F.when(F.col("stage") == 3, F.col("loan_count")).otherwise(0)).alias("defaulted_loans"))
    cols = [F.col("total_loans"), F.round("_e", 2).alias("total_exposure"), F.round("_l", 2).alias("total_ecl"),
            F.round(F.try_divide(F.col("_l"), F.col("_e")) * 100, 2).alias("portfolio_ecl_rate_pct"),
            F.round(_avg_pd("_ps", "_pn"), 4).alias("portfolio_avg_pd")]
    if count_defaulted:
        cols.append(F.col("defaulted_loans").cast("long").alias("defaulted_loans"))
    return t.select(*cols)
