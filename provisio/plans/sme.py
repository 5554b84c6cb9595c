"""SME flow: company features → PD (fixed-coefficient or trained) →
attributions → factor table and memo; plus the stress grid over all
companies × all scenarios.

Every step after the feature aggregation is a narrow projection of the
company rows (array expressions), so the only shuffle is the one building
the features from orders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import explain, score, stress
from ..sources import fixtures


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.sme_features(spark, sf_dir)


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All companies scored (no test-split-only scoring, T-12): one-hot
    industry, fixed-coefficient PD, demo allow-list override (P-27)."""
    f = score.sme_model_frame(features(spark, sf_dir))
    f = f.withColumn("predicted_default_prob", score.pd_sme_fixed(
        "revenue_growth", "debt_to_asset_ratio", "cash_flow_volatility", "past_default"))
    lo, hi = explain.VIP_PD_RANGE
    return explain.override(f, "company_id", explain.vip_ids(spark), "predicted_default_prob",
                            explain.hashed_uniform("company_id", lo, hi))


def attributed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored companies with their log-odds attribution array (M-12)."""
    sc = scored(spark, sf_dir)
    means = explain.feature_means(sc, explain.SME_FEATURES)
    return explain.linear_attributions(sc, means)


def factor_tables(spark: SparkSession, sf_dir: str, attributions: DataFrame | None = None) -> DataFrame:
    """R-7 arrays from the linear attributions, or from ``attributions`` (for
    instance those of the trained trees)."""
    a = attributed(spark, sf_dir) if attributions is None else attributions
    return a.select("company_id", "predicted_default_prob", "revenue_growth", "cash_flow_volatility",
                    explain.factor_table("attributions").alias("factors"))


def stressed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stress.stress_table(scored(spark, sf_dir))


def memos(spark: SparkSession, sf_dir: str, *, shock_rev: float = 0.0, shock_vol: float = 1.0,
          as_of: str | None = None, attributions: DataFrame | None = None, factors: DataFrame | None = None) -> DataFrame:
    """R-9: one plain-text memo per company for one scenario (the sliders'
    defaults unless given); header name and source come from the market
    side (live company → its name and the exchange feed; else simulated).
    ``factors`` are ready factor tables, which then are not computed again."""
    from ..plans import market as mk

    ft = factor_tables(spark, sf_dir, attributions) if factors is None else factors
    info = mk.company_info(spark, sf_dir)
    day = F.lit(as_of) if as_of else F.date_format(F.current_date(), "yyyy-MM-dd")
    j = ft.join(info, "company_id", "left")
    pd = F.col("predicted_default_prob")
    new_pd = stress.stressed_pd(pd, F.lit(shock_rev), F.lit(shock_vol))
    from ..functions.text import fmt_pct1, fmt_signed_pct0

    header = F.concat_ws("\n",
                         F.concat(F.lit("CREDIT RISK ASSESSMENT: "), F.coalesce(F.col("name"), F.col("company_id"))),
                         F.concat(F.lit("DATE: "), day, F.lit(" | SOURCE: "),
                                  F.when(F.col("is_real"), "HKEX API").otherwise("Internal Sim")))
    addendum = F.concat_ws(
        "\n",
        F.concat(F.lit("STRESS TEST ADDENDUM: Under simulated macro-economic stress (Revenue "),
                 fmt_signed_pct0(F.lit(shock_rev)), F.lit(", Volatility "),
                 F.format_string("%.1f", F.lit(shock_vol)), F.lit("x), the Probability of Default (PD) shifts from "),
                 fmt_pct1(stress.base_pd(pd)), F.lit(" to "), fmt_pct1(new_pd), F.lit(".")),
        F.concat(F.lit("FINAL RECOMMENDATION: "), stress.recommendation(new_pd)))
    return j.select("company_id", explain.memo_text(pd, F.col("factors"), header, addendum).alias("memo"))
