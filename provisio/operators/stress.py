"""Stress testing (J-8, M-17, M-18, R-10 … R-13).

The dashboard's two sliders become a grid: every company is scored under
every (revenue shock, volatility multiplier) pair. The grid is generated per
row with ``explode(sequence(...))`` on integers — a narrow operation, no
join and no shuffle — so the work is one pass over the companies × 315.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.scalars import clip, col_, logit, sigmoid
from ..functions.text import fill_text, fmt_fixed, fmt_pct1

# ---- fixed values: slider ranges (integers; divided afterwards, T-22) ----
REV_SHOCK_PCT = (-50, 20, 5)        # revenue shock in percent: min, max, step
VOL_TENTHS = (10, 30, 1)            # volatility multiplier in tenths: 1.0 … 3.0 step 0.1
PD_CLIP = (0.001, 0.999)
REV_SENSITIVITY = -5.0              # logit change per unit of revenue shock
VOL_SENSITIVITY = 1.5               # logit change per unit of extra volatility
HIGH_PD = 0.2                       # recommendation / risk-level cut
# ---- fixed values: findings thresholds and texts ----
LEVERAGE_LIMIT = 0.6
VOLATILITY_LIMIT = 1.5
PAST_DEFAULT_LIMIT = 0.5
TXT_REVENUE = "Revenue is contracting (%s)."
TXT_LEVERAGE = "Leverage is critically high (%s)."
TXT_VOLATILITY = "Cash flow is highly volatile (%sx)."
TXT_DEFAULT = "History of default detected."
RISK_TITLE = "⚠️ Critical Risk Factor(s)"
RISK_TAIL = " These factors significantly elevate the Probability of Default under stress."
SAFE_TITLE = "✅ Stability Assessment"
SAFE_TEXT = ("All key risk metrics are within healthy ranges. The company demonstrates strong resilience "
             "against stress scenarios.")
REC_REJECT = "REJECT / WATCHLIST"
REC_APPROVE = "APPROVE"
PD_BANDS = [(5.0, "0-5%"), (20.0, "5-20%")]   # gauge bands on PD in percent; else 20-100%
PD_BAND_TOP = "20-100%"


def scenario_grid(df: DataFrame) -> DataFrame:
    """J-8: each row × 15 revenue shocks × 21 volatility multipliers (315 scenarios)."""
    lo, hi, step = REV_SHOCK_PCT
    vlo, vhi, vstep = VOL_TENTHS
    return (df.withColumn("_rev_pct", F.explode(F.sequence(F.lit(lo), F.lit(hi), F.lit(step))))
              .withColumn("_vol_tenths", F.explode(F.sequence(F.lit(vlo), F.lit(vhi), F.lit(vstep))))
              .withColumn("shock_rev", F.col("_rev_pct") / 100.0)
              .withColumn("shock_vol", F.col("_vol_tenths") / 10.0)
              .drop("_rev_pct", "_vol_tenths"))


def logit_change(shock_rev: str | Column, shock_vol: str | Column) -> Column:
    return (col_(shock_rev) * F.lit(REV_SENSITIVITY)) + ((col_(shock_vol) - F.lit(1.0)) * F.lit(VOL_SENSITIVITY))


def base_pd(pd: str | Column) -> Column:
    """PD clipped to [0.001, 0.999] before any log-odds arithmetic."""
    return clip(col_(pd), *PD_CLIP)


def stressed_pd(pd: str | Column, shock_rev: str | Column, shock_vol: str | Column) -> Column:
    """M-17: σ(logit(clip(pd)) − 5·shock_rev + 1.5·(vol − 1))."""
    return sigmoid(logit(base_pd(pd)) + logit_change(shock_rev, shock_vol))


def stressed_growth(growth: str | Column, shock_rev: str | Column) -> Column:
    """M-18: growth·(1 + shock) — a negative shock shrinks negative growth too (T-15)."""
    return col_(growth) * (F.lit(1.0) + col_(shock_rev))


def stressed_volatility(cfv: str | Column, shock_vol: str | Column) -> Column:
    """M-18: volatility·multiplier."""
    return col_(cfv) * col_(shock_vol)


def findings(str_rev: Column, dta: Column, str_vol: Column, past_default: Column) -> Column:
    """R-10: the list of triggered findings (array of text, in rule order)."""
    return F.array_compact(F.array(
        F.when(str_rev < 0, fill_text(TXT_REVENUE, fmt_pct1(str_rev))),
        F.when(dta > LEVERAGE_LIMIT, fill_text(TXT_LEVERAGE, fmt_pct1(dta))),
        F.when(str_vol > VOLATILITY_LIMIT,
               fill_text(TXT_VOLATILITY, fmt_fixed(str_vol, 2))),
        F.when(past_default > PAST_DEFAULT_LIMIT, F.lit(TXT_DEFAULT)),
    ))


def verdict_title(found: Column) -> Column:
    return F.when(F.size(found) > 0, F.lit(RISK_TITLE)).otherwise(F.lit(SAFE_TITLE))


def verdict_text(found: Column) -> Column:
    """R-10: findings joined by spaces + the closing sentence, or the all-clear text."""
    return F.when(F.size(found) > 0, F.concat(F.array_join(found, " "), F.lit(RISK_TAIL))).otherwise(F.lit(SAFE_TEXT))


def recommendation(new_pd: str | Column) -> Column:
    """R-11: stressed PD above 0.2 → REJECT / WATCHLIST, else APPROVE."""
    return F.when(col_(new_pd) > HIGH_PD, REC_REJECT).otherwise(REC_APPROVE)


def pd_band(new_pd: str | Column) -> Column:
    """R-12: gauge band of the stressed PD (0–5, 5–20, 20–100 %)."""
    pct = col_(new_pd) * 100
    expr = None
    for bound, label in PD_BANDS:
        expr = F.when(pct < bound, label) if expr is None else expr.when(pct < bound, label)
    return expr.otherwise(PD_BAND_TOP)


def spread_for_expansion(df: DataFrame, num_partitions: int | None = None) -> DataFrame:
    """Fix the task count before a row-multiplying step (explode ×315).

    AQE sizes partitions by their input bytes; a small company table would be
    coalesced into one partition and the whole expanded grid would run in a
    single task. An explicit round-robin repartition (which AQE keeps) spreads
    the companies over ``spark.sql.shuffle.partitions`` tasks first.
    """
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n)


def stress_table(scored: DataFrame, *, pd_col: str = "predicted_default_prob",
                 num_partitions: int | None = None) -> DataFrame:
    """Companies × scenarios with stressed PD and metrics (J-8, M-17, M-18, R-10 … R-13)."""
    companies = scored.select("company_id", pd_col, "revenue_growth", "debt_to_asset_ratio",
                              "cash_flow_volatility", "past_default")
    grid = scenario_grid(spread_for_expansion(companies, num_partitions))
    s = grid.select(
        "company_id", "shock_rev", "shock_vol", "debt_to_asset_ratio", "past_default",
        base_pd(pd_col).alias("base_pd"),
        stressed_pd(pd_col, "shock_rev", "shock_vol").alias("stressed_pd"),
        stressed_growth("revenue_growth", "shock_rev").alias("stressed_growth"),
        stressed_volatility("cash_flow_volatility", "shock_vol").alias("stressed_volatility"),
    )
    s = s.withColumn("_found", findings(F.col("stressed_growth"), F.col("debt_to_asset_ratio"),
                                        F.col("stressed_volatility"), F.col("past_default")))
    found = F.col("_found")
    return s.select(
        "company_id", "shock_rev", "shock_vol", "debt_to_asset_ratio", "past_default", "base_pd", "stressed_pd",
        "stressed_growth", "stressed_volatility",
        (F.col("stressed_pd") - F.col("base_pd")).alias("pd_change"),
        pd_band("stressed_pd").alias("pd_band"),
        recommendation("stressed_pd").alias("recommendation"),
        F.size(found).alias("n_findings"),
        verdict_title(found).alias("verdict_title"),
        verdict_text(found).alias("verdict_text"),
    )
