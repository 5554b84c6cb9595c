"""Cleaning profiles: loader A (P-10, P-11, P-21, P-23, C-14, F-3) and the
profile-B landing → clean layer (P-1, P-3 … P-9, F-1, F-2, W-1, A-10)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.scalars import (dti_from_text, emp_years, fico_midpoint, lenient_real,
                                 pct_to_fraction, term_months)
from .sizing import checked_broadcast

# ---- fixed values: known-outcome statuses (profile B filter) ----
KNOWN_OUTCOME_STATUSES = ["Fully Paid", "Charged Off", "Default", "Current", "Late (31-120 days)"]

# ---- fixed values: loader A status → default flag map (unmapped → 0) ----
STATUS_DEFAULT_MAP = {
    "Fully Paid": 0,
    "Current": 0,
    "In Grace Period": 0,
    "Late (31-120 days)": 1,
    "Default": 1,
    "Charged Off": 1,
    "Does not meet the credit policy. Status:Fully Paid": 0,
    "Does not meet the credit policy. Status:Charged Off": 1,
}

# ---- fixed values: loader A grade → FICO estimate (missing → 680) ----
GRADE_TO_FICO = {"A": 750, "B": 700, "C": 650, "D": 600, "E": 550, "F": 500, "G": 450}
FICO_DEFAULT = 680
FICO_MIN, FICO_MAX = 300, 850
DEBT_INSTALLMENT_FACTOR, MONTHS_PER_YEAR = 1.5, 12   # annual debt estimate when no DTI column exists


def _numeric(df: DataFrame, name: str) -> Column:
    """A landing column as double: lenient text parse for strings, cast otherwise."""
    dtype = df.schema[name].dataType
    return lenient_real(name) if isinstance(dtype, T.StringType) else F.col(name).cast("double")


def _literal_map(mapping: dict) -> Column:
    items = []
    for k, v in mapping.items():
        items += [F.lit(k), F.lit(v)]
    return F.create_map(*items)


# ------------------------------------------------------------- W-1 / A-10
def fill_by_group_mean(df: DataFrame, column: str, group: str, *, out: str | None = None,
                       over: DataFrame | None = None) -> DataFrame:
    """W-1: ``coalesce(x, avg(x) over (partition by group))``.

    One grouped average (A-10; partial + final aggregation, one row per group)
    joined back with a size-checked broadcast, instead of a window that moves
    every row of a group into one task. ``over`` computes the means on another
    frame (default: ``df``).
    """
    target = out or column
    source = df if over is None else over
    means = source.groupBy(group).agg(F.avg(column).alias("_grp_mean")).withColumnRenamed(group, "_grp_key")
    joined = df.join(checked_broadcast(means), F.col(group).eqNullSafe(F.col("_grp_key")), "left")
    return joined.withColumn(target, F.coalesce(F.col(column), F.col("_grp_mean"))).drop("_grp_key", "_grp_mean")


# ------------------------------------------------------------- profile B
def known_outcomes(landing: DataFrame) -> DataFrame:
    """F-1: statuses with a known outcome and a positive, present amount."""
    amount = _numeric(landing, "loan_amnt")
    return landing.where(F.col("loan_status").isin(*KNOWN_OUTCOME_STATUSES) & amount.isNotNull() & (amount > 0))


def raw_cleaned_b(landing: DataFrame) -> DataFrame:
    """Typed, parsed columns of the landing zone (the CTE of the clean layer)."""
    src = known_outcomes(landing)
    inc = _numeric(src, "annual_inc")
    inst = _numeric(src, "installment")
    rate = src.schema["int_rate"].dataType
    interest = pct_to_fraction("int_rate") if isinstance(rate, T.StringType) else F.col("int_rate") / 100.0
    return src.select(
        F.col("id").alias("loan_id"),
        F.coalesce(_numeric(src, "loan_amnt"), F.lit(0.0)).alias("loan_amount"),
        emp_years("emp_length").alias("emp_years"),
        inc.alias("annual_income_raw"),
        "grade", "sub_grade",
        dti_from_text(_numeric(src, "dti"), inc, inst).alias("dti_ratio"),
        "loan_status",
        fico_midpoint(_numeric(src, "fico_range_low"), _numeric(src, "fico_range_high"),
                      _numeric(src, "last_fico_range_low"), _numeric(src, "last_fico_range_high")).alias("fico_score"),
        interest.alias("interest_rate"),
        term_months("term").alias("term_months"),
        "home_ownership", "verification_status",
    )


def _quality_b(income: Column) -> Column:
    """F-2: positive income and amount; FICO absent or within 300–850."""
    fico = F.col("fico_score")
    return (income > 0) & (F.col("loan_amount") > 0) & (fico.isNull() | ((fico >= FICO_MIN) & (fico <= FICO_MAX)))


CLEAN_B_COLUMNS = ["loan_id", "loan_amount", "emp_years", "annual_income", "grade", "sub_grade", "dti_ratio",
                   "loan_status", "fico_score", "interest_rate", "term_months", "home_ownership",
                   "verification_status"]


def clean_loans_b(landing: DataFrame, *, income_mode: str = "strict") -> DataFrame:
    """``clean_loans`` of profile B.

    ``strict`` is the layer as written: the quality filter runs before the
    grade-mean fill, so the fill never fires (T-5) and is skipped — no
    window, no shuffle. ``impute_then_filter`` fills a missing income with
    its grade's mean income (A-10) and then applies the quality filter.
    """
    rc = raw_cleaned_b(landing)
    if income_mode == "strict":
        out = rc.where(_quality_b(F.col("annual_income_raw"))).withColumn("annual_income", F.col("annual_income_raw"))
    elif income_mode == "impute_then_filter":
        filled = fill_by_group_mean(rc, "annual_income_raw", "grade", out="annual_income")
        out = filled.where(_quality_b(F.col("annual_income")))
    else:
        raise ValueError(income_mode)
    return out.select(*CLEAN_B_COLUMNS)


# ------------------------------------------------------------- loader A
def loader_a(landing: DataFrame, *, sample: int | None = None, seed: int = 42) -> DataFrame:
    """Loader A over a landing-zone frame → ``raw_loans`` columns.

    Medians (C-14) are exact and computed over the whole input (A-8), two scans
    for income and amount and two for the debt that follows from the income. The upstream plan runs once: its slim columns are written to
    the shared folder. The branches on column
    presence (P-11, P-23) follow the source file's schema.
    """
    from ..sources.tables import land, sample_n
    from .quantiles import medians

    src = sample_n(landing, "id", sample, seed) if sample else landing
    cols = set(src.columns)
    status = F.col("loan_status")
    flagged = src.select(
        "*",
        F.coalesce(_literal_map(STATUS_DEFAULT_MAP)[status], F.lit(0)).alias("_flag"),
        F.concat(F.lit("LOAN_"), F.col("id").cast("string")).alias("_loan_id"),
    )
    if {"fico_range_low", "fico_range_high"} <= cols:
        fico = F.coalesce((_numeric(flagged, "fico_range_low") + _numeric(flagged, "fico_range_high")) / 2,
                          F.lit(float(FICO_DEFAULT)))
    else:
        fico = F.coalesce(_literal_map(GRADE_TO_FICO)[F.col("grade")].cast("double"), F.lit(float(FICO_DEFAULT)))
    debt_source = _numeric(flagged, "dti") if "dti" in cols else _numeric(flagged, "installment")
    # the slim columns are written once: the medians and the result read them,
    # not the upstream plan
    slim_path = land(flagged.select(
        F.col("_loan_id").alias("loan_id"), _numeric(flagged, "annual_inc").alias("_inc"), debt_source.alias("_debt"),
        fico.alias("_fico"), _numeric(flagged, "loan_amnt").alias("_amt"), F.col("_flag").alias("default_flag")), name="loader_a")
    slim = landing.sparkSession.read.parquet(slim_path)
    known = medians(slim, ["_inc", "_amt"])
    income = F.coalesce(F.col("_inc"), F.lit(known["_inc"]).cast("double"))
    if "dti" in cols:
        debt = F.col("_debt") / 100.0 * income
    else:
        debt = F.col("_debt") * F.lit(DEBT_INSTALLMENT_FACTOR) * F.lit(MONTHS_PER_YEAR)
    step = slim.select("*", income.alias("income"), debt.alias("_debt_raw"))
    out = step.select(
        "loan_id", "income",
        F.coalesce(F.col("_debt_raw"), F.lit(medians(step, ["_debt_raw"])["_debt_raw"]).cast("double")).alias("total_debt"),
        "_fico",
        F.coalesce(F.col("_amt"), F.lit(known["_amt"]).cast("double")).alias("loan_amount"),
        "default_flag",
    )
    valid = (F.col("income") > 0) & (F.col("loan_amount") > 0) & (F.col("_fico") >= FICO_MIN) & (F.col("_fico") <= FICO_MAX)
    return out.where(valid).select(
        "loan_id", "income", "total_debt",
        F.floor("_fico").cast("int").alias("fico_score"),   # truncation (values are positive)
        "loan_amount", "default_flag")
