"""Feature engineering for the two loan profiles (P-7 … P-24, J-9).

Profile A and profile B disagree on FICO bins, size thresholds (strict vs
inclusive), encoding direction and defaults, so they are two sets of
functions, never shared constants.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.scalars import col_, safe_ratio

# ---- fixed values of profile A (bins of the SQL feature step) ----
A_FICO_BINS = [(580, "Poor"), (670, "Fair"), (740, "Good")]          # fico < bound; else Excellent
A_FICO_TOP = "Excellent"
A_SIZE_BINS = [(50000, "Large"), (20000, "Medium")]                  # amount > bound; else Small
A_SIZE_BOTTOM = "Small"
A_FICO_CODES = {"Poor": 0, "Fair": 1, "Good": 2}                     # else 3
A_SIZE_CODES = {"Small": 0, "Medium": 1}                             # else 2

# ---- fixed values of profile B (bins of the feature view) ----
B_CREDIT_BINS = [(750, "Excellent"), (700, "Good"), (650, "Fair"), (580, "Poor")]   # fico >= bound
B_CREDIT_BOTTOM = "Very Poor"
B_SIZE_BINS = [(25000, "Large"), (10000, "Medium")]                  # amount >= bound
B_INCOME_BINS = [(100000, "High"), (50000, "Medium")]                # income >= bound; else Low
B_DTI_BINS = [(0.43, "High Risk"), (0.36, "Medium Risk")]            # dti >= bound; else Low Risk
B_CREDIT_CODES = {"Excellent": 4, "Good": 3, "Fair": 2, "Poor": 1}   # else 0
B_SIZE_CODES = {"Large": 2, "Medium": 1}                             # else 0
B_INCOME_CODES = {"High": 2, "Medium": 1}                            # else 0
B_DEFAULT_STATUSES = ["Charged Off", "Default"]
B_LATE_PATTERN = "Late%"
B_FICO_DEFAULT = 680


def _bins(x: Column, bins, otherwise: str, op: str) -> Column:
    expr = None
    for bound, label in bins:
        cond = {"<": x < bound, ">": x > bound, ">=": x >= bound}[op]
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(otherwise)


def _codes(x: Column, codes: dict, otherwise: int) -> Column:
    expr = None
    for label, code in codes.items():
        expr = F.when(x == label, code) if expr is None else expr.when(x == label, code)
    return expr.otherwise(otherwise)


# ---------------- profile A ----------------
def fico_category_a(fico: str | Column) -> Column:
    """P-12: <580 Poor, <670 Fair, <740 Good, else Excellent (NULL → Excellent)."""
    return _bins(col_(fico), A_FICO_BINS, A_FICO_TOP, "<")


def loan_size_a(amount: str | Column) -> Column:
    """P-14: >50000 Large, >20000 Medium, else Small (strict, NULL → Small)."""
    return _bins(col_(amount), A_SIZE_BINS, A_SIZE_BOTTOM, ">")


def features_a(raw: DataFrame) -> DataFrame:
    """Profile A feature table (P-7, P-8, P-12, P-14) over ``raw_loans``."""
    return raw.select(
        "loan_id", "income", "total_debt", "fico_score", "loan_amount", "default_flag",
        F.round(safe_ratio(F.col("total_debt"), F.col("income")), 4).alias("dti_ratio"),
        fico_category_a("fico_score").alias("fico_category"),
        F.round(safe_ratio(F.col("loan_amount"), F.col("income")), 4).alias("loan_to_income_ratio"),
        loan_size_a("loan_amount").alias("loan_size_category"),
    )


def encode_a(features: DataFrame) -> DataFrame:
    """P-18: ordinal codes of profile A (FICO 0–3, size 0–2)."""
    return features.select(
        "loan_id", "dti_ratio",
        _codes(F.col("fico_category"), A_FICO_CODES, 3).alias("fico_encoded"),
        "loan_to_income_ratio",
        _codes(F.col("loan_size_category"), A_SIZE_CODES, 2).alias("loan_size_encoded"),
        "default_flag",
    )


A_MODEL_FEATURES = ["dti_ratio", "fico_encoded", "loan_to_income_ratio", "loan_size_encoded"]


# ---------------- profile B ----------------
def credit_bucket_b(fico: str | Column) -> Column:
    """P-13: ≥750 Excellent, ≥700 Good, ≥650 Fair, ≥580 Poor, else Very Poor.
    Must be applied to the raw FICO (NULL → Very Poor), before the default fill."""
    return _bins(col_(fico), B_CREDIT_BINS, B_CREDIT_BOTTOM, ">=")


def loan_size_b(amount: str | Column) -> Column:
    """P-15: ≥25000 Large, ≥10000 Medium, else Small (inclusive)."""
    return _bins(col_(amount), B_SIZE_BINS, "Small", ">=")


def income_category(income: str | Column) -> Column:
    """P-16: ≥100000 High, ≥50000 Medium, else Low."""
    return _bins(col_(income), B_INCOME_BINS, "Low", ">=")


def dti_risk_category(dti: str | Column) -> Column:
    """P-17: ≥0.43 High Risk, ≥0.36 Medium Risk, else Low Risk (NULL → Low Risk)."""
    return _bins(col_(dti), B_DTI_BINS, "Low Risk", ">=")


def default_flag_b(status: str | Column) -> Column:
    """P-20: Charged Off / Default, or any status starting with Late (ASCII
    case-insensitive), is a default."""
    s = col_(status)
    return F.when(s.isin(*B_DEFAULT_STATUSES), 1).when(s.ilike(B_LATE_PATTERN), 1).otherwise(0)


def features_b(clean: DataFrame) -> DataFrame:
    """Profile B feature view (P-13 … P-17, P-20, P-24). Bins read the raw
    columns, so a NULL FICO scores 680 but buckets as Very Poor (T-1)."""
    return clean.select(
        "loan_id", "loan_amount", "annual_income",
        F.coalesce(F.col("dti_ratio"), F.lit(0.0)).alias("dti_ratio"),
        F.coalesce(F.col("fico_score"), F.lit(float(B_FICO_DEFAULT))).alias("fico_score"),
        F.coalesce(F.col("emp_years"), F.lit(0)).alias("emp_years"),
        "term_months", "interest_rate", "grade", "sub_grade", "home_ownership",
        default_flag_b("loan_status").alias("default_flag"),
        credit_bucket_b("fico_score").alias("credit_bucket"),
        loan_size_b("loan_amount").alias("loan_size_category"),
        income_category("annual_income").alias("income_category"),
        dti_risk_category("dti_ratio").alias("dti_risk_category"),
    )


def encode_b(features: DataFrame) -> DataFrame:
    """P-19 (+ F-4): ordinal codes of profile B (bucket 4–0, size 2–0,
    income 2–0). The not-null filter on the filled FICO is always true and
    Catalyst removes it."""
    return features.where(F.col("fico_score").isNotNull()).select(
        "loan_id", "dti_ratio",
        _codes(F.col("credit_bucket"), B_CREDIT_CODES, 0).alias("credit_bucket_encoded"),
        _codes(F.col("loan_size_category"), B_SIZE_CODES, 0).alias("loan_size_encoded"),
        _codes(F.col("income_category"), B_INCOME_CODES, 0).alias("income_category_encoded"),
        "default_flag",
    )


B_MODEL_FEATURES = ["dti_ratio", "credit_bucket_encoded", "loan_size_encoded", "income_category_encoded"]


# ---------------- bins held as data (J-9) ----------------
# cells of the J-9 range join: bins are grouped by at most this many cuts
BIN_CELLS = 64


def bins_table(spark, bins, *, name: str, otherwise: str, op: str):
    """The bins of a CASE chain as rows ``(name, label, lo, hi, priority)``,
    half-open ``[lo, hi)`` for ``<``/``>=`` chains and ``(lo, hi]`` for ``>``."""
    rows = []
    if op == "<":
        lo = None
        for bound, label in bins:
            rows.append((name, label, lo, float(bound)))
            lo = float(bound)
        rows.append((name, otherwise, lo, None))
    else:  # descending thresholds
        hi = None
        for bound, label in bins:
            rows.append((name, label, float(bound), hi))
            hi = float(bound)
        rows.append((name, otherwise, None, hi))
    return spark.createDataFrame(rows, "bin_set string, label string, lo double, hi double")


def bin_by_range_join(df: DataFrame, value: str, bins: DataFrame, *, out: str, null_label: str,
                      inclusive_lo: bool = True) -> DataFrame:
    """J-9: categorise by a range join against a bin table of any size whose
    bins do not overlap. ``inclusive_lo`` chooses ``[lo, hi)`` (``>=``/``<``
    chains) or ``(lo, hi]`` (``>`` chains). A NULL value matches no range and
    takes ``null_label``, the bin the CASE chain falls through to.

    A bin table that passes a size check is broadcast: the bounds cut the
    number line into cells, every bin is listed under the cells it touches and
    every value looks up its own cell, so the range test is the residual of an
    equi-join and the wide rows stay where they are. A larger table is merged
    with the values in sorted order (:func:`bin_by_sorted_merge`); the result
    is the same.
    """
    from .sizing import DEFAULT_MAX_BROADCAST_ROWS, checked_broadcast

    if bins.limit(DEFAULT_MAX_BROADCAST_ROWS + 1).count() > DEFAULT_MAX_BROADCAST_ROWS:
        return bin_by_sorted_merge(df, value, bins, out=out, null_label=null_label, inclusive_lo=inclusive_lo)
    bound = F.coalesce("lo", "hi")
    # at most CELLS numbers: quantiles of the bounds
    cuts = bins.agg(F.percentile_approx(bound.cast("double"), F.array(*[F.lit(i / BIN_CELLS) for i in range(BIN_CELLS)]), 10_000)).first()[0]
    cuts = F.array(*[F.lit(c) for c in sorted(set(cuts or []))]).cast("array<double>")

    def cell(x: Column) -> Column:
        return F.size(F.filter(cuts, lambda c: c <= x))

    listed = bins.select("label", "lo", "hi", F.explode(F.sequence(
        F.coalesce(cell(F.col("lo")), F.lit(0)), F.when(F.col("hi").isNull(), F.size(cuts)).otherwise(cell(F.col("hi"))))).alias("_cell"))
    b = checked_broadcast(listed.select(F.col("label").alias("_bin_label"), F.col("lo").alias("_bin_lo"), F.col("hi").alias("_bin_hi"), "_cell"))
    v, lo, hi = F.col(value), F.col("_bin_lo"), F.col("_bin_hi")
    if inclusive_lo:
        inside = (lo.isNull() | (v >= lo)) & (hi.isNull() | (v < hi))
    else:
        inside = (lo.isNull() | (v > lo)) & (hi.isNull() | (v <= hi))
    valued = df.withColumn("_value_cell", F.when(v.isNotNull(), cell(v.cast("double"))))
    joined = valued.join(b, (F.col("_value_cell") == F.col("_cell")) & inside, "left")
    label = F.when(v.isNull(), F.lit(null_label)).otherwise(F.col("_bin_label"))
    return joined.select(*df.columns, label.alias(out))


def bin_by_sorted_merge(df: DataFrame, value: str, bins: DataFrame, *, out: str, null_label: str, inclusive_lo: bool = True,
                        num_partitions: int | None = None) -> DataFrame:
    """J-9 for a bin table of any size: bins and values are range-partitioned
    together by position, sorted, and every value takes the last bin that opened
    before it, carried over partition edges, if that bin still holds it. Equal
    values are spread by a hash of their row, so neither a hot value nor the
    number of bins in one place decides a task's size."""
    from .ordered import carry_forward

    own = df.columns
    names = {c: f"_v{i}" for i, c in enumerate(own)}           # helper names never clash with the caller's
    v = F.col(names[value])
    # at one place [lo, hi) opens before its values, (lo, hi] after them
    opens, holds = (0, 1) if inclusive_lo else (1, 0)
    values = df.select(*[F.col(f"`{c}`").alias(a) for c, a in names.items()]) \
        .select("*", F.when(v.isNull(), 0).otherwise(1).alias("_at"), v.cast("double").alias("_place"), F.lit(holds).alias("_kind"),
                F.xxhash64(*names.values()).alias("_tie"))
    starts = bins.select(F.when(F.col("lo").isNull(), 0).otherwise(1).alias("_at"), F.col("lo").cast("double").alias("_place"),
                         F.lit(opens).alias("_kind"), F.lit(0).cast("long").alias("_tie"), F.lit(True).alias("_bin"),
                         F.col("label").alias("_label"), F.col("hi").cast("double").alias("_hi"))
    merged = carry_forward(values.unionByName(starts, allowMissingColumns=True), ["_at", "_place", "_kind", "_tie"],
                           ["_label", "_hi"], F.col("_bin"), prefix="_open", num_partitions=num_partitions)
    place, hi = F.col("_place"), F.col("_open_hi")
    inside = hi.isNull() | ((place < hi) if inclusive_lo else (place <= hi))
    label = F.when(v.isNull(), F.lit(null_label)).when(inside, F.col("_open_label"))
    return merged.where(F.col("_bin").isNull()).select(*[F.col(a).alias(c) for c, a in names.items()], label.alias(out))
