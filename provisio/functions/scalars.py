"""Scalar helpers (C-1 … C-15, P-3 … P-6): lenient casts, clip, sigmoid,
logit and the text parsers of the landing layer."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

__all__ = ["col_", "lenient_real", "lenient_int", "first_char_int", "emp_years", "term_months",
           "pct_to_fraction", "dti_from_text", "fico_midpoint", "clip", "sigmoid", "logit",
           "safe_ratio", "round_half_up"]

# Leading numeric prefix, as a lenient text→number cast reads it.
_REAL_PREFIX = r"^\s*([+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?)"
_INT_PREFIX = r"^\s*([+-]?\d+)"


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lenient_real(c: str | Column) -> Column:
    """C-3: text → double the lenient way: the leading number, 0.0 when the
    text has none, NULL stays NULL (``'12.5%'`` → 12.5, ``'abc'`` → 0.0)."""
    s = col_(c).cast("string")
    prefix = F.regexp_extract(s, _REAL_PREFIX, 1)
    return F.when(s.isNull(), F.lit(None).cast("double")) \
        .otherwise(F.coalesce(prefix.try_cast("double"), F.lit(0.0)))


def lenient_int(c: str | Column) -> Column:
    """C-3: text → int the lenient way (leading integer, else 0; NULL stays NULL)."""
    s = col_(c).cast("string")
    prefix = F.regexp_extract(s, _INT_PREFIX, 1)
    return F.when(s.isNull(), F.lit(None).cast("int")).otherwise(F.coalesce(prefix.try_cast("int"), F.lit(0)))


def first_char_int(c: str | Column) -> Column:
    """C-5 + C-3: lenient integer of the first character (``'7 yrs'`` → 7, ``'x'`` → 0)."""
    return lenient_int(F.substr(col_(c), F.lit(1), F.lit(1)))


def emp_years(c: str | Column) -> Column:
    """P-3: employment-length text → years. Rule order matters:
    ``'11 years'`` matches ``'%1 year%'`` first (→ 1); ``'10 years'`` (no
    plus) falls through to the first character (→ 1). Matching is ASCII
    case-insensitive."""
    s = col_(c)
    expr = F.when(s.isNull() | (s == "n/a"), F.lit(None).cast("int"))
    expr = expr.when(s.ilike("%10+%"), 10)
    expr = expr.when(s.ilike("%< 1%"), 0)
    expr = expr.when(s.ilike("%1 year%"), 1)
    for n in range(2, 10):
        expr = expr.when(s.ilike(f"%{n} years%"), n)
    return expr.otherwise(first_char_int(s))


def term_months(c: str | Column) -> Column:
    """P-4: term text → 36 / 60 / NULL."""
    s = col_(c)
    return F.when(s.ilike("%36%"), 36).when(s.ilike("%60%"), 60).otherwise(F.lit(None).cast("int"))


def pct_to_fraction(c: str | Column) -> Column:
    """P-5: percent text (``'13.99%'`` or ``'13.99'``) → fraction 0.1399."""
    return lenient_real(F.replace(col_(c).cast("string"), F.lit("%"), F.lit(""))) / 100.0


def dti_from_text(dti: Column, income: Column, installment: Column) -> Column:
    """P-6: DTI percent / 100; else 12·installment / income when both are
    positive; else NULL."""
    fallback = F.when((income > 0) & (installment > 0), (installment * 12.0) / income)
    return F.coalesce(dti / 100.0, fallback)


def fico_midpoint(lo: Column, hi: Column, last_lo: Column, last_hi: Column) -> Column:
    """P-9: midpoint of the origination FICO range, else of the last range, else NULL."""
    return (F.when(lo.isNotNull() & hi.isNotNull(), (lo + hi) / 2.0)
            .when(last_lo.isNotNull() & last_hi.isNotNull(), (last_lo + last_hi) / 2.0))


def clip(x: Column, lo: float, hi: float) -> Column:
    """C-10: clip to [lo, hi]; NULL stays NULL (``greatest`` alone would skip it)."""
    return F.when(x.isNull(), F.lit(None).cast("double")).otherwise(F.least(F.greatest(x, F.lit(lo)), F.lit(hi)))


def sigmoid(x: Column) -> Column:
    """C-9: logistic function 1 / (1 + e^−x)."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))


def logit(p: Column) -> Column:
    """C-9: log-odds ln(p / (1 − p))."""
    return F.ln(p / (F.lit(1.0) - p))


def safe_ratio(num: Column, den: Column) -> Column:
    """C-2: num / NULLIF(den, 0) — NULL instead of a division error."""
    return num / F.nullif(den, F.lit(0))


def round_half_up(x: Column, digits: int) -> Column:
    """C-7: ROUND half away from zero (Spark's ``round`` is HALF_UP)."""
    return F.round(x, digits)
