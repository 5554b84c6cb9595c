"""Declared layer schemas (S-14, S-16) and a schema check."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

S, D, I, L = T.StringType(), T.DoubleType(), T.IntegerType(), T.LongType()


def _st(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


RAW_LOANS = _st(("loan_id", S), ("income", D), ("total_debt", D), ("fico_score", I), ("loan_amount", D),
                ("default_flag", I))
MODEL_FEATURES_A = _st(*[(f.name, f.dataType) for f in RAW_LOANS.fields], ("dti_ratio", D), ("fico_category", S),
                       ("loan_to_income_ratio", D), ("loan_size_category", S))
LOAN_PREDICTIONS_A = _st(("loan_id", S), ("pd", D))
LOAN_STAGING_A = _st(("loan_id", S), ("loan_amount", D), ("default_flag", I), ("pd", D), ("stage", I), ("ecl", D))
LANDING_CSV = _st(("id", L), ("loan_amnt", D), ("emp_length", S), ("annual_inc", D), ("grade", S), ("sub_grade", S),
                  ("dti", D), ("installment", D), ("loan_status", S), ("fico_range_low", D), ("fico_range_high", D),
                  ("last_fico_range_low", D), ("last_fico_range_high", D), ("int_rate", S), ("term", S),
                  ("home_ownership", S), ("verification_status", S))
CLEAN_LOANS_B = _st(("loan_id", L), ("loan_amount", D), ("emp_years", I), ("annual_income", D), ("grade", S),
                    ("sub_grade", S), ("dti_ratio", D), ("loan_status", S), ("fico_score", D), ("interest_rate", D),
                    ("term_months", I), ("home_ownership", S), ("verification_status", S))
LOAN_PREDICTIONS_B = _st(("loan_id", L), ("pd_12m", D), ("pd_lifetime", D), ("model_version", S))
LOAN_STAGING_B = _st(("loan_id", L), ("loan_amount", D), ("default_flag", I), ("grade", S), ("fico_score", D),
                     ("pd_12m", D), ("pd_lifetime", D), ("stage", I), ("ecl", D))
MODEL_VERSION_DEFAULT = "v1.0"


def schema_report(df: DataFrame, expected: T.StructType) -> DataFrame:
    """S-14: one row per declared (or undeclared) column: expected and actual
    type, whether they agree, and how many rows have a value (one scan)."""
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    declared = {f.name: f.dataType.simpleString() for f in expected.fields}
    filled = df.agg(*[F.count(F.col(f"`{n}`")).alias(n) for n in actual])
    rows = F.array(*[F.struct(F.lit(n).alias("column"), F.lit(declared.get(n)).alias("expected"), F.lit(actual.get(n)).alias("actual"),
                              F.lit(n in declared and declared[n] == actual.get(n)).alias("ok"),
                              (F.col(f"`{n}`") if n in actual else F.lit(None).cast("long")).alias("filled"))
                     for n in [*declared, *(n for n in actual if n not in declared)]])
    return filled.select(F.explode(rows).alias("r")).select("r.*")
