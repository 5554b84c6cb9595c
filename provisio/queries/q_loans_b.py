"""Registered queries: profile B (landing → clean → features → stage/ECL → reports)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as sc
from ..operators import clean, features as feat, reports, staging
from ..plans import book_b
from . import register

PD9 = 9

# fixed values: stage texts
STAGE_TEXT = """case stage when 1 then 'Stage 1: Performing'
                  when 2 then 'Stage 2: Significant Increase in Credit Risk'
                  when 3 then 'Stage 3: Defaulted' end"""


@register("f1_known_outcomes", """
select id from raw_landing_zone
where loan_status in ('Fully Paid', 'Charged Off', 'Default', 'Current', 'Late (31-120 days)')
  and loan_amnt is not null and loan_amnt > 0
""", ("raw_landing_zone",))
def f1_known_outcomes(spark, sf):
    return clean.known_outcomes(book_b.landing(spark, sf)).select("id")


@register("p3_emp_years", """
select loan_id, emp_years from raw_cleaned_b
""", ("raw_cleaned_b",))
def p3_emp_years(spark, sf):
    land = clean.known_outcomes(book_b.landing(spark, sf))
    return land.select(F.col("id").alias("loan_id"), sc.emp_years("emp_length").alias("emp_years"))


@register("p4_term_months", """
select loan_id, term_months from raw_cleaned_b
""", ("raw_cleaned_b",))
def p4_term_months(spark, sf):
    land = clean.known_outcomes(book_b.landing(spark, sf))
    return land.select(F.col("id").alias("loan_id"), sc.term_months("term").alias("term_months"))


@register("p5_pct_to_fraction", """
select loan_id, round(interest_rate, 10) as interest_rate from raw_cleaned_b
""", ("raw_cleaned_b",))
def p5_pct_to_fraction(spark, sf):
    land = clean.known_outcomes(book_b.landing(spark, sf))
    return land.select(F.col("id").alias("loan_id"), F.round(sc.pct_to_fraction("int_rate"), 10).alias("interest_rate"))


@register("p6_dti_from_text", """
select loan_id, round(dti_ratio, 10) as dti_ratio from raw_cleaned_b
""", ("raw_cleaned_b",))
def p6_dti_from_text(spark, sf):
    land = clean.known_outcomes(book_b.landing(spark, sf))
    return land.select(F.col("id").alias("loan_id"),
                       F.round(sc.dti_from_text(F.col("dti"), F.col("annual_inc"), F.col("installment")), 10)
                       .alias("dti_ratio"))


@register("p9_fico_midpoint_b", """
select loan_id, fico_score from raw_cleaned_b
""", ("raw_cleaned_b",))
def p9_fico_midpoint_b(spark, sf):
    land = clean.known_outcomes(book_b.landing(spark, sf))
    return land.select(F.col("id").alias("loan_id"),
                       sc.fico_midpoint(F.col("fico_range_low"), F.col("fico_range_high"),
                                        F.col("last_fico_range_low"), F.col("last_fico_range_high")).alias("fico_score"))


@register("f2_quality_filter_b", """
select loan_id, loan_amount, emp_years, annual_income, grade, sub_grade, round(dti_ratio, 10) as dti_ratio,
       loan_status, fico_score, round(interest_rate, 10) as interest_rate, term_months, home_ownership,
       verification_status
from clean_loans_b
""", ("clean_loans_b",))
def f2_quality_filter_b(spark, sf):
    return book_b.cleaned(spark, sf).withColumn("dti_ratio", F.round("dti_ratio", 10)) \
        .withColumn("interest_rate", F.round("interest_rate", 10))


@register("w1_grade_mean_income_strict", """
select loan_id, annual_income from clean_loans_b
""", ("clean_loans_b",))
def w1_grade_mean_income_strict(spark, sf):
    return book_b.cleaned(spark, sf, "strict").select("loan_id", "annual_income")


@register("w1_grade_mean_income_impute", """
select loan_id, round(annual_income, 6) as annual_income from clean_loans_b_imputed
""", ("clean_loans_b_imputed",))
def w1_grade_mean_income_impute(spark, sf):
    return book_b.cleaned(spark, sf, "impute_then_filter").select(
        "loan_id", F.round("annual_income", 6).alias("annual_income"))


@register("a10_grade_mean_aggregate", """
select grade, round(avg(annual_income_raw), 6) as mean_income, count(annual_income_raw) as n_income
from raw_cleaned_b group by grade
""", ("raw_cleaned_b",))
def a10_grade_mean_aggregate(spark, sf):
    rc = clean.raw_cleaned_b(book_b.landing(spark, sf))
    return rc.groupBy("grade").agg(F.round(F.avg("annual_income_raw"), 6).alias("mean_income"),
                                   F.count("annual_income_raw").alias("n_income"))


@register("p13_credit_bucket_b", """
select loan_id, fico_score, credit_bucket from features_b
""", ("features_b",))
def p13_credit_bucket_b(spark, sf):
    return book_b.features(spark, sf).select("loan_id", "fico_score", "credit_bucket")


@register("p15_loan_size_b", """
select loan_id, case when loan_amount >= 25000 then 'Large' when loan_amount >= 10000 then 'Medium'
                     else 'Small' end as loan_size_category from clean_loans_b
""", ("clean_loans_b",))
def p15_loan_size_b(spark, sf):
    return book_b.cleaned(spark, sf).select("loan_id", feat.loan_size_b("loan_amount").alias("loan_size_category"))


@register("p16_income_category", """
select loan_id, income_category from features_b
""", ("features_b",))
def p16_income_category(spark, sf):
    return book_b.cleaned(spark, sf).select("loan_id", feat.income_category("annual_income").alias("income_category"))


@register("p17_dti_risk_category", """
select loan_id, dti_risk_category from features_b
""", ("features_b",))
def p17_dti_risk_category(spark, sf):
    return book_b.cleaned(spark, sf).select("loan_id", feat.dti_risk_category("dti_ratio").alias("dti_risk_category"))


@register("p20_default_flag_b", """
select loan_id, loan_status, default_flag from features_b join clean_loans_b using (loan_id)
""", ("features_b",))
def p20_default_flag_b(spark, sf):
    return book_b.cleaned(spark, sf).select("loan_id", "loan_status",
                                            feat.default_flag_b("loan_status").alias("default_flag"))


@register("p24_default_substitution", """
select loan_id, round(dti_ratio, 10) as dti_ratio, fico_score, emp_years from features_b
""", ("features_b",))
def p24_default_substitution(spark, sf):
    return book_b.features(spark, sf).select("loan_id", F.round("dti_ratio", 10).alias("dti_ratio"),
                                             "fico_score", "emp_years")


@register("s9_feature_view_b", """
select loan_id, loan_amount, annual_income, round(dti_ratio, 10) as dti_ratio, fico_score, emp_years,
       term_months, round(interest_rate, 10) as interest_rate, grade, sub_grade, home_ownership, default_flag,
       credit_bucket, loan_size_category, income_category, dti_risk_category
from features_b
""", ("features_b",))
def s9_feature_view_b(spark, sf):
    from ..sources.tables import materialise_view

    view = materialise_view(book_b.features(spark, sf), "model_features_b")
    return view.withColumn("dti_ratio", F.round("dti_ratio", 10)).withColumn("interest_rate", F.round("interest_rate", 10))


@register("p19_encode_b", """
select loan_id, round(dti_ratio, 10) as dti_ratio,
       case credit_bucket when 'Excellent' then 4 when 'Good' then 3 when 'Fair' then 2 when 'Poor' then 1
            else 0 end as credit_bucket_encoded,
       case loan_size_category when 'Large' then 2 when 'Medium' then 1 else 0 end as loan_size_encoded,
       case income_category when 'High' then 2 when 'Medium' then 1 else 0 end as income_category_encoded,
       default_flag
from features_b where fico_score is not null
""", ("features_b",))
def p19_encode_b(spark, sf):
    return feat.encode_b(book_b.features(spark, sf)).withColumn("dti_ratio", F.round("dti_ratio", 10))


@register("f4_not_null_feature_filter", """
select count(*) as row_count from features_b where fico_score is not null
""", ("features_b",))
def f4_not_null_feature_filter(spark, sf):
    return book_b.features(spark, sf).where(F.col("fico_score").isNotNull()) \
        .agg(F.count(F.lit(1)).alias("row_count"))


@register("m6_lifetime_pd", f"""
select loan_id, round(pd_12m, {PD9}) as pd_12m, round(pd_lifetime, {PD9}) as pd_lifetime, model_version
from predictions_b
""", ("predictions_b",))
def m6_lifetime_pd(spark, sf):
    p = book_b.predictions(spark, sf)
    return p.select("loan_id", F.round("pd_12m", PD9).alias("pd_12m"),
                    F.round("pd_lifetime", PD9).alias("pd_lifetime"), "model_version")


@register("s16_model_version_default", """
select model_version, count(*) as n from predictions_b group by model_version
""", ("predictions_b",))
def s16_model_version_default(spark, sf):
    return book_b.predictions(spark, sf).groupBy("model_version").agg(F.count(F.lit(1)).alias("n"))


@register("j1_features_predictions_join", f"""
select loan_id, stage, round(pd_12m, {PD9}) as pd_12m, round(ecl, 6) as ecl from staging_b
""", ("staging_b",))
def j1_features_predictions_join(spark, sf):
    st = book_b.staged_by_join(spark, sf)
    return st.select("loan_id", "stage", F.round("pd_12m", PD9).alias("pd_12m"), F.round("ecl", 6).alias("ecl"))


@register("m16_ecl_b", """
select loan_id, stage, round(ecl, 6) as ecl from staging_b
""", ("staging_b",))
def m16_ecl_b(spark, sf):
    st = book_b.staged(spark, sf)
    return st.select("loan_id", "stage", F.round("ecl", 6).alias("ecl"))


@register("r1_stage_distribution_b", f"""
select stage, {STAGE_TEXT} as stage_description, count(*) as loan_count,
       round(cast(count(*) as double) * 100e0 / sum(count(*)) over (), 2) as pct,
       round(sum(ecl), 2) as total_ecl, round(avg(pd_12m), 4) as avg_pd
from staging_b group by stage
""", ("staging_b",))
def r1_stage_distribution_b(spark, sf):
    return reports.stage_distribution(book_b.staged(spark, sf), pd_col="pd_12m", with_description=True)


@register("r2_portfolio_by_stage_b", f"""
select stage, {STAGE_TEXT} as stage_description, count(*) as loan_count,
       round(sum(loan_amount), 2) as total_exposure, round(sum(ecl), 2) as total_ecl,
       round(sum(ecl) / sum(loan_amount) * 100, 2) as ecl_rate_pct, round(avg(pd_12m), 4) as avg_pd
from staging_b group by stage
""", ("staging_b",))
def r2_portfolio_by_stage_b(spark, sf):
    return reports.portfolio_by_stage(book_b.staged(spark, sf), pd_col="pd_12m")


@register("r3_overall_b", """
select count(*) as total_loans, round(sum(loan_amount), 2) as total_exposure, round(sum(ecl), 2) as total_ecl,
       round(sum(ecl) / sum(loan_amount) * 100, 2) as portfolio_ecl_rate_pct,
       round(avg(pd_12m), 4) as portfolio_avg_pd
from staging_b
""", ("staging_b",))
def r3_overall_b(spark, sf):
    return reports.portfolio_overall(book_b.staged(spark, sf), pd_col="pd_12m", count_defaulted=False)


@register("p25_stage_description", f"""
select loan_id, stage, {STAGE_TEXT} as stage_description from staging_b
""", ("staging_b",))
def p25_stage_description(spark, sf):
    st = book_b.staged(spark, sf)
    return st.select("loan_id", "stage", staging.stage_description("stage").alias("stage_description"))
