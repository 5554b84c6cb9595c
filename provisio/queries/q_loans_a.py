"""Registered queries: profile A (features, fixed PD, staging, reports)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import features as feat, reports, staging
from ..plans import book_a
from . import register

# PDs shown raw are rounded to 9 digits: the two engines' exp() may differ
# in the last bit.
PD9 = 9


@register("r2_portfolio_by_stage", """
select stage,
       case stage when 1 then 'Stage 1: Performing'
                  when 2 then 'Stage 2: Significant Increase in Credit Risk'
                  when 3 then 'Stage 3: Defaulted' end as stage_description,
       count(*) as loan_count,
       round(sum(loan_amount), 2) as total_exposure,
       round(sum(ecl), 2) as total_ecl,
       round(sum(ecl) / sum(loan_amount) * 100, 2) as ecl_rate_pct,
       round(avg(pd), 4) as avg_pd
from staging_a group by stage order by stage
""", ("staging_a",))
def r2_portfolio_by_stage(spark, sf):
    return reports.portfolio_by_stage(book_a.staged(spark, sf))


@register("r1_stage_distribution", """
select stage, count(*) as loan_count,
       round(cast(count(*) as double) * 100e0 / sum(count(*)) over (), 2) as pct,
       round(sum(ecl), 2) as total_ecl,
       round(avg(pd), 4) as avg_pd
from staging_a group by stage order by stage
""", ("staging_a",))
def r1_stage_distribution(spark, sf):
    return reports.stage_distribution(book_a.staged(spark, sf))


@register("r3_overall_a", """
select count(*) as total_loans,
       round(sum(loan_amount), 2) as total_exposure,
       round(sum(ecl), 2) as total_ecl,
       round(sum(ecl) / sum(loan_amount) * 100, 2) as portfolio_ecl_rate_pct,
       round(avg(pd), 4) as portfolio_avg_pd,
       cast(sum(case when stage = 3 then 1 else 0 end) as bigint) as defaulted_loans
from staging_a
""", ("staging_a",))
def r3_overall_a(spark, sf):
    return reports.portfolio_overall(book_a.staged(spark, sf))


@register("r4_staging_sample", f"""
select loan_id, loan_amount, round(pd, {PD9}) as pd, stage, round(ecl, 2) as ecl
from staging_a where stage in (1, 2, 3)
order by stage asc nulls first, pd desc nulls last, loan_id limit 10
""", ("staging_a",))
def r4_staging_sample(spark, sf):
    return reports.staging_sample(book_a.staged(spark, sf)).withColumn("pd", F.round("pd", PD9))


@register("r5_top_ecl", f"""
select loan_id, loan_amount, round(pd, {PD9}) as pd, stage, round(ecl, 2) as ecl
from staging_a order by ecl desc nulls last, loan_id limit 10
""", ("staging_a",))
def r5_top_ecl(spark, sf):
    return reports.top_ecl(book_a.staged(spark, sf)).withColumn("pd", F.round("pd", PD9))


@register("m14_ifrs9_stage", """
select loan_id, stage from staging_a
""", ("staging_a",))
def m14_ifrs9_stage(spark, sf):
    sc = book_a.scored(spark, sf)
    return sc.select("loan_id", staging.ifrs9_stage("default_flag", "pd").alias("stage"))


@register("m15_ecl_a", """
select loan_id, stage, round(ecl, 6) as ecl from staging_a
""", ("staging_a",))
def m15_ecl_a(spark, sf):
    st = book_a.staged(spark, sf)
    return st.select("loan_id", "stage", F.round("ecl", 6).alias("ecl"))


@register("m1_pd_loans_fixed", f"""
select loan_id, round(pd, {PD9}) as pd from scored_a
""", ("scored_a",))
def m1_pd_loans_fixed(spark, sf):
    return book_a.scored(spark, sf).select("loan_id", F.round("pd", PD9).alias("pd"))


@register("p7_dti_ratio_a", """
select loan_id, round(total_debt / nullif(income, 0), 4) as dti_ratio from raw_loans
""", ("raw_loans",))
def p7_dti_ratio_a(spark, sf):
    return book_a.features(spark, sf).select("loan_id", "dti_ratio")


@register("p8_loan_to_income", """
select loan_id, round(loan_amount / nullif(income, 0), 4) as loan_to_income_ratio from raw_loans
""", ("raw_loans",))
def p8_loan_to_income(spark, sf):
    return book_a.features(spark, sf).select("loan_id", "loan_to_income_ratio")


@register("p12_fico_category_a", """
select loan_id, fico_score, fico_category from features_a
""", ("features_a",))
def p12_fico_category_a(spark, sf):
    return book_a.raw(spark, sf).select("loan_id", "fico_score",
                                        feat.fico_category_a("fico_score").alias("fico_category"))


@register("p14_loan_size_a", """
select loan_id, loan_size_category from features_a
""", ("features_a",))
def p14_loan_size_a(spark, sf):
    return book_a.raw(spark, sf).select("loan_id", feat.loan_size_a("loan_amount").alias("loan_size_category"))


@register("p18_encode_a", """
select loan_id, dti_ratio,
       case fico_category when 'Poor' then 0 when 'Fair' then 1 when 'Good' then 2 else 3 end as fico_encoded,
       loan_to_income_ratio,
       case loan_size_category when 'Small' then 0 when 'Medium' then 1 else 2 end as loan_size_encoded,
       default_flag
from features_a
""", ("features_a",))
def p18_encode_a(spark, sf):
    return feat.encode_a(book_a.features(spark, sf))


@register("s8_features_a_table", """
select * from features_a
""", ("features_a",))
def s8_features_a_table(spark, sf):
    return book_a.features(spark, sf)


@register("k4_feature_preview", """
select loan_id, dti_ratio, fico_category, loan_to_income_ratio, default_flag
from features_a order by loan_id limit 5
""", ("features_a",))
def k4_feature_preview(spark, sf):
    return reports.feature_preview_a(book_a.features(spark, sf))


@register("a9_portfolio_rollup", """
select case when grouping(stage) = 1 then 'portfolio' else 'stage' end as level,
       stage, count(*) as loan_count,
       round(sum(loan_amount), 2) as total_exposure,
       round(sum(ecl), 2) as total_ecl,
       round(sum(ecl) / sum(loan_amount) * 100, 2) as ecl_rate_pct,
       round(avg(pd), 4) as avg_pd
from staging_a group by rollup (stage)
""", ("staging_a",))
def a9_portfolio_rollup(spark, sf):
    return reports.portfolio_rollup(book_a.staged(spark, sf))
