"""Registered queries: scalar functions, aggregates, sorts and small joins
(C-*, A-1 … A-5, K-1 … K-3, J-2 … J-4, W-4, F-5, P-1)."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from ..functions import scalars as sc, text as tx
from ..operators import explain, reports
from ..operators.ordered import row_number_global
from ..plans import book_a, book_b, sme
from . import register
from .layers import fixed, pct1, pct2, rnd

_REAL = r"^\s*([+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?)"
_INT = r"^\s*([+-]?\d+)"


@register("c1_coalesce", """
select id, coalesce(loan_amnt, 0e0) as loan_amount, coalesce(annual_inc, installment * 12) as income_or_proxy
from raw_landing_zone
""", ("raw_landing_zone",))
def c1_coalesce(spark, sf):
    land = book_b.landing(spark, sf)
    return land.select("id", F.coalesce("loan_amnt", F.lit(0.0)).alias("loan_amount"),
                       F.coalesce(F.col("annual_inc"), F.col("installment") * 12).alias("income_or_proxy"))


@register("c2_nullif", """
select loan_id, round(total_debt / nullif(income, 0), 10) as debt_to_income from raw_loans
""", ("raw_loans",))
def c2_nullif(spark, sf):
    r = book_a.raw(spark, sf)
    return r.select("loan_id", F.round(sc.safe_ratio(F.col("total_debt"), F.col("income")), 10).alias("debt_to_income"))


@register("c3_lenient_cast", f"""
select id,
       case when int_rate is null then null
            else coalesce(try_cast(regexp_extract(int_rate, '{_REAL}', 1) as double), 0e0) end as rate_number,
       case when emp_length is null then null
            else coalesce(try_cast(regexp_extract(emp_length, '{_INT}', 1) as integer), 0) end as emp_number
from raw_landing_zone
""", ("raw_landing_zone",))
def c3_lenient_cast(spark, sf):
    land = book_b.landing(spark, sf)
    return land.select("id", sc.lenient_real("int_rate").alias("rate_number"),
                       sc.lenient_int("emp_length").alias("emp_number"))


@register("c4_ilike", """
select id, term ilike '%36%' as is_36_months, loan_status ilike 'late%' as is_late from raw_landing_zone
""", ("raw_landing_zone",))
def c4_ilike(spark, sf):
    land = book_b.landing(spark, sf)
    return land.select("id", F.col("term").ilike("%36%").alias("is_36_months"),
                       F.col("loan_status").ilike("late%").alias("is_late"))


@register("c5_substr", """
select id, substr(emp_length, 1, 1) as first_char, substr(sub_grade, 2, 1) as grade_step from raw_landing_zone
""", ("raw_landing_zone",))
def c5_substr(spark, sf):
    land = book_b.landing(spark, sf)
    return land.select("id", F.substr("emp_length", F.lit(1), F.lit(1)).alias("first_char"),
                       F.substr("sub_grade", F.lit(2), F.lit(1)).alias("grade_step"))


@register("c6_replace", """
select id, replace(int_rate, '%', '') as rate_text from raw_landing_zone
""", ("raw_landing_zone",))
def c6_replace(spark, sf):
    land = book_b.landing(spark, sf)
    return land.select("id", F.replace("int_rate", F.lit("%"), F.lit("")).alias("rate_text"))


@register("c7_round", """
select loan_id, round(pd * 100, 2) as pd_pct, round(ecl, 4) as ecl_4 from staging_a
""", ("staging_a",))
def c7_round(spark, sf):
    st = book_a.staged(spark, sf)
    return st.select("loan_id", sc.round_half_up(F.col("pd") * 100, 2).alias("pd_pct"),
                     sc.round_half_up(F.col("ecl"), 4).alias("ecl_4"))


@register("c8_case", """
select loan_id,
       case when fico_score < 580 then 'Poor' when fico_score < 670 then 'Fair' when fico_score < 740 then 'Good'
            else 'Excellent' end as searched,
       case default_flag when 1 then 'defaulted' when 0 then 'performing' end as simple_case
from raw_loans
""", ("raw_loans",))
def c8_case(spark, sf):
    from ..operators.features import fico_category_a

    r = book_a.raw(spark, sf)
    simple = F.when(F.col("default_flag") == 1, "defaulted").when(F.col("default_flag") == 0, "performing")
    return r.select("loan_id", fico_category_a("fico_score").alias("searched"), simple.alias("simple_case"))


@register("c9_exp_log_sigmoid", """
select loan_id, round(ln(p / (1e0 - p)), 9) as log_odds, round(1e0 / (1e0 + exp(-ln(p / (1e0 - p)))), 9) as back_to_pd
from (select loan_id, case when pd is null then null else least(greatest(pd, 1e-3), 999e-3) end as p from scored_a) t
""", ("scored_a",))
def c9_exp_log_sigmoid(spark, sf):
    s = book_a.scored(spark, sf).select("loan_id", sc.clip(F.col("pd"), 0.001, 0.999).alias("p"))
    return s.select("loan_id", F.round(sc.logit(F.col("p")), 9).alias("log_odds"),
                    F.round(sc.sigmoid(sc.logit(F.col("p"))), 9).alias("back_to_pd"))


@register("c10_clip", """
select loan_id, round(case when pd is null then null else least(greatest(pd, 1e-3), 999e-3) end, 9) as clipped_pd
from scored_a
""", ("scored_a",))
def c10_clip(spark, sf):
    s = book_a.scored(spark, sf)
    return s.select("loan_id", F.round(sc.clip(F.col("pd"), 0.001, 0.999), 9).alias("clipped_pd"))


@register("c11_abs", """
select company_id, feature, round(abs(contribution), 9) as magnitude from sme_linear_long
""", ("sme_linear_long",))
def c11_abs(spark, sf):
    a = explain.explode_attributions(sme.attributed(spark, sf))
    return a.select("company_id", "feature", F.round(F.abs("contribution"), 9).alias("magnitude"))


@register("c13_fill_constant", """
select id, coalesce(dti, 0e0) as dti, coalesce((fico_range_low + fico_range_high) / 2e0, 680e0) as fico,
       coalesce(emp_length, 'n/a') as emp_length
from raw_landing_zone
""", ("raw_landing_zone",))
def c13_fill_constant(spark, sf):
    land = book_b.landing(spark, sf)
    filled = land.fillna({"dti": 0.0, "emp_length": "n/a"})
    return filled.select("id", "dti", F.coalesce((F.col("fico_range_low") + F.col("fico_range_high")) / 2.0,
                                                 F.lit(680.0)).alias("fico"), "emp_length")


@register("c15_concat_contains", """
select id, 'LOAN_' || cast(id as varchar) as loan_id, contains(loan_status, 'Charged Off') as mentions_charge_off
from raw_landing_zone
""", ("raw_landing_zone",))
def c15_concat_contains(spark, sf):
    land = book_b.landing(spark, sf)
    return land.select("id", F.concat(F.lit("LOAN_"), F.col("id").cast("string")).alias("loan_id"),
                       F.col("loan_status").contains("Charged Off").alias("mentions_charge_off"))


@register("c16_number_formats", f"""
select company_id, {pct1('revenue_growth')} as growth_text, {pct2('predicted_default_prob')} as pd_text,
       {fixed('cash_flow_volatility', 2)} as volatility_text,
       printf('%+.0f%%', {rnd('revenue_growth * 1e2', 0)}) as growth_signed,
       format('{{:,.0f}}', {rnd('cash_flow_volatility * 1e6', 0)}) as volatility_ppm
from sme_scored
""", ("sme_scored",))
def c16_number_formats(spark, sf):
    s = sme.scored(spark, sf)
    return s.select("company_id", tx.fmt_pct1("revenue_growth").alias("growth_text"),
                    tx.fmt_pct2("predicted_default_prob").alias("pd_text"),
                    tx.fmt_fixed("cash_flow_volatility", 2).alias("volatility_text"),
                    tx.fmt_signed_pct0("revenue_growth").alias("growth_signed"),
                    tx.fmt_thousands(F.col("cash_flow_volatility") * 1e6).alias("volatility_ppm"))


@register("c18_template_text", f"""
select company_id,
       case when cash_flow_volatility > 1.5
            then 'High volatility (' || {fixed('cash_flow_volatility', 2)} || 'x) signals instability in operating cash flows.'
            else 'Cash flow volatility (' || {fixed('cash_flow_volatility', 2)} || 'x) is healthy, indicating stable working capital.'
       end as commentary
from sme_scored
""", ("sme_scored",))
def c18_template_text(spark, sf):
    s = sme.scored(spark, sf)
    rule = explain.INSIGHT_RULES[0]
    v = tx.fmt_fixed("cash_flow_volatility", 2)
    text = F.when(F.col("cash_flow_volatility") > rule[2], tx.fill_text(rule[5], v)) \
        .otherwise(tx.fill_text(rule[6], v))
    return s.select("company_id", text.alias("commentary"))


# ------------------------------------------------------------------ aggregates
@register("a1_count_all", """
select count(*) as row_count from staging_a
""", ("staging_a",))
def a1_count_all(spark, sf):
    return book_a.staged(spark, sf).agg(F.count(F.lit(1)).alias("row_count"))


@register("a2_group_by_stage", """
select stage, count(*) as loan_count, round(sum(ecl), 2) as total_ecl, round(avg(pd), 4) as avg_pd
from staging_a group by stage
""", ("staging_a",))
def a2_group_by_stage(spark, sf):
    st = book_a.staged(spark, sf)
    return st.groupBy("stage").agg(F.count(F.lit(1)).alias("loan_count"), F.round(F.sum("ecl"), 2).alias("total_ecl"),
                                   F.round(F.avg("pd"), 4).alias("avg_pd"))


@register("a3_share_of_total", """
select stage, round(cast(count(*) as double) * 100e0 / (select count(*) from staging_a), 2) as pct
from staging_a group by stage
""", ("staging_a",))
def a3_share_of_total(spark, sf):
    return reports.stage_distribution(book_a.staged(spark, sf)).select("stage", "pct")


@register("a4_ratio_of_sums", """
select stage, round(sum(ecl) / sum(loan_amount) * 100, 2) as ecl_rate_pct from staging_a group by stage
""", ("staging_a",))
def a4_ratio_of_sums(spark, sf):
    st = book_a.staged(spark, sf)
    return st.groupBy("stage").agg(
        F.round(F.try_divide(F.sum("ecl"), F.sum("loan_amount")) * 100, 2).alias("ecl_rate_pct"))


@register("a5_conditional_count", """
select cast(sum(case when stage = 3 then 1 else 0 end) as bigint) as defaulted_loans,
       cast(count_if(stage = 2) as bigint) as stage2_loans
from staging_a
""", ("staging_a",))
def a5_conditional_count(spark, sf):
    st = book_a.staged(spark, sf)
    return st.agg(F.sum(F.when(F.col("stage") == 3, 1).otherwise(0)).cast("long").alias("defaulted_loans"),
                  F.count_if(F.col("stage") == 2).alias("stage2_loans"))


@register("j4_scalar_subquery_total", """
select stage, count(*) as loan_count, (select count(*) from staging_a) as total_loans from staging_a group by stage
""", ("staging_a",))
def j4_scalar_subquery_total(spark, sf):
    agg = book_a.staged(spark, sf).groupBy("stage").agg(F.count(F.lit(1)).alias("loan_count"))
    return agg.select("stage", "loan_count", F.sum("loan_count").over(Window.partitionBy()).alias("total_loans"))


@register("f5_stage_in_list", """
select count(*) as n from staging_a where stage in (1, 2, 3)
""", ("staging_a",))
def f5_stage_in_list(spark, sf):
    return book_a.staged(spark, sf).where(F.col("stage").isin(1, 2, 3)).agg(F.count(F.lit(1)).alias("n"))


@register("k1_sort_by_stage", """
select stage, count(*) as loan_count from staging_b group by stage order by stage
""", ("staging_b",))
def k1_sort_by_stage(spark, sf):
    return book_b.staged(spark, sf).groupBy("stage").agg(F.count(F.lit(1)).alias("loan_count")) \
        .orderBy(F.col("stage").asc_nulls_first())


@register("k2_multikey_sort_limit", """
select loan_id, stage, round(pd_12m, 9) as pd_12m from staging_b
order by stage asc nulls first, pd_12m desc nulls last, loan_id limit 10
""", ("staging_b",))
def k2_multikey_sort_limit(spark, sf):
    st = book_b.staged(spark, sf)
    top = st.orderBy(F.col("stage").asc_nulls_first(), F.col("pd_12m").desc_nulls_last(), F.col("loan_id")).limit(10)
    return top.select("loan_id", "stage", F.round("pd_12m", 9).alias("pd_12m"))


@register("k3_top_ecl_b", """
select loan_id, stage, round(ecl, 2) as ecl from staging_b order by ecl desc nulls last, loan_id limit 10
""", ("staging_b",))
def k3_top_ecl_b(spark, sf):
    return reports.top_ecl(book_b.staged(spark, sf), pd_col="pd_12m").select("loan_id", "stage", "ecl")


@register("w4_sequential_row_id", """
select loan_id, row_number() over (order by loan_id) as row_id from raw_loans
""", ("raw_loans",))
def w4_sequential_row_id(spark, sf):
    return row_number_global(book_a.raw(spark, sf).select("loan_id"), ["loan_id"], out="row_id")


@register("p1_project_rename", """
select id as loan_id, annual_inc as annual_income_raw, loan_amnt as loan_amount_raw, grade from raw_landing_zone
""", ("raw_landing_zone",))
def p1_project_rename(spark, sf):
    land = book_b.landing(spark, sf)
    return land.select(F.col("id").alias("loan_id"), F.col("annual_inc").alias("annual_income_raw"),
                       F.col("loan_amnt").alias("loan_amount_raw"), "grade")


@register("j3_split_row_labels", """
select company_id, true_label, rn <= round(2e-1 * n) as is_test from (
  select company_id, true_label,
         row_number() over (partition by true_label order by md5(concat_ws(':', '42', company_id)), company_id) as rn,
         count(*) over (partition by true_label) as n
  from sme_features) t
""", ("sme_features",))
def j3_split_row_labels(spark, sf):
    from ..operators.score import stratified_split

    f = sme.features(spark, sf).select("company_id", "true_label")
    return stratified_split(f, key="company_id", label="true_label")


@register("j2_keyed_scoring", """
select loan_id, is_test, status, status = 'scored' as has_pd from split_a
""", ("split_a",))
def j2_keyed_scoring(spark, sf):
    """Trained model scores carried with their key (no positional zip); a loan
    with an undefined ratio is kept and marked."""
    from ..plans import models

    s = models.scored_by_model_a(spark, sf)
    return s.select("loan_id", "is_test", "status", F.coalesce(F.col("pd").between(0.0, 1.0), F.lit(False)).alias("has_pd"))
