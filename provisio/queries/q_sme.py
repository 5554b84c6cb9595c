"""Registered queries: SME scoring, attributions, factor table, stress grid."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import explain, score, stress
from ..plans import sme
from . import register
from .layers import fixed, pct1, pct2, sme_pd

R9 = 9


@register("m2_pd_sme_fixed", f"""
select company_id, round({sme_pd()}, {R9}) as pd from sme_features
""", ("sme_features",))
def m2_pd_sme_fixed(spark, sf):
    f = sme.features(spark, sf)
    return f.select("company_id", F.round(score.pd_sme_fixed("revenue_growth", "debt_to_asset_ratio",
                                                               "cash_flow_volatility", "past_default"), R9).alias("pd"))


@register("s5_sme_feature_table", """
select * from sme_features
""", ("sme_features",))
def s5_sme_feature_table(spark, sf):
    return sme.features(spark, sf)


@register("p2_drop_columns", """
select * exclude (company_id, true_label) from sme_features
""", ("sme_features",))
def p2_drop_columns(spark, sf):
    return sme.features(spark, sf).drop("company_id", "true_label")


@register("m10_one_hot", """
select company_id, industry_Manufacturing, industry_Retail, industry_Services, industry_Tech from sme_scored
""", ("sme_scored",))
def m10_one_hot(spark, sf):
    oh = score.one_hot(sme.features(spark, sf), "industry", score.SME_INDUSTRIES)
    return oh.select("company_id", *[f"industry_{c}" for c in score.SME_INDUSTRIES])


@register("p27_vip_override", f"""
select company_id, round(predicted_default_prob, {R9}) as predicted_default_prob from sme_scored
""", ("sme_scored",))
def p27_vip_override(spark, sf):
    return sme.scored(spark, sf).select("company_id", F.round("predicted_default_prob", R9).alias("predicted_default_prob"))


@register("f7_member_ids", f"""
select company_id, round(predicted_default_prob, {R9}) as predicted_default_prob from sme_scored
where company_id in ('HK_00000', 'HK_00001', 'HK_00002', 'HK_00003', 'HK_00004', 'HK_00005')
""", ("sme_scored",))
def f7_member_ids(spark, sf):
    m = explain.members(sme.scored(spark, sf), explain.vip_ids(spark))
    return m.select("company_id", F.round("predicted_default_prob", R9).alias("predicted_default_prob"))


@register("f6_entity_lookup", f"""
select printf('HK_%05d', c_custkey) as company_id,
       case when s.company_id is null then 'NOT_FOUND' else 'FOUND' end as lookup_status,
       round(s.predicted_default_prob, {R9}) as predicted_default_prob
from customer c left join sme_scored s on s.company_id = printf('HK_%05d', c.c_custkey)
""", ("sme_scored",))
def f6_entity_lookup(spark, sf):
    from ..sources.fixtures import company_id
    from ..sources.tables import read_table

    req = read_table(spark, sf, "customer").select(company_id(F.col("c_custkey")).alias("company_id"))
    hit = explain.lookup(req, sme.scored(spark, sf).select("company_id", "predicted_default_prob"))
    return hit.select("company_id", "lookup_status", F.round("predicted_default_prob", R9).alias("predicted_default_prob"))


@register("r6_risk_level", """
select company_id, case when predicted_default_prob > 0.2 then 'HIGH RISK' else 'LOW RISK' end as risk_level
from sme_scored
""", ("sme_scored",))
def r6_risk_level(spark, sf):
    return sme.scored(spark, sf).select("company_id", explain.risk_level("predicted_default_prob").alias("risk_level"))


@register("m12_linear_attribution", f"""
select company_id, feature, round(contribution, {R9}) as contribution from sme_linear_long
""", ("sme_linear_long",))
def m12_linear_attribution(spark, sf):
    long = explain.explode_attributions(sme.attributed(spark, sf))
    return long.select("company_id", "feature", F.round("contribution", R9).alias("contribution"))


@register("w3_top3_factors", f"""
select company_id, factor_rank, feature, round(contribution, {R9}) as contribution from sme_top3
""", ("sme_top3",))
def w3_top3_factors(spark, sf):
    a = sme.attributed(spark, sf)
    top = a.select("company_id", F.posexplode(explain.top_by_magnitude("attributions")).alias("_pos", "_a"))
    return top.select("company_id", (F.col("_pos") + 1).alias("factor_rank"), F.col("_a.feature").alias("feature"),
                      F.round("_a.contribution", R9).alias("contribution"))


@register("j6_first_matching_rule", """
select company_id, feature, name as insight, rule_order from sme_factor_match
""", ("sme_factor_match",))
def j6_first_matching_rule(spark, sf):
    ft = sme.factor_tables(spark, sf).select("company_id", F.explode("factors").alias("f"))
    idx = F.array_position(F.array(*[F.lit(r[1]) for r in explain.INSIGHT_RULES]), F.col("f.insight"))
    return ft.select("company_id", F.col("f.feature").alias("feature"), F.col("f.insight").alias("insight"),
                     idx.cast("int").alias("rule_order"))


def _r7_sql() -> str:
    risky = "(case when direction = 'below' then value < threshold else value > threshold end)"
    formatted = f"(case fmt when 'fixed2' then {fixed('value', 2)} when 'pct1' then {pct1('value')} else '' end)"
    return f"""
select company_id, factor_rank, feature, name as insight,
       (case when contribution > 0 then '▲' else '▼' end) || ' ' || {fixed('contribution', 3)} as attribution_text,
       case when contains(feature, 'growth') or contains(feature, 'ratio') then {pct1('value')}
            else {fixed('value', 2)} end as value_text,
       case when {risky} then '⚠️ Risk' else '✅ Safe' end as status,
       case when {risky} then risk_pre || {formatted} || risk_post
            else safe_pre || {formatted} || safe_post end as commentary,
       benchmark
from sme_factor_match
"""


@register("r7_factor_table", _r7_sql(), ("sme_factor_match",))
def r7_factor_table(spark, sf):
    ft = sme.factor_tables(spark, sf).select("company_id", F.explode("factors").alias("f"))
    return ft.select("company_id", "f.factor_rank", "f.feature", "f.insight", "f.attribution_text", "f.value_text",
                     "f.status", "f.commentary", "f.benchmark")


@register("r8_risk_test", """
select l.company_id, l.feature,
       case when (case when r.direction = 'below' then l.value < r.threshold else l.value > r.threshold end)
            then '⚠️ Risk' else '✅ Safe' end as status
from sme_linear_long l join insight_rules r on l.feature = r.key
""", ("sme_linear_long", "insight_rules"))
def r8_risk_test(spark, sf):
    a = sme.attributed(spark, sf)
    keys = [r[0] for r in explain.INSIGHT_RULES]
    ruled = F.filter("attributions", lambda x: x["feature"].isin(*keys))
    rows = a.select("company_id", F.explode(F.transform(ruled, lambda x: explain.factor_row(x))).alias("f"))
    return rows.select("company_id", "f.feature", "f.status")


@register("f9_substring_rule_key", """
select l.company_id, l.feature, r.key
from sme_linear_long l join insight_rules r on contains(l.feature, r.key)
""", ("sme_linear_long", "insight_rules"))
def f9_substring_rule_key(spark, sf):
    a = explain.explode_attributions(sme.attributed(spark, sf))
    keys = [r[0] for r in explain.INSIGHT_RULES]
    matched = a.select("company_id", "feature",
                       F.filter(F.array(*[F.lit(k) for k in keys]), lambda k: F.col("feature").contains(k)).alias("ks"))
    return matched.select("company_id", "feature", F.explode("ks").alias("key"))


@register("k5_largest_signed", f"""
select company_id, chart_pos, feature, round(contribution, {R9}) as contribution from (
  select *, row_number() over (partition by company_id order by contribution desc, feature_pos desc) as rk,
         cast(7 - row_number() over (partition by company_id order by contribution desc, feature_pos desc) as integer)
           as chart_pos
  from sme_linear_long) t
where rk <= 6
""", ("sme_linear_long",))
def k5_largest_signed(spark, sf):
    a = sme.attributed(spark, sf)
    top = a.select("company_id", F.posexplode(explain.largest_signed("attributions")).alias("_pos", "_a"))
    return top.select("company_id", (F.col("_pos") + 1).alias("chart_pos"), F.col("_a.feature").alias("feature"),
                      F.round("_a.contribution", R9).alias("contribution"))


@register("r16_attribution_chart", f"""
select company_id, chart_pos, replace(feature, 'industry_', 'Sector: ') as feature,
       round(contribution, {R9}) as contribution, case when contribution > 0 then '#d32f2f' else '#388e3c' end as colour
from (
  select *, row_number() over (partition by company_id order by contribution desc, feature_pos desc) as rk,
         cast(7 - row_number() over (partition by company_id order by contribution desc, feature_pos desc) as integer)
           as chart_pos
  from sme_linear_long) t
where rk <= 6
""", ("sme_linear_long",))
def r16_attribution_chart(spark, sf):
    a = sme.attributed(spark, sf)
    rows = a.select("company_id", F.posexplode(explain.chart_rows("attributions")).alias("_pos", "_r"))
    return rows.select("company_id", (F.col("_pos") + 1).alias("chart_pos"), F.col("_r.feature").alias("feature"),
                       F.round("_r.contribution", R9).alias("contribution"), F.col("_r.colour").alias("colour"))


@register("p26_display_name", """
select company_id, replace(feature, 'industry_', 'Sector: ') as feature from sme_linear_long
""", ("sme_linear_long",))
def p26_display_name(spark, sf):
    a = explain.explode_attributions(sme.attributed(spark, sf))
    return a.select("company_id", tx.display_feature_name("feature").alias("feature"))


@register("m13_exact_shapley_bg100", f"""
with bg as (
  select revenue_growth as b0, debt_to_asset_ratio as b1, cash_flow_volatility as b2,
         cast(past_default as double) as b3
  from sme_features order by md5(concat_ws(':', '42', company_id)), company_id limit 100),
masks as (select unnest(generate_series(0, 15)) as s),
v as (
  select f.company_id, m.s,
         avg({sme_pd(rg="case when m.s & 1 <> 0 then f.revenue_growth else bg.b0 end",
                     dta="case when m.s & 2 <> 0 then f.debt_to_asset_ratio else bg.b1 end",
                     cfv="case when m.s & 4 <> 0 then f.cash_flow_volatility else bg.b2 end",
                     pdf="case when m.s & 8 <> 0 then cast(f.past_default as double) else bg.b3 end")}) as v
  from sme_features f cross join masks m cross join bg
  group by f.company_id, m.s),
players as (select * from (values (0, 'revenue_growth'), (1, 'debt_to_asset_ratio'), (2, 'cash_flow_volatility'),
                                 (3, 'past_default')) p(j, feature))
select a.company_id, p.feature,
       round(sum(case bit_count(a.s) when 0 then 0.25e0 when 1 then 1e0 / 12e0 when 2 then 1e0 / 12e0
                                     else 0.25e0 end * (b.v - a.v)), {R9}) as contribution,
       100 as background_rows
from v a join players p on (a.s & (1 << p.j)) = 0
join v b on b.company_id = a.company_id and b.s = (a.s | (1 << p.j))
group by a.company_id, p.feature
""", ("sme_features",))
def m13_exact_shapley_bg100(spark, sf):
    """Exact Shapley values against 100 background companies."""
    sh = explain.shapley_against_sample(sme.features(spark, sf), 100)
    long = sh.select("company_id", "background_rows", F.explode("shapley").alias("s"))
    return long.select("company_id", F.col("s.feature").alias("feature"),
                       F.round("s.contribution", R9).alias("contribution"), "background_rows")


# ------------------------------------------------------------------ stress
@register("j8_scenario_grid", """
select company_id, shock_rev, shock_vol from sme_grid
""", ("sme_grid",))
def j8_scenario_grid(spark, sf):
    return stress.scenario_grid(sme.scored(spark, sf).select("company_id"))


@register("m17_stressed_pd", f"""
select company_id, shock_rev, shock_vol, round(stressed_pd, {R9}) as stressed_pd from sme_stress
""", ("sme_stress",))
def m17_stressed_pd(spark, sf):
    s = sme.stressed(spark, sf)
    return s.select("company_id", "shock_rev", "shock_vol", F.round("stressed_pd", R9).alias("stressed_pd"))


@register("m18_stressed_metrics", f"""
select company_id, shock_rev, shock_vol, round(stressed_growth, {R9}) as stressed_growth,
       round(stressed_volatility, {R9}) as stressed_volatility
from sme_stress
""", ("sme_stress",))
def m18_stressed_metrics(spark, sf):
    s = sme.stressed(spark, sf)
    return s.select("company_id", "shock_rev", "shock_vol", F.round("stressed_growth", R9).alias("stressed_growth"),
                    F.round("stressed_volatility", R9).alias("stressed_volatility"))


# The texts in the two functions below are fixed values: findings, verdicts, memo lines.
def _findings_sql() -> str:
    parts = [f"case when stressed_growth < 0 then 'Revenue is contracting (' || {pct1('stressed_growth')} || ').' end",
             f"case when debt_to_asset_ratio > 0.6 then 'Leverage is critically high (' || {pct1('debt_to_asset_ratio')} || ').' end",
             f"case when stressed_volatility > 1.5 then 'Cash flow is highly volatile (' || {fixed('stressed_volatility', 2)} || 'x).' end",
             "case when past_default > 0.5 then 'History of default detected.' end"]
    n = " + ".join(f"(case when ({p}) is null then 0 else 1 end)" for p in parts)
    joined = "concat_ws(' ', " + ", ".join(parts) + ")"
    return f"""
select company_id, shock_rev, shock_vol, n_findings,
       case when n_findings > 0 then '⚠️ Critical Risk Factor(s)' else '✅ Stability Assessment' end as verdict_title,
       case when n_findings > 0 then found || ' These factors significantly elevate the Probability of Default under stress.'
            else 'All key risk metrics are within healthy ranges. The company demonstrates strong resilience against stress scenarios.'
       end as verdict_text
from (select *, {n} as n_findings, {joined} as found from sme_stress) t
"""


@register("r10_stress_findings", _findings_sql(), ("sme_stress",))
def r10_stress_findings(spark, sf):
    s = sme.stressed(spark, sf)
    return s.select("company_id", "shock_rev", "shock_vol", "n_findings", "verdict_title", "verdict_text")


@register("r11_recommendation", """
select company_id, shock_rev, shock_vol,
       case when stressed_pd > 0.2 then 'REJECT / WATCHLIST' else 'APPROVE' end as recommendation
from sme_stress
""", ("sme_stress",))
def r11_recommendation(spark, sf):
    return sme.stressed(spark, sf).select("company_id", "shock_rev", "shock_vol", "recommendation")


@register("r12_pd_band", """
select company_id, shock_rev, shock_vol,
       case when stressed_pd * 100 < 5 then '0-5%' when stressed_pd * 100 < 20 then '5-20%' else '20-100%' end as pd_band
from sme_stress
""", ("sme_stress",))
def r12_pd_band(spark, sf):
    return sme.stressed(spark, sf).select("company_id", "shock_rev", "shock_vol", "pd_band")


@register("r13_base_vs_stressed", f"""
select company_id, shock_rev, shock_vol, round(base_pd, {R9}) as base_pd, round(stressed_pd, {R9}) as stressed_pd,
       round(stressed_pd - base_pd, {R9}) + 0e0 as pd_change
from sme_stress
""", ("sme_stress",))
def r13_base_vs_stressed(spark, sf):
    s = sme.stressed(spark, sf)
    return s.select("company_id", "shock_rev", "shock_vol", F.round("base_pd", R9).alias("base_pd"),
                    F.round("stressed_pd", R9).alias("stressed_pd"), F.round("pd_change", R9).alias("pd_change"))


def _memo_sql() -> str:
    stressed = ("1e0 / (1e0 + exp(-(ln(b / (1e0 - b)) + ((0e0 * -5e0) + ((1e0 - 1e0) * 1.5e0)))))")
    return f"""
with f as (
  select company_id, factor_rank,
         concat_ws(' | ', insight, attribution_text, concat_ws(' ', value_text, status), commentary) as line
  from ({_r7_sql()}) r),
l as (select company_id, string_agg(line, chr(10) order by factor_rank) as body from f group by company_id),
s as (select company_id, predicted_default_prob as pd,
             case when predicted_default_prob is null then null
                  else least(greatest(predicted_default_prob, 1e-3), 999e-3) end as b
      from sme_scored),
t as (select *, {stressed} as new_pd from s)
select t.company_id,
       concat_ws(chr(10),
         'CREDIT RISK ASSESSMENT: ' || coalesce(fa.name, t.company_id),
         'DATE: ' || strftime(a.as_of, '%Y-%m-%d') || ' | SOURCE: '
           || case when fa.is_real then 'HKEX API' else 'Internal Sim' end,
         'EXECUTIVE SUMMARY: ' || case when t.pd > 0.2 then 'HIGH RISK' else 'LOW RISK' end,
         'Model Prediction (PD): ' || {pct2('t.pd')},
         'Risk Factor | AI Attribution | Metric Analysis | Commentary',
         coalesce(l.body, ''),
         'AI Suggestion: Validate flagged metrics against audited financial statements.',
         'STRESS TEST ADDENDUM: Under simulated macro-economic stress (Revenue +0%, Volatility 1.0x), '
           || 'the Probability of Default (PD) shifts from ' || {pct1('t.b')} || ' to ' || {pct1('t.new_pd')} || '.',
         'FINAL RECOMMENDATION: ' || case when t.new_pd > 0.2 then 'REJECT / WATCHLIST' else 'APPROVE' end) as memo
from t left join l on l.company_id = t.company_id
left join financials_all fa on fa.company_id = t.company_id
cross join as_of a
"""


def _report_day(spark, sf) -> str:
    from ..plans import market as pm

    return spark.range(1).select(F.date_format(pm.as_of_day(spark, sf), "yyyy-MM-dd")).first()[0]


@register("r9_credit_memo", _memo_sql(), ("sme_factor_match", "sme_scored", "financials_all", "as_of"))
def r9_credit_memo(spark, sf):
    return sme.memos(spark, sf, as_of=_report_day(spark, sf))


@register("s17_memo_sink", _memo_sql(), ("sme_factor_match", "sme_scored", "financials_all", "as_of"))
def s17_memo_sink(spark, sf):
    """One plain-text memo per company written to the shared folder,
    partitioned by a hash bucket of the company id, then read back."""
    from ..session import scratch_path

    path = scratch_path(spark, "credit_memos")
    memos = sme.memos(spark, sf, as_of=_report_day(spark, sf))
    memos.withColumn("bucket", F.pmod(F.xxhash64("company_id"), F.lit(64))) \
        .write.mode("overwrite").partitionBy("bucket").parquet(path)
    return spark.read.parquet(path).select("company_id", "memo")


@register("s5_literal_rule_frame", """
select l.company_id, l.feature, r.name as insight, r.threshold, r.benchmark
from sme_linear_long l join insight_rules r on l.feature = r.key
""", ("sme_linear_long", "insight_rules"))
def s5_literal_rule_frame(spark, sf):
    """A literal dimension frame (4 rules, broadcast) joined to every company's attributions."""
    rules = explain.insight_rules_frame(spark)
    long = explain.explode_attributions(sme.attributed(spark, sf))
    j = long.join(F.broadcast(rules), long.feature == rules.key, "inner")
    return j.select("company_id", "feature", F.col("name").alias("insight"), "threshold", "benchmark")
