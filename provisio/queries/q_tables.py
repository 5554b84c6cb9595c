"""Registered queries: sources, sinks, catalog and checks (S-*), loader A."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import checks, clean, features as feat, reports
from ..plans import book_a, book_b
from ..session import scratch_path
from ..sources import tables
from . import register
from .layers import STATUS_FLAG


def _loaded_a(spark, sf):
    return clean.loader_a(book_b.landing(spark, sf))


@register("s13_load_profile", """
select count(*) as row_count, avg(default_flag) as default_rate, round(avg(fico_score), 6) as avg_fico,
       round(avg(income), 6) as avg_income, round(avg(loan_amount), 6) as avg_loan_amount
from loaded_a
""", ("loaded_a",))
def s13_load_profile(spark, sf):
    p = reports.load_profile(_loaded_a(spark, sf))
    return p.select("row_count", "default_rate", *[F.round(c, 6).alias(c) for c in ("avg_fico", "avg_income",
                                                                                     "avg_loan_amount")])


@register("a7_default_rate", """
select round(avg(default_flag), 12) as default_rate from raw_loans
""", ("raw_loans",))
def a7_default_rate(spark, sf):
    return book_a.raw(spark, sf).agg(F.round(F.avg("default_flag"), 12).alias("default_rate"))


@register("a6_pd_min_max_mean", """
select round(min(pd), 9) as min_pd, round(max(pd), 9) as max_pd, round(avg(pd), 9) as avg_pd from scored_a
""", ("scored_a",))
def a6_pd_min_max_mean(spark, sf):
    s = reports.pd_summary(book_a.scored(spark, sf))
    return s.select(*[F.round(c, 9).alias(c) for c in s.columns])


@register("a8_exact_median", """
select median(annual_inc) as median_income, median(loan_amnt) as median_amount from raw_landing_zone
""", ("raw_landing_zone",))
def a8_exact_median(spark, sf):
    from ..operators.quantiles import medians

    slim = spark.read.parquet(tables.land(book_b.landing(spark, sf).select("annual_inc", "loan_amnt"), name="medians"))
    found = medians(slim, ["annual_inc", "loan_amnt"])
    return spark.range(1).select(F.lit(found["annual_inc"]).cast("double").alias("median_income"), F.lit(found["loan_amnt"]).cast("double").alias("median_amount"))


@register("a8_approximate_median", """
select true as income_close, true as amount_close
""")
def a8_approximate_median(spark, sf):
    """The sketch option: its answer's rank is within the stated error of the middle."""
    from ..operators.quantiles import medians

    slim = spark.read.parquet(tables.land(book_b.landing(spark, sf).select("annual_inc", "loan_amnt"), name="medians"))
    found = medians(slim, ["annual_inc", "loan_amnt"], approximate=1000)
    close = lambda c: F.abs(F.count_if(F.col(c) <= found[c]) / F.count(c) - 0.5) <= F.greatest(
        F.lit(0.002), F.count_if(F.col(c) == found[c]) / F.count(c))
    return slim.agg(close("annual_inc").alias("income_close"), close("loan_amnt").alias("amount_close"))


@register("c14_median_fill", """
select loan_id, income, round(total_debt, 6) as total_debt, loan_amount from loaded_a
""", ("loaded_a",))
def c14_median_fill(spark, sf):
    return _loaded_a(spark, sf).select("loan_id", "income", F.round("total_debt", 6).alias("total_debt"), "loan_amount")


@register("f3_quality_filter_a", """
select loan_id, fico_score from loaded_a
""", ("loaded_a",))
def f3_quality_filter_a(spark, sf):
    return _loaded_a(spark, sf).select("loan_id", "fico_score")


@register("p21_status_default_map", f"""
select id, loan_status, coalesce({STATUS_FLAG}, 0) as default_flag from raw_landing_zone
""", ("raw_landing_zone",))
def p21_status_default_map(spark, sf):
    land = book_b.landing(spark, sf)
    m = clean._literal_map(clean.STATUS_DEFAULT_MAP)
    return land.select("id", "loan_status", F.coalesce(m[F.col("loan_status")], F.lit(0)).alias("default_flag"))


@register("p10_fico_midpoint_a", """
select 'LOAN_' || cast(id as varchar) as loan_id,
       cast(floor(coalesce((fico_range_low + fico_range_high) / 2e0, 680e0)) as integer) as fico_score
from raw_landing_zone
""", ("raw_landing_zone",))
def p10_fico_midpoint_a(spark, sf):
    land = book_b.landing(spark, sf)
    fico = F.coalesce((F.col("fico_range_low") + F.col("fico_range_high")) / 2, F.lit(680.0))
    return land.select(F.concat(F.lit("LOAN_"), F.col("id").cast("string")).alias("loan_id"),
                       F.floor(fico).cast("int").alias("fico_score"))


@register("p11_fico_from_grade", """
select loan_id, fico_score from (
  select 'LOAN_' || cast(id as varchar) as loan_id,
         coalesce(case grade when 'A' then 750 when 'B' then 700 when 'C' then 650 when 'D' then 600
                  when 'E' then 550 when 'F' then 500 when 'G' then 450 end, 680) as fico_score,
         coalesce(annual_inc, (select median(annual_inc) from raw_landing_zone)) as income,
         coalesce(loan_amnt, (select median(loan_amnt) from raw_landing_zone)) as loan_amount
  from raw_landing_zone) t
where income > 0 and loan_amount > 0
""", ("raw_landing_zone",))
def p11_fico_from_grade(spark, sf):
    land = book_b.landing(spark, sf).drop("fico_range_low", "fico_range_high")
    return clean.loader_a(land).select("loan_id", "fico_score")


@register("p23_total_debt_estimate", """
select loan_id, round(total_debt, 6) as total_debt from (
  select 'LOAN_' || cast(id as varchar) as loan_id,
         coalesce(installment * 1.5e0 * 12, (select median(installment * 1.5e0 * 12) from raw_landing_zone)) as total_debt,
         coalesce(annual_inc, (select median(annual_inc) from raw_landing_zone)) as income,
         coalesce(loan_amnt, (select median(loan_amnt) from raw_landing_zone)) as loan_amount,
         coalesce((fico_range_low + fico_range_high) / 2e0, 680e0) as fico
  from raw_landing_zone) t
where income > 0 and loan_amount > 0 and fico >= 300 and fico <= 850
""", ("raw_landing_zone",))
def p23_total_debt_estimate(spark, sf):
    land = book_b.landing(spark, sf).drop("dti")
    return clean.loader_a(land).select("loan_id", F.round("total_debt", 6).alias("total_debt"))


@register("p22_loan_ids", """
select printf('LOAN_%06d', o_orderkey + 1) as padded_id, 'LOAN_' || cast(o_orderkey as varchar) as plain_id,
       printf('HK_%05d', o_custkey) as company_id
from orders
""")
def p22_loan_ids(spark, sf):
    from ..functions.text import padded_id

    o = tables.read_table(spark, sf, "orders")
    return o.select(padded_id("LOAN_", F.col("o_orderkey") + 1, 6).alias("padded_id"),
                    F.concat(F.lit("LOAN_"), F.col("o_orderkey").cast("string")).alias("plain_id"),
                    padded_id("HK_", "o_custkey", 5).alias("company_id"))


@register("s3_seeded_sample", """
select id from raw_landing_zone order by md5(concat_ws(':', '42', cast(id as varchar))), id limit 1000
""", ("raw_landing_zone",))
def s3_seeded_sample(spark, sf):
    return tables.sample_n(book_b.landing(spark, sf), "id", 1000, seed=42).select("id")


@register("s2_first_chunk", """
select * from raw_landing_zone order by id limit 50000
""", ("raw_landing_zone",))
def s2_first_chunk(spark, sf):
    return tables.head_n(book_b.landing(spark, sf), "id", 50000)


@register("s2_first_chunk_700", """
select * from raw_landing_zone order by id limit 700
""", ("raw_landing_zone",))
def s2_first_chunk_700(spark, sf):
    return tables.head_n(book_b.landing(spark, sf), "id", 700)


@register("s2_first_chunk_null_keys", """
select annual_inc, id from raw_landing_zone order by annual_inc nulls first, id limit 900
""", ("raw_landing_zone",))
def s2_first_chunk_null_keys(spark, sf):
    """A key with NULLs and ties as the leading order column."""
    return tables.head_n(book_b.landing(spark, sf).select("annual_inc", "id"), ["annual_inc", "id"], 900)


@register("k6_first_rows_preview", """
select * from loaded_a order by loan_id limit 5
""", ("loaded_a",))
def k6_first_rows_preview(spark, sf):
    return _loaded_a(spark, sf).orderBy("loan_id").limit(5)     # a preview: a top-k, not a chunk


@register("c12_truncating_cast", """
select loan_id, cast(trunc(loan_amount) as bigint) as whole_amount, cast(trunc(-loan_amount) as bigint) as neg_whole
from raw_loans
""", ("raw_loans",))
def c12_truncating_cast(spark, sf):
    r = book_a.raw(spark, sf)
    return r.select("loan_id", F.col("loan_amount").cast("long").alias("whole_amount"),
                    (-F.col("loan_amount")).cast("long").alias("neg_whole"))


@register("s4_parquet_scan", """
select 'orders' as table_name, count(*) as row_count, round(sum(o_totalprice), 2) as checksum from orders
union all select 'customer', count(*), round(sum(c_acctbal), 2) from customer
union all select 'events', count(*), round(sum(value), 2) from events
""")
def s4_parquet_scan(spark, sf):
    parts = []
    for name, col in (("orders", "o_totalprice"), ("customer", "c_acctbal"), ("events", "value")):
        t = tables.read_table(spark, sf, name)
        parts.append(t.agg(F.count(F.lit(1)).alias("row_count"), F.round(F.sum(col), 2).alias("checksum"))
                     .select(F.lit(name).alias("table_name"), "row_count", "checksum"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@register("s6_landing_dump", """
select * from raw_landing_zone
""", ("raw_landing_zone",))
def s6_landing_dump(spark, sf):
    path = tables.land(book_b.landing(spark, sf), name="raw_landing_zone")
    return spark.read.parquet(path)


@register("s7_overwrite_load", """
select loan_id, round(pd_12m, 9) as pd_12m, round(pd_lifetime, 9) as pd_lifetime, model_version from predictions_b
""", ("predictions_b",))
def s7_overwrite_load(spark, sf):
    path = scratch_path(spark, "loan_predictions")
    preds = book_b.predictions(spark, sf)
    tables.land(preds.limit(0), path)            # an earlier version of the table …
    tables.land(preds, path)                     # … replaced by the overwrite load
    back = spark.read.parquet(path)
    return back.select("loan_id", F.round("pd_12m", 9).alias("pd_12m"), F.round("pd_lifetime", 9).alias("pd_lifetime"),
                       "model_version")


@register("s8_ctas_features_a", """
select * from features_a
""", ("features_a",))
def s8_ctas_features_a(spark, sf):
    path = tables.land(book_a.features(spark, sf), name="model_features")
    return spark.read.parquet(path)


@register("s10_idempotent_rebuild", """
select count(*) as row_count from clean_loans_b
""", ("clean_loans_b",))
def s10_idempotent_rebuild(spark, sf):
    path = scratch_path(spark, "clean_loans")
    for _ in range(2):                            # running the build twice gives the same table
        tables.land(book_b.cleaned(spark, sf), path)
    return spark.read.parquet(path).agg(F.count(F.lit(1)).alias("row_count"))


@register("s11_catalog_check", """
select 'clean_loans' as layer, true as present, count(*) as row_count from clean_loans_b
union all select 'model_features', true, count(*) from features_b
union all select 'raw_landing_zone', false, null
""", ("clean_loans_b", "features_b"))
def s11_catalog_check(spark, sf):
    # views under names of this run; nothing that was there before is touched
    run = uuid.uuid4().hex[:12]
    tables.materialise_view(book_b.cleaned(spark, sf), f"clean_loans_{run}")
    tables.materialise_view(book_b.features(spark, sf), f"model_features_{run}")
    found = tables.layer_objects(spark, [f"{n}_{run}" for n in ("clean_loans", "model_features", "raw_landing_zone")])
    return found.select(F.regexp_replace("name", f"_{run}$", "").alias("layer"), "present", "row_count")


@register("s12_layer_row_counts", """
select 'raw_loans' as layer, count(*) as row_count from raw_loans
union all select 'model_features', count(*) from features_a
union all select 'loan_predictions', count(*) from scored_a
union all select 'loan_staging', count(*) from staging_a
""", ("staging_a",))
def s12_layer_row_counts(spark, sf):
    return reports.layer_counts({"raw_loans": book_a.raw(spark, sf), "model_features": book_a.features(spark, sf),
                                 "loan_predictions": book_a.scored(spark, sf), "loan_staging": book_a.staged(spark, sf)})


@register("s14_layer_schema", """
select u.col as column, u.typ as expected, u.typ as actual, true as ok, u.filled from (
  select unnest([{'col': 'loan_id', 'typ': 'string', 'filled': count(loan_id)},
                 {'col': 'loan_amount', 'typ': 'double', 'filled': count(loan_amount)},
                 {'col': 'default_flag', 'typ': 'int', 'filled': count(default_flag)},
                 {'col': 'pd', 'typ': 'double', 'filled': count(pd)},
                 {'col': 'stage', 'typ': 'int', 'filled': count(stage)},
                 {'col': 'ecl', 'typ': 'double', 'filled': count(ecl)}]) as u
  from staging_a) t
""", ("staging_a",))
def s14_layer_schema(spark, sf):
    from ..schemas import LOAN_STAGING_A, schema_report

    return schema_report(book_a.staged(spark, sf), LOAN_STAGING_A)


@register("s15_key_violations", """
select 'raw_landing_zone.sub_grade' as key_name, count(*) as duplicate_keys, coalesce(max(n), 0) as max_multiplicity
from (select sub_grade, count(*) as n from raw_landing_zone group by sub_grade having count(*) > 1) t
union all
select 'raw_loans.loan_id', count(*), coalesce(max(n), 0)
from (select loan_id, count(*) as n from raw_loans group by loan_id having count(*) > 1) t
""", ("raw_landing_zone", "raw_loans"))
def s15_key_violations(spark, sf):
    a = checks.key_violation_summary(book_b.landing(spark, sf), ["sub_grade"], "raw_landing_zone.sub_grade")
    b = checks.key_violation_summary(book_a.raw(spark, sf), ["loan_id"], "raw_loans.loan_id")
    return a.unionByName(b)


@register("s1_csv_scan", """
select * from raw_landing_zone
""", ("raw_landing_zone",))
def s1_csv_scan(spark, sf):
    from ..schemas import LANDING_CSV

    path = scratch_path(spark, "landing_csv")
    tables.write_csv(book_b.landing(spark, sf), path)
    return tables.read_loans_csv(spark, path, LANDING_CSV)


@register("j9_bins_range_join", """
select loan_id, case when fico_score < 580 then 'Poor' when fico_score < 670 then 'Fair'
                     when fico_score < 740 then 'Good' else 'Excellent' end as fico_category
from raw_loans
""", ("raw_loans",))
def j9_bins_range_join(spark, sf):
    bins = feat.bins_table(spark, feat.A_FICO_BINS, name="fico_a", otherwise=feat.A_FICO_TOP, op="<")
    return feat.bin_by_range_join(book_a.raw(spark, sf).select("loan_id", "fico_score"), "fico_score", bins,
                                  out="fico_category", null_label=feat.A_FICO_TOP).select("loan_id", "fico_category")


@register("j9_sorted_merge", """
select l_orderkey, l_linenumber, l_extendedprice, b.label as price_band
from lineitem left join (select distinct floor(o_totalprice * 4) / 4 as lo, 'band ' || cast(cast(floor(o_totalprice * 4) as bigint) as varchar) as label
                         from orders) b on b.lo = floor(l_extendedprice * 4) / 4
""")
def j9_sorted_merge(spark, sf):
    """J-9 with bins from the data: a quarter-wide band for every order price
    (gaps between them), as many bins as there are distinct prices."""
    quarter = F.floor(F.col("o_totalprice") * 4)
    bins = tables.read_table(spark, sf, "orders").select(
        F.concat(F.lit("band "), quarter.cast("string")).alias("label"), (quarter / 4).alias("lo"), ((quarter + 1) / 4).alias("hi")).distinct()
    prices = tables.read_table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return feat.bin_by_sorted_merge(prices, "l_extendedprice", bins, out="price_band", null_label="none")


@register("j6_rules_table", """
select p_partkey, p_name, (select min(rule_order) from (select substr(p_name, 3, 5) as key, p_partkey as rule_order from part where p_partkey % 3 = 0) r
                           where contains(p.p_name, r.key)) as rule_order
from part p
""")
def j6_rules_table(spark, sf):
    """J-6 with rules as data: a third of all part names give a key each; every
    name takes the first rule whose key it contains."""
    from ..operators.rule_match import first_rule

    part = tables.read_table(spark, sf, "part").select("p_partkey", "p_name")
    rules = part.where(F.col("p_partkey") % 3 == 0).select(F.substring("p_name", 3, 5).alias("key"), F.col("p_partkey").alias("rule_order"))
    return first_rule(part, "p_name", rules)
