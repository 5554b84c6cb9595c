"""Registered queries: split, evaluation, trained models."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from ..operators import evaluate, features as feat, score
from ..plans import models
from . import register

R12 = 12


@register("m3_stratified_split", """
select loan_id, default_flag, is_test from split_b
""", ("split_b",))
def m3_stratified_split(spark, sf):
    return models.split_b(spark, sf).select("loan_id", "default_flag", "is_test")


@register("m7_auc", f"""
with g as (select s, sum(y) as p, count(*) - sum(y) as n from test_b where s is not null group by s),
c as (select *, sum(n) over (order by s rows between unbounded preceding and current row) - n as n_below from g)
select round(sum(p * (n_below + n * 0.5e0)) / (sum(p) * sum(n)), {R12}) as auc from c
""", ("test_b",))
def m7_auc(spark, sf):
    return evaluate.auc(models.evaluation_b(spark, sf), "s", "y").select(F.round("auc", R12).alias("auc"))


@register("m8_confusion_counts", """
select y as label, yhat as prediction, count(*) as n from test_b group by 1, 2
""", ("test_b",))
def m8_confusion_counts(spark, sf):
    return evaluate.confusion_counts(models.evaluation_b(spark, sf), "y", "yhat")


@register("m9_classification_report", f"""
with c as (select cast(count_if(y = 1 and yhat = 1) as bigint) as tp, cast(count_if(y = 0 and yhat = 1) as bigint) as fp,
                  cast(count_if(y = 1 and yhat = 0) as bigint) as fn, cast(count_if(y = 0 and yhat = 0) as bigint) as tn
           from test_b),
m as (select *,
        coalesce(tp::double / nullif(tp + fp, 0), 0) as p1, coalesce(tp::double / nullif(tp + fn, 0), 0) as r1,
        coalesce(tn::double / nullif(tn + fn, 0), 0) as p0, coalesce(tn::double / nullif(tn + fp, 0), 0) as r0,
        tp + fn as s1, tn + fp as s0 from c),
f as (select *, coalesce(2 * p1 * r1 / nullif(p1 + r1, 0), 0) as f1, coalesce(2 * p0 * r0 / nullif(p0 + r0, 0), 0) as f0,
             s0 + s1 as n from m)
select 'No Default' as class, round(p0, {R12}) as precision, round(r0, {R12}) as recall, round(f0, {R12}) as f1_score, s0 as support from f
union all select 'Default', round(p1, {R12}), round(r1, {R12}), round(f1, {R12}), s1 from f
union all select 'accuracy', null, null, round(coalesce((tp + tn)::double / nullif(n, 0), 0), {R12}), n from f
union all select 'macro avg', round((p0 + p1) / 2, {R12}), round((r0 + r1) / 2, {R12}), round((f0 + f1) / 2, {R12}), n from f
union all select 'weighted avg', round(coalesce((p0 * s0 + p1 * s1) / nullif(n, 0), 0), {R12}),
                 round(coalesce((r0 * s0 + r1 * s1) / nullif(n, 0), 0), {R12}),
                 round(coalesce((f0 * s0 + f1 * s1) / nullif(n, 0), 0), {R12}), n from f
""", ("test_b",))
def m9_classification_report(spark, sf):
    r = evaluate.classification_report(models.evaluation_b(spark, sf), "y", "yhat")
    return r.select("class", *[F.round(c, R12).alias(c) for c in ("precision", "recall", "f1_score")], "support")


# Trained models: coefficients differ between libraries, so each query returns
# facts that hold for any correct fit, next to keys and labels.
GRADIENT_TOLERANCE = 1e-4     # of the objective's gradient, relative to the input's mean size


@register("m4_logistic_fit", """
select unnest(['intercept', 'dti_ratio', 'credit_bucket_encoded', 'loan_size_encoded', 'income_category_encoded']) as feature,
       true as stationary, count(*) as n_train
from split_b where not is_test
""", ("split_b",))
def m4_logistic_fit(spark, sf):
    """At the fitted coefficients the objective's gradient is zero."""
    model, split = models.logistic_b(spark, sf)
    train = split.where(~F.col("is_test"))
    g = score.objective_gradient(model, train, feat.B_MODEL_FEATURES, "default_flag")
    return g.select("feature", (F.abs("gradient") <= GRADIENT_TOLERANCE * F.col("input_size")).alias("stationary"),
                    F.lit(train.count()).cast("long").alias("n_train"))


def _in_range(pd: str):
    return F.coalesce(F.col(pd).between(0.0, 1.0), F.lit(False))


@register("m5_score_all_trained", """
select loan_id, default_flag, is_test, 'scored' as status, true as pd_in_range from split_b
""", ("split_b",))
def m5_score_all_trained(spark, sf):
    s = models.scored_by_model_b(spark, sf)
    return s.select("loan_id", "default_flag", "is_test", "status", _in_range("pd_12m").alias("pd_in_range"))


@register("m11_gbt_scores", """
select company_id, true_label, is_test, true as pd_in_range from split_sme
""", ("split_sme",))
def m11_gbt_scores(spark, sf):
    model, split = models.gbt_sme(spark, sf)
    scored = score.score_with_model(model, split, score.SME_MODEL_FEATURES, out="predicted_default_prob")
    return scored.select("company_id", "true_label", "is_test", _in_range("predicted_default_prob").alias("pd_in_range"))


@register("m7_auc_trained", """
select count(*) as n_test, cast(sum(y) as bigint) as n_default, true as agrees, true as in_range from test_b
""", ("test_b",))
def m7_auc_trained(spark, sf):
    """The rank form of the AUC agrees with Spark ML's area under the curve."""
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    s = models.evaluation_by_model_b(spark, sf)
    area = BinaryClassificationEvaluator(rawPredictionCol="s", labelCol="y", metricName="areaUnderROC", numBins=0).evaluate(
        s.withColumn("y", F.col("y").cast("double")))
    auc = evaluate.auc(s, "s", "y").select(F.col("auc").alias("auc"))
    counts = s.agg(F.count(F.lit(1)).alias("n_test"), F.sum("y").alias("n_default"))
    both = counts.withColumn("auc", F.lit(None).cast("double")).unionByName(
        auc.select(F.lit(None).cast("long").alias("n_test"), F.lit(None).cast("long").alias("n_default"), "auc"))
    one = both.agg(F.max("n_test").alias("n_test"), F.max("n_default").alias("n_default"), F.max("auc").alias("auc"))
    return one.select("n_test", "n_default", (F.abs(F.col("auc") - F.lit(float(area))) < 1e-9).alias("agrees"),
                      F.col("auc").between(0.0, 1.0).alias("in_range"))


@register("m8_confusion_trained", """
select y as label, count(*) as n from test_b group by 1
""", ("test_b",))
def m8_confusion_trained(spark, sf):
    """The trained model's confusion cells add up to the test rows of each label."""
    cells = evaluate.confusion_counts(models.evaluation_by_model_b(spark, sf), "y", "yhat")
    return cells.groupBy("label").agg(F.sum("n").alias("n"))


@register("m9_report_trained", """
select 'No Default' as class, count(*) as support, true as in_range from test_b where y = 0
union all select 'Default', count(*), true from test_b where y = 1
union all select unnest(['accuracy', 'macro avg', 'weighted avg']), count(*), true from test_b
""", ("test_b",))
def m9_report_trained(spark, sf):
    r = evaluate.classification_report(models.evaluation_by_model_b(spark, sf), "y", "yhat")
    fine = F.lit(True)
    for c in ("precision", "recall", "f1_score"):
        fine = fine & F.coalesce(F.col(c), F.lit(0.0)).between(0.0, 1.0)
    return r.select("class", "support", fine.alias("in_range"))


def _staging_facts(st, pd: str, pd_stage2: str):
    """Stage and ECL recomputed from the written PDs by the rules' own text."""
    stage = F.expr(f"case when default_flag = 1 then 3 when {pd} >= 0.02 then 2 else 1 end")
    loss = F.expr(f"case when default_flag = 1 then loan_amount * 0.45d when {pd} >= 0.02 then loan_amount * {pd_stage2} * 0.45d "
                  f"else loan_amount * {pd} * 0.45d * 0.5d end")
    return ((F.col("stage") == stage).alias("stage_ok"),
            (F.col("ecl").eqNullSafe(loss) | (F.abs(F.col("ecl") - loss) <= 1e-9 * F.abs(loss))).alias("ecl_ok"))


@register("flow_a_trained_staging", """
select loan_id, default_flag, status, is_test, status = 'scored' as has_pd, true as stage_ok, true as ecl_ok from split_a
""", ("split_a",))
def flow_a_trained_staging(spark, sf):
    """Fit, score every loan, stage on those predictions (profile A)."""
    st = models.staged_by_model_a(spark, sf)
    return st.select("loan_id", "default_flag", "status", "is_test", _in_range("pd").alias("has_pd"), *_staging_facts(st, "pd", "pd"))


@register("flow_b_trained_staging", """
select loan_id, default_flag, grade, true as has_pd, true as lifetime_ok, true as stage_ok, true as ecl_ok from scored_b
""", ("scored_b",))
def flow_b_trained_staging(spark, sf):
    """Fit, score every loan, stage on those predictions (profile B)."""
    st = models.staged_by_model_b(spark, sf)
    return st.select("loan_id", "default_flag", "grade", _in_range("pd_12m").alias("has_pd"),
                     (F.abs(F.col("pd_lifetime") - 1.2 * F.col("pd_12m")) < 1e-12).alias("lifetime_ok"),
                     *_staging_facts(st, "pd_12m", "pd_lifetime"))


def _report_totals(run: dict):
    """The stage reports add up to the portfolio report."""
    by_stage = run["portfolio_by_stage"].agg(F.sum("loan_count").alias("loans"), F.round(F.sum("total_exposure"), 1).alias("exposure"),
                                             F.sum("total_ecl").alias("ecl"))
    overall = run["portfolio_overall"].select(F.col("total_loans").alias("loans"), F.round("total_exposure", 1).alias("exposure"),
                                              F.col("total_ecl").alias("ecl"))
    share = run["stage_distribution"].agg(F.sum("pct").alias("pct"))
    rows = by_stage.select(F.lit("by stage").alias("report"), "*").unionByName(overall.select(F.lit("overall").alias("report"), "*"))
    one = rows.agg(F.min("loans").alias("loans"), F.max("loans").alias("most_loans"), F.min("exposure").alias("exposure"),
                   (F.max("ecl") - F.min("ecl")).alias("gap")).select(
        "loans", F.round("exposure", 0).alias("exposure"), ((F.col("loans") == F.col("most_loans")) & (F.col("gap") < 0.05)).alias("adds_up"),
        F.lit(None).cast("boolean").alias("shares_ok"))
    shares = share.select(F.lit(None).cast("long").alias("loans"), F.lit(None).cast("double").alias("exposure"),
                          F.lit(None).cast("boolean").alias("adds_up"), (F.abs(F.col("pct") - 100) < 0.1).alias("shares_ok"))
    return one.unionByName(shares).agg(F.max("loans").alias("loans"), F.max("exposure").alias("exposure"),
                                       F.max("adds_up").alias("adds_up"), F.max("shares_ok").alias("shares_ok"))


@register("flow_a_trained_reports", """
select count(*) as loans, round(sum(loan_amount), 0) as exposure, true as adds_up, true as shares_ok from features_a
""", ("features_a",))
def flow_a_trained_reports(spark, sf):
    return _report_totals(models.run_a(spark, sf))


@register("flow_b_trained_reports", """
select count(*) as loans, round(sum(loan_amount), 0) as exposure, true as adds_up, true as shares_ok from scored_b
""", ("scored_b",))
def flow_b_trained_reports(spark, sf):
    return _report_totals(models.run_b(spark, sf))


# Background companies of the tree attributions below; each company is scored
# for 2^5 coalitions against every one of them.
TREE_BACKGROUND = 100


@register("m13_shapley_gbt_bg100", f"""
select company_id, unnest(['revenue_growth', 'debt_to_asset_ratio', 'cash_flow_volatility', 'past_default', 'industry']) as feature,
       true as sums_to_score, {TREE_BACKGROUND} as background_rows
from sme_features
""", ("sme_features",))
def m13_shapley_gbt_bg100(spark, sf):
    """Exact Shapley values of the trained trees: they add up to the score
    less the background's mean score."""
    a = models.attributed_by_trees(spark, sf, TREE_BACKGROUND)
    total = F.aggregate("attributions", F.lit(0.0), lambda acc, x: acc + x["contribution"])
    ok = F.abs(total - (F.col("predicted_default_prob") - F.col("expected_pd"))) < 1e-9
    return a.select("company_id", ok.alias("sums_to_score"), "background_rows", F.explode("attributions").alias("s")) \
        .select("company_id", "s.feature", "sums_to_score", "background_rows")


@register("m13_shapley_gbt_population", """
select company_id, unnest(['revenue_growth', 'debt_to_asset_ratio', 'cash_flow_volatility', 'past_default', 'industry']) as feature,
       unnest([revenue_growth, debt_to_asset_ratio, cash_flow_volatility, past_default::double,
               case industry when 'Manufacturing' then 1e0 when 'Retail' then 2e0 when 'Services' then 3e0 when 'Tech' then 4e0 else 0e0 end]) as value,
       true as sums_to_score, true as balanced, count(*) over () as background_rows
from sme_features
""", ("sme_features",))
def m13_shapley_gbt_population(spark, sf):
    """Exact Shapley values of the trees' log-odds against all companies: with
    the expected log-odds they add up to each score, and over the population
    every feature's values add up to zero."""
    a = models.attributed_by_population(spark, sf)
    total = F.aggregate("attributions", F.col("expected_log_odds"), lambda acc, x: acc + x["contribution"])
    ok = F.abs(F.lit(1.0) / (1 + F.exp(-total)) - F.col("predicted_default_prob")) < 1e-9
    long = a.select("company_id", ok.alias("sums_to_score"), "background_rows", F.explode("attributions").alias("s"))
    mean = F.avg("s.contribution").alias("mean")
    balance = long.groupBy(F.col("s.feature").alias("feature")).agg(mean).select("feature", (F.abs("mean") < 1e-9).alias("balanced"))   # a row a feature
    return long.select("company_id", "sums_to_score", "background_rows", "s.feature", "s.value").join(F.broadcast(balance), "feature") \
        .select("company_id", "feature", "value", "sums_to_score", "balanced", "background_rows")


@register("r7_factor_table_trees", """
select company_id, true as top_three, true as only_ruled, true as ordered from sme_features
""", ("sme_features",))
def r7_factor_table_trees(spark, sf):
    """R-7 on the trees: the factors are those of the three largest
    contributions that have a rule, checked against an independent ranking."""
    from ..operators import explain
    from ..plans import sme

    a = models.attributed_by_population(spark, sf)
    ranked = a.select("company_id", F.explode("attributions").alias("x")).select("company_id", "x.*")
    place = F.row_number().over(Window.partitionBy("company_id").orderBy(F.abs("contribution").desc(), "feature_pos"))   # five rows a company
    keys = [r[0] for r in explain.INSIGHT_RULES]
    want = ranked.withColumn("place", place).where((F.col("place") <= 3) & F.col("feature").isin(*keys)) \
        .groupBy("company_id").agg(F.array_sort(F.collect_list(F.struct("place", "feature"))).alias("want"))
    got = sme.factor_tables(spark, sf, a).join(want, "company_id", "left")
    named = F.transform("factors", lambda f: F.struct(f["factor_rank"].alias("place"), f["feature"].alias("feature")))
    sizes = F.transform("factors", lambda f: F.abs(f["contribution"]))
    return got.select("company_id", (named == F.coalesce("want", F.array().cast("array<struct<place:int,feature:string>>"))).alias("top_three"),
                      F.forall("factors", lambda f: f["insight"].isNotNull()).alias("only_ruled"),
                      (sizes == F.reverse(F.array_sort(sizes))).alias("ordered"))


@register("r9_memo_trees", """
select company_id, true as has_pd, true as has_factors from sme_features
""", ("sme_features",))
def r9_memo_trees(spark, sf):
    """R-9 on the trees: every memo states the trees' PD and each of its factors.
    The factor tables are written once; the memos and the check read them."""
    from ..functions.text import fmt_pct2
    from ..plans import sme
    from ..sources.tables import land

    a = models.attributed_by_population(spark, sf)
    ft = spark.read.parquet(land(sme.factor_tables(spark, sf, a), name="factor_tables"))
    memo = sme.memos(spark, sf, as_of="2000-01-01", factors=ft).join(ft.select("company_id", "predicted_default_prob", "factors"), "company_id")
    return memo.select("company_id", F.contains("memo", F.concat(F.lit("Model Prediction (PD): "), fmt_pct2(F.col("predicted_default_prob")))).alias("has_pd"),
                       F.forall("factors", lambda f: F.contains(F.col("memo"), f["commentary"])).alias("has_factors"))


@register("r16_chart_trees", """
select company_id, 5 as bars, true as ascending, true as coloured from sme_features
""", ("sme_features",))
def r16_chart_trees(spark, sf):
    """R-16 on the trees: one bar per player, ascending, coloured by sign."""
    from ..operators import explain

    a = models.attributed_by_population(spark, sf).select("company_id", explain.chart_rows("attributions").alias("bars"))
    height = F.transform("bars", lambda b: b["contribution"])
    return a.select("company_id", F.size("bars").alias("n"), (height == F.array_sort(height)).alias("ascending"),
                    F.forall("bars", lambda b: (b["colour"] == explain.RISK_COLOUR) == (b["contribution"] > 0)).alias("coloured")) \
        .withColumnRenamed("n", "bars")
