"""Registered queries: monitoring extensions described by the reference's
documentation (E-1 … E-11)."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from ..operators import evaluate, features as feat, monitoring as mon, score, stress
from ..plans import book_a, book_b, sme
from . import register
from .layers import sme_pd

R9, R12 = 9, 12
# ---- fixed values: periods compared and the probability-weighted scenarios ----
PERIODS = ("1996", "1997")
BACKTEST_FROM = "1998-01-01"
SCENARIOS = [(0.0, 1.0, 0.5), (-0.2, 1.5, 0.3), (-0.5, 2.0, 0.2)]   # (revenue shock, volatility, weight)


def _scored_a_dated(spark, sf):
    """Profile A loans with their origination period, scored with the fixed PD."""
    from ..sources import fixtures

    dated = fixtures.raw_loans(spark, sf, with_dates=True)
    fa = dated.select("*", F.round(F.col("total_debt") / F.nullif(F.col("income"), F.lit(0.0)), 4).alias("dti_ratio"),
                      feat.fico_category_a("fico_score").alias("fico_category"))
    return score.score_loans_fixed(fa).withColumn("period", F.year("origination_date").cast("string"))


@register("e1_calibration_deciles", f"""
select cast(decile as integer) as decile, count(*) as n, round(avg(pd_12m), {R9}) as avg_pd,
       round(avg(default_flag), {R9}) as default_rate
from (select *, ntile(10) over (order by pd_12m, loan_id) as decile from scored_b) t
group by decile
""", ("scored_b",))
def e1_calibration_deciles(spark, sf):
    c = mon.calibration_table(book_b.scored(spark, sf), "pd_12m", "default_flag", "loan_id")
    return c.select("decile", "n", F.round("avg_pd", R9).alias("avg_pd"), F.round("default_rate", R9).alias("default_rate"))


@register("e1_brier_score", f"""
select round(avg((pd_12m - default_flag) * (pd_12m - default_flag)), {R12}) as brier from scored_b
""", ("scored_b",))
def e1_brier_score(spark, sf):
    return mon.brier_score(book_b.scored(spark, sf), "pd_12m", "default_flag").select(F.round("brier", R12).alias("brier"))


@register("e2_threshold_table", f"""
select t.threshold,
       round(coalesce(count_if(s.pd_12m > t.threshold and s.default_flag = 1)::double
             / nullif(count_if(s.pd_12m > t.threshold), 0), 0), {R12}) as precision,
       round(coalesce(count_if(s.pd_12m > t.threshold and s.default_flag = 1)::double
             / nullif(count_if(s.default_flag = 1), 0), 0), {R12}) as recall
from scored_b s cross join (values (0.02e0), (0.05e0), (0.1e0), (0.2e0), (0.5e0)) t(threshold)
group by t.threshold
""", ("scored_b",))
def e2_threshold_table(spark, sf):
    t = mon.threshold_table(book_b.scored(spark, sf), "pd_12m", "default_flag")
    return t.select("threshold", F.round("precision", R12).alias("precision"), F.round("recall", R12).alias("recall"))


@register("e3_predicted_vs_actual", f"""
select case when grouping(grade) = 1 then 'portfolio' else 'segment' end as level, grade as segment,
       count(*) as n, round(avg(pd_12m), {R9}) as predicted_rate, round(avg(default_flag), {R9}) as actual_rate
from scored_b group by rollup (grade)
""", ("scored_b",))
def e3_predicted_vs_actual(spark, sf):
    t = mon.predicted_vs_actual(book_b.scored(spark, sf), "pd_12m", "default_flag", "grade")
    return t.select("level", "segment", "n", F.round("predicted_rate", R9).alias("predicted_rate"),
                    F.round("actual_rate", R9).alias("actual_rate"))


@register("e4_misclassification_cost", """
select cast(count_if(pd_12m <= 0.5 and default_flag = 1) as bigint) as false_negatives,
       cast(count_if(pd_12m > 0.5 and default_flag = 0) as bigint) as false_positives,
       round(sum(case when pd_12m <= 0.5 and default_flag = 1 then loan_amount * 0.45 else 0e0 end), 2) as fn_cost,
       round(sum(case when pd_12m > 0.5 and default_flag = 0 then loan_amount * interest_rate else 0e0 end), 2) as fp_cost
from scored_b
""", ("scored_b",))
def e4_misclassification_cost(spark, sf):
    c = mon.misclassification_cost(book_b.scored(spark, sf), "pd_12m", "default_flag", "loan_amount",
                                   margin=F.col("interest_rate"))
    return c.select("false_negatives", "false_positives", F.round("fn_cost", 2).alias("fn_cost"),
                    F.round("fp_cost", 2).alias("fp_cost"))


@register("e5_population_stability", f"""
with per_bin as (select fico_category, count_if(period = '{PERIODS[0]}') as e, count_if(period = '{PERIODS[1]}') as a
                 from scored_a_dated group by fico_category),
sh as (select fico_category, (e + 5e-1) / (sum(e) over () + 5e-1 * count(*) over ()) as e,
              (a + 5e-1) / (sum(a) over () + 5e-1 * count(*) over ()) as a from per_bin)
select round(sum((a - e) * ln(a / e)), {R12}) as psi from sh
""", ("scored_a_dated",))
def e5_population_stability(spark, sf):
    d = _scored_a_dated(spark, sf)
    return mon.population_stability(d, "fico_category", F.col("period"), *PERIODS) \
        .select(F.round("psi", R12).alias("psi"))


@register("e5_population_stability_empty_bin", f"""
with per_bin as (select fico_category, count_if(period = '{PERIODS[0]}') as e,
                        count_if(period = '{PERIODS[1]}' and fico_category <> 'Good') as a
                 from scored_a_dated group by fico_category),
sh as (select fico_category, (e + 5e-1) / (sum(e) over () + 5e-1 * count(*) over ()) as e,
              (a + 5e-1) / (sum(a) over () + 5e-1 * count(*) over ()) as a from per_bin)
select round(sum((a - e) * ln(a / e)), {R12}) as psi from sh
""", ("scored_a_dated",))
def e5_population_stability_empty_bin(spark, sf):
    """A bin that the second period does not have."""
    d = _scored_a_dated(spark, sf).where((F.col("period") != PERIODS[1]) | (F.col("fico_category") != "Good"))
    return mon.population_stability(d, "fico_category", F.col("period"), *PERIODS) \
        .select(F.round("psi", R12).alias("psi"))


@register("e6_importance_rank_stability", f"""
with m as (select avg(dti_ratio) as md, avg(fico_score) as mf, avg(loan_amount) as ma from scored_a_dated),
imp as (
  select 'dti' as feature, period, avg(abs(2e0 * (dti_ratio - md))) as importance from scored_a_dated, m
  where period in ('{PERIODS[0]}', '{PERIODS[1]}') group by period
  union all
  select 'fico', period, avg(abs(-1e-2 * (fico_score - mf))) from scored_a_dated, m
  where period in ('{PERIODS[0]}', '{PERIODS[1]}') group by period
  union all
  select 'amount', period, avg(abs(1e-4 * (loan_amount - ma))) from scored_a_dated, m
  where period in ('{PERIODS[0]}', '{PERIODS[1]}') group by period)
select feature, period, round(importance, {R9}) as importance,
       cast(row_number() over (partition by period order by importance desc, feature) as integer) as importance_rank
from imp
""", ("scored_a_dated",))
def e6_importance_rank_stability(spark, sf):
    d = _scored_a_dated(spark, sf)
    m = d.agg(F.avg("dti_ratio").alias("md"), F.avg("fico_score").alias("mf"), F.avg("loan_amount").alias("ma")).first()
    c = score.LOAN_PD_COEF
    contribs = {"dti": F.lit(c["dti"]) * (F.col("dti_ratio") - F.lit(m["md"])),
                "fico": F.lit(c["fico"]) * (F.col("fico_score") - F.lit(m["mf"])),
                "amount": F.lit(c["amount"]) * (F.col("loan_amount") - F.lit(m["ma"]))}
    r = mon.importance_ranks(d, contribs, F.col("period"), PERIODS)
    return r.select("feature", "period", F.round("importance", R9).alias("importance"), "importance_rank")


@register("e7_out_of_time_auc", f"""
with t as (select pd as s, default_flag as y from scored_a_dated o
           where pd is not null and loan_id in (select printf('LOAN_%06d', o_orderkey + 1) from orders
                                                where o_orderdate >= timestamp '{BACKTEST_FROM} 00:00:00')),
g as (select s, sum(y) as p, count(*) - sum(y) as n from t group by s),
c as (select *, sum(n) over (order by s rows between unbounded preceding and current row) - n as n_below from g)
select round(sum(p * (n_below + n * 0.5e0)) / (sum(p) * sum(n)), {R12}) as auc from c
""", ("scored_a_dated",))
def e7_out_of_time_auc(spark, sf):
    d = _scored_a_dated(spark, sf).where(F.col("origination_date") >= F.lit(f"{BACKTEST_FROM} 00:00:00").cast("timestamp_ntz"))
    return evaluate.auc(d, "pd", "default_flag").select(F.round("auc", R12).alias("auc"))


@register("e7_backtest_report", f"""
with t as (select f.default_flag as y from features_a f join orders o on f.loan_id = printf('LOAN_%06d', o.o_orderkey + 1)
           where o.o_orderdate >= timestamp '{BACKTEST_FROM} 00:00:00' and f.dti_ratio is not null and f.loan_to_income_ratio is not null)
select 'No Default' as class, count(*) as support, true as in_range from t where y = 0
union all select 'Default', count(*), true from t where y = 1
union all select unnest(['accuracy', 'macro avg', 'weighted avg']), count(*), true from t
""", ("features_a",))
def e7_backtest_report(spark, sf):
    """Back-test: the model is trained on the loans before the cut-over and
    reported (M-9) on the loans after it."""
    from ..sources import fixtures

    dated = fixtures.raw_loans(spark, sf, with_dates=True)
    enc = feat.encode_a(feat.features_a(dated)).join(dated.select("loan_id", "origination_date"), "loan_id")
    later = F.col("origination_date") >= F.lit(f"{BACKTEST_FROM} 00:00:00").cast("timestamp_ntz")
    model = score.fit_logistic(enc.where(~later), feat.A_MODEL_FEATURES, "default_flag")
    tested = score.score_with_model(model, enc.where(later), feat.A_MODEL_FEATURES, out="pd").where(F.col("pd").isNotNull())
    r = evaluate.classification_report(tested.withColumn("yhat", evaluate.hard_prediction("pd")), "default_flag", "yhat")
    fine = F.lit(True)
    for c in ("precision", "recall", "f1_score"):
        fine = fine & F.coalesce(F.col(c), F.lit(0.0)).between(0.0, 1.0)
    return r.select("class", "support", fine.alias("in_range"))


def _dated_a(spark, sf):
    """Profile A's encoded loans with their year of origination."""
    from ..sources import fixtures

    dated = fixtures.raw_loans(spark, sf, with_dates=True)
    enc = feat.encode_a(feat.features_a(dated))
    return enc.join(dated.select("loan_id", F.date_format("origination_date", "yyyy").alias("period")), "loan_id")


def rolling_scores(spark, sf):
    """The rolling back-test's scores, written once: every loan from the second
    year on, scored by the model of its year's fold; with the folds' coefficients."""
    from ..operators import backtest
    from ..sources.tables import land

    df = spark.read.parquet(land(_dated_a(spark, sf), name="dated_loans"))
    cuts = backtest.periods_of(df, "period", 1000)[1:]
    beta = backtest.fit_folds(df, feat.A_MODEL_FEATURES, "default_flag", "period", cuts)
    scored = backtest.score_folds(df, beta, feat.A_MODEL_FEATURES, "period", cuts).withColumn("yhat", evaluate.hard_prediction("pd"))
    return spark.read.parquet(land(scored.select("loan_id", "cut", "default_flag", "pd", "yhat"), name="rolling_scores")), df, cuts, beta


@register("e7_rolling_backtest", """
with t as (select cast(year(o.o_orderdate) as varchar) as period, f.default_flag as y
           from features_a f join orders o on f.loan_id = printf('LOAN_%06d', o.o_orderkey + 1)
           where f.dti_ratio is not null and f.loan_to_income_ratio is not null),
c as (select distinct period as cut from t where period > (select min(period) from t))
select cut, (select count(*) from t where period < cut) as n_train, count(*) as n_test, cast(sum(y) as bigint) as n_default,
       true as stationary, true as auc_agrees, true as report_agrees
from c join t on t.period = c.cut group by cut
""", ("features_a",))
def e7_rolling_backtest(spark, sf):
    """One model a year, trained on all years before it: at each fold's
    coefficients the objective's gradient is zero, and AUC and report follow
    from the written scores by a plain window and plain counts."""
    from ..operators import backtest

    scored, df, cuts, beta = rolling_scores(spark, sf)
    features = feat.A_MODEL_FEATURES
    inputs = [F.lit(1.0), *[F.col(f).cast("double") for f in features]]
    trained = df.where(backtest._complete(features)).select("default_flag", "period", *features, F.explode(F.filter(
        F.array(*[F.struct(F.lit(i).alias("_fold"), F.lit(c).alias("cut")) for i, c in enumerate(cuts)]), lambda f: F.col("period") < f["cut"])).alias("f")) \
        .select("*", "f.*")
    miss = 1 / (1 + F.exp(-backtest._logit(beta, inputs))) - F.col("default_flag")
    still = F.lit(True)
    for j, x in enumerate(inputs):
        penalty = F.lit(0.0) if j == 0 else F.get(F.array(*[F.lit(float(b)) for b in beta[:, j]]), F.first("_fold"))
        still = still & (F.abs(F.sum(miss * x) + penalty) <= 1e-6 * (1 + F.sum(F.abs(x))))
    fits = trained.groupBy("cut").agg(F.count(F.lit(1)).alias("n_train"), still.alias("stationary"))

    y, p = F.col("default_flag"), F.col("yhat")
    by_score = scored.groupBy("cut", "pd").agg(F.sum("default_flag").alias("pos"), F.count_if(y == 0).alias("neg"))
    below = F.sum("neg").over(Window.partitionBy("cut").orderBy("pd").rowsBetween(Window.unboundedPreceding, -1))
    plain_auc = by_score.withColumn("below", F.coalesce(below, F.lit(0))).groupBy("cut").agg(
        F.try_divide(F.sum(F.col("pos") * (F.col("below") + F.col("neg") * 0.5)), (F.sum("pos") * F.sum("neg")).cast("double")).alias("plain"))
    plain = scored.groupBy("cut").agg(
        F.count(F.lit(1)).alias("n_test"), F.sum("default_flag").cast("long").alias("n_default"), F.avg((y == p).cast("double")).alias("acc"),
        F.coalesce(F.try_divide(F.sum(y * p).cast("double"), F.sum(p)), F.lit(0.0)).alias("prec"), F.coalesce(F.try_divide(F.sum(y * p).cast("double"), F.sum(y)), F.lit(0.0)).alias("rec"))
    report = backtest.report_by(scored, "cut", "default_flag", "yhat")
    near = lambda a, b: F.coalesce(F.abs(F.col(a) - F.col(b)) < 1e-9, F.col(a).isNull() & F.col(b).isNull())
    return (plain.join(fits, "cut").join(plain_auc, "cut").join(backtest.auc_by(scored, "cut", "pd", "default_flag"), "cut").join(report, "cut")
            .select("cut", "n_train", "n_test", "n_default", "stationary", near("auc", "plain").alias("auc_agrees"),
                    (near("accuracy", "acc") & near("precision", "prec") & near("recall", "rec") & (F.col("support") == F.col("n_default"))).alias("report_agrees")))


VOTE_TREES = 20
VOTE_MODELS = ("pd_formula", "pd_logistic", "pd_trees")


def vote_scores(spark, sf):
    """Profile A's loans with the scores of the formula, the logistic regression
    (M-4) and boosted trees (M-11 with ``VOTE_TREES`` trees), written once."""
    from ..sources.tables import land

    df = spark.read.parquet(land(_dated_a(spark, sf).join(book_a.scored(spark, sf).select("loan_id", F.col("pd").alias("pd_formula")), "loan_id"), name="vote_loans"))
    train = df.where(F.pmod(F.xxhash64("loan_id"), F.lit(5)) != 0)
    for name, model in (("pd_logistic", score.fit_logistic(train, feat.A_MODEL_FEATURES, "default_flag")),
                        ("pd_trees", score.fit_gbt(train, feat.A_MODEL_FEATURES, "default_flag", trees=VOTE_TREES))):
        df = score.score_with_model(model, df, feat.A_MODEL_FEATURES, out=name)
    return spark.read.parquet(land(df.select("loan_id", "period", "default_flag", *VOTE_MODELS), name="vote_scores"))


@register("e11_model_vote", """
select f.loan_id, cast(year(o.o_orderdate) as varchar) as period, true as weights_sum_to_one, true as equal_without_history, true as inside_the_scores
from features_a f join orders o on f.loan_id = printf('LOAN_%06d', o.o_orderkey + 1)
""", ("features_a",))
def e11_model_vote(spark, sf):
    """E-11 over three models: weights from each model's Brier score in earlier
    years, equal in the first; the vote lies between the scores it is made of."""
    from ..operators import backtest

    scores = vote_scores(spark, sf)
    weights = backtest.earlier_weights(scores, VOTE_MODELS, "default_flag", "period")
    first = scores.agg(F.min("period")).first()[0]
    v = backtest.vote(scores, weights, VOTE_MODELS, "period")
    parts = [F.col(f"weight_{m}") for m in VOTE_MODELS]
    lo, hi = F.least(*VOTE_MODELS), F.greatest(*VOTE_MODELS)
    return v.select("loan_id", "period", (F.abs(parts[0] + parts[1] + parts[2] - 1) < 1e-12).alias("weights_sum_to_one"),
                    ((F.col("period") != first) | (F.abs(parts[0] - parts[1]) + F.abs(parts[1] - parts[2]) < 1e-12)).alias("equal_without_history"),
                    F.coalesce((F.col("pd_vote") >= lo - 1e-12) & (F.col("pd_vote") <= hi + 1e-12), lo.isNull() & F.col("pd_vote").isNull()).alias("inside_the_scores"))


@register("e8_woe_iv", f"""
with per as (select fico_category, cast(count_if(default_flag = 0) as bigint) as good,
                    cast(count_if(default_flag = 1) as bigint) as bad
             from features_a group by fico_category),
s as (select *, good::double / sum(good) over () as gs, bad::double / sum(bad) over () as bs from per)
select fico_category, good, bad,
       round(case when good > 0 and bad > 0 then ln(gs / bs) end, {R12}) as woe,
       round((gs - bs) * case when good > 0 and bad > 0 then ln(gs / bs) end, {R12}) as iv
from s
""", ("features_a",))
def e8_woe_iv(spark, sf):
    w = mon.woe_iv(book_a.features(spark, sf), "fico_category", "default_flag")
    return w.select("fico_category", "good", "bad", F.round("woe", R12).alias("woe"), F.round("iv", R12).alias("iv"))


@register("e8_woe_iv_without_bads", """
select fico_category, count(*) as good, cast(0 as bigint) as bad, cast(null as double) as woe, cast(null as double) as iv
from features_a where default_flag = 0 group by fico_category
""", ("features_a",))
def e8_woe_iv_without_bads(spark, sf):
    """No defaults at all: evidence is undefined, not an error."""
    return mon.woe_iv(book_a.features(spark, sf).where(F.col("default_flag") == 0), "fico_category", "default_flag")


@register("e9_fairness_by_group", f"""
with per as (
  select home_ownership, count(*) as n,
         avg(case when pd_12m > 0.5 then 0e0 else 1e0 end) as approval_rate,
         count_if(pd_12m > 0.5 and default_flag = 1)::double / nullif(count_if(default_flag = 1), 0) as tpr,
         count_if(pd_12m > 0.5 and default_flag = 0)::double / nullif(count_if(default_flag = 0), 0) as fpr
  from scored_b group by home_ownership)
select home_ownership, n, round(approval_rate, {R12}) as approval_rate, round(tpr, {R12}) as tpr,
       round(fpr, {R12}) as fpr, round(approval_rate / max(approval_rate) over (), {R12}) as disparate_impact
from per
""", ("scored_b",))
def e9_fairness_by_group(spark, sf):
    s = book_b.scored(spark, sf).withColumn("yhat", evaluate.hard_prediction("pd_12m"))
    f = mon.fairness_by_group(s, "home_ownership", "default_flag", "yhat")
    return f.select("home_ownership", "n", *[F.round(c, R12).alias(c) for c in
                                             ("approval_rate", "tpr", "fpr", "disparate_impact")])


_CF_SQL = " union all ".join(
    f"select company_id, '{f}' as feature, round({sme_pd()}, {R9}) as pd_base, "
    f"round({sme_pd(**{k: (f'{col} * 1.1e0' if col == f else col) for k, col in zip(('rg', 'dta', 'cfv', 'pdf'), score.SME_NUMERIC)})}, {R9}) "
    f"as pd_counterfactual from sme_features"
    for f in score.SME_NUMERIC)


@register("e10_counterfactual_pd", _CF_SQL, ("sme_features",))
def e10_counterfactual_pd(spark, sf):
    f = sme.features(spark, sf)
    pd_fn = lambda cols: score.pd_sme_fixed(*[cols[c] for c in score.SME_NUMERIC])
    cf = mon.counterfactual_pd(f.select("company_id", *score.SME_NUMERIC), pd_fn, score.SME_NUMERIC, 0.1)
    return cf.select("company_id", "feature", F.round("pd_base", R9).alias("pd_base"),
                     F.round("pd_counterfactual", R9).alias("pd_counterfactual"))


def _e11_sql() -> str:
    total = sum(w for _, _, w in SCENARIOS)
    terms = []
    for rev, vol, w in SCENARIOS:
        terms.append(f"(1e0 / (1e0 + exp(-(ln(b / (1e0 - b)) + (({rev}e0 * -5e0) + (({vol}e0 - 1e0) * 1.5e0))))))"
                     f" * {w / total!r}e0")
    return f"""
select company_id, round({' + '.join(terms)}, {R9}) as weighted_pd
from (select company_id, case when predicted_default_prob is null then null
                              else least(greatest(predicted_default_prob, 1e-3), 999e-3) end as b from sme_scored) t
"""


@register("e11_scenario_weighted_pd", _e11_sql(), ("sme_scored",))
def e11_scenario_weighted_pd(spark, sf):
    s = sme.scored(spark, sf)
    pds = [stress.stressed_pd("predicted_default_prob", F.lit(rev), F.lit(vol)) for rev, vol, _ in SCENARIOS]
    return s.select("company_id", F.round(mon.weighted_vote(pds, [w for _, _, w in SCENARIOS]), R9).alias("weighted_pd"))
