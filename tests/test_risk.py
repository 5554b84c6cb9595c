"""Staging, ECL, stress and explanation rules: goldens and invariants."""

import math

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMOKE
from provisio.operators import clean, evaluate, explain, reports, staging, stress
from provisio.plans import book_a, book_b, sme


def test_stage_rules(spark):
    df = spark.createDataFrame([(1, 0.001), (0, 0.02), (0, 0.0199), (0, None)], "f int, p double")
    assert [r[0] for r in df.select(staging.ifrs9_stage("f", "p")).collect()] == [3, 2, 1, 1]


def test_ecl_rules(spark):
    df = spark.createDataFrame([(1, 1000.0, 0.5), (0, 1000.0, 0.1), (0, 1000.0, 0.01)], "f int, a double, p double")
    a = [r[0] for r in df.select(staging.ecl("f", "a", "p")).collect()]
    assert a == pytest.approx([450.0, 45.0, 2.25])
    b = df.select(staging.ecl("f", "a", "p", F.col("p") * 1.2)).collect()
    assert b[1][0] == pytest.approx(54.0)


def test_stress_goldens(spark):
    df = spark.createDataFrame([(0.5, 0.0, 1.0), (0.0, 0.0, 1.0), (None, 0.0, 1.0)], "p double, r double, v double")
    got = [r[0] for r in df.select(stress.stressed_pd("p", "r", "v")).collect()]
    assert got[0] == pytest.approx(0.5) and got[1] == pytest.approx(0.001) and got[2] is None
    g = spark.createDataFrame([(-0.10, -0.50)], "g double, s double").select(stress.stressed_growth("g", "s")).first()[0]
    assert g == pytest.approx(-0.05)


def test_boundaries_exactly_point_two(spark):
    df = spark.createDataFrame([(0.2,)], "p double")
    r = df.select(explain.risk_level("p"), stress.recommendation("p")).first()
    assert tuple(r) == ("LOW RISK", "APPROVE")


def test_grid_has_315_scenarios(spark):
    df = spark.createDataFrame([("X",)], "company_id string")
    g = stress.scenario_grid(df)
    assert g.count() == 315
    assert sorted({r.shock_rev for r in g.collect()})[0] == -0.5
    assert sorted({r.shock_vol for r in g.collect()})[-1] == 3.0


def test_findings_text(spark):
    df = spark.createDataFrame([(-0.1, 0.7, 2.0, 1), (0.1, 0.1, 0.5, 0)], "g double, d double, v double, p int")
    found = stress.findings(F.col("g"), F.col("d"), F.col("v"), F.col("p"))
    got = df.select(stress.verdict_text(found).alias("t")).collect()
    assert got[0].t == ("Revenue is contracting (-10.0%). Leverage is critically high (70.0%). Cash flow is highly "
                        "volatile (2.00x). History of default detected. These factors significantly elevate the "
                        "Probability of Default under stress.")
    assert got[1].t.startswith("All key risk metrics are within healthy ranges.")


def test_factor_table_drops_unmatched_after_top3(spark):
    arr = F.array(*[F.struct(F.lit(f).alias("feature"), F.lit(i).alias("feature_pos"), F.lit(v).alias("value"),
                             F.lit(c).alias("contribution"))
                    for i, (f, v, c) in enumerate([("revenue_growth", -0.1, 0.9), ("debt_to_asset_ratio", 0.4, 0.1),
                                                   ("cash_flow_volatility", 2.0, 0.5), ("past_default", 0.0, -0.05),
                                                   ("industry_Tech", 1.0, 0.7)])])
    rows = spark.range(1).select(F.explode(explain.factor_table(arr)).alias("f")).select("f.*").collect()
    assert [r.insight for r in rows] == ["Revenue Growth", "Cash Flow Volatility"]
    assert [r.factor_rank for r in rows] == [1, 3]
    assert rows[0].status == "⚠️ Risk" and rows[0].value_text == "-10.0%"
    assert rows[0].commentary == "Negative growth (-10.0%) indicates structural market share loss."
    assert rows[1].attribution_text == "▲ 0.500"


def test_lookup_not_found(spark):
    scored = spark.createDataFrame([("HK_00001", 0.1)], "company_id string, p double")
    req = spark.createDataFrame([("HK_00001",), ("HK_99999",)], "company_id string")
    got = sorted(tuple(r) for r in explain.lookup(req, scored).select("company_id", "lookup_status").collect())
    assert got == [("HK_00001", "FOUND"), ("HK_99999", "NOT_FOUND")]


def test_loader_a_keeps_id_only_row(spark):
    schema = ("id bigint, loan_amnt double, annual_inc double, dti double, installment double, loan_status string, "
              "fico_range_low double, fico_range_high double, grade string")
    df = spark.createDataFrame([(1, 1000.0, 50000.0, 10.0, 30.0, "Fully Paid", 700.0, 704.0, "A"),
                                (2, 3000.0, 70000.0, 20.0, 90.0, "Charged Off", 650.0, 654.0, "B"),
                                (3, 2000.0, 60000.0, 30.0, 60.0, "In Grace Period", 600.0, 604.0, "C"),
                                (4, None, None, None, None, None, None, None, None)], schema)
    got = {r.loan_id: r for r in clean.loader_a(df).collect()}
    r4 = got["LOAN_4"]
    assert r4.income == 60000.0 and r4.loan_amount == 2000.0 and r4.fico_score == 680 and r4.default_flag == 0
    assert r4.total_debt == pytest.approx(sorted([5000.0, 14000.0, 18000.0])[1])
    assert got["LOAN_3"].default_flag == 0 and got["LOAN_2"].default_flag == 1 and got["LOAN_1"].fico_score == 702


def test_quality_filter_b(spark):
    land = book_b.landing(spark, SF_SMOKE)
    cleaned = book_b.cleaned(spark, SF_SMOKE)
    assert cleaned.where("fico_score < 300 or fico_score > 850").count() == 0
    assert cleaned.where("fico_score is null").count() > 0
    assert cleaned.where("loan_status in ('In Grace Period', 'Late (16-30 days)')").count() == 0
    assert cleaned.count() < land.count()


def test_profile_a_invariants(spark):
    st = book_a.staged(spark, SF_SMOKE).cache()
    assert st.where("pd < 0 or pd > 1").count() == 0
    assert st.groupBy("loan_id").count().where("count > 1").count() == 0
    assert st.where("ecl < 0").count() == 0
    assert st.where("stage = 3 and abs(ecl - loan_amount * 0.45) > 1e-9").count() == 0
    assert set(r.stage for r in st.select("stage").distinct().collect()) == {1, 2, 3}
    dist = reports.stage_distribution(st).collect()
    assert abs(sum(r.pct for r in dist) - 100.0) < 0.05


def test_flow_reports_equal_direct_reports(spark):
    out = book_a.run(spark, SF_SMOKE)
    st = book_a.staged(spark, SF_SMOKE)
    assert sorted(out["portfolio_by_stage"].collect()) == sorted(reports.portfolio_by_stage(st).collect())
    assert sorted(out["portfolio_overall"].collect()) == sorted(reports.portfolio_overall(st).collect())


def test_weighted_recall_equals_accuracy(spark):
    from provisio.plans import models

    rep = {r["class"]: r for r in evaluate.classification_report(models.evaluation_b(spark, SF_SMOKE), "y", "yhat").collect()}
    assert rep["weighted avg"].recall == pytest.approx(rep["accuracy"].f1_score)


def test_split_sizes_exact(spark):
    from provisio.plans import models

    sp = models.split_b(spark, SF_SMOKE)
    for r in sp.groupBy("default_flag").agg(F.count("*").alias("n"), F.count_if("is_test").alias("t")).collect():
        assert r.t == round(0.2 * r.n + 1e-9)


def test_linear_attribution_sums_to_logit_gap(spark):
    a = sme.attributed(spark, SF_SMOKE)
    sc = sme.scored(spark, SF_SMOKE)
    means = explain.feature_means(sc, explain.SME_FEATURES)
    mean_logit = sum(explain.LINEAR_COEF[f] * means[f] for f in explain.SME_FEATURES)
    from provisio.operators.score import sme_logit_fixed

    rows = a.select(F.aggregate("attributions", F.lit(0.0), lambda acc, x: acc + x["contribution"]).alias("s"),
                    (sme_logit_fixed("revenue_growth", "debt_to_asset_ratio", "cash_flow_volatility", "past_default")
                     + 3.0).alias("lin")).collect()
    for r in rows:
        assert r.s == pytest.approx(r.lin - mean_logit, abs=1e-9)


def test_shapley_efficiency(spark):
    f = sme.features(spark, SF_SMOKE)
    bg = explain.background_sample(f, "company_id", 20)
    sh = explain.shapley_attributions(f, bg)
    from provisio.operators.score import pd_sme_fixed

    fx = f.select("company_id", pd_sme_fixed("revenue_growth", "debt_to_asset_ratio", "cash_flow_volatility",
                                             "past_default").alias("fx"))
    j = sh.join(fx, "company_id").select(
        F.aggregate("shapley", F.lit(0.0), lambda acc, x: acc + x["contribution"]).alias("s"), "fx", "expected_pd")
    for r in j.collect():
        assert r.s == pytest.approx(r.fx - r.expected_pd, abs=1e-12)


def test_shapley_against_sample_equals_the_two_steps(spark):
    f = sme.features(spark, SF_SMOKE)
    want = explain.shapley_attributions(f, explain.background_sample(f, "company_id", 7))
    got = explain.shapley_against_sample(f, 7)
    assert {r.background_rows for r in got.select("background_rows").collect()} == {7}
    rows = [sorted((r.company_id, r.expected_pd, *[x.contribution for x in r.shapley]) for r in df.collect()) for df in (want, got)]
    assert len(rows[0]) == len(rows[1]) > 0
    assert all(a[0] == b[0] and a[1:] == pytest.approx(b[1:], abs=1e-12) for a, b in zip(*rows))
    for too_many in (lambda: explain.shapley_against_sample(f, explain.MAX_BACKGROUND_ROWS + 1),
                     lambda: explain.background_sample(f, "company_id", explain.MAX_BACKGROUND_ROWS + 1)):
        with pytest.raises(ValueError, match="shapley_over_population"):
            too_many()


def test_zero_shock_returns_clipped_base(spark):
    st = sme.stressed(spark, SF_SMOKE).where("shock_rev = 0 and shock_vol = 1.0")
    assert st.where(F.abs(F.col("stressed_pd") - F.col("base_pd")) > 1e-12).count() == 0
    assert st.count() == sme.scored(spark, SF_SMOKE).count()


def test_auc_matches_rank_formula(spark):
    df = spark.createDataFrame([(0.1, 0), (0.4, 0), (0.35, 1), (0.8, 1), (0.4, 1)], "s double, y int")
    got = evaluate.auc(df, "s", "y").first()[0]
    # pairs (pos, neg): 0.35>0.1, 0.35<0.4, 0.8>both, 0.4 vs 0.1 win, 0.4 vs 0.4 tie
    assert got == pytest.approx((1 + 0 + 2 + 1 + 0.5) / 6)
    assert not math.isnan(got)


def test_model_shapley_efficiency(spark):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array

    from provisio.operators import score

    frame = score.sme_model_frame(sme.features(spark, SF_SMOKE))
    model = score.fit_gbt(frame, score.SME_MODEL_FEATURES, "true_label", trees=5)
    bg = explain.model_background(frame, "company_id", 10)
    sh = explain.shapley_for_model(frame, model, explain.SME_PLAYERS, bg)
    fx = model.setFeaturesCol("_fx").transform(
        VectorAssembler(inputCols=score.SME_MODEL_FEATURES, outputCol="_fx").transform(frame)) \
        .select("company_id", vector_to_array("probability")[1].alias("fx"))
    j = sh.join(fx, "company_id").select(
        F.aggregate("shapley", F.lit(0.0), lambda acc, x: acc + x["contribution"]).alias("s"), "fx", "expected_pd")
    rows = j.collect()
    assert len(rows) == frame.count()
    for r in rows:
        assert r.s == pytest.approx(r.fx - r.expected_pd, abs=1e-9)


def test_logistic_matches_l2_objective(spark):
    """T-10: regParam = 1/n without standardisation reproduces the default
    L2 objective ½‖w‖² + Σ logloss with a free intercept (Newton solution)."""
    import numpy as np

    from provisio.operators import features as feat
    from provisio.plans import models

    model, split = models.logistic_a(spark, SF_SMOKE)
    train = split.where(~F.col("is_test")).dropna(subset=feat.A_MODEL_FEATURES).select(*feat.A_MODEL_FEATURES, "default_flag").collect()
    X = np.array([[float(r[c]) for c in feat.A_MODEL_FEATURES] for r in train])
    y = np.array([float(r.default_flag) for r in train])
    A = np.hstack([X, np.ones((len(X), 1))])
    beta = np.zeros(A.shape[1])
    reg = np.eye(A.shape[1])
    reg[-1, -1] = 0.0
    for _ in range(100):
        p = 1.0 / (1.0 + np.exp(-A @ beta))
        grad = A.T @ (p - y) + reg @ beta
        hess = A.T @ (A * (p * (1 - p))[:, None]) + reg
        step = np.linalg.solve(hess, grad)
        beta -= step
        if np.abs(step).max() < 1e-12:
            break
    got = np.append(model.coefficients.toArray(), model.intercept)
    assert np.allclose(got, beta, atol=1e-4, rtol=1e-4)


def test_split_sizes_with_null_and_many_labels(spark):
    from provisio.operators import score

    df = spark.range(30_000).select(F.col("id").alias("k"), F.when(F.col("id") % 3 > 0, F.col("id") % 2500).alias("label"))
    got = score.stratified_split(df, key="k", label="label")
    assert got.columns == ["k", "label", "is_test"] and got.count() == 30_000
    for r in got.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.count_if("is_test").alias("test")).collect():
        assert r.test == int(0.2 * r.n + 0.5)
    # the test rows are the first in hash order, also among NULL labels
    hot = got.where("label is null").withColumn("h", F.md5(F.concat_ws(":", F.lit("42"), F.col("k").cast("string")))).orderBy("h").collect()
    assert [r.is_test for r in hot] == [i < 2000 for i in range(len(hot))]


def test_split_computes_its_input_once(spark):
    from provisio.operators import score

    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = spark.range(2000).select(F.col("id").alias("k"), (F.col("id") % 2).alias("label")).mapInArrow(counted, "k long, label long")
    got = score.stratified_split(df, key="k", label="label")
    assert got.where("is_test").count() == 400 and got.where("not is_test").count() == 1600
    assert seen.value == 2000
    none = score.stratified_split(df.where("k < 0"), key="k", label="label")
    assert none.columns == ["k", "label", "is_test"] and none.count() == 0


def test_grade_mean_fill_equals_window(spark):
    from pyspark.sql import Window

    from provisio.operators import clean

    rc = clean.raw_cleaned_b(book_b.landing(spark, SF_SMOKE))
    a = clean.fill_by_group_mean(rc, "annual_income_raw", "grade", out="v")
    w = rc.withColumn("v", F.coalesce("annual_income_raw", F.avg("annual_income_raw").over(Window.partitionBy("grade"))))
    ra = {r.loan_id: r.v for r in a.select("loan_id", "v").collect()}
    rw = {r.loan_id: r.v for r in w.select("loan_id", "v").collect()}
    assert ra.keys() == rw.keys()
    assert all((ra[k] is None and rw[k] is None) or abs(ra[k] - rw[k]) <= 1e-6 * max(1.0, abs(rw[k])) for k in ra)
    assert any(r.annual_income_raw is None for r in rc.select("annual_income_raw").collect())


def test_stability_and_evidence_with_empty_bins(spark):
    from provisio.operators import monitoring as mon

    split = spark.createDataFrame([("a", "1", 0)] * 5 + [("b", "2", 0)] * 5, "bin string, period string, y int")
    assert mon.population_stability(split, "bin", F.col("period"), "1", "2").first()[0] > 1
    gone = mon.population_stability(split.where("period = '1'"), "bin", F.col("period"), "1", "2").first()[0]
    assert gone is not None
    assert {(r.bin, r.woe, r.iv) for r in mon.woe_iv(split, "bin", "y").collect()} == {("a", None, None), ("b", None, None)}


def test_repeated_keys_and_null_features_keep_their_rows(spark):
    from provisio.operators import explain

    f = spark.createDataFrame([("c", 0.1, 0.5, 1.0, 0), ("c", 0.3, 0.2, 1.0, 1), ("d", None, 0.2, 1.0, 0)],
                              "company_id string, revenue_growth double, debt_to_asset_ratio double, cash_flow_volatility double, past_default int")
    bg = explain.background_sample(f, "company_id", 5)
    assert len(bg) == 2
    got = explain.shapley_attributions(f, bg).collect()
    assert sorted(r.company_id for r in got) == ["c", "c", "d"]
    assert all((x.contribution is None) == (r.company_id == "d") for r in got for x in r.shapley)


def test_incomplete_rows_are_scored_as_missing(spark):
    from provisio.operators import score

    df = spark.range(200).select(F.col("id").alias("k"), F.when(F.col("id") % 10 > 0, F.col("id") / 200.0).alias("x"),
                                 (F.col("id") > 90).cast("int").alias("y"))
    model = score.fit_logistic(df, ["x"], "y")
    got = score.score_with_model(model, df, ["x"], out="pd", status="status").collect()
    assert len(got) == 200
    assert all((r.pd is None) == (r.k % 10 == 0) == (r.status == "incomplete") for r in got)
    g = score.objective_gradient(model, df, ["x"], "y").collect()
    assert all(abs(r.gradient) < 1e-5 for r in g)


def test_lookup_unknown_company_and_industry(spark):
    from provisio.operators import explain, score

    known = spark.createDataFrame([("HK_1", 0.1)], "company_id string, pd double")
    asked = spark.createDataFrame([("HK_1",), ("HK_9",)], "company_id string")
    got = {r.company_id: (r.lookup_status, r.pd) for r in explain.lookup(asked, known).collect()}
    assert got == {"HK_1": ("FOUND", 0.1), "HK_9": ("NOT_FOUND", None)}
    odd = spark.createDataFrame([("Mining",), (None,)], "industry string")
    for r in score.one_hot(odd, "industry", score.SME_INDUSTRIES).collect():
        assert sum(r) == 0


def test_queries_leave_a_users_table_alone(spark):
    from provisio.queries import queries

    spark.sql("drop table if exists clean_loans")
    spark.range(3).write.saveAsTable("clean_loans")
    try:
        queries()["s11_catalog_check"](spark, SF_SMOKE).collect()
        queries()["s10_idempotent_rebuild"](spark, SF_SMOKE).collect()
        assert spark.table("clean_loans").count() == 3
    finally:
        spark.sql("drop table clean_loans")
