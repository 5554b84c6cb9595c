"""The tree attributions' background: its size, and its mean next to the population's."""

import pytest

from provisio.plans import models
from provisio.queries import q_models

SF_SMOKE = "/root/testdata/sf0.001"


def test_background_of_a_hundred_and_population_mean(spark):
    assert q_models.TREE_BACKGROUND >= 100
    rows = models.attributed_by_trees(spark, SF_SMOKE, q_models.TREE_BACKGROUND, trees=3).collect()
    assert {r.background_rows for r in rows} == {q_models.TREE_BACKGROUND}
    mean = sum(r.predicted_default_prob for r in rows) / len(rows)
    assert all(r.population_pd == pytest.approx(mean, abs=1e-12) for r in rows)


def _trees_and_rows(spark):
    """Trees on values of two digits, and rows whose values lie between the same thresholds."""
    from pyspark.sql import functions as F

    from provisio.operators import explain, score

    n = lambda i, m: F.pmod(F.xxhash64(F.lit(i), "id"), F.lit(m))
    frame = spark.range(400).select(
        F.concat(F.lit("HK_"), "id").alias("company_id"), (n(1, 40) / 10).alias("revenue_growth"), (n(2, 10) / 10).alias("debt_to_asset_ratio"),
        (n(3, 30) / 10).alias("cash_flow_volatility"), (n(4, 2)).cast("int").alias("past_default"),
        F.element_at(F.array(*[F.lit(c) for c in score.SME_INDUSTRIES]), (n(5, 4) + 1).cast("int")).alias("industry"))
    frame = score.sme_model_frame(frame).withColumn("true_label", (F.col("revenue_growth") + F.col("past_default") < F.col("cash_flow_volatility")).cast("int"))
    return frame.localCheckpoint(), score.fit_gbt(frame, score.SME_MODEL_FEATURES, "true_label", trees=5), explain


def test_shapley_for_model_is_the_sum_over_coalitions(spark):
    from math import factorial

    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array
    from pyspark.sql import functions as F

    frame, model, explain = _trees_and_rows(spark)
    cols = [c for _, group in explain.SME_PLAYERS for c in group]
    owner = [j for j, (_, group) in enumerate(explain.SME_PLAYERS) for _ in group]
    bg = explain.model_background(frame, "company_id", 6)
    few = frame.limit(12).unionByName(frame.limit(2)).unionByName(frame.limit(1).withColumn("revenue_growth", F.lit(None).cast("double"))).localCheckpoint()
    rows = {r.company_id: [float(r[c]) for c in cols] for r in few.collect() if r.revenue_growth is not None}
    mixes = [(i, m, *[x[a] if m >> owner[a] & 1 else float(b[c]) for a, c in enumerate(cols)]) for i, x in rows.items() for m in range(32) for b in bg]
    scored = model.setFeaturesCol("_f").transform(VectorAssembler(inputCols=cols, outputCol="_f").transform(
        spark.createDataFrame(mixes, ["id", "m", *cols]))).groupBy("id", "m").agg(F.avg(vector_to_array("probability")[1]).alias("v")).collect()
    v = {(r.id, r.m): r.v for r in scored}
    w = [factorial(s) * factorial(4 - s) / factorial(5) for s in range(5)]
    got = explain.shapley_for_model(few, model, explain.SME_PLAYERS, bg).collect()
    assert len(got) == 15 and sum(r.expected_pd is None for r in got) == 1
    for r in got:
        if r.expected_pd is None:
            assert all(s.contribution is None for s in r.shapley)
            continue
        for j, s in enumerate(r.shapley):
            want = sum(w[bin(m).count("1")] * (v[r.company_id, m | 1 << j] - v[r.company_id, m]) for m in range(32) if not m >> j & 1)
            assert s.contribution == pytest.approx(want, abs=1e-12)
        assert r.expected_pd == pytest.approx(v[r.company_id, 0], abs=1e-12) and r.background_rows == 6


def test_scored_coalitions_are_bounded_by_the_thresholds(spark, monkeypatch):
    """Ten times the rows, all between the same thresholds, are scored no more often."""
    from pyspark.ml.classification import GBTClassificationModel
    from pyspark.sql import functions as F

    frame, model, explain = _trees_and_rows(spark)
    bg = explain.model_background(frame, "company_id", 6)
    plain, counts = GBTClassificationModel.transform, []

    def counted(self, dataset, params=None):
        counts.append(dataset.count())
        return plain(self, dataset)

    monkeypatch.setattr(GBTClassificationModel, "transform", counted)
    more = frame.crossJoin(spark.range(10).select((F.col("id") * 1e-9).alias("_by")))
    for c in ("revenue_growth", "cash_flow_volatility"):       # lower values stay on their side of a threshold
        more = more.withColumn(c, F.col(c) - F.col("_by"))
    for rows, n in ((frame, 400), (more.drop("_by"), 4000)):
        assert explain.shapley_for_model(rows, model, explain.SME_PLAYERS, bg).count() == n
    assert counts[1] == counts[0] < 400 * 6 * 32 / 2
