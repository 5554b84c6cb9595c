"""Shapley values of boosted trees by leaf patterns against the coalition form."""

from itertools import permutations

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from provisio.operators import explain, score, tree_shapley as ts
from provisio.plans import models, sme
from provisio.queries import queries

SF_SMOKE = "/root/testdata/sf0.001"
COLUMNS = [c for _, group in explain.SME_PLAYERS for c in group]


@pytest.fixture(scope="module")
def fitted(spark):
    model, frame = models.gbt_sme(spark, SF_SMOKE, trees=12)
    return model, frame


def log_odds(spark, model, rows):
    """The model's own log-odds of many input rows."""
    from pyspark.ml.feature import VectorAssembler

    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(rows)], ["i", *COLUMNS])
    scored = model.setFeaturesCol("_features").transform(VectorAssembler(inputCols=COLUMNS, outputCol="_features").transform(df))
    got = scored.select("i", vector_to_array("rawPrediction")[1].alias("m")).orderBy("i").collect()
    return 2.0 * np.array([r.m for r in got])


def test_equals_the_coalition_form_on_fifty_companies(spark, fitted):
    model, frame = fitted
    population = frame.select(*COLUMNS).dropna().limit(60).collect()
    pop = spark.createDataFrame(population, frame.select(*COLUMNS).schema)
    background = np.array([tuple(map(float, r)) for r in population])
    companies = background[:50]
    owner = np.array([j for j, (_, g) in enumerate(explain.SME_PLAYERS) for _ in g])
    k = len(explain.SME_PLAYERS)
    mixed = np.concatenate([np.where((mask >> owner & 1) == 1, x, background) for x in companies for mask in range(1 << k)])
    value = log_odds(spark, model, mixed).reshape(len(companies), 1 << k, len(background)).mean(axis=2)
    want = np.zeros((len(companies), k))
    orders = list(permutations(range(k)))
    for order in orders:
        mask = 0
        for j in order:
            want[:, j] += value[:, mask | 1 << j] - value[:, mask]
            mask |= 1 << j
    want /= len(orders)
    got = ts.shapley_over_population(pop.limit(50), model, explain.SME_PLAYERS, pop).collect()
    assert {r.background_rows for r in got} == {60}
    assert got[0].expected_log_odds == pytest.approx(value[0, 0], abs=1e-9)
    by_row = {tuple(float(r[c]) for c in COLUMNS): [x.contribution for x in r.shapley] for r in got}
    for x, phi in zip(companies, want):
        assert by_row[tuple(x)] == pytest.approx(phi.tolist(), abs=1e-9)


def test_whole_population_sums_and_balance(spark, fitted):
    model, frame = fitted
    got = ts.shapley_over_population(frame, model, explain.SME_PLAYERS).collect()
    assert len(got) == frame.count()
    margins = log_odds(spark, model, [tuple(r[c] for c in COLUMNS) for r in got])
    for r, m in zip(got, margins):
        assert r.expected_log_odds + sum(x.contribution for x in r.shapley) == pytest.approx(m, abs=1e-9)
    for j in range(len(explain.SME_PLAYERS)):
        assert abs(np.mean([r.shapley[j].contribution for r in got])) < 1e-9


def test_missing_inputs_repeated_keys_and_an_empty_frame(spark, fitted):
    model, frame = fitted
    two = frame.limit(2).withColumn("company_id", F.lit("same"))
    hole = frame.limit(1).withColumn("revenue_growth", F.lit(None).cast("double"))
    df = two.unionByName(hole).withColumn("extra", F.lit("kept"))
    got = ts.shapley_over_population(df, model, explain.SME_PLAYERS).collect()
    assert len(got) == 3 and {r.background_rows for r in got} == {2} and {r.extra for r in got} == {"kept"}
    missing = [r for r in got if r.revenue_growth is None]
    assert len(missing) == 1 and all(x.contribution is None for x in missing[0].shapley)
    whole = [tuple(x.contribution for x in r.shapley) for r in got if r.revenue_growth is not None]
    assert all(c is not None for phi in whole for c in phi)
    assert ts.shapley_over_population(df.limit(0), model, explain.SME_PLAYERS).count() == 0


def test_table_size_depends_on_the_model_alone(fitted):
    model, frame = fitted
    paths = ts.paths_of(model, explain.SME_PLAYERS)
    assert len(paths.leaves) <= 12 * 16 and paths.patterns <= 16
    small, big = frame.limit(10), frame.union(frame).union(frame)
    assert ts.pattern_counts(small, paths)[0].shape == ts.pattern_counts(big, paths)[0].shape


def test_reports_read_one_written_result(spark):
    first = models.attributed_by_population(spark, SF_SMOKE, trees=3)
    second = models.attributed_by_population(spark, SF_SMOKE, trees=3)
    assert first.inputFiles() == second.inputFiles()
    other = models.attributed_by_population(spark, SF_SMOKE, trees=2)
    assert set(other.inputFiles()).isdisjoint(first.inputFiles())
