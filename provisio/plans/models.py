"""Trained-model flows (M-3 split, M-4/M-5 logistic regression, M-11 boosted
trees) from the features through scoring and staging to the reports.

Splits and predictions are written to the shared folder once: training,
evaluation and staging read the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import evaluate, features as feat, reports, score, staging
from ..sources.tables import land
from . import book_a, book_b, sme


def _landed(df: DataFrame, name: str) -> DataFrame:
    return df.sparkSession.read.parquet(land(df, name=name))


def written_once(spark: SparkSession, key: tuple, build) -> DataFrame:
    """The frame ``build`` makes, written to the shared folder the first time
    ``key`` is asked for in this application, and read from there afterwards
    (until ``clear_scratch`` removes it)."""
    from ..session import scratch_paths

    held = _WRITTEN.get((spark.sparkContext.applicationId, *key))
    if held is None or held not in scratch_paths():
        held = land(build(), name=key[0])
        _WRITTEN[(spark.sparkContext.applicationId, *key)] = held
    return spark.read.parquet(held)


_WRITTEN: dict[tuple, str] = {}


def split_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profile B's loans with label, PD and the seeded stratified split flag."""
    scored = book_b.scored(spark, sf_dir).select("loan_id", "default_flag", "pd_12m")
    return score.stratified_split(scored, key="loan_id", label="default_flag")


def logistic_b(spark: SparkSession, sf_dir: str):
    """M-4 on profile B's encoded features, trained on the 80 % split; with all rows."""
    enc = feat.encode_b(book_b.features(spark, sf_dir))
    split = score.stratified_split(enc, key="loan_id", label="default_flag")
    return score.fit_logistic(split.where(~F.col("is_test")), feat.B_MODEL_FEATURES, "default_flag"), split


def logistic_a(spark: SparkSession, sf_dir: str):
    """M-4 on profile A's encoded features, trained on the complete rows of
    the 80 % split; with all rows (an undefined ratio is scored as missing)."""
    enc = feat.encode_a(book_a.features(spark, sf_dir))
    split = score.stratified_split(enc, key="loan_id", label="default_flag")
    return score.fit_logistic(split.where(~F.col("is_test")), feat.A_MODEL_FEATURES, "default_flag"), split


def scored_by_model_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M-5 / J-2: every loan with the trained model's PD and a status."""
    model, split = logistic_a(spark, sf_dir)
    return score.score_with_model(model, split, feat.A_MODEL_FEATURES, out="pd", status="status")


def scored_by_model_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M-5: every loan scored by the trained model, keyed by loan id."""
    model, split = logistic_b(spark, sf_dir)
    return score.score_with_model(model, split, feat.B_MODEL_FEATURES, out="pd_12m", status="status")


def staged_by_model_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profile A end to end on the trained model: the predictions are written
    as their own table and joined back to the features (J-1) for staging."""
    preds = _landed(scored_by_model_a(spark, sf_dir).select("loan_id", "pd", "status", "is_test"), "loan_predictions_a")
    staged = staging.staging_a_from_tables(book_a.features(spark, sf_dir), preds)
    return staged.join(preds.select("loan_id", "status", "is_test"), "loan_id")


def staged_by_model_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profile B end to end on the trained model, with lifetime PD in stage 2."""
    scored = scored_by_model_b(spark, sf_dir)
    preds = _landed(score.predictions_b(scored), "loan_predictions_b")
    return staging.staging_b(book_b.features(spark, sf_dir), preds)


def run_a(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Profile A's reports on the trained model."""
    st = _landed(staged_by_model_a(spark, sf_dir), "loan_staging_a")
    summary = _landed(reports.stage_summary(st), "stage_summary_a")
    return {"staging": st, "stage_distribution": reports.stage_distribution_from(summary),
            "portfolio_by_stage": reports.portfolio_by_stage_from(summary),
            "portfolio_overall": reports.portfolio_overall_from(summary),
            "staging_sample": reports.staging_sample(st), "top_ecl": reports.top_ecl(st)}


def run_b(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Profile B's reports on the trained model."""
    st = _landed(staged_by_model_b(spark, sf_dir), "loan_staging_b")
    summary = _landed(reports.stage_summary(st, pd_col="pd_12m"), "stage_summary_b")
    return {"staging": st, "stage_distribution": reports.stage_distribution_from(summary, with_description=True),
            "portfolio_by_stage": reports.portfolio_by_stage_from(summary),
            "portfolio_overall": reports.portfolio_overall_from(summary, count_defaulted=False)}


def gbt_sme(spark: SparkSession, sf_dir: str, **fit):
    """M-11 on the SME design matrix (numeric + one-hot industry); with all rows."""
    frame = score.sme_model_frame(sme.features(spark, sf_dir))
    split = score.stratified_split(frame, key="company_id", label="true_label")
    return score.fit_gbt(split.where(~F.col("is_test")), score.SME_MODEL_FEATURES, "true_label", **fit), split


def attributed_by_trees(spark: SparkSession, sf_dir: str, background_rows: int, **fit) -> DataFrame:
    """Companies scored by the trees (M-11) with their exact Shapley values
    against ``background_rows`` companies (M-13) as the attribution array; expected_pd is
    the background's mean score, population_pd that of all companies."""
    from ..operators import explain

    model, split = gbt_sme(spark, sf_dir, **fit)
    # companies that share an id stay apart: a written row number is the key
    split = _landed(split.withColumn("_company", F.monotonically_increasing_id()), "numbered_sme")
    scored = score.score_with_model(model, split, score.SME_MODEL_FEATURES, out="predicted_default_prob")
    shap = explain.shapley_for_model(split, model, explain.SME_PLAYERS, explain.model_background(split, "company_id", background_rows), key="_company")
    population = scored.agg(F.avg("predicted_default_prob")).first()[0]
    return _landed(scored.join(shap.withColumnRenamed("shapley", "attributions"), "_company").drop("_company")
                   .withColumn("population_pd", F.lit(population)), "attributed_by_trees")


def attributed_by_population(spark: SparkSession, sf_dir: str, **fit) -> DataFrame:
    """Companies scored by the trees (M-11) with the exact Shapley values of
    their log-odds against the whole population (M-13). The factor table, the
    memo and the chart read this one written result (R-7, R-9, R-16)."""
    from ..operators import explain, tree_shapley

    def build() -> DataFrame:
        model, split = gbt_sme(spark, sf_dir, **fit)
        scored = score.score_with_model(model, split, score.SME_MODEL_FEATURES, out="predicted_default_prob")
        return tree_shapley.shapley_over_population(scored, model, explain.SME_PLAYERS, out="attributions")

    return written_once(spark, ("attributed_by_population", sf_dir, *sorted(fit.items())), build)


def evaluation_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test rows of profile B with label, score and hard prediction."""
    return _evaluation(split_b(spark, sf_dir))


def evaluation_by_model_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same of the trained model."""
    return _evaluation(scored_by_model_b(spark, sf_dir))


def _evaluation(scored: DataFrame) -> DataFrame:
    return scored.where(F.col("is_test")).select("loan_id", F.col("default_flag").alias("y"), F.col("pd_12m").alias("s"),
                                                 evaluate.hard_prediction("pd_12m").alias("yhat"))
