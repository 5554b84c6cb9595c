"""Scoring (M-1 … M-6, M-10, M-11): fixed-coefficient PDs, the seeded
stratified split, and the Spark ML models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.scalars import col_, sigmoid
from ..sources.tables import sample_key
from .sizing import checked_broadcast

# Fixed coefficients of the two generating formulas (fixed values).
LOAN_PD_COEF = {"intercept": -3.0, "dti": 2.0, "fico": -0.01, "amount": 0.0001}
SME_PD_COEF = {"intercept": -3.0, "revenue_growth": -2.0, "debt_to_asset_ratio": 3.5,
               "cash_flow_volatility": 0.8, "past_default": 1.5}
SME_NUMERIC = ["revenue_growth", "debt_to_asset_ratio", "cash_flow_volatility", "past_default"]
SME_INDUSTRIES = ["Manufacturing", "Retail", "Services", "Tech"]   # one-hot order (alphabetical)
LIFETIME_FACTOR = 1.2
MODEL_VERSION = "v1.0"


def loan_logit_fixed(dti: str | Column, fico: str | Column, amount: str | Column) -> Column:
    c = LOAN_PD_COEF
    return F.lit(c["intercept"]) + F.lit(c["dti"]) * col_(dti) + F.lit(c["fico"]) * col_(fico) \
        + F.lit(c["amount"]) * col_(amount)


def pd_loans_fixed(dti: str | Column, fico: str | Column, amount: str | Column) -> Column:
    """M-1: σ(−3 + 2·dti − 0.01·fico + 0.0001·amount). NULL inputs give a NULL PD."""
    return sigmoid(loan_logit_fixed(dti, fico, amount))


def sme_logit_fixed(rg: str | Column, dta: str | Column, cfv: str | Column, past: str | Column) -> Column:
    c = SME_PD_COEF
    return (F.lit(c["intercept"]) + F.lit(c["revenue_growth"]) * col_(rg)
            + F.lit(c["debt_to_asset_ratio"]) * col_(dta) + F.lit(c["cash_flow_volatility"]) * col_(cfv)
            + F.lit(c["past_default"]) * col_(past))


def pd_sme_fixed(rg: str | Column, dta: str | Column, cfv: str | Column, past: str | Column) -> Column:
    """M-2: σ(−3 − 2·growth + 3.5·debt/asset + 0.8·volatility + 1.5·past default)."""
    return sigmoid(sme_logit_fixed(rg, dta, cfv, past))


def score_loans_fixed(features: DataFrame, *, pd_col: str = "pd") -> DataFrame:
    """Score every loan in place (keeps the key; no positional matching)."""
    return features.withColumn(pd_col, pd_loans_fixed("dti_ratio", "fico_score", "loan_amount"))


def lifetime_pd(pd_12m: str | Column, factor: float = LIFETIME_FACTOR, cap: bool = False) -> Column:
    """M-6: lifetime PD = 12-month PD × 1.2; may exceed 1 unless ``cap``."""
    v = col_(pd_12m) * F.lit(factor)
    return F.least(v, F.lit(1.0)) if cap else v


def predictions_b(scored: DataFrame, *, pd_col: str = "pd_12m", version: str = MODEL_VERSION) -> DataFrame:
    """``loan_predictions`` of profile B (M-6, S-16)."""
    return scored.select("loan_id", F.col(pd_col).alias("pd_12m"),
                         lifetime_pd(pd_col).alias("pd_lifetime"),
                         F.lit(version).alias("model_version"))


# ---------------- M-3 stratified split ----------------
PREFIX_DIGITS = 4       # hex digits of the hash that rows are counted by


def stratified_split(df: DataFrame, *, key: str, label: str, test_fraction: float = 0.2,
                     seed: int = 42, out: str = "is_test") -> DataFrame:
    """M-3: seeded stratified split with exact sizes: per label (NULL is a
    label too), the ``floor(test_fraction·n_label + 1/2)`` rows first in
    md5(seed:key) order are test. ``key`` is unique.

    ``df`` is computed and written once, with its hash; select the columns that
    are needed before. Counts, cuts and the result read the written rows, so a
    result that is read again (training, scoring, evaluation) costs a scan.
    Rows are counted per (label, hash prefix), one partial aggregate; the
    prefix whose running count reaches a label's test size holds its cut, and
    only the rows of that prefix are ranked (a label's rows over
    16^``PREFIX_DIGITS``), so a label holding most rows is never ranked as a
    whole. The full-width rows are flagged by comparing with their label's
    cut: one row per label, broadcast behind a size check, joined NULL-safe.
    """
    from ..sources.tables import land

    keyed = df.sparkSession.read.parquet(land(df.withColumn("_split_h", sample_key(seed, key)), name="split"))
    slim = keyed.select(F.col(label).alias("_cut_label"), F.col("_split_h").alias("_cut_h"), F.col(key).alias("_cut_key"),
                        F.substring("_split_h", 1, PREFIX_DIGITS).alias("_prefix"))
    per_prefix = slim.groupBy("_cut_label", "_prefix").agg(F.count(F.lit(1)).alias("_n"))
    of_label = Window.partitionBy("_cut_label")              # at most 16^PREFIX_DIGITS rows a label
    upto = F.sum("_n").over(of_label.orderBy("_prefix").rowsBetween(Window.unboundedPreceding, 0))
    size = F.floor(F.lit(test_fraction) * F.sum("_n").over(of_label) + 0.5)
    at = per_prefix.withColumn("_upto", upto).withColumn("_size", size) \
        .where((F.col("_upto") >= F.col("_size")) & (F.col("_upto") - F.col("_n") < F.col("_size"))) \
        .select(F.col("_cut_label").alias("_at_label"), F.col("_prefix").alias("_at_prefix"),
                (F.col("_size") - F.col("_upto") + F.col("_n")).alias("_place"))
    near = slim.join(checked_broadcast(at), F.col("_cut_label").eqNullSafe(F.col("_at_label"))
                     & (F.col("_prefix") == F.col("_at_prefix")))
    rank = F.row_number().over(Window.partitionBy("_cut_label").orderBy("_cut_h", "_cut_key"))
    cut = near.withColumn("_rank", rank).where(F.col("_rank") == F.col("_place")).select("_cut_label", "_cut_h", "_cut_key")
    joined = keyed.join(checked_broadcast(cut), F.col(label).eqNullSafe(F.col("_cut_label")), "left")
    h, k = F.col("_split_h"), F.col(key)
    flag = (h < F.col("_cut_h")) | ((h == F.col("_cut_h")) & (k <= F.col("_cut_key")))
    return joined.withColumn(out, F.coalesce(flag, F.lit(False))) \
        .drop("_split_h", "_cut_label", "_cut_h", "_cut_key")


# ---------------- M-10 one-hot ----------------
def one_hot(df: DataFrame, column: str, categories: Sequence[str], *, prefix: str | None = None,
            drop_source: bool = True) -> DataFrame:
    """M-10: one 0/1 double column per known category; an unknown category
    gives all zeros."""
    p = prefix if prefix is not None else f"{column}_"
    cols = [F.when(F.col(column) == cat, 1.0).otherwise(0.0).alias(f"{p}{cat}") for cat in categories]
    out = df.select("*", *cols)
    return out.drop(column) if drop_source else out


# ---------------- Spark ML (M-4, M-5, M-11) ----------------
def _complete(features: Sequence[str]) -> Column:
    """Whether every model input is present (not NULL, not NaN)."""
    ok = F.lit(True)
    for f in features:
        ok = ok & F.col(f).isNotNull() & ~F.isnan(F.col(f).cast("double"))
    return ok


def _assembled(train: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """Complete labelled rows with a feature vector; others cannot train."""
    from pyspark.ml.feature import VectorAssembler

    rows = train.where(_complete(features) & F.col(label).isNotNull()).withColumn(label, F.col(label).cast("double"))
    return VectorAssembler(inputCols=list(features), outputCol="_features", handleInvalid="error").transform(rows)


def fit_logistic(train: DataFrame, features: Sequence[str], label: str, *, max_iter: int = 1000):
    """M-4: L2 logistic regression matching the default scikit-learn
    objective (C = 1, free intercept): ``regParam = 1/n`` without
    standardisation. Training is distributed (tree aggregation) and uses the
    complete rows."""
    from pyspark.ml.classification import LogisticRegression

    assembled = _assembled(train, features, label)
    n = assembled.count()
    lr = LogisticRegression(featuresCol="_features", labelCol=label, maxIter=max_iter,
                            regParam=1.0 / max(n, 1), elasticNetParam=0.0, standardization=False,
                            tol=1e-9, fitIntercept=True)
    return lr.fit(assembled)


def objective_gradient(model, train: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """Per coefficient the gradient of the M-4 objective at the fitted model,
    and the mean size of its input as a yardstick: one aggregate over the
    complete training rows, one row per feature (and the intercept)."""
    rows = train.where(_complete(features) & F.col(label).isNotNull())
    beta = [float(c) for c in model.coefficients.toArray()]
    z = F.lit(float(model.intercept))
    for f, c in zip(features, beta):
        z = z + F.lit(c) * F.col(f)
    miss = sigmoid(z) - F.col(label)
    inputs = [("intercept", F.lit(1.0), 0.0)] + [(f, F.col(f).cast("double"), c) for f, c in zip(features, beta)]
    sums = rows.agg(F.count(F.lit(1)).alias("n"), *[F.avg(miss * x).alias(f"g{i}") for i, (_, x, _) in enumerate(inputs)],
                    *[F.avg(F.abs(x)).alias(f"m{i}") for i, (_, x, _) in enumerate(inputs)])
    out = F.array(*[F.struct(F.lit(name).alias("feature"), (F.col(f"g{i}") + F.lit(c) / F.col("n")).alias("gradient"),
                             F.col(f"m{i}").alias("input_size")) for i, (name, _, c) in enumerate(inputs)])
    return sums.select(F.explode(out).alias("r")).select("r.*")


SCORED, INCOMPLETE = "scored", "incomplete"


def score_with_model(model, df: DataFrame, features: Sequence[str], *, out: str = "pd",
                     status: str | None = None) -> DataFrame:
    """M-5: score every row and keep all input columns (the key travels with
    the row, so no positional alignment is needed). A row with a missing input
    stays, with a NULL score; ``status`` names a column that says so."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array

    filled = {f: f"_in_{f}" for f in features}
    complete = _complete(features)
    ready = df.select("*", complete.alias("_complete"),
                      *[F.when(complete, F.col(f).cast("double")).otherwise(0.0).alias(c) for f, c in filled.items()])
    assembled = VectorAssembler(inputCols=list(filled.values()), outputCol="_features", handleInvalid="error").transform(ready)
    scored = model.transform(assembled).withColumn(
        out, F.when(F.col("_complete"), vector_to_array(F.col("probability"))[1]))
    if status:
        scored = scored.withColumn(status, F.when(F.col("_complete"), SCORED).otherwise(INCOMPLETE))
    return scored.drop("_features", "rawPrediction", "probability", "prediction", "_complete", *filled.values())


def fit_gbt(train: DataFrame, features: Sequence[str], label: str, *, trees: int = 100, depth: int = 4,
            rate: float = 0.1, positive_weight: float = 10.0, seed: int = 42):
    """M-11: gradient-boosted trees (100 trees, depth 4, rate 0.1), positives
    weighted ``positive_weight`` (1.0 reproduces the unweighted branch)."""
    from pyspark.ml.classification import GBTClassifier

    weighted = _assembled(train, features, label).withColumn("_w", F.when(F.col(label) == 1, positive_weight).otherwise(1.0))
    gbt = GBTClassifier(featuresCol="_features", labelCol=label, weightCol="_w", maxIter=trees,
                        maxDepth=depth, stepSize=rate, seed=seed)
    return gbt.fit(weighted)


def sme_model_frame(features: DataFrame) -> DataFrame:
    """SME design matrix: numeric features passed through + industry one-hot."""
    return one_hot(features, "industry", SME_INDUSTRIES, drop_source=False)


SME_MODEL_FEATURES = SME_NUMERIC + [f"industry_{c}" for c in SME_INDUSTRIES]
