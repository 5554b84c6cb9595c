"""Model monitoring described by the reference's documentation (E-1 … E-11).

Each is one scan with conditional aggregates, or a ranked pass with the
range-partitioned row number (deciles), never a one-task window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.scalars import col_

# ---- fixed values: monitoring parameters ----
N_DECILES = 10
PR_THRESHOLDS = (0.02, 0.05, 0.1, 0.2, 0.5)


def deciles(df: DataFrame, score: str, key: str, *, n: int = N_DECILES, out: str = "decile") -> DataFrame:
    """``ntile(n) over (order by score, key)`` without a sort: bucket sizes
    differ by at most one, the first buckets are the larger. The scores at the
    n - 1 cuts come from two scans (:mod:`.quantiles`); only where a cut falls
    between rows of one score, that score's keys are counted too. Rows get
    their bucket by a narrow comparison. NULL scores come first, NaN last."""
    from ..sources.tables import land
    from .quantiles import exact_ranks
    from .selection import before_and_at, nth

    spark, s = df.sparkSession, F.col(score)
    stored = spark.read.parquet(land(df.select(score, key), name="scores"))
    rows, nulls, values = stored.agg(F.count(F.lit(1)), F.count_if(s.isNull()),
                                     F.count_if(s.isNotNull() & ~F.isnan(s.cast("double")))).first()
    q, rem = divmod(rows, n)
    cuts = [i * q + min(i, rem) for i in range(1, n)]
    found = exact_ranks(stored, {score: [c - nulls for c in cuts]}, {score: values})[score]
    bucket = F.lit(1)
    for cut in cuts:
        if cut == 0:                                         # fewer rows than buckets: none lies before
            bucket = bucket + 1
            continue
        rank = found.get(cut - nulls)
        if rank is not None and rank.before + rank.at == cut - nulls:
            before, same = before_and_at(df, [score], (rank.value,))
        else:                                                # the cut is inside the rows of one score
            tied, place = ((stored.where(s == rank.value), cut - nulls - rank.before) if rank is not None
                           else (stored.where(s.isNull()), cut) if cut <= nulls else (stored.where(F.isnan(s.cast("double"))), cut - nulls - values))
            before, same = before_and_at(df, [score, key], nth(tied, [score, key], place).values)
        bucket = bucket + F.when(before | same, 0).otherwise(1)
    return df.withColumn(out, bucket.cast("int"))


def calibration_table(df: DataFrame, score: str, label: str, key: str) -> DataFrame:
    """E-1: per score decile — rows, mean predicted PD, observed default rate."""
    d = deciles(df.select(key, score, label), score, key)
    return d.groupBy("decile").agg(F.count(F.lit(1)).alias("n"), F.avg(score).alias("avg_pd"),
                                   F.avg(label).alias("default_rate"))


def brier_score(df: DataFrame, score: str, label: str) -> DataFrame:
    """E-1: mean squared error of the PD against the 0/1 outcome."""
    return df.agg(F.avg((F.col(score) - F.col(label)) ** 2).alias("brier"))


def threshold_table(df: DataFrame, score: str, label: str, thresholds: Sequence[float] = PR_THRESHOLDS) -> DataFrame:
    """E-2: precision and recall of ``score > t`` for several thresholds —
    all thresholds counted in one scan, then unpivoted (one row each)."""
    s, y = F.col(score), F.col(label)
    aggs = []
    for i, t in enumerate(thresholds):
        aggs += [F.count_if((s > t) & (y == 1)).alias(f"tp{i}"), F.count_if((s > t) & (y == 0)).alias(f"fp{i}"),
                 F.count_if((s <= t) & (y == 1)).alias(f"fn{i}")]
    c = df.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(t).alias("threshold"),
                              F.coalesce(F.try_divide(F.col(f"tp{i}").cast("double"), F.col(f"tp{i}") + F.col(f"fp{i}")),
                                         F.lit(0.0)).alias("precision"),
                              F.coalesce(F.try_divide(F.col(f"tp{i}").cast("double"), F.col(f"tp{i}") + F.col(f"fn{i}")),
                                         F.lit(0.0)).alias("recall"))
                     for i, t in enumerate(thresholds)])
    return c.select(F.explode(rows).alias("r")).select("r.*")


def predicted_vs_actual(df: DataFrame, score: str, label: str, segment: str) -> DataFrame:
    """E-3: mean predicted PD vs observed default rate, per segment and for
    the portfolio (ROLLUP, one scan)."""
    agg = df.rollup(segment).agg(F.count(F.lit(1)).alias("n"), F.avg(score).alias("predicted_rate"),
                                 F.avg(label).alias("actual_rate"), F.grouping_id().alias("_g"))
    return agg.select(F.when(F.col("_g") == 1, "portfolio").otherwise("segment").alias("level"),
                      F.col(segment).alias("segment"), "n", "predicted_rate", "actual_rate")


def misclassification_cost(df: DataFrame, score: str, label: str, amount: str, *, threshold: float = 0.5,
                           lgd: float = 0.45, margin: Column | None = None) -> DataFrame:
    """E-4: cost of missed defaults (amount·LGD) and of wrongly refused good
    loans (amount·margin) at a decision threshold."""
    s, y, a = F.col(score), F.col(label), F.col(amount)
    m = margin if margin is not None else F.lit(0.05)
    return df.agg(F.count_if((s <= threshold) & (y == 1)).alias("false_negatives"),
                  F.count_if((s > threshold) & (y == 0)).alias("false_positives"),
                  F.sum(F.when((s <= threshold) & (y == 1), a * lgd).otherwise(0.0)).alias("fn_cost"),
                  F.sum(F.when((s > threshold) & (y == 0), a * m).otherwise(0.0)).alias("fp_cost"))


def _shares(counts: Column, smoothing: float) -> Column:
    """Each bin's share over all bins, with ``smoothing`` added to every bin's
    count. NULL when there is nothing to share."""
    every = Window.partitionBy()          # over the few bin rows
    return F.try_divide((counts + F.lit(smoothing)).cast("double"),
                        (F.sum(counts).over(every) + F.lit(smoothing) * F.count(F.lit(1)).over(every)).cast("double"))


def population_stability(df: DataFrame, bin_col: str, period: Column, expected: str, actual: str, *,
                         smoothing: float = 0.5) -> DataFrame:
    """E-5: PSI Σ (a − e)·ln(a / e) of the bin shares between two periods, one
    scan. ``smoothing`` is added to every bin's count in both periods, so a
    bin that is empty in one of them (the strongest drift) counts and the
    index is always defined."""
    if smoothing <= 0:
        raise ValueError("smoothing must be positive: an empty bin has no logarithm")
    p = col_(period)
    per_bin = df.groupBy(bin_col).agg(F.count_if(p == expected).alias("_e"), F.count_if(p == actual).alias("_a"))
    shares = per_bin.select(_shares(F.col("_e"), smoothing).alias("e"), _shares(F.col("_a"), smoothing).alias("a"))
    return shares.agg(F.sum((F.col("a") - F.col("e")) * F.ln(F.try_divide("a", "e"))).alias("psi"))


def importance_ranks(df: DataFrame, contributions: dict[str, Column], period: Column, periods: Sequence[str]) -> DataFrame:
    """E-6: mean |contribution| per feature and period, and each feature's
    importance rank in each period (one scan; the ranking is over the
    handful of feature rows)."""
    p = col_(period)
    aggs = [F.avg(F.when(p == per, F.abs(c))).alias(f"{name}|{per}") for name, c in contributions.items()
            for per in periods]
    wide = df.agg(*aggs)
    items = F.array(*[F.struct(F.lit(name).alias("feature"), F.lit(per).alias("period"),
                               F.col(f"`{name}|{per}`").alias("importance"))
                      for name in contributions for per in periods])
    long = wide.select(F.explode(items).alias("r")).select("r.*")
    w = Window.partitionBy("period").orderBy(F.col("importance").desc(), F.col("feature"))
    return long.withColumn("importance_rank", F.row_number().over(w).cast("int"))


def woe_iv(df: DataFrame, bin_col: str, label: str, *, smoothing: float = 0.0) -> DataFrame:
    """E-8: weight of evidence per bin ln(good share / bad share) and the
    bin's information value (good share − bad share)·WoE, one scan. Without
    ``smoothing`` a bin with no goods or no bads has NULL for both."""
    per = df.groupBy(bin_col).agg(F.count_if(F.col(label) == 0).alias("good"), F.count_if(F.col(label) == 1).alias("bad"))
    s = per.select(bin_col, "good", "bad", _shares(F.col("good"), smoothing).alias("gs"), _shares(F.col("bad"), smoothing).alias("bs"))
    woe = F.when((F.col("gs") > 0) & (F.col("bs") > 0), F.ln(F.try_divide("gs", "bs")))
    return s.select(bin_col, "good", "bad", woe.alias("woe"), ((F.col("gs") - F.col("bs")) * woe).alias("iv"))


def fairness_by_group(df: DataFrame, group: str, label: str, pred: str) -> DataFrame:
    """E-9: approval rate (predicted non-default) per group and its ratio to
    the best group (disparate impact); true/false positive rates (equalised odds)."""
    y, p = F.col(label), F.col(pred)
    per = df.groupBy(group).agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.when(p == 0, 1.0).otherwise(0.0)).alias("approval_rate"),
        F.try_divide(F.count_if((p == 1) & (y == 1)).cast("double"), F.count_if(y == 1)).alias("tpr"),
        F.try_divide(F.count_if((p == 1) & (y == 0)).cast("double"), F.count_if(y == 0)).alias("fpr"))
    best = F.max("approval_rate").over(Window.partitionBy())     # over the few group rows
    return per.withColumn("disparate_impact", F.try_divide(F.col("approval_rate"), best))


def counterfactual_pd(df: DataFrame, pd_fn, features: Sequence[str], shift: float) -> DataFrame:
    """E-10: PD when one input moves by ``shift`` (relative), one row per
    entity and feature; every variant is computed from the same row."""
    base = pd_fn({f: F.col(f) for f in features})
    variants = []
    for f in features:
        moved = {g: (F.col(g) * (1.0 + shift) if g == f else F.col(g)) for g in features}
        variants.append(F.struct(F.lit(f).alias("feature"), pd_fn(moved).alias("pd_counterfactual")))
    return df.select("*", base.alias("pd_base"), F.explode(F.array(*variants)).alias("_cf")) \
        .select("*", "_cf.*").drop("_cf")


def weighted_vote(scores: Sequence[Column], weights: Sequence[float]) -> Column:
    """E-11: weighted mean of several PD scores (weights normalised)."""
    total = float(sum(weights))
    expr = None
    for s, w in zip(scores, weights):
        term = s * F.lit(w / total)
        expr = term if expr is None else expr + term
    return expr
