"""Rolling back-test (E-7) and a vote of several models (E-11).

A fold is a cut date: its model is trained on the rows before the cut and
tested on those from the cut to the next one. All folds are fitted together by
Newton's method: a round is one aggregate that gives every fold's gradient and
Hessian sums (a handful of numbers a fold), and the driver solves one small
system a fold. A row is read once a round, whatever the number of folds.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.scalars import sigmoid

ROUNDS = 25
TOLERANCE = 1e-10        # of the largest step, relative to 1 + the largest coefficient


def _complete(features: Sequence[str]) -> Column:
    out = F.lit(True)
    for f in features:
        out = out & F.col(f).isNotNull()
    return out


def _logit(beta: np.ndarray, inputs: Sequence[Column]) -> Column:
    """The linear score with a row's fold's coefficients (``_fold`` indexes them)."""
    out = F.lit(0.0)
    for j, x in enumerate(inputs):
        out = out + F.get(F.array(*[F.lit(float(b)) for b in beta[:, j]]), F.col("_fold")) * x
    return out


def fit_folds(df: DataFrame, features: Sequence[str], label: str, period: str, cuts: Sequence[str]) -> np.ndarray:
    """(folds x 1 + features): intercept and coefficients of every fold's L2
    logistic regression (the M-4 objective: C = 1, free intercept), trained on
    the complete rows with ``period`` before its cut. A fold without rows of
    both labels keeps zeros."""
    inputs = [F.lit(1.0), *[F.col(f).cast("double") for f in features]]
    k = len(inputs)
    folds = F.filter(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(c).alias("cut")) for i, c in enumerate(cuts)]),
                     lambda f: F.col(period) < f["cut"])
    rows = (df.where(_complete(features) & F.col(label).isNotNull() & F.col(period).isNotNull())
            .select(F.col(label).cast("double").alias("_y"), *[x.alias(f"_x{j}") for j, x in enumerate(inputs)], F.explode(folds.getField("i")).alias("_fold")))
    xs = [F.col(f"_x{j}") for j in range(k)]
    beta = np.zeros((len(cuts), k))
    scale = np.diag([0.0] + [1.0] * (k - 1))             # the intercept is not penalised
    live = None
    for _ in range(ROUNDS):
        p = sigmoid(_logit(beta, xs))
        w = p * (1 - p)
        sums = [F.sum((p - F.col("_y")) * xs[j]) for j in range(k)] + [F.sum(w * xs[a] * xs[b]) for a in range(k) for b in range(a, k)]
        got = rows.groupBy("_fold").agg(F.min("_y"), F.max("_y"), *sums).collect()         # one row a fold
        step = np.zeros_like(beta)
        live = [r[0] for r in got if r[1] != r[2]]
        for r in got:
            fold = r[0]
            if fold not in live:
                continue
            gradient = np.array(r[3:3 + k], dtype=float) + scale @ beta[fold]
            hessian = np.zeros((k, k))
            hessian[np.triu_indices(k)] = r[3 + k:]
            hessian = hessian + np.triu(hessian, 1).T + scale
            step[fold] = np.linalg.lstsq(hessian, gradient, rcond=None)[0]
        beta -= step
        if np.abs(step).max() <= TOLERANCE * (1 + np.abs(beta).max()):
            break
    return beta


def score_folds(df: DataFrame, beta: np.ndarray, features: Sequence[str], period: str, cuts: Sequence[str], *, out: str = "pd") -> DataFrame:
    """Every complete row from the first cut on with its fold's ``cut`` (the
    last one not after it) and PD."""
    place = F.size(F.filter(F.array(*map(F.lit, cuts)), lambda c: c <= F.col(period))) - 1
    inputs = [F.lit(1.0), *[F.col(f).cast("double") for f in features]]
    tested = df.where(_complete(features) & F.col(period).isNotNull()).withColumn("_fold", place).where(F.col("_fold") >= 0)
    return tested.select(*df.columns, F.get(F.array(*map(F.lit, cuts)), F.col("_fold")).alias("cut"), sigmoid(_logit(beta, inputs)).alias(out))


def auc_by(df: DataFrame, group: str, score: str, label: str) -> DataFrame:
    """(group, auc): the Mann-Whitney form with average ranks for ties, for all
    groups in one pass: rows are counted by score first, and the distinct
    scores of a group are ranked over range partitions."""
    from .ordered import running_total

    counted = (df.where(F.col(score).isNotNull()).groupBy(group, F.col(score).alias("_s"))
               .agg(F.sum(F.col(label).cast("long")).alias("_pos"), F.count(F.lit(1)).alias("_n")))
    ranked = running_total(counted, ["_s"], value="_n", partition_by=[group], out="_hi")
    dec = "decimal(38,1)"
    mean_rank = (F.col("_hi") * 2 - F.col("_n") + 1).cast(dec) / 2
    t = ranked.groupBy(group).agg(F.sum(F.col("_pos").cast(dec) * mean_rank).alias("_ranks"), F.sum("_pos").alias("_p"), F.sum("_n").alias("_all"))
    p, n = F.col("_p").cast(dec), (F.col("_all") - F.col("_p")).cast(dec)
    u = F.col("_ranks") - p * (p + 1) / 2
    return t.select(group, F.try_divide(u.cast("double"), (p * n).cast("double")).alias("auc"))


def report_by(df: DataFrame, group: str, label: str, pred: str) -> DataFrame:
    """M-9's figures of the default class by group: precision, recall, F1,
    accuracy and support; a zero denominator gives 0."""
    y, p = F.col(label), F.col(pred)
    c = df.groupBy(group).agg(F.count_if((y == 1) & (p == 1)).alias("tp"), F.count_if((y == 0) & (p == 1)).alias("fp"),
                              F.count_if((y == 1) & (p == 0)).alias("fn"), F.count_if((y == 0) & (p == 0)).alias("tn"))
    ratio = lambda a, b: F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    return c.select(group, ratio(tp, tp + fp).alias("precision"), ratio(tp, tp + fn).alias("recall"),
                    ratio(2 * tp, 2 * tp + fp + fn).alias("f1_score"), ratio(tp + tn, tp + fp + fn + tn).alias("accuracy"),
                    (tp + fn).alias("support"))


def earlier_weights(df: DataFrame, scores: Sequence[str], label: str, period: str) -> DataFrame:
    """(period, weights map): every model's weight in a period, the inverse of
    its Brier score over all earlier periods, normalised; equal weights where
    there is no earlier row. One aggregate by period, then a running sum over
    the few periods."""
    from pyspark.sql import Window

    per = df.where(F.col(period).isNotNull()).groupBy(period).agg(*[
        f(x).alias(f"{tag}{i}") for i, s in enumerate(scores)
        for tag, f, x in (("_e", F.sum, (F.col(s) - F.col(label)) ** 2), ("_c", F.count, F.col(s) * F.col(label)))])
    before = Window.orderBy(period).rowsBetween(Window.unboundedPreceding, -1)           # one row a period
    brier = [F.try_divide(F.sum(f"_e{i}").over(before), F.sum(f"_c{i}").over(before)) for i in range(len(scores))]
    known = per.select(period, *[b.alias(f"_b{i}") for i, b in enumerate(brier)])
    inverse = [F.when(F.col(f"_b{i}") > 0, 1 / F.col(f"_b{i}")) for i in range(len(scores))]
    all_known = F.lit(True)
    total = F.lit(0.0)
    for v in inverse:
        all_known, total = all_known & v.isNotNull(), total + v
    pairs = [x for i, s in enumerate(scores) for x in (F.lit(s), F.when(all_known, inverse[i] / total).otherwise(1.0 / len(scores)))]
    return known.select(period, F.create_map(*pairs).alias("weights"))


def vote(df: DataFrame, weights: DataFrame, scores: Sequence[str], period: str, *, out: str = "pd_vote") -> DataFrame:
    """E-11: the weighted mean of several models' scores with the weights of the
    row's period (the few periods are broadcast). A NULL score leaves its model
    out of that row's vote."""
    joined = df.join(F.broadcast(weights), period, "left")
    part = lambda s: F.col("weights")[s]
    top, base = F.lit(0.0), F.lit(0.0)
    for s in scores:
        top = top + F.coalesce(part(s) * F.col(s), F.lit(0.0))
        base = base + F.when(F.col(s).isNotNull(), part(s)).otherwise(0.0)
    return joined.select(*df.columns, *[part(s).alias(f"weight_{s}") for s in scores], F.try_divide(top, base).alias(out))


def periods_of(df: DataFrame, period: str, most: int) -> list[str]:
    """The distinct periods in order; more than ``most`` are refused, since every
    fold's coefficients travel in the plan."""
    found = [r[0] for r in df.where(F.col(period).isNotNull()).select(period).distinct().orderBy(period).limit(most + 1).collect()]
    if len(found) > most:
        raise ValueError(f"more than {most} periods")
    return found


def coefficients(beta: np.ndarray, features: Sequence[str], cuts: Sequence[str]) -> list[Mapping[str, float]]:
    return [dict(zip(["cut", "intercept", *features], [c, *map(float, b)])) for c, b in zip(cuts, beta)]
