"""Model evaluation (M-7, M-8, M-9) and the documented monitoring
extensions (E-1 … E-11).

AUC is exact without a global sort in one task: rows are counted per distinct
score, and only the distinct scores are ranked, by range partitions. Confusion counts and the classification report are one global
aggregate (four conditional counts) and column arithmetic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.scalars import col_
from .ordered import running_total

CLASS_NAMES = ("No Default", "Default")
DECISION_THRESHOLD = 0.5


def hard_prediction(score: str | Column, threshold: float = DECISION_THRESHOLD) -> Column:
    """M-8: class 1 when the probability exceeds the threshold (ties → 0)."""
    return F.when(col_(score) > threshold, 1).otherwise(0)


def auc(df: DataFrame, score: str, label: str) -> DataFrame:
    """M-7: area under the ROC curve with average ranks for ties (the
    Mann-Whitney form), as a one-row frame. Rows with a NULL score are left out.

    Rows are first counted per distinct score (partial aggregation), then a
    running count over the distinct scores gives each tie group's ranks
    min..max, whose average is (min + max)/2, and
    AUC = (Σ_s pos_s·avg_rank_s − P(P+1)/2) / (P·N).
    The rank sums are exact decimals.
    """
    counted = (df.where(F.col(score).isNotNull()).groupBy(F.col(score).alias("_s"))
               .agg(F.sum(F.col(label).cast("long")).alias("_pos"), F.count(F.lit(1)).alias("_n")))
    per_score = running_total(counted, ["_s"], value="_n", out="_hi") \
        .withColumn("_lo", F.col("_hi") - F.col("_n") + 1)
    dec = "decimal(38,1)"
    t = per_score.agg(
        F.sum(F.col("_pos").cast(dec) * (F.col("_lo") + F.col("_hi")).cast(dec) / 2).alias("_rank_sum"),
        F.sum("_pos").alias("_p"), F.sum("_n").alias("_all"))
    p, n = F.col("_p").cast(dec), (F.col("_all") - F.col("_p")).cast(dec)
    u = F.col("_rank_sum") - p * (p + 1) / 2
    return t.select(F.try_divide(u.cast("double"), (p * n).cast("double")).alias("auc"))


def confusion_counts(df: DataFrame, label: str, pred: str) -> DataFrame:
    """M-8: ``(label, prediction, count)`` — one aggregation, at most four rows."""
    return df.groupBy(F.col(label).alias("label"), F.col(pred).alias("prediction")).agg(
        F.count(F.lit(1)).alias("n"))


def classification_report(df: DataFrame, label: str, pred: str, names=CLASS_NAMES) -> DataFrame:
    """M-9: precision, recall, F1 and support per class, accuracy, macro and
    weighted means; a zero denominator gives 0."""
    y, p = F.col(label), F.col(pred)
    c = df.agg(F.count_if((y == 1) & (p == 1)).alias("tp"), F.count_if((y == 0) & (p == 1)).alias("fp"),
               F.count_if((y == 1) & (p == 0)).alias("fn"), F.count_if((y == 0) & (p == 0)).alias("tn"))

    def ratio(a: Column, b: Column) -> Column:
        return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))

    tp, fp, fn, tn = F.col("tp"), F.col("fp"), F.col("fn"), F.col("tn")
    p1, r1 = ratio(tp, tp + fp), ratio(tp, tp + fn)
    p0, r0 = ratio(tn, tn + fn), ratio(tn, tn + fp)
    f1 = ratio(2 * p1 * r1, p1 + r1)
    f0 = ratio(2 * p0 * r0, p0 + r0)
    s1, s0 = tp + fn, tn + fp
    n = s0 + s1
    acc = ratio(tp + tn, n)

    def w(a: Column, b: Column) -> Column:
        return ratio(a * s0 + b * s1, n)

    rows = F.array(
        F.struct(F.lit(names[0]).alias("class"), p0.alias("precision"), r0.alias("recall"), f0.alias("f1_score"), s0.alias("support")),
        F.struct(F.lit(names[1]).alias("class"), p1.alias("precision"), r1.alias("recall"), f1.alias("f1_score"), s1.alias("support")),
        F.struct(F.lit("accuracy").alias("class"), F.lit(None).cast("double").alias("precision"),
                 F.lit(None).cast("double").alias("recall"), acc.alias("f1_score"), n.alias("support")),
        F.struct(F.lit("macro avg").alias("class"), ((p0 + p1) / 2).alias("precision"), ((r0 + r1) / 2).alias("recall"),
                 ((f0 + f1) / 2).alias("f1_score"), n.alias("support")),
        F.struct(F.lit("weighted avg").alias("class"), w(p0, p1).alias("precision"), w(r0, r1).alias("recall"),
                 w(f0, f1).alias("f1_score"), n.alias("support")),
    )
    return c.select(F.explode(rows).alias("r")).select("r.*")
