"""Mixing sources to target weights by Poisson replication (operator 3).

A source's target share of the mixture over its share of the corpus is its
mean repetition rate. Each document draws its number of copies by inverting
the Poisson distribution at a uniform number hashed from (seed, doc_id, text):
the count is how many values of the cumulative distribution lie at or below
it. A rerun or a lost task draws the same number. Documents are exploded by
their count and dealt out globally by a second hash.

DataFrame expressions only: one aggregate over sources, a join with its small
result, an explode and one shuffle into equal ranges of the second hash.

Edge cases: a null source is a source of its own; a null or empty text counts
as size 0 under ``size="chars"``, so a source of such texts only has an
undefined rate and keeps its documents once. A null doc_id hashes as ''.
Repeated rows draw the same count, and sources that tie in size get the same
rate. A very long text is hashed once and copied whole. A weight of 0 removes a source. An empty
table gives no rows. Extra columns are carried along.
"""

from __future__ import annotations

from math import log, pi

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import fresh, shuffle_partitions

SEED = "mix-1"
BROADCAST_SOURCES = 10_000    # sources: broadcast up to this count, joined by shuffle beyond
_HEX_DIGITS = 13              # 52 bits: exact in a double


def uniform(seed: str, *parts: Column) -> Column:
    """A uniform number in [0, 1) from the md5 of the seed and the parts."""
    text = F.concat_ws("|", F.lit(seed), *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, _HEX_DIGITS), 16, 10).cast("double") / F.lit(float(16 ** _HEX_DIGITS))


def log_gamma(x: Column) -> Column:
    """The logarithm of the gamma function for x >= 1: Stirling's series at
    x + 10, less the factors in between."""
    shifted, factors = x + 10.0, x
    for i in range(1, 10):
        factors = factors * (x + float(i))
    y, inverse = shifted, 1.0 / shifted
    series = inverse / 12 - F.pow(inverse, F.lit(3.0)) / 360 + F.pow(inverse, F.lit(5.0)) / 1260 - F.pow(inverse, F.lit(7.0)) / 1680 \
        + F.pow(inverse, F.lit(9.0)) / 1188
    small = (y - 0.5) * F.ln(y) - y + 0.5 * log(2 * pi) + series - F.ln(F.when(x < 1e6, factors).otherwise(1.0))
    large = (x - 0.5) * F.ln(x) - x + 0.5 * log(2 * pi) + 1.0 / (12 * x)
    return F.when(x < 1e6, small).otherwise(large)


def poisson_steps(rates: DataFrame) -> DataFrame:
    """``rates`` with least (a number of copies) and steps, the cumulative
    distribution from there on until it is 1 in a double. Below
    ``rate - 12 sqrt(rate) - 30`` there is nothing a double could tell from 0,
    so a rate of a million takes 24,000 numbers. One row a value, one running
    sum a source; terms come from logarithms (no underflow for large rates)."""
    width = 12 * F.sqrt("rate") + 30
    least = F.greatest(F.floor(F.col("rate") - width), F.lit(0)).cast("long")
    most = F.ceil(F.col("rate") + width).cast("long")
    k = F.col("poisson_k").cast("double")
    term = F.when(F.col("rate") > 0, F.exp(k * F.ln("rate") - F.col("rate") - log_gamma(k + 1.0))).otherwise(F.when(k == 0, 1.0).otherwise(0.0))
    upto = Window.partitionBy("source").orderBy("poisson_k").rowsBetween(Window.unboundedPreceding, 0)
    values = (rates.select("source", "rate", least.alias("least"), F.explode(F.sequence(least, most)).alias("poisson_k"))
              .withColumn("step", F.sum(term).over(upto)))
    return values.groupBy("source", "rate", "least").agg(F.array_sort(F.collect_list("step")).alias("steps"))


def repetition_rates(docs: DataFrame, weights: dict[str, float] | None = None, *, size: str = "chars",
                     total: float = 1.0) -> DataFrame:
    """One row per source: source, n_docs, amount, rate. ``weights`` are
    relative targets; without them every source gets the same. ``size`` is
    ``chars`` or ``docs``; ``total`` is the mixture's size over the corpus'."""
    amount = F.sum(F.coalesce(F.length("text"), F.lit(0)).cast("long")) if size == "chars" else F.count(F.lit(1))
    per = docs.groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"), amount.alias("amount"))
    if weights:
        table = F.create_map(*[x for k, v in weights.items() for x in (F.lit(k), F.lit(float(v)))])
        per = per.withColumn("weight", F.coalesce(F.try_element_at(table, F.coalesce("source", F.lit(""))), F.lit(0.0)))
    else:
        per = per.withColumn("weight", F.lit(1.0))
    sums = per.agg(F.sum("amount").cast("double").alias("all_amount"), F.sum("weight").alias("all_weight"))   # one row
    return (per.crossJoin(F.broadcast(sums))
            .withColumn("rate", F.coalesce(F.try_divide(F.col("weight") * F.col("all_amount") * F.lit(float(total)),
                                                        F.col("all_weight") * F.col("amount")), F.lit(1.0)))
            .select("source", "n_docs", "amount", "rate"))


def mix(docs: DataFrame, weights: dict[str, float] | None = None, *, size: str = "chars", total: float = 1.0,
        seed: str = SEED) -> DataFrame:
    """Every column of ``docs`` plus copy_no (from 0), copies, rate and
    shuffle_key, in global random order."""
    rates = repetition_rates(docs, weights, size=size, total=total)
    name, least, steps, u = fresh(docs, "mix_source", "mix_least", "mix_steps", "mix_uniform")
    table = poisson_steps(rates).select(F.col("source").alias(name), "rate", F.col("least").alias(least), F.col("steps").alias(steps))
    few = rates.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES
    # drop a caller's columns that would clash with the results
    own = docs.drop("copy_no", "copies", "rate", "shuffle_key")
    drawn = (own.join(F.broadcast(table) if few else table, F.col("source").eqNullSafe(F.col(name)))
             .withColumn(u, uniform(seed, F.col("doc_id"), F.md5(F.coalesce(F.col("text").cast("binary"), F.lit(b""))))))
    copies = (F.col(least) + F.size(F.filter(F.col(steps), lambda c: c <= F.col(u)))).cast("int")
    out = (drawn.withColumn("copies", copies).where(F.col("copies") > 0)
           .withColumn("copy_no", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
           .withColumn("shuffle_key", F.md5(F.concat_ws("|", F.lit(seed), F.lit("order"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")),
                                                        F.col("copy_no").cast("string")))))
    # the key is uniform, so equal ranges of it are the partitions: no sampling pass
    parts = shuffle_partitions(docs.sparkSession)
    place = F.conv(F.substring("shuffle_key", 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32)) * F.lit(parts)
    return out.drop(name, least, steps, u).repartitionById(parts, F.floor(place).cast("int")).sortWithinPartitions("shuffle_key")
