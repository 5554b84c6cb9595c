"""Filter interaction audit by the Hart-Mas-Colell potential (operator 12).

Every document gets one bit per filter it fails. Documents are counted once by
(part, failed filters, labels); everything after that works on those counts,
at most 2^filters x 4 rows a part.

A coalition S of filters removes v(S) documents: those that fail at least one
of its filters. The potential of the removal game is defined by recursion over
all coalitions: P(empty) = 0 and P(S) = (v(S) + sum of P(S without i)) / |S|.
A filter's Shapley value is P(all) - P(all without it). To stay in whole
numbers the recursion runs on Q(S) = |S|! P(S):
``Q(S) = (|S|-1)! v(S) + sum of Q(S without i)``. The value times the number
of orders is then ``Q(all) - n Q(all without i)``.
A step of an order is a coalition difference: filter i after the filters S
removes v(S and i) - v(S); the same difference over the labelled documents
gives the good and toxic ones it removes.

DataFrame expressions only: one scan for words, characters and a digest; a
join of narrow rows with the labels; one aggregate by text digest; counts.

The default filters (``failures``) are: A fewer than 50 words, B under 65 %
distinct words, C over 5 % ``[A-Z]``, D any of ``[#$%&*|]``, E identical to
the text of a smaller doc_id anywhere in the table. Texts are identical if
their SHA-256 is. E needs no join: rows are counted by (digest, part, labels)
with their smallest doc_id, so a text with a third of all rows is reduced in
every task, and the digest's smallest doc_id is compared with those counts.

Edge cases: a null or empty text has no words, fails A only (B needs a word,
C a character), and E like any other text. A null source is the part ''. A
null doc_id has no label and is neither smaller nor larger than another, so it
never fails E. Rows sharing the smallest doc_id of a text all pass E (ties).
Repeated labels of one doc_id count once; a document is good (toxic) if any of
them says so. Very long texts are split in one task's memory, one text at a
time. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, Window, functions as F

FILTERS = "ABCDE"
MIN_WORDS = 50
MIN_DISTINCT = 65       # percent of the words
MAX_CAPITALS = 5        # percent of the code points
SYMBOLS = r"[#$%&*|]"
SEPARATORS = r"[\x20\x09-\x0D]+"


def text_failures(text: Column) -> Column:
    """Bits 0 to 3: the filters A to D that a text (not null) fails."""
    words = F.array_remove(F.split(text, SEPARATORS), "")
    n = F.size(words)
    fails = (n < MIN_WORDS,
             100 * F.size(F.array_distinct(words)) < MIN_DISTINCT * n,
             100 * F.regexp_count(text, F.lit("[A-Z]")) > MAX_CAPITALS * F.length(text),
             text.rlike(SYMBOLS))
    out = F.lit(0)
    for bit, fail in enumerate(fails):
        out = out.bitwiseOR(F.when(fail, 1 << bit).otherwise(0))
    return out


def failure_counts(docs: DataFrame, labels: DataFrame, part: str = "source") -> DataFrame:
    """(part, mask, good, toxic, n): documents by the filters they fail and
    their labels."""
    text = F.coalesce(F.col("text"), F.lit(""))
    slim = docs.select(F.col("doc_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
                       F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"), text_failures(text).alias("bits"))
    marks = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"), F.lit(0).cast("long").alias("spread"))
    # rows without an id have no label: their digest spreads them over the join's partitions
    spread = F.when(F.col("doc_id").isNull(), F.xxhash64("digest").bitwiseOR(F.lit(1).cast("long"))).otherwise(F.lit(0).cast("long"))
    known = (slim.withColumn("spread", spread)
             .groupBy("doc_id", "spread", "digest", "part", "bits").agg(F.count(F.lit(1)).alias("n"))
             .join(marks, ["doc_id", "spread"], "left")
             .withColumn("good", F.coalesce("good", F.lit(False))).withColumn("toxic", F.coalesce("toxic", F.lit(False))))
    same = known.groupBy("digest", "part", "bits", "good", "toxic").agg(
        F.sum("n").alias("n"), F.min("doc_id").alias("least"), F.min_by("n", "doc_id").alias("n_least"),
        F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("n_null"))
    # a window holds one row for each part and label of a text, however many copies there are
    pairs = same.withColumn("first", F.min("least").over(Window.partitionBy("digest")))
    passing = F.col("n_null") + F.when(F.col("least") == F.col("first"), F.col("n_least")).otherwise(0)
    copies = 1 << 4
    cases = F.array(F.struct(F.col("bits").alias("mask"), passing.alias("n")),
                    F.struct(F.col("bits").bitwiseOR(F.lit(copies)).alias("mask"), (F.col("n") - passing).alias("n")))
    return (pairs.select("part", "good", "toxic", F.explode(cases).alias("case")).where(F.col("case.n") > 0)
            .groupBy("part", F.col("case.mask").alias("mask"), "good", "toxic").agg(F.sum("case.n").alias("n")))


def coalition_values(counts: DataFrame, n_filters: int = len(FILTERS)) -> DataFrame:
    """One row a part: total, fails (by filter) and v, good, toxic — what each
    coalition removes, as arrays indexed by the coalition's bits."""
    size = 1 << n_filters
    hit = F.col("mask").bitwiseAND(F.col("coalition")) != 0
    removed = lambda c: F.sum(F.when(hit & c, F.col("n")).otherwise(0))
    per = (counts.withColumn("coalition", F.explode(F.sequence(F.lit(0), F.lit(size - 1))))
           .groupBy("part", "coalition").agg(F.sum("n").alias("total"), removed(F.lit(True)).alias("v"),
                                             removed(F.col("good")).alias("good"), removed(F.col("toxic")).alias("toxic")))
    game = F.array_sort(F.collect_list(F.struct("coalition", "v", "good", "toxic")))      # 2^filters rows
    return per.groupBy("part").agg(F.max("total").alias("total"), game.alias("game")) \
        .select("part", "total", *[F.col(f"game.{c}").alias(c) for c in ("v", "good", "toxic")])


def potentials(v: Column, n_filters: int = len(FILTERS)) -> Column:
    """Q(S) = |S|! P(S) for every coalition S, in the order of its bits: all
    coalitions without one filter come before S."""
    zero = F.lit(0).cast("long")

    def step(acc: Column, s: Column) -> Column:
        size = F.bit_count(s)
        scale = F.element_at(F.array(*[F.lit(factorial(k)).cast("long") for k in range(n_filters)]), size)
        below = zero
        for bit in range(n_filters):
            below = below + F.when(s.bitwiseAND(F.lit(1 << bit)) != 0, F.get(acc, s - (1 << bit))).otherwise(zero)
        return F.concat(acc, F.array(scale * F.get(v, s) + below))

    return F.aggregate(F.sequence(F.lit(1), F.lit((1 << n_filters) - 1)), F.array(zero), step)


def shapley_times_orders(potential: Column, n_filters: int = len(FILTERS)) -> Column:
    """Each filter's Shapley value times the number of orders, n_filters!."""
    full = (1 << n_filters) - 1
    return F.array(*[F.get(potential, F.lit(full)) - n_filters * F.get(potential, F.lit(full - (1 << bit))) for bit in range(n_filters)])


def audit(counts: DataFrame, filters: str = FILTERS) -> DataFrame:
    """One row per part, order of the filters and step, from failure counts."""
    n = len(filters)
    game = coalition_values(counts, n)
    game = game.withColumn("shapley", shapley_times_orders(potentials(F.col("v"), n), n))
    number = F.create_map(*[x for i, c in enumerate(filters) for x in (F.lit(c), F.lit(i))])
    orders = F.array(*[F.lit("".join(p)) for p in permutations(filters)])
    steps = (game.withColumn("filter_order", F.explode(orders))
             .withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(n)))))
    letter = lambda k: number[F.substring(F.col("filter_order"), k, F.lit(1))]
    earlier = F.aggregate(F.sequence(F.lit(1), F.lit(n)), F.lit(0),
                          lambda acc, k: acc + F.when(k < F.col("step"), _power(letter(k), n)).otherwise(0))
    steps = (steps.withColumn("bit", letter(F.col("step"))).withColumn("own", _power(F.col("bit"), n)).withColumn("before", earlier)
             .withColumn("after", F.col("before") + F.col("own")))
    of = lambda column, s: F.get(F.col(column), F.col(s))
    full = (1 << n) - 1
    removed = of("v", "after") - of("v", "before")
    return steps.select(
        "part", "filter_order", F.col("step").cast("int").alias("step"),
        (F.col("total") - of("v", "after")).alias("kept"), removed.alias("removed"),
        (of("v", "own") - removed).alias("redundant"),
        (F.get("v", F.lit(full)) - F.get("v", F.lit(full) - F.col("own"))).alias("unique_fails"),
        (of("good", "after") - of("good", "before")).alias("good_lost"),
        (of("toxic", "after") - of("toxic", "before")).alias("toxic_lost"),
        of("shapley", "bit").alias("shapley"))


def _power(bit: Column, n: int) -> Column:
    return F.get(F.array(*[F.lit(1 << i) for i in range(n)]), bit)


def filter_interactions(docs: DataFrame, labels: DataFrame, part: str = "source") -> DataFrame:
    """The audit of the five default filters over all documents."""
    return audit(failure_counts(docs, labels, part))
