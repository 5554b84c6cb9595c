"""Several exact quantiles of several columns in two scans (A-8, C-14, E-1).

Scan 1 takes a mergeable quantile sketch of every column and brackets each
wanted rank: the sketch's rank error is at most n / ``ACCURACY``, so the values
two errors below and above enclose it. The brackets cut the number line into
segments. Scan 2 counts rows by segment, and inside the brackets by value; a
row gives one count a column, reduced in every task. What lies inside the
brackets, a few thousandths of the rows, is ranked by a running total
(distributed beyond ``RANK_ROWS`` values). Nothing is sorted whole, and the driver sees one row a segment and one a
wanted rank.

NULL and NaN values are not ranked. Medians need no count beforehand: scan 1
counts too. For other ranks the numbers of values come from the caller or from
one more scan. Pass a stored or slim frame.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from .ordered import running_total

ACCURACY = 10_000
RANK_ROWS = 100_000      # bracketed values that one window may rank; more go over range partitions


@dataclass(frozen=True)
class Rank:
    """The value of a rank (from 1), the values that sort before it, and how many equal it."""
    value: float
    before: int
    at: int


def _value(column: str) -> Column:
    v = F.col(f"`{column}`").cast("double")
    return F.when(~F.isnan(v), v)


def _brackets(sketch: Sequence[float], pairs: int) -> list[tuple[float, float]]:
    """Disjoint closed intervals from the sketch's pairs, touching ones joined."""
    out: list[tuple[float, float]] = []
    for lo, hi in sorted((sketch[2 * i], sketch[2 * i + 1]) for i in range(pairs)):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(hi, out[-1][1]))
        else:
            out.append((lo, hi))
    return out


def count_values(df: DataFrame, columns: Sequence[str]) -> dict[str, int]:
    """How many values of each column are ranked: one aggregate."""
    row = df.agg(*[F.count(_value(c)).alias(f"n{i}") for i, c in enumerate(columns)]).first()
    return {c: row[i] for i, c in enumerate(columns)}


def exact_ranks(df: DataFrame, wanted: Mapping[str, Sequence[int]], counts: Mapping[str, int] | None = None) -> dict[str, dict[int, Rank]]:
    """The values of the ``wanted`` ranks (from 1) of every column. ``counts``
    are the numbers of values if the caller has them."""
    counts = counts or count_values(df, list(wanted))
    ranks = {c: sorted({r for r in rs if 1 <= r <= counts[c]}) for c, rs in wanted.items()}
    columns = [c for c in ranks if ranks[c]]
    if not columns:
        return {c: {} for c in wanted}
    shares = {c: [min(1.0, max(0.0, r / counts[c] + side * 2.0 / ACCURACY)) for r in ranks[c] for side in (-1, 1)] for c in columns}
    sketches = df.agg(*[F.percentile_approx(_value(c), F.array(*map(F.lit, shares[c])), ACCURACY).alias(f"s{i}")
                        for i, c in enumerate(columns)]).first()                       # scan 1: one row
    brackets = {c: _brackets(sketches[i], len(ranks[c])) for i, c in enumerate(columns)}
    return {c: {} for c in wanted} | _selected(df, {c: ranks[c] for c in columns}, brackets)


def _selected(df: DataFrame, ranks: Mapping[str, Sequence[int]], brackets: Mapping[str, list[tuple[float, float]]]) -> dict[str, dict[int, Rank]]:
    """Scan 2. Should a rank lie outside its bracket, the whole line is taken."""
    from ..sources.tables import land

    columns = list(ranks)

    def segment(c: str) -> Column:
        """0, 2, 4 ... between the brackets, 1, 3, 5 ... inside them."""
        v, out = _value(c), F.lit(0)
        for lo, hi in brackets[c]:
            out = out + F.when(v >= F.lit(lo), 1).otherwise(0) + F.when(v > F.lit(hi), 1).otherwise(0)
        return F.when(v.isNotNull(), out)

    cells = F.array(*[F.struct(F.lit(i).alias("c"), segment(c).alias("segment"), F.when(segment(c) % 2 == 1, _value(c)).alias("v"))
                      for i, c in enumerate(columns)])
    counted = (df.select(F.explode(cells).alias("cell")).select("cell.*").where(F.col("segment").isNotNull())
               .groupBy("c", "segment", "v").agg(F.count(F.lit(1)).alias("n")))         # scan 2
    counted = df.sparkSession.read.parquet(land(counted, name="bracket-counts"))
    totals = {(r["c"], r["segment"]): r["n"] for r in counted.groupBy("c", "segment").agg(F.sum("n").alias("n")).collect()}
    inside = counted.where(F.col("v").isNotNull())
    if inside.count() <= RANK_ROWS:          # a bounded number of rows: a plain window per bracket
        upto = inside.withColumn("upto", F.sum("n").over(Window.partitionBy("c", "segment").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)))
    else:
        upto = running_total(inside, ["v"], value="n", partition_by=["c", "segment"], out="upto")
    picks = []
    for i, c in enumerate(columns):
        for r in ranks[c]:
            below = segment_no = 0
            while below + totals.get((i, segment_no), 0) < r:
                below += totals.get((i, segment_no), 0)
                segment_no += 1
            if segment_no % 2 == 0:
                return _selected(df, ranks, {c: [(float("-inf"), float("inf"))] for c in columns})
            picks.append((i, segment_no, r, below))
    asked = F.array(*[F.struct(F.lit(i).alias("pc"), F.lit(s).alias("ps"), F.lit(r).cast("long").alias("rank"), F.lit(b).cast("long").alias("below"))
                      for i, s, r, b in picks])
    own = F.filter(asked, lambda p: (p["pc"] == F.col("c")) & (p["ps"] == F.col("segment")) & (p["rank"] - p["below"] <= F.col("upto"))
                   & (p["rank"] - p["below"] > F.col("upto") - F.col("n")))
    found = upto.select("c", "v", "n", "upto", F.explode(own).alias("p")).select("c", "v", "n", "p.rank", (F.col("p.below") + F.col("upto") - F.col("n")).alias("before"))
    out: dict[str, dict[int, Rank]] = {c: {} for c in columns}
    for r in found.collect():                                                          # one row a wanted rank
        out[columns[r["c"]]][r["rank"]] = Rank(r["v"], r["before"], r["n"])
    return out


def medians(df: DataFrame, columns: Sequence[str], *, approximate: int | None = None) -> dict[str, float | None]:
    """A-8: the medians of several columns, interpolated like ``median``;
    ``approximate`` takes the sketch's answer of that accuracy from one scan
    instead (rank error at most n / ``approximate``)."""
    if approximate:
        row = df.agg(*[F.percentile_approx(_value(c), 0.5, approximate).alias(f"m{i}") for i, c in enumerate(columns)]).first()
        return {c: row[i] for i, c in enumerate(columns)}
    shares = F.array(F.lit(0.5 - 2.0 / ACCURACY), F.lit(0.5 + 2.0 / ACCURACY))
    row = df.agg(*[x for i, c in enumerate(columns) for x in (F.count(_value(c)).alias(f"n{i}"), F.percentile_approx(
        _value(c), shares, ACCURACY).alias(f"s{i}"))]).first()                         # scan 1: one row
    counts = {c: row[2 * i] for i, c in enumerate(columns) if row[2 * i]}
    brackets = {c: [tuple(row[2 * i + 1])] for i, c in enumerate(columns) if row[2 * i]}
    found = _selected(df, {c: sorted({(n + 1) // 2, (n + 2) // 2}) for c, n in counts.items()}, brackets) if counts else {}
    out: dict[str, float | None] = dict.fromkeys(columns)
    for c, values in found.items():
        pair = [x.value for _, x in sorted(values.items())]
        out[c] = (pair[0] + pair[-1]) / 2
    return out
