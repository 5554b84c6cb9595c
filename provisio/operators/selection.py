"""The n-th row of a stored frame in the order of some columns, by counting
(S-2, S-3, K-6): a radix selection, no sort and no shuffle of the rows.

The order columns become a list of numeric digits whose lexicographic order is
that of the columns. Rows are counted in at most ``BUCKETS`` equal ranges of a
digit; the range that holds the n-th row is cut again while it holds more than
``RANK_ROWS`` rows, and once all its rows share a digit the next one follows.
Only the rows of the last range are ranked. Every round is one partial
aggregate over the stored columns, and its counts are all that is collected.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

BUCKETS = 4096
RANK_ROWS = 100_000       # rows of the last range, ranked by one sort
_BYTES = 6                # of a text make one digit (48 bits: exact in a double)
# places of what has no distance: sorted like the values they stand for
_NULL, _LOWEST, _HIGHEST, _NAN = -2, -1, 1 << 30, (1 << 30) + 1


@dataclass(frozen=True)
class Cut:
    values: tuple         # the n-th row's order columns
    before: int           # rows that sort before it
    at: int               # rows that equal it


def _digits(rows: DataFrame, name: str) -> Iterator[Column]:
    """Numeric digits of a column, the most significant first; NULL stays NULL."""
    kind, c = rows.schema[name].dataType, F.col(f"`{name}`")
    if isinstance(kind, (T.StringType, T.BinaryType)):
        raw = c.cast("binary")
        longest = rows.agg(F.max(F.octet_length(raw))).first()[0] or 0
        for at in range(0, max(longest, 1), _BYTES):
            yield F.conv(F.hex(F.rpad(F.substring(raw, at + 1, _BYTES), _BYTES, F.lit(b"\0"))), 16, 10).cast("long")
        yield F.octet_length(raw).cast("long")          # a text before the same text with zero bytes behind
    elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        yield F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast(kind), c)
    elif isinstance(kind, T.DateType):
        yield F.datediff(c, F.lit("1970-01-01").cast("date")).cast("long")
    elif isinstance(kind, T.BooleanType):
        yield c.cast("long")
    elif isinstance(kind, T.DecimalType):
        yield c.cast("double")                          # rounding keeps the order; ties are ranked as decimals
        yield (c - c.cast("double").cast(kind)).cast("double")
    else:
        yield c


def _narrowed(rows: DataFrame, digit: Column, k: int) -> tuple[DataFrame, int, int, bool]:
    """(rows of the range that holds the k-th, k inside it, its rows, whether
    they share the digit), from two aggregates."""
    kind = rows.select(digit.alias("d")).schema["d"].dataType
    place, finite = F.when(digit.isNull(), _NULL), digit
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        endless = F.lit(float("inf"))
        place = place.when(F.isnan(digit), _NAN).when(digit == endless, _HIGHEST).when(digit == -endless, _LOWEST)
        finite = F.when(F.abs(digit) < endless, digit)
    lo, hi = rows.agg(F.min(finite), F.max(finite)).first()
    if lo is None or lo == hi:
        place = place.otherwise(0)
    else:
        # whole numbers keep exact distances where they fit
        exact = isinstance(lo, int) and hi - lo < 1 << 62
        offset = (digit.cast("long") - F.lit(lo) if exact else digit.cast("double") - F.lit(float(lo))).cast("double")
        width = (hi - lo if exact else float(hi) - float(lo)) / BUCKETS
        if 0.0 < width < float("inf"):
            place = place.otherwise(F.greatest(F.lit(0), F.least(F.floor(offset / F.lit(width)), F.lit(BUCKETS - 1))).cast("int"))
        else:                    # a width that underflows or overflows: halves
            place = place.otherwise(F.when(digit.cast("double") <= F.lit(float(lo) / 2 + float(hi) / 2), 0).otherwise(1))
    counted = sorted((r["b"], r["n"], r["lo"], r["hi"]) for r in rows.groupBy(place.alias("b")).agg(
        F.count(F.lit(1)).alias("n"), F.min(digit).alias("lo"), F.max(digit).alias("hi")).collect())    # at most BUCKETS + 4 rows
    for bucket, n, least, most in counted:
        if k <= n:
            break
        k -= n
    return rows.where(place == bucket), k, n, not 0 <= bucket < BUCKETS or least == most


def nth(rows: DataFrame, order: Sequence[str], n: int) -> Cut | None:
    """The ``n``-th row (from 1) of a stored frame in ``order`` (ascending,
    NULLs first); None if there are fewer."""
    total = rows.count()
    if n > total:
        return None
    inside, k, size = rows, n, total
    for name in order:
        for digit in _digits(rows, name):
            shared = False
            while size > RANK_ROWS and not shared:
                inside, k, size, shared = _narrowed(inside, digit, k)
            if size <= RANK_ROWS:
                break
        if size <= RANK_ROWS:
            break
    ascending = [F.col(f"`{c}`").asc_nulls_first() for c in order]
    if size <= RANK_ROWS:
        row = inside.orderBy(*ascending).offset(k - 1).limit(1).first()
    else:                                                # all rows left are equal
        row = inside.first()
    values = tuple(row[c] for c in order)
    less, same = before_and_at(inside, order, values)
    earlier, at = inside.agg(F.count(F.when(less, 1)), F.count(F.when(same, 1))).first()
    return Cut(values, n - k + earlier, at)


def before_and_at(df: DataFrame, order: Sequence[str], values: Sequence) -> tuple[Column, Column]:
    """Conditions: a row sorts before ``values``; a row equals them."""
    before, same = F.lit(False), F.lit(True)
    for name, value in zip(order, values):
        c, v = F.col(f"`{name}`"), F.lit(value).cast(df.schema[name].dataType)
        less = F.lit(False) if value is None else c.isNull() | (c < v)
        before, same = before | (same & less), same & c.eqNullSafe(v)
    return before, same
