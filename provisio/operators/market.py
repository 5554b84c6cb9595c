"""Market data (X-1, X-2 batch form, J-5, J-7, W-2, F-8, R-14, R-15, C-17, C-20)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.scalars import col_
from ..functions.text import fmt_money
from .ordered import running_total

# ---- fixed values: demo company → exchange ticker, and the default ticker ----
REAL_TICKER_MAP = {
    "HK_00000": "700.HK",
    "HK_00001": "5.HK",
    "HK_00002": "1299.HK",
    "HK_00003": "3690.HK",
    "HK_00004": "9988.HK",
    "HK_00005": "388.HK",
}
DEFAULT_TICKER = "700.HK"
# ---- fixed values: simulated financials and currency of the fallback source ----
MOCK_FINANCIALS = {"revenue": 5e10, "net_income": 1e10, "total_debt": 2e10, "cash": 1.5e10}
DEFAULT_CURRENCY = "HKD"
SIMULATED_SUFFIX = " (Simulated)"
FRESHNESS_SECONDS = 3600
HISTORY_MONTHS = 6
FALLBACK_START_PRICE = 100.0
FINANCIAL_ITEMS = [("Total Revenue", "revenue"), ("Net Income", "net_income"), ("Total Debt", "total_debt"),
                   ("Cash", "cash")]


def tick_order(ts: str, tiebreak: str | None) -> Column:
    """Ordering key (ts, tiebreak) as ONE fixed-width value: microseconds
    since the epoch · 10^19 + tiebreak, a decimal(38,0). A struct key would
    force a sort-based aggregate; this keeps the hash aggregate."""
    if not tiebreak:
        return F.col(ts)
    micros = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"),
                              F.col(ts).cast("timestamp_ntz"))
    dec = "decimal(38,0)"
    return micros.cast(dec) * F.lit(str(10 ** 19)).cast(dec) + F.col(tiebreak).cast(dec)


def ohlc_bars(ticks: DataFrame, *, key: Column, ts: str = "ts", price: str = "value",
              tiebreak: str | None = None, unit: str = "day") -> DataFrame:
    """X-1: OHLC bars per key and period. Open/close are the first/last
    price in (ts, tiebreak) order (tiebreak ≥ 0); all four are hash
    aggregates with a partial phase, so a key with most of the ticks is
    pre-aggregated in every task."""
    order = tick_order(ts, tiebreak)
    period = F.date_trunc(unit, F.col(ts)).cast(ticks.schema[ts].dataType)   # keep NTZ input as NTZ
    return ticks.groupBy(key.alias("company_id"), period.alias("ts")).agg(
        F.min_by(price, order).alias("open"), F.max(price).alias("high"),
        F.min(price).alias("low"), F.max_by(price, order).alias("close"))


def latest_quotes(ticks: DataFrame, *, key: Column, ts: str = "ts", price: str = "value",
                  tiebreak: str | None = None) -> DataFrame:
    """X-2 (batch): the latest quote per key."""
    order = tick_order(ts, tiebreak)
    return ticks.groupBy(key.alias("company_id")).agg(F.max(ts).alias("last_ts"),
                                                      F.max_by(price, order).alias("last_price"))


def freshness(latest: DataFrame, as_of: Column, *, max_age_seconds: int = FRESHNESS_SECONDS) -> DataFrame:
    """X-2: age of the latest quote at ``as_of`` and whether it is still fresh."""
    age = (F.unix_micros(as_of.cast("timestamp")) - F.unix_micros(F.col("last_ts").cast("timestamp"))) / 1e6
    return latest.select("*", age.alias("age_seconds"), (age <= max_age_seconds).alias("is_fresh"))


def cumulative_index(returns: DataFrame, *, key: str, order: str, ret: str = "ret",
                     start: float = FALLBACK_START_PRICE, out: str = "price",
                     bounded_groups: bool = False) -> DataFrame:
    """W-2: price index start·Π(1 + r) per key in ``order``, as
    start·exp(Σ ln(1 + r)).

    By default the running sum is range-partitioned, so a key with most of
    the rows is still split over many tasks. ``bounded_groups=True`` is for
    series whose length per key is fixed by construction (the 90-point
    simulated series): a plain window per key, no checkpoint.
    """
    from pyspark.sql import Window

    logs = returns.withColumn("_ln1p", F.log1p(F.col(ret)))
    if bounded_groups:
        w = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
        summed = logs.withColumn("_cum", F.sum("_ln1p").over(w))
    else:
        summed = running_total(logs, [order], value="_ln1p", partition_by=[key], out="_cum")
    return summed.withColumn(out, F.lit(start) * F.exp(F.col("_cum"))).drop("_ln1p", "_cum")


def ticker_for(company: str | Column) -> Column:
    """J-5: reference-data lookup with a default (map literal, no join)."""
    items = []
    for k, v in REAL_TICKER_MAP.items():
        items += [F.lit(k), F.lit(v)]
    return F.coalesce(F.create_map(*items)[col_(company)], F.lit(DEFAULT_TICKER))


def newest_ticks(ticks: DataFrame, key: str, *, ts: str = "ts") -> DataFrame:
    """J-7: each key's newest tick, one aggregate of the scan. A key whose
    ticks carry no time has none."""
    return ticks.groupBy(key).agg(F.max(ts).alias("last_ts")).where(F.col("last_ts").isNotNull())


def sources(entities: DataFrame, newest: DataFrame, key: str, *, as_of: Column, since: Column | None = None,
            max_age_seconds: int = FRESHNESS_SECONDS) -> DataFrame:
    """J-7 + F-8 + X-2: one row per entity with its newest tick, that tick's
    age at ``as_of``, whether it is fresh, and whether the live feed is the
    entity's source: its newest tick lies in the window from ``since`` on. An
    entity that only ticked before the window falls back like one that never did."""
    aged = freshness(newest, as_of, max_age_seconds=max_age_seconds)
    inside = F.col("last_ts") >= since if since is not None else F.col("last_ts").isNotNull()
    return (entities.join(aged, key, "left")
            .withColumn("is_fresh", F.coalesce("is_fresh", F.lit(False)))
            .withColumn("is_real", F.coalesce(inside, F.lit(False))))


def live_else_fallback(live: DataFrame, fallback: DataFrame, key: str = "company_id") -> DataFrame:
    """J-7: keep a key's live rows when it has any, otherwise its fallback
    rows; ``is_real`` tells which. The anti join runs against the distinct
    live keys (one row per key), never against the raw live rows."""
    live_keys = live.select(key).distinct()
    fb = fallback.join(live_keys, key, "left_anti").withColumn("is_real", F.lit(False))
    return live.withColumn("is_real", F.lit(True)).unionByName(fb)


def months_before(as_of: Column, months: int = HISTORY_MONTHS) -> Column:
    """F-8: the first day of the last ``months`` months before ``as_of``."""
    return F.add_months(as_of.cast("date"), -months).cast("timestamp_ntz")


def recent(df: DataFrame, as_of: Column, *, ts: str = "ts", months: int = HISTORY_MONTHS) -> DataFrame:
    """F-8: rows of the last ``months`` months before ``as_of``."""
    return df.where(F.col(ts) >= months_before(as_of, months))


def financials_table(fin: DataFrame) -> DataFrame:
    """R-14: the four statement items per company as formatted text (C-17)."""
    items = F.array(*[F.struct(F.lit(pos).alias("item_pos"), F.lit(label).alias("item"),
                               fmt_money(F.col(col)).alias("value"))
                      for pos, (label, col) in enumerate(FINANCIAL_ITEMS)])
    return fin.select("company_id", F.explode(items).alias("_i")).select("company_id", "_i.*")
