"""Market side of the dashboard, for every company at once: live bars
where the feed has them, a simulated series otherwise; financials; the
6-month price trend; company names and sources for the memo header."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators import market as mk
from ..sources import fixtures
from ..sources.tables import read_table


def latest_tick(spark: SparkSession, sf_dir: str) -> Column:
    """Timestamp of the newest tick in the feed, as an NTZ literal (one scalar,
    carried as text so no time-zone conversion touches it)."""
    ev = read_table(spark, sf_dir, "events").agg(F.max("ts").alias("m"))
    text = ev.select(F.date_format("m", "yyyy-MM-dd HH:mm:ss.SSSSSS")).first()[0]
    return F.lit(text).cast("timestamp_ntz")


def as_of_day(spark: SparkSession, sf_dir: str) -> Column:
    """C-19: the report date — the day of the latest tick in the feed (one scalar)."""
    ts = read_table(spark, sf_dir, "events").agg(F.max("ts").alias("m"))
    day = ts.select(F.date_format(F.col("m").cast("date"), "yyyy-MM-dd")).first()[0]
    return F.lit(f"{day} 00:00:00").cast("timestamp_ntz")    # text, not a datetime: no time-zone shift


def live_bars(spark: SparkSession, sf_dir: str, since: Column | None = None) -> DataFrame:
    return fixtures.prices_live(fixtures.feed(spark, sf_dir), since)


def window_start(spark: SparkSession, sf_dir: str, months: int | None) -> Column | None:
    """F-8: the first moment of the last ``months`` months before the report day."""
    return None if months is None else mk.months_before(as_of_day(spark, sf_dir), months)


def source_table(spark: SparkSession, sf_dir: str, months: int | None = mk.HISTORY_MONTHS, ticks: DataFrame | None = None) -> DataFrame:
    """J-7: every company's newest tick, its age and freshness (X-2), and
    whether its data come from the live feed, decided inside the window. One
    aggregate of the feed; the companies join one row a user."""
    ticks = fixtures.feed(spark, sf_dir) if ticks is None else ticks
    companies = read_table(spark, sf_dir, "customer").select("c_custkey")
    newest = mk.newest_ticks(ticks, "user_id").withColumnRenamed("user_id", "c_custkey")
    found = mk.sources(companies, newest, "c_custkey", as_of=latest_tick(spark, sf_dir), since=window_start(spark, sf_dir, months))
    return found.select(fixtures.company_id(F.col("c_custkey")).alias("company_id"), "last_ts", "age_seconds", "is_fresh", "is_real")


def fallback_bars(spark: SparkSession, sf_dir: str, as_of: Column | None = None, without: DataFrame | None = None) -> DataFrame:
    """Simulated daily series (90 points ending at ``as_of``, C-20 + W-2)."""
    as_of = as_of if as_of is not None else as_of_day(spark, sf_dir)
    idx = mk.cumulative_index(fixtures.fallback_returns(spark, sf_dir, without), key="company_id", order="step",
                              bounded_groups=True)   # exactly 90 rows per company
    last = fixtures.FALLBACK_STEPS - 1
    ts = F.timestamp_add("DAY", F.col("step") - F.lit(last), as_of)
    p = F.col("price")
    return idx.select("company_id", ts.alias("ts"), p.alias("open"), p.alias("high"), p.alias("low"), p.alias("close"))


def prices(spark: SparkSession, sf_dir: str, months: int | None = None, ticks: DataFrame | None = None) -> DataFrame:
    """J-7 over bars: live where available, simulated otherwise; with
    ``months`` only the bars of that many months before the report day (F-8),
    and a company falls back if its feed is empty in that window.

    The feed is scanned once for the bars and once for its users' newest ticks,
    both with the time bound in the scan. Companies on the feed leave before
    the simulated series is expanded, so only the others are computed.
    """
    ticks = fixtures.feed(spark, sf_dir) if ticks is None else ticks
    as_of = as_of_day(spark, sf_dir)
    since = None if months is None else mk.months_before(as_of, months)
    simulated = fallback_bars(spark, sf_dir, as_of, without=fixtures.live_users(ticks, since))
    if since is not None:
        simulated = simulated.where(F.col("ts") >= since)
    return fixtures.prices_live(ticks, since).withColumn("is_real", F.lit(True)) \
        .unionByName(simulated.withColumn("is_real", F.lit(False)))


def financials(spark: SparkSession, sf_dir: str, months: int | None = mk.HISTORY_MONTHS, ticks: DataFrame | None = None) -> DataFrame:
    """J-7 over statements: live items for companies whose feed is live in the
    window, the simulated set (and ``<ticker> (Simulated)`` as name) for all others."""
    ticks = fixtures.feed(spark, sf_dir) if ticks is None else ticks
    live = fixtures.financials_live(spark, sf_dir, fixtures.live_users(ticks, window_start(spark, sf_dir, months)))
    companies = read_table(spark, sf_dir, "customer").select(fixtures.company_id(F.col("c_custkey")).alias("company_id"))
    m = mk.MOCK_FINANCIALS
    fallback = companies.select(
        "company_id", F.lit(m["revenue"]).alias("revenue"), F.lit(m["net_income"]).alias("net_income"),
        F.lit(m["total_debt"]).alias("total_debt"), F.lit(m["cash"]).alias("cash"),
        F.lit(mk.DEFAULT_CURRENCY).alias("currency"),
        F.concat(mk.ticker_for("company_id"), F.lit(mk.SIMULATED_SUFFIX)).alias("name"))
    return mk.live_else_fallback(live, fallback)


def company_info(spark: SparkSession, sf_dir: str, ticks: DataFrame | None = None) -> DataFrame:
    return financials(spark, sf_dir, ticks=ticks).select("company_id", "name", "currency", "is_real")


def price_trend(spark: SparkSession, sf_dir: str, months: int = mk.HISTORY_MONTHS, ticks: DataFrame | None = None) -> DataFrame:
    """R-15: (ts, close) per company over the last six months (F-8)."""
    return prices(spark, sf_dir, months, ticks).select("company_id", "ts", "close", "is_real")
