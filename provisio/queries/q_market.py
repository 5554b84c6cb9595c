"""Registered queries: market data (bars, freshness, fallback, index, financials)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import fmt_money
from ..operators import market as mk
from ..plans import market as pm
from ..sources import fixtures
from ..sources.tables import read_table
from . import register

R6 = 6


@register("x1_ohlc_bars_batch", """
select * from prices_live
""", ("prices_live",))
def x1_ohlc_bars_batch(spark, sf):
    return pm.live_bars(spark, sf)


@register("x2_quote_freshness", """
select company_id, last_ts, last_price, (epoch_us(a.as_of_ts) - epoch_us(last_ts)) / 1e6 as age_seconds,
       (epoch_us(a.as_of_ts) - epoch_us(last_ts)) / 1e6 <= 3600 as is_fresh
from (select printf('HK_%05d', user_id) as company_id, max(ts) as last_ts,
             arg_max(value, row(ts, event_id)) as last_price
      from events where event_type <> 'error' group by 1) q,
     (select max(ts) as as_of_ts from events) a
""")
def x2_quote_freshness(spark, sf):
    ev = read_table(spark, sf, "events")
    latest = mk.latest_quotes(ev.where(F.col("event_type") != "error"), key=fixtures.company_id(F.col("user_id")),
                              tiebreak="event_id")
    return mk.freshness(latest, pm.latest_tick(spark, sf))


@register("w2_price_index", f"""
select company_id, step, round(100e0 * exp(sum(ln(1e0 + ret)) over (partition by company_id order by step
                                rows between unbounded preceding and current row)), {R6}) as price
from fallback_returns
""", ("fallback_returns",))
def w2_price_index(spark, sf):
    idx = mk.cumulative_index(fixtures.fallback_returns(spark, sf), key="company_id", order="step")
    return idx.select("company_id", "step", F.round("price", R6).alias("price"))


@register("c20_date_series", """
select f.company_id, a.as_of + to_days(cast(f.step - 89 as integer)) as ts
from fallback_returns f, as_of a
""", ("fallback_returns", "as_of"))
def c20_date_series(spark, sf):
    return pm.fallback_bars(spark, sf).select("company_id", "ts")


@register("c19_report_date", """
select strftime(as_of, '%Y-%m-%d') as report_date from as_of
""", ("as_of",))
def c19_report_date(spark, sf):
    ev = read_table(spark, sf, "events")
    return ev.agg(F.date_format(F.max(F.date_trunc("day", F.col("ts"))), "yyyy-MM-dd").alias("report_date"))


@register("j7_live_else_fallback", f"""
select company_id, ts, round(open, {R6}) as open, round(high, {R6}) as high, round(low, {R6}) as low,
       round(close, {R6}) as close, is_real
from prices_all
""", ("prices_all",))
def j7_live_else_fallback(spark, sf):
    p = pm.prices(spark, sf)
    return p.select("company_id", "ts", *[F.round(c, R6).alias(c) for c in ("open", "high", "low", "close")], "is_real")


@register("f8_last_six_months", """
select company_id, count(*) as n_points from prices_6m group by company_id
""", ("prices_6m",))
def f8_last_six_months(spark, sf):
    r = pm.prices(spark, sf, months=mk.HISTORY_MONTHS)
    return r.groupBy("company_id").agg(F.count(F.lit(1)).alias("n_points"))


@register("f8_last_month", f"""
select company_id, ts, round(close, {R6}) as close, is_real from prices_1m
""", ("prices_1m",))
def f8_last_month(spark, sf):
    """A window that cuts live and simulated series."""
    return pm.prices(spark, sf, months=1).select("company_id", "ts", F.round("close", R6).alias("close"), "is_real")


@register("r15_price_trend", f"""
select company_id, ts, round(close, {R6}) as close, is_real from prices_6m
""", ("prices_6m",))
def r15_price_trend(spark, sf):
    return pm.price_trend(spark, sf).withColumn("close", F.round("close", R6))


@register("j7_in_window", """
select printf('HK_%05d', c_custkey) as company_id, last_ts, (epoch_us(a.now) - epoch_us(last_ts)) / 1e6 as age_seconds,
       coalesce((epoch_us(a.now) - epoch_us(last_ts)) / 1e6 <= 3600, false) as is_fresh,
       c_custkey in (select user_id from live_shifted) as is_real, p.n_points
from customer left join (select user_id, max(ts) as last_ts from feed_shifted group by 1) on user_id = c_custkey
     join (select company_id, count(*) as n_points from prices_shifted group by 1) p on p.company_id = printf('HK_%05d', c_custkey),
     (select max(ts) as now from events) a
""", ("prices_shifted", "feed_shifted", "live_shifted"))
def j7_in_window(spark, sf):
    """Every company's source over a feed with stale companies: those whose
    last tick is older than the window fall back, and all have bars."""
    ticks = fixtures.feed_shifted(spark, sf)
    points = pm.prices(spark, sf, mk.HISTORY_MONTHS, ticks).groupBy("company_id", "is_real").agg(F.count(F.lit(1)).alias("n_points"))
    return pm.source_table(spark, sf, ticks=ticks).join(points, ["company_id", "is_real"], "left")


@register("f8_last_six_months_shifted", f"""
select company_id, ts, round(open, {R6}) as open, round(high, {R6}) as high, round(low, {R6}) as low,
       round(close, {R6}) as close, is_real
from prices_shifted
""", ("prices_shifted",))
def f8_last_six_months_shifted(spark, sf):
    """The window cuts live bars of companies that also tick inside it."""
    p = pm.prices(spark, sf, mk.HISTORY_MONTHS, fixtures.feed_shifted(spark, sf))
    return p.select("company_id", "ts", *[F.round(c, R6).alias(c) for c in ("open", "high", "low", "close")], "is_real")


@register("r15_stale_company", f"""
select company_id, ts, round(close, {R6}) as close from prices_shifted
where company_id in (select printf('HK_%05d', user_id) from feed_shifted) and not is_real
""", ("prices_shifted", "feed_shifted"))
def r15_stale_company(spark, sf):
    """The price trend of the companies that ticked, but not in the window."""
    ticks = fixtures.feed_shifted(spark, sf)
    stale = pm.source_table(spark, sf, ticks=ticks).where(F.col("last_ts").isNotNull() & ~F.col("is_real")).select("company_id")
    return (pm.price_trend(spark, sf, ticks=ticks).where(~F.col("is_real")).join(stale, "company_id", "left_semi")
            .select("company_id", "ts", F.round("close", R6).alias("close")))


@register("j7_company_info_stale", """
select printf('HK_%05d', c_custkey) as company_id, coalesce(l.name,
       coalesce(case c_custkey when 0 then '700.HK' when 1 then '5.HK' when 2 then '1299.HK' when 3 then '3690.HK'
                when 4 then '9988.HK' when 5 then '388.HK' end, '700.HK') || ' (Simulated)') as name,
       'HKD' as currency, l.name is not null as is_real
from customer left join (select c_custkey as k, c_name as name from customer where c_custkey in (select user_id from live_shifted)) l
     on l.k = c_custkey
""", ("live_shifted",))
def j7_company_info_stale(spark, sf):
    """Names and statements follow the same decision as the prices."""
    return pm.company_info(spark, sf, fixtures.feed_shifted(spark, sf))


def _money(col: str) -> str:
    from .layers import rnd

    return (f"case when {col} is null or {col} = 0 then 'N/A' "
            f"when {col} > 1e9 then printf('%.2f B', {rnd(f'{col} / 1e9', 2)}) "
            f"else format('{{:,.0f}}', {rnd(col, 0)}) end")


@register("c17_money_format", f"""
select company_id, {_money('revenue')} as revenue, {_money('net_income')} as net_income,
       {_money('total_debt')} as total_debt, {_money('cash')} as cash
from financials_all
""", ("financials_all",))
def c17_money_format(spark, sf):
    f = pm.financials(spark, sf)
    return f.select("company_id", *[fmt_money(c).alias(c) for c in ("revenue", "net_income", "total_debt", "cash")])


@register("r14_financials_table", f"""
select company_id, 0 as item_pos, 'Total Revenue' as item, {_money('revenue')} as value from financials_all
union all select company_id, 1, 'Net Income', {_money('net_income')} from financials_all
union all select company_id, 2, 'Total Debt', {_money('total_debt')} from financials_all
union all select company_id, 3, 'Cash', {_money('cash')} from financials_all
""", ("financials_all",))
def r14_financials_table(spark, sf):
    return mk.financials_table(pm.financials(spark, sf))


@register("j5_ticker_lookup", """
select printf('HK_%05d', c_custkey) as company_id,
       coalesce(case printf('HK_%05d', c_custkey) when 'HK_00000' then '700.HK' when 'HK_00001' then '5.HK'
                when 'HK_00002' then '1299.HK' when 'HK_00003' then '3690.HK' when 'HK_00004' then '9988.HK'
                when 'HK_00005' then '388.HK' end, '700.HK') as ticker
from customer
""")
def j5_ticker_lookup(spark, sf):
    c = read_table(spark, sf, "customer").select(fixtures.company_id(F.col("c_custkey")).alias("company_id"))
    return c.select("company_id", mk.ticker_for("company_id").alias("ticker"))


@register("j7_company_info_fallback", """
select company_id, name, currency, is_real from financials_all
""", ("financials_all",))
def j7_company_info_fallback(spark, sf):
    return pm.company_info(spark, sf)


