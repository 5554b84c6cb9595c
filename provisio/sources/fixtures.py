"""Input tables of the reference's shapes, derived from the driver's test
tables (FIXTURES.md §2–3), built with the DataFrame API.

Each builder reads whole tables; joins are left to the planner (sort-merge
at scale with AQE skew splitting, broadcast when a side is small at run
time), aggregates run partial + final so a hot customer never lands in one
task unaggregated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .tables import read_table

# Fixed values of the fixtures (FIXTURES.md): growth cut-over date, the
# segment → industry map, and the fallback series length (90 daily points).
GROWTH_CUTOVER = "1998-05-01 00:00:00"
SEGMENT_TO_INDUSTRY = {"AUTOMOBILE": "Manufacturing", "BUILDING": "Services", "MACHINERY": "Tech"}
OTHER_INDUSTRY = "Retail"
FALLBACK_STEPS = 90
STALE_DAYS = 400


def _orders_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus", "o_orderpriority", "o_orderdate")
    customers = read_table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    return orders.join(customers, orders.o_custkey == customers.c_custkey, "inner")


def _urgent_failed() -> Column:
    return (F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "1-URGENT")


def raw_loans(spark: SparkSession, sf_dir: str, *, with_dates: bool = False) -> DataFrame:
    """Pipeline A input ``raw_loans`` (one loan per order); ``with_dates``
    adds the origination date (the order date) for period analyses."""
    oc = _orders_customers(spark, sf_dir)
    extra = [F.col("o_orderdate").alias("origination_date")] if with_dates else []
    return oc.select(
        F.format_string("LOAN_%06d", F.col("o_orderkey") + 1).alias("loan_id"),
        F.when(F.col("c_acctbal") > 0, F.col("c_acctbal") * 12).otherwise(F.lit(0.0)).alias("income"),
        (F.col("o_totalprice") / 25).alias("total_debt"),
        (F.lit(300) + (F.col("o_orderkey") * 37 + F.col("o_custkey")) % 551).cast("int").alias("fico_score"),
        (F.col("o_totalprice") / 5).alias("loan_amount"),
        F.when(_urgent_failed(), 1).otherwise(0).alias("default_flag"),
        *extra,
    )


def raw_landing_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pipeline B landing table with the raw text columns of the source file."""
    oc = _orders_customers(spark, sf_dir)
    k = F.col("o_orderkey")
    c = F.col("o_custkey")
    grade = F.substr(F.lit("ABCDEFG"), (c % 7 + 1).cast("int"), F.lit(1))
    mix = k * 37 + c
    status = (F.when(k % 101 == 0, "Late (16-30 days)")
              .when(k % 103 == 0, "Does not meet the credit policy. Status:Charged Off")
              .when(F.col("o_orderstatus") == "P", "Current")
              .when(_urgent_failed(), "Charged Off")
              .when((F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "2-HIGH"), "Late (31-120 days)")
              .when((F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "3-MEDIUM"), "Default")
              .when((F.col("o_orderstatus") == "O") & (F.col("o_orderpriority") == "5-LOW"), "In Grace Period")
              .otherwise("Fully Paid"))
    emp = (F.when(k % 14 == 0, F.lit(None).cast("string"))
           .when(k % 14 == 1, "n/a").when(k % 14 == 2, "< 1 year").when(k % 14 == 3, "1 year")
           .when(k % 14 == 13, "10+ years")
           .otherwise(F.concat((k % 14 - 2).cast("string"), F.lit(" years"))))
    return oc.select(
        k.alias("id"),
        F.when(k % 97 == 0, F.lit(None).cast("double")).when(k % 89 == 0, F.lit(0.0))
         .otherwise(F.col("o_totalprice") / 5).alias("loan_amnt"),
        emp.alias("emp_length"),
        F.when(c % 23 == 0, F.lit(None).cast("double")).otherwise(F.col("c_acctbal") * 12).alias("annual_inc"),
        grade.alias("grade"),
        F.concat(grade, (k % 5 + 1).cast("string")).alias("sub_grade"),
        F.when(k % 11 == 0, F.lit(None).cast("double")).otherwise((k % 60).cast("double")).alias("dti"),
        (F.col("o_totalprice") / 180).alias("installment"),
        status.alias("loan_status"),
        F.when(k % 13 == 0, F.lit(None).cast("double")).otherwise((290 + mix % 580).cast("double")).alias("fico_range_low"),
        F.when(k % 13 == 0, F.lit(None).cast("double")).otherwise((294 + mix % 580).cast("double")).alias("fico_range_high"),
        F.when(k % 26 == 0, F.lit(None).cast("double")).otherwise((400 + k % 400).cast("double")).alias("last_fico_range_low"),
        F.when(k % 26 == 0, F.lit(None).cast("double")).otherwise((404 + k % 400).cast("double")).alias("last_fico_range_high"),
        F.concat((5 + k % 20).cast("string"), F.lit("."), (10 + k % 90).cast("string"), F.lit("%")).alias("int_rate"),
        F.when(k % 3 == 0, " 60 months").when(k % 41 == 0, F.lit(None).cast("string"))
         .otherwise(" 36 months").alias("term"),
        F.when(k % 3 == 0, "RENT").when(k % 3 == 1, "MORTGAGE").otherwise("OWN").alias("home_ownership"),
        F.when(k % 2 == 0, "Verified").otherwise("Not Verified").alias("verification_status"),
    )


def company_id(key: Column) -> Column:
    """P-22: zero-padded company id ``HK_%05d``."""
    return F.format_string("HK_%05d", key)


def industry_of(segment: Column) -> Column:
    expr = None
    for seg, ind in SEGMENT_TO_INDUSTRY.items():
        expr = (F.when(segment == seg, ind) if expr is None else expr.when(segment == seg, ind))
    return expr.otherwise(OTHER_INDUSTRY)


def sme_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SME feature table: one company per customer, ratios from its orders,
    and a deterministic ``true_label`` (fixed-coefficient PD against a
    per-company uniform draw)."""
    from ..operators.score import pd_sme_fixed

    orders = read_table(spark, sf_dir, "orders").select(
        "o_custkey", "o_totalprice", "o_orderdate", "o_orderstatus", "o_orderpriority")
    customers = read_table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    cut = F.lit(GROWTH_CUTOVER).cast("timestamp_ntz")
    price = F.col("o_totalprice")
    # aggregate the orders per customer first (partial aggregation in every
    # task, so a customer with most of the orders is reduced before the
    # shuffle), then join the one-row-per-customer result to the customers
    per_customer = orders.groupBy("o_custkey").agg(
        F.sum(F.when(F.col("o_orderdate") >= cut, price).otherwise(0.0)).alias("_late"),
        F.sum(F.when(F.col("o_orderdate") < cut, price).otherwise(0.0)).alias("_early"),
        F.sum(F.when(F.col("o_orderstatus") == "O", price).otherwise(0.0)).alias("_open"),
        F.sum(price).alias("_total"),
        F.stddev_samp(price).alias("_sd"),
        F.avg(price).alias("_avg"),
        F.sum(F.when(_urgent_failed(), 1).otherwise(0)).alias("_defaults"),
    )
    agg = customers.join(per_customer, customers.c_custkey == per_customer.o_custkey, "inner")
    feats = agg.select(
        company_id(F.col("c_custkey")).alias("company_id"),
        F.round(F.coalesce(F.try_divide(F.col("_late"), F.nullif(F.col("_early"), F.lit(0.0))) - 1, F.lit(0.0)), 6)
         .alias("revenue_growth"),
        F.round(F.try_divide(F.col("_open"), F.col("_total")), 6).alias("debt_to_asset_ratio"),
        F.round(F.coalesce(F.try_divide(F.col("_sd"), F.col("_avg")), F.lit(0.0)) * 2.5, 6).alias("cash_flow_volatility"),
        industry_of(F.col("c_mktsegment")).alias("industry"),
        F.when(F.col("_defaults") >= 2, 1).otherwise(0).alias("past_default"),
        ((F.col("c_custkey") * 7919) % 1000 / 1000.0).alias("_draw"),
    )
    pd_true = pd_sme_fixed(F.col("revenue_growth"), F.col("debt_to_asset_ratio"),
                           F.col("cash_flow_volatility"), F.col("past_default"))
    return feats.withColumn("true_label", F.when(F.col("_draw") < pd_true, 1).otherwise(0)).drop("_draw")


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The live feed's ticks: every event that is no error."""
    return read_table(spark, sf_dir, "events").where(F.col("event_type") != "error")


def feed_shifted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed with stale companies: a third of the users ticked
    ``STALE_DAYS`` earlier, another third has every second tick there."""
    old = (F.col("user_id") % 3 == 0) | ((F.col("user_id") % 3 == 1) & (F.col("event_id") % 2 == 0))
    return feed(spark, sf_dir).withColumn("ts", F.when(old, F.col("ts") - F.make_dt_interval(F.lit(STALE_DAYS))).otherwise(F.col("ts")))


def prices_live(ticks: DataFrame, since: Column | None = None) -> DataFrame:
    """Daily OHLC bars of the live feed (batch form of X-1), of the days from
    ``since`` on. The bound is on the raw tick time, so the scan takes it;
    ticks are grouped by the integer user id and named last."""
    from ..operators.market import ohlc_bars

    if since is not None:
        ticks = ticks.where(F.col("ts") >= since)
    bars = ohlc_bars(ticks, key=F.col("user_id"), ts="ts", price="value", tiebreak="event_id")
    return bars.withColumn("company_id", company_id(F.col("company_id")))


def live_users(ticks: DataFrame, since: Column | None = None) -> DataFrame:
    """Customer keys whose newest tick lies in the window from ``since`` on
    (with a tick at all, without it). The bound reaches the scan: a key's
    newest tick is inside if any of its ticks is."""
    from ..operators.market import newest_ticks

    inside = ticks if since is None else ticks.where(F.col("ts") >= since)
    return newest_ticks(inside, "user_id").select(F.col("user_id").alias("c_custkey"))


def fallback_returns(spark: SparkSession, sf_dir: str, without: DataFrame | None = None) -> DataFrame:
    """Deterministic stand-in for the mock price series: 90 daily returns in
    [−2 %, +2 %] for every company (the mock exists for any ticker), except
    the customer keys ``without``, which go before the series is expanded."""
    from ..operators.stress import spread_for_expansion

    customers = read_table(spark, sf_dir, "customer").select("c_custkey")
    if without is not None:
        customers = customers.join(without, "c_custkey", "left_anti")
    customers = spread_for_expansion(customers)
    steps = customers.select("c_custkey", F.explode(F.sequence(F.lit(0), F.lit(FALLBACK_STEPS - 1))).alias("step"))
    return steps.select(
        company_id(F.col("c_custkey")).alias("company_id"),
        F.col("step").cast("long").alias("step"),
        (((F.col("step") * 37 + F.col("c_custkey") * 101) % 401 - 200) / 10000.0).alias("ret"),
    )


def financials_live(spark: SparkSession, sf_dir: str, users: DataFrame) -> DataFrame:
    """Live financial statement items of the customers ``users`` (those whose
    source is the live feed)."""
    orders = read_table(spark, sf_dir, "orders").select("o_custkey", "o_totalprice", "o_orderstatus")
    customers = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    live = customers.join(users, "c_custkey", "left_semi")
    per = orders.groupBy("o_custkey").agg(
        F.sum("o_totalprice").alias("_rev"),
        F.sum(F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice")).otherwise(-F.col("o_totalprice") / 10)).alias("_ni"),
        F.sum(F.when(F.col("o_orderstatus") == "O", F.col("o_totalprice")).otherwise(0.0)).alias("_debt"),
    )
    j = live.join(per, live.c_custkey == per.o_custkey, "left")
    return j.select(
        company_id(F.col("c_custkey")).alias("company_id"),
        F.round(F.coalesce(F.col("_rev"), F.lit(0.0)) * 1000, 2).alias("revenue"),
        F.round(F.coalesce(F.col("_ni"), F.lit(0.0)) * 1000, 2).alias("net_income"),
        F.round(F.coalesce(F.col("_debt"), F.lit(0.0)) * 1000, 2).alias("total_debt"),
        F.round(F.col("c_acctbal") * 1000000, 2).alias("cash"),
        F.lit("HKD").alias("currency"),
        F.col("c_name").alias("name"),
    )
