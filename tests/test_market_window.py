"""Live or fallback is decided inside the window."""

from pyspark.sql import functions as F

from conftest import SF_SMOKE
from provisio.operators import market as mk
from provisio.plans import market
from provisio.sources import fixtures
from provisio.sources.tables import read_table


def test_every_company_has_prices_whatever_its_last_tick(spark):
    ticks = fixtures.feed_shifted(spark, SF_SMOKE)
    companies = read_table(spark, SF_SMOKE, "customer").count()
    sources = market.source_table(spark, SF_SMOKE, ticks=ticks)
    stale = {r.company_id for r in sources.where("last_ts is not null and not is_real").collect()}
    assert len(stale) >= 3 and sources.count() == companies
    prices = market.prices(spark, SF_SMOKE, mk.HISTORY_MONTHS, ticks)
    per = {r.company_id: (r.n, r.real) for r in prices.groupBy("company_id").agg(F.count(F.lit(1)).alias("n"), F.collect_set("is_real").alias("real")).collect()}
    assert len(per) == companies and all(n > 0 and len(real) == 1 for n, real in per.values())
    assert all(per[c] == (90, [False]) for c in stale)
    names = {r.company_id: r for r in market.company_info(spark, SF_SMOKE, ticks).collect()}
    assert all(not names[c].is_real and names[c].name.endswith("(Simulated)") for c in stale)


def test_without_a_window_any_tick_counts_but_not_one_without_a_time(spark):
    none = fixtures.feed(spark, SF_SMOKE).withColumn("ts", F.lit(None).cast("timestamp_ntz"))
    assert fixtures.live_users(none).count() == 0 and fixtures.live_users(none.limit(0)).count() == 0
    shifted = fixtures.feed_shifted(spark, SF_SMOKE)
    assert fixtures.live_users(shifted).count() == fixtures.live_users(fixtures.feed(spark, SF_SMOKE)).count()
    fresh = market.source_table(spark, SF_SMOKE, months=None, ticks=shifted)
    assert fresh.where("is_real <> (last_ts is not null)").count() == 0
    assert fresh.where("is_fresh and age_seconds > 3600").count() == 0 and fresh.where("is_fresh is null").count() == 0
