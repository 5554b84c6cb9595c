"""Streaming forms give the batch results."""

import os
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from conftest import SF_SMOKE
from provisio.plans import book_b, market
from provisio.streaming import ticks


def _same(a, b):
    cols = sorted(a.columns)
    return sorted(a.select(*cols).collect()) == sorted(b.select(*cols).collect())


def test_bars_stream_equals_batch(spark):
    assert _same(ticks.ohlc_bars_stream(spark, SF_SMOKE), market.live_bars(spark, SF_SMOKE))


def test_staging_stream_equals_batch(spark):
    s = ticks.staging_stream(spark, SF_SMOKE)
    b = book_b.staged_by_join(spark, SF_SMOKE)
    assert s.count() == b.count()
    assert _same(s.select("loan_id", "stage"), b.select("loan_id", "stage"))


def test_streams_over_files_newest_first_and_delivered_twice(spark):
    """Four arrivals, newest first, then every tick once more: nothing is lost
    and nothing counts twice."""
    from provisio.queries import queries
    from provisio.queries.q_streaming import empty_feed, newest_first
    from provisio.sources.tables import read_table

    ev = read_table(spark, SF_SMOKE, "events")
    for run, batch in ((ticks.ohlc_bars_stream, market.live_bars), (ticks.freshness_from_stream, queries()["x2_quote_freshness"])):
        src = empty_feed(ev, "ticks_test")
        got = run(spark, SF_SMOKE, source=src, arrivals=newest_first(ev, "ts", src, again=True))
        assert spark.read.parquet(src).count() == 2 * ev.count()
        assert _same(got, batch(spark, SF_SMOKE))


def test_rows_without_an_order_value_arrive_with_the_oldest(spark):
    from provisio.queries.q_streaming import empty_feed, newest_first

    df = spark.range(1000).select("id", F.when(F.col("id") % 10 == 0, None).otherwise(F.timestamp_seconds(F.col("id"))).cast("timestamp_ntz").alias("ts"))
    src = empty_feed(df, "null_ts")
    counts = []
    for _ in newest_first(df, "ts", src):
        counts.append(spark.read.parquet(src).count())
    assert counts[-1] == 1000 and spark.read.parquet(src).where("ts is null").count() == 100
    assert counts == sorted(counts) and counts[0] < 400


def _files(path):
    return [os.path.join(d, f) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")]


def test_a_hundred_batches_leave_a_bounded_number_of_files(spark):
    from provisio.session import scratch_path
    from provisio.sources.tables import read_table

    ev = read_table(spark, SF_SMOKE, "events").where("event_id % 5 = 0")
    table = ticks.bars_table(scratch_path(spark, "bounded"))
    days = ev.where("event_type <> 'error'").select(F.date_trunc("day", "ts")).distinct().count()
    for n in range(100):
        table.upsert(ticks.partial_bars(ev.where(F.pmod(F.xxhash64("event_id"), F.lit(100)) == n)), n)
    schema = ticks.partial_bars(ev.limit(0)).schema
    assert len(_files(table.path.removeprefix("file:"))) <= 2 * days
    got = table.read(spark, schema)
    assert _same(got, ticks.partial_bars(ev))


def test_a_retried_batch_counts_once(spark):
    from provisio.session import scratch_path
    from provisio.streaming.merged import MergedTable

    total = lambda rows: rows.groupBy("k").agg(F.sum("n").alias("n"))
    table = MergedTable(scratch_path(spark, "retried"), F.col("k") % 3, total)
    schema = "k long, n long"
    for batch in (0, 1, 1, 2, 2):                     # not idempotent by itself: a sum
        table.upsert(spark.createDataFrame([(k, 10 ** batch) for k in range(6)], schema), batch)
    table.upsert(spark.createDataFrame([(0, 1000), (None, 5)], schema), 3)
    got = {r.k: r.n for r in table.read(spark, spark.createDataFrame([], schema).schema).collect()}
    assert got == {0: 1111, 1: 111, 2: 111, 3: 111, 4: 111, 5: 111, None: 5}


def test_predictions_are_upserted_by_version(spark):
    preds = book_b.predictions(spark, SF_SMOKE).limit(50)
    first = preds.collect()
    rows = [(r.loan_id, 0.1, 0.2, "v1.2") for r in first] + [(r.loan_id, 0.3, 0.4, "v1.10") for r in first] * 2 + [(r.loan_id, 0.9, 0.9, "odd") for r in first]
    batch = spark.createDataFrame(rows, "loan_id string, pd_12m double, pd_lifetime double, model_version string")
    got = ticks.latest_predictions(batch.select("loan_id", "pd_12m", "pd_lifetime", ticks.version_order("model_version").alias("version_no"), F.lit(0).cast("long").alias("arrived")))
    assert {(r.pd_12m, r.pd_lifetime, r.version_no) for r in got.collect()} == {(0.3, 0.4, 1_000_010)} and got.count() == 50


def test_source_switches_by_hand(spark):
    """Stale after 3,600 s and not a microsecond before; repeats count once; a
    company that ticks again is live again."""
    from provisio.streaming import sources

    t = lambda s, us=0: datetime(2024, 1, 1) + timedelta(seconds=s, microseconds=us)
    rows = [(1, 7, t(0), 1.0), (2, 7, t(3600), 2.0), (2, 7, t(3600), 2.0), (3, 7, t(7200, 1), 3.0), (4, 8, t(10), 9.0), (5, 8, None, 1.0), (6, None, t(5), 1.0)]
    feed = spark.createDataFrame(rows, "event_id long, user_id long, ts timestamp_ntz, value double")
    changes = sources.changes_batch(feed)
    got = sorted((r.company_id, r.changed_at, r.is_live, r.price, r.n_ticks) for r in changes.collect())
    assert got == [("HK_00007", t(0), True, 1.0, 0), ("HK_00007", t(7200), False, 2.0, 2), ("HK_00007", t(7200, 1), True, 3.0, 0),
                   ("HK_00007", t(10800, 1), False, 3.0, 1), ("HK_00008", t(10), True, 9.0, 0), ("HK_00008", t(3610), False, 9.0, 1)]
    at = lambda when: {r.company_id: r.is_live for r in sources.source_at(changes, F.lit(str(when)).cast("timestamp_ntz")).collect()}
    assert at(t(7200)) == {"HK_00007": True, "HK_00008": False} and at(t(3610)) == {"HK_00007": True, "HK_00008": True}


def test_stateful_stream_equals_batch_with_late_and_repeated_ticks(spark):
    from provisio.queries import queries
    from provisio.sources import fixtures
    from provisio.streaming import sources

    assert _same(queries()["x2_source_changes_stream"](spark, SF_SMOKE), sources.changes_batch(fixtures.feed(spark, SF_SMOKE)))


class _Handle:
    """The state of one key of a stateful processor: one value and its timers."""

    def __init__(self):
        self.value, self.timers = None, set()

    def getValueState(self, name, schema):
        return self

    exists = lambda self: self.value is not None
    get = lambda self: self.value

    def update(self, value):
        self.value = value

    def clear(self):
        self.value = None

    def registerTimer(self, ms):
        self.timers.add(ms)

    def deleteTimer(self, ms):
        self.timers.remove(ms)


def test_one_call_handles_all_companies_of_a_group():
    """A group's open stretches share one state row and one timer, at the first expiry."""
    from types import SimpleNamespace

    import pandas as pd

    from provisio.streaming import sources

    s = 1_000_000
    switcher, handle = sources._switcher(3600, 60), _Handle()
    switcher.init(handle)
    cols = ["user_id", "first_us", "last_us", "first_price", "last_price", "n_ticks"]
    feed = lambda *rows: [pd.DataFrame(list(rows), columns=cols)]
    at = lambda ms: (SimpleNamespace(getCurrentWatermarkInMs=lambda: ms), SimpleNamespace(getExpiryTimeInMs=lambda: min(handle.timers)))
    rows = lambda frames: sorted(map(tuple, pd.concat(list(frames)).astype(object).itertuples(index=False)))

    def expire(ms):
        timers, info = at(ms)
        fired = info.getExpiryTimeInMs()
        out = rows(switcher.handleExpiredTimer((0,), timers, SimpleNamespace(getExpiryTimeInMs=lambda: fired)))
        handle.timers.discard(fired)
        return out

    got = rows(switcher.handleInputRows((0,), iter(feed((8, 10 * s, 20 * s, 5.0, 6.0, 2), (7, 5000 * s, 5001 * s, 3.0, 4.0, 3)) + feed((7, 0, s, 1.0, 2.0, 4))), None))
    assert got == [(7, 0, True, 1.0, 0), (7, 3601 * s, False, 2.0, 4), (7, 5000 * s, True, 3.0, 0), (8, 10 * s, True, 5.0, 0)]
    assert handle.timers == {3620_000 + 1 + 60_000}                       # that of company 8
    got = rows(switcher.handleInputRows((0,), iter(feed((8, 3620 * s, 3700 * s, 7.0, 8.0, 1), (9, 4000 * s, 4000 * s, 8.5, 9.0, 1))), None))
    assert got == [(9, 4000 * s, True, 8.5, 0)] and handle.value[3] == [3, 3, 1]      # a tick of exactly the age joins: 2 + 1 ticks
    assert handle.timers == {7300_000 + 1 + 60_000}
    assert expire(7_700_000) == [(8, 7300 * s, False, 8.0, 3), (9, 7600 * s, False, 9.0, 1)]
    assert handle.value[0] == [7] and handle.timers == {8601_000 + 1 + 60_000}
    assert expire(9_000_000) == [(7, 8601 * s, False, 4.0, 3)]
    assert handle.value is None and not handle.timers
