"""Registered queries: streaming forms (their results equal the batch ones,
so they share the batch oracle). The tables are replayed as several arrivals,
newest first or nearly in order; a stream is run after each of them from the
same checkpoint."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, functions as F

from ..plans import book_b, market
from ..session import scratch_path
from ..sources import fixtures
from ..sources.tables import read_table
from ..streaming import sources, ticks
from . import REGISTRY, q_loans_b, q_market, register  # noqa: F401  (their oracle texts are reused)

ARRIVALS = 4


def _place(df: DataFrame, order: str) -> Column:
    return (F.col(order).cast("timestamp") if order == "ts" else F.col(order)).cast("double")


def _slices(df: DataFrame, order: str, n: int) -> list[Column]:
    """Conditions of ``n`` slices by quantiles of ``order``, oldest first; rows
    without a value belong to the oldest."""
    value = _place(df, order)
    cuts = df.agg(F.percentile_approx(value, F.array(*[F.lit(i / n) for i in range(1, n)]), 10_000)).first()[0] or []
    bounds = [None, *cuts, None]
    out = []
    for lo, hi in zip(bounds, bounds[1:]):
        part = F.lit(True) if hi is None else value < hi
        out.append(value.isNull() | part if lo is None else (value >= lo) & part)
    return out


def empty_feed(df: DataFrame, name: str) -> str:
    """A fresh folder that a file stream can be opened on before the first arrival."""
    path = scratch_path(df.sparkSession, name)
    df.where(F.lit(False)).write.parquet(path)
    return path


def newest_first(df: DataFrame, order: str, path: str, n: int = ARRIVALS, again: bool = False) -> Iterator[int]:
    """Write ``df`` to ``path`` in ``n`` slices by ``order``, the newest first,
    one each time the iterator is advanced; ``again`` delivers every row once
    more at the end. Slices are written in parallel."""
    for i, part in enumerate([*reversed(_slices(df, order, n)), *([F.lit(True)] if again else [])]):
        df.where(part).write.mode("append").parquet(path)
        yield i


@register("x1_ohlc_bars_stream", REGISTRY["x1_ohlc_bars_batch"].sql)
def x1_ohlc_bars_stream(spark, sf):
    events = read_table(spark, sf, "events")
    feed = empty_feed(events, "ticks_newest_first")
    return ticks.ohlc_bars_stream(spark, sf, source=feed, arrivals=newest_first(events, "ts", feed))


@register("x2_freshness_stream", REGISTRY["x2_quote_freshness"].sql)
def x2_freshness_stream(spark, sf):
    events = read_table(spark, sf, "events")
    feed = empty_feed(events, "ticks_newest_first")
    return ticks.freshness_from_stream(spark, sf, source=feed, arrivals=newest_first(events, "ts", feed))


@register("x3_staging_stream", REGISTRY["j1_features_predictions_join"].sql)
def x3_staging_stream(spark, sf):
    """Every prediction arrives twice, and an older model version after it."""
    preds = book_b.predictions(spark, sf)
    feed = empty_feed(preds, "predictions_newest_first")
    older = preds.withColumn("model_version", F.lit("v0.9")).withColumn("pd_12m", F.lit(0.5))

    def arrivals():
        yield from newest_first(preds, "loan_id", feed, again=True)
        older.write.mode("append").parquet(feed)
        yield -1

    st = ticks.staging_stream(spark, sf, source=feed, arrivals=arrivals())
    return st.select("loan_id", "stage", F.round("pd_12m", 9).alias("pd_12m"), F.round("ecl", 6).alias("ecl"))


SWITCHES = """
select printf('HK_%05d', user_id) as company_id, unnest([min(ts), max(ts) + interval 3600 second]) as changed_at,
       unnest([true, false]) as is_live, unnest([arg_min(value, row(ts, event_id)), arg_max(value, row(ts, event_id))]) as price,
       unnest([0, count(*)])::bigint as n_ticks
from (select *, sum(case when gap <= 3600000000 then 0 else 1 end) over (partition by user_id order by ts, event_id) as stretch
      from (select *, epoch_us(ts) - epoch_us(lag(ts) over (partition by user_id order by ts, event_id)) as gap
            from feed where ts is not null and user_id is not null) f) g
group by user_id, stretch
"""


@register("x2_source_changes_batch", SWITCHES, ("feed",))
def x2_source_changes_batch(spark, sf):
    return sources.changes_batch(fixtures.feed(spark, sf))


def _replayed(spark, sf):
    """The feed in four arrivals, oldest first; a tenth of each comes with the
    next one, another tenth comes twice, and heartbeats close the feed."""
    events = fixtures.feed(spark, sf).select("event_id", "user_id", "ts", "value")
    path = empty_feed(events, "ticks_late")
    first, last = events.agg(F.min("ts"), F.max("ts")).first()
    delay = int((last - first).total_seconds() * 0.6) + 1
    beat = spark.range(1).select(F.lit(None).cast("long").alias("event_id"), F.lit(None).cast("long").alias("user_id"),
                                 F.timestamp_add("SECOND", F.lit(delay + 4 * 3600), F.lit(str(last)).cast("timestamp_ntz")).alias("ts"),
                                 F.lit(None).cast("double").alias("value"))

    def arrivals():
        late = F.pmod(F.xxhash64("event_id"), F.lit(10))
        before = None
        for part in _slices(events, "ts", ARRIVALS):
            own = events.where(part & (late != 0))
            (own if before is None else own.unionByName(events.where(before & (late <= 1)))).write.mode("append").parquet(path)
            before = part
            yield part
        events.where(before & (late <= 1)).write.mode("append").parquet(path)
        yield None
        for _ in range(2):                  # a batch works with the watermark of the one before
            beat.write.mode("append").parquet(path)
            yield None

    stream = spark.readStream.schema(events.schema).option("maxBytesPerTrigger", ticks.BATCH_BYTES).parquet(path)
    return sources.changes_stream(stream, delay=f"{delay} seconds", arrivals=arrivals(),
                                  state_partitions=max(4, spark.sparkContext.defaultParallelism))     # a task a core


@register("x2_source_changes_stream", SWITCHES, ("feed",))
def x2_source_changes_stream(spark, sf):
    """Late and repeated ticks included, the stream's switches are those of the batch."""
    return _replayed(spark, sf)


@register("x2_source_at_report_time", """
select printf('HK_%05d', user_id) as company_id, epoch_us(a.now) - epoch_us(max(ts)) <= 3600000000 as is_live,
       arg_max(value, row(ts, event_id)) as price
from feed, (select max(ts) as now from events) a where ts is not null and user_id is not null group by user_id, a.now
""", ("feed",))
def x2_source_at_report_time(spark, sf):
    """J-7 switched by the stale events: every company's source when the feed ends.
    A live row holds the price it began with, so the price is that of the stretch's end."""
    changes = sources.changes_batch(fixtures.feed(spark, sf))
    now = sources.source_at(changes, market.latest_tick(spark, sf)).select("company_id", "is_live")
    ends = changes.where(~F.col("is_live")).groupBy("company_id").agg(F.max_by("price", "changed_at").alias("price"))
    return now.join(ends, "company_id")
