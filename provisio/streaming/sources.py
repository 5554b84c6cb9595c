"""Live or fallback as a stateful stream (X-2 -> J-7).

Every company's source switches to the live feed with a tick and back to the
fallback when no tick followed for ``FRESHNESS_SECONDS``. The stream emits one
row per switch:

1. Ticks are de-duplicated by event id within the watermark's delay, so a
   redelivered tick neither counts twice nor brings a company back to life.
2. They are reduced to one row per company and ``BUCKET`` of event time, with
   partial aggregates. A bucket leaves this step once the watermark has passed
   it: the next step sees every company in event-time order, and a company
   with a third of all ticks costs one row a bucket.
3. Keyed state (``transformWithState``) holds the open stretches of a group of
   companies (``STATE_GROUPS`` by hash); an event-time timer at the group's
   first expiry closes those that are due. A stretch is due one bucket after
   its expiry, when every tick up to the expiry has been seen. A call of the
   processor costs milliseconds whatever it handles, so its number must not
   grow with the companies: a group's buckets are handled at once, as arrays.

Ticks may arrive up to ``delay`` late in any order without changing the result;
later ones are dropped by the watermark, as in any such stream. The batch form
gives the same rows for a complete feed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import market as mk
from ..session import scratch_path
from ..sources.fixtures import company_id
from .ticks import Arrivals, run_stream

BUCKET_SECONDS = 60
STATE_GROUPS = 256         # groups of companies that share a state row and a call
DELAY = "10 minutes"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
CHANGES = "user_id long, at_us long, is_live boolean, price double, n_ticks long"


def _named(changes: DataFrame) -> DataFrame:
    """Microseconds to the feed's time type, ids to names."""
    at = F.timestamp_add("MICROSECOND", F.col("at_us"), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
    return changes.select(company_id(F.col("user_id")).alias("company_id"), at.alias("changed_at"), "is_live", "price", "n_ticks")


def changes_batch(ticks: DataFrame, *, max_age_seconds: int = mk.FRESHNESS_SECONDS) -> DataFrame:
    """The switches of a complete feed: a company's stretches of ticks with no
    gap over ``max_age_seconds``; each begins with a live row (its first price)
    and ends with a fallback row (its last price and number of ticks)."""
    order = mk.tick_order("ts", "event_id")
    gap = f"{max_age_seconds} seconds"          # a tick at the very end still joins: a quote of exactly that age is fresh
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    once = ticks.where(F.col("ts").isNotNull() & F.col("user_id").isNotNull()).dropDuplicates(["event_id"])
    stretches = once.groupBy("user_id", F.session_window(F.col("ts").cast("timestamp"), gap)).agg(
        F.min(us).alias("first_us"), F.max(us).alias("last_us"), F.min_by("value", order).alias("first_price"),
        F.max_by("value", order).alias("last_price"), F.count(F.lit(1)).alias("n_ticks"))
    both = F.array(
        F.struct(F.col("first_us").alias("at_us"), F.lit(True).alias("is_live"), F.col("first_price").alias("price"), F.lit(0).cast("long").alias("n_ticks")),
        F.struct((F.col("last_us") + max_age_seconds * 1_000_000).alias("at_us"), F.lit(False).alias("is_live"), F.col("last_price").alias("price"), F.col("n_ticks")))
    return _named(stretches.select("user_id", F.explode(both).alias("c")).select("user_id", "c.*"))


def _switcher(max_age_seconds: int, bucket_seconds: int):
    """The stateful processor of one group of companies; defined here so that it
    travels to the tasks by value. One call handles all of a group's buckets."""
    from pyspark.sql.streaming import StatefulProcessor

    age = max_age_seconds * 1_000_000
    expires_ms = lambda last_us: (last_us + age) // 1000 + 1 + bucket_seconds * 1000

    def frame(user_id, at_us, is_live, price, n_ticks):
        import pandas as pd

        return pd.DataFrame({"user_id": user_id, "at_us": at_us, "is_live": is_live, "price": price, "n_ticks": n_ticks})

    class Switcher(StatefulProcessor):
        def init(self, handle):
            self.handle = handle
            self.open = handle.getValueState("open", "user_id array<long>, last_us array<long>, price array<double>, n_ticks array<long>, timer_ms long")

        def held(self):
            """The group's open stretches as arrays, and its timer."""
            import numpy as np

            user_id, last_us, price, n_ticks, timer_ms = self.open.get() if self.open.exists() else ([], [], [], [], None)
            return (np.array(user_id, dtype=np.int64), np.array(last_us, dtype=np.int64), np.array(price, dtype=np.float64),
                    np.array(n_ticks, dtype=np.int64), timer_ms)

        def keep(self, user_id, last_us, price, n_ticks, timer_ms):
            """Hold these stretches, with a timer at the first expiry among them."""
            first = int(expires_ms(last_us.min())) if len(last_us) else None
            if first != timer_ms:
                if timer_ms is not None:
                    self.handle.deleteTimer(timer_ms)
                if first is not None:
                    self.handle.registerTimer(first)
            if first is None:
                self.open.clear()
            else:
                self.open.update((user_id.tolist(), last_us.tolist(), price.tolist(), n_ticks.tolist(), first))

        def handleInputRows(self, key, rows, timerValues):
            import numpy as np
            import pandas as pd

            new = pd.concat(list(rows), ignore_index=True)
            h_user, h_last, h_price, h_n, timer_ms = self.held()
            joined = lambda held, column: np.concatenate([held, new[column].to_numpy(dtype=held.dtype)])
            user, first, last = joined(h_user, "user_id"), joined(h_last, "first_us"), joined(h_last, "last_us")
            first_price, last_price, n = joined(h_price, "first_price"), joined(h_price, "last_price"), joined(h_n, "n_ticks")
            is_new = np.arange(len(user)) >= len(h_user)
            order = np.lexsort((last, first, is_new, user))          # a company's open stretch, then its buckets
            user, first, last, first_price, last_price, n, is_new = (x[order] for x in (user, first, last, first_price, last_price, n, is_new))
            other = np.append(True, user[1:] != user[:-1])
            starts = np.flatnonzero(other | np.append(True, first[1:] > last[:-1] + age))
            ends = np.append(starts[1:], len(user)) - 1
            ticks = np.add.reduceat(n, starts)
            stays = np.append(other[starts[1:]], True)               # a company's last stretch
            begun, closed = starts[is_new[starts]], ends[~stays]
            yield frame(np.append(user[begun], user[closed]), np.append(first[begun], last[closed] + age),
                        np.arange(len(begun) + len(closed)) < len(begun), np.append(first_price[begun], last_price[closed]),
                        np.append(np.zeros(len(begun), dtype=np.int64), ticks[~stays]))
            at = ends[stays]
            self.keep(user[at], last[at], last_price[at], ticks[stays], timer_ms)

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            user, last, price, n, timer_ms = self.held()
            due = expires_ms(last) <= max(timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs())
            yield frame(user[due], last[due] + age, False, price[due], n[due])
            # the timer that fired is removed by Spark
            self.keep(user[~due], last[~due], price[~due], n[~due], None if timer_ms == expiredTimerInfo.getExpiryTimeInMs() else timer_ms)

        def close(self):
            pass

    return Switcher()


def changes_stream(ticks: DataFrame, *, delay: str = DELAY, max_age_seconds: int = mk.FRESHNESS_SECONDS,
                   arrivals: Arrivals = None, state_partitions: int | None = None) -> DataFrame:
    """The switches found so far by the stream over ``ticks`` (a streaming frame
    with event_id, user_id, ts, value; a row without a user only moves the
    watermark). ``state_partitions`` is fixed by the first run; by default the
    session's number of shuffle partitions."""
    spark = ticks.sparkSession
    out = scratch_path(spark, "source-changes")
    order = mk.tick_order("ts", "event_id")
    us = F.unix_micros("_at")
    timed = ticks.withColumn("_at", F.col("ts").cast("timestamp")).withWatermark("_at", delay)
    # the condition names the event time, so the optimiser leaves it above the watermark
    owned = F.when(F.col("user_id").isNotNull(), F.col("_at")).isNotNull()
    once = timed.where(owned).dropDuplicatesWithinWatermark(["event_id"])
    buckets = once.groupBy("user_id", F.window("_at", f"{BUCKET_SECONDS} seconds")).agg(
        F.min(us).alias("first_us"), F.max(us).alias("last_us"), F.min_by("value", order).alias("first_price"),
        F.max_by("value", order).alias("last_price"), F.count(F.lit(1)).alias("n_ticks"))
    grouped = buckets.withColumn("state_group", F.pmod(F.xxhash64("user_id"), F.lit(STATE_GROUPS)))
    changes = grouped.groupBy("state_group").transformWithStateInPandas(_switcher(max_age_seconds, BUCKET_SECONDS), CHANGES, "append", "eventTime")

    def write(batch: DataFrame, n: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch_id={n}")

    settings = {"spark.sql.streaming.stateStore.providerClass": _ROCKS}
    if state_partitions:
        settings["spark.sql.shuffle.partitions"] = str(state_partitions)
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        run_stream(changes, "source-changes", write, arrivals)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    return _named(spark.read.schema(CHANGES).parquet(f"{out}/batch_id=*"))


def source_at(changes: DataFrame, as_of) -> DataFrame:
    """J-7 from the switches: every company that ever ticked with its source at
    ``as_of`` and since when. A fallback row counts from just after its time: a
    quote of exactly the allowed age is still fresh."""
    us = F.unix_micros(F.col("changed_at").cast("timestamp"))
    now = F.unix_micros(as_of.cast("timestamp"))
    passed = changes.where(F.when(F.col("is_live"), us <= now).otherwise(us < now))
    # one number: the time, and of two switches at one moment the live one last
    order = us * 2 + F.col("is_live").cast("long")
    return passed.groupBy("company_id").agg(F.max_by("is_live", order).alias("is_live"), F.max_by("changed_at", order).alias("since"),
                                            F.max_by("price", order).alias("price"))
