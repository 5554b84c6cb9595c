"""Streaming OHLC bars (X-1), latest quotes for freshness (X-2), and stage +
ECL on arriving predictions (X-3).

These three streams hold no keyed state and no watermark, so no row is ever
too late: each micro-batch is reduced to partial results that can be merged
(first and last by an order key, minimum, maximum, the latest version) and
merged into a table in buckets (:mod:`.merged`); only the buckets a batch
touches are rewritten. Files may arrive in any order, and a row delivered twice
changes nothing. :mod:`.sources` is the stateful stream over the same ticks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import market as mk, staging
from ..session import scratch_path
from ..sources.fixtures import company_id
from ..sources.tables import land, read_table
from .merged import MergedTable

BATCH_BYTES = 1 << 30     # input bytes a micro-batch takes (at least one file)
KEY_BUCKETS = 64          # buckets of tables without a natural one
Arrivals = Iterable[object] | None


def tick_stream(spark: SparkSession, sf_dir: str, *, source: str | None = None,
                glob: str = "events.parquet", batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """The events table as a file stream, from the test folder or from
    ``source`` (a folder of event files), ``batch_bytes`` at a time."""
    schema = read_table(spark, sf_dir, "events").schema
    reader = spark.readStream.schema(schema).option("maxBytesPerTrigger", batch_bytes)
    return reader.option("pathGlobFilter", glob).parquet(sf_dir) if source is None else reader.parquet(source)


def run_stream(stream_df: DataFrame, name: str, write_batch: Callable[[DataFrame, int], None], arrivals: Arrivals = None) -> None:
    """Run ``stream_df`` until its input is used up (availableNow). With
    ``arrivals`` once after each of them (an iterable that puts the next files
    there when it is advanced), every time from the same checkpoint."""
    ckpt = scratch_path(stream_df.sparkSession, f"{name}-checkpoint")
    for _ in [None] if arrivals is None else arrivals:
        q = (stream_df.writeStream.outputMode("append").foreachBatch(write_batch)
             .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
        q.awaitTermination()


def partial_bars(ticks: DataFrame) -> DataFrame:
    """Mergeable daily bars: the order keys of the first and last tick travel along."""
    order = mk.tick_order("ts", "event_id")
    day = F.date_trunc("day", F.col("ts")).cast(ticks.schema["ts"].dataType)
    return ticks.where(F.col("event_type") != "error").groupBy(F.col("user_id"), day.alias("ts")).agg(
        F.min(order).alias("first_key"), F.min_by("value", order).alias("open"), F.max("value").alias("high"),
        F.min("value").alias("low"), F.max(order).alias("last_key"), F.max_by("value", order).alias("close"))


def merge_partial_bars(partials: DataFrame) -> DataFrame:
    return partials.groupBy("user_id", "ts").agg(
        F.min("first_key").alias("first_key"), F.min_by("open", "first_key").alias("open"), F.max("high").alias("high"),
        F.min("low").alias("low"), F.max("last_key").alias("last_key"), F.max_by("close", "last_key").alias("close"))


def bars_table(path: str) -> MergedTable:
    """Partial bars by day: a batch rewrites the days it has ticks of."""
    return MergedTable(path, F.coalesce(F.date_format("ts", "yyyy-MM-dd"), F.lit("none")), merge_partial_bars)


def ohlc_bars_stream(spark: SparkSession, sf_dir: str, *, source: str | None = None, batch_bytes: int = BATCH_BYTES,
                     arrivals: Arrivals = None, path: str | None = None) -> DataFrame:
    """X-1: daily OHLC bars from the tick stream. Partial bars of each
    micro-batch (one hash aggregate, so a busy ticker is not one task) are
    merged into the days they belong to."""
    table = bars_table(path or scratch_path(spark, "ohlc_bars"))
    ticks = tick_stream(spark, sf_dir, source=source, batch_bytes=batch_bytes)
    run_stream(ticks, "ohlc_bars", lambda batch, n: table.upsert(partial_bars(batch), n), arrivals)
    schema = partial_bars(read_table(spark, sf_dir, "events").limit(0)).schema
    return table.read(spark, schema).select(company_id(F.col("user_id")).alias("company_id"), "ts", "open", "high", "low", "close")


def partial_quotes(ticks: DataFrame) -> DataFrame:
    """Mergeable latest quote per user, with its order key."""
    order = mk.tick_order("ts", "event_id")
    return ticks.where(F.col("event_type") != "error").groupBy("user_id").agg(
        F.max(order).alias("last_key"), F.max("ts").alias("last_ts"), F.max_by("value", order).alias("last_price"))


def merge_quotes(partials: DataFrame) -> DataFrame:
    return partials.groupBy("user_id").agg(F.max("last_key").alias("last_key"), F.max("last_ts").alias("last_ts"),
                                           F.max_by("last_price", "last_key").alias("last_price"))


def _hashed(*names: str):
    return F.pmod(F.xxhash64(*names), F.lit(KEY_BUCKETS))


def freshness_from_stream(spark: SparkSession, sf_dir: str, *, source: str | None = None, batch_bytes: int = BATCH_BYTES,
                          arrivals: Arrivals = None) -> DataFrame:
    """X-2: latest quote per company, merged batch by batch, and its age at
    the time of the newest tick in the feed."""
    from ..plans.market import latest_tick

    table = MergedTable(scratch_path(spark, "quotes"), _hashed("user_id"), merge_quotes)
    ticks = tick_stream(spark, sf_dir, source=source, batch_bytes=batch_bytes)
    run_stream(ticks, "quotes", lambda batch, n: table.upsert(partial_quotes(batch), n), arrivals)
    latest = table.read(spark, partial_quotes(read_table(spark, sf_dir, "events").limit(0)).schema)
    return mk.freshness(latest.select(company_id(F.col("user_id")).alias("company_id"), "last_ts", "last_price"),
                        latest_tick(spark, sf_dir))


# ---------------- X-3 ----------------
PREDICTED = ("pd_12m", "pd_lifetime")


def version_order(version: str) -> F.Column:
    """A model version ``v<major>.<minor>`` as one number that sorts like it;
    anything else comes first."""
    found = lambda i: F.try_to_number(F.nullif(F.regexp_extract(version, r"^v(\d{1,6})\.(\d{1,6})$", i), F.lit("")), F.lit("999999")).cast("long")
    return F.coalesce(found(1) * 1_000_000 + found(2), F.lit(-1).cast("long"))


def latest_predictions(rows: DataFrame) -> DataFrame:
    """One prediction a loan: the highest model version; of those the latest
    batch, then the highest PD. The order is one fixed-width number, so this
    stays a hash aggregate and a prediction delivered often is reduced at once."""
    dec = "decimal(38,0)"
    pd_steps = F.floor(F.coalesce("pd_12m", F.lit(-1.0)) * 1e9).cast("long")
    order = (F.col("version_no").cast(dec) * F.lit(10 ** 9).cast(dec) + F.col("arrived").cast(dec)).cast("decimal(27,0)") * F.lit(10 ** 10).cast("decimal(11,0)") \
        + pd_steps.cast("decimal(20,0)")
    return rows.withColumn("_order", order.cast(dec)).groupBy("loan_id").agg(
        *[F.max_by(c, "_order").alias(c) for c in (*PREDICTED, "version_no", "arrived")])


def staging_stream(spark: SparkSession, sf_dir: str, *, source: str | None = None, batch_bytes: int = BATCH_BYTES,
                   arrivals: Arrivals = None) -> DataFrame:
    """X-3: predictions arrive as files and are upserted by loan: the latest
    model version stays, whatever the order of arrival, and a prediction
    delivered twice counts once. The staged loans are the features joined to
    the merged predictions, with the batch flow's stage and ECL functions."""
    from ..plans import book_b

    feed = source or land(book_b.predictions(spark, sf_dir), name="predictions_feed")
    schema = book_b.predictions(spark, sf_dir).schema
    preds = spark.readStream.schema(schema).option("maxBytesPerTrigger", batch_bytes).parquet(feed)
    table = MergedTable(scratch_path(spark, "predictions"), _hashed("loan_id"), latest_predictions)

    def numbered(batch: DataFrame, n: int) -> DataFrame:
        return batch.select("loan_id", *PREDICTED, version_order("model_version").alias("version_no"), F.lit(n).cast("long").alias("arrived"))

    run_stream(preds, "predictions", lambda batch, n: table.upsert(latest_predictions(numbered(batch, n)), n), arrivals)
    merged = table.read(spark, latest_predictions(numbered(spark.createDataFrame([], schema), 0)).schema)
    return staging.staging_b(book_b.features(spark, sf_dir), merged)
