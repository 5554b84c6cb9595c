"""Order-dependent operators without a single-task window.

``Window.orderBy`` with no ``partitionBy`` (and a window partitioned by a hot
key) moves every row of the group into one task. The operators here compute
the same running totals and ranks with range partitioning instead:

1. range-partition on (group, order keys) — the order keys end in a
   tie-breaker, so even a key holding a third of all rows is split over many
   partitions;
2. a per-partition pass (Arrow batches, pandas ``cumsum``) gives the running
   total inside each partition;
3. a group that started in an earlier partition gets the sum of its earlier
   pieces as an offset. Only the first group of a partition can need one, so
   the offset table has at most one row per partition (a proven bound) and is
   broadcast.

The ranged frame is checkpointed so both passes read one materialised copy.
:func:`carry_forward` fills forward by the same plan, for merges of sorted
sides (range joins, as-of joins).
Plain row numbers (no groups, no weights) skip the pandas pass: the
position inside each sorted partition comes from
``monotonically_increasing_id``.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..session import checkpoint_dir

_PID = "_rt_pid"
_LOCAL = "_rt_local"
_W = "_rt_w"


def _as_col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def running_total(df: DataFrame, order_by: Sequence[str], *, value: str | Column | None = None,
                  partition_by: Sequence[str] = (), out: str = "running_total",
                  num_partitions: int | None = None) -> DataFrame:
    """Inclusive running sum of ``value`` (row count when ``value`` is None)
    within ``partition_by`` in ``order_by`` order.

    Equals ``sum(value) over (partition by … order by … rows between unbounded
    preceding and current row)`` when ``order_by`` is a total order (end it
    with a unique column). NULL values count as 0. Every column of ``df``
    travels through the range shuffle, so pass slim frames.
    """
    spark = df.sparkSession
    checkpoint_dir(spark)
    parts = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    group_cols = list(partition_by)
    sort_cols = group_cols + list(order_by)

    weight = F.lit(1).cast("long") if value is None else _as_col(value)
    w_type = df.select(weight.alias(_W)).schema[_W].dataType
    if not isinstance(w_type, (T.LongType, T.DoubleType)):
        w_type = T.DoubleType() if isinstance(w_type, (T.FloatType, T.DecimalType)) else T.LongType()
    keyed = df.withColumn(_W, F.coalesce(weight.cast(w_type), F.lit(0).cast(w_type)))

    ranged = keyed.repartitionByRange(parts, *sort_cols).sortWithinPartitions(*sort_cols)
    out_schema = T.StructType(keyed.schema.fields + [
        T.StructField(_PID, T.IntegerType(), False),
        T.StructField(_LOCAL, w_type, False),
    ])
    is_long = isinstance(w_type, T.LongType)

    def local_totals(batches):
        from pyspark import TaskContext

        pid = TaskContext.get().partitionId()
        carry_key, carry_sum = None, 0
        for pdf in batches:
            if len(pdf) == 0:
                continue
            w = pdf[_W].astype("int64" if is_long else "float64")
            if group_cols:
                starts = pd.Series(False, index=range(len(pdf)))
                for c in group_cols:        # a new group starts where any key value changes; null equals null
                    v = pdf[c].reset_index(drop=True)
                    starts |= (v != v.shift(1)) & ~(v.isna() & v.shift(1).isna())
                starts.iloc[0] = True
                run = starts.cumsum()
                cs = w.groupby(run.to_numpy()).cumsum()
                key = [None if pd.isna(x) else x for x in pdf[group_cols].iloc[0]]
                if carry_key is not None and key == carry_key:
                    first_run = (run == 1).to_numpy()
                    cs[first_run] = cs[first_run] + carry_sum
                carry_key = [None if pd.isna(x) else x for x in pdf[group_cols].iloc[-1]]
            else:
                cs = w.cumsum() + carry_sum
            carry_sum = cs.iloc[-1]
            pdf[_PID] = pid
            pdf[_LOCAL] = cs.to_numpy()
            yield pdf

    local = ranged.mapInPandas(local_totals, out_schema).checkpoint(eager=True)

    totals = local.groupBy(_PID, *group_cols).agg(F.sum(_W).alias("_rt_t"))
    earlier = Window.partitionBy(*group_cols).orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1) \
        if group_cols else Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    # at most one row per range partition survives the filter (see module doc)
    offsets = (totals.select(F.col(_PID).alias("_rt_opid"),
                             *[F.col(c).alias(f"_rt_o_{c}") for c in group_cols],
                             F.sum("_rt_t").over(earlier).alias("_rt_off"))
               .where(F.col("_rt_off").isNotNull()))
    cond = [F.col(_PID) == F.col("_rt_opid")] + [F.col(c).eqNullSafe(F.col(f"_rt_o_{c}")) for c in group_cols]
    joined = local.join(F.broadcast(offsets), cond, "left")
    result = joined.withColumn(out, F.col(_LOCAL) + F.coalesce(F.col("_rt_off"), F.lit(0).cast(w_type)))
    return result.drop(_PID, _LOCAL, _W, "_rt_opid", "_rt_off", *[f"_rt_o_{c}" for c in group_cols])


def row_number_global(df: DataFrame, order_by: Sequence[str], *, partition_by: Sequence[str] = (),
                      out: str = "row_number", num_partitions: int | None = None) -> DataFrame:
    """``row_number() over ([partition by …] order by …)`` without a one-task
    window. ``order_by`` must be a total order (inside each group).

    Without groups the pass is JVM-only: after the range shuffle and the
    in-partition sort, ``monotonically_increasing_id`` carries the partition
    index (high bits) and the position inside the partition (low 33 bits);
    the per-partition row counts (one row per partition) become offsets.
    With groups it is the running count of :func:`running_total`.
    """
    if partition_by:
        return running_total(df, order_by, partition_by=partition_by, out=out, num_partitions=num_partitions)
    spark = df.sparkSession
    checkpoint_dir(spark)
    parts = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(parts, *order_by).sortWithinPartitions(*order_by)
    # ids follow the sorted order inside each partition; materialised once so
    # every later read sees the same assignment
    tagged = ranged.withColumn("_rn_id", F.monotonically_increasing_id()).checkpoint(eager=True)
    pid = F.shiftright(F.col("_rn_id"), 33)
    counts = tagged.groupBy(pid.alias("_rn_pid")).agg(F.count(F.lit(1)).alias("_rn_n"))
    earlier = Window.orderBy("_rn_pid").rowsBetween(Window.unboundedPreceding, -1)   # one row per partition
    offsets = counts.select("_rn_pid", F.coalesce(F.sum("_rn_n").over(earlier), F.lit(0)).alias("_rn_off"))
    joined = tagged.join(F.broadcast(offsets), pid == F.col("_rn_pid"), "left")
    local = F.col("_rn_id").bitwiseAND(F.lit((1 << 33) - 1))
    return joined.withColumn(out, local + 1 + F.coalesce(F.col("_rn_off"), F.lit(0))) \
        .drop("_rn_id", "_rn_pid", "_rn_off")


def carry_forward(df: DataFrame, order_by: Sequence[str], carry: Sequence[str], marked: Column, *,
                  prefix: str = "carried_", num_partitions: int | None = None) -> DataFrame:
    """Every row of ``df`` with the ``carry`` columns of the last ``marked`` row
    at or before it in ``order_by`` order (NULL before the first).

    The frame is range-partitioned on the order, so end it with a tie-breaker
    that spreads hot values. A pass over each sorted partition fills forward;
    what is open at a partition's end, one row a partition, is carried over its
    edge. Every column travels through the range shuffle: pass slim frames.
    """
    spark = df.sparkSession
    checkpoint_dir(spark)
    parts = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    held = [f"_cf_{i}" for i in range(len(carry))]
    ranged = (df.withColumn("_cf_mark", F.coalesce(marked, F.lit(False)))
              .repartitionByRange(parts, *order_by).sortWithinPartitions(*order_by))
    schema = T.StructType([*ranged.schema.fields, *[T.StructField(h, df.schema[c].dataType) for h, c in zip(held, carry)],
                           T.StructField("_cf_seen", T.BooleanType()), T.StructField("_cf_last", T.BooleanType()),
                           T.StructField(_PID, T.IntegerType())])
    names, sources = [f.name for f in schema.fields], list(carry)

    def fill(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        pid, open_row, waiting = TaskContext.get().partitionId(), None, None

        def finished(columns, last):
            n = len(columns[0])
            flag = np.zeros(n, dtype=bool)
            flag[-1] = last
            return pa.RecordBatch.from_arrays([*columns, pa.array(flag), pa.array(np.full(n, pid, dtype=np.int32))], names=names)

        for batch in batches:
            n = batch.num_rows
            if n == 0:
                continue
            mark = np.asarray(batch.column(batch.schema.get_field_index("_cf_mark")).to_numpy(zero_copy_only=False), dtype=bool)
            at = np.maximum.accumulate(np.where(mark, np.arange(n), -1))
            filled = []
            for i, name in enumerate(sources):
                own = batch.column(batch.schema.get_field_index(name))
                before = open_row[i] if open_row is not None else pa.nulls(1, own.type)
                filled.append(pa.concat_arrays([before, own]).take(pa.array(at + 1)))
            seen = (at >= 0) | (open_row is not None)
            if mark.any():
                open_row = [f.slice(n - 1, 1) for f in filled]
            if waiting is not None:
                yield finished(waiting, False)
            waiting = [*batch.columns, *filled, pa.array(seen)]
        if waiting is not None:
            yield finished(waiting, True)

    local = ranged.mapInArrow(fill, schema).checkpoint(eager=True)
    state = F.when(F.col("_cf_seen"), F.struct(*held))
    earlier = Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)       # one row per partition
    edges = (local.where("_cf_last").select(F.col(_PID).alias("_cf_pid"), F.last(state, ignorenulls=True).over(earlier).alias("_cf_edge"))
             .where(F.col("_cf_edge").isNotNull()))
    joined = local.join(F.broadcast(edges), ~F.col("_cf_seen") & (F.col(_PID) == F.col("_cf_pid")), "left")
    return joined.select(*df.columns, *[F.when(F.col("_cf_seen"), F.col(h)).otherwise(F.col(f"_cf_edge.{h}")).alias(prefix + c)
                                        for h, c in zip(held, carry)])


# A median's search range is cut into this many buckets at a time, until the
# bucket that holds the middle has at most MEDIAN_ROWS rows (or one value).
MEDIAN_BUCKETS = 4096
MEDIAN_ROWS = 1_000_000


def exact_median(df: DataFrame, column: str, *, out: str = "median") -> DataFrame:
    """One-row frame with the exact (interpolated) median of ``column``.

    Same value as ``median``/``percentile(col, 0.5)``, but no task ever holds
    the value→count map of the whole column and nothing is sorted: values are
    counted in equal-width buckets (one aggregate of at most
    ``MEDIAN_BUCKETS`` rows), the bucket that holds the middle is cut again
    while it is large, and only its distinct values are ranked. The frame is
    scanned three times or more, so pass a stored or slim one.
    """
    vals = df.select(F.col(column).cast("double").alias("_v")).where(F.col("_v").isNotNull() & ~F.isnan("_v"))
    lo, hi, n = vals.agg(F.min("_v"), F.max("_v"), F.count("_v")).first()          # one row
    if not n:
        return vals.agg(F.avg("_v").alias(out))
    parts = [_around_rank(vals, lo, hi, n, k) for k in sorted({(n + 1) // 2, (n + 2) // 2})]
    middle = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return middle.agg(F.avg("_v").alias(out))


def _around_rank(vals: DataFrame, lo: float, hi: float, n: int, k: int) -> DataFrame:
    """The value of rank ``k`` among ``vals`` in [lo, hi], as a one-row frame."""
    inside = vals
    while n > MEDIAN_ROWS and lo < hi:
        width = (hi - lo) / MEDIAN_BUCKETS
        if lo + width <= lo:
            break
        bucket = F.least(F.floor((F.col("_v") - F.lit(lo)) / F.lit(width)), F.lit(MEDIAN_BUCKETS - 1))
        counts = inside.groupBy(bucket.alias("b")).agg(F.count(F.lit(1)).alias("n"), F.min("_v").alias("lo"),
                                                       F.max("_v").alias("hi")).orderBy("b").collect()    # ≤ MEDIAN_BUCKETS rows
        for r in counts:
            if k <= r["n"]:
                break
            k -= r["n"]
        lo, hi, n = r["lo"], r["hi"], r["n"]
        inside = vals.where(F.col("_v").between(lo, hi))
    per_value = inside.groupBy("_v").agg(F.count(F.lit(1)).alias("n"))
    upto = F.sum("n").over(Window.orderBy("_v").rowsBetween(Window.unboundedPreceding, 0))
    return per_value.withColumn("_upto", upto).where((F.col("_upto") >= k) & (F.col("_upto") - F.col("n") < k)).select("_v")
