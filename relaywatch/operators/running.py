"""Running (prefix) aggregates that do not put a whole group in one task.

A running sum "per mode ordered by arrival" written as a plain window puts
every row of a mode into one task; with three modes a third of all rows
would be sorted by a single task. Instead we split each group into ordered
buckets of the order key and compute

    running(row) = running within its bucket + total of all earlier buckets

The within-bucket part is a window over ``(group, bucket)``; the offsets come
from a per-bucket totals table (one row per bucket, tiny) whose own window is
over buckets only. Both sides are keyed by ``(group, bucket)``, so the final
join reuses the window's hash partitioning; AQE turns it into a broadcast
join when the offsets table is small at runtime.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Default bucket width in units of the order key (an arrival counter here).
DEFAULT_BUCKET_WIDTH = 1 << 20

BUCKET = "_bucket"


def with_bucket(df: DataFrame, order_col: str, width: int) -> DataFrame:
    return df.withColumn(BUCKET, F.floor(F.col(order_col) / F.lit(width)).cast("long"))


def running_aggregates(df: DataFrame, partition_cols: list[str], order_col: str,
                       sums: dict[str, Column] | None = None,
                       maxes: dict[str, Column] | None = None,
                       bucket_width: int = DEFAULT_BUCKET_WIDTH) -> DataFrame:
    """Add running sums and running maxima per group, ordered by ``order_col``.

    ``order_col`` must be numeric and unique within a group (ties would make
    "running" ill-defined). Output keeps every input row and column plus one
    column per entry of ``sums`` and ``maxes``; sums over no rows are 0.
    """
    sums = sums or {}
    maxes = maxes or {}
    base = with_bucket(df, order_col, bucket_width)
    keys = [*partition_cols, BUCKET]

    # Per-bucket totals, then exclusive prefix over earlier buckets.
    tot = base.groupBy(*keys).agg(
        *[F.sum(e).alias(f"_t_{n}") for n, e in sums.items()],
        *[F.max(e).alias(f"_m_{n}") for n, e in maxes.items()])
    earlier = (Window.partitionBy(*partition_cols).orderBy(BUCKET)
               .rowsBetween(Window.unboundedPreceding, -1))
    offsets = tot.select(
        *keys,
        *[F.coalesce(F.sum(f"_t_{n}").over(earlier), F.lit(0)).alias(f"_o_{n}") for n in sums],
        *[F.max(f"_m_{n}").over(earlier).alias(f"_p_{n}") for n in maxes])

    within = (Window.partitionBy(*keys).orderBy(order_col)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    run = base.select(
        "*",
        *[F.sum(e).over(within).alias(f"_r_{n}") for n, e in sums.items()],
        *[F.max(e).over(within).alias(f"_q_{n}") for n, e in maxes.items()])
    out = run.join(offsets, keys, "inner")
    return out.select(
        *df.columns,
        *[(F.coalesce(f"_r_{n}", F.lit(0)) + F.col(f"_o_{n}")).alias(n) for n in sums],
        *[F.greatest(F.col(f"_q_{n}"), F.col(f"_p_{n}")).alias(n) for n in maxes],
        F.col(BUCKET))


def previous_value(df: DataFrame, partition_cols: list[str], order_col: str,
                   value_col: str, out_col: str,
                   bucket_width: int = DEFAULT_BUCKET_WIDTH) -> DataFrame:
    """``lag(value_col)`` per group, split into buckets like running_aggregates.

    Within a bucket it is a plain ``lag``; the first row of a bucket takes the
    last value of the nearest earlier non-empty bucket.
    """
    base = df if BUCKET in df.columns else with_bucket(df, order_col, bucket_width)
    keys = [*partition_cols, BUCKET]
    last = base.groupBy(*keys).agg(F.max_by(value_col, order_col).alias("_last"))
    earlier = (Window.partitionBy(*partition_cols).orderBy(BUCKET)
               .rowsBetween(Window.unboundedPreceding, -1))
    carry = last.select(*keys, F.last("_last", ignorenulls=True).over(earlier).alias("_carry"))
    w = Window.partitionBy(*keys).orderBy(order_col)
    lagged = base.withColumns({"_lag": F.lag(value_col).over(w),
                               "_rn": F.row_number().over(w)})
    out = lagged.join(carry, keys, "inner")
    return (out.withColumn(out_col, F.when(F.col("_rn") == 1, F.col("_carry"))
                           .otherwise(F.col("_lag")))
            .drop("_lag", "_carry", "_rn"))
