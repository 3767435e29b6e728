"""Order-dependent operators that stay distributed for hot keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from larder.plans.lineage import pin

# Value buckets for the median: a coarse one per 1/2**8 and a fine one per
# 1/2**20 on the asinh scale, which is logarithmic for large magnitudes.
_COARSE_BITS, _FINE_BITS = 8, 20


def running_total(df: DataFrame, order: list[Column], value: str, out: str, total: str) -> DataFrame:
    """Add the running sum of ``value`` in ``order`` and the grand total.

    A window without partition keys would put all rows in one task. Rows are
    range-partitioned instead: each slice sums its own rows, and only the slice
    sums (one row per partition) are added up centrally. The slices are pinned
    because both uses must see the same boundaries.
    """
    sliced = pin(df.repartitionByRange(*order).withColumn("_slice", F.spark_partition_id()))
    slices = sliced.groupBy("_slice").agg(F.sum(value).alias("_part"))
    ahead = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = slices.select(
        "_slice",
        F.coalesce(F.sum("_part").over(ahead), F.lit(0.0)).alias("_ahead"),
        F.sum("_part").over(Window.partitionBy(F.lit(1))).alias(total),
    )
    inside = (
        Window.partitionBy("_slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    )
    # Bounded by the number of partitions, hence safe to broadcast.
    return (
        sliced.join(F.broadcast(offsets), "_slice")
        .withColumn(out, F.col("_ahead") + F.sum(value).over(inside))
        .drop("_slice", "_ahead")
    )


def exact_median(
    df: DataFrame, keys: list[str], value: str, out: str, count: str | None = None
) -> DataFrame:
    """Exact median of ``value`` per key, without gathering a key in one task.

    Equal values are counted first. The counts are then summed into value
    buckets, the bucket holding each middle rank is found from the bucket
    counts, and only the values in that bucket are ordered. Keys without a
    non-null value are absent from the result; NaN counts as no value. A row
    stands for as many values as its ``count`` column says, if one is named.
    """
    position = F.asinh(F.col(value).cast("double")) * float(2**_FINE_BITS)
    counted = (
        df.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
        .groupBy(*keys, value)
        .agg((F.count(F.lit(1)) if count is None else F.sum(count)).alias("_n"))
        .withColumn("_fine", F.floor(position))
        .withColumn("_coarse", F.floor(F.col("_fine") / 2 ** (_FINE_BITS - _COARSE_BITS)))
    )

    coarse = counted.groupBy(*keys, "_coarse").agg(F.sum("_n").alias("_n"))
    everything = Window.partitionBy(*keys)
    ahead = everything.orderBy("_coarse").rowsBetween(Window.unboundedPreceding, -1)
    ranked = coarse.select(
        *keys,
        "_coarse",
        F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_before"),
        F.col("_n"),
        F.sum("_n").over(everything).alias("_all"),
    )
    middle = F.array_distinct(
        F.array(F.floor((F.col("_all") + 1) / 2), F.floor(F.col("_all") / 2) + 1)
    )
    targets = (
        ranked.withColumn("_rank", F.explode(middle))
        .where((F.col("_rank") > F.col("_before")) & (F.col("_rank") <= F.col("_before") + F.col("_n")))
        .select(*keys, "_coarse", "_before", "_rank")
    )

    # Second level: the same search over the fine buckets of the chosen ones.
    chosen = counted.join(targets, [*keys, "_coarse"])
    fine = chosen.groupBy(*keys, "_rank", "_coarse", "_fine").agg(
        F.sum("_n").alias("_n"), F.first("_before").alias("_before")
    )
    within = Window.partitionBy(*keys, "_rank")
    ahead = within.orderBy("_fine").rowsBetween(Window.unboundedPreceding, -1)
    fine = (
        fine.withColumn("_before", F.col("_before") + F.coalesce(F.sum("_n").over(ahead), F.lit(0)))
        .where((F.col("_rank") > F.col("_before")) & (F.col("_rank") <= F.col("_before") + F.col("_n")))
        .select(*keys, "_rank", "_coarse", "_fine", F.col("_before").alias("_start"))
    )
    exact = chosen.join(fine, [*keys, "_rank", "_coarse", "_fine"])
    upto = (
        Window.partitionBy(*keys, "_rank").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    )
    exact = exact.withColumn("_upto", F.col("_start") + F.sum("_n").over(upto)).where(
        (F.col("_upto") >= F.col("_rank")) & (F.col("_upto") - F.col("_n") < F.col("_rank"))
    )
    return exact.groupBy(*keys).agg(F.avg(F.col(value).cast("double")).alias(out))


def latest_per_key(df: DataFrame, key: str, order: str, columns: list[str] | None = None) -> DataFrame:
    """Per key and column, the last non-null value in ``order``.

    ``max_by`` aggregates partially, so nothing is sorted or gathered.
    """
    names = [c for c in (columns or df.columns) if c != key]
    return df.groupBy(key).agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in names]
    )


def last_rows(df: DataFrame, key: str, order: str, rows: int) -> DataFrame:
    """The last ``rows`` rows of each key in ``order``.

    The rank limit is applied per map task before the shuffle.
    """
    newest = Window.partitionBy(key).orderBy(F.desc(order))
    return (
        df.withColumn("_recency", F.row_number().over(newest))
        .where(F.col("_recency") <= rows)
        .drop("_recency")
    )


def bucket_counts(
    df: DataFrame, value: str, low: float, high: float, buckets: int, clip_low: bool = False
) -> DataFrame:
    """Histogram of a clipped column: (bucket, lower edge, count).

    The value at the top edge belongs to the last bucket.
    """
    clipped = F.least(F.col(value), F.lit(float(high)))
    if clip_low:
        clipped = F.greatest(clipped, F.lit(float(low)))
    number = F.least(F.width_bucket(clipped, F.lit(float(low)), F.lit(float(high)), F.lit(buckets)),
                     F.lit(buckets))
    return (
        df.where(F.col(value).isNotNull())
        .groupBy(number.cast("int").alias("bucket"))
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("bucket_start", low + (F.col("bucket") - 1) * ((high - low) / buckets))
    )
