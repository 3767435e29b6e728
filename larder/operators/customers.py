"""Customers: RFM scores and cohort retention."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from larder.operators.ranks import positions, tile
from larder.plans.lineage import pin

#: Customers of a bucket, and bytes of its bitmap.
BUCKET = 32768
_BYTES = BUCKET // 8


def customer_totals(tx: DataFrame) -> DataFrame:
    """Per customer: the last day, the number of invoices and the sum of the revenue.

    Invoices of a customer are counted before they meet, so a customer with most of the
    lines is no single task. Rows without a customer are left out.
    """
    per_invoice = tx.where("customer_id is not null").groupBy("customer_id", "invoice_no").agg(
        F.max("date").alias("date"), F.sum("revenue").alias("revenue")
    )
    return per_invoice.groupBy("customer_id").agg(
        F.max("date").alias("last_date"), F.count("*").alias("frequency"), F.sum("revenue").alias("monetary")
    )


def rfm_scores(tx: DataFrame, tiles: int = 5, places: int = 2) -> DataFrame:
    """Recency, frequency and monetary value of each customer with scores from 1 to ``tiles``.

    The most recent, most frequent and most valuable customers have the highest score.
    Scores are SQL's ``ntile`` over all customers; equal values are in the order of
    ``customer_id``. Money is compared to ``places`` decimals. ``rfm`` joins the digits.
    """
    totals = customer_totals(tx)
    last = totals.agg(F.max("last_date")).scalar()
    scored = pin(totals.select(
        "customer_id", F.date_diff(last, F.col("last_date")).alias("recency_days"), "frequency",
        F.round("monetary", places).alias("monetary"),
    ))
    for name, order in (
        ("r_score", F.col("recency_days").desc()), ("f_score", F.col("frequency").asc()), ("m_score", F.col("monetary").asc())
    ):
        placed = positions(scored, [], [order, F.col("customer_id").asc()])
        scored = placed.withColumn(name, tile(F.col("before"), F.col("total"), tiles)).drop("before", "total")
    return scored.withColumn("rfm", F.concat(*[F.col(c).cast("string") for c in ("r_score", "f_score", "m_score")]))


# Cohorts ---------------------------------------------------------------------------

def customer_numbers(tx: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """customer_id and a number of its own; customers of ``known`` keep theirs.

    Numbers of one partition follow each other, so they fill buckets.
    """
    customers = tx.where("customer_id is not null").select("customer_id").distinct()
    if known is None:
        return pin(customers.withColumn("number", F.monotonically_increasing_id()))
    start = F.coalesce(known.agg(F.max("number")).scalar(), F.lit(-1))
    # the next free bucket, so that partitions of both don't share one
    begin = (F.floor(start / BUCKET) + 1).cast("long") * BUCKET
    new = customers.join(known, "customer_id", "left_anti").withColumn("number", F.monotonically_increasing_id())
    return pin(known.select("customer_id", "number").unionByName(new.withColumn("number", F.col("number") + begin)))


def active_sets(tx: DataFrame, numbers: DataFrame) -> DataFrame:
    """(month, bucket, members): bitmaps of the customers who bought in a month, by buckets of their numbers.

    Lines of a customer and month are first counted as one. Sets of two tables of lines
    merge with ``merged_sets``.
    """
    active = tx.where("customer_id is not null").select("customer_id", F.trunc("date", "month").alias("month")).distinct()
    return (
        active.join(numbers, "customer_id")
        .groupBy("month", F.floor(F.col("number") / BUCKET).alias("bucket"))
        .agg(F.bitmap_construct_agg((F.col("number") % BUCKET)).alias("members"))
    )


def merged_sets(*sets: DataFrame) -> DataFrame:
    """The unions of several tables of ``active_sets`` over one table of numbers."""
    rows = sets[0]
    for more in sets[1:]:
        rows = rows.unionByName(more)
    return rows.groupBy("month", "bucket").agg(F.bitmap_or_agg("members").alias("members"))


def _retained(rows: pa.Table) -> pa.Table:
    """Customers of one bucket by the month in which they first bought and each later one: one bitmap a month."""
    rows = rows.sort_by("month")
    months = rows["month"].combine_chunks()
    sets = np.frombuffer(b"".join(rows["members"].to_pylist()), np.uint8).reshape(-1, _BYTES)
    seen = np.bitwise_or.accumulate(sets, axis=0)
    first = sets.copy()
    first[1:] &= ~seen[:-1]
    cohorts, active, counts = [], [], []
    for k in range(len(sets)):
        if first[k].any():
            both = np.bitwise_count(sets[k:] & first[k]).sum(axis=1, dtype=np.int64)
            cohorts += [k] * len(both)
            active += range(k, len(sets))
            counts += both.tolist()
    take = lambda places: months.take(pa.array(places, pa.int64()))
    return pa.table({"cohort": take(cohorts), "month": take(active), "customers": pa.array(counts, pa.int64())})


def cohort_retention(sets: DataFrame) -> DataFrame:
    """Rows (cohort, month, month_number, customers, cohort_size, retention) from ``active_sets``.

    A cohort is the month of customers' first purchase; ``customers`` of them bought in
    ``month``. Months in which none did are left out. A bucket holds one bitmap a month;
    buckets only add up.
    """
    def work(rows: pa.Table) -> pa.Table:
        return _retained(rows)

    counts = sets.groupBy("bucket").applyInArrow(work, "cohort date, month date, customers long")
    cells = pin(counts.groupBy("cohort", "month").agg(F.sum("customers").alias("customers")).where("customers > 0"))
    sizes = cells.where("cohort = month").select(F.col("cohort").alias("_cohort"), F.col("customers").alias("cohort_size"))
    return cells.join(sizes, F.col("cohort") == F.col("_cohort")).select(
        "cohort", "month", F.round(F.months_between("month", "cohort")).cast("int").alias("month_number"), "customers", "cohort_size",
        (F.col("customers") / F.col("cohort_size")).alias("retention"),
    )
