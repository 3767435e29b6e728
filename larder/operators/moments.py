"""Pairwise moments of many columns at once: a blocked Gram matrix with gaps.

A row may miss some columns, so each pair of columns has its own rows. With X the
values (0 where missing) and M the marks of what is there, four matrix products give
all pairs: M'M counts rows, X'M sums one column over the rows that have the other,
(X*X)'M its squares, and X'X the products. They add up over blocks of rows, so a
partition sends one row of arrays per column, whatever its size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

_SUMS = ("counts", "sums", "squares", "products")
_SCHEMA = "place int, salt int, " + ", ".join(f"{name} array<double>" for name in _SUMS)
#: Groups that add up the rows of one column first, so that no task gets those of all partitions.
_SALTS = 64
#: Variances below this share of the mean square are rounding.
_NOTHING = 1e-12


def _block(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    columns = [c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns]
    values = np.column_stack(columns) if batch.num_rows else np.zeros((0, len(columns)))
    there = np.isfinite(values)
    x, m = np.where(there, values, 0.0), there.astype(float)
    return m.T @ m, x.T @ m, (x * x).T @ m, x.T @ x


def _rows(sums: tuple[np.ndarray, ...], salts: list[int]) -> dict[str, pa.Array]:
    n = len(sums[0])
    arrays = {name: pa.array(list(s), pa.list_(pa.float64())) for name, s in zip(_SUMS, sums)}
    return {"place": pa.array(range(n), pa.int32()), "salt": pa.array(salts, pa.int32())} | arrays


def _partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = None
    for batch in batches:
        found = _block(batch)
        total = found if total is None else tuple(a + b for a, b in zip(total, found))
    if total is not None:
        salt = TaskContext.get().partitionId() % _SALTS
        yield pa.RecordBatch.from_pydict(_rows(total, [salt] * len(total[0])))


def _merged(rows: pa.Table) -> pa.Table:
    sums = {name: np.array(rows[name].to_pylist()).sum(axis=0) for name in _SUMS}
    return pa.table({
        "place": rows["place"].slice(0, 1), "salt": rows["salt"].slice(0, 1),
        **{name: pa.array([s], pa.list_(pa.float64())) for name, s in sums.items()},
    })


def gram(df: DataFrame, columns: list[str]) -> DataFrame:
    """Per column, by its ``place`` in ``columns``: arrays of its sums over the rows that have each other column too.

    ``counts``, ``sums`` and ``squares`` are those of the column itself, ``products``
    those with the other. Values are taken from the column's middle first, so that
    squares don't cancel; ``middle`` is that value. Null, NaN and infinite values are
    missing. An empty table has no rows.
    """
    numbers = df.select(*[F.col(f"`{c}`").cast("double").alias(f"c{k}") for k, c in enumerate(columns)])
    finite = [F.when(~F.isnan(f"c{k}") & (F.abs(f"c{k}") < float("inf")), F.col(f"c{k}")).alias(f"c{k}") for k in range(len(columns))]
    numbers = numbers.select(*finite)
    # one row for the driver; a constant column becomes exactly 0
    first = numbers.agg(*[
        F.when(F.min(c) == F.max(c), F.min(c)).otherwise(F.avg(c)).alias(c) for c in numbers.columns
    ]).first()
    middles = [first[c] or 0.0 for c in numbers.columns]
    shifted = numbers.select(*[(F.col(c) - F.lit(m)).alias(c) for c, m in zip(numbers.columns, middles)])
    partial = shifted.mapInArrow(_partial, _SCHEMA)
    once = partial.groupBy("place", "salt").applyInArrow(_merged, _SCHEMA)
    whole = once.groupBy("place").applyInArrow(_merged, _SCHEMA)
    middle = F.get(F.array(*[F.lit(float(m)) for m in middles]), F.col("place"))
    return whole.drop("salt").withColumn("middle", middle)


def column_pairs(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows (x, y, n, covariance, correlation) of all ordered pairs of ``columns``.

    ``n`` counts the rows that have both; the covariance is the sample's. It is null
    below two rows, and so is the correlation, also where one side is constant.
    """
    sums = gram(df, columns)
    fields = F.arrays_zip(*[F.col(name) for name in _SUMS])
    own = sums.select("place", F.posexplode(fields).alias("other", "own"))
    # a pair's other half is the entry on the far side of the diagonal; there are columns x columns rows
    far = own.select(F.col("place").alias("far_other"), F.col("other").alias("far_place"), F.col("own").alias("far"))
    pairs = own.join(far, (F.col("place") == F.col("far_place")) & (F.col("other") == F.col("far_other")))
    n, x, y = F.col("own.counts"), F.col("own.sums"), F.col("far.sums")
    spread_x, spread_y = n * F.col("own.squares") - x * x, n * F.col("far.squares") - y * y
    constant = (spread_x <= _NOTHING * n * F.col("own.squares")) | (spread_y <= _NOTHING * n * F.col("far.squares"))
    shared = n * F.col("own.products") - x * y
    names = F.array(*[F.lit(c) for c in columns])
    return pairs.select(
        F.get(names, F.col("place")).alias("x"), F.get(names, F.col("other")).alias("y"), n.cast("long").alias("n"),
        F.when(n >= 2, shared / (n * (n - 1))).alias("covariance"),
        F.when((n >= 2) & ~constant, shared / F.sqrt(spread_x * spread_y)).alias("correlation"),
    )
