"""Statistics over earlier rows of a series.

All helpers take a window partitioned by the series key and ordered by date.
"Earlier" frames exclude the current row.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F


def earlier(series: WindowSpec, rows: int) -> WindowSpec:
    return series.rowsBetween(-rows, -1)


def slope_sums(value: str, position: str, series: WindowSpec, rows: int) -> tuple[Column, Column]:
    """Over the last ``rows`` earlier rows: the sum of a value, and of the value times ``position``."""
    frame = earlier(series, rows)
    return F.sum(value).over(frame), F.sum(F.col(value) * F.col(position)).over(frame)


def slope_of_last(total: Column, moment: Column, position: Column, rows: int) -> Column:
    """Least-squares slope over the last ``rows`` earlier rows, from ``slope_sums``.

    ``position`` counts rows from 0; the slope is 0 while there are fewer. The
    positions are equally spaced, so the slope is the moment about their middle.
    """
    middle = position - (rows + 1) / 2
    spread = rows * (rows * rows - 1) / 12
    return F.when(position >= rows, (moment - middle * total) / spread).otherwise(0.0)


def with_ewma(
    df: DataFrame, value: str, key: str, order: str, position: str, spans: dict[str, tuple[int, int]]
) -> DataFrame:
    """Exponentially weighted means (bias-corrected) over a series.

    ``spans`` maps an output column to (span, observations needed). ``position``
    counts observations from 0 and is negative before the first one.

    With decay r the weighted sum is a running sum of x * r**-j, rescaled by
    r**j. To keep the powers in range j restarts every ``block`` rows, and the
    block before is carried in; whatever lies further back weighs less than
    2**-60. So one running sum and one block sum replace a recursion per row.
    Spans too far apart for one block length take further passes.
    """
    decays = {out: 1.0 - 2.0 / (span + 1) for out, (span, _) in spans.items()}
    longest = max(spans, key=lambda out: decays[out])
    block = math.ceil(60 * math.log(2) / -math.log(decays[longest]))
    apart = {out: s for out, s in spans.items() if block * -math.log(decays[out]) > 600}
    if apart:
        near = {out: s for out, s in spans.items() if out not in apart}
        return with_ewma(with_ewma(df, value, key, order, position, near), value, key, order, position, apart)

    offset = F.pmod(F.col(position), F.lit(block))
    power = lambda out, exponent: F.pow(F.lit(decays[out]), exponent)
    df = df.withColumn("_block", F.floor(F.col(position) / block)).withColumns(
        {f"_scaled_{out}": F.col(value) * power(out, -offset) for out in spans}
    )
    inside = (
        Window.partitionBy(key, "_block").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    )
    before = Window.partitionBy(key).orderBy("_block").rangeBetween(-1, -1)
    # One select per window, so that the block sums reuse the sort of the running sums.
    df = df.withColumns({f"_run_{out}": F.sum(f"_scaled_{out}").over(inside) for out in spans})
    df = df.withColumns({f"_carry_{out}": F.sum(f"_scaled_{out}").over(before) for out in spans})
    results = {}
    for out, (_, needed) in spans.items():
        carried = F.coalesce(F.col(f"_carry_{out}"), F.lit(0.0)) * decays[out] ** block
        weighted = (F.col(f"_run_{out}") + carried) * power(out, offset)
        weights = (1 - power(out, F.col(position) + 1)) / (1 - decays[out])
        results[out] = F.when(F.col(position) >= needed - 1, weighted / weights)
    scratch = [f"_{kind}_{out}" for out in spans for kind in ("scaled", "run", "carry")]
    return df.withColumns(results).drop("_block", *scratch)
