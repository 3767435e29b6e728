"""Exact ranks and positions without sorting a column or gathering a group in one task."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.window import WindowSpec

from larder.plans.lineage import pin

#: Cells into which a range of values is divided at a time.
CELLS = 512


def is_number(value: Column) -> Column:
    """Neither null, NaN nor infinite."""
    return value.isNotNull() & ~F.isnan(value) & (F.abs(value) < float("inf"))


def melted(df: DataFrame, columns: list[str], name: str = "feature", value: str = "value") -> DataFrame:
    """One row per row and column of ``df``: the column's name and its number."""
    fields = [F.struct(F.lit(c).alias(name), F.col(f"`{c}`").cast("double").alias(value)) for c in columns]
    return df.select(F.inline(F.array(*fields)))


def values_at_ranks(
    rows: DataFrame, keys: list[str], value: str, wanted: Callable[[Column], Column], out: str = "rank"
) -> DataFrame:
    """Per key and wanted rank (from 1, by rising ``value``): the value there.

    ``wanted`` maps the number of a key's values to an array of ranks. Many ranks of
    many keys are found together: the range between a key's least and greatest value is
    cut into cells, which are counted with their least and greatest values, and a rank's
    cell is the range of the next pass, until it holds one value. Values are never
    shuffled or sorted, only counts of cells are, and a pass after the first looks at
    the rows of the chosen cells alone. ``rows`` are read once a pass, so they should be
    stored. Values that are no numbers are left out; keys without any have no rows.
    """
    numbers = rows.select(*keys, F.col(value).cast("double").alias("_v")).where(is_number(F.col("_v")))
    ends = numbers.groupBy(*keys).agg(F.count("*").alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    open_ranks = pin(
        ends.select(*keys, "_lo", "_hi", F.lit(0).cast("long").alias("_before"), F.explode(F.array_distinct(wanted(F.col("_n")))).alias(out))
    )
    found = []
    while True:
        found.append(open_ranks.where("_lo = _hi").select(*keys, out, F.col("_lo").alias(value)))
        left = open_ranks.where("_lo < _hi")
        if left.isEmpty():
            break
        ranges = left.select(*keys, "_lo", "_hi").distinct()
        inside = numbers.join(ranges, keys).where((F.col("_v") >= F.col("_lo")) & (F.col("_v") <= F.col("_hi")))
        # by halves where the range itself is no double
        low, high = F.col("_lo"), F.col("_hi")
        share = F.when(high - low < float("inf"), (F.col("_v") - low) / (high - low)).otherwise(
            (F.col("_v") / 2 - low / 2) / (high / 2 - low / 2))
        cells = inside.groupBy(*keys, "_lo", "_hi", F.least(F.floor(share * CELLS), F.lit(CELLS - 1)).alias("_cell")).agg(
            F.count("*").alias("_n"), F.min("_v").alias("_least"), F.max("_v").alias("_most")
        )
        ahead = Window.partitionBy(*keys, "_lo", "_hi").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
        cells = cells.withColumn("_below", F.coalesce(F.sum("_n").over(ahead), F.lit(0)))
        start = F.col("_before") + F.col("_below")
        open_ranks = pin(
            left.join(cells, [*keys, "_lo", "_hi"])
            .where((F.col(out) > start) & (F.col(out) <= start + F.col("_n")))
            .select(*keys, F.col("_least").alias("_lo"), F.col("_most").alias("_hi"), start.alias("_before"), out)
        )
    result = found[0]
    for more in found[1:]:
        result = result.unionByName(more)
    return result


def quantiles(rows: DataFrame, keys: list[str], value: str, shares: dict[str, float]) -> DataFrame:
    """Per key one column for each of ``shares``, interpolated between the neighbouring values."""
    place = {out: (F.col("_n") - 1) * p for out, p in shares.items()}
    wanted = lambda n: F.array(*[
        (step((n - 1) * p) + 1).cast("long") for p in shares.values() for step in (F.floor, F.ceil)
    ])
    at = values_at_ranks(rows, keys, value, wanted)
    sizes = rows.where(is_number(F.col(value).cast("double"))).groupBy(*keys).agg(F.count("*").alias("_n"))
    ranked = at.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("rank", value))).alias("_at"))
    value_at = lambda r: F.element_at("_at", (r + 1).cast("long"))
    between = {
        out: value_at(F.floor(h)) + (value_at(F.ceil(h)) - value_at(F.floor(h))) * (h - F.floor(h)) for out, h in place.items()
    }
    return ranked.join(sizes, keys).select(*keys, *[c.alias(out) for out, c in between.items()])


def positions(df: DataFrame, group: list[str], order: list[Column], count: str | None = None) -> DataFrame:
    """``df`` with ``before`` and ``total``: rows ahead of each row in its group's order, and in the group.

    With ``count`` a row stands for that many. A group may hold most of all rows: rows
    are dealt to range partitions by group and order, each counts its own, and what the
    earlier partitions hold of a group is added to it. There are as many (group,
    partition) pairs as groups and partitions together.
    """
    size = F.lit(1) if count is None else F.col(count)
    dealt = df.repartitionByRange(*group, *order).withColumn("_slice", F.spark_partition_id())
    dealt = pin(dealt)
    parts = dealt.groupBy(*group, "_slice").agg(F.sum(size).alias("_part"))
    own = Window.partitionBy(*group)
    ahead = own.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(
        *[F.col(g).alias(f"_of_{g}") for g in group], F.col("_slice").alias("_at"),
        F.coalesce(F.sum("_part").over(ahead), F.lit(0)).alias("_ahead"), F.sum("_part").over(own).alias("total"),
    )
    inside: WindowSpec = Window.partitionBy("_slice", *group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    same = F.col("_slice") == F.col("_at")
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"_of_{g}"))
    counted = dealt.withColumn("_inside", F.coalesce(F.sum(size).over(inside), F.lit(0)))
    return (
        counted.join(offsets, same)
        .withColumn("before", (F.col("_ahead") + F.col("_inside")).cast("long"))
        .withColumn("total", F.col("total").cast("long"))
        .drop("_slice", "_inside", "_at", "_ahead", *[f"_of_{g}" for g in group])
    )


def tile(before: Column, total: Column, tiles: int) -> Column:
    """The number, from 1, of ``tiles`` equal parts: the first ones take one of the remainder each."""
    least, larger = F.floor(total / tiles), total % tiles
    in_larger = larger * (least + 1)
    later = larger + F.floor(F.try_divide(before - in_larger, least))
    return (F.when(before < in_larger, F.floor(before / (least + 1))).otherwise(later) + 1).cast("int")


def percent_rank(df: DataFrame, group: list[str], value: str, out: str = "percent_rank") -> DataFrame:
    """``df`` with the share of the group's other rows that have a lower ``value``; ties share it.

    Equal values of a group are counted first, so the ranks are those of distinct
    values, however many rows share one. Null values come last, as one tie. A group of
    one row has 0.
    """
    counted = df.groupBy(*group, value).agg(F.count("*").alias("_copies"))
    order = [F.col(value).asc_nulls_last()]
    placed = positions(counted, group, order, "_copies")
    rank = F.coalesce(F.try_divide(F.col("before").cast("double"), F.col("total") - 1), F.lit(0.0))
    ranks = placed.select(
        *[F.col(g).alias(f"_of_{g}") for g in group], F.col(value).alias("_value"), rank.alias(out)
    )
    same = F.col(value).eqNullSafe(F.col("_value"))
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"_of_{g}"))
    return df.join(ranks, same).drop("_value", *[f"_of_{g}" for g in group])
