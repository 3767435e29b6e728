"""Connected components: local contraction, then alternating large and small stars."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from larder.plans.lineage import pin


#: Ids that a task's contraction holds before it hands on what it has and begins anew.
HELD_IDS = 500_000


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A partition's links as stars: each id with the least id that links held together reach."""
    up: dict[int, int] = {}

    def root(x: int) -> int:
        while up[x] != x:
            up[x] = x = up[up[x]]
        return x

    def stars() -> pa.RecordBatch:
        apart = [(x, y) for x in up if (y := root(x)) != x]
        return pa.RecordBatch.from_pydict(
            {"u": pa.array([x for x, _ in apart], pa.int64()), "v": pa.array([y for _, y in apart], pa.int64())}
        )

    for batch in batches:
        for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
            up.setdefault(a, a)
            up.setdefault(b, b)
            x, y = root(a), root(b)
            up[max(x, y)] = min(x, y)
        if len(up) > HELD_IDS:
            yield stars()
            up.clear()
    yield stars()


def _are_stars(edges: DataFrame) -> bool:
    """Whether each upper end has one edge and is no lower end."""
    ends = edges.select(F.col("u").alias("id"), F.lit(1).alias("upper"), F.lit(0).alias("lower")).unionByName(
        edges.select(F.col("v").alias("id"), F.lit(0).alias("upper"), F.lit(1).alias("lower"))
    )
    mixed = ends.groupBy("id").agg(F.sum("upper").alias("upper"), F.max("lower").alias("lower")).filter("upper + lower > 1")
    return mixed.agg(F.count("*")).first()[0] == 0


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of each id move to its least neighbour. The middle of a large star is a hot key of this join."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = pin(both.groupBy(F.col("u").alias("at")).agg(F.least(F.min("v"), F.first("u")).alias("least")))
    near = both.join(least, F.col("u") == F.col("at"))
    return near.filter("v > u").select(F.col("v").alias("u"), F.col("least").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Smaller neighbours of each id, of which a large star leaves few, move to the least of them."""
    near = edges.withColumn("least", F.min("v").over(Window.partitionBy("u")))
    moved = F.when(F.col("v") == F.col("least"), F.struct("u", "v")).otherwise(F.struct(F.col("v").alias("u"), F.col("least").alias("v")))
    return near.select(moved.alias("edge")).select("edge.*").distinct()


def components(links: DataFrame) -> DataFrame:
    """(id, component) of every id in ``links`` (a, b; longs): the least id that it reaches.

    Links are undirected, may repeat and may join an id to itself. Each partition's links
    are first contracted to stars; then each round is a grouped minimum and a window over
    the remaining edges. Rounds grow with the logarithm of a component's size. An empty
    input has no components.
    """
    edges = pin(links.select("a", "b").mapInArrow(_contract, "u long, v long").distinct())
    while not _are_stars(edges):
        edges = pin(_small_star(_large_star(edges)))
    alone = links.filter("a = b").select(F.col("a").alias("id"), F.col("a").alias("component"))
    roots = edges.select(F.col("v").alias("id"), F.col("v").alias("component"))
    found = edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)
    return found.unionByName(alone).groupBy("id").agg(F.min("component").alias("component"))
