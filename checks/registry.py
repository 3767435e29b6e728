"""The register of queries and how they are run.

Floating results are rounded on both sides.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from checks.shop import Shop, shop_for
from checks.sql import rounded, with_parts
from larder.functions.numbers import half_even


@dataclass(frozen=True)
class Query:
    build: Callable[[Shop], DataFrame]
    places: dict[int, str]
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(name: str, places: dict[int, str] | None = None, parts: str = "", sql: str | None = None):
    """Register a query; ``places`` rounds columns of both sides."""
    places = places or {}

    def register(build: Callable[[Shop], DataFrame]):
        text = None
        if sql is not None:
            text = with_parts(parts, rounded(sql, places) if places else sql)
        QUERIES[name] = Query(build, places, text)
        return build

    return register


def run(name: str, spark: SparkSession, folder: str) -> DataFrame:
    entry = QUERIES[name]
    df = entry.build(shop_for(spark, folder))
    # Adding 0.0 turns a rounded -0.0 into 0.0.
    changes = {
        c: half_even(F.col(c), n) + F.lit(0.0)
        for n, names in entry.places.items() for c in names.split()
    }
    return df.withColumns(changes) if changes else df
