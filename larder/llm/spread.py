"""Joins whose many side may have a few keys that hold most of its rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

#: A key is frequent if it holds more than this share of the rows; so there are fewer than its inverse.
FREQUENT = 1 / 2000


def attach(rows: DataFrame, facts: DataFrame, key: str, copies: str = "copies") -> DataFrame:
    """``rows`` joined with the one row of ``facts`` that has their key.

    ``facts`` has each key once and how many ``rows`` have it (``copies``); it is read
    three times, so it should be stored. Facts of frequent keys, fewer than
    1 / ``FREQUENT`` by their definition, are broadcast; the rest is shuffled, where no
    key holds more than that share. Null keys join with nothing.
    """
    total = facts.agg(F.sum(copies)).first()[0] or 0
    frequent = F.col(copies) > F.lit(total * FREQUENT)
    heavy = facts.filter(frequent)
    often = rows.join(F.broadcast(heavy), key)
    rare = rows.join(F.broadcast(heavy.select(key)), key, "left_anti").join(facts.filter(~frequent), key)
    return often.unionByName(rare)
