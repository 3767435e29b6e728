"""Mixing sources to target weights by entropy balancing.

Every token of the corpus is a unit of a maximum-entropy problem: find rates as
close as possible to 1 (relative to a binomial of mean 1 on 0..cap copies) so
that each category's tokens, times the rates of their documents, meet a target.
The solution tilts the odds of a document exponentially by the multipliers of
its categories,

    rate = cap * sigmoid(sum of multipliers - log(cap - 1)),

and the multipliers minimise a convex dual. Its gradient and curvature are sums
over documents, so a Newton step is one grouped aggregation; documents of equal
categories share a rate and are added up once before the first step. Families of
categories (source, or source and language) take turns.

Rates become whole copies: a document gets the whole part, and the rest of a
source's tokens goes to the documents with the smallest draw over fraction, up
to the point where the source's budget is used. That point is found by digit
histograms, so no source is ever sorted or summed in one task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from larder.llm.common import fresh, word_count
from larder.plans.lineage import pin


@dataclass(frozen=True)
class MixRules:
    """``weights`` repeat over the sources by code point, null last; ``cap`` is the most copies."""

    weights: tuple[int, ...] = (1, 2, 3)
    cap: int = 3
    tolerance: float = 1e-10
    most_steps: int = 60


#: Histogram digits of the rounding, 8 bits each.
DIGITS = 3
_ALL = 2.0  # above every rank
_NO_ID = -(2**63)


def source_targets(sized: DataFrame, rules: MixRules = MixRules()) -> DataFrame:
    """(source, source_size, target): each source's share of all tokens.

    A share stops at ``cap`` times the source's size, and the excess is dealt
    again by weight. That is a common level ``t`` with target = min(cap * size,
    t * weight): sources are taken in order of cap * size / weight, and the level
    is set by the first one that it leaves under its cap. Works on one row per
    source. An empty input gives no rows; sources without words have target 0.
    """
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    names = Window.orderBy(F.col("source").asc_nulls_last())
    weights = F.array(*[F.lit(float(w)) for w in rules.weights])
    ranked = totals.withColumn(
        "weight", F.element_at(weights, (F.row_number().over(names) - 1) % len(rules.weights) + 1)
    ).withColumn("most", F.col("source_size") * float(rules.cap))
    by_ratio = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = by_ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("most").over(before), F.lit(0.0))
    level = left / F.sum("weight").over(onward)
    fits = F.when(level * F.col("weight") <= F.col("most"), level)
    return (
        ranked.withColumn("fits", fits)
        .withColumn("level", F.first("fits", ignorenulls=True).over(everything))
        .select("source", "source_size", F.least(F.col("most"), F.col("level") * F.col("weight")).alias("target"))
    )


def entropy_rates(cells: DataFrame, targets: dict[str, DataFrame], rules: MixRules = MixRules()) -> DataFrame:
    """``cells`` (one row per combination of categories, with ``tokens``) plus ``rate``.

    ``targets`` has for each family's column a table (category, target). A category
    whose target is its cap or 0 has that rate outright; so has a cell of which any
    category has. Null is a category like others. Raises when the targets of several
    families can't be met together.
    """
    families = list(targets)
    cap = float(rules.cap)
    fixed = F.coalesce(*[F.col(f"fixed_{f}") for f in families])
    tilt = sum((F.col(f"tilt_{f}") for f in families), F.lit(0.0))
    rate = F.coalesce(fixed, cap / (1 + (cap - 1) * F.exp(-tilt)))
    state = cells.groupBy(*families).agg(F.sum("tokens").cast("double").alias("tokens"))
    for f in families:
        goal = targets[f].select(F.col(f).alias("_category"), F.col("target").alias(f"target_{f}"))
        whole = F.sum("tokens").over(Window.partitionBy(f))
        state = (
            state.join(goal, F.col(f).eqNullSafe(F.col("_category"))).drop("_category")
            .withColumn(f"tilt_{f}", F.lit(0.0))
            .withColumn(f"fixed_{f}", F.when(F.col(f"target_{f}") >= cap * whole * (1 - 1e-12), cap).when(F.col(f"target_{f}") <= 0, 0.0))
        )
    state = pin(state)
    for _ in range(rules.most_steps):
        for f in families:
            sums = state.select("*", rate.alias("rate")).groupBy(F.col(f).alias("_category")).agg(
                F.first(f"target_{f}").alias("_target"),
                F.sum(F.col("tokens") * F.col("rate")).alias("_taken"),
                F.sum(F.when(fixed.isNull(), F.col("tokens") * F.col("rate") * (1 - F.col("rate") / cap))).alias("_slope"),
            )
            step = F.coalesce((F.col("_target") - F.col("_taken")) / F.nullif(F.col("_slope"), F.lit(0.0)), F.lit(0.0))
            moves = sums.select("_category", F.greatest(F.lit(-2.0), F.least(F.lit(2.0), step)).alias("_move"))
            state = pin(
                state.join(moves, F.col(f).eqNullSafe(F.col("_category")))
                .withColumn(f"tilt_{f}", F.col(f"tilt_{f}") + F.col("_move"))
                .drop("_category", "_move")
            )
        if _largest_gap(state, families, rate) <= rules.tolerance:
            return state.select(*families, "tokens", rate.alias("rate"))
    raise ValueError("the targets of these families can't be met together")


def _largest_gap(state: DataFrame, families: list[str], rate: Column) -> float:
    """The largest relative miss of a target, over all families."""
    worst = 0.0
    for f in families:
        sums = state.groupBy(f).agg(F.first(f"target_{f}").alias("t"), F.sum(F.col("tokens") * rate).alias("x"))
        gap = sums.agg(F.max(F.abs(F.col("x") - F.col("t")) / F.greatest(F.col("t"), F.lit(1.0)))).first()[0]
        worst = max(worst, gap or 0.0)
    return worst


def draw() -> Column:
    """A fixed number from 0 up to 1 for a document: 48 bits of the MD5 of its id and text."""
    text = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.coalesce("text", F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("double") / float(16**12)


def _rank(draw_: Column, fraction: Column) -> Column:
    """Order of the extra copies: draw over fraction, mapped to 0..1; null if there is no fraction."""
    return F.when(fraction > 0, draw_ / (draw_ + fraction))


def _budget_cut(rows: DataFrame, budgets: DataFrame) -> DataFrame:
    """(source, cut, ties, fit): the last (rank, id, size) within the source's budget, how many rows share it and how many of them fit.

    ``rows``: source, rank, id, size; ``budgets``: source, budget. Each digit's
    histogram has 256 rows a source and says in which cell the budget ends; only
    that cell's rows go on. What is left has one 16-millionth of a source, or repeated
    rows, which are counted before they meet.
    """
    # of each source: where the cell begins, how wide it is, and what of the budget is left there
    at = budgets.select("source", F.col("budget").alias("left"), F.lit(0.0).alias("low"))
    width, open_rows = 1.0, rows
    for _ in range(DIGITS):
        width /= 256
        here = open_rows.join(at.select(F.col("source").alias("_s"), "low"), F.col("source").eqNullSafe(F.col("_s"))).withColumn(
            "digit", F.floor((F.col("rank") - F.col("low")) / width).cast("long")
        )
        sums = here.groupBy("source", "low", "digit").agg(F.sum("size").alias("sum"))
        order = Window.partitionBy("source").orderBy("digit")
        through = F.sum("sum").over(order)
        found = (
            sums.join(at.select(F.col("source").alias("_s"), "left"), F.col("source").eqNullSafe(F.col("_s")))
            .withColumn("through", through)
            .filter(F.col("through") > F.col("left"))
            .groupBy("source")
            .agg(F.min(F.struct("digit", "low", (F.col("left") - F.col("through") + F.col("sum")).alias("left"))).alias("x"))
            .select("source", F.col("x.left").alias("left"), (F.col("x.low") + F.col("x.digit") * width).alias("low"))
        )
        at = pin(found)
        cell = at.select(F.col("source").alias("_s"), F.col("low").alias("_low"))
        open_rows = rows.join(cell, F.col("source").eqNullSafe(F.col("_s"))).filter(
            (F.col("rank") >= F.col("_low")) & (F.col("rank") < F.col("_low") + width)
        ).select(*rows.columns)
    groups = open_rows.groupBy("source", "rank", "id", "size").agg(F.count("*").alias("ties"))
    order = Window.partitionBy("source").orderBy("rank", "id", "size")
    through = F.sum(F.col("size") * F.col("ties")).over(order)
    # a row fits if its middle does
    room = F.col("left") - F.col("through") + F.col("size") * F.col("ties")
    fit = F.when(F.col("size") > 0, F.least(F.col("ties"), F.floor(F.try_divide(room, F.col("size")) + 0.5))).when(room >= 0, F.col("ties"))
    last = (
        groups.withColumn("through", through)
        .join(at.select(F.col("source").alias("_s"), "left"), F.col("source").eqNullSafe(F.col("_s")))
        .withColumn("fit", fit)
        .filter("fit > 0")
        .groupBy("source")
        .agg(F.max(F.struct("rank", "id", "size", "ties", "fit")).alias("last"))
        .select("source", F.struct("last.rank", "last.id", "last.size").alias("last"), "last.ties", "last.fit")
    )
    none = lambda rank: F.struct(rank.alias("rank"), F.lit(_NO_ID).alias("id"), F.lit(0).cast("long").alias("size"))
    return (
        budgets.select("source")
        .join(at.select(F.col("source").alias("_a"), "low"), F.col("source").eqNullSafe(F.col("_a")), "left")
        .join(last.withColumnRenamed("source", "_l"), F.col("source").eqNullSafe(F.col("_l")), "left")
        .select(
            "source", F.coalesce("last", F.when(F.col("low").isNotNull(), none(F.col("low"))), none(F.lit(_ALL))).alias("cut"),
            F.coalesce("ties", F.lit(0)).alias("ties"), F.coalesce("fit", F.lit(0)).alias("fit"),
        )
    )


@dataclass(frozen=True)
class Mix:
    """``plan``: per source its size, target, whole copies, fraction and cut; ``sized``: the documents it was made from."""

    plan: DataFrame
    sized: DataFrame

    def copies(self, rows: DataFrame, name: str = "copies") -> DataFrame:
        """``rows`` (id, source, size, draw and more) with the plan's columns and a document's copies.

        Rows that share the last place of a budget, as repeated rows do, are numbered
        within their input partitions, and each partition takes its part of what fits.
        """
        plan = self.plan.withColumnRenamed("source", "_plan_source")
        joined = rows.join(plan, F.col("source").eqNullSafe(F.col("_plan_source"))).drop("_plan_source")
        mine = F.struct(_rank(F.col("draw"), F.col("fraction")).alias("rank"), F.col("id"), F.col("size"))
        some = F.col("fraction") > 0
        extra = F.when(some & (mine <= F.col("cut")), 1).otherwise(0)
        if self.plan.filter("fit < ties").isEmpty():
            return joined.withColumn(name, F.col("whole") + extra)
        last = F.coalesce(some & (mine == F.col("cut")) & (F.col("fit") < F.col("ties")), F.lit(False))
        others = joined.filter(~last).withColumn(name, F.col("whole") + extra)
        tied = pin(joined.filter(last).withColumn("_part", F.spark_partition_id()))
        parts = tied.groupBy("source", "_part").agg(F.count("*").alias("_rows"))
        ahead = Window.partitionBy("source").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
        ahead = parts.select(
            F.col("source").alias("_s"), F.col("_part").alias("_p"), F.coalesce(F.sum("_rows").over(ahead), F.lit(0)).alias("_ahead")
        )
        inside = F.row_number().over(Window.partitionBy("source", "_part").orderBy("_part"))
        numbered = tied.withColumn("_nth", inside).join(ahead, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_part") == F.col("_p")))
        fits = (F.col("_ahead") + F.col("_nth") <= F.col("fit")).cast("int")
        return others.unionByName(numbered.withColumn(name, F.col("whole") + fits).drop("_part", "_nth", "_s", "_p", "_ahead"))


def sized_documents(docs: DataFrame) -> DataFrame:
    """id (null: the least long), source, size in words and draw of each document."""
    return docs.select(
        "doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID + 1)).alias("id"),
        "source", word_count().alias("size"), draw().alias("draw"),
    )


def mix_documents(docs: DataFrame, rules: MixRules = MixRules()) -> Mix:
    """The mix of ``docs`` (doc_id, text, source): one pass over the texts.

    Null texts have size 0, null is a source of its own, repeated rows are documents
    of their own that share their draw, of which as many are taken as fit; other ties of
    draws are broken by id and size. Rows that only share an id, or have none, have
    draws of their own, by their texts.
    """
    sized = pin(sized_documents(docs))
    targets = pin(source_targets(sized, rules))
    rates = entropy_rates(sized.select("source", F.col("size").alias("tokens")), {"source": targets}, rules)
    # a rate within rounding of a whole number is that number
    near = F.round("rate", 9)
    plan = pin(
        targets.join(rates.select(F.col("source").alias("_s"), "rate"), F.col("source").eqNullSafe(F.col("_s"))).select(
            "source", "source_size", "target", F.floor(near).cast("int").alias("whole"), (near - F.floor(near)).alias("fraction")
        )
    )
    shares = plan.filter(F.col("fraction") > 0)
    budgets = shares.select("source", (F.col("target") - F.col("whole") * F.col("source_size")).alias("budget"))
    rows = sized.join(
        shares.select(F.col("source").alias("_s"), "fraction"), F.col("source").eqNullSafe(F.col("_s"))
    ).select("source", _rank(F.col("draw"), F.col("fraction")).alias("rank"), "id", "size")
    cuts = _budget_cut(rows, budgets).withColumnRenamed("source", "_s")
    return Mix(pin(plan.join(cuts, F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s")), sized)


def mixed_corpus(docs: DataFrame, rules: MixRules = MixRules()) -> DataFrame:
    """``docs`` with each row as often as the mix takes it; columns as they came."""
    names = docs.columns
    mix = mix_documents(docs.select("doc_id", "text", "source"), rules)
    body = fresh(names, "_row")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias(body), *_keys(docs))
    taken = mix.copies(rows).filter(F.col("copies") > 0)
    return taken.withColumn("_nth", F.explode(F.array_repeat(F.lit(0), F.col("copies")))).select(f"{body}.*")


def _keys(docs: DataFrame) -> list[Column]:
    return [
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID + 1)).alias("id"),
        F.col("source"), word_count().alias("size"), draw().alias("draw"),
    ]
