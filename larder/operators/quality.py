"""Input checks and data-quality reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from larder.config import CleaningRules, HEADER_SPELLINGS
from larder.operators.cleaning import number_of, time_of
from larder.operators.moments import column_pairs
from larder.operators.ranks import is_number, melted, quantiles
from larder.plans.lineage import pin


#: Columns of which only certain texts are of use; of the others anything but blanks is.
_NUMBERS, _DATES = ("Quantity", "UnitPrice"), ("InvoiceDate",)


def _usable(df: DataFrame, name: str, column: str, rules: CleaningRules) -> Column:
    if name in _NUMBERS:
        return number_of(df, column).isNotNull()
    if name in _DATES:
        return time_of(df, rules, column).isNotNull()
    return F.trim(F.col(column).cast("string")) != ""


def schema_report(df: DataFrame, rules: CleaningRules = CleaningRules()) -> DataFrame:
    """For every expected column: found or missing, the first matching spelling, and how many of its values are of use.

    A number or a date is of use if cleaning can read it, any other value if it isn't
    blank. One scan of the matched columns; a missing column has none.
    """
    present = set(df.columns)
    matched = {name: next((s for s in spellings if s in present), None) for name, spellings in HEADER_SPELLINGS.items()}
    counts = df.agg(
        F.count(F.lit(1)).alias("row_count"),
        *[F.count_if(_usable(df, name, m, rules)).alias(name) for name, m in matched.items() if m],
    )
    entries = [
        F.struct(
            F.lit(name).alias("required_column"), F.lit("Found" if m else "Missing").alias("status"),
            F.lit(m).cast("string").alias("matched_as"), (F.col(name) if m else F.lit(0)).cast("long").alias("usable_values"),
            F.col("row_count"),
        )
        for name, m in matched.items()
    ]
    return counts.select(F.inline(F.array(*entries)))


def quality_overview(df: DataFrame) -> DataFrame:
    """Mean null share, duplicate-row share and column counts in one row.

    Equal rows are counted before the totals, so duplicates combine on the map
    side and no row set is gathered.
    """
    columns = df.columns
    numeric = sum(isinstance(f.dataType, T.NumericType) for f in df.schema.fields)
    text = sum(isinstance(f.dataType, T.StringType) for f in df.schema.fields)
    nulls = sum((F.col(c).isNull().cast("int") for c in columns), F.lit(0))
    distinct = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_copies"))
    rows = F.sum("_copies")
    return distinct.agg(
        rows.alias("row_count"),
        (F.try_divide(F.sum(nulls * F.col("_copies")), rows * len(columns)) * 100).alias(
            "avg_null_pct"
        ),
        (F.try_divide(rows - F.count(F.lit(1)), rows) * 100).alias("duplicate_pct"),
        F.lit(numeric).alias("numeric_columns"),
        F.lit(text).alias("text_columns"),
    )


def missing_report(df: DataFrame) -> DataFrame:
    """Null count, null percentage and type of every column; sort by null_count."""
    total = F.count(F.lit(1))
    counts = df.agg(
        total.alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns]
    )
    entries = [
        F.struct(
            F.lit(f.name).alias("column_name"),
            F.col(f.name).alias("null_count"),
            F.round(F.try_divide(F.col(f.name), F.col("_rows")) * 100, 2).alias("null_pct"),
            F.lit(f.dataType.simpleString()).alias("dtype"),
        )
        for f in df.schema.fields
    ]
    return counts.select(F.inline(F.array(*entries)))


def column_stats(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count, mean, deviation, range, quartiles and null share per column.

    Rows are melted to one per column, so any number of columns is one grouped
    aggregation; the quartiles are exact and need no sorted column. ``df`` is read
    several times and should be stored. NaN and infinite values count as null.
    """
    values = melted(df, columns)
    value = F.when(is_number(F.col("value")), F.col("value"))
    stats = values.withColumn("value", value).groupBy("feature").agg(
        F.count("value").alias("n"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"),
        F.round(F.try_divide(F.count_if(F.col("value").isNull()), F.count(F.lit(1))) * 100, 2).alias("null_pct"),
    )
    quartiles = quantiles(values, ["feature"], "value", {"q25": 0.25, "median": 0.5, "q75": 0.75})
    return stats.join(quartiles, "feature", "left").select(
        "feature", "n", "mean", "std", "min", "q25", "median", "q75", "max", "null_pct"
    )


def correlation_matrix(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pairwise correlations as rows (x, y, n, correlation); ``n`` rows have both. Null where a side is constant."""
    return column_pairs(df, columns).select("x", "y", "n", "correlation")


def _with_target(pairs: DataFrame, target: str) -> DataFrame:
    return pairs.where((F.col("x") == target) & (F.col("y") != target) & F.col("correlation").isNotNull())


def target_correlation(df: DataFrame, target: str, columns: list[str]) -> DataFrame:
    """Correlation of each column with the target, where there is one."""
    pairs = column_pairs(df, [target, *[c for c in columns if c != target]])
    return _with_target(pairs, target).select(F.col("y").alias("feature"), "correlation")


def top_correlated(df: DataFrame, target: str, columns: list[str], n: int) -> DataFrame:
    strongest = F.desc(F.abs("correlation"))
    return target_correlation(df, target, columns).orderBy(strongest, "feature").limit(n)


def group_strength(strength: DataFrame, groups: dict[str, list[str]]) -> DataFrame:
    """Per group of features, from ``target_correlation``: how many there are, and their mean and greatest correlation without sign.

    A feature may be in several groups; a group without features has no row.
    """
    members = [(group, name) for group, names in groups.items() for name in names]
    of = strength.sparkSession.createDataFrame(members, "feature_group string, feature string")
    return strength.join(F.broadcast(of), "feature").groupBy("feature_group").agg(
        F.count("*").alias("features"), F.avg(F.abs("correlation")).alias("mean_strength"),
        F.max(F.abs("correlation")).alias("max_strength"),
    )


def strongest_matrix(df: DataFrame, target: str, columns: list[str], n: int) -> DataFrame:
    """The correlation matrix of the target and the ``n`` columns most correlated with it.

    One pass gives all pairs, from which both steps read.
    """
    pairs = pin(correlation_matrix(df, [target, *[c for c in columns if c != target]]))
    ranked = _with_target(pairs, target).orderBy(F.desc(F.abs("correlation")), "y").limit(n)
    chosen = pin(ranked.select(F.col("y").alias("name")).unionByName(ranked.select(F.lit(target).alias("name")).limit(1)))
    return (
        pairs.join(chosen.withColumnRenamed("name", "x"), "x", "left_semi")
        .join(chosen.withColumnRenamed("name", "y"), "y", "left_semi").select("x", "y", "n", "correlation")
    )


def most_variable(stats: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` columns of largest deviation, from ``column_stats``."""
    return stats.orderBy(F.desc_nulls_last("std"), "feature").limit(n)
