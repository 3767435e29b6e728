"""Rolling-origin folds and history cuts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def recent_history(df: DataFrame, days: int = 120) -> DataFrame:
    """Rows dated within ``days`` of the last date, both ends included.

    A table stored by ``sale_month`` is cut by that column first, so neither the
    search for the last date nor the result reads the older folders.
    """
    if "sale_month" not in df.columns:
        newest = df.agg(F.max("date")).scalar()
        return df.where(F.col("date") >= F.date_sub(newest, days))
    last_month = df.agg(F.max("sale_month")).scalar()
    newest = df.where(F.col("sale_month") == last_month).agg(F.max("date")).scalar()
    first = F.date_sub(newest, days)
    return df.where(
        (F.col("sale_month") >= F.date_format(first, "yyyy-MM")) & (F.col("date") >= first)
    )


def with_min_history(df: DataFrame, rows: int = 60) -> DataFrame:
    """Rows of products that have at least ``rows`` rows."""
    enough = (
        df.groupBy("stock_code")
        .agg(F.count("date").alias("n"))
        .where(F.col("n") >= rows)
        .select("stock_code")
    )
    return df.join(enough, "stock_code", "left_semi")


def cv_folds(
    df: DataFrame, folds: int = 3, horizon: int = 28, min_train_days: int = 90
) -> DataFrame:
    """Train and test ranges of each rolling-origin fold, oldest fold first.

    The newest fold tests on the last ``horizon`` distinct dates and trains on
    all earlier ones; each older fold ends where the test before it started. A
    fold with too short a history ends the list. Only the distinct dates are
    gathered: as many as there are days.
    """
    dates = F.col("dates")
    end = F.size(dates) - 1 - F.col("back") * horizon
    start = end - horizon + 1
    return (
        df.agg(F.array_sort(F.collect_set("date")).alias("dates"))
        .select("dates", F.explode(F.sequence(F.lit(0), F.lit(folds - 1))).alias("back"))
        .withColumns({"_end": end, "_start": start})
        .where(F.col("_start") - 1 >= min_train_days)
        .select(
            F.get(dates, F.lit(0)).alias("train_start"),
            F.get(dates, F.col("_start") - 1).alias("train_end"),
            F.get(dates, F.col("_start")).alias("test_start"),
            F.get(dates, F.col("_end")).alias("test_end"),
            "back",
            # Folds count down as they go back, so the largest step is fold 1.
            F.greatest(
                F.lit(0),
                F.least(
                    F.lit(folds),
                    F.floor((F.size(dates) - 1 - min_train_days) / horizon),
                ),
            ).alias("_usable"),
        )
        .select(
            (F.col("_usable") - F.col("back")).cast("int").alias("fold"),
            "train_start", "train_end", "test_start", "test_end",
        )
    )
