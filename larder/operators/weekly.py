"""Weekly demand per product, kept up as batches of lines come in."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

LINES = "stock_code string, quantity double, revenue double, invoice_no string, week date, batch long"


def _weeks(df: DataFrame) -> DataFrame:
    return df.withColumn("week", F.trunc("date", "week"))


def weekly_demand(lines: DataFrame) -> DataFrame:
    """Per product and week (its Monday) with sales: quantity, revenue and lines."""
    return lines.groupBy("stock_code", "week").agg(
        F.sum("quantity").alias("quantity"), F.sum("revenue").alias("revenue"), F.count("*").alias("line_count")
    )


def with_zero_weeks(demand: DataFrame) -> DataFrame:
    """``demand`` with a row of zeros for each week without sales, from a product's first to the last week of all.

    Each week is stretched to the one before the product's next; no cross join.
    """
    last = demand.agg(F.max("week")).scalar()
    nexts = F.lead("week").over(Window.partitionBy("stock_code").orderBy("week"))
    upto = F.coalesce(F.date_sub(nexts, 7), last)
    stretched = demand.withColumn("_weeks", F.sequence(F.col("week"), upto, F.expr("interval 7 days")))
    sold = F.col("_at") == 0
    return stretched.select("stock_code", F.posexplode("_weeks").alias("_at", "_week"), "quantity", "revenue", "line_count").select(
        "stock_code", F.col("_week").alias("week"),
        *[F.when(sold, F.col(c)).otherwise(F.lit(0)).alias(c) for c in ("quantity", "revenue", "line_count")],
    )


class WeeklyDemand:
    """Stored weekly demand that grows batch by batch.

    Lines are kept by week and batch, demand by week. A batch overwrites its own lines
    and then the demand of the weeks it touches, both as whole folders, and is entered
    in the list of batches last. A batch that was cut short can be sent again; one that
    is entered already changes nothing. So demand is always that of all lines, and a
    small batch costs its weeks, not the history.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _read(self, part: str, schema: str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.path}/{part}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def batches(self) -> set[int]:
        """Numbers of the batches taken; one row a batch."""
        return {row["batch"] for row in self._read("batches", "batch long").collect()}

    def take(self, tx: DataFrame, batch: int) -> bool:
        """Add the lines of ``tx`` (clean transactions) as ``batch``; false if it is known already."""
        if batch in self.batches():
            return False
        lines = _weeks(tx).select("stock_code", "quantity", "revenue", "invoice_no", "week", F.lit(batch).cast("long").alias("batch"))
        self._overwrite(lines.repartition("week"), "lines", "week", "batch")
        stored = self._read("lines", LINES)
        touched = [row["week"] for row in stored.where(F.col("batch") == batch).select("week").distinct().collect()]  # as many as weeks
        demand = weekly_demand(stored.where(F.col("week").isin(touched)))
        self._overwrite(demand.repartition("week"), "demand", "week")
        self.spark.createDataFrame([(batch,)], "batch long").coalesce(1).write.mode("append").parquet(f"{self.path}/batches")
        return True

    def _overwrite(self, df: DataFrame, part: str, *by: str) -> None:
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(f"{self.path}/{part}")

    def demand(self) -> DataFrame:
        """Demand of all weeks with sales."""
        rows = self._read("demand", "stock_code string, quantity double, revenue double, line_count long, week date")
        return rows.select("stock_code", "week", "quantity", "revenue", "line_count")
