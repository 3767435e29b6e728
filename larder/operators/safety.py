"""Safety stock by service level."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from larder.functions.normal import normal_quantile

SERVICE_LEVELS = (0.90, 0.95, 0.975, 0.99, 0.999)


def safety_stock(
    sales: DataFrame, products: DataFrame, levels: tuple[float, ...] = SERVICE_LEVELS, default_lead_days: int = 7
) -> DataFrame:
    """Per product and service level: z times the daily deviation times the root of the lead time, and the reorder point with it.

    ``sales`` has a row per product and day. A product of one day has no deviation and no
    safety stock; one without a lead time takes ``default_lead_days``.
    """
    demand = sales.groupBy("stock_code").agg(F.avg("quantity").alias("daily_mean"), F.stddev_samp("quantity").alias("daily_std"))
    lead = F.coalesce("lead_time_days", F.lit(default_lead_days))
    known = demand.join(products.select("stock_code", "lead_time_days"), "stock_code", "left").withColumn("lead_time_days", lead)
    factors = F.array(*[F.struct(F.lit(p).alias("p"), normal_quantile(F.lit(p)).alias("z")) for p in levels])
    rows = known.withColumn("_level", F.explode(factors))
    stock = F.col("_level.z") * F.coalesce("daily_std", F.lit(0.0)) * F.sqrt("lead_time_days")
    return rows.select(
        "stock_code", F.col("_level.p").alias("service_level"), F.col("_level.z").alias("z"), "lead_time_days",
        stock.alias("safety_stock"), (F.col("daily_mean") * F.col("lead_time_days") + stock).alias("reorder_point"),
    )
