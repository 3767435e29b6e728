"""Reorder policy and stock ledger."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from larder.config import StockPolicy

LEDGER_SCHEMA = (
    "stock_code string, date date, opening_inventory double, units_sold double, "
    "closing_inventory double, reorder_triggered int, reorder_point double, eoq double, "
    "inventory_value double, coverage_days double, avg_daily_demand double"
)


def reorder_policy(
    sales: DataFrame, products: DataFrame, policy: StockPolicy = StockPolicy()
) -> DataFrame:
    """Mean demand, reorder point and order quantity per product (not rounded)."""
    demand = sales.groupBy("stock_code").agg(F.avg("quantity").alias("avg_daily_demand"))
    supply = products.select(
        "stock_code", "lead_time_days", F.col("avg_unit_price").alias("unit_price")
    )
    d, lead = F.col("avg_daily_demand"), F.col("lead_time_days")
    holding = F.greatest(
        F.col("unit_price") * policy.holding_rate, F.lit(policy.min_holding_cost)
    )
    return (
        demand.join(supply, "stock_code", "left")
        .fillna({"lead_time_days": policy.default_lead_days, "unit_price": policy.default_price})
        .withColumn(
            "reorder_point",
            F.greatest(d * (lead * policy.lead_cover), d * policy.min_cover_days),
        )
        .withColumn(
            "eoq",
            F.greatest(
                F.sqrt(2 * (d * 365) * policy.order_cost / holding),
                lead * d * 2,
                F.lit(policy.min_order),
            ),
        )
    )


def _ledger_of_product(rows: pd.DataFrame, policy: StockPolicy) -> pd.DataFrame:
    """The ledger of one product; at most one order is on its way at a time."""
    rows = rows.sort_values("date", ignore_index=True)
    terms = rows.iloc[0]
    demand, rop, eoq = terms["avg_daily_demand"], terms["reorder_point"], terms["eoq"]
    lead, order = int(terms["lead_time_days"]), float(np.rint(eoq))

    n = len(rows)
    sold, closing, ordered = np.zeros(n), np.zeros(n), np.zeros(n, dtype="int32")
    stock, due, arriving = demand * policy.opening_cover_days, None, 0.0
    for i, wanted in enumerate(rows["quantity"].tolist()):
        if due is not None and due <= i:
            stock, due = stock + arriving, None
        sold[i] = min(stock, wanted)
        stock = max(stock - sold[i], 0.0)
        if stock <= rop and due is None:
            due, arriving, ordered[i] = i + lead, order, 1
        closing[i] = stock

    cover = closing / demand if demand > 0 else np.full(n, policy.no_demand_cover)
    two_places = lambda x: np.rint(x * 100.0) / 100.0
    return pd.DataFrame(
        {
            "stock_code": rows["stock_code"],
            "date": rows["date"],
            "opening_inventory": closing + sold,
            "units_sold": sold,
            "closing_inventory": closing,
            "reorder_triggered": ordered,
            "reorder_point": two_places(rop),
            "eoq": two_places(eoq),
            "inventory_value": two_places(closing * terms["unit_price"]),
            "coverage_days": two_places(cover),
            "avg_daily_demand": np.rint(demand * 10000.0) / 10000.0,
        }
    )


def project_stock(
    sales: DataFrame, products: DataFrame, policy: StockPolicy = StockPolicy()
) -> DataFrame:
    """Daily stock ledger under a continuous-review (s, Q) policy with lost sales.

    Stock depends on the day before, so each product is folded in date order.
    A group is one product and holds one row per day of the date range,
    whatever the number of invoice lines behind it.
    """
    terms = reorder_policy(sales, products, policy)
    joined = sales.select("stock_code", "date", "quantity").join(terms, "stock_code")
    return joined.groupBy("stock_code").applyInPandas(
        lambda rows: _ledger_of_product(rows, policy), LEDGER_SCHEMA
    )


def reorder_list(latest: DataFrame) -> DataFrame:
    """Products whose latest stock is at or below the reorder point."""
    return latest.where(F.col("closing_inventory") <= F.col("reorder_point"))
