"""Sales joined with its dimensions.

No join here carries a broadcast hint. Spark broadcasts a dimension on its own
while it is under ``spark.sql.autoBroadcastJoinThreshold``; past that it falls
back to a sort-merge join, whose hot keys adaptive execution splits.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from tillwright.functions.scalars import gross_profit, rate
from tillwright.operators.skew import spread_join


def sales_detail(sales: DataFrame, products: DataFrame, stores: DataFrame, how: str = "left", spread: int = 1) -> DataFrame:
    """One row per sale with product, store, profit and margin rate.

    ``spread`` above 1 splits each measured hot product and store over so many
    tasks without adaptive execution, at the price of one count per dimension.
    """
    if spread > 1:
        joined = spread_join(spread_join(sales, products, "product_id", how, spread), stores, "store_id", how, spread)
    else:
        joined = sales.join(products, "product_id", how).join(stores, "store_id", how)
    profit = gross_profit(F.col("total_amount"), F.col("cost_price"), F.col("quantity"))
    return joined.withColumns({
        "gross_profit": profit,
        "gross_margin_rate": rate(profit, F.col("total_amount")),
    })


def between_dates(sales: DataFrame, first: dt.date | None = None, last: dt.date | None = None) -> DataFrame:
    """Sales of a date range, both ends included; either end may be open."""
    if first is not None:
        sales = sales.filter(F.col("sale_date") >= F.lit(first))
    if last is not None:
        sales = sales.filter(F.col("sale_date") <= F.lit(last))
    return sales


def combo_facts(sales: DataFrame, products: DataFrame, stores: DataFrame, how: str = "left") -> DataFrame:
    """Sales summed per (product_id, store_id), then joined with both dimensions.

    All sums of the reports are linear in these totals, so the fact table is
    summed before any join: map-side partial sums absorb hot products and hot
    stores, and the joins see one row per pair.
    """
    return _attach(_totals(sales, "product_id", "store_id"), products, stores, how)


def product_facts(sales: DataFrame, products: DataFrame, how: str = "left") -> DataFrame:
    """As ``combo_facts``, per product only."""
    return _attach(_totals(sales, "product_id"), products, None, how)


def store_facts(sales: DataFrame, stores: DataFrame, how: str = "left") -> DataFrame:
    """As ``combo_facts``, per store only (no cost, hence no profit)."""
    return _attach(_totals(sales, "store_id"), None, stores, how)


def _totals(sales: DataFrame, *keys: str) -> DataFrame:
    return sales.groupBy(*keys).agg(
        F.sum("quantity").alias("units"),
        F.sum("total_amount").alias("revenue"),
        F.count("total_amount").alias("sales_count"),
    )


def _attach(totals: DataFrame, products: DataFrame | None, stores: DataFrame | None, how: str) -> DataFrame:
    if products is not None:
        totals = totals.join(products, "product_id", how).withColumns({
            "cost": F.col("cost_price") * F.col("units"),
            "profit": gross_profit(F.col("revenue"), F.col("cost_price"), F.col("units")),
        })
    if stores is not None:
        totals = totals.join(stores, "store_id", how)
    return totals
