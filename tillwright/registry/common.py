"""Registration helpers and the SQL twins of the logical tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tillwright.sources.sinks import flat

Query = Callable[[SparkSession, str], DataFrame]

SALES = """sales AS (
  SELECT l_orderkey AS sale_id, l_linenumber AS line_number, l_partkey AS product_id, l_suppkey AS store_id,
         CAST(l_shipdate AS DATE) AS sale_date, CAST(l_quantity AS INTEGER) AS quantity,
         CAST(round(CAST(l_extendedprice AS DECIMAL(14,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))), 2)
              AS DECIMAL(14,2)) AS total_amount
  FROM lineitem)"""
PRODUCTS = """products AS (
  SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category,
         CAST(p_retailprice AS DECIMAL(12,2)) AS cost_price FROM part)"""
STORES = """stores AS (
  SELECT s_suppkey AS store_id, s_name AS store_location,
         CAST(greatest(s_acctbal, 0) AS DECIMAL(12,2)) AS monthly_rent FROM supplier)"""
DETAIL = f"""{SALES}, {PRODUCTS}, {STORES}, detail AS (
  SELECT s.*, p.product_name, p.category, p.cost_price, t.store_location, t.monthly_rent,
         s.total_amount - p.cost_price * s.quantity AS profit, p.cost_price * s.quantity AS cost
  FROM sales s LEFT JOIN products p ON p.product_id = s.product_id
  LEFT JOIN stores t ON t.store_id = s.store_id)"""


class Registry:
    """Queries by name, each with its SQL twin where SQL can express it."""

    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.oracles: dict[str, str] = {}

    def add(self, name: str, sql: str | None = None) -> Callable[[Query], Query]:
        def keep(build: Query) -> Query:
            self.queries[name] = lambda spark, folder: flat(build(spark, folder))
            if sql is not None:
                self.oracles[name] = sql
            return build

        return keep
