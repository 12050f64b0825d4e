"""The logical tables read from the benchmark's Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

SATURDAY = 5  # Monday is 0


def parquet(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def sales(spark: SparkSession, folder: str) -> DataFrame:
    price = F.col("l_extendedprice").cast("decimal(14,2)")
    discount = F.col("l_discount").cast("decimal(4,2)")
    return parquet(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("sale_id"),
        F.col("l_linenumber").alias("line_number"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("store_id"),
        F.to_date("l_shipdate").alias("sale_date"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.round(price * (1 - discount), 2).cast("decimal(14,2)").alias("total_amount"),
    )


def products(spark: SparkSession, folder: str) -> DataFrame:
    return parquet(spark, folder, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").cast("decimal(12,2)").alias("cost_price"),
    )


def stores(spark: SparkSession, folder: str) -> DataFrame:
    return parquet(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("store_id"),
        F.col("s_name").alias("store_location"),
        F.greatest(F.col("s_acctbal"), F.lit(0.0)).cast("decimal(12,2)").alias("monthly_rent"),
    )


def category_orders(spark: SparkSession, folder: str) -> DataFrame:
    """One row per order: category is its priority, amount its price in cents."""
    return parquet(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderpriority").alias("category"),
        F.round(F.col("o_totalprice").cast("decimal(14,2)") * 100).cast("bigint").alias("amount"),
        F.to_date("o_orderdate").alias("order_date"),
    )


def transactions(spark: SparkSession, folder: str) -> DataFrame:
    """An invoice log, one series per market segment. Saturday's orders are booked on Sunday, so Saturdays are a structural gap.

    Returned lines are the cancellations (``C`` before the invoice number,
    negative quantity); one customer in 25 is anonymous. Some suppliers' lines
    lack a quantity or are write-offs, and some parts are free samples.
    """
    orders = parquet(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    customers = parquet(spark, folder, "customer").select("c_custkey", "c_mktsegment")
    lines = parquet(spark, folder, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag")
    booked = F.when(F.weekday("o_orderdate") == SATURDAY, F.col("o_orderdate") + F.expr("INTERVAL 1 DAY")).otherwise(F.col("o_orderdate"))
    headed = orders.withColumn("o_orderdate", booked).join(customers, F.col("o_custkey") == F.col("c_custkey"))
    returned = F.col("l_returnflag") == "R"
    units = F.ceil(F.col("l_quantity") / 10).cast("int")
    quantity = (
        F.when(F.col("l_suppkey") % 97 == 13, F.lit(None))
        .when(returned | (F.col("l_suppkey") % 89 == 7), -units)
        .otherwise(units)
    )
    price = F.when(F.col("l_partkey") % 41 == 0, F.lit(0)).otherwise(10 + F.col("l_partkey") % 50)
    return lines.join(headed, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("c_mktsegment").alias("series_key"),
        F.concat(F.when(returned, "C").otherwise(""), F.col("l_orderkey").cast("string")).alias("invoice_no"),
        (F.col("l_partkey") % 50).cast("string").alias("stock_code"),
        quantity.alias("quantity"),
        F.col("o_orderdate").alias("invoice_ts"),
        price.cast("decimal(12,4)").alias("unit_price"),
        F.when(F.col("o_custkey") % 25 != 0, F.col("o_custkey")).alias("customer_id"),
    )


def customer_days(spark: SparkSession, folder: str) -> DataFrame:
    """Order value per customer and day with an order, numbered in order of time: many short series."""
    orders = parquet(spark, folder, "orders")
    days = orders.groupBy(F.col("o_custkey").cast("string").alias("series_key"), F.to_date("o_orderdate").alias("ds")).agg(
        F.sum(F.col("o_totalprice").cast("double")).alias("revenue"))
    ordered = Window.partitionBy("series_key").orderBy("ds")
    return days.withColumn("step", F.row_number().over(ordered).cast("bigint"))


def events(spark: SparkSession, folder: str) -> DataFrame:
    """Views and clicks of ten ads."""
    return parquet(spark, folder, "events").filter(F.col("event_type").isin("view", "click")).select(
        "event_id",
        F.col("ts").cast("timestamp").alias("ts"),
        (F.col("user_id") % 10).cast("string").alias("ad_id"),
        "event_type",
    )
