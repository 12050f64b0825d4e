"""Retail indicators over the totals of ``operators.facts``.

Group keys keep their NULL group (sales without a matching dimension row), as
SQL does; ``drop_null_keys`` gives the data-frame meaning.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tillwright.functions.scalars import rate, rate_or_zero


def drop_null_keys(df: DataFrame, *keys: str) -> DataFrame:
    return df.dropna(subset=list(keys))


def category_totals(orders: DataFrame, over: int | None = None) -> DataFrame:
    """Sum and mean of the amount per category, above a total if one is given."""
    totals = orders.groupBy("category").agg(
        F.sum("amount").alias("total_sales"), F.avg("amount").alias("avg_order_amount")
    )
    return totals if over is None else totals.filter(F.col("total_sales") > over)


def revenue_by_store(facts: DataFrame) -> DataFrame:
    return facts.groupBy("store_location").agg(
        F.sum("revenue").alias("total_revenue"), F.sum("units").alias("total_units")
    )


def units_by_product(facts: DataFrame, *, with_category: bool = True) -> DataFrame:
    keys = ["product_name", "category"] if with_category else ["product_name"]
    return facts.groupBy(*keys).agg(
        F.sum("units").alias("total_units"), F.sum("revenue").alias("total_revenue")
    )


def store_kpis(facts: DataFrame, *, one_rent_per_location: bool = False) -> DataFrame:
    """Revenue, units, rent and revenue ÷ rent per store.

    By default stores that share a location but not a rent stay apart and a
    zero rent gives NULL. With ``one_rent_per_location`` a location takes its
    highest rent, and a zero or unknown rent gives a ratio of 0.
    """
    sums = [F.sum("revenue").alias("total_revenue"), F.sum("units").alias("total_units")]
    if not one_rent_per_location:
        totals = facts.groupBy("store_location", "monthly_rent").agg(*sums)
        ratio = rate(F.col("total_revenue"), F.col("monthly_rent"))
    else:
        totals = facts.groupBy("store_location").agg(
            *sums, F.coalesce(F.max("monthly_rent"), F.lit(0).cast("decimal(12,2)")).alias("monthly_rent")
        )
        ratio = rate_or_zero(F.col("total_revenue"), F.col("monthly_rent"))
    return totals.withColumn("roi", F.round(ratio, 4))


def product_margins(facts: DataFrame, *, zero_fill: bool = False) -> DataFrame:
    """Units, revenue, cost, profit and margin rate per product and category."""
    quotient = rate_or_zero if zero_fill else rate
    return (
        facts.groupBy("product_name", "category")
        .agg(
            F.sum("units").alias("total_units"),
            F.sum("revenue").alias("total_revenue"),
            F.sum("cost").alias("total_cost"),
            F.sum("profit").alias("gross_profit"),
        )
        .withColumn("gross_margin_rate", F.round(quotient(F.col("gross_profit"), F.col("total_revenue")), 4))
    )


def slow_movers(facts: DataFrame, max_units: int = 3, min_cost: float = 100.0, *, strict: bool = False) -> DataFrame:
    """Products with few units sold and much cost bound in them.

    ``strict`` asks for fewer than ``max_units``; with ``min_cost=0`` that is
    the plain low-quantity flag.
    """
    few = F.col("total_units") < max_units if strict else F.col("total_units") <= max_units
    return (
        facts.groupBy("product_name")
        .agg(
            F.sum("units").alias("total_units"),
            F.sum("cost").alias("total_cost"),
            F.sum("revenue").alias("total_revenue"),
        )
        .filter(few & (F.col("total_cost") >= min_cost))
        .withColumn("risk_flag", F.lit("high"))
    )


def store_products(facts: DataFrame) -> DataFrame:
    """Units, revenue and profit per store and product."""
    return facts.groupBy("store_location", "product_name").agg(
        F.sum("units").alias("total_units"),
        F.sum("revenue").alias("total_revenue"),
        F.sum("profit").alias("gross_profit"),
    )


def category_profit(facts: DataFrame) -> DataFrame:
    return facts.groupBy("category").agg(
        F.sum("revenue").alias("revenue"), F.sum("profit").alias("estimated_profit")
    )


def average_sale_by_store(facts: DataFrame, min_sales: int = 0) -> DataFrame:
    """Mean sale amount per store, leaving out stores with few sales."""
    return (
        facts.groupBy("store_location")
        .agg(F.sum("sales_count").alias("sales_count"), F.sum("revenue").alias("revenue"))
        .filter(F.col("sales_count") >= min_sales)
        .select("store_location", "sales_count",
                rate(F.col("revenue"), F.col("sales_count")).alias("avg_sale_amount"))
    )


def _first_by(columns: Sequence[str], *order: Column) -> Column:
    """The row (as a struct) that comes first in ascending ``order``."""
    return F.min_by(F.struct(*columns), F.struct(*order))


def extremes(df: DataFrame, keys: Sequence[str], measure: str, high: str, low: str,
             label: str = "rank_type") -> DataFrame:
    """The rows with the highest and the lowest ``measure``, labelled.

    One aggregate instead of two global row numbers: partial minima per task,
    a single row at the end. Ties go to the smaller key. A NULL measure ranks
    as the lowest. A row that is both keeps the first label.
    """
    ties = [F.col(k) for k in keys]
    value = F.col(measure)
    picked = df.agg(
        _first_by(df.columns, value.isNull(), -value, *ties).alias("_high"),
        _first_by(df.columns, value.isNotNull(), value, *ties).alias("_low"),
    )
    same = F.lit(True)
    for k in keys:
        same = same & F.col(f"_high.{k}").eqNullSafe(F.col(f"_low.{k}"))
    rows = F.array(
        F.struct(F.col("_high").alias("row"), F.lit(high).alias("tag")),
        F.when(~same, F.struct(F.col("_low").alias("row"), F.lit(low).alias("tag"))),
    )
    return (
        picked.filter(F.col("_high").isNotNull())
        .select(F.explode(F.array_compact(rows)).alias("r"))
        .select("r.row.*", F.col("r.tag").alias(label))
    )


def top(df: DataFrame, n: int, measure: str, *ties: str, ascending: bool = False) -> DataFrame:
    """The ``n`` rows first by ``measure``, ties by name. Planned as a top-k."""
    value = F.asc_nulls_first(measure) if ascending else F.desc_nulls_last(measure)
    return df.orderBy(value, *[F.asc(t) for t in ties]).limit(n)


def both_ends(df: DataFrame, n: int, measure: str, *ties: str) -> DataFrame:
    """Top ``n`` and bottom ``n`` rows, marked by ``end``."""
    return (
        top(df, n, measure, *ties).withColumn("end", F.lit("top"))
        .unionByName(top(df, n, measure, *ties, ascending=True).withColumn("end", F.lit("bottom")))
    )


def by_descending(df: DataFrame, measure: str, *ties: str) -> DataFrame:
    """All rows, highest ``measure`` first."""
    return df.orderBy(F.desc_nulls_last(measure), *[F.asc(t) for t in ties])
