"""The report that combines several retail indicators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tillwright.functions.scalars import rate_or_zero
from tillwright.operators import kpi

# Groupings of one pass over the summed sales; grouping_id has a bit per absent key.
KEYS = ["store_location", "product_name", "category"]
BY_STORE, BY_PRODUCT, BY_PAIR = 0b011, 0b100, 0b001


def _ranked(level: int, row: Column, *order: Column) -> Column:
    """The subject and value that come first in ``order`` among the rows of one grouping."""
    return F.min_by(row, F.when(F.col("level") == level, F.struct(*order)))


def recommendations(combos: DataFrame, products: DataFrame, max_units: int = 3, min_cost: float = 100.0) -> DataFrame:
    """Best store, slow movers, best and worst margin, best and worst combination.

    ``combos`` is ``facts.combo_facts`` and ``products`` ``facts.product_facts``.
    All single-row answers come out of one grouping-sets aggregate, so the
    sales are summed once for them and once, per product, for the slow movers.
    """
    grouped = combos.groupingSets([["store_location"], ["product_name", "category"], ["store_location", "product_name"]],
                                  *KEYS).agg(
        F.grouping_id().alias("level"), F.sum("revenue").alias("revenue"), F.sum("profit").alias("profit"),
    ).withColumn("margin", F.round(rate_or_zero(F.col("profit"), F.col("revenue")), 4))
    store, product, category = (F.col(k) for k in KEYS)
    revenue, margin = F.col("revenue"), F.col("margin")
    pair = F.concat_ws(" - ", store, product)

    def row(subject: Column, value: Column) -> Column:
        return F.struct(subject.alias("subject"), value.cast("double").alias("value"), store, product, category)

    best = grouped.agg(
        _ranked(BY_STORE, row(store, revenue), revenue.isNull(), -revenue, store).alias("best_store"),
        _ranked(BY_PRODUCT, row(product, margin), -margin, product, category).alias("highest_margin"),
        _ranked(BY_PRODUCT, row(product, margin), margin, product, category).alias("lowest_margin"),
        _ranked(BY_PAIR, row(pair, revenue), revenue.isNull(), -revenue, store, product).alias("best_combo"),
        _ranked(BY_PAIR, row(pair, revenue), revenue.isNotNull(), revenue, store, product).alias("worst_combo"),
    )

    def line(name: str, other_than: str | None = None) -> Column:
        entry = F.struct(F.lit(name).alias("topic"), F.col(f"{name}.subject"), F.col(f"{name}.value"))
        shown = F.col(name).isNotNull()
        if other_than:
            shown = shown & ~F.col(name).eqNullSafe(F.col(other_than))
        return F.when(shown, entry)

    lines = F.array_compact(F.array(
        line("best_store"), line("highest_margin"), line("lowest_margin", "highest_margin"),
        line("best_combo"), line("worst_combo", "best_combo"),
    ))
    slow = kpi.slow_movers(products, max_units, min_cost).select(
        F.lit("slow_mover").alias("topic"), F.col("product_name").alias("subject"),
        F.col("total_units").cast("double").alias("value"),
    )
    return best.select(F.inline(lines)).unionByName(slow)
