"""Transaction-log cleaning: cancellation matching and what is left to sell.

A cancelled invoice removes one earlier-or-later line of the same customer,
stock code, price and absolute quantity; of the lines that share this key the
earliest go first, as many as there are cancellations. Anonymous lines never
match. The sign and price filter comes after the matching, or the
cancellations would be gone before they could match.

``series_key`` is part of the key: matching happens inside a series.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tillwright.operators.ordered import running_totals

KEY = ["series_key", "customer_id", "stock_code", "unit_price", "abs_quantity"]


def tagged(transactions: DataFrame) -> DataFrame:
    """Adds day, match-key quantity and the row's role in the cleaning."""
    core = F.col("quantity").isNotNull() & F.col("unit_price").isNotNull() & F.col("invoice_ts").isNotNull()
    cancel = F.coalesce(F.col("invoice_no").startswith("C"), F.lit(False))
    positive = (F.col("quantity") > 0) & (F.col("unit_price") > 0)
    role = (
        F.when(~core, "missing_core").when(cancel, "cancel").when(positive, "sale").otherwise("not_positive")
    )
    return transactions.withColumns({
        "ds": F.to_date("invoice_ts"),
        "abs_quantity": F.abs("quantity"),
        "role": role,
    })


def day_ledger(transactions: DataFrame) -> DataFrame:
    """Lines per match key and day, with the number of sales matched away.

    Sales of one key and day are interchangeable for every daily figure, so
    they are only counted: copies and hot keys shrink in the map-side sum, and
    the window that spends a key's cancellations on its earliest days sees at
    most one row per calendar day.
    """
    def role(name: str):
        return F.count_if(F.col("role") == name).alias(name)

    counts = tagged(transactions).groupBy(*KEY, "ds").agg(
        role("missing_core"), role("cancel"), role("sale"), role("not_positive")
    )
    # Both windows share partition and order, hence one sort.
    key = Window.partitionBy(*KEY).orderBy("ds")
    whole = key.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    earlier = key.rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("cancel").over(whole) - F.coalesce(F.sum("sale").over(earlier), F.lit(0))
    matched = F.when(F.col("customer_id").isNull(), 0).otherwise(
        F.least(F.col("sale"), F.greatest(left, F.lit(0)))
    ).cast("bigint")
    return counts.withColumn("matched", matched).withColumns({
        "kept": F.col("sale") - F.col("matched"),
        "kept_revenue": (F.col("sale") - F.col("matched")) * F.col("abs_quantity") * F.col("unit_price"),
        "removed_revenue": F.col("matched") * F.col("abs_quantity") * F.col("unit_price"),
    })


def audit(ledger: DataFrame) -> DataFrame:
    """Rows in, rows removed per step, rows and revenue left: one row."""
    def total(column: str):
        return F.coalesce(F.sum(column), F.lit(0))

    return ledger.agg(
        total("missing_core").alias("missing_core"),
        total("cancel").alias("cancels"),
        total("matched").alias("matched_sales"),
        total("not_positive").alias("not_positive"),
        total("kept").alias("rows_kept"),
        total("kept_revenue").alias("revenue_kept"),
        total("removed_revenue").alias("revenue_removed"),
    ).withColumn(
        "rows_in",
        F.col("missing_core") + F.col("cancels") + F.col("matched_sales") + F.col("not_positive") + F.col("rows_kept"),
    )


def daily_revenue(ledger: DataFrame) -> DataFrame:
    """Revenue and line count per series and day; days without a sale have no row."""
    return (
        ledger.filter(F.col("kept") > 0)
        .groupBy("series_key", "ds")
        .agg(F.sum("kept_revenue").cast("double").alias("revenue"), F.sum("kept").alias("line_count"))
    )


def net_lines(transactions: DataFrame, slot: str = "HOUR") -> DataFrame:
    """The lines that survive the cleaning, equal lines folded into a count.

    The row-level form of ``day_ledger``. Within a key, lines are spent in
    order of time and invoice number, counted inside time slots. Anonymous lines
    never match, so each invoice of theirs is a key of its own.
    """
    lines = (
        tagged(transactions)
        .filter(F.col("role").isin("cancel", "sale"))
        .groupBy(*KEY, "invoice_ts", "invoice_no")
        .agg(F.count_if(F.col("role") == "sale").alias("sale"), F.count_if(F.col("role") == "cancel").alias("cancel"))
        .withColumn("slot", F.date_trunc(slot, F.col("invoice_ts")))
        .withColumn("alone", F.when(F.col("customer_id").isNull(), F.col("invoice_no")))
    )
    counted = running_totals(lines, [*KEY, "alone"], "slot", ["invoice_ts", "invoice_no"], ["sale", "cancel"])
    spent = F.when(F.col("customer_id").isNull(), 0).otherwise(
        F.least(F.col("sale"), F.greatest(F.col("cancel_total") - F.col("sale_before"), F.lit(0)))
    )
    return (
        counted.withColumn("line_count", F.col("sale") - spent)
        .filter(F.col("line_count") > 0)
        .select("series_key", "invoice_no", "stock_code", "customer_id", "invoice_ts", "unit_price",
                F.col("abs_quantity").alias("quantity"), "line_count",
                (F.col("abs_quantity") * F.col("unit_price")).alias("line_revenue"))
    )


def cancel_counts(transactions: DataFrame) -> DataFrame:
    """Cancellations per match key of known customers."""
    return (
        tagged(transactions)
        .filter((F.col("role") == "cancel") & F.col("customer_id").isNotNull())
        .groupBy(*KEY).agg(F.count("*").alias("cancels"))
    )
