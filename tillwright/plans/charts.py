"""The aggregate behind each figure; drawing is left to the caller."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tillwright.functions.scalars import WEEKDAYS
from tillwright.operators import anomalies, kpi
from tillwright.operators.calendar import in_order, per_series


def store_bars(store_facts: DataFrame) -> DataFrame:
    return kpi.by_descending(kpi.revenue_by_store(store_facts), "total_revenue", "store_location")


def top_product_bars(product_facts: DataFrame, n: int = 5) -> DataFrame:
    return kpi.top(kpi.units_by_product(product_facts), n, "total_units", "product_name", "category")


def margin_bars(product_facts: DataFrame) -> DataFrame:
    margins = kpi.product_margins(product_facts, zero_fill=True)
    return kpi.by_descending(margins, "gross_margin_rate", "product_name", "category").select(
        "product_name", "category", "gross_margin_rate"
    )


def combo_bars(combo_facts: DataFrame, n: int = 8) -> DataFrame:
    pairs = kpi.store_products(combo_facts)
    return kpi.top(pairs, n, "total_revenue", "store_location", "product_name").select(
        F.concat_ws(" - ", "store_location", "product_name").alias("label"), "total_revenue"
    )


def daily_line(series: DataFrame) -> DataFrame:
    return series.select("series_key", "ds", "revenue", (F.col("revenue") == 0).alias("closed"))


def decomposition_lines(decomposed: DataFrame) -> DataFrame:
    return decomposed.select("series_key", "ds", "revenue", "trend", "season_short", "season_long", "resid")


def anomaly_marks(decomposed: DataFrame) -> DataFrame:
    """The whole series with the anomaly kinds of each day (often none)."""
    marked = anomalies.anomaly_kinds(anomalies.residual_fences(decomposed))
    return marked.select("series_key", "ds", "revenue", "kinds", "level_fence")


def differenced(series: DataFrame) -> DataFrame:
    """Original and first difference; the first day has none and is left out."""
    step = F.col("revenue") - F.lag("revenue").over(in_order())
    return series.select("series_key", "ds", "revenue", step.alias("diff")).filter(F.col("diff").isNotNull())


def pattern_bars(pattern: DataFrame) -> DataFrame:
    weekday = F.element_at(F.array(*[F.lit(w) for w in WEEKDAYS]), F.col("slot") % 7 + 1)
    label = F.when(F.col("pattern") == "weekday", weekday).otherwise(F.lpad(F.col("slot").cast("string"), 2, "0"))
    return pattern.select("series_key", "pattern", label.alias("label"), "mean_revenue")


def hold_out_lines(compared: DataFrame) -> DataFrame:
    """Actual values and each model's predictions over the hold-out."""
    return compared.select("series_key", "model", "ds", "actual", "predicted")


def forecast_lines(series: DataFrame, forecast: DataFrame, history: int = 60) -> DataFrame:
    """The last ``history`` trading days and the forecasts with bands and closures."""
    newest = F.row_number().over(per_series().orderBy(F.desc("ds")))
    past = series.withColumn("_r", newest).filter(F.col("_r") <= history).select(
        "series_key", F.lit("history").alias("line"), "ds", F.col("revenue").alias("value"),
        F.lit(None).cast("double").alias("lower95"), F.lit(None).cast("double").alias("upper95"),
        F.lit(False).alias("expected_closure"),
    )
    return past.unionByName(forecast.select(
        "series_key", F.col("model").alias("line"), "ds", F.col("predicted").alias("value"),
        "lower95", "upper95", "expected_closure",
    ))
