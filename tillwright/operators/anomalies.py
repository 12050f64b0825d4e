"""Outlier days and seasonal patterns of daily series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tillwright.functions.scalars import percent_of, weekday_label
from tillwright.operators.calendar import per_series

FENCE = 1.5  # interquartile ranges beyond the quartiles


def quartiles(value: Column) -> Column:
    """Exact quartiles with linear interpolation, NULLs left out."""
    return F.percentile(value, [0.25, 0.75])


def sketched_quartiles(value: Column, accuracy: int = 10_000) -> Column:
    """Quartiles from a mergeable sketch: values whose rank is off by at most 1 / ``accuracy`` of the group.

    For groups whose values don't fit one buffer: ``quartiles`` holds every different value of a group, the sketch
    about ``accuracy`` of them, and tasks send sketches instead of values. Its quartiles are values of the group,
    not interpolated ones.
    """
    return F.percentile_approx(value, [0.25, 0.75], accuracy)


def upper_fence(q: Column) -> Column:
    return q[1] + FENCE * (q[1] - q[0])


def lower_fence(q: Column) -> Column:
    return q[0] - FENCE * (q[1] - q[0])


def summary(series: DataFrame, accuracy: int | None = None) -> DataFrame:
    """Length, mean, sample deviation, maximum and level fence per series; with ``accuracy``, the fence from sketched quartiles."""
    opened = F.when(F.col("revenue") > 0, F.col("revenue"))
    q = sketched_quartiles(opened, accuracy) if accuracy else quartiles(opened)
    return series.groupBy("series_key").agg(
        F.count("*").alias("days"),
        F.avg("revenue").alias("mean_revenue"),
        F.stddev_samp("revenue").alias("sd_revenue"),
        F.max("revenue").alias("max_revenue"),
        upper_fence(q).alias("level_fence"),
    )


def level_outliers(series: DataFrame) -> DataFrame:
    """Days above the level fence (``peak``) and closed days (``closure``).

    The fence comes from days with revenue only.
    """
    q = quartiles(F.when(F.col("revenue") > 0, F.col("revenue"))).over(per_series())
    marked = series.withColumn("level_fence", upper_fence(q))
    kind = F.when(F.col("revenue") > F.col("level_fence"), "peak").when(F.col("revenue") == 0, "closure")
    return marked.withColumn("kind", kind).filter(F.col("kind").isNotNull()).select(
        "series_key", "ds", weekday_label(F.col("ds")).alias("weekday_name"), "revenue", "level_fence", "kind"
    )


def residual_fences(decomposed: DataFrame) -> DataFrame:
    """Adds both residual fences (from all days) and the level fence (from open days)."""
    q = quartiles(F.col("resid")).over(per_series())
    level = quartiles(F.when(F.col("revenue") > 0, F.col("revenue"))).over(per_series())
    return decomposed.withColumns({
        "resid_upper": upper_fence(q), "resid_lower": lower_fence(q), "level_fence": upper_fence(level),
    })


def anomaly_kinds(fenced: DataFrame) -> DataFrame:
    """Adds the array ``kinds``; a day may be of several kinds.

    A closed day's residual is extreme by nature, so only open days can be
    seasonal outliers.
    """
    opened = F.col("revenue") > 0
    kinds = F.array_compact(F.array(
        F.when(F.col("revenue") > F.col("level_fence"), F.lit("peak")),
        F.when(opened & (F.col("resid") > F.col("resid_upper")), F.lit("seasonal_high")),
        F.when(opened & (F.col("resid") < F.col("resid_lower")), F.lit("seasonal_low")),
        F.when(F.col("revenue") == 0, F.lit("closure")),
    ))
    return fenced.withColumn("kinds", kinds)


def anomalies(decomposed: DataFrame) -> DataFrame:
    """One row per anomalous day and kind, in one pass over the series."""
    return anomaly_kinds(residual_fences(decomposed)).select(
        "series_key", "ds", weekday_label(F.col("ds")).alias("weekday_name"),
        F.round("revenue", 2).alias("revenue"),
        F.round(F.abs("resid"), 2).alias("off_expectation"),
        F.explode("kinds").alias("kind"),
    )


def weekday_month_pattern(series: DataFrame) -> DataFrame:
    """Mean revenue of open days by weekday and by month, as % of the Mon-Fri mean."""
    base = F.avg(F.when(F.weekday("ds") < 5, F.col("revenue"))).over(per_series())
    slots = F.explode(F.array(
        F.struct(F.lit("weekday").alias("pattern"), F.weekday("ds").alias("slot")),
        F.struct(F.lit("month").alias("pattern"), F.month("ds").alias("slot")),
    ))
    return (
        series.filter(F.col("revenue") > 0)
        .select("series_key", "revenue", base.alias("base"), slots.alias("s"))
        .groupBy("series_key", "s.pattern", "s.slot")
        .agg(F.avg("revenue").alias("mean_revenue"), F.first("base").alias("weekday_base"))
        .withColumn("percent_of_base", percent_of(F.col("mean_revenue"), F.col("weekday_base")))
    )
