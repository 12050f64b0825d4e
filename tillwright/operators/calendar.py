"""Calendar repair and trading days, for many series at once.

All windows run over (series) on one row per day, so a group is as long as the
calendar. They share one shuffle on the series key.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from tillwright.functions.scalars import weekday_label


def per_series() -> WindowSpec:
    return Window.partitionBy("series_key")


def in_order() -> WindowSpec:
    return per_series().orderBy("ds")


# Month-days that are closed by the calendar (Christmas Day, New Year's Day).
FIXED_CLOSURES = ["12-25", "01-01"]


def spine(daily: DataFrame) -> DataFrame:
    """Every day from a series' first to its last; revenue NULL where none was recorded.

    Each recorded day also emits the gap up to the next one: no calendar
    table, no join.
    """
    following = F.lead("ds").over(in_order())
    filled = daily.withColumn("_until", F.coalesce(F.date_sub(following, 1), F.col("ds"))).withColumn(
        "_day", F.explode(F.sequence("ds", "_until"))
    )
    recorded = F.col("_day") == F.col("ds")
    return filled.select(
        "series_key",
        F.col("_day").alias("ds"),
        F.when(recorded, F.col("revenue")).alias("revenue"),
        F.when(recorded, F.col("line_count")).otherwise(0).alias("line_count"),
        recorded.alias("recorded"),
    )


def classified(days: DataFrame) -> DataFrame:
    """Marks each day ``trading``, ``structural`` or ``closure``.

    A missing day is structural when its weekday was never recorded in the
    series, and a closure otherwise.
    """
    by_weekday = Window.partitionBy("series_key", "weekday")
    known = F.max("recorded").over(by_weekday)
    return days.withColumn("weekday", F.weekday("ds")).withColumn(
        "day_kind", F.when(F.col("recorded"), "trading").when(known, "closure").otherwise("structural")
    )


def trading_series(days: DataFrame) -> DataFrame:
    """``classified`` days without structural ones, closures as 0, numbered from 1."""
    return (
        days.filter(F.col("day_kind") != "structural")
        .select("series_key", "ds", F.coalesce("revenue", F.lit(0.0)).alias("revenue"))
        .withColumn("step", F.row_number().over(in_order()).cast("bigint"))
    )


def weekday_profile(days: DataFrame) -> DataFrame:
    """Calendar days, recorded days and raw lines per series and weekday."""
    return days.groupBy("series_key", "weekday").agg(
        F.min(weekday_label(F.col("ds"))).alias("weekday_name"),
        F.count("*").alias("calendar_days"),
        F.count_if("recorded").alias("recorded_days"),
        F.sum("line_count").alias("line_count"),
    )


def span(days: DataFrame) -> DataFrame:
    """First, last and number of calendar days, and how many of each kind."""
    return days.groupBy("series_key").agg(
        F.min("ds").alias("first_day"),
        F.max("ds").alias("last_day"),
        (F.datediff(F.max("ds"), F.min("ds")) + 1).alias("calendar_days"),
        F.count_if("recorded").alias("recorded_days"),
        F.count_if(F.col("day_kind") == "structural").alias("structural_days"),
        F.count_if(F.col("day_kind") == "closure").alias("closure_days"),
    )


def month_day(day: Column) -> Column:
    return F.date_format(day, "MM-dd")


def upcoming(series: DataFrame, horizon: int = 30, closure_lookback: int | None = None,
             fixed: Iterable[str] = FIXED_CLOSURES) -> DataFrame:
    """The next ``horizon`` trading days of each series and their expected closures.

    Trading weekdays are those the series has. A day is expected closed
    (``observed``) when its month-day was closed within the last
    ``closure_lookback`` days (all of the past if None), or else (``calendar``)
    when it is in ``fixed``. A series' past is reduced to a set of at most 366
    month-days, so nothing is joined.
    """
    closed = F.col("revenue") == 0
    if closure_lookback is not None:
        closed = closed & (F.col("ds") > F.date_sub(F.max("ds").over(per_series()), closure_lookback))
    facts = series.withColumn("_closed", closed).groupBy("series_key").agg(
        F.max("ds").alias("last_day"),
        F.collect_set(F.weekday("ds")).alias("open_weekdays"),
        F.collect_set(F.when(F.col("_closed"), month_day(F.col("ds")))).alias("closed_month_days"),
    )
    weeks = F.ceil(F.lit(horizon) / F.size("open_weekdays")).cast("int") + 1
    candidates = F.sequence(F.date_add("last_day", 1), F.date_add(F.col("last_day"), weeks * 7))
    trading = F.filter(candidates, lambda day: F.array_contains(F.col("open_weekdays"), F.weekday(day)))
    days = facts.select(
        "series_key", "last_day", "closed_month_days",
        F.posexplode(F.slice(trading, 1, horizon)).alias("_pos", "ds"),
    )
    observed = F.array_contains("closed_month_days", month_day(F.col("ds")))
    source = F.when(observed, "observed").when(month_day(F.col("ds")).isin(*fixed), "calendar")
    return days.select(
        "series_key", (F.col("_pos") + 1).cast("bigint").alias("step"), "ds",
        weekday_label(F.col("ds")).alias("weekday_name"),
        F.datediff("ds", "last_day").alias("days_ahead"),
        source.alias("closure_source"),
        source.isNotNull().alias("expected_closure"),
    )
