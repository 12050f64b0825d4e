"""Additive decomposition with two seasons: trend, short, long, residual.

Rounds of centred moving means and phase means, each component taken from the
series less the other components. All windows lie inside one series.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tillwright.operators.calendar import per_series

SHORT, LONG = 6, 26  # trading days per week and per month


def centred_mean(value: Column, period: int) -> Column:
    """Mean of the two windows of ``period`` rows around a row; what there is at the ends."""
    ordered, half = per_series().orderBy("step"), period // 2
    return (
        F.avg(value).over(ordered.rowsBetween(-half, half - 1))
        + F.avg(value).over(ordered.rowsBetween(1 - half, half))
    ) / 2


def _phase_mean(df: DataFrame, value: Column, period: int, name: str) -> DataFrame:
    phase = Window.partitionBy("series_key", (F.col("step") - 1) % period)
    means = df.withColumn("_detrended", value)
    return means.withColumn(
        name, F.avg("_detrended").over(phase) - F.avg("_detrended").over(per_series())
    ).drop("_detrended")


def decompose(series: DataFrame, short: int = SHORT, long: int = LONG, rounds: int = 2) -> DataFrame:
    """Adds ``trend``, ``season_short``, ``season_long`` and ``resid``; they add up to revenue."""
    y = F.col("revenue")
    out = series.withColumns({"season_short": F.lit(0.0), "season_long": F.lit(0.0)})
    for _ in range(rounds):
        out = out.withColumn("trend", centred_mean(y - F.col("season_short") - F.col("season_long"), long))
        out = _phase_mean(out, y - F.col("trend") - F.col("season_long"), short, "season_short")
        out = _phase_mean(out, y - F.col("trend") - F.col("season_short"), long, "season_long")
    return out.withColumn("resid", y - F.col("trend") - F.col("season_short") - F.col("season_long"))


def amplitudes(decomposed: DataFrame) -> DataFrame:
    """Highest minus lowest value of each season per series."""
    return decomposed.groupBy("series_key").agg(
        (F.max("season_short") - F.min("season_short")).alias("short_amplitude"),
        (F.max("season_long") - F.min("season_long")).alias("long_amplitude"),
    )
