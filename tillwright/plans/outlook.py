"""From a daily series to calibrated forecasts of the coming trading days.

The series is cut from its lineage first: it is tiny beside the transaction
log behind it, and every step below reads it again.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from tillwright.operators import calendar, evaluation, forecasting
from tillwright.session import durable

Forecaster = Callable[[DataFrame], DataFrame]


def smoothing_only(series: DataFrame) -> DataFrame:
    return forecasting.smoothing_rows(forecasting.histories(series))


@dataclass(frozen=True)
class HoldOut:
    """The hold-out days of a series with what each model predicted for them."""

    series: DataFrame
    compared: DataFrame

    @property
    def metrics(self) -> DataFrame:
        return evaluation.metrics(self.compared)

    @property
    def best(self) -> DataFrame:
        return evaluation.best_models(self.metrics)

    @property
    def by_segment(self) -> DataFrame:
        return evaluation.error_by_segment(self.compared)


def hold_out(series: DataFrame, forecaster: Forecaster = forecasting.forecast_all,
             share: float = forecasting.TRAIN_SHARE) -> HoldOut:
    """Models fitted on the first part of each series, compared on the rest."""
    series = durable(series)
    predicted = forecaster(forecasting.training_part(series, share))
    return HoldOut(series, durable(evaluation.compare(series, predicted)))


def coming_days(held: HoldOut, forecaster: Forecaster = forecasting.forecast_all,
                horizon: int = forecasting.HORIZON, closure_lookback: int | None = None) -> DataFrame:
    """Models fitted again on whole series: dated forecasts, band, expected closures."""
    ahead = forecaster(forecasting.whole(held.series, horizon)).select(
        "series_key", "model", F.col("ahead").alias("step"), "predicted"
    )
    dates = calendar.upcoming(held.series, horizon, closure_lookback).select(
        "series_key", "step", "ds", "weekday_name", "expected_closure"
    )
    return evaluation.banded(ahead, held.metrics).join(dates, ["series_key", "step"]).select(
        "series_key", "model", "step", "ds", "weekday_name", "predicted", "lower95", "upper95", "width",
        "expected_closure",
    )


def best_forecast(forecast: DataFrame, best: DataFrame) -> DataFrame:
    """The forecast of each series' best model."""
    return forecast.join(best.select("series_key", "model"), ["series_key", "model"], "left_semi")
