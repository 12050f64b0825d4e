"""Forecasters for many series: smoothing, ARIMA(1,1,1) and its seasonal form.

Input is a frame (series_key, step, revenue, horizon), where ``step`` counts
trading days from 1. Forecast rows carry ``step``, so that they join with
actual days or coming dates.

A series holds one value per trading day, so collecting one into an array is
bounded by the calendar, not by the number of transactions.

A series too short for a model keeps its rows, with NULL forecasts; ``statuses``
says why.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tillwright.functions.recursions import PERIOD, arima_fit, smoothing_fit
from tillwright.operators.calendar import per_series

TRAIN_SHARE = 0.8
HORIZON = 30
# Observations a model needs.
SMOOTHING_LEAST, ARIMA_LEAST = 2 * PERIOD, 4 * PERIOD


def split(series: DataFrame, share: float = TRAIN_SHARE) -> DataFrame:
    """Adds ``in_train`` (the first ⌊share·n⌋ steps) and ``horizon``, the length of the rest."""
    n = F.count("*").over(per_series())
    cut = F.floor(n * share)
    return series.withColumns({"in_train": F.col("step") <= cut, "horizon": (n - cut).cast("int")})


def training_part(series: DataFrame, share: float = TRAIN_SHARE) -> DataFrame:
    return split(series, share).filter("in_train").drop("in_train")


def whole(series: DataFrame, horizon: int = HORIZON) -> DataFrame:
    return series.withColumn("horizon", F.lit(horizon))


def histories(series: DataFrame) -> DataFrame:
    """One row per series with its values in order, spread over the shuffle partitions.

    The partition count is given, so adaptive execution does not merge the
    small rows into one task before the costly fits.
    """
    width = int(series.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    values = F.array_sort(F.collect_list(F.struct("step", "revenue")))
    return (
        series.repartition(width, "series_key")
        .groupBy("series_key")
        .agg(F.transform(values, lambda e: e["revenue"]).alias("history"),
             F.max("step").alias("origin"), F.max("horizon").alias("horizon"))
    )


# -- exponential smoothing ----------------------------------------------------

def fit_smoothing(past: DataFrame) -> DataFrame:
    """Weights and final states per row of ``histories``."""
    return past.withColumn("fit", smoothing_fit(F.col("history")))


def smoothing_path(horizon: Column) -> Column:
    """The forecasts of steps 1..horizon from a ``fit`` column."""
    fit = F.col("fit")
    return F.transform(
        F.sequence(F.lit(1), horizon),
        lambda h: fit["level"] + h * fit["trend"] + fit["season"][(h - 1) % PERIOD],
    )


def smoothing_rows(past: DataFrame) -> DataFrame:
    return _as_rows(fit_smoothing(past).withColumn("path", smoothing_path(F.col("horizon"))), "holt_winters")


# -- ARIMA --------------------------------------------------------------------

@dataclass(frozen=True)
class Order:
    """ARIMA(1,1,1), with ``seasonal`` times (1,1,1) at lag 6."""

    name: str
    seasonal: bool

    @property
    def carry(self) -> dict[int, int]:
        """How past values enter the next one once differencing is undone."""
        return {1: 1, PERIOD: 1, PERIOD + 1: -1} if self.seasonal else {1: 1}


ARIMA = Order("arima", False)
SARIMA = Order("sarima", True)


def difference(values: Column, lag: int) -> Column:
    """Array of values less the value ``lag`` places before."""
    n = F.greatest(F.size(values) - lag, F.lit(0))
    return F.zip_with(F.slice(values, F.lit(lag + 1), n), F.slice(values, F.lit(1), n), lambda x, y: x - y)


def _newest(values: Column, n: int) -> Column:
    return F.reverse(F.slice(values, -n, n))


def fit_arima(past: DataFrame, order: Order) -> DataFrame:
    """Coefficients per row of ``histories`` and the recent values a forecast needs."""
    kept = PERIOD + 1
    changed = past.withColumn("w", difference(F.col("history"), 1))
    if order.seasonal:
        changed = changed.withColumn("w", difference(F.col("w"), PERIOD))
    changed = changed.withColumn("w", F.when(F.size("history") >= ARIMA_LEAST, F.col("w")))
    return changed.withColumn("fit", arima_fit(F.col("w"), order.seasonal)).withColumns({
        "recent_w": _newest(F.col("w"), kept),
        "recent_y": _newest(F.col("history"), kept),
    })


def arima_path(order: Order) -> Column:
    """The forecasts of steps 1..horizon from a fitted row, future shocks being 0."""
    fit, last = F.col("fit"), PERIOD
    start = F.struct(
        F.col("recent_w").alias("w"), fit["shocks"].alias("e"), F.col("recent_y").alias("y"),
        F.array().cast("array<double>").alias("path"),
    )

    def following(acc: Column, _: Column) -> Column:
        w, e, y = acc["w"], acc["e"], acc["y"]
        change = (
            fit["ar"] * F.get(w, 0) + fit["seasonal_ar"] * (F.get(w, last - 1) - fit["ar"] * F.get(w, last))
            + fit["ma"] * F.get(e, 0) + fit["seasonal_ma"] * (F.get(e, last - 1) + fit["ma"] * F.get(e, last))
        )
        value = reduce(Column.__add__, [F.get(y, lag - 1) * f for lag, f in order.carry.items()], change)

        def pushed(new: Column, old: Column) -> Column:
            return F.concat(F.array(new), F.slice(old, 1, last))

        return F.struct(
            pushed(change, w).alias("w"), pushed(F.lit(0.0), e).alias("e"), pushed(value, y).alias("y"),
            F.concat(acc["path"], F.array(value)).alias("path"),
        )

    return F.aggregate(F.sequence(F.lit(1), F.col("horizon")), start, following, lambda acc: acc["path"])


def arima_rows(past: DataFrame, order: Order) -> DataFrame:
    """Forecast rows; a value that is not a number is NULL. The coefficients' limit keeps the models stationary."""
    path = F.transform(arima_path(order), lambda v: F.when(~F.isnan(v), v))
    return _as_rows(fit_arima(past, order).withColumn("path", path), order.name)


# -- all models ---------------------------------------------------------------

def _as_rows(paths: DataFrame, model: str) -> DataFrame:
    return paths.select(
        "series_key", F.lit(model).alias("model"), "origin", F.posexplode("path").alias("_h", "predicted")
    ).select(
        "series_key", "model", (F.col("_h") + 1).cast("bigint").alias("ahead"),
        (F.col("origin") + F.col("_h") + 1).cast("bigint").alias("step"), "predicted",
    )


def forecast_all(series: DataFrame) -> DataFrame:
    """The forecasts of all three models as one table."""
    past = histories(series)
    return (
        smoothing_rows(past)
        .unionByName(arima_rows(past, ARIMA))
        .unionByName(arima_rows(past, SARIMA))
    )


def parameters(series: DataFrame) -> DataFrame:
    """Fitted parameters of all models in long form."""
    past = histories(series)

    def long_form(fitted: DataFrame, model: str, names: Sequence[str]) -> DataFrame:
        pairs = [x for n in names for x in (F.lit(n), F.col(f"fit.{n}"))]
        return fitted.select("series_key", F.lit(model).alias("model"),
                             F.explode(F.create_map(*pairs)).alias("parameter", "value"))

    own, seasonal = ["ar", "ma"], ["ar", "ma", "seasonal_ar", "seasonal_ma"]
    return (
        long_form(fit_smoothing(past), "holt_winters", ["alpha", "beta", "gamma"])
        .unionByName(long_form(fit_arima(past, ARIMA), ARIMA.name, own))
        .unionByName(long_form(fit_arima(past, SARIMA), SARIMA.name, seasonal))
    )


def statuses(series: DataFrame) -> DataFrame:
    """Per series and model the number of days and ``fitted``, ``too_short`` or ``failed``."""
    past = histories(series.withColumn("horizon", F.lit(1)))

    def judged(fitted: DataFrame, model: str, least: int) -> DataFrame:
        days, sse = F.size("history"), F.col("fit.sse")
        status = (
            F.when(days < least, "too_short").when(sse.isNull() | F.isnan(sse), "failed").otherwise("fitted")
        )
        return fitted.select("series_key", F.lit(model).alias("model"), days.alias("days"), status.alias("status"))

    return (
        judged(fit_smoothing(past), "holt_winters", SMOOTHING_LEAST)
        .unionByName(judged(fit_arima(past, ARIMA), ARIMA.name, ARIMA_LEAST))
        .unionByName(judged(fit_arima(past, SARIMA), SARIMA.name, ARIMA_LEAST))
    )


def rolling_origin(series: DataFrame, share: float = TRAIN_SHARE, ahead: int = PERIOD) -> DataFrame:
    """Smoothing judged ``ahead`` days from every day of the hold-out, its states brought up to date daily.

    Weights come from the training part once; one pass over the hold-out then
    carries level, trend and season from day to day and gives the forecasts
    at each origin, so a day costs the same however long the past is. One row
    per series, origin and step ahead; a series too short for a fit has none.
    """
    marked = split(series, share).withColumn("value", F.struct("step", "revenue"))
    width = int(series.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def values(part: Column) -> Column:
        return F.transform(F.array_sort(F.collect_list(F.when(part, F.col("value")))), lambda e: e["revenue"])

    past = marked.repartition(width, "series_key").groupBy("series_key").agg(
        values(F.col("in_train")).alias("history"), values(~F.col("in_train")).alias("held"))
    fitted = fit_smoothing(past).filter("fit IS NOT NULL AND fit.level IS NOT NULL")
    return fitted.select("series_key", F.size("history").alias("cut"), "held", F.posexplode(_daily_states(ahead)).alias("day", "state")).select(
        "series_key", (F.col("cut") + F.col("day")).cast("bigint").alias("origin"),
        F.posexplode(F.transform(F.sequence(F.lit(1), F.lit(ahead)), lambda h: F.struct(
            F.get("held", F.col("day") + h - 1).alias("actual"),
            (F.col("state.level") + h * F.col("state.trend") + F.get("state.season", (h - 1) % PERIOD)).alias("predicted")))).alias("_h", "p"),
    ).select("series_key", "origin", (F.col("_h") + 1).cast("bigint").alias("ahead"), "p.actual", "p.predicted")


def _daily_states(ahead: int) -> Column:
    """Level, trend and season after 0, 1, ... days of ``held``, as long as ``ahead`` days follow."""
    fit, held = F.col("fit"), F.col("held")

    def state(level: Column, trend: Column, season: Column) -> Column:
        return F.struct(level.alias("level"), trend.alias("trend"), season.alias("season"))

    def next_day(states: Column, value: Column) -> Column:
        now = F.element_at(states, -1)
        expected, old = now["level"] + now["trend"], F.get(now["season"], 0)
        level = fit["alpha"] * (value - old) + (1 - fit["alpha"]) * expected
        trend = fit["beta"] * (level - now["level"]) + (1 - fit["beta"]) * now["trend"]
        season = F.concat(F.slice(now["season"], 2, PERIOD - 1), F.array(fit["gamma"] * (value - expected) + (1 - fit["gamma"]) * old))
        return F.concat(states, F.array(state(level, trend, season)))

    first = F.array(state(fit["level"], fit["trend"], fit["season"]))
    days = F.slice(held, F.lit(1), F.greatest(F.size(held) - ahead, F.lit(0)))
    return F.when(F.size(held) >= ahead, F.aggregate(days, first, next_day))


def rolling_errors(rolled: DataFrame) -> DataFrame:
    """Error by step ahead over all origins."""
    miss = F.col("actual") - F.col("predicted")
    return rolled.groupBy("series_key", "ahead").agg(
        F.count("*").alias("origins"), F.sqrt(F.avg(miss * miss)).alias("rmse"), F.avg(F.abs(miss)).alias("mae")
    )
