"""Hold-out errors, interval calibration and model choice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

Z95 = 1.96  # fixed value: half-width of the 95 % band in error deviations


def compare(series: DataFrame, forecasts: DataFrame) -> DataFrame:
    """Actual and predicted value of every forecast day that has been observed."""
    actual = series.select("series_key", "step", "ds", F.col("revenue").alias("actual"))
    return forecasts.join(actual, ["series_key", "step"])


def _at_least_zero(bound: Column) -> Column:
    """The bound, no lower than 0; unknown stays NULL."""
    return F.when(bound.isNotNull(), F.greatest(bound, F.lit(0.0)))


def with_sigma(compared: DataFrame) -> DataFrame:
    """Adds the error, its deviation about the mean error, and the 95 % band."""
    group = Window.partitionBy("series_key", "model")
    return (
        compared.withColumn("error", F.col("actual") - F.col("predicted"))
        .withColumn("sigma", F.stddev_samp("error").over(group))
        .withColumns({
            "upper": F.col("predicted") + Z95 * F.col("sigma"),
            "lower": _at_least_zero(F.col("predicted") - Z95 * F.col("sigma")),
        })
    )


def metrics(compared: DataFrame) -> DataFrame:
    """MSE, RMSE, MAE, error deviation and the band's coverage per series and model."""
    return with_sigma(compared).groupBy("series_key", "model").agg(
        F.count("*").alias("days"),
        F.avg(F.col("error") * F.col("error")).alias("mse"),
        F.sqrt(F.avg(F.col("error") * F.col("error"))).alias("rmse"),
        F.avg(F.abs("error")).alias("mae"),
        F.first("sigma").alias("sigma"),
        F.avg(F.col("actual").between(F.col("lower"), F.col("upper")).cast("double")).alias("coverage"),
    )


def best_models(measured: DataFrame) -> DataFrame:
    """The model with the smallest RMSE per series, ties by name; models without one come last."""
    first = F.min_by(F.struct("model", "rmse"), F.struct(F.col("rmse").isNull().alias("none"), "rmse", "model"))
    return measured.groupBy("series_key").agg(first.alias("b")).select("series_key", "b.*")


def error_by_segment(compared: DataFrame, segments: int = 5) -> DataFrame:
    """RMSE and MAE in equal consecutive parts of the hold-out."""
    ordered = Window.partitionBy("series_key", "model").orderBy("step")
    error = F.col("actual") - F.col("predicted")
    return (
        compared.withColumn("segment", F.ntile(segments).over(ordered).cast("bigint"))
        .groupBy("series_key", "model", "segment")
        .agg(F.sqrt(F.avg(error * error)).alias("rmse"), F.avg(F.abs(error)).alias("mae"))
    )


def banded(forecasts: DataFrame, measured: DataFrame) -> DataFrame:
    """Forecasts with the 95 % band that the hold-out error calibrated; no band where there was no hold-out."""
    margin = Z95 * F.col("sigma")
    rounded = forecasts.join(measured.select("series_key", "model", "sigma"), ["series_key", "model"], "left").select(
        *[c for c in forecasts.columns if c != "predicted"],
        F.round("predicted", 2).alias("predicted"),
        F.round(_at_least_zero(F.col("predicted") - margin), 2).alias("lower95"),
        F.round(F.col("predicted") + margin, 2).alias("upper95"),
    )
    return rounded.withColumn("width", F.round(F.col("upper95") - F.col("lower95"), 2))
