"""Operating calendar, stock plan and staffing from a forecast table.

Input is the forecast of one model per series. Windows run over the forecast
horizon of a series (30 days).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tillwright.functions.scalars import WEEKDAYS, percent_of, rate

STOCK_FACTOR = 1.2  # fixed value: stock per unit of predicted revenue on busy days


def _horizon():
    return Window.partitionBy("series_key")


def closures_as_zero(forecast: DataFrame) -> DataFrame:
    """Predictions and band set to 0 on expected closures, which no model can know."""
    def zeroed(name: str) -> Column:
        return F.when(F.col("expected_closure"), 0.0).otherwise(F.col(name))

    return forecast.withColumns({n: zeroed(n) for n in ("predicted", "lower95", "upper95", "width")})


def marked_days(forecast: DataFrame) -> DataFrame:
    """All days with peak, trough and volatility marks; the cuts come from open days only.

    Volatile days are the quarter with the widest band relative to the
    prediction; the band itself is equally wide on all days.
    """
    opened = ~F.col("expected_closure")
    doubt = F.round(rate(F.col("width"), F.col("predicted")), 3)
    days = forecast.withColumn("relative_uncertainty", doubt)

    def cut(name: str, share: float) -> Column:
        return F.percentile(F.when(opened, F.col(name)), share).over(_horizon())

    days = days.withColumns({
        "high_cut": cut("predicted", 0.75), "low_cut": cut("predicted", 0.25),
        "doubt_cut": cut("relative_uncertainty", 0.75),
    })
    return days.withColumns({
        "is_peak": opened & (F.col("predicted") >= F.col("high_cut")),
        "is_trough": opened & (F.col("predicted") <= F.col("low_cut")),
        "is_volatile": opened & F.coalesce(F.col("relative_uncertainty") >= F.col("doubt_cut"), F.lit(False)),
    })


def operating_calendar(forecast: DataFrame) -> DataFrame:
    """Open days only, with cuts and marks."""
    return marked_days(forecast).filter(~F.col("expected_closure"))


def key_days(forecast: DataFrame, n: int = 5, factor: float = STOCK_FACTOR) -> DataFrame:
    """The ``n`` highest and lowest open days per series with their stock quantity."""
    opened = forecast.filter(~F.col("expected_closure"))
    high = F.row_number().over(_horizon().orderBy(F.desc("predicted"), "ds"))
    low = F.row_number().over(_horizon().orderBy("predicted", "ds"))
    ends = F.array_compact(F.array(
        F.when(F.col("_high") <= n, F.struct(F.lit("top").alias("end"), F.col("_high").alias("place"))),
        F.when(F.col("_low") <= n, F.struct(F.lit("bottom").alias("end"), F.col("_low").alias("place"))),
    ))
    return (
        opened.withColumns({"_high": high, "_low": low})
        .select("series_key", "ds", "weekday_name", "predicted", "lower95", "upper95",
                F.round(F.col("predicted") * factor, 2).alias("stock"), F.explode(ends).alias("e"))
        .select("series_key", "e.end", F.col("e.place").cast("bigint").alias("place"), "ds", "weekday_name",
                "predicted", "lower95", "upper95", "stock")
    )


def stock_plan(forecast: DataFrame, factor: float = STOCK_FACTOR) -> DataFrame:
    """Stock per day by one rule: closure, before a closure, peak, volatile, normal.

    The first rule that holds decides. Trough days carry the order to keep no
    more than two days of cover.
    """
    days = marked_days(forecast)
    before = F.lead("expected_closure").over(_horizon().orderBy("ds"))
    rule = (
        F.when(F.col("expected_closure"), "closure")
        .when(F.coalesce(before, F.lit(False)), "before_closure")
        .when(F.col("is_peak"), "peak")
        .when(F.col("is_volatile"), "volatile")
        .otherwise("normal")
    )
    raised, kind = F.col("predicted") * factor, F.col("rule")
    stock = (
        F.when(kind == "closure", 0.0).when(kind.isin("before_closure", "peak"), raised)
        .when(kind == "volatile", F.col("lower95")).otherwise(F.col("predicted"))
    )
    return days.withColumn("rule", rule).select(
        "series_key", "ds", "weekday_name", "predicted", "rule",
        F.round(stock, 2).alias("stock"),
        F.when(F.col("is_trough"), "two_days_of_cover").otherwise("").alias("cover"),
    )


def plan_totals(forecast: DataFrame, factor: float = STOCK_FACTOR) -> DataFrame:
    """Totals of the operating calendar and which weekdays are volatile."""
    volatile = F.when(F.col("is_volatile"), F.col("weekday_name"))
    return operating_calendar(forecast).groupBy("series_key").agg(
        F.count("*").alias("open_days"),
        F.round(F.sum("predicted"), 2).alias("total_predicted"),
        F.round(F.avg("predicted"), 2).alias("mean_predicted"),
        F.round(F.first("high_cut"), 2).alias("high_cut"),
        F.round(F.first("low_cut"), 2).alias("low_cut"),
        F.round(F.first("doubt_cut"), 3).alias("doubt_cut"),
        F.count_if("is_peak").alias("peak_days"),
        F.count_if("is_trough").alias("trough_days"),
        F.count_if("is_volatile").alias("volatile_days"),
        F.round(F.sum(F.when(F.col("is_peak"), F.col("predicted"))) * factor, 2).alias("peak_stock"),
        F.array_join(F.sort_array(F.collect_set(volatile)), ",").alias("volatile_weekdays"),
        F.coalesce(F.min(volatile) == F.max(volatile), F.lit(False)).alias("one_volatile_weekday"),
    )


def staffing(pattern: DataFrame) -> DataFrame:
    """Two peak weekdays, the low weekday, peak and low month, per series.

    ``pattern`` is ``anomalies.weekday_month_pattern``.
    """
    kinds = Window.partitionBy("series_key", "pattern")
    highest = F.row_number().over(kinds.orderBy(F.desc("mean_revenue"), "slot"))
    lowest = F.row_number().over(kinds.orderBy("mean_revenue", "slot"))
    weekly, monthly = F.col("pattern") == "weekday", F.col("pattern") == "month"
    role = (
        F.when(weekly & (F.col("_high") <= 2), F.concat(F.lit("peak_weekday_"), F.col("_high")))
        .when(weekly & (F.col("_low") == 1), "low_weekday")
        .when(monthly & (F.col("_high") == 1), "peak_month")
        .when(monthly & (F.col("_low") == 1), "low_month")
    )
    names = F.array(*[F.lit(d) for d in WEEKDAYS])
    label = F.when(weekly, F.element_at(names, F.col("slot") % 7 + 1)).otherwise(F.col("slot").cast("string"))
    return (
        pattern.withColumns({"_high": highest, "_low": lowest})
        .withColumn("role", role).filter(F.col("role").isNotNull())
        .select("series_key", "role", label.alias("label"), "mean_revenue",
                percent_of(F.col("mean_revenue"), F.col("weekday_base")).alias("percent_of_base"))
    )


def staffing_uplift(staff: DataFrame) -> DataFrame:
    """How far the two peak weekdays lie above the Mon-Fri mean, and peak over low month."""
    def of(role: str, column: str) -> Column:
        return F.max(F.when(F.col("role") == role, F.col(column)))

    peaks = (of("peak_weekday_1", "percent_of_base") + of("peak_weekday_2", "percent_of_base")) / 2
    return staff.groupBy("series_key").agg(
        (peaks - 100).alias("peak_uplift_percent"),
        rate(of("peak_month", "mean_revenue"), of("low_month", "mean_revenue")).alias("month_ratio"),
    )
