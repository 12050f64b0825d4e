"""Unit-root test per series, lag order by AIC, and the verdict on differencing."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window, functions as F

from tillwright.functions.scalars import normal_cdf
from tillwright.functions.unitroot import unit_root_fit
from tillwright.operators.calendar import per_series

# Published response surfaces for the test with a constant.
CRITICAL_5 = [-2.86154, -2.8903, -4.234, -40.04]  # in powers of 1/T
P_SPLIT, P_LOWEST, P_HIGHEST = -1.61, -18.83, 2.74
P_BELOW = [2.1659, 1.4412, 0.038269]
P_ABOVE = [1.7339, 0.93202, -0.12745, -0.010368]


def _polynomial(x: Column, coefficients: list[float]) -> Column:
    out = F.lit(coefficients[-1])
    for c in reversed(coefficients[:-1]):
        out = out * x + c
    return out


def p_value(stat: Column) -> Column:
    """Approximate p-value of the test statistic."""
    inner = F.when(stat <= P_SPLIT, _polynomial(stat, P_BELOW)).otherwise(_polynomial(stat, P_ABOVE))
    return F.when(stat < P_LOWEST, 0.0).when(stat > P_HIGHEST, 1.0).otherwise(normal_cdf(inner))


def differenced(series: DataFrame, value: str = "revenue") -> DataFrame:
    """First differences; each series loses its first row."""
    ordered = per_series().orderBy("step")
    change = F.col(value) - F.lag(value).over(ordered)
    return series.withColumn(value, change).filter(F.col(value).isNotNull())


def adf(series: DataFrame, value: str = "revenue", by: tuple[str, ...] = ("series_key",)) -> DataFrame:
    """Augmented Dickey-Fuller statistic with a constant, per series.

    Lag orders up to 12·(n/100)^¼, a bound that the length of the series alone
    sets, compete by AIC on one common sample; the chosen one is fitted again on
    all rows it allows. Spark sums the products of the regressors over the rows
    (partial sums first), so a series is never in one place; what is left per
    series is a small matrix, and the rows before the common sample. A series
    that is constant or very short has no statistic but keeps its row, and
    missing values are left out.
    """
    keys = Window.partitionBy(*by)
    order = keys.orderBy("step")
    known = F.col(value).cast("double")
    rows = series.select(*by, "step", F.when(known.isNotNull() & ~F.isnan(known) & (F.abs(known) < float("inf")), known).alias("y"))
    rows = rows.withColumns({"n": F.count("y").over(keys), "t": F.count("y").over(order), "middle": F.avg("y").over(keys), "spread": F.stddev_pop("y").over(keys)})
    cap = F.greatest(F.lit(0), F.least(F.ceil(12 * F.pow(F.col("n") / 100, 0.25)), F.floor(F.col("n") / 2) - 2)).cast("int")
    named = rows.select(*by, "t", "n", cap.alias("cap"), F.when(F.col("spread") > 0, (F.col("y") - F.col("middle")) / F.col("spread")).alias("z")).filter("z IS NOT NULL")
    shortest = series.select(*by).distinct()
    longest = rows.agg(F.max(cap)).first()[0] or 0
    order = keys.orderBy("t")
    level = F.lag("z").over(order)
    changed = named.withColumns({"level": level, "change": F.col("z") - level})
    lagged = changed.withColumn("x", F.array(
        F.lit(1.0), "level", "change", *[F.when(F.col("cap") >= k, F.lag("change", k).over(order)) for k in range(1, longest + 1)]))
    vectors = lagged.filter("level IS NOT NULL").select(*by, "t", "n", "cap", F.transform("x", lambda v: F.coalesce(v, F.lit(0.0))).alias("x"))
    products = F.flatten(F.transform("x", lambda v, i: F.transform(F.slice("x", i + 1, longest + 3), lambda w: v * w)))
    common = F.col("t") >= F.col("cap") + 2
    gram = Summarizer.sum(array_to_vector(F.when(common, products).otherwise(F.array_repeat(F.lit(0.0), (longest + 3) * (longest + 4) // 2))))
    sums = vectors.groupBy(*by).agg(
        F.max("n").alias("n"), F.max("cap").alias("cap"), vector_to_array(gram).alias("gram"),
        F.array_sort(F.collect_list(F.when(~common, F.struct("t", "x")))).alias("early"))
    fit = unit_root_fit(F.col("n"), F.col("cap"), F.col("gram"), F.transform("early", lambda e: e["x"]))
    fitted = sums.select(*by, fit.alias("fit"))
    out = shortest.join(fitted, list(by), "left").select(*by, "fit.*")
    return out.withColumns({
        "p_value": p_value(F.col("adf_stat")),
        "critical_5": _polynomial(1 / F.col("n_obs"), CRITICAL_5),
    }).withColumn("stationary", F.col("p_value") < 0.05)


def verdicts(series: DataFrame, value: str = "revenue") -> DataFrame:
    """The test on the series and on its first differences in one pass, with what to do."""
    both = series.select("series_key", "step", value, F.lit("original").alias("input")).unionByName(
        differenced(series, value).select("series_key", "step", value, F.lit("first_difference").alias("input")))
    tested = adf(both, value, ("series_key", "input"))
    advice = (
        F.when(F.col("stationary").isNull(), "undetermined")
        .when(F.col("stationary"), "stationary")
        .when(F.col("input") == "original", "difference_and_test_again")
        .otherwise("higher_difference_needed")
    )
    return tested.withColumn("verdict", advice)
