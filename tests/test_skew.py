"""Hot keys without adaptive execution, and the rank bound of sketched quartiles."""

import pytest
from pyspark.sql import functions as F

from tillwright.operators import anomalies, facts, skew


@pytest.fixture()
def plain_plans(spark):
    """No adaptive execution, no broadcast joins, 16 partitions."""
    wanted = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16"}
    kept = {k: spark.conf.get(k) for k in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    yield
    for key, value in kept.items():
        spark.conf.set(key, value)


def skewed(spark, rows=60_000):
    """A third of the sales of product 1, a third without a store, the rest even."""
    i = F.col("id")
    sales = spark.range(rows).select(
        i.alias("sale_id"), F.when(i % 3 == 0, 1).otherwise(i % 5_000).cast("long").alias("product_id"),
        F.when(i % 3 != 1, i % 4_000).cast("long").alias("store_id"), F.lit(2).alias("quantity"), F.lit(3).cast("decimal(14,2)").alias("total_amount"))
    products = spark.range(4_900).select(i.alias("product_id"), F.concat(F.lit("p"), i.cast("string")).alias("product_name"), F.lit(1).cast("decimal(12,2)").alias("cost_price"))
    stores = spark.range(4_000).select(i.alias("store_id"), F.concat(F.lit("s"), i.cast("string")).alias("store_location"))
    return sales, products, stores


def tasks(df):
    return sorted(r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect())


def test_no_task_of_a_spread_join_has_twice_the_median(spark, plain_plans):
    sales, products, stores = skewed(spark)
    plain = tasks(sales.join(products, "product_id", "left"))
    assert plain[-1] > 3 * plain[len(plain) // 2]
    first = tasks(skew.spread_join(sales, products, "product_id", spread=64))
    assert first[-1] < 2 * first[len(first) // 2]
    both = tasks(facts.sales_detail(sales, products, stores, spread=64))
    assert both[-1] < 2 * both[len(both) // 2]


@pytest.mark.parametrize("how", ["left", "inner"])
def test_a_spread_join_has_the_rows_of_the_plain_one(spark, plain_plans, how):
    sales, products, stores = skewed(spark, 9_000)
    sales = sales.union(sales.limit(50)).union(sales.filter("sale_id = 1").withColumn("product_id", F.lit(None).cast("long")))
    products = products.union(products.filter("product_id < 3"))  # repeated on the right as well
    assert skew.hot_keys(sales, "product_id", 0.01) == [1]
    spread, plain = (facts.sales_detail(sales, products, stores, how, n) for n in (8, 1))
    assert spread.columns == plain.columns
    assert spread.exceptAll(plain).count() == plain.exceptAll(spread).count() == 0


def test_a_spread_join_without_hot_keys_or_rows(spark):
    sales, products, _ = skewed(spark, 300)
    even = sales.withColumn("product_id", F.col("sale_id"))
    assert skew.hot_keys(even, "product_id", 0.01) == []
    assert skew.spread_join(even, products, "product_id").count() == 300
    assert skew.spread_join(even.limit(0), products, "product_id").count() == 0
    with pytest.raises(ValueError):
        skew.spread_join(even, products, "product_id", "full")


@pytest.mark.parametrize("accuracy", [20, 200, 2_000])
def test_sketched_quartiles_keep_their_rank_bound(spark, accuracy):
    n = 40_000
    rows = spark.range(n, numPartitions=16).select(F.lit("a").alias("series_key"), F.pmod(F.xxhash64("id"), F.lit(1_000_003)).cast("double").alias("revenue"))
    got = rows.agg(anomalies.sketched_quartiles(F.col("revenue"), accuracy).alias("q")).first().q
    values = sorted(r.revenue for r in rows.collect())
    for value, share in zip(got, (0.25, 0.75)):
        assert value in values
        assert sum(v < value for v in values) <= n * share + n / accuracy and sum(v <= value for v in values) >= n * share - n / accuracy


def test_summary_by_sketch_is_near_the_exact_one(spark):
    rows = spark.range(5_000).select(F.lit("a").alias("series_key"), (F.pmod(F.xxhash64("id"), F.lit(1_000)) + 1).cast("double").alias("revenue"))
    exact, sketch = (anomalies.summary(rows, accuracy).first() for accuracy in (None, 10_000))
    assert abs(sketch.level_fence - exact.level_fence) <= 0.01 * exact.level_fence
    assert (sketch.days, sketch.max_revenue) == (exact.days, exact.max_revenue)
