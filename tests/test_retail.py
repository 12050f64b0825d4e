from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.conftest import PRODUCTS, SALES, STORES, star
from tillwright.operators import facts, kpi
from tillwright.plans import charts, mart
from tillwright.sources import schemas, sinks


def product_facts(tables):
    products, sales, _ = tables
    return facts.product_facts(sales, products)


def store_facts(tables):
    _, sales, stores = tables
    return facts.store_facts(sales, stores)


def combo_facts(tables):
    products, sales, stores = tables
    return facts.combo_facts(sales, products, stores)


def by(df, key, *values):
    return {r[key]: tuple(float(r[v]) if r[v] is not None else None for v in values) for r in df.collect()}


def test_category_totals(spark):
    rows = [(1, 101, "Electronics", 500), (2, 102, "Apparel", 100), (3, 101, "Electronics", 300),
            (4, 103, "Apparel", 150), (5, 104, "Electronics", 800)]
    orders = spark.createDataFrame(rows, "order_id long, customer_id long, category string, amount long")
    totals = by(kpi.category_totals(orders), "category", "total_sales", "avg_order_amount")
    assert totals == {"Apparel": (250, 125), "Electronics": (1600, pytest.approx(533.3333333))}
    assert set(by(kpi.category_totals(orders, over=700), "category", "total_sales")) == {"Electronics"}


def test_units_margins_and_stores(retail):
    assert by(kpi.units_by_product(product_facts(retail)), "product_name", "total_units") == {
        "Wireless Headphones": (6,), "Laptop Charger": (5,), "Bluetooth Speaker": (5,), "Desk Lamp": (2,), "Office Chair": (2,)}
    assert by(kpi.product_margins(product_facts(retail)), "product_name", "gross_margin_rate") == {
        "Bluetooth Speaker": (0.5999,), "Desk Lamp": (0.5833,), "Laptop Charger": (0.5713,), "Office Chair": (0.5384,),
        "Wireless Headphones": (0.4999,)}
    expected = {"Chicago": (534.91, 9, 0.2972), "New York": (459.94, 6, 0.1840), "Los Angeles": (349.95, 5, 0.1094)}
    for one in (False, True):
        kpis = kpi.store_kpis(store_facts(retail), one_rent_per_location=one)
        assert by(kpis, "store_location", "total_revenue", "total_units", "roi") == expected


def test_best_stores_slow_movers_and_combos(retail):
    assert kpi.top(kpi.revenue_by_store(store_facts(retail)), 1, "total_revenue", "store_location").first().store_location == "Chicago"
    slow = kpi.slow_movers(product_facts(retail)).collect()
    assert [(r.product_name, r.total_units, float(r.total_cost), r.risk_flag) for r in slow] == [("Office Chair", 2, 120.0, "high")]
    strict = kpi.slow_movers(product_facts(retail), 5, 0.0, strict=True)
    assert {r.product_name for r in strict.collect()} == {"Office Chair", "Desk Lamp"}
    ends = kpi.extremes(kpi.store_products(combo_facts(retail)), ["store_location", "product_name"], "total_revenue", "best", "worst")
    assert {r.rank_type: (r.store_location, r.product_name, float(r.total_revenue)) for r in ends.collect()} == {
        "best": ("Chicago", "Wireless Headphones", 359.96), "worst": ("Los Angeles", "Bluetooth Speaker", 99.98)}


def test_totals_before_the_join_equal_the_detail(retail):
    products, sales, stores = retail
    detail = facts.sales_detail(sales, products, stores)
    direct = detail.groupBy("store_location", "product_name").agg(
        F.sum("quantity").alias("total_units"), F.sum("total_amount").alias("total_revenue"), F.sum("gross_profit").alias("gross_profit"))
    ours = kpi.store_products(combo_facts(retail))
    assert sorted(map(tuple, direct.collect())) == sorted(map(tuple, ours.collect()))


def test_ties_go_to_the_smaller_name(retail):
    units = kpi.units_by_product(product_facts(retail), with_category=False)
    ends = {r.rank_type: r.product_name for r in kpi.extremes(units, ["product_name"], "total_units", "high", "low").collect()}
    assert ends == {"high": "Wireless Headphones", "low": "Desk Lamp"}


def test_single_row_keeps_the_first_label(spark):
    tables = star(spark, products=PRODUCTS[:1], sales=SALES[:1])
    ends = kpi.extremes(kpi.units_by_product(product_facts(tables)), ["product_name", "category"], "total_units", "high", "low")
    assert [r.rank_type for r in ends.collect()] == ["high"]
    empty = kpi.units_by_product(product_facts(tables)).filter("total_units < 0")
    assert kpi.extremes(empty, ["product_name", "category"], "total_units", "high", "low").count() == 0


def test_unmatched_sales_form_a_null_group(spark):
    tables = star(spark, sales=[*SALES, (509, 999, 201, "2025/10/10", 7, "70.00"), (510, 101, 999, "2025/10/2", 1, "89.99")])
    units = by(kpi.units_by_product(product_facts(tables), with_category=False), "product_name", "total_units")
    assert units[None] == (7,)
    assert None in by(kpi.revenue_by_store(store_facts(tables)), "store_location", "total_revenue")
    dropped = kpi.drop_null_keys(kpi.units_by_product(product_facts(tables)), "product_name")
    assert dropped.count() == 5
    margins = by(kpi.product_margins(product_facts(tables)), "product_name", "gross_profit")
    assert margins[None] == (None,)
    inner = facts.sales_detail(tables[1], tables[0], tables[2], "inner")
    assert inner.count() == 8
    detail = facts.sales_detail(tables[1], tables[0], tables[2]).orderBy("sale_date", "sale_id")
    assert detail.collect()[-1].sale_id == 509  # sorted as dates, not as text


def test_zero_revenue_and_zero_rent(spark):
    tables = star(spark, sales=[(1, 101, 201, "2025/10/1", 1, "0.00"), (2, 102, 202, "2025/10/1", 1, "50.00")],
                  stores=[(201, "A", "0.00"), (202, "B", "100.00")])
    assert by(kpi.product_margins(product_facts(tables)), "product_name", "gross_margin_rate")["Wireless Headphones"] == (None,)
    filled = kpi.product_margins(product_facts(tables), zero_fill=True)
    assert by(filled, "product_name", "gross_margin_rate")["Wireless Headphones"] == (0.0,)
    assert by(kpi.store_kpis(store_facts(tables)), "store_location", "roi") == {"A": (None,), "B": (0.5,)}
    assert by(kpi.store_kpis(store_facts(tables), one_rent_per_location=True), "store_location", "roi")["A"] == (0.0,)
    ends = kpi.extremes(kpi.product_margins(product_facts(tables)), ["product_name"], "gross_margin_rate", "high", "low")
    assert {r.rank_type: r.product_name for r in ends.collect()} == {"high": "Bluetooth Speaker", "low": "Wireless Headphones"}
    detail = facts.sales_detail(tables[1], tables[0], tables[2])
    assert detail.filter("sale_id = 1").first().gross_margin_rate is None


def test_stores_that_share_a_location(spark):
    tables = star(spark, stores=[(201, "X", "100.00"), (202, "X", "300.00"), (203, "Chicago", "1800.00")])
    assert kpi.store_kpis(store_facts(tables)).count() == 3
    one = by(kpi.store_kpis(store_facts(tables), one_rent_per_location=True), "store_location", "monthly_rent", "total_units")
    assert one["X"] == (300.0, 11)


def test_recommendations_and_figures(retail):
    rows = {(r.topic, r.subject): r.value for r in mart.recommendations(combo_facts(retail), product_facts(retail)).collect()}
    assert rows == {
        ("best_store", "Chicago"): 534.91, ("slow_mover", "Office Chair"): 2.0,
        ("highest_margin", "Bluetooth Speaker"): 0.5999, ("lowest_margin", "Wireless Headphones"): 0.4999,
        ("best_combo", "Chicago - Wireless Headphones"): 359.96, ("worst_combo", "Los Angeles - Bluetooth Speaker"): 99.98}
    assert [r.store_location for r in charts.store_bars(store_facts(retail)).collect()] == ["Chicago", "New York", "Los Angeles"]
    assert charts.combo_bars(combo_facts(retail)).first().label == "Chicago - Wireless Headphones"
    assert charts.top_product_bars(product_facts(retail)).first().total_units == 6
    assert charts.margin_bars(product_facts(retail)).first().product_name == "Bluetooth Speaker"


def test_maps_and_records(retail):
    units = kpi.units_by_product(product_facts(retail), with_category=False)
    shards = sinks.as_maps(units, "product_name", "total_units", digits=1).collect()
    merged = {k: v for s in shards for k, v in s.entries.items()}
    assert merged == {"Wireless Headphones": 6, "Laptop Charger": 5, "Bluetooth Speaker": 5, "Desk Lamp": 2, "Office Chair": 2}
    assert '{"product_name":"Desk Lamp","total_units":2}' in [
        r.record for r in sinks.as_records(units.select("product_name", "total_units")).collect()]


def test_money_stays_exact(spark):
    many = [(i, 101, 201, "2025/10/1", 1, "0.10") for i in range(1000)]
    total = kpi.revenue_by_store(store_facts(star(spark, sales=many))).first().total_revenue
    assert total == Decimal("100.00")
    assert schemas.SALES["total_amount"].dataType.scale == 2
