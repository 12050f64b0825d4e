import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.conftest import PRODUCTS, SALES, STORES, star
from tillwright.operators import facts
from tillwright.sources import files, schemas, sinks

HEADS = {"products": "product_id,product_name,category,cost_price,retail_price", "stores": "store_id,store_location,monthly_rent",
         "sales": "sale_id,product_id,store_id,sale_date,quantity,total_amount"}


def write_star(folder, newline="\n", last=True, bom=""):
    for name, rows in (("products", PRODUCTS), ("stores", STORES), ("sales", SALES)):
        text = newline.join([HEADS[name], *(",".join(map(str, r)) for r in rows)]) + (newline if last else "")
        (folder / f"{name}.csv").write_bytes((bom + text).encode("utf-8"))


@pytest.mark.parametrize("newline,last,bom", [("\r\n", True, ""), ("\n", False, ""), ("\r\n", False, "﻿"), ("\n", True, "﻿")])
def test_star_from_csv_variants(spark, tmp_path, newline, last, bom):
    write_star(tmp_path, newline, last, bom)
    products, sales, stores = files.load_star(spark, str(tmp_path))
    assert (products.count(), sales.count(), stores.count()) == (5, 8, 3)
    first = sales.orderBy("sale_id").first()
    assert first.sale_date == dt.date(2025, 10, 1) and float(first.total_amount) == 179.98 and first.quantity == 2
    assert sales.schema == schemas.SALES and float(products.agg(F.sum("cost_price")).first()[0]) == 165.0


def test_rejects_are_counted_and_rows_kept(spark, tmp_path):
    (tmp_path / "sales.csv").write_text(HEADS["sales"] + "\n1,101,201,2025/10/1,two,1.00\n2,101,x,2025/13/1,3,\n3,1,1,2025/1/2,1,9.99\n")
    text = files.text_scan(spark, str(tmp_path / "sales.csv"), schemas.SALES)
    typed = files.standardise(text, schemas.SALES, {"sale_date": "yyyy/M/d"})
    assert typed.count() == 3
    assert {r.column_name: r.rejected for r in files.reject_counts(typed).collect()} == {"quantity": 1, "store_id": 1, "sale_date": 1}


def test_gb18030_transactions(spark, tmp_path):
    text = ("InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID\n"
            "536365,85123A,£纸灯笼,6,2010-12-01 08:26:00,2.55,17850\nC536379,D,折扣,-1,2010-12-01 09:41:00,27.5,\n")
    (tmp_path / "log.csv").write_bytes(text.encode("gb18030"))
    raw = files.text_scan(spark, str(tmp_path / "log.csv"), schemas.TRANSACTIONS, "gb18030")
    assert [r.Description for r in raw.collect()] == ["£纸灯笼", "折扣"]
    rows = files.load_transactions(spark, str(tmp_path / "log.csv")).orderBy("invoice_no").collect()
    assert rows[0].invoice_ts == dt.datetime(2010, 12, 1, 8, 26) and rows[0].customer_id == 17850
    assert rows[1].customer_id is None and rows[1].quantity == -1
    slashed = text.replace("2010-12-01 0", "12/1/2010 ")
    (tmp_path / "us.csv").write_bytes(slashed.encode("gb18030"))
    us = files.load_transactions(spark, str(tmp_path / "us.csv"), timestamp_format="M/d/yyyy H:mm:ss").orderBy("invoice_no")
    assert us.first().invoice_ts == dt.datetime(2010, 12, 1, 8, 26)


def test_category_orders_views_tables_and_profile(spark, tmp_path):
    (tmp_path / "o.csv").write_text("order_id,customer_id,category,amount,order_date\n1,101,Electronics,500,2025-01-10\n2,102,Apparel,100,2025-01-12\n")
    orders = files.load_category_orders(spark, str(tmp_path / "o.csv"))
    files.register_views({"orders_v": orders.limit(1)})
    files.register_views({"orders_v": orders})
    assert spark.sql("SELECT count(*) FROM orders_v").first()[0] == 2
    seen = spark.sql("SELECT category, sum(amount) AS total FROM orders_v GROUP BY category HAVING total > 200").collect()
    assert [r.category for r in seen] == ["Electronics"]
    spark.sql(f"CREATE DATABASE IF NOT EXISTS shop LOCATION '{tmp_path}/shop'")
    files.save_tables({"shop.orders": orders})
    files.save_tables({"shop.orders": orders.limit(1)})
    assert spark.table("shop.orders").count() == 1
    spark.sql("DROP DATABASE shop CASCADE")
    p = files.profile(orders, "order_date").first()
    assert (p.row_count, p.column_count, p.first_time, p.last_time) == (2, 5, dt.date(2025, 1, 10), dt.date(2025, 1, 12))


def test_sinks_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([("arima", dt.date(2011, 12, 9), 1.5), ("sarima", dt.date(2011, 12, 11), 2.5)], "model string, ds date, predicted double")
    sinks.write_csv(sinks.flat(rows), str(tmp_path / "csv"), partition_by="model")
    back = spark.read.option("header", True).csv(str(tmp_path / "csv"))
    assert {(r.model, r.ds, r.predicted) for r in back.collect()} == {("arima", "2011-12-09", "1.5"), ("sarima", "2011-12-11", "2.5")}
    sinks.write_parquet(rows, str(tmp_path / "pq"), partition_by="model")
    assert spark.read.parquet(str(tmp_path / "pq")).filter("model = 'arima'").count() == 1


def test_columns_are_taken_by_name(spark, tmp_path):
    names = [f.name for f in schemas.PRODUCTS.fields]
    heads = {"product_id": "101", "product_name": "Lamp"}
    (tmp_path / "p.csv").write_text(",".join(["extra", *reversed(names)]) + "\n" + ",".join(["x", *(heads.get(n, "1") for n in reversed(names))]) + "\n")
    row = files.text_scan(spark, str(tmp_path / "p.csv"), schemas.PRODUCTS).first()
    assert row.asDict() == {n: heads.get(n, "1") for n in names}
    (tmp_path / "q.csv").write_text(",".join(names[1:]) + "\n")
    with pytest.raises(ValueError, match=names[0]):
        files.text_scan(spark, str(tmp_path / "q.csv"), schemas.PRODUCTS)


def test_quarantine_stores_rejects_and_observes_their_counts_in_one_scan(spark, tmp_path):
    (tmp_path / "sales.csv").write_text(HEADS["sales"] + "\n1,101,201,2025/10/1,two,1.00\n2,101,x,2025/13/1,3,\n3,1,1,2025/1/2,1,9.99\n")
    text = files.text_scan(spark, str(tmp_path / "sales.csv"), schemas.SALES)
    scans = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            scans.add(batch.num_rows)
            yield batch

    held = files.quarantine(text.mapInArrow(seen, text.schema), schemas.SALES, str(tmp_path / "held"), {"sale_date": "yyyy/M/d"})
    assert held.counts == {"sale_id": 0, "product_id": 0, "store_id": 1, "sale_date": 1, "quantity": 1, "total_amount": 0}
    assert {r.sale_id: (r[files.REJECTS], r[files.RAW]) for r in held.rejects.collect()} == {
        1: (["quantity"], {"quantity": "two"}), 2: (["store_id", "sale_date"], {"store_id": "x", "sale_date": "2025/13/1"})}
    assert held.rows.schema == schemas.SALES and held.rows.count() == 3
    assert held.rows.filter("sale_id = 2").first().quantity == 3
    assert scans.value == 3
    counted = files.reject_counts(files.standardise(text, schemas.SALES, {"sale_date": "yyyy/M/d"}))
    assert {r.column_name: r.rejected for r in counted.collect()} == {n: c for n, c in held.counts.items() if c}
    assert "PartitionFilters: [isnotnull(_held" in held.rejects._jdf.queryExecution().toString()


def test_quarantine_of_a_clean_and_an_empty_table(spark, tmp_path):
    write_star(tmp_path)
    _, sales, _ = files.load_star(spark, str(tmp_path), kept_in=str(tmp_path / "kept"))
    _, plain, _ = files.load_star(spark, str(tmp_path))
    assert sorted(sales.collect()) == sorted(plain.collect())
    (tmp_path / "none.csv").write_text(HEADS["sales"] + "\n")
    held = files.quarantine(files.text_scan(spark, str(tmp_path / "none.csv"), schemas.SALES), schemas.SALES, str(tmp_path / "none"))
    assert held.rows.count() == held.rejects.count() == 0 and set(held.counts.values()) == {0}


def test_maps_never_exceed_their_limit(spark):
    for keys in (0, 1, 64, 65, 16_000):
        units = spark.range(keys).select(F.concat(F.lit("item "), F.col("id").cast("string")).alias("name"), (F.col("id") * 2).alias("units"))
        maps = sinks.bounded_maps(units, "name", "units", limit=64)
        shards = maps.collect()
        assert {k: v for s in shards for k, v in s.entries.items()} == {f"item {i}": 2 * i for i in range(keys)}
        assert all(0 < len(s.entries) <= 64 for s in shards)
    assert any(s.part for s in shards)  # a shard that was cut
    for i in (0, 17, 15_999):
        assert sinks.map_of(maps, f"item {i}").first().entries[f"item {i}"] == 2 * i


def test_bucketed_tables_join_and_sum_without_a_shuffle(spark, tmp_path):
    products, sales, stores = star(spark)
    names = {"bucketed_sales": sales, "bucketed_products": products}
    kept = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        files.save_bucketed(names, "product_id", 3, str(tmp_path))
        for key, value in zip(kept, ("false", "-1")):
            spark.conf.set(key, value)
        joined = spark.table("bucketed_sales").join(spark.table("bucketed_products"), "product_id", "left")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        summed = facts.product_facts(spark.table("bucketed_sales"), spark.table("bucketed_products"))
        assert "Exchange" not in summed._jdf.queryExecution().executedPlan().toString()
        assert sorted(joined.select("sale_id", "product_name").collect()) == sorted(sales.join(products, "product_id").select("sale_id", "product_name").collect())
        detail = facts.sales_detail(spark.table("bucketed_sales"), spark.table("bucketed_products"), stores)
        assert detail._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 2  # both sides of the stores' join
    finally:
        for key, value in kept.items():
            spark.conf.set(key, value)
        for name in names:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
