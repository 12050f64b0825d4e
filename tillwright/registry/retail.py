"""Registered queries of the retail mart."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F, types as T

from tillwright.functions import scalars
from tillwright.operators import anomalies, facts, kpi
from tillwright.plans import charts, mart
from tillwright.registry.common import DETAIL, PRODUCTS, SALES, STORES, Registry
from tillwright.session import shared_folder
from tillwright.sources import files, schemas, sinks, tables

registry = Registry()
add = registry.add

# Slow-mover limits that suit the benchmark tables (the library's own defaults are 3 and 100).
MAX_UNITS, MIN_COST = 22_000, 100.0


def _products(spark, d):
    return facts.product_facts(tables.sales(spark, d), tables.products(spark, d))


def _stores(spark, d):
    return facts.store_facts(tables.sales(spark, d), tables.stores(spark, d))


def _combos(spark, d):
    return facts.combo_facts(tables.sales(spark, d), tables.products(spark, d), tables.stores(spark, d))


# -- scans and tables ---------------------------------------------------------

@add("table_preview", f"WITH {SALES} SELECT sale_id, CAST(line_number AS BIGINT) AS line_number, product_id, store_id, "
     "strftime(sale_date, '%Y-%m-%d') AS sale_date, CAST(quantity AS BIGINT) AS quantity, "
     "CAST(total_amount AS DOUBLE) AS total_amount FROM sales")
def _(spark, d):
    files.register_views({"sales": tables.sales(spark, d)})
    return spark.table("sales")


@add("star_from_csv", f"""WITH {SALES}, {PRODUCTS}, {STORES} SELECT sale_id, s.product_id, s.store_id, strftime(sale_date, '%Y-%m-%d') AS sale_date,
  CAST(quantity AS BIGINT) AS quantity, CAST(total_amount AS DOUBLE) AS total_amount, product_name, category,
  CAST(cost_price AS DOUBLE) AS cost_price, store_location, CAST(monthly_rent AS DOUBLE) AS monthly_rent
  FROM sales s LEFT JOIN products p ON p.product_id = s.product_id LEFT JOIN stores t ON t.store_id = s.store_id""")
def _(spark, d):
    """The three tables written as CSV, loaded back with their types and joined."""
    folder = f"{shared_folder(spark)}/star-{uuid.uuid4().hex}"
    dated = tables.sales(spark, d).withColumn("sale_date", F.date_format("sale_date", "yyyy/M/d"))
    sinks.write_csv(dated, f"{folder}/sales.csv")
    sinks.write_csv(tables.products(spark, d).withColumn("retail_price", F.col("cost_price")), f"{folder}/products.csv")
    sinks.write_csv(tables.stores(spark, d), f"{folder}/stores.csv")
    products, sales, stores = files.load_star(spark, folder)
    return sales.join(products.drop("retail_price"), "product_id", "left").join(stores, "store_id", "left")


@add("typed_rows", f"""WITH {SALES} SELECT year(sale_date) AS sale_year, count(*) AS rows_typed,
  CAST(sum(quantity) AS BIGINT) AS total_units, CAST(sum(total_amount) AS DOUBLE) AS total_revenue,
  CAST(sum(CASE WHEN quantity % 7 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS rejected_quantity
  FROM sales GROUP BY 1""")
def _(spark, d):
    text = tables.sales(spark, d).select(
        F.col("sale_id").cast("string"), F.col("product_id").cast("string"), F.col("store_id").cast("string"),
        F.date_format("sale_date", "yyyy/M/d").alias("sale_date"),
        F.col("quantity").cast("string").alias("units_text"),
        F.when(F.col("quantity") % 7 == 0, F.lit("n/a")).otherwise(F.col("quantity").cast("string")).alias("quantity"),
        F.col("total_amount").cast("string"),
    )
    typed = files.standardise(text, T.StructType([*schemas.SALES.fields, T.StructField("units_text", T.IntegerType())]), {"sale_date": "yyyy/M/d"})
    return typed.groupBy(F.year("sale_date").cast("bigint").alias("sale_year")).agg(
        F.count("*").alias("rows_typed"),
        F.sum("units_text").alias("total_units"),
        F.sum("total_amount").alias("total_revenue"),
        F.count_if(F.array_contains(files.REJECTS, "quantity")).alias("rejected_quantity"),
    )


@add("type_rejects", f"""WITH {SALES} SELECT 'quantity' AS column_name, count(*) AS rejected FROM sales
  WHERE quantity % 7 = 0""")
def _(spark, d):
    text = tables.sales(spark, d).select(
        F.when(F.col("quantity") % 7 == 0, F.lit("n/a")).otherwise(F.col("quantity").cast("string")).alias("quantity"),
        F.col("total_amount").cast("string").alias("total_amount"),
    )
    kept = [f for f in schemas.SALES.fields if f.name in text.columns]
    return files.reject_counts(files.standardise(text, T.StructType(kept)))


@add("reject_quarantine", f"""WITH {SALES} SELECT sale_id, line_number, store_id, 'n/a' AS quantity_text,
  CAST(total_amount AS DOUBLE) AS total_amount, CAST((SELECT count(*) FROM sales WHERE quantity % 7 = 0) AS BIGINT) AS observed
  FROM (SELECT * EXCLUDE line_number, CAST(line_number AS BIGINT) AS line_number FROM sales) WHERE quantity % 7 = 0""")
def _(spark, d):
    """Rejected rows read back from where they were put aside, with the count that was observed on the way."""
    text = tables.sales(spark, d).select(
        *(F.col(c).cast("string") for c in ("sale_id", "line_number", "product_id", "store_id")), F.date_format("sale_date", "yyyy/M/d").alias("sale_date"),
        F.when(F.col("quantity") % 7 == 0, F.lit("n/a")).otherwise(F.col("quantity").cast("string")).alias("quantity"),
        F.col("total_amount").cast("string"),
    )
    schema = T.StructType([*schemas.SALES.fields, T.StructField("line_number", T.LongType())])
    held = files.quarantine(text, schema, f"{shared_folder(spark)}/quarantine-{uuid.uuid4().hex}", {"sale_date": "yyyy/M/d"})
    return held.rejects.select("sale_id", "line_number", "store_id", F.col(files.RAW)["quantity"].alias("quantity_text"), "total_amount",
                               F.lit(held.counts["quantity"]).cast("bigint").alias("observed"))


@add("dataset_profile", """SELECT count(*) AS row_count, CAST(6 AS BIGINT) AS column_count,
  strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS first_time, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last_time FROM events""")
def _(spark, d):
    return files.profile(tables.parquet(spark, d, "events").withColumn("ts", F.to_timestamp("ts")), "ts")


@add("product_units_map", f"""WITH {DETAIL}, u AS (
  SELECT product_name, CAST(sum(quantity) AS BIGINT) AS units FROM detail GROUP BY 1)
  SELECT substr(md5(product_name), 1, 2) AS shard, count(*) AS products,
  string_agg(product_name || '=' || units, ';' ORDER BY product_name || '=' || units) AS entries FROM u GROUP BY 1""")
def _(spark, d):
    units = kpi.units_by_product(_products(spark, d), with_category=False)
    shards = sinks.as_maps(units, "product_name", "total_units")
    texts = F.transform(F.map_entries("entries"), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string")))
    return shards.select(
        "shard", F.cardinality("entries").cast("bigint").alias("products"),
        F.array_join(F.array_sort(texts), ";").alias("entries"),
    )


@add("product_units_shards", f"""WITH {DETAIL}, u AS (
  SELECT product_name, CAST(sum(quantity) AS BIGINT) AS units, md5(product_name) AS h FROM detail GROUP BY 1), n AS (SELECT count(*) AS n FROM u),
  p AS (SELECT u.*, substr(h, 1, CASE WHEN n <= 100 THEN 0 WHEN n <= 1600 THEN 1 WHEN n <= 25600 THEN 2 WHEN n <= 409600 THEN 3 ELSE 4 END) AS shard
    FROM u CROSS JOIN n),
  r AS (SELECT *, (row_number() OVER (PARTITION BY shard ORDER BY h, product_name) - 1) // 100 AS part FROM p)
  SELECT shard, CAST(part AS BIGINT) AS part, min(h) AS first_hash, count(*) AS products, CAST(sum(units) AS BIGINT) AS total_units FROM r GROUP BY 1, 2""")
def _(spark, d):
    """The product map in shards of 100 entries at most."""
    units = kpi.units_by_product(_products(spark, d), with_category=False)
    shards = sinks.bounded_maps(units, "product_name", "total_units", limit=100)
    return shards.select("shard", "part", "first_hash", F.cardinality("entries").cast("bigint").alias("products"),
                         F.aggregate(F.map_values("entries"), F.lit(0).cast("bigint"), lambda total, n: total + n).alias("total_units"))


@add("store_records", f"""WITH {DETAIL} SELECT '{{"store_location":"' || store_location || '","total_units":' ||
  CAST(sum(quantity) AS BIGINT) || '}}' AS record FROM detail GROUP BY store_location""")
def _(spark, d):
    return sinks.as_records(kpi.revenue_by_store(_stores(spark, d)).select("store_location", "total_units"))


# -- fact joins ---------------------------------------------------------------

_DETAIL_COLUMNS = """sale_id, CAST(line_number AS BIGINT) AS line_number, product_id, product_name, category, store_id,
  store_location, strftime(sale_date, '%Y-%m-%d') AS sale_date, CAST(quantity AS BIGINT) AS quantity,
  CAST(total_amount AS DOUBLE) AS total_amount, CAST(profit AS DOUBLE) AS gross_profit,
  round(CAST(profit AS DOUBLE) / nullif(CAST(total_amount AS DOUBLE), 0), 6) AS gross_margin_rate"""


@add("sales_detail", f"WITH {DETAIL} SELECT {_DETAIL_COLUMNS} FROM detail ORDER BY detail.sale_date, sale_id")
def _(spark, d):
    detail = facts.sales_detail(tables.sales(spark, d), tables.products(spark, d), tables.stores(spark, d))
    return detail.orderBy("sale_date", "sale_id").select(
        "sale_id", "line_number", "product_id", "product_name", "category", "store_id", "store_location",
        "sale_date", "quantity", "total_amount", "gross_profit",
        F.round("gross_margin_rate", 6).alias("gross_margin_rate"),
    )


_UNORDERED = f"WITH {DETAIL} SELECT {_DETAIL_COLUMNS} FROM detail"
_SHOWN = ("sale_id", "line_number", "product_id", "product_name", "category", "store_id", "store_location",
          "sale_date", "quantity", "total_amount", "gross_profit")


@add("sales_detail_spread", _UNORDERED)
def _(spark, d):
    """The fact table with measured hot products and stores split over tasks."""
    detail = facts.sales_detail(tables.sales(spark, d), tables.products(spark, d), tables.stores(spark, d), spread=16)
    return detail.select(*_SHOWN, F.round("gross_margin_rate", 6).alias("gross_margin_rate"))


@add("sales_detail_bucketed", _UNORDERED)
def _(spark, d):
    """The fact table from catalog tables that are bucketed by product, so that sales stay where they are."""
    mark, buckets = uuid.uuid4().hex[:12], int(spark.conf.get("spark.sql.shuffle.partitions"))
    sales, products = f"sales_{mark}", f"products_{mark}"
    files.save_bucketed({sales: tables.sales(spark, d), products: tables.products(spark, d)}, "product_id", buckets, f"{shared_folder(spark)}/bucketed")
    detail = facts.sales_detail(spark.table(sales), spark.table(products), tables.stores(spark, d))
    return detail.select(*_SHOWN, F.round("gross_margin_rate", 6).alias("gross_margin_rate"))


@add("sales_detail_inner", f"""WITH {DETAIL} SELECT category, store_location, count(*) AS sales_count,
  CAST(sum(profit) AS DOUBLE) AS gross_profit FROM detail
  WHERE product_name IS NOT NULL AND store_location IS NOT NULL AND category <> 'ECONOMY' GROUP BY 1, 2""")
def _(spark, d):
    products = tables.products(spark, d).filter(F.col("category") != "ECONOMY")
    inner = facts.sales_detail(tables.sales(spark, d), products, tables.stores(spark, d), "inner")
    return inner.groupBy("category", "store_location").agg(
        F.count("*").alias("sales_count"), F.sum("gross_profit").alias("gross_profit"))


@add("unmatched_products", f"""WITH {SALES}, {PRODUCTS}, chosen AS (SELECT * FROM products WHERE category <> 'ECONOMY')
  SELECT c.product_name, CAST(sum(s.quantity) AS BIGINT) AS total_units, CAST(sum(s.total_amount) AS DOUBLE) AS total_revenue
  FROM sales s LEFT JOIN chosen c ON c.product_id = s.product_id GROUP BY 1""")
def _(spark, d):
    """A left join whose unmatched sales form a NULL group."""
    products = tables.products(spark, d).filter(F.col("category") != "ECONOMY")
    return kpi.units_by_product(facts.product_facts(tables.sales(spark, d), products), with_category=False)


@add("sales_between_dates", f"""WITH {DETAIL} SELECT store_location, CAST(sum(total_amount) AS DOUBLE) AS total_revenue,
  CAST(sum(quantity) AS BIGINT) AS total_units FROM detail
  WHERE sale_date BETWEEN DATE '1997-01-01' AND DATE '1997-12-31' GROUP BY 1""")
def _(spark, d):
    year = facts.between_dates(tables.sales(spark, d), dt.date(1997, 1, 1), dt.date(1997, 12, 31))
    return kpi.revenue_by_store(facts.store_facts(year, tables.stores(spark, d)))


# -- indicators ---------------------------------------------------------------

_ORDERS = """orders_c AS (SELECT o_orderpriority AS category,
  CAST(round(CAST(o_totalprice AS DECIMAL(14,2)) * 100) AS BIGINT) AS amount FROM orders)"""


@add("category_totals", f"""WITH {_ORDERS} SELECT category, CAST(sum(amount) AS BIGINT) AS total_sales,
  round(CAST(sum(amount) AS DOUBLE) / count(*), 4) AS avg_order_amount,
  printf('%.2f', CAST(sum(amount) AS DOUBLE) / count(*)) AS avg_text FROM orders_c GROUP BY 1""")
def _(spark, d):
    totals = kpi.category_totals(tables.category_orders(spark, d))
    return totals.select("category", "total_sales", F.round("avg_order_amount", 4).alias("avg_order_amount"),
                         scalars.two_decimals(F.col("avg_order_amount")).alias("avg_text"))


@add("amount_quartiles", f"""WITH {_ORDERS}, q AS (SELECT category, quantile_cont(amount, 0.25) AS q1, quantile_cont(amount, 0.75) AS q3,
  count(*) AS order_count FROM orders_c GROUP BY 1) SELECT category, order_count, round(q1, 4) AS q1, round(q3, 4) AS q3,
  true AS sketch_within_bound FROM q""")
def _(spark, d):
    """Exact quartiles of the order amounts, and whether the sketched ones keep their rank bound of a thousandth."""
    orders = tables.category_orders(spark, d)
    groups = orders.groupBy(F.col("category").alias("of")).agg(
        F.count("*").alias("order_count"), anomalies.quartiles(F.col("amount")).alias("exact"),
        anomalies.sketched_quartiles(F.col("amount"), 1_000).alias("sketch"))
    ranked = orders.join(groups, F.equal_null("category", "of")).groupBy("category").agg(
        F.first("order_count").alias("order_count"), F.first("exact").alias("exact"),
        *(F.count_if(test).alias(name) for i in (0, 1) for name, test in (
            (f"below{i}", F.col("amount") < F.col("sketch")[i]), (f"upto{i}", F.col("amount") <= F.col("sketch")[i]))))
    slack = F.col("order_count") * 0.001 + 1

    def near(i: int, share: float):
        return (F.col(f"below{i}") <= F.col("order_count") * share + slack) & (F.col(f"upto{i}") >= F.col("order_count") * share - slack)

    return ranked.select("category", "order_count", F.round(F.col("exact")[0], 4).alias("q1"), F.round(F.col("exact")[1], 4).alias("q3"),
                         (near(0, 0.25) & near(1, 0.75)).alias("sketch_within_bound"))


@add("category_totals_above", f"""WITH {_ORDERS}
  SELECT category, CAST(sum(amount) AS BIGINT) AS total_sales,
  round(CAST(sum(amount) AS DOUBLE) / count(*), 4) AS avg_order_amount FROM orders_c GROUP BY 1
  HAVING total_sales > 75000000000""")
def _(spark, d):
    totals = kpi.category_totals(tables.category_orders(spark, d), over=75_000_000_000)
    return totals.withColumn("avg_order_amount", F.round("avg_order_amount", 4))


@add("revenue_by_store", f"""WITH {DETAIL} SELECT store_location, CAST(sum(total_amount) AS DOUBLE) AS total_revenue,
  CAST(sum(quantity) AS BIGINT) AS total_units FROM detail GROUP BY 1""")
def _(spark, d):
    return kpi.revenue_by_store(_stores(spark, d))


@add("best_store_by_revenue", f"""WITH {DETAIL} SELECT store_location, CAST(sum(total_amount) AS DOUBLE) AS total_revenue,
  CAST(sum(quantity) AS BIGINT) AS total_units FROM detail GROUP BY 1
  ORDER BY sum(total_amount) DESC, store_location LIMIT 1""")
def _(spark, d):
    return kpi.top(kpi.revenue_by_store(_stores(spark, d)), 1, "total_revenue", "store_location")


@add("units_by_product", f"""WITH {DETAIL} SELECT product_name, category, CAST(sum(quantity) AS BIGINT) AS total_units,
  CAST(sum(total_amount) AS DOUBLE) AS total_revenue FROM detail GROUP BY 1, 2""")
def _(spark, d):
    return kpi.units_by_product(_products(spark, d))


@add("highest_lowest_units", f"""WITH {DETAIL}, u AS (SELECT product_name, CAST(sum(quantity) AS BIGINT) AS total_units
  FROM detail GROUP BY 1), r AS (SELECT *, row_number() OVER (ORDER BY total_units DESC, product_name) AS hi,
  row_number() OVER (ORDER BY total_units, product_name) AS lo FROM u)
  SELECT product_name, total_units, CASE WHEN hi = 1 THEN 'highest_sales' WHEN lo = 1 THEN 'lowest_sales' END
  AS sales_rank_type FROM r WHERE hi = 1 OR lo = 1""")
def _(spark, d):
    units = kpi.units_by_product(_products(spark, d), with_category=False).select("product_name", "total_units")
    return kpi.extremes(units, ["product_name"], "total_units", "highest_sales", "lowest_sales", "sales_rank_type")


_KPI = """SELECT store_location, CAST(sum(total_amount) AS DOUBLE) AS total_revenue,
  CAST(sum(quantity) AS BIGINT) AS total_units, CAST({rent} AS DOUBLE) AS monthly_rent, {roi} AS roi FROM detail GROUP BY {keys}"""


@add("store_kpis", f"WITH {DETAIL} " + _KPI.format(
    rent="monthly_rent", keys="store_location, monthly_rent",
    roi="round(CAST(sum(total_amount) AS DOUBLE) / nullif(CAST(monthly_rent AS DOUBLE), 0), 4)"))
def _(spark, d):
    return kpi.store_kpis(_stores(spark, d))


@add("store_kpis_by_location", f"WITH {DETAIL} " + _KPI.format(
    rent="max(monthly_rent)", keys="store_location",
    roi="coalesce(round(CAST(sum(total_amount) AS DOUBLE) / nullif(CAST(max(monthly_rent) AS DOUBLE), 0), 4), 0)"))
def _(spark, d):
    return kpi.store_kpis(_stores(spark, d), one_rent_per_location=True)


@add("best_store_by_rent_return", f"WITH {DETAIL}, k AS (" + _KPI.format(
    rent="monthly_rent", keys="store_location, monthly_rent",
    roi="round(CAST(sum(total_amount) AS DOUBLE) / nullif(CAST(monthly_rent AS DOUBLE), 0), 4)")
    + ") SELECT store_location, total_revenue, monthly_rent, roi FROM k ORDER BY roi DESC NULLS LAST, store_location LIMIT 1")
def _(spark, d):
    best = kpi.top(kpi.store_kpis(_stores(spark, d)), 1, "roi", "store_location")
    return best.select("store_location", "total_revenue", "monthly_rent", "roi")


_MARGINS = """margins AS (SELECT product_name, category, CAST(sum(quantity) AS BIGINT) AS total_units,
  CAST(sum(total_amount) AS DOUBLE) AS total_revenue, CAST(sum(cost) AS DOUBLE) AS total_cost,
  CAST(sum(profit) AS DOUBLE) AS gross_profit,
  round(CAST(sum(profit) AS DOUBLE) / nullif(CAST(sum(total_amount) AS DOUBLE), 0), 4) AS gross_margin_rate
  FROM detail GROUP BY 1, 2)"""


@add("product_margins", f"WITH {DETAIL}, {_MARGINS} SELECT * FROM margins")
def _(spark, d):
    return kpi.product_margins(_products(spark, d))


@add("highest_lowest_margin", f"""WITH {DETAIL}, {_MARGINS}, r AS (SELECT *,
  row_number() OVER (ORDER BY gross_margin_rate DESC NULLS LAST, product_name, category) AS hi,
  row_number() OVER (ORDER BY gross_margin_rate NULLS FIRST, product_name, category) AS lo FROM margins)
  SELECT * EXCLUDE (hi, lo), CASE WHEN hi = 1 THEN 'highest_margin' WHEN lo = 1 THEN 'lowest_margin' END
  AS margin_rank_type FROM r WHERE hi = 1 OR lo = 1""")
def _(spark, d):
    margins = kpi.product_margins(_products(spark, d))
    return kpi.extremes(margins, ["product_name", "category"], "gross_margin_rate",
                        "highest_margin", "lowest_margin", "margin_rank_type")


@add("slow_movers", f"""WITH {DETAIL} SELECT product_name, CAST(sum(quantity) AS BIGINT) AS total_units,
  CAST(sum(cost) AS DOUBLE) AS total_cost, CAST(sum(total_amount) AS DOUBLE) AS total_revenue, 'high' AS risk_flag
  FROM detail GROUP BY 1 HAVING sum(quantity) <= {MAX_UNITS} AND sum(cost) >= {MIN_COST}""")
def _(spark, d):
    return kpi.slow_movers(_products(spark, d), MAX_UNITS, MIN_COST)


@add("slow_parts", f"""WITH {SALES}, {PRODUCTS} SELECT CAST(product_id AS VARCHAR) AS product_name,
  CAST(sum(quantity) AS BIGINT) AS total_units, CAST(sum(cost_price * quantity) AS DOUBLE) AS total_cost,
  CAST(sum(total_amount) AS DOUBLE) AS total_revenue, 'high' AS risk_flag FROM sales JOIN products USING (product_id)
  GROUP BY 1 HAVING sum(quantity) < 400""")
def _(spark, d):
    """The low-quantity flag per part number, by a strict limit and no cost limit."""
    products = tables.products(spark, d).withColumn("product_name", F.col("product_id").cast("string"))
    return kpi.slow_movers(facts.product_facts(tables.sales(spark, d), products), 400, 0.0, strict=True)


@add("store_products", f"""WITH {DETAIL} SELECT store_location, product_name, CAST(sum(quantity) AS BIGINT) AS total_units,
  CAST(sum(total_amount) AS DOUBLE) AS total_revenue, CAST(sum(profit) AS DOUBLE) AS gross_profit FROM detail GROUP BY 1, 2""")
def _(spark, d):
    return kpi.store_products(_combos(spark, d))


@add("best_worst_combo", f"""WITH {DETAIL}, c AS (SELECT store_location, product_name,
  CAST(sum(quantity) AS BIGINT) AS total_units, CAST(sum(total_amount) AS DOUBLE) AS total_revenue,
  CAST(sum(profit) AS DOUBLE) AS gross_profit FROM detail GROUP BY 1, 2), r AS (SELECT *,
  row_number() OVER (ORDER BY total_revenue DESC, store_location, product_name) AS hi,
  row_number() OVER (ORDER BY total_revenue, store_location, product_name) AS lo FROM c)
  SELECT * EXCLUDE (hi, lo), CASE WHEN hi = 1 THEN 'best_combo' WHEN lo = 1 THEN 'worst_combo' END AS combo_rank_type
  FROM r WHERE hi = 1 OR lo = 1""")
def _(spark, d):
    return kpi.extremes(kpi.store_products(_combos(spark, d)), ["store_location", "product_name"],
                        "total_revenue", "best_combo", "worst_combo", "combo_rank_type")


@add("category_profit", f"""WITH {DETAIL} SELECT category, CAST(sum(total_amount) AS DOUBLE) AS revenue,
  CAST(sum(profit) AS DOUBLE) AS estimated_profit FROM detail GROUP BY 1""")
def _(spark, d):
    return kpi.category_profit(_products(spark, d))


@add("average_sale_by_store", f"""WITH {DETAIL} SELECT store_location, count(*) AS sales_count,
  CAST(sum(total_amount) AS DOUBLE) / count(*) AS avg_sale_amount FROM detail GROUP BY 1 HAVING count(*) >= 590""")
def _(spark, d):
    return kpi.average_sale_by_store(_stores(spark, d), min_sales=590)


@add("top_bottom_products", f"""WITH {DETAIL}, u AS (SELECT product_name, category, CAST(sum(quantity) AS BIGINT) AS total_units,
  CAST(sum(total_amount) AS DOUBLE) AS total_revenue FROM detail GROUP BY 1, 2)
  (SELECT *, 'top' AS "end" FROM u ORDER BY total_units DESC, product_name, category LIMIT 3) UNION ALL
  (SELECT *, 'bottom' AS "end" FROM u ORDER BY total_units, product_name, category LIMIT 3)""")
def _(spark, d):
    return kpi.both_ends(kpi.units_by_product(_products(spark, d)), 3, "total_units", "product_name", "category")


@add("top_bottom_margins", f"""WITH {DETAIL}, {_MARGINS}
  (SELECT *, 'top' AS "end" FROM margins ORDER BY gross_margin_rate DESC, product_name, category LIMIT 3) UNION ALL
  (SELECT *, 'bottom' AS "end" FROM margins ORDER BY gross_margin_rate, product_name, category LIMIT 3)""")
def _(spark, d):
    return kpi.both_ends(kpi.product_margins(_products(spark, d)), 3, "gross_margin_rate", "product_name", "category")


@add("recommendations", f"""WITH {DETAIL}, {_MARGINS},
  st AS (SELECT store_location, CAST(sum(total_amount) AS DOUBLE) AS v FROM detail GROUP BY 1),
  slow AS (SELECT product_name, CAST(sum(quantity) AS DOUBLE) AS v FROM detail GROUP BY 1
           HAVING sum(quantity) <= {MAX_UNITS} AND sum(cost) >= {MIN_COST}),
  co AS (SELECT store_location || ' - ' || product_name AS pair, store_location, product_name,
         CAST(sum(total_amount) AS DOUBLE) AS v FROM detail GROUP BY 2, 3)
  (SELECT 'best_store' AS topic, store_location AS subject, v AS value FROM st ORDER BY v DESC, 2 LIMIT 1)
  UNION ALL (SELECT 'slow_mover', product_name, v FROM slow)
  UNION ALL (SELECT 'highest_margin', product_name, gross_margin_rate FROM margins ORDER BY 3 DESC, product_name, category LIMIT 1)
  UNION ALL (SELECT 'lowest_margin', product_name, gross_margin_rate FROM margins ORDER BY 3, product_name, category LIMIT 1)
  UNION ALL (SELECT 'best_combo', pair, v FROM co ORDER BY v DESC, store_location, product_name LIMIT 1)
  UNION ALL (SELECT 'worst_combo', pair, v FROM co ORDER BY v, store_location, product_name LIMIT 1)""")
def _(spark, d):
    return mart.recommendations(_combos(spark, d), _products(spark, d), MAX_UNITS, MIN_COST)


# -- figures ------------------------------------------------------------------

@add("figure_store_revenue", f"""WITH {DETAIL} SELECT store_location, CAST(sum(total_amount) AS DOUBLE) AS total_revenue,
  CAST(sum(quantity) AS BIGINT) AS total_units FROM detail GROUP BY 1 ORDER BY 2 DESC, 1""")
def _(spark, d):
    return charts.store_bars(_stores(spark, d))


@add("figure_top_products", f"""WITH {DETAIL} SELECT product_name, category, CAST(sum(quantity) AS BIGINT) AS total_units,
  CAST(sum(total_amount) AS DOUBLE) AS total_revenue FROM detail GROUP BY 1, 2
  ORDER BY 3 DESC, product_name, category LIMIT 5""")
def _(spark, d):
    return charts.top_product_bars(_products(spark, d))


@add("figure_product_margin", f"""WITH {DETAIL}, {_MARGINS} SELECT product_name, category,
  coalesce(gross_margin_rate, 0) AS gross_margin_rate FROM margins ORDER BY 3 DESC, 1, 2""")
def _(spark, d):
    return charts.margin_bars(_products(spark, d))


@add("figure_combos", f"""WITH {DETAIL} SELECT store_location || ' - ' || product_name AS label,
  CAST(sum(total_amount) AS DOUBLE) AS total_revenue FROM detail GROUP BY store_location, product_name
  ORDER BY 2 DESC, store_location, product_name LIMIT 8""")
def _(spark, d):
    return charts.combo_bars(_combos(spark, d))
