"""Registered queries of cleaning, calendar, anomalies and patterns."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tillwright.functions.scalars import weekday_label
from tillwright.operators import anomalies, calendar, cleaning, decomposition
from tillwright.plans import charts
from tillwright.registry.common import Registry
from tillwright.session import shared_folder
from tillwright.sources import files, schemas, sinks, tables

registry = Registry()
add = registry.add

TX = """tx AS (
  SELECT c_mktsegment AS series_key, CASE WHEN l_returnflag = 'R' THEN 'C' ELSE '' END || l_orderkey AS invoice_no,
    CAST(l_partkey % 50 AS VARCHAR) AS stock_code,
    CASE WHEN l_suppkey % 97 = 13 THEN NULL WHEN l_returnflag = 'R' OR l_suppkey % 89 = 7
      THEN -CAST(ceil(l_quantity / 10) AS INTEGER) ELSE CAST(ceil(l_quantity / 10) AS INTEGER) END AS quantity,
    CASE WHEN isodow(o_orderdate) = 6 THEN o_orderdate + INTERVAL 1 DAY ELSE o_orderdate END AS invoice_ts,
    CAST(CASE WHEN l_partkey % 41 = 0 THEN 0 ELSE 10 + l_partkey % 50 END AS DECIMAL(12,4)) AS unit_price,
    CASE WHEN o_custkey % 25 <> 0 THEN o_custkey END AS customer_id
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey),
roles AS (
  SELECT *, abs(quantity) AS units, CASE WHEN quantity IS NULL THEN 'missing_core' WHEN invoice_no LIKE 'C%' THEN 'cancel'
    WHEN quantity > 0 AND unit_price > 0 THEN 'sale' ELSE 'not_positive' END AS role FROM tx),
ranked AS (
  SELECT *, CASE WHEN customer_id IS NULL THEN 0 ELSE
      count(*) FILTER (role = 'cancel') OVER (PARTITION BY series_key, customer_id, stock_code, unit_price, units) END AS need,
    row_number() OVER (PARTITION BY series_key, customer_id, stock_code, unit_price, units, role
                       ORDER BY invoice_ts, invoice_no) AS place FROM roles),
lines AS (SELECT *, CASE WHEN role = 'sale' AND place <= need THEN 'matched' WHEN role = 'sale' THEN 'kept' ELSE role END AS fate,
  units * unit_price AS value FROM ranked)"""
DAILY = f"""{TX}, daily AS (SELECT series_key, CAST(invoice_ts AS DATE) AS ds, CAST(sum(value) AS DOUBLE) AS revenue,
  count(*) AS line_count FROM lines WHERE fate = 'kept' GROUP BY 1, 2)"""
DAYS = f"""{DAILY}, ends AS (SELECT series_key, min(ds) AS a, max(ds) AS b FROM daily GROUP BY 1),
grid AS (SELECT series_key, CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS ds FROM ends),
days AS (SELECT g.series_key, g.ds, d.revenue, coalesce(d.line_count, 0) AS line_count, d.ds IS NOT NULL AS recorded,
  isodow(g.ds) - 1 AS weekday, CASE WHEN d.ds IS NOT NULL THEN 'trading'
    WHEN bool_or(d.ds IS NOT NULL) OVER (PARTITION BY g.series_key, isodow(g.ds)) THEN 'closure' ELSE 'structural' END AS day_kind
  FROM grid g LEFT JOIN daily d ON d.series_key = g.series_key AND d.ds = g.ds)"""
SERIES = f"""{DAYS}, ts AS (SELECT series_key, ds, coalesce(revenue, 0) AS revenue,
  row_number() OVER (PARTITION BY series_key ORDER BY ds) AS step FROM days WHERE day_kind <> 'structural')"""
NAME = "['Mon','Tue','Wed','Thu','Fri','Sat','Sun'][isodow(ds)]"
ISO = "strftime(ds, '%Y-%m-%d')"


def daily(spark, d):
    return cleaning.daily_revenue(cleaning.day_ledger(tables.transactions(spark, d)))


def days(spark, d):
    return calendar.classified(calendar.spine(daily(spark, d)))


def trading(spark, d):
    return calendar.trading_series(days(spark, d))


# -- cleaning -----------------------------------------------------------------

@add("cancel_counts", f"""WITH {TX} SELECT series_key, customer_id, stock_code, CAST(unit_price AS DOUBLE) AS unit_price,
  CAST(units AS BIGINT) AS abs_quantity, count(*) AS cancels FROM lines WHERE role = 'cancel' AND customer_id IS NOT NULL
  GROUP BY ALL""")
def _(spark, d):
    return cleaning.cancel_counts(tables.transactions(spark, d))


@add("cleaning_audit", f"""WITH {TX} SELECT count(*) FILTER (fate = 'missing_core') AS missing_core,
  count(*) FILTER (fate = 'cancel') AS cancels, count(*) FILTER (fate = 'matched') AS matched_sales,
  count(*) FILTER (fate = 'not_positive') AS not_positive, count(*) FILTER (fate = 'kept') AS rows_kept,
  CAST(sum(value) FILTER (fate = 'kept') AS DOUBLE) AS revenue_kept,
  CAST(coalesce(sum(value) FILTER (fate = 'matched'), 0) AS DOUBLE) AS revenue_removed, count(*) AS rows_in FROM lines""")
def _(spark, d):
    return cleaning.audit(cleaning.day_ledger(tables.transactions(spark, d)))


@add("net_lines", f"""WITH {TX} SELECT series_key, invoice_no, stock_code, coalesce(customer_id, -1) AS customer_id,
  strftime(invoice_ts, '%Y-%m-%d %H:%M:%S') AS invoice_ts, CAST(unit_price AS DOUBLE) AS unit_price,
  CAST(units AS BIGINT) AS quantity, count(*) AS line_count, CAST(any_value(value) AS DOUBLE) AS line_revenue
  FROM lines WHERE fate = 'kept' GROUP BY 1, 2, 3, 4, 5, 6, 7""")
def _(spark, d):
    return cleaning.net_lines(tables.transactions(spark, d)).withColumn("customer_id", F.coalesce("customer_id", F.lit(-1)))


@add("daily_revenue", f"WITH {DAILY} SELECT series_key, {ISO} AS ds, revenue, line_count FROM daily")
def _(spark, d):
    return daily(spark, d)


# -- calendar -----------------------------------------------------------------

@add("classified_days", f"""WITH {DAYS} SELECT series_key, {ISO} AS ds, coalesce(revenue, -1) AS revenue, line_count,
  recorded, weekday, day_kind FROM days""")
def _(spark, d):
    return days(spark, d).withColumn("revenue", F.coalesce("revenue", F.lit(-1.0)))


@add("missing_days", f"WITH {DAYS} SELECT series_key, {ISO} AS ds, {NAME} AS weekday_name, day_kind FROM days WHERE NOT recorded")
def _(spark, d):
    return days(spark, d).filter(~F.col("recorded")).select(
        "series_key", "ds", weekday_label(F.col("ds")).alias("weekday_name"), "day_kind")


@add("weekday_profile", f"""WITH {DAYS} SELECT series_key, weekday, min({NAME}) AS weekday_name, count(*) AS calendar_days,
  count(*) FILTER (recorded) AS recorded_days, CAST(sum(line_count) AS BIGINT) AS line_count FROM days GROUP BY 1, 2""")
def _(spark, d):
    return calendar.weekday_profile(days(spark, d))


@add("calendar_span", f"""WITH {DAYS} SELECT series_key, strftime(min(ds), '%Y-%m-%d') AS first_day,
  strftime(max(ds), '%Y-%m-%d') AS last_day, datediff('day', min(ds), max(ds)) + 1 AS calendar_days,
  count(*) FILTER (recorded) AS recorded_days, count(*) FILTER (day_kind = 'structural') AS structural_days,
  count(*) FILTER (day_kind = 'closure') AS closure_days FROM days GROUP BY 1""")
def _(spark, d):
    return calendar.span(days(spark, d))


@add("trading_series", f"WITH {SERIES} SELECT series_key, {ISO} AS ds, revenue, step FROM ts")
def _(spark, d):
    return trading(spark, d)


UPCOMING = f"""{SERIES}, last AS (SELECT series_key, max(ds) AS last_day FROM ts GROUP BY 1),
closed AS (SELECT DISTINCT t.series_key, strftime(t.ds, '%m-%d') AS md FROM ts t JOIN last l USING (series_key)
  WHERE t.revenue = 0),
ahead AS (SELECT series_key, last_day, CAST(unnest(generate_series(last_day + 1, last_day + 60, INTERVAL 1 DAY)) AS DATE) AS ds FROM last),
numbered AS (SELECT *, row_number() OVER (PARTITION BY series_key ORDER BY ds) AS step FROM ahead a
  WHERE EXISTS (SELECT 1 FROM ts t WHERE t.series_key = a.series_key AND isodow(t.ds) = isodow(a.ds))),
upcoming AS (SELECT n.series_key, n.step, n.ds, {NAME.replace('ds', 'n.ds')} AS weekday_name,
  datediff('day', n.last_day, n.ds) AS days_ahead, CASE WHEN c.md IS NOT NULL THEN 'observed'
    WHEN strftime(n.ds, '%m-%d') IN ('12-25', '01-01') THEN 'calendar' END AS closure_source
  FROM numbered n LEFT JOIN closed c ON c.series_key = n.series_key AND c.md = strftime(n.ds, '%m-%d') WHERE n.step <= 30)"""


@add("upcoming_trading_days", f"""WITH {UPCOMING} SELECT series_key, step, {ISO} AS ds, weekday_name, days_ahead,
  coalesce(closure_source, 'open') AS closure_source, closure_source IS NOT NULL AS expected_closure FROM upcoming""")
def _(spark, d):
    ahead = calendar.upcoming(trading(spark, d))
    return ahead.withColumn("closure_source", F.coalesce("closure_source", F.lit("open")))


# -- level statistics ---------------------------------------------------------

@add("series_summary", f"""WITH {SERIES} SELECT series_key, count(*) AS days, round(avg(revenue), 4) AS mean_revenue,
  round(stddev_samp(revenue), 4) AS sd_revenue, max(revenue) AS max_revenue,
  round(2.5 * quantile_cont(CASE WHEN revenue > 0 THEN revenue END, 0.75)
      - 1.5 * quantile_cont(CASE WHEN revenue > 0 THEN revenue END, 0.25), 4) AS level_fence FROM ts GROUP BY 1""")
def _(spark, d):
    s = anomalies.summary(trading(spark, d))
    return s.withColumns({c: F.round(c, 4) for c in ("mean_revenue", "sd_revenue", "level_fence")})


FENCED = """q AS (SELECT series_key, quantile_cont(revenue, 0.25) AS q1, quantile_cont(revenue, 0.75) AS q3
  FROM ts WHERE revenue > 0 GROUP BY 1)"""


@add("level_outliers", f"""WITH {SERIES}, {FENCED} SELECT series_key, {ISO} AS ds, {NAME} AS weekday_name, revenue,
  round(q3 + 1.5 * (q3 - q1), 4) AS level_fence, CASE WHEN revenue = 0 THEN 'closure' ELSE 'peak' END AS kind
  FROM ts JOIN q USING (series_key) WHERE revenue = 0 OR revenue > q3 + 1.5 * (q3 - q1)""")
def _(spark, d):
    return anomalies.level_outliers(trading(spark, d)).withColumn("level_fence", F.round("level_fence", 4))


PATTERN = """base AS (SELECT series_key, avg(revenue) AS weekday_base FROM ts WHERE revenue > 0 AND isodow(ds) < 6 GROUP BY 1),
slots AS (SELECT series_key, revenue, 'weekday' AS pattern, isodow(ds) - 1 AS slot FROM ts WHERE revenue > 0
  UNION ALL SELECT series_key, revenue, 'month', month(ds) FROM ts WHERE revenue > 0),
pattern AS (SELECT series_key, pattern, slot, avg(revenue) AS mean_revenue, any_value(weekday_base) AS weekday_base
  FROM slots JOIN base USING (series_key) GROUP BY 1, 2, 3)"""


@add("weekday_month_pattern", f"""WITH {SERIES}, {PATTERN} SELECT series_key, pattern, slot, round(mean_revenue, 4) AS mean_revenue,
  round(weekday_base, 4) AS weekday_base, round(mean_revenue / weekday_base * 100, 4) AS percent_of_base FROM pattern""")
def _(spark, d):
    p = anomalies.weekday_month_pattern(trading(spark, d))
    return p.withColumns({c: F.round(c, 4) for c in ("mean_revenue", "weekday_base", "percent_of_base")})


@add("first_difference", f"""WITH {SERIES}, x AS (SELECT series_key, ds, revenue,
  revenue - lag(revenue) OVER (PARTITION BY series_key ORDER BY ds) AS diff FROM ts)
  SELECT series_key, {ISO} AS ds, revenue, diff FROM x WHERE diff IS NOT NULL""")
def _(spark, d):
    return charts.differenced(trading(spark, d))


# -- decomposition ------------------------------------------------------------

def _round_sql(k: int) -> str:
    """One decomposition round over the table of the round before."""
    w = "PARTITION BY series_key ORDER BY step ROWS BETWEEN"
    rest = "revenue - s6 - s26"
    return f"""
t{k} AS (SELECT series_key, ds, step, revenue, s6, s26, (avg({rest}) OVER ({w} 13 PRECEDING AND 12 FOLLOWING)
  + avg({rest}) OVER ({w} 12 PRECEDING AND 13 FOLLOWING)) / 2 AS trend FROM d{k - 1}),
p{k} AS (SELECT * EXCLUDE (s6), avg(revenue - trend - s26) OVER (PARTITION BY series_key, (step - 1) % 6)
  - avg(revenue - trend - s26) OVER (PARTITION BY series_key) AS s6 FROM t{k}),
d{k} AS (SELECT * EXCLUDE (s26), avg(revenue - trend - s6) OVER (PARTITION BY series_key, (step - 1) % 26)
  - avg(revenue - trend - s6) OVER (PARTITION BY series_key) AS s26 FROM p{k})"""


DECOMPOSED = f"""{SERIES}, d0 AS (SELECT *, 0.0::DOUBLE AS s6, 0.0::DOUBLE AS s26 FROM ts),{_round_sql(1)},{_round_sql(2)},
parts AS (SELECT *, revenue - trend - s6 - s26 AS resid FROM d2)"""


@add("decomposition", f"""WITH {DECOMPOSED} SELECT series_key, {ISO} AS ds, revenue, round(trend, 4) AS trend,
  round(s6, 4) AS season_short, round(s26, 4) AS season_long, round(resid, 4) AS resid FROM parts""")
def _(spark, d):
    parts = charts.decomposition_lines(decomposition.decompose(trading(spark, d)))
    return parts.withColumns({c: F.round(c, 4) for c in ("trend", "season_short", "season_long", "resid")})


@add("seasonal_amplitudes", f"""WITH {DECOMPOSED} SELECT series_key, round(max(s6) - min(s6), 4) AS short_amplitude,
  round(max(s26) - min(s26), 4) AS long_amplitude FROM parts GROUP BY 1""")
def _(spark, d):
    a = decomposition.amplitudes(decomposition.decompose(trading(spark, d)))
    return a.withColumns({c: F.round(c, 4) for c in ("short_amplitude", "long_amplitude")})


ANOMALIES = f"""{DECOMPOSED}, {FENCED}, rq AS (SELECT series_key, quantile_cont(resid, 0.25) AS r1,
  quantile_cont(resid, 0.75) AS r3 FROM parts GROUP BY 1),
judged AS (SELECT parts.*, q3 + 1.5 * (q3 - q1) AS fence, r3 + 1.5 * (r3 - r1) AS hi, r1 - 1.5 * (r3 - r1) AS lo
  FROM parts JOIN q USING (series_key) JOIN rq USING (series_key)),
found AS (SELECT *, 'peak' AS kind FROM judged WHERE revenue > fence
  UNION ALL SELECT *, 'seasonal_high' FROM judged WHERE revenue > 0 AND resid > hi
  UNION ALL SELECT *, 'seasonal_low' FROM judged WHERE revenue > 0 AND resid < lo
  UNION ALL SELECT *, 'closure' FROM judged WHERE revenue = 0)"""


@add("anomaly_days", f"""WITH {ANOMALIES} SELECT series_key, {ISO} AS ds, {NAME} AS weekday_name, round(revenue, 2) AS revenue,
  round(abs(resid), 2) AS off_expectation, kind FROM found ORDER BY series_key, ds, kind""")
def _(spark, d):
    return anomalies.anomalies(decomposition.decompose(trading(spark, d))).orderBy("series_key", "ds", "kind")


@add("anomaly_counts", f"WITH {ANOMALIES} SELECT series_key, kind, count(*) AS day_count FROM found GROUP BY 1, 2")
def _(spark, d):
    found = anomalies.anomalies(decomposition.decompose(trading(spark, d)))
    return found.groupBy("series_key", "kind").agg(F.count("*").alias("day_count"))


@add("figure_daily_line", f"WITH {SERIES} SELECT series_key, {ISO} AS ds, revenue, revenue = 0 AS closed FROM ts")
def _(spark, d):
    return charts.daily_line(trading(spark, d))


@add("figure_anomalies", f"""WITH {ANOMALIES}, k AS (SELECT series_key, ds, string_agg(kind, ',' ORDER BY kind) AS kinds FROM found
  GROUP BY 1, 2) SELECT series_key, {ISO} AS ds, j.revenue, coalesce(kinds, '') AS kinds, round(fence, 4) AS level_fence
  FROM judged j LEFT JOIN k USING (series_key, ds)""")
def _(spark, d):
    marks = charts.anomaly_marks(decomposition.decompose(trading(spark, d)))
    return marks.withColumns({"kinds": F.array_join(F.array_sort("kinds"), ","), "level_fence": F.round("level_fence", 4)})


@add("figure_patterns", f"""WITH {SERIES}, {PATTERN} SELECT series_key, pattern, CASE WHEN pattern = 'weekday'
  THEN ['Mon','Tue','Wed','Thu','Fri','Sat','Sun'][slot + 1] ELSE lpad(CAST(slot AS VARCHAR), 2, '0') END AS label,
  round(mean_revenue, 4) AS mean_revenue FROM pattern""")
def _(spark, d):
    bars = charts.pattern_bars(anomalies.weekday_month_pattern(trading(spark, d)))
    return bars.withColumn("mean_revenue", F.round("mean_revenue", 4))


@add("log_from_gb18030", f"""WITH {TX} SELECT invoice_no, stock_code, '纸灯笼 £' || stock_code AS description, CAST(quantity AS BIGINT) AS quantity,
  strftime(invoice_ts, '%Y-%m-%d %H:%M:%S') AS invoice_ts, CAST(unit_price AS DOUBLE) AS unit_price, customer_id FROM tx""")
def _(spark, d):
    """The transaction log written as GB18030 text and read back with its types."""
    spark.conf.set("spark.sql.legacy.javaCharsets", "true")  # as in the session's defaults
    path = f"{shared_folder(spark)}/log-{uuid.uuid4().hex}.csv"
    log = tables.transactions(spark, d).select(
        F.col("invoice_no").alias("InvoiceNo"), F.col("stock_code").alias("StockCode"), F.concat(F.lit("纸灯笼 £"), "stock_code").alias("Description"),
        F.col("quantity").alias("Quantity"), F.date_format("invoice_ts", "yyyy-MM-dd HH:mm:ss").alias("InvoiceDate"),
        F.col("unit_price").alias("UnitPrice"), F.col("customer_id").alias("CustomerID"))
    sinks.write_csv(log, path, encoding="gb18030")
    described = files.standardise(files.text_scan(spark, path, schemas.TRANSACTIONS, "gb18030"), schemas.TRANSACTIONS)
    return described.select(
        F.col("InvoiceNo").alias("invoice_no"), F.col("StockCode").alias("stock_code"), F.col("Description").alias("description"),
        F.col("Quantity").alias("quantity"), F.col("InvoiceDate").alias("invoice_ts"), F.col("UnitPrice").alias("unit_price"), F.col("CustomerID").alias("customer_id"))
