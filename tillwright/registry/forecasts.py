"""Registered queries of stationarity, forecasting and planning.

The SQL twins run the models' recursions as recursive table expressions, one
step per trading day.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tillwright.functions.recursions import ARIMA_COARSE, ARIMA_STEPS, SMOOTHING_COARSE, SMOOTHING_STEPS
from tillwright.operators import anomalies, calendar, evaluation, forecasting, stationarity
from tillwright.plans import charts, outlook, planning
from tillwright.registry.common import Registry
from tillwright.registry.series import NAME, PATTERN, SERIES, UPCOMING, trading
from tillwright.session import durable, shared_folder
from tillwright.sources import sinks, tables

registry = Registry()
add = registry.add


def _rounded(df, *names, places=4):
    return df.withColumns({n: F.round(n, places) for n in names})


# -- stationarity -------------------------------------------------------------

_LAGS = 30  # more than the length rule asks for in these tables, which span seven years
_T = _LAGS + 2  # place of the target in the vector, from 0


def _swept(m: str, k: str) -> str:
    p = f"{m}[{k} + 1][{k} + 1]"
    return (f"list_transform({m}, lambda r, i: CASE WHEN i = {k} + 1 "
            f"THEN list_transform(r, lambda v, j: (CASE WHEN j = {k} + 1 THEN 1.0 ELSE v END) / {p}) "
            f"ELSE list_transform(r, lambda v, j: CASE WHEN j = {k} + 1 THEN -r[{k} + 1] / {p} "
            f"ELSE v - r[{k} + 1] * {m}[{k} + 1][j] / {p} END) END)")


def _sums(name: str, rows: str) -> str:
    """Matrix of sums of products of the vectors ``x`` in ``rows`` (with its number of pivots)."""
    return f"""{name}_cells AS (SELECT series_key, any_value(pivots) AS pivots, i, j, sum(x[i] * x[j]) AS s
  FROM {rows}, (SELECT unnest(range(1, {_T + 2})) AS i), (SELECT unnest(range(1, {_T + 2})) AS j) GROUP BY series_key, i, j),
{name}_rows AS (SELECT series_key, any_value(pivots) AS pivots, i, list(s ORDER BY j) AS r FROM {name}_cells GROUP BY series_key, i),
{name} AS (SELECT series_key, any_value(pivots) AS pivots, list(r ORDER BY i) AS m FROM {name}_rows GROUP BY series_key),
{name}_sweep AS (SELECT series_key, pivots, m, m[1][1] AS n, 0 AS k, []::DOUBLE[] AS rss FROM {name}
  UNION ALL SELECT series_key, pivots, {_swept('m', 'k')}, n, k + 1,
    list_append(rss, m[{_T + 1}][{_T + 1}] - m[{_T + 1}][k + 1] * m[k + 1][{_T + 1}] / m[k + 1][k + 1])
  FROM {name}_sweep WHERE k < pivots)"""


def _adf_sql(source: str, value: str, p: str = "") -> str:
    lags = ", ".join(f"coalesce(lag(change, {i}) OVER o, 0)" for i in range(1, _LAGS + 1))
    keep = "list_transform(lags, lambda v, i: CASE WHEN i <= {p} THEN v ELSE 0.0 END)"
    return f"""{p}z AS (SELECT series_key, row_number() OVER w AS t, count(*) OVER (PARTITION BY series_key) AS n,
  ({value} - avg({value}) OVER (PARTITION BY series_key)) / stddev_pop({value}) OVER (PARTITION BY series_key) AS z FROM {source}
  WINDOW w AS (PARTITION BY series_key ORDER BY ds)),
{p}zd AS (SELECT *, lag(z) OVER (PARTITION BY series_key ORDER BY t) AS level FROM {p}z),
{p}zc AS (SELECT *, z - level AS change FROM {p}zd),
{p}zl AS (SELECT series_key, t, level, change, greatest(0, least({_LAGS}, CAST(ceil(12 * pow(n / 100, 0.25)) AS BIGINT), n // 2 - 2)) AS cap,
  [{lags}] AS lags FROM {p}zc WINDOW o AS (PARTITION BY series_key ORDER BY t)),
{p}v1 AS (SELECT series_key, cap + 2 AS pivots, list_concat([1.0, level], {keep.format(p='cap')}, [change]) AS x
  FROM {p}zl WHERE level IS NOT NULL AND t >= cap + 2),
{_sums(p + 'g1', p + 'v1')},
{p}aic AS (SELECT series_key, list_transform(rss[2:], lambda r, i: n * ln(r / n) + 2 * (i + 1)) AS a FROM {p}g1_sweep WHERE k = pivots),
{p}pick AS (SELECT series_key, list_position(a, list_min(a)) - 1 AS p FROM {p}aic),
{p}v2 AS (SELECT series_key, p + 2 AS pivots, list_concat([1.0, level], {keep.format(p='p')}, [change]) AS x
  FROM {p}zl JOIN {p}pick USING (series_key) WHERE level IS NOT NULL AND t >= p + 2),
{_sums(p + 'g2', p + 'v2')},
{p}adf AS (SELECT series_key, pivots - 2 AS lag_order, CAST(n AS BIGINT) AS n_obs,
  m[2][{_T + 1}] / sqrt(m[{_T + 1}][{_T + 1}] / (n - pivots) * m[2][2]) AS stat FROM {p}g2_sweep WHERE k = pivots)"""


_ADF_OUT = """series_key, CAST(lag_order AS BIGINT) AS lag_order, n_obs, round(stat, 4) AS adf_stat,
  round(-2.86154 - 2.8903 / n_obs - 4.234 / pow(n_obs, 2) - 40.04 / pow(n_obs, 3), 4) AS critical_5"""


@add("unit_root_test", f"WITH RECURSIVE {SERIES}, {_adf_sql('ts', 'revenue')} SELECT {_ADF_OUT} FROM adf")
def _(spark, d):
    rows = stationarity.adf(durable(trading(spark, d)))
    return _rounded(rows, "adf_stat", "critical_5").select("series_key", "lag_order", "n_obs", "adf_stat", "critical_5")


_DIFF = "df1 AS (SELECT * FROM (SELECT series_key, ds, revenue - lag(revenue) OVER (PARTITION BY series_key ORDER BY ds) AS change1 FROM ts) WHERE change1 IS NOT NULL)"


@add("unit_root_test_differenced", f"WITH RECURSIVE {SERIES}, {_DIFF}, {_adf_sql('df1', 'change1')} SELECT {_ADF_OUT} FROM adf")
def _(spark, d):
    rows = stationarity.adf(stationarity.differenced(durable(trading(spark, d))))
    return _rounded(rows, "adf_stat", "critical_5").select("series_key", "lag_order", "n_obs", "adf_stat", "critical_5")


_TAIL = """exp(-q * q / 2) / sqrt(2 * pi()) * u * (0.319381530 + u * (-0.356563782 + u * (1.781477937 + u * (-1.821255978 + u * 1.330274429))))"""


@add("stationarity_verdicts", f"""WITH RECURSIVE {SERIES}, {_DIFF}, {_adf_sql('ts', 'revenue')}, {_adf_sql('df1', 'change1', 'd_')},
both_tests AS (SELECT 'original' AS input, * FROM adf UNION ALL SELECT 'first_difference', * FROM d_adf),
q AS (SELECT *, CASE WHEN stat <= -1.61 THEN 2.1659 + 1.4412 * stat + 0.038269 * stat * stat
  ELSE 1.7339 + 0.93202 * stat - 0.12745 * stat * stat - 0.010368 * stat * stat * stat END AS q FROM both_tests),
u AS (SELECT *, 1 / (1 + 0.2316419 * abs(q)) AS u FROM q),
p AS (SELECT *, CASE WHEN stat < -18.83 THEN 0 WHEN stat > 2.74 THEN 1 WHEN q >= 0 THEN 1 - {_TAIL} ELSE {_TAIL} END AS p FROM u)
SELECT {_ADF_OUT}, input, round(p, 4) + 0.0 AS p_value, p < 0.05 AS stationary, CASE WHEN p < 0.05 THEN 'stationary'
  WHEN input = 'original' THEN 'difference_and_test_again' ELSE 'higher_difference_needed' END AS verdict FROM p""")
def _(spark, d):
    return _rounded(stationarity.verdicts(durable(trading(spark, d))), "adf_stat", "p_value", "critical_5")


# -- smoothing in SQL ---------------------------------------------------------

def _smoothing_sql(name: str, source: str) -> str:
    """Coarse and refined search of the smoothing weights on ``source`` (series_key, step, revenue)."""
    coarse = ", ".join(f"({i}, {a}, {b}, {g})" for i, (a, b, g) in enumerate(SMOOTHING_COARSE.T.tolist()))

    def run(stage: str, tries: str) -> str:
        return f"""{stage} AS (
  SELECT t.series_key, t.i, t.a, t.b, t.g, 6 AS step, s.l0 AS level, 0.0::DOUBLE AS trend,
    list_transform(s.first6, lambda v: v - s.l0) AS season, 0.0::DOUBLE AS sse FROM {tries} t JOIN {name}_start s USING (series_key)
  UNION ALL
  SELECT series_key, i, a, b, g, step + 1, moved, b * (moved - level) + (1 - b) * trend,
    list_append(season[2:], g * (y - (level + trend)) + (1 - g) * season[1]), sse + pow(y - (level + trend + season[1]), 2)
  FROM (SELECT r.*, x.revenue AS y, r.a * (x.revenue - r.season[1]) + (1 - r.a) * (r.level + r.trend) AS moved
        FROM {stage} r JOIN {source} x ON x.series_key = r.series_key AND x.step = r.step + 1))"""

    def best(stage: str) -> str:  # of errors equal to nine places the first try counts
        return f"""{stage}_best AS (SELECT series_key, arg_min(struct_pack(a := a, b := b, g := g, sse := sse, level := level,
    trend := trend, season := season), i) AS f FROM (SELECT r.*, min(sse) OVER (PARTITION BY series_key) AS least_sse
    FROM {stage} r JOIN {name}_start USING (series_key) WHERE step = n) WHERE sse <= least_sse * (1 + 1e-9) GROUP BY 1)"""

    parts = [f"""{name}_start AS (SELECT series_key, list_avg(list(revenue ORDER BY step)[1:6]) AS l0,
  list(revenue ORDER BY step)[1:6] AS first6, max(step) AS n FROM {source} GROUP BY 1 HAVING count(*) >= 12),
{name}_t0 AS (SELECT series_key, i, a::DOUBLE AS a, b::DOUBLE AS b, g::DOUBLE AS g FROM {name}_start, (VALUES {coarse}) v(i, a, b, g)),
{run(name + '_r0', name + '_t0')}, {best(name + '_r0')}"""]
    for k, z in enumerate(SMOOTHING_STEPS, start=1):
        lists = ", ".join(f"(SELECT unnest([-{z}, 0.0, {z}]) AS d{c}, unnest([0, 1, 2]) AS i{c})" for c in "abg")
        near = ", ".join(f"greatest(0.0, least(0.99, f.{c} + d{c}))::DOUBLE AS {c}" for c in "abg")
        parts.append(f"""{name}_t{k} AS (SELECT series_key, 9 * ia + 3 * ib + ig AS i, {near} FROM {name}_r{k - 1}_best, {lists}),
{run(f'{name}_r{k}', f'{name}_t{k}')}, {best(f'{name}_r{k}')}""")
    parts.append(f"""{name} AS (SELECT series_key, f.a AS a, f.b AS b, f.g AS g, f.sse AS sse, f.level AS level, f.trend AS trend, f.season AS season
  FROM {name}_r{len(SMOOTHING_STEPS)}_best)""")
    return ",\n".join(parts)


def _arima_sql(name: str, source: str, seasonal: bool, horizons: str) -> str:
    """Coefficient search and forecast of (seasonal) ARIMA on ``source``; ``horizons`` has (series_key, horizon)."""
    def values(grid) -> str:
        return ", ".join(f"({', '.join(repr(float(v)) for v in column)})" for column in grid.T)

    def run(stage: str, tries: str) -> str:
        return f"""{stage} AS (
  SELECT series_key, f, t, p, q, 0 AS k, list_resize([]::DOUBLE[], 7, 0.0) AS e, list_resize([]::DOUBLE[], 7, 0.0) AS v, 0.0::DOUBLE AS sse FROM {tries}
  UNION ALL
  SELECT series_key, f, t, p, q, k + 1, list_prepend(shock, e[:6]), list_prepend(w, v[:6]),
    CASE WHEN k >= 7 THEN sse + shock * shock ELSE sse END
  FROM (SELECT r.*, x.w, x.w - f * v[1] - p * (v[6] - f * v[7]) - t * e[1] - q * (e[6] + t * e[7]) AS shock
        FROM {stage} r JOIN {name}_w x ON x.series_key = r.series_key AND x.k = r.k + 1)),
{stage}_best AS (SELECT r.series_key, arg_min(struct_pack(f := f, t := t, p := p, q := q, e := e, v := v), sse) AS b
  FROM {stage} r JOIN {name}_n n ON n.series_key = r.series_key AND n.n = r.k GROUP BY 1)"""

    change = "y - lag(y) OVER (PARTITION BY series_key ORDER BY step)"
    base = f"SELECT series_key, step, {change} AS w FROM (SELECT series_key, step, revenue AS y FROM {source})"
    if seasonal:
        base = f"SELECT series_key, step, w - lag(w, 6) OVER (PARTITION BY series_key ORDER BY step) AS w FROM ({base})"
    parts = [f"""{name}_w AS (SELECT series_key, w, row_number() OVER (PARTITION BY series_key ORDER BY step) AS k FROM ({base}) WHERE w IS NOT NULL),
{name}_n AS (SELECT series_key, max(k) AS n FROM {name}_w GROUP BY 1),
{name}_t0 AS (SELECT series_key, f, t, p, q FROM {name}_n, (VALUES {values(ARIMA_COARSE[seasonal])}) c(f, t, p, q))""",
             run(f"{name}_s0", f"{name}_t0")]
    for i, (own, shock) in enumerate(ARIMA_STEPS, start=1):
        steps = [own, shock, own * seasonal, shock * seasonal]
        lists = ", ".join(f"(SELECT unnest([{', '.join(map(str, [-z, 0.0, z] if z else [0.0]))}]) AS d{c})" for c, z in zip("ftpq", steps))
        clip = ", ".join(f"greatest(-0.99, least(0.99, b.{c} + d{c}))::DOUBLE AS {c}" for c in "ftpq")
        parts += [f"{name}_t{i} AS (SELECT series_key, {clip} FROM {name}_s{i - 1}_best, {lists})", run(f"{name}_s{i}", f"{name}_t{i}")]
    undo = "y[1] + y[6] - y[7]" if seasonal else "y[1]"
    parts.append(f"""{name} AS (SELECT series_key, b.f AS f, b.t AS t, b.p AS p, b.q AS q, b.e AS e, b.v AS v FROM {name}_s{len(ARIMA_STEPS)}_best),
{name}_y AS (SELECT series_key, list(revenue ORDER BY step DESC)[1:7] AS y FROM {source} GROUP BY 1),
{name}_path AS (
  SELECT series_key, 0 AS h, NULL::DOUBLE AS predicted, f, t, p, q, v, e, y, horizon FROM {name} JOIN {name}_y USING (series_key) JOIN {horizons} USING (series_key)
  UNION ALL
  SELECT series_key, h + 1, w + {undo}, f, t, p, q, list_prepend(w, v[:6]), list_prepend(0.0, e[:6]),
    list_prepend(w + {undo}, y[:6]), horizon
  FROM (SELECT *, f * v[1] + p * (v[6] - f * v[7]) + t * e[1] + q * (e[6] + t * e[7]) AS w FROM {name}_path WHERE h < horizon))""")
    return ",\n".join(parts)


TRAIN = f"""{SERIES}, cuts AS (SELECT series_key, CAST(floor(count(*) * 0.8) AS BIGINT) AS cut, count(*) AS n FROM ts GROUP BY 1),
train AS (SELECT ts.* FROM ts JOIN cuts USING (series_key) WHERE step <= cut), {_smoothing_sql('hw', 'train')}"""
HELD = f"""{TRAIN}, held AS (SELECT ts.series_key, ts.ds, ts.step, ts.revenue AS actual, ts.step - cut AS h,
  level + (ts.step - cut) * trend + season[(ts.step - cut - 1) % 6 + 1] AS predicted
  FROM ts JOIN cuts USING (series_key) JOIN hw USING (series_key) WHERE ts.step > cut)"""
METRICS = f"""{HELD}, sig AS (SELECT series_key, stddev_samp(actual - predicted) AS sigma FROM held GROUP BY 1),
measured AS (SELECT series_key, count(*) AS days, avg(pow(actual - predicted, 2)) AS mse, sqrt(avg(pow(actual - predicted, 2))) AS rmse,
  avg(abs(actual - predicted)) AS mae, any_value(sigma) AS sigma,
  avg(CASE WHEN actual BETWEEN greatest(predicted - 1.96 * sigma, 0) AND predicted + 1.96 * sigma THEN 1.0 ELSE 0.0 END) AS coverage
  FROM held JOIN sig USING (series_key) GROUP BY 1)"""
AHEAD = f"""{METRICS}, {UPCOMING[len(SERIES) + 2:]}, {_smoothing_sql('hf', 'ts')},
fc0 AS (SELECT u.series_key, u.step, u.ds, u.weekday_name, u.closure_source IS NOT NULL AS expected_closure, sigma,
  level + u.step * trend + season[(u.step - 1) % 6 + 1] AS p FROM upcoming u JOIN hf USING (series_key) JOIN measured USING (series_key)),
fc AS (SELECT series_key, step, ds, weekday_name, expected_closure, round(p, 2) AS predicted,
  round(greatest(p - 1.96 * sigma, 0), 2) AS lower95, round(p + 1.96 * sigma, 2) AS upper95,
  round(round(p + 1.96 * sigma, 2) - round(greatest(p - 1.96 * sigma, 0), 2), 2) AS width FROM fc0)"""
def _plan_sql(source: str) -> str:
    """The stock plan of a forecast table."""
    return f"""opened AS (SELECT *, round(width / nullif(predicted, 0), 3) AS doubt FROM {source} WHERE NOT expected_closure),
limits AS (SELECT series_key, quantile_cont(predicted, 0.75) AS high_cut, quantile_cont(predicted, 0.25) AS low_cut,
  quantile_cont(doubt, 0.75) AS doubt_cut FROM opened GROUP BY 1),
marks AS (SELECT o.*, high_cut, low_cut, doubt_cut, predicted >= high_cut AS is_peak, predicted <= low_cut AS is_trough,
  coalesce(doubt >= doubt_cut, false) AS is_volatile FROM opened o JOIN limits USING (series_key)),
ruled AS (SELECT *, CASE WHEN expected_closure THEN 'closure' WHEN shut THEN 'before_closure' WHEN is_peak THEN 'peak'
    WHEN is_volatile THEN 'volatile' ELSE 'normal' END AS rule
  FROM (SELECT f.*, lead(f.expected_closure) OVER (PARTITION BY f.series_key ORDER BY f.ds) AS shut, m.is_peak, m.is_trough, m.is_volatile
    FROM {source} f LEFT JOIN marks m ON m.series_key = f.series_key AND m.ds = f.ds))"""


_STOCK = """SELECT series_key, strftime(ds, '%Y-%m-%d') AS ds, weekday_name, predicted, rule,
  round(CASE rule WHEN 'closure' THEN 0 WHEN 'before_closure' THEN predicted * 1.2 WHEN 'peak' THEN predicted * 1.2
    WHEN 'volatile' THEN lower95 ELSE predicted END, 2) AS stock, CASE WHEN is_trough THEN 'two_days_of_cover' ELSE '' END AS cover FROM ruled"""


PLAN = f"{AHEAD}, {_plan_sql('fc')}"


def _held(spark, d):
    return outlook.hold_out(trading(spark, d), outlook.smoothing_only)


def _coming(spark, d):
    return outlook.coming_days(_held(spark, d), outlook.smoothing_only)


@add("smoothing_parameters", f"""WITH RECURSIVE {TRAIN} SELECT series_key, round(a, 4) AS alpha, round(b, 4) AS beta,
  round(g, 4) AS gamma, round(sse, 2) AS sse, round(level, 4) AS level, round(trend, 4) AS trend FROM hw""")
def _(spark, d):
    past = forecasting.histories(forecasting.training_part(durable(trading(spark, d))))
    fitted = forecasting.fit_smoothing(past).select("series_key", "fit.*").drop("season")
    return _rounded(_rounded(fitted, "alpha", "beta", "gamma", "level", "trend"), "sse", places=2)


@add("smoothing_hold_out", f"""WITH RECURSIVE {HELD} SELECT series_key, 'holt_winters' AS model, h AS ahead, step,
  strftime(ds, '%Y-%m-%d') AS ds, actual, round(predicted, 4) AS predicted FROM held""")
def _(spark, d):
    return _rounded(_held(spark, d).compared, "predicted")


@add("smoothing_metrics", f"""WITH RECURSIVE {METRICS} SELECT series_key, 'holt_winters' AS model, days, round(mse, 4) AS mse,
  round(rmse, 4) AS rmse, round(mae, 4) AS mae, round(sigma, 4) AS sigma, round(coverage, 6) AS coverage FROM measured""")
def _(spark, d):
    return _rounded(_rounded(_held(spark, d).metrics, "mse", "rmse", "mae", "sigma"), "coverage", places=6)


@add("smoothing_error_by_segment", f"""WITH RECURSIVE {HELD}, s AS (SELECT *, ntile(5) OVER (PARTITION BY series_key ORDER BY step) AS segment FROM held)
  SELECT series_key, 'holt_winters' AS model, segment, round(sqrt(avg(pow(actual - predicted, 2))), 4) AS rmse,
  round(avg(abs(actual - predicted)), 4) AS mae FROM s GROUP BY series_key, segment""")
def _(spark, d):
    return _rounded(_held(spark, d).by_segment, "rmse", "mae")


_SMOOTHED = f"""WITH RECURSIVE {AHEAD} SELECT series_key, 'holt_winters' AS model, step, strftime(ds, '%Y-%m-%d') AS ds,
  weekday_name, predicted, lower95, upper95, width, expected_closure FROM fc"""


@add("smoothing_forecast", _SMOOTHED)
def _(spark, d):
    return _coming(spark, d)


@add("stock_plan", f"WITH RECURSIVE {PLAN} {_STOCK}")
def _(spark, d):
    return planning.stock_plan(_coming(spark, d))


STAFF = f"""{SERIES}, {PATTERN}, ranks AS (SELECT *, row_number() OVER (PARTITION BY series_key, pattern ORDER BY mean_revenue DESC, slot) AS hi,
  row_number() OVER (PARTITION BY series_key, pattern ORDER BY mean_revenue, slot) AS lo FROM pattern),
staff AS (SELECT series_key, CASE WHEN pattern = 'weekday' AND hi <= 2 THEN 'peak_weekday_' || hi
  WHEN pattern = 'weekday' AND lo = 1 THEN 'low_weekday' WHEN pattern = 'month' AND hi = 1 THEN 'peak_month'
  WHEN pattern = 'month' AND lo = 1 THEN 'low_month' END AS role, CASE WHEN pattern = 'weekday'
  THEN ['Mon','Tue','Wed','Thu','Fri','Sat','Sun'][slot + 1] ELSE CAST(slot AS VARCHAR) END AS label, mean_revenue,
  mean_revenue / weekday_base * 100 AS pct FROM ranks)"""


@add("staffing", f"""WITH {STAFF} SELECT series_key, role, label, round(mean_revenue, 4) AS mean_revenue,
  round(pct, 4) AS percent_of_base FROM staff WHERE role IS NOT NULL""")
def _(spark, d):
    staff = planning.staffing(anomalies.weekday_month_pattern(trading(spark, d)))
    return _rounded(staff, "mean_revenue", "percent_of_base")


@add("staffing_uplift", f"""WITH {STAFF} SELECT series_key, round(avg(pct) FILTER (role LIKE 'peak_weekday%') - 100, 4) AS peak_uplift_percent,
  round(max(mean_revenue) FILTER (role = 'peak_month') / max(mean_revenue) FILTER (role = 'low_month'), 4) AS month_ratio
  FROM staff GROUP BY 1""")
def _(spark, d):
    staff = planning.staffing(anomalies.weekday_month_pattern(trading(spark, d)))
    return _rounded(planning.staffing_uplift(staff), "peak_uplift_percent", "month_ratio")


# -- all models ---------------------------------------------------------------

ALL_HELD = f"""{HELD}, tests AS (SELECT series_key, n - cut AS horizon FROM cuts), {_arima_sql('ar', 'train', False, 'tests')},
{_arima_sql('sa', 'train', True, 'tests')},
guesses AS (SELECT series_key, 'holt_winters' AS model, h, predicted FROM held
  UNION ALL SELECT series_key, 'arima', h, predicted FROM ar_path WHERE h > 0
  UNION ALL SELECT series_key, 'sarima', h, predicted FROM sa_path WHERE h > 0),
compared AS (SELECT g.*, ts.ds, ts.step, ts.revenue AS actual FROM guesses g JOIN cuts USING (series_key)
  JOIN ts ON ts.series_key = g.series_key AND ts.step = cut + h)"""
ALL_METRICS = f"""{ALL_HELD}, sigmas AS (SELECT series_key, model, stddev_samp(actual - predicted) AS sigma FROM compared GROUP BY 1, 2),
scores AS (SELECT series_key, model, count(*) AS days, avg(pow(actual - predicted, 2)) AS mse, sqrt(avg(pow(actual - predicted, 2))) AS rmse,
  avg(abs(actual - predicted)) AS mae, any_value(sigma) AS sigma,
  avg(CASE WHEN actual BETWEEN greatest(predicted - 1.96 * sigma, 0) AND predicted + 1.96 * sigma THEN 1.0 ELSE 0.0 END) AS coverage
  FROM compared JOIN sigmas USING (series_key, model) GROUP BY 1, 2),
best AS (SELECT series_key, arg_min(model, rmse) AS model, min(rmse) AS rmse FROM scores GROUP BY 1)"""
ALL_AHEAD = f"""{ALL_METRICS}, {UPCOMING[len(SERIES) + 2:]}, thirty AS (SELECT series_key, 30 AS horizon FROM cuts),
{_smoothing_sql('hf', 'ts')}, {_arima_sql('af', 'ts', False, 'thirty')}, {_arima_sql('sf', 'ts', True, 'thirty')},
paths AS (SELECT series_key, 'holt_winters' AS model, u.step, level + u.step * trend + season[(u.step - 1) % 6 + 1] AS p
    FROM upcoming u JOIN hf USING (series_key)
  UNION ALL SELECT series_key, 'arima', h, predicted FROM af_path WHERE h > 0
  UNION ALL SELECT series_key, 'sarima', h, predicted FROM sf_path WHERE h > 0),
all_fc AS (SELECT series_key, model, step, ds, weekday_name, closure_source IS NOT NULL AS expected_closure, round(p, 2) AS predicted,
  round(greatest(p - 1.96 * sigma, 0), 2) AS lower95, round(p + 1.96 * sigma, 2) AS upper95,
  round(round(p + 1.96 * sigma, 2) - round(greatest(p - 1.96 * sigma, 0), 2), 2) AS width
  FROM paths JOIN upcoming USING (series_key, step) JOIN scores USING (series_key, model))"""


def _pairs(model: str, names: list[str], columns: list[str], source: str) -> str:
    return " UNION ALL ".join(f"SELECT series_key, '{model}' AS model, '{n}' AS parameter, round({c}, 4) + 0.0 AS value FROM {source}"
                              for n, c in zip(names, columns))


@add("model_parameters", f"WITH RECURSIVE {ALL_HELD} {_pairs('holt_winters', ['alpha', 'beta', 'gamma'], ['a', 'b', 'g'], 'hw')} UNION ALL "
     f"{_pairs('arima', ['ar', 'ma'], ['f', 't'], 'ar')} UNION ALL "
     f"{_pairs('sarima', ['ar', 'ma', 'seasonal_ar', 'seasonal_ma'], ['f', 't', 'p', 'q'], 'sa')}")
def _(spark, d):
    fitted = forecasting.parameters(forecasting.training_part(durable(trading(spark, d))))
    return fitted.withColumn("value", F.round("value", 4) + 0.0)


@add("model_metrics", f"""WITH RECURSIVE {ALL_METRICS} SELECT series_key, model, days, round(mse, 2) AS mse, round(rmse, 4) AS rmse,
  round(mae, 4) AS mae, round(sigma, 4) AS sigma, round(coverage, 6) AS coverage FROM scores""")
def _(spark, d):
    rows = _rounded(outlook.hold_out(trading(spark, d)).metrics, "rmse", "mae", "sigma")
    return _rounded(_rounded(rows, "mse", places=2), "coverage", places=6)


@add("best_models", f"WITH RECURSIVE {ALL_METRICS} SELECT series_key, model, round(rmse, 4) AS rmse FROM best")
def _(spark, d):
    return _rounded(outlook.hold_out(trading(spark, d)).best, "rmse")


@add("error_by_segment", f"""WITH RECURSIVE {ALL_HELD}, s AS (SELECT *, ntile(5) OVER (PARTITION BY series_key, model ORDER BY step) AS segment FROM compared)
  SELECT series_key, model, segment, round(sqrt(avg(pow(actual - predicted, 2))), 4) AS rmse,
  round(avg(abs(actual - predicted)), 4) AS mae FROM s GROUP BY 1, 2, 3""")
def _(spark, d):
    return _rounded(outlook.hold_out(trading(spark, d)).by_segment, "rmse", "mae")


@add("forecast_30_days", f"""WITH RECURSIVE {ALL_AHEAD} SELECT series_key, model, step, strftime(ds, '%Y-%m-%d') AS ds, weekday_name,
  predicted, lower95, upper95, width, expected_closure FROM all_fc""")
def _(spark, d):
    return outlook.coming_days(outlook.hold_out(trading(spark, d)))


@add("forecast_csv", _SMOOTHED)
def _(spark, d):
    """The forecast table written as CSV, a folder per model, and read back with its types; the model comes from the folders."""
    path = f"{shared_folder(spark)}/forecast-{uuid.uuid4().hex}"
    rows = sinks.flat(_coming(spark, d))
    sinks.write_csv(rows, path, partition_by="model")
    return spark.read.option("header", True).schema(rows.schema).csv(path).select(*rows.columns)


BEST = f"{ALL_AHEAD}, chosen AS (SELECT all_fc.* FROM all_fc JOIN best USING (series_key, model))"
BEST_PLAN = f"{BEST}, {_plan_sql('chosen')}"


def _chosen(spark, d):
    """The coming days by each series' best model, on which plans rest."""
    held = outlook.hold_out(trading(spark, d))
    return outlook.best_forecast(outlook.coming_days(held), held.best)


@add("best_forecast_stock_plan", f"WITH RECURSIVE {BEST_PLAN} {_STOCK}")
def _(spark, d):
    return planning.stock_plan(_chosen(spark, d))


@add("closures_as_zero", f"""WITH RECURSIVE {BEST} SELECT series_key, strftime(ds, '%Y-%m-%d') AS ds,
  CASE WHEN expected_closure THEN 0 ELSE predicted END AS predicted, CASE WHEN expected_closure THEN 0 ELSE upper95 END AS upper95 FROM chosen""")
def _(spark, d):
    return planning.closures_as_zero(_chosen(spark, d)).select("series_key", "ds", "predicted", "upper95")


@add("operating_calendar", f"""WITH RECURSIVE {BEST_PLAN} SELECT series_key, strftime(ds, '%Y-%m-%d') AS ds, predicted,
  round(doubt, 3) AS relative_uncertainty, round(high_cut, 4) AS high_cut, round(low_cut, 4) AS low_cut,
  round(doubt_cut, 5) AS doubt_cut, is_peak, is_trough, is_volatile FROM marks""")
def _(spark, d):
    days = planning.operating_calendar(_chosen(spark, d))
    return _rounded(_rounded(days, "high_cut", "low_cut"), "doubt_cut", places=5).select(
        "series_key", "ds", "predicted", "relative_uncertainty", "high_cut", "low_cut", "doubt_cut",
        "is_peak", "is_trough", "is_volatile")


@add("key_days", f"""WITH RECURSIVE {BEST_PLAN}, r AS (SELECT *, row_number() OVER (PARTITION BY series_key ORDER BY predicted DESC, ds) AS hi,
  row_number() OVER (PARTITION BY series_key ORDER BY predicted, ds) AS lo FROM opened),
  e AS (SELECT *, 'top' AS "end", hi AS place FROM r WHERE hi <= 5 UNION ALL SELECT *, 'bottom', lo FROM r WHERE lo <= 5)
  SELECT series_key, "end", place, strftime(ds, '%Y-%m-%d') AS ds, weekday_name, predicted, lower95, upper95,
  round(predicted * 1.2, 2) AS stock FROM e""")
def _(spark, d):
    return planning.key_days(_chosen(spark, d))


@add("plan_totals", f"""WITH RECURSIVE {BEST_PLAN} SELECT series_key, count(*) AS open_days, round(sum(predicted), 2) AS total_predicted,
  round(avg(predicted), 2) AS mean_predicted, round(any_value(high_cut), 2) AS high_cut, round(any_value(low_cut), 2) AS low_cut,
  round(any_value(doubt_cut), 3) AS doubt_cut, count(*) FILTER (is_peak) AS peak_days, count(*) FILTER (is_trough) AS trough_days,
  count(*) FILTER (is_volatile) AS volatile_days, round(sum(predicted) FILTER (is_peak) * 1.2, 2) AS peak_stock,
  coalesce(string_agg(DISTINCT weekday_name, ',' ORDER BY weekday_name) FILTER (is_volatile), '') AS volatile_weekdays,
  count(DISTINCT weekday_name) FILTER (is_volatile) = 1 AS one_volatile_weekday FROM marks GROUP BY 1""")
def _(spark, d):
    return planning.plan_totals(_chosen(spark, d))


@add("figure_hold_out", f"""WITH RECURSIVE {ALL_HELD} SELECT series_key, model, strftime(ds, '%Y-%m-%d') AS ds, actual,
  round(predicted, 4) AS predicted FROM compared""")
def _(spark, d):
    return _rounded(charts.hold_out_lines(outlook.hold_out(trading(spark, d)).compared), "predicted")


@add("forecast_status", """WITH lengths AS (SELECT o_custkey AS series_key, count(DISTINCT CAST(o_orderdate AS DATE)) AS days FROM orders GROUP BY 1)
  SELECT CAST(series_key AS VARCHAR) AS series_key, model, days, CASE WHEN days < least_days THEN 'too_short' ELSE 'fitted' END AS status
  FROM lengths, (VALUES ('holt_winters', 12), ('arima', 24), ('sarima', 24)) m(model, least_days)""")
def _(spark, d):
    return forecasting.statuses(tables.customer_days(spark, d))


@add("rolling_origin_errors", f"""WITH RECURSIVE {TRAIN}, refreshed AS (
  SELECT series_key, a, b, g, cut AS step, level, trend, season FROM hw JOIN cuts USING (series_key)
  UNION ALL
  SELECT series_key, a, b, g, step + 1, moved, b * (moved - level) + (1 - b) * trend, list_append(season[2:], g * (y - (level + trend)) + (1 - g) * season[1])
  FROM (SELECT r.*, x.revenue AS y, r.a * (x.revenue - r.season[1]) + (1 - r.a) * (r.level + r.trend) AS moved
        FROM refreshed r JOIN ts x ON x.series_key = r.series_key AND x.step = r.step + 1)),
  judged AS (SELECT d.series_key, ts.step - d.step AS ahead, ts.revenue - (level + (ts.step - d.step) * trend + season[ts.step - d.step]) AS miss
    FROM refreshed d JOIN cuts USING (series_key) JOIN ts ON ts.series_key = d.series_key AND ts.step BETWEEN d.step + 1 AND d.step + 6 WHERE d.step <= n - 6)
  SELECT series_key, ahead, count(*) AS origins, round(sqrt(avg(miss * miss)), 4) AS rmse, round(avg(abs(miss)), 4) AS mae
  FROM judged GROUP BY 1, 2""")
def _(spark, d):
    return _rounded(forecasting.rolling_errors(forecasting.rolling_origin(durable(trading(spark, d)))), "rmse", "mae")


@add("figure_forecast", f"""WITH RECURSIVE {ALL_AHEAD}, recent AS (SELECT *, row_number() OVER (PARTITION BY series_key ORDER BY ds DESC) AS r FROM ts)
  SELECT series_key, 'history' AS line, strftime(ds, '%Y-%m-%d') AS ds, revenue AS value, NULL::DOUBLE AS lower95,
  NULL::DOUBLE AS upper95, false AS expected_closure FROM recent WHERE r <= 60
  UNION ALL SELECT series_key, model, strftime(ds, '%Y-%m-%d'), predicted, lower95, upper95, expected_closure FROM all_fc""")
def _(spark, d):
    held = outlook.hold_out(trading(spark, d))
    return charts.forecast_lines(held.series, outlook.coming_days(held))
