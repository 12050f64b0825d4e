import datetime as dt
import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.test_calendar import trading
from tillwright.functions import recursions
from tillwright.operators import evaluation, forecasting, stationarity
from tillwright.plans import outlook, planning


def seasonal(n, slope=0.0, noise=0.3, seed=5):
    rng = np.random.default_rng(seed)
    return [50 + slope * i + [0, 8, 6, 7, 9, 2][i % 6] + rng.normal(0, noise) for i in range(n)]


# -- unit root ----------------------------------------------------------------

def reference_adf(y):
    """The test spelled out with dense least squares."""
    y = np.asarray(y, dtype=float)
    dy, n = np.diff(y), len(y)
    cap = max(0, min(int(math.ceil(12 * (n / 100) ** 0.25)), n // 2 - 2))

    def fit(p, start):
        t = np.arange(start, len(dy))
        x = np.column_stack([np.ones(len(t)), y[t]] + [dy[t - i] for i in range(1, p + 1)])
        coef, *_ = np.linalg.lstsq(x, dy[t], rcond=None)
        rss = float(((dy[t] - x @ coef) ** 2).sum())
        return coef, rss, x, len(t)

    def aic(p):
        _, rss, _, m = fit(p, cap)
        return m * math.log(rss / m) + 2 * (p + 2)

    p = min(range(cap + 1), key=aic)
    coef, rss, x, m = fit(p, p)
    error = math.sqrt(rss / (m - p - 2) * np.linalg.inv(x.T @ x)[1, 1])
    return p, m, coef[1] / error


def test_unit_root_against_dense_least_squares(spark):
    rng = np.random.default_rng(1)
    walk = np.cumsum(rng.normal(size=150)) + 1000
    steady = [0.0]
    for e in rng.normal(size=320):
        steady.append(0.5 * steady[-1] + e)
    long = np.cumsum(rng.normal(size=5000))  # its length asks for 32 lags
    frame = trading(spark, walk, "walk").unionByName(trading(spark, steady, "steady")).unionByName(trading(spark, seasonal(90), "wave"))
    rows = {r.series_key: r for r in stationarity.adf(frame.unionByName(trading(spark, long, "long"))).collect()}
    for key, y in (("walk", walk), ("steady", steady), ("wave", seasonal(90)), ("long", long)):
        p, m, stat = reference_adf(y)
        assert (rows[key].lag_order, rows[key].n_obs) == (p, m)
        assert rows[key].adf_stat == pytest.approx(stat, rel=1e-8)
    assert not rows["walk"].stationary and rows["steady"].stationary
    verdicts = {(r.series_key, r.input): r.verdict for r in stationarity.verdicts(frame).collect()}
    assert verdicts["walk", "original"] == "difference_and_test_again" and verdicts["walk", "first_difference"] == "stationary"


def test_published_p_value_and_critical_value(spark):
    r = spark.range(1).select(stationarity.p_value(F.lit(-2.0143)).alias("p"),
                              stationarity._polynomial(1 / F.lit(304.0), stationarity.CRITICAL_5).alias("c")).first()
    assert r.p == pytest.approx(0.2803, abs=1e-4) and r.c == pytest.approx(-2.8711, abs=2e-4)


def test_constant_series_gives_no_verdict(spark):
    rows = stationarity.verdicts(trading(spark, [3.0] * 60)).collect()
    assert [(r.adf_stat, r.verdict) for r in rows if r.input == "original"] == [(None, "undetermined")]


def test_very_short_series_keep_their_row(spark):
    frame = trading(spark, [4.0], "1")
    for n in range(2, 7):
        frame = frame.unionByName(trading(spark, [4.0, 9.0, 5.0, 7.0, 2.0, 8.0][:n], str(n)))
    rows = {(r.series_key, r.input): r for r in stationarity.verdicts(frame).collect()}
    assert {k for k, i in rows if i == "original"} == set("123456")
    assert [rows[k, "original"].adf_stat is None for k in "123456"] == [True] * 3 + [False] * 3


# -- models -------------------------------------------------------------------

def smooth_by_hand(y, a, b, g):
    level, trend = sum(y[:6]) / 6, 0.0
    season, sse = [v - level for v in y[:6]], 0.0
    for t in range(6, len(y)):
        s = season[t % 6]
        sse += (y[t] - level - trend - s) ** 2
        moved = a * (y[t] - s) + (1 - a) * (level + trend)
        season[t % 6] = g * (y[t] - level - trend) + (1 - g) * s
        trend = b * (moved - level) + (1 - b) * trend
        level = moved
    return sse, level, trend, [season[(len(y) + i) % 6] for i in range(6)]


def test_smoothing_against_a_plain_search(spark):
    short, long = seasonal(40, 0.2), seasonal(75, -0.1, seed=9)
    frame = trading(spark, short, "short").unionByName(trading(spark, long, "long"))
    rows = {r.series_key: r.fit for r in forecasting.fit_smoothing(forecasting.histories(forecasting.whole(frame))).collect()}
    for key, y in (("short", short), ("long", long)):
        weights = min(recursions.SMOOTHING_COARSE.T.tolist(), key=lambda w: smooth_by_hand(y, *w)[0])
        for step in recursions.SMOOTHING_STEPS:
            tries = [[min(0.99, max(0.0, x + d)) for x, d in zip(weights, ds)] for ds in itertools.product([-step, 0.0, step], repeat=3)]
            least = min(smooth_by_hand(y, *w)[0] for w in tries)
            weights = next(w for w in tries if smooth_by_hand(y, *w)[0] <= least * (1 + 1e-9))
        sse, level, trend, season = smooth_by_hand(y, *weights)
        fit = rows[key]
        assert (fit.alpha, fit.beta, fit.gamma) == tuple(pytest.approx(w) for w in weights)
        assert (fit.sse, fit.level, fit.trend) == (pytest.approx(sse), pytest.approx(level), pytest.approx(trend))
        assert list(fit.season) == pytest.approx(season)


def shocks_by_hand(w, phi, theta, sphi, stheta):
    e = []
    at = lambda s, i: s[i] if i >= 0 else 0.0
    for t, x in enumerate(w):
        e.append(x - phi * at(w, t - 1) - sphi * (at(w, t - 6) - phi * at(w, t - 7))
                 - theta * at(e, t - 1) - stheta * (at(e, t - 6) + theta * at(e, t - 7)))
    return sum(v * v for v in e[7:]), e


@pytest.mark.parametrize("order", [forecasting.ARIMA, forecasting.SARIMA])
def test_arima_against_a_plain_recursion(spark, order):
    short, long = seasonal(60, 0.1), seasonal(90, seed=3)
    frame = trading(spark, short, "short").unionByName(trading(spark, long, "long"))
    past = forecasting.histories(forecasting.whole(frame, 9))
    fits = {r.series_key: r.fit for r in forecasting.fit_arima(past, order).collect()}
    paths = {}
    for r in forecasting.arima_rows(past, order).collect():
        paths.setdefault(r.series_key, {})[r.ahead] = (r.step, r.predicted)
    for key, y in (("short", short), ("long", long)):
        w = list(np.diff(y))
        if order.seasonal:
            w = list(np.array(w[6:]) - np.array(w[:-6]))
        f = fits[key]
        c = (f.ar, f.ma, f.seasonal_ar, f.seasonal_ma)
        sse, e = shocks_by_hand(w, *c)
        assert f.sse == pytest.approx(sse) and list(f.shocks) == pytest.approx(e[::-1][:7])
        coarse = min(shocks_by_hand(w, *g)[0] for g in recursions.ARIMA_COARSE[order.seasonal].T.tolist())
        assert f.sse <= coarse + 1e-9
        w, e, values = list(w), list(e), list(y)
        for h in range(1, 10):
            x = c[0] * w[-1] + c[2] * (w[-6] - c[0] * w[-7]) + c[1] * e[-1] + c[3] * (e[-6] + c[1] * e[-7])
            values.append(x + values[-1] + (values[-6] - values[-7] if order.seasonal else 0))
            w.append(x)
            e.append(0.0)
            assert paths[key][h] == (len(y) + h, pytest.approx(values[-1]))


def test_seasonal_models_win_on_seasonal_data(spark):
    series = trading(spark, seasonal(240, 0.05), "a").unionByName(trading(spark, seasonal(200, 0.0, seed=8), "b"))
    held = outlook.hold_out(series)
    rmse = {(r.series_key, r.model): r.rmse for r in held.metrics.collect()}
    for key in "ab":
        assert rmse[key, "holt_winters"] < rmse[key, "arima"] and rmse[key, "sarima"] < rmse[key, "arima"]
    assert {r.model for r in held.best.collect()} <= {"holt_winters", "sarima"}
    assert held.by_segment.count() == 2 * 3 * 5
    ahead = outlook.coming_days(held, horizon=30)
    assert ahead.count() == 2 * 3 * 30 and ahead.filter("lower95 < 0 OR upper95 < predicted").count() == 0
    assert outlook.best_forecast(ahead, held.best).count() == 60


def test_too_short_series_keep_their_rows(spark):
    frame = trading(spark, seasonal(60), "long").unionByName(trading(spark, [1.0, 2.0, 3.0], "short"))
    rows = forecasting.forecast_all(forecasting.whole(frame, 5)).collect()
    assert len(rows) == 2 * 3 * 5
    assert {r.series_key for r in rows if r.predicted is None} == {"short"}
    assert all(r.predicted is None for r in rows if r.series_key == "short")
    status = {(r.series_key, r.model): (r.days, r.status) for r in forecasting.statuses(frame).collect()}
    for model in ("holt_winters", "arima", "sarima"):
        assert status["long", model] == (60, "fitted") and status["short", model] == (3, "too_short")


@pytest.mark.parametrize("days", [1, 2, 6, 7, 14, 20])
def test_short_series_pass_through_hold_out_and_forecast(spark, days):
    frame = trading(spark, seasonal(120), "long").unionByName(trading(spark, seasonal(days), "short"))
    held = outlook.hold_out(frame)
    ahead = outlook.coming_days(held, horizon=5).collect()
    assert len([r for r in ahead if r.series_key == "short"]) == 15
    assert all(r.lower95 is None for r in ahead if r.predicted is None)
    assert {r.series_key for r in held.best.collect()} == ({"long", "short"} if days > 1 else {"long"})


def test_split_and_rolling_origin(spark):
    series = trading(spark, seasonal(103))
    counts = forecasting.split(series).groupBy("in_train").count().collect()
    assert {r.in_train: r["count"] for r in counts} == {True: 82, False: 21}
    y = seasonal(103)
    rolled = forecasting.rolling_origin(series, ahead=3)
    fit = forecasting.fit_smoothing(forecasting.histories(forecasting.training_part(series))).first().fit
    got = {(r.origin, r.ahead): r for r in rolled.collect()}
    assert set(got) == {(o, h) for o in range(82, 101) for h in (1, 2, 3)}  # every day of the hold-out with three more to come
    for origin in range(82, 101):  # the states of a run over the whole past with the same weights
        _, level, trend, season = smooth_by_hand(y[:origin], fit.alpha, fit.beta, fit.gamma)
        for h in (1, 2, 3):
            row = got[origin, h]
            assert (row.actual, row.predicted) == (pytest.approx(y[origin + h - 1]), pytest.approx(level + h * trend + season[h - 1]))
    assert forecasting.rolling_errors(rolled).count() == 3
    short = series.filter("step <= 9")
    assert forecasting.rolling_origin(short).count() == 0 == forecasting.rolling_origin(series.limit(0)).count()


def test_smoothing_search_reaches_a_dense_grid():
    pick, t = np.random.default_rng(0), np.arange(300)
    bends = [0.5 * t, np.cumsum(np.cumsum(pick.normal(0, 0.3, 300))), np.abs(t - 150) * 1.5, 50 * np.sin(t / 25)]
    rows = [500 + bend + 30 * np.sin(2 * np.pi * t / 6) + pick.normal(0, 10, 300) for bend in bends]
    found = recursions._smoothing_rows(rows)
    y, length = recursions._padded(rows)
    axis = list(np.linspace(0, 0.99, 23))
    grids = (recursions._grid([a], axis, axis) for a in axis)
    dense = np.min([recursions._smooth(y, length, np.repeat(g[:, None, :], len(rows), axis=1))[0].min(1) for g in grids], axis=0)
    assert (np.array(found["sse"]) <= dense * 1.001).all()
    assert max(found["beta"]) > 0.2  # weights between those of the first grid


def test_sigma_is_about_the_mean_error(spark):
    rows = [("s", "m", i, dt.date(2020, 1, i), 10.0 + i % 2, 7.0) for i in range(1, 9)]
    compared = spark.createDataFrame(rows, "series_key string, model string, step long, ds date, actual double, predicted double")
    r = evaluation.metrics(compared).first()
    assert r.sigma == pytest.approx(np.std([3 + i % 2 for i in range(1, 9)], ddof=1)) and r.sigma < r.rmse
    assert r.mae == pytest.approx(3.5) and r.mse == pytest.approx(12.5) and r.coverage == 0.0


# -- planning on the golden forecast -------------------------------------------

# Predictions of the golden table and its closures; all bands are 69,494.80 or .81 wide.
PREDICTED = [35260.49, 67738.13, 60538.26, 62341.43, 65394.26, 55748.51, 35255.73, 67733.37, 60533.5, 62336.67, 65389.5, 55743.75,
             35250.96, 67728.61, 60528.73, 62331.91, 65384.73, 55738.99, 35246.2, 67723.84, 60523.97, 62327.14, 65379.97, 55734.22,
             35241.44, 67719.08, 60519.21, 62322.38, 65375.21, 55729.46]
NARROW = {2, 3, 4, 5, 8, 9, 11, 12, 19, 23, 26, 27, 28, 29, 30}


@pytest.fixture()
def golden(spark):
    days = [d for d in (dt.date(2011, 12, 11) + dt.timedelta(i) for i in range(40)) if d.weekday() != 5][:30]
    rows = []
    for step, (day, p) in enumerate(zip(days, PREDICTED), start=1):
        width = 69494.80 if step in NARROW else 69494.81
        closed = dt.date(2011, 12, 25) <= day <= dt.date(2012, 1, 3)
        rows.append(("all", "holt_winters", step, day, day.strftime("%a"), p, round(p - width / 2, 2), round(p + width / 2, 2), width, closed))
    return spark.createDataFrame(rows, "series_key string, model string, step long, ds date, weekday_name string, predicted double, "
                                       "lower95 double, upper95 double, width double, expected_closure boolean")


def test_golden_plan(golden):
    assert golden.filter("expected_closure").count() == 9
    t = planning.plan_totals(golden).first()
    assert (t.open_days, t.peak_days, t.trough_days, t.volatile_days) == (21, 6, 6, 7)
    assert t.total_predicted == pytest.approx(1224361.71, abs=0.02) and t.mean_predicted == pytest.approx(58302.94, abs=0.01)
    assert (t.low_cut, t.high_cut, t.doubt_cut) == (55743.75, 65379.97, 1.247)
    assert t.peak_stock == pytest.approx(479225.17, abs=0.02)
    assert t.volatile_weekdays == "Fri,Sun" and not t.one_volatile_weekday


def test_golden_stock_plan(golden):
    plan = {str(r.ds): r for r in planning.stock_plan(golden).collect()}
    assert plan["2011-12-25"].rule == "closure" and plan["2011-12-25"].stock == 0.0
    assert plan["2011-12-23"].rule == "before_closure" and plan["2011-12-23"].stock == pytest.approx(55743.75 * 1.2, abs=0.01)
    assert plan["2011-12-12"].rule == "peak" and plan["2011-12-18"].rule == "volatile"
    assert plan["2011-12-18"].stock == pytest.approx(508.32, abs=0.02) and plan["2011-12-18"].cover == "two_days_of_cover"
    assert plan["2011-12-13"].rule == "normal" and plan["2011-12-13"].stock == 60538.26
    top = planning.key_days(golden).filter("end = 'top'").orderBy("place").collect()
    assert [str(r.ds) for r in top[:3]] == ["2011-12-12", "2011-12-19", "2012-01-09"] and top[0].stock == pytest.approx(81285.76)
    zeroed = planning.closures_as_zero(golden).filter("expected_closure").agg(F.max("predicted"), F.max("upper95")).first()
    assert tuple(zeroed) == (0.0, 0.0)
