import datetime as dt

import pytest
from pyspark.sql import functions as F

from tillwright.operators import anomalies, calendar, decomposition
from tillwright.plans import charts

SERIES = "series_key string, ds date, revenue double, line_count long"
# Days closed in the golden year (besides Saturdays).
CLOSED = ["2010-12-24", "2010-12-26", "2010-12-27", "2010-12-28", "2010-12-29", "2010-12-30", "2010-12-31", "2011-01-02", "2011-01-03",
          "2011-04-22", "2011-04-24", "2011-04-25", "2011-04-29", "2011-05-02", "2011-05-30", "2011-08-29"]


def golden_daily(spark):
    first, last = dt.date(2010, 12, 1), dt.date(2011, 12, 9)
    days = [first + dt.timedelta(i) for i in range((last - first).days + 1)]
    rows = [("all", d, 100.0 + d.day, 3) for d in days if d.weekday() != 5 and str(d) not in CLOSED]
    return spark.createDataFrame(rows, SERIES)


def trading(spark, values, key="s", start=dt.date(2011, 1, 2)):
    """A series on Sunday to Friday, numbered from 1."""
    rows, day = [], start
    for i, v in enumerate(values, start=1):
        while day.weekday() == 5:
            day += dt.timedelta(1)
        rows.append((key, day, float(v), i))
        day += dt.timedelta(1)
    return spark.createDataFrame(rows, "series_key string, ds date, revenue double, step long")


def test_golden_calendar(spark):
    days = calendar.classified(calendar.spine(golden_daily(spark)))
    span = calendar.span(days).first()
    assert (span.calendar_days, span.recorded_days, span.structural_days, span.closure_days) == (374, 305, 53, 16)
    series = calendar.trading_series(days)
    assert series.count() == 321 and series.agg(F.max("step")).first()[0] == 321
    assert {str(r.ds) for r in series.filter("revenue = 0").collect()} == set(CLOSED)
    profile = {r.weekday_name: (r.calendar_days, r.recorded_days) for r in calendar.weekday_profile(days).collect()}
    assert profile == {"Mon": (53, 47), "Tue": (53, 52), "Wed": (54, 53), "Thu": (54, 53), "Fri": (54, 50), "Sat": (53, 0), "Sun": (53, 50)}


def test_golden_upcoming_days(spark):
    series = calendar.trading_series(calendar.classified(calendar.spine(golden_daily(spark))))
    ahead = calendar.upcoming(series).orderBy("step").collect()
    assert len(ahead) == 30 and (str(ahead[0].ds), str(ahead[-1].ds)) == ("2011-12-11", "2012-01-13")
    assert not any(r.ds.weekday() == 5 for r in ahead) and ahead[-1].days_ahead == 35
    closed = {str(r.ds): r.closure_source for r in ahead if r.expected_closure}
    assert len(closed) == 9 and {d for d, s in closed.items() if s == "calendar"} == {"2011-12-25", "2012-01-01"}
    recent = calendar.upcoming(series, closure_lookback=200).filter("expected_closure").count()
    assert recent == 2  # only the fixed days are left


def test_spine_has_no_gap_and_keeps_series_apart(spark):
    rows = [("a", dt.date(2020, 1, 1), 1.0, 1), ("a", dt.date(2020, 1, 5), 2.0, 1), ("b", dt.date(2020, 3, 1), 3.0, 1)]
    days = calendar.spine(spark.createDataFrame(rows, SERIES)).orderBy("series_key", "ds").collect()
    assert [(r.series_key, r.ds.day, r.revenue) for r in days] == [
        ("a", 1, 1.0), ("a", 2, None), ("a", 3, None), ("a", 4, None), ("a", 5, 2.0), ("b", 1, 3.0)]


def two_seasons(n=321):
    # Each season is zero-mean over its even and over its odd phases, so the parts are identifiable.
    short = [3, -1, -3, 4, 0, -3]
    long = [2.0 * ((k // 2 * 5 % 13) - 6) / 3 for k in range(26)]
    return [100 + 0.05 * i + short[i % 6] + long[i % 26] for i in range(n)], short, long


def test_decomposition_adds_up_and_recovers_the_parts(spark):
    values, short, long = two_seasons()
    parts = decomposition.decompose(trading(spark, values)).orderBy("step").collect()
    for i, r in enumerate(parts):
        assert r.trend + r.season_short + r.season_long + r.resid == pytest.approx(r.revenue, abs=1e-9)
        if 40 <= i < 281:
            assert r.season_short == pytest.approx(short[i % 6], abs=0.25)
            assert r.season_long == pytest.approx(long[i % 26], abs=0.25)
            assert r.trend == pytest.approx(100 + 0.05 * i, abs=0.25)
    spread = decomposition.amplitudes(decomposition.decompose(trading(spark, values))).first()
    assert spread.short_amplitude == pytest.approx(7, abs=0.3)


def test_a_spike_is_an_outlier_and_a_closed_day_is_not(spark):
    values, *_ = two_seasons()
    values = [v + (i * 7919 % 13 - 6) / 20 for i, v in enumerate(values)]
    values[150], values[200] = values[150] + 8, 0.0
    decomposed = decomposition.decompose(trading(spark, values))
    found = {(r.kind, round(r.revenue, 2)) for r in anomalies.anomalies(decomposed).collect()}
    assert ("closure", 0.0) in found and ("seasonal_high", round(values[150], 2)) in found
    assert ("seasonal_low", 0.0) not in found
    marks = charts.anomaly_marks(decomposed)
    assert marks.count() == 321 and marks.filter("size(kinds) > 0").count() >= 2


def test_level_fence_leaves_zero_days_out(spark):
    series = trading(spark, [0, 10, 11, 12, 13, 100])
    rows = {r.kind: r.revenue for r in anomalies.level_outliers(series).collect()}
    assert rows == {"closure": 0.0, "peak": 100.0}
    assert anomalies.summary(series).first().level_fence == 13 + 1.5 * 2  # quartiles 11 and 13 of the five open days


def test_pattern_is_relative_to_the_weekday_mean(spark):
    series = trading(spark, [5, 10, 10, 10, 10, 10] * 4)
    rows = {(r.pattern, r.slot): r.percent_of_base for r in anomalies.weekday_month_pattern(series).collect()}
    assert rows["weekday", 6] == pytest.approx(50) and rows["weekday", 0] == pytest.approx(100)
    labels = {r.label for r in charts.pattern_bars(anomalies.weekday_month_pattern(series)).collect()}
    assert {"Sun", "Mon", "01"} <= labels
