import datetime as dt
import random
from collections import Counter, defaultdict
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillwright.operators import cleaning
from tillwright.operators.ordered import running_totals

SCHEMA = ("series_key string, invoice_no string, stock_code string, quantity int, invoice_ts timestamp, "
          "unit_price decimal(12,4), customer_id long")


def frame(spark, rows):
    """rows: (invoice, stock, quantity, time text, price, customer)"""
    def convert(r):
        ts = dt.datetime.fromisoformat(r[3]) if isinstance(r[3], str) else r[3]
        return ("all", r[0], r[1], r[2], ts, None if r[4] is None else Decimal(str(r[4])), r[5])

    return spark.createDataFrame([convert(r) for r in rows], SCHEMA)


def brute_force(rows):
    """Kept lines as a multiset, by the rule spelled out row by row."""
    need, taken, kept = Counter(), Counter(), []
    core = [r for r in rows if r[2] is not None and r[3] is not None and r[4] is not None]
    for inv, stock, q, _, price, cust in core:
        if inv.startswith("C") and cust is not None:
            need[cust, stock, price, abs(q)] += 1
    for r in sorted((r for r in core if not r[0].startswith("C") and r[2] > 0 and r[4] > 0), key=lambda r: (r[3], r[0])):
        key = (r[5], r[1], r[4], r[2])
        if r[5] is not None and taken[key] < need[key]:
            taken[key] += 1
        else:
            kept.append(r)
    return kept


CASES = [
    ("581483", "23843", 80995, "2011-12-09 09:15:00", 2.08, 16446), ("C581484", "23843", -80995, "2011-12-09 09:27:00", 2.08, 16446),
    ("541431", "23166", 74215, "2011-01-18 10:01:00", 1.04, 12346), ("C541433", "23166", -74215, "2011-01-18 10:17:00", 1.04, 12346),
    # two originals, one cancellation: the earlier goes
    ("1", "A", 5, "2011-02-01 10:00:00", 2, 7), ("2", "A", 5, "2011-02-02 10:00:00", 2, 7), ("C3", "A", -5, "2011-02-03 10:00:00", 2, 7),
    # anonymous cancellation: the original stays
    ("4", "B", 3, "2011-02-01 10:00:00", 1, None), ("C5", "B", -3, "2011-02-01 11:00:00", 1, None),
    # cancelled before it was bought: matched all the same
    ("C6", "D", -2, "2011-02-01 08:00:00", 4, 8), ("7", "D", 2, "2011-02-05 08:00:00", 4, 8),
    # write-off, sample, missing fields, two originals at one time
    ("8", "E", -9, "2011-02-01 08:00:00", 4, 8), ("9", "E", 9, "2011-02-01 08:00:00", 0, 8),
    ("10", "E", None, "2011-02-01 08:00:00", 4, 8), ("11", "E", 1, "2011-02-01 08:00:00", None, 8), ("12", "E", 1, None, 4, 8),
    ("13", "F", 1, "2011-02-07 08:00:00", 4, 9), ("14", "F", 1, "2011-02-07 08:00:00", 4, 9), ("C15", "F", -1, "2011-02-09 08:00:00", 4, 9),
]


def test_named_cases(spark):
    tx = frame(spark, CASES)
    kept = {r.invoice_no for r in cleaning.net_lines(tx).collect()}
    assert kept == {"2", "4", "14"}
    audit = cleaning.audit(cleaning.day_ledger(tx)).first()
    assert (audit.rows_in, audit.missing_core, audit.cancels, audit.matched_sales, audit.not_positive, audit.rows_kept) == (
        len(CASES), 3, 6, 5, 2, 3)
    assert float(audit.revenue_kept) == 10 + 3 + 4
    assert float(audit.revenue_removed) == pytest.approx(80995 * 2.08 + 74215 * 1.04 + 10 + 8 + 4)
    daily = {str(r.ds): r.revenue for r in cleaning.daily_revenue(cleaning.day_ledger(tx)).collect()}
    assert daily == {"2011-02-01": 3.0, "2011-02-02": 10.0, "2011-02-07": 4.0}


def random_log(seed, n, hot):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = (1, "S1", 2) if rng.random() < hot else (rng.choice([None, 1, 2, 3]), rng.choice("XY"), rng.choice([0, 1, 2]))
        cancel = rng.random() < 0.3
        quantity = rng.choice([1, 1, 2, -3]) if not cancel else -rng.choice([1, 1, 2])
        ts = dt.datetime(2011, 1, 1) + dt.timedelta(minutes=rng.randrange(0, 60 * 24 * 5, 7))
        rows.append((("C" if cancel else "") + str(rng.randrange(n // 2)), key[1], quantity, ts, key[2], key[0]))
    rows += [rows[0]] * 25  # a group of copies
    return rows


@pytest.mark.parametrize("seed,hot", [(1, 0.0), (2, 0.4), (3, 0.95)])
def test_against_brute_force(spark, seed, hot):
    rows = random_log(seed, 600, hot)
    expected = brute_force(rows)
    tx = frame(spark, rows).repartition(5)
    got = Counter()
    for r in cleaning.net_lines(tx).collect():
        got[r.invoice_no, r.stock_code, r.quantity, r.invoice_ts, int(r.unit_price), r.customer_id] += r.line_count
    assert got == Counter((r[0], r[1], r[2], r[3], r[4], r[5]) for r in expected)
    by_day = defaultdict(float)
    for r in expected:
        by_day[r[3].date()] += r[2] * r[4]
    daily = {r.ds: r.revenue for r in cleaning.daily_revenue(cleaning.day_ledger(tx)).collect()}
    assert daily == dict(by_day)
    audit = cleaning.audit(cleaning.day_ledger(tx)).first()
    assert audit.rows_in == len(rows) and audit.rows_kept == len(expected)


def test_series_never_match_each_other(spark):
    tx = frame(spark, [("1", "A", 5, "2011-02-01 10:00:00", 2, 7), ("C2", "A", -5, "2011-02-01 11:00:00", 2, 7)])
    apart = tx.withColumn("series_key", F.when(F.col("quantity") > 0, "a").otherwise("b"))
    assert cleaning.net_lines(tx).count() == 0 and cleaning.net_lines(apart).count() == 1
    assert cleaning.cancel_counts(tx).first().cancels == 1


def test_running_totals_with_null_keys(spark):
    rows = [(k, s, i, 1) for k in ("a", None) for s in (0, 1, 2) for i in range(4)]
    df = spark.createDataFrame(rows, "k string, slot int, i int, m int").repartition(3)
    out = running_totals(df, ["k"], "slot", ["i"], ["m"]).collect()
    assert len(out) == len(rows)
    assert all(r.m_before == r.slot * 4 + r.i and r.m_total == 12 for r in out)
