import decimal
import math

import pytest
from pyspark.sql import functions as F

from tillwright.functions.beta import beta_cdf, beta_quantile, beta_sf
from tillwright.functions.beta_tails import mass_above, mass_below
from tillwright.functions.scalars import ln_choose, ln_gamma, normal_cdf
from tillwright.operators import bayes


@pytest.fixture()
def pilot(spark):
    rows = spark.createDataFrame([("pilot", 200, 18)], "ad_id string, impressions long, clicks long")
    return rows.withColumn("sample_ctr", F.col("clicks") / F.col("impressions"))


def test_posterior(pilot):
    r = bayes.with_interval(bayes.with_interval(bayes.posterior(pilot)), which="prior").first()
    assert (r.alpha_post, r.beta_post) == (28, 382)
    assert (r.prior_mean, r.prior_sd) == (pytest.approx(0.047619, abs=1e-6), pytest.approx(0.014661, abs=1e-6))
    assert (r.post_mean, r.post_sd) == (pytest.approx(0.068293, abs=1e-6), pytest.approx(0.012442, abs=1e-6))
    assert (r.prior_lower, r.prior_upper) == (pytest.approx(0.02318, abs=1e-5), pytest.approx(0.08017, abs=1e-5))
    assert (r.post_lower, r.post_upper) == (pytest.approx(0.04597, abs=1e-5), pytest.approx(0.09460, abs=1e-5))
    assert r.weighted_mean == pytest.approx(r.post_mean) and r.weight_prior == pytest.approx(210 / 410)
    assert r.sd_reduction == pytest.approx(0.151, abs=1e-3)


def test_probabilities(pilot):
    post = bayes.posterior(pilot)
    assert bayes.mass_between(post, 0.02, 0.08, "prior").first().mass == pytest.approx(0.96450, abs=1e-5)
    above = {r.threshold: r.p_above for r in bayes.exceedance(post).collect()}
    assert (above[0.05], above[0.06], above[0.08]) == tuple(pytest.approx(v, abs=1e-5) for v in (0.94007, 0.73737, 0.17112))
    assert bayes.gated(post).first().decision == "roll_out"
    assert bayes.gated(post, at_least=0.95).first().decision == "hold"
    assert bayes.below_lower_bound(bayes.with_interval(post)).first().p_below_lower == pytest.approx(0.025, abs=1e-9)


def test_sensitivity_and_width(pilot):
    rows = {r.prior: (round(r.post_mean, 4), round(r.p_above, 4)) for r in bayes.prior_sensitivity(pilot).collect()}
    assert rows == {"main": (0.0683, 0.9401), "weak": (0.0833, 0.9822), "flat": (0.0941, 0.9939), "strong": (0.0614, 0.9022)}
    widths = {r.extra_impressions: round(r.projected_width, 5)
              for r in bayes.width_projection(bayes.with_interval(bayes.posterior(pilot))).collect()}
    assert widths == {0: 0.04863, 400: 0.0346, 1000: 0.02622, 2000: 0.02006}


def test_prior_by_moments(spark):
    past = spark.createDataFrame([(0.035,), (0.065,)], "sample_ctr double")
    r = bayes.prior_from_past(past).first()
    assert r.strength == pytest.approx(0.05 * 0.95 / r.sigma**2 - 1) and r.alpha == pytest.approx(0.05 * r.strength)
    assert r.alpha + r.beta == pytest.approx(r.strength)


def test_likelihood_and_curves(pilot):
    args = F.lit(0.09), F.lit(200), F.lit(18)
    r = pilot.select(bayes.likelihood(*args).alias("l"), bayes.log_likelihood(*args).alias("ll")).first()
    assert r.l == pytest.approx(0.0981126045, abs=1e-10) and r.ll == pytest.approx(math.log(0.0981126045), abs=1e-9)
    grid = bayes.curves(bayes.posterior(pilot))
    assert grid.count() == 500
    s = bayes.grid_summary(grid).first()
    assert s.mle == pytest.approx(0.09, abs=0.0002)
    assert (s.grid_lower, s.grid_upper) == (pytest.approx(0.04597, abs=5e-4), pytest.approx(0.09460, abs=5e-4))


def test_beta_functions_invert_and_rise(spark):
    params = [(1.0, 1.0), (2.5, 0.7), (28.0, 382.0), (5000.0, 9000.0), (2e6, 3e6)]
    df = spark.createDataFrame([(a, b, p) for a, b in params for p in (0.001, 0.025, 0.5, 0.975, 0.999)], "a double, b double, p double")
    rows = df.withColumn("x", beta_quantile(F.col("a"), F.col("b"), F.col("p"))).withColumn(
        "back", beta_cdf(F.col("a"), F.col("b"), F.col("x"))).orderBy("a", "p").collect()
    for r in rows:
        assert r.back == pytest.approx(r.p, abs=1e-8)
    for a in {r.a for r in rows}:
        xs = [r.x for r in rows if r.a == a]
        assert xs == sorted(xs)
    edge = spark.createDataFrame([(3.0, 4.0, 0.0), (3.0, 4.0, 1.0), (3.0, None, 0.5)], "a double, b double, x double")
    assert [r[0] for r in edge.select(beta_cdf(F.col("a"), F.col("b"), F.col("x"))).collect()][:2] == [0.0, 1.0]


def test_binomial_tail_equals_the_cdf(spark):
    a, b, x = 12, 30, 0.3
    n = a + b - 1
    tail = sum(math.comb(n, j) * x**j * (1 - x) ** (n - j) for j in range(a, n + 1))
    assert spark.range(1).select(beta_cdf(F.lit(a), F.lit(b), F.lit(x))).first()[0] == pytest.approx(tail, abs=1e-12)


def test_special_scalars(spark):
    row = spark.range(1).select(
        *[ln_gamma(F.lit(x)).alias(f"g{i}") for i, x in enumerate((0.5, 1.0, 3.7, 171.0, 1e7))],
        ln_choose(F.lit(200), F.lit(18)).alias("c"), normal_cdf(F.lit(-1.96)).alias("n"), normal_cdf(F.lit(1.0)).alias("m")).first()
    for i, x in enumerate((0.5, 1.0, 3.7, 171.0, 1e7)):
        assert row[f"g{i}"] == pytest.approx(math.lgamma(x), rel=1e-11, abs=1e-11)
    assert row.c == pytest.approx(math.log(math.comb(200, 18)))
    assert row.n == pytest.approx(0.0249979, abs=1e-6) and row.m == pytest.approx(0.8413447, abs=1e-6)


def test_sequential_blocks_of_a_hot_ad(spark):
    events = spark.range(5003).select(
        F.col("id").alias("event_id"),
        (F.timestamp_seconds(1_700_000_000 + F.col("id") * 37)).alias("ts"),
        F.when(F.col("id") % 50 == 0, "cold").otherwise("hot").alias("ad_id"),
        F.when(F.col("id") % 3 == 0, "click").otherwise("view").alias("event_type"),
    ).repartition(6)
    blocks = bayes.sequential(events).orderBy("ad_id", "block").collect()
    for ad in ("cold", "hot"):
        mine = [r for r in blocks if r.ad_id == ad]
        total = [i for i in range(5003) if (i % 50 == 0) == (ad == "cold")]
        assert [r.block for r in mine] == list(range(math.ceil(len(total) / 200)))
        a, b = bayes.PRIOR
        for r in mine:
            part = total[r.block * 200 : (r.block + 1) * 200]
            clicks = sum(i % 3 == 0 for i in part)
            assert (r.alpha_prior, r.beta_prior, r.impressions, r.clicks) == (a, b, len(part), clicks)
            a, b = a + clicks, b + len(part) - clicks
            assert (r.alpha_post, r.beta_post) == (a, b)


def test_edges_of_likelihood_and_prior(spark):
    rows = spark.createDataFrame([(10, 0), (10, 10)], "n long, z long")
    got = rows.select(bayes.log_likelihood(F.col("z") / F.col("n"), F.col("n"), F.col("z")).alias("l")).collect()
    assert [r.l for r in got] == pytest.approx([0.0, 0.0], abs=1e-9)
    same = spark.createDataFrame([(0.1,), (0.1,)], "sample_ctr double")
    assert bayes.prior_from_past(same).first().alpha is None


@pytest.mark.parametrize("n", [100, 10**4, 10**6, 10**8, 10**10])
def test_any_number_of_impressions(spark, n):
    """Cumulative shares, bounds and likelihood against the normal limit with its skewness term, and at 0 and all clicks."""
    rows = spark.createDataFrame([(f"{z}", n, z) for z in (0, n // 20, n)], "ad_id string, impressions long, clicks long").withColumn(
        "sample_ctr", F.col("clicks") / F.col("impressions"))
    post = bayes.with_interval(bayes.posterior(rows))
    a, b = F.col("alpha_post"), F.col("beta_post")
    got = {r.ad_id: r for r in post.select(
        "*", beta_cdf(a, b, F.col("post_lower")).alias("low"), beta_sf(a, b, F.col("post_upper")).alias("high"), beta_cdf(a, b, F.col("post_mean")).alias("mid"),
        bayes.log_likelihood(F.col("sample_ctr"), F.col("impressions"), F.col("clicks")).alias("ll")).collect()}
    for r in got.values():
        assert 0 < r.post_lower < r.post_mean < r.post_upper < 1
        assert (r.low, r.high) == (pytest.approx(0.025, abs=1e-6), pytest.approx(0.025, abs=1e-6))
    r = got[f"{n // 20}"]
    a, b = r.alpha_post, r.beta_post
    skew = 2 * (b - a) * math.sqrt(a + b + 1) / ((a + b + 2) * math.sqrt(a * b))
    assert r.mid == pytest.approx(0.5 + skew / 6 / math.sqrt(2 * math.pi), abs=2 * skew**3 + 1e-10)
    assert r.ll == pytest.approx(-0.5 * math.log(2 * math.pi * n * 0.05 * 0.95), abs=4 / n + 1e-9 if n > 100 else 0.05)
    assert got["0"].ll == got[f"{n}"].ll == 0
    near = bayes.grid_summary(bayes.curves(bayes.posterior(rows), spread=6.0)).collect()
    assert len(near) == 3
    for g in near:
        step = 12 * got[g.ad_id].post_sd / 499
        assert g.grid_lower == pytest.approx(got[g.ad_id].post_lower, abs=step) and g.grid_upper == pytest.approx(got[g.ad_id].post_upper, abs=step)


def test_small_upper_tails_keep_their_digits(spark):
    got = spark.range(1).select(beta_sf(F.lit(1.0), F.lit(50.0), F.lit(0.6)).alias("p")).first().p
    assert got == pytest.approx(0.4**50, rel=1e-10)


def posteriors():
    """Counts of 0 to 10^8 impressions at several rates under four priors, with rates around the mean and fixed ones."""
    for n in (0, 10, 100, 10_000, 1_000_000, 100_000_000):
        for share in (0, 0.0001, 0.05, 0.5, 1):
            for a0, b0 in ((10, 200), (1, 1), (0.5, 0.5), (25, 475)):
                a, b = a0 + int(n * share), b0 + n - int(n * share)
                mean, sd = a / (a + b), math.sqrt(a * b / ((a + b) ** 2 * (a + b + 1)))
                yield from ((float(a), float(b), x) for x in (0.05, 0.31, *(mean + d * sd for d in (-6, -1, 0, 0.5, 2, 8))) if 0 < x < 1)


def exact_tail(a: float, b: float, x: float) -> decimal.Decimal:
    """P(θ > x) for whole a and b as a binomial sum in sixty digits."""
    with decimal.localcontext(prec=60):
        n, rate = int(a + b - 1), decimal.Decimal(x)
        hit, miss, ways, total = rate.ln(), (1 - rate).ln(), decimal.Decimal(1), decimal.Decimal(0)
        for k in range(int(a)):
            total += ways * (hit * k + miss * (n - k)).exp()
            ways = ways * (n - k) / (k + 1)
        return total


def test_tails_on_the_jvm_are_exact(spark):
    cases = list(posteriors())
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i long, a double, b double, x double")
    cols = F.col("a"), F.col("b"), F.col("x")
    tails = df.withColumns({"below": mass_below(*cols), "above": mass_above(*cols)})
    assert "EvalPython" not in tails._jdf.queryExecution().toString()
    rows = tails.withColumn("udf", beta_sf(*cols)).orderBy("i").collect()
    summed = [(r, exact_tail(r.a, r.b, r.x)) for r in rows if r.a <= 25 and r.a % 1 == r.b % 1 == 0]
    assert len(summed) > 100
    assert max(abs(decimal.Decimal(r.above) - t) for r, t in summed) < 1e-12
    assert max(abs(1 - decimal.Decimal(r.below) - t) for r, t in summed) < 1e-12
    long_sums = [r for r in rows if r.a == 10_001 and r.b == 99_990_001]
    assert long_sums and max(abs(decimal.Decimal(r.above) - exact_tail(r.a, r.b, r.x)) for r in long_sums) < 1e-12
    # The UDFs lose digits where one parameter is far larger than the other: 1 - x has fewer digits than a small x.
    even = [abs(r.above - r.udf) for r in rows if max(r.a, r.b) <= 100 * min(r.a, r.b)]
    assert len(even) > 100 and max(even) < 2e-12
    assert max(abs(r.above - r.udf) for r in rows) < 2e-9
    small = [(r, t) for r, t in summed if 1e-250 < t < 1e-6]
    assert small and all(abs(decimal.Decimal(r.above) - t) < decimal.Decimal(1e-9) * t for r, t in small)


def test_tails_on_the_jvm_at_the_edges(spark):
    df = spark.createDataFrame([(3.0, 4.0, 0.0), (3.0, 4.0, 1.0), (3.0, 4.0, -1.0), (3.0, None, 0.5), (2e6, 3e6, 0.0), (2e6, 3e6, 1e-9)], "a double, b double, x double")
    cols = F.col("a"), F.col("b"), F.col("x")
    rows = df.select(mass_below(*cols).alias("below"), mass_above(*cols).alias("above")).collect()
    assert [(r.below, r.above) for r in rows] == [(0, 1), (1, 0), (0, 1), (None, None), (0, 1), (0, 1)]


def test_the_gate_runs_without_python(pilot):
    assert "EvalPython" not in bayes.gated(bayes.posterior(pilot))._jdf.queryExecution().toString()
