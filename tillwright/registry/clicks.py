"""Registered queries of the click-rate decisions."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tillwright.operators import bayes
from tillwright.registry.common import Registry
from tillwright.session import shared_folder
from tillwright.sources import tables
from tillwright.streaming import clicks as stream

registry = Registry()
add = registry.add

# Rates that suit the benchmark's events, where about half of all impressions are clicks.
RATES = [0.02, 0.05, 0.06, 0.08, 0.3, 0.35, 0.4, 0.45, 0.5, 0.55]
GATE = 0.31

TRIALS = """ev AS (SELECT event_id, ts, CAST(user_id % 10 AS VARCHAR) AS ad_id, event_type FROM events
  WHERE event_type IN ('view', 'click')),
trials AS (SELECT ad_id, count(*) AS impressions, count(*) FILTER (event_type = 'click') AS clicks FROM ev GROUP BY 1),
post AS (SELECT *, 10 + clicks AS a1, 200 + impressions - clicks AS b1 FROM trials)"""


def cdf(a: str, b: str, x: str) -> str:
    """Beta distribution function as a binomial tail (whole-number parameters)."""
    n = f"({a} + {b} - 1)"
    term = (f"exp(lgamma({n} + 1) - lgamma(j + 1) - lgamma({n} - j + 1) + j * ln({x}) + ({n} - j) * ln(1 - ({x})))")
    return f"list_sum(list_transform(range(CAST({a} AS BIGINT), CAST({n} AS BIGINT) + 1), lambda j: {term}))"


def intervals(source: str, keys: str) -> str:
    """Recursive bisection for both ends of the 95 % interval of Beta(a1, b1)."""
    return f"""bisect AS (
  SELECT {keys}, a1, b1, p, 0.0::DOUBLE AS lo, 1.0::DOUBLE AS hi, 0 AS i FROM {source}, (VALUES (0.025), (0.975)) t(p)
  UNION ALL SELECT {keys}, a1, b1, p, CASE WHEN f < p THEN (lo + hi) / 2 ELSE lo END,
    CASE WHEN f < p THEN hi ELSE (lo + hi) / 2 END, i + 1
  FROM (SELECT *, {cdf('a1', 'b1', '(lo + hi) / 2')} AS f FROM bisect WHERE i < 40)),
ci AS (SELECT {keys}, max((lo + hi) / 2) FILTER (p = 0.025) AS lower_end, max((lo + hi) / 2) FILTER (p = 0.975) AS upper_end
  FROM bisect WHERE i = 40 GROUP BY ALL)"""


def _trials(spark, d):
    return bayes.trials(tables.events(spark, d))


def _posterior(spark, d):
    return bayes.posterior(_trials(spark, d))


def _rounded(df, *names, places=6):
    return df.withColumns({n: F.round(n, places) for n in names})


@add("click_trials", f"WITH {TRIALS} SELECT ad_id, impressions, clicks, round(clicks / impressions, 6) AS sample_ctr FROM trials")
def _(spark, d):
    return _rounded(_trials(spark, d), "sample_ctr")


@add("click_posterior", f"""WITH {TRIALS}, m AS (SELECT *, 10.0::DOUBLE / 210 AS m0, a1 / (a1 + b1) AS m1,
  sqrt(10 * 200 / (210.0::DOUBLE * 210 * 211)) AS s0,
  sqrt(a1::DOUBLE * b1 / ((a1 + b1)::DOUBLE * (a1 + b1) * (a1 + b1 + 1))) AS s1 FROM post)
  SELECT ad_id, impressions, clicks, a1::DOUBLE AS alpha_post, b1::DOUBLE AS beta_post, round(m0, 6) AS prior_mean,
  round(s0, 6) AS prior_sd, round(m1, 6) AS post_mean, round(s1, 6) AS post_sd,
  round(210.0::DOUBLE / (210 + impressions), 6) AS weight_prior, round(impressions / (210 + impressions), 6) AS weight_data,
  round(m1, 6) AS weighted_mean, round(1 - s1 / s0, 6) AS sd_reduction FROM m""")
def _(spark, d):
    return _rounded(
        _posterior(spark, d).drop("sample_ctr", "alpha_prior", "beta_prior"),
        "prior_mean", "prior_sd", "post_mean", "post_sd", "weight_prior", "weight_data", "weighted_mean", "sd_reduction")


@add("click_interval", f"""WITH RECURSIVE {TRIALS}, {intervals('post', 'ad_id')}
  SELECT ad_id, round(lower_end, 6) AS post_lower, round(upper_end, 6) AS post_upper,
  round(upper_end - lower_end, 6) AS post_width, 0.025::DOUBLE AS p_below_lower FROM ci""")
def _(spark, d):
    bounds = bayes.below_lower_bound(bayes.with_interval(_posterior(spark, d)))
    return _rounded(bounds, "post_lower", "post_upper", "post_width", "p_below_lower").select(
        "ad_id", "post_lower", "post_upper", "post_width", "p_below_lower")


@add("click_rate_mass", f"WITH {TRIALS} SELECT ad_id, round({cdf('a1', 'b1', '0.4')} - {cdf('a1', 'b1', '0.3')}, 6) AS mass FROM post")
def _(spark, d):
    return _rounded(bayes.mass_between(_posterior(spark, d), 0.3, 0.4), "mass").select("ad_id", "mass")


@add("click_prior_interval", f"""WITH RECURSIVE {TRIALS}, prior AS (SELECT ad_id, 10 AS a1, 200 AS b1 FROM trials), {intervals('prior', 'ad_id')}
  SELECT ad_id, round(lower_end, 6) AS prior_lower, round(upper_end, 6) AS prior_upper, round(upper_end - lower_end, 6) AS prior_width FROM ci""")
def _(spark, d):
    bounds = bayes.with_interval(_posterior(spark, d), which="prior")
    return _rounded(bounds, "prior_lower", "prior_upper", "prior_width").select("ad_id", "prior_lower", "prior_upper", "prior_width")


@add("click_prior_mass", f"WITH {TRIALS} SELECT ad_id, round({cdf('10', '200', '0.08')} - {cdf('10', '200', '0.02')}, 6) AS mass FROM trials")
def _(spark, d):
    return _rounded(bayes.mass_between(_posterior(spark, d), 0.02, 0.08, "prior"), "mass").select("ad_id", "mass")


@add("click_exceedance", f"""WITH {TRIALS} SELECT ad_id, t::DOUBLE AS threshold, round(1 - {cdf('a1', 'b1', 't')}, 6) + 0.0 AS p_above
  FROM post, (SELECT unnest({RATES}) AS t)""")
def _(spark, d):
    rows = bayes.exceedance(_posterior(spark, d), RATES).select("ad_id", "threshold", "p_above")
    return rows.withColumn("p_above", F.round("p_above", 6) + 0.0)


@add("click_prior_sensitivity", f"""WITH RECURSIVE {TRIALS}, tries AS (SELECT ad_id, tag, a0, b0, a0 + clicks AS a1,
  b0 + impressions - clicks AS b1 FROM trials, (VALUES ('main', 10, 200), ('weak', 2, 38), ('flat', 1, 1), ('strong', 25, 475)) p(tag, a0, b0)),
  {intervals('tries', 'ad_id, tag')}
  SELECT ad_id, tag AS prior, (a0 + b0)::DOUBLE AS effective_n, round(a1 / (a1 + b1), 6) AS post_mean,
  round(lower_end, 6) AS post_lower, round(upper_end, 6) AS post_upper,
  round(1 - {cdf('a1', 'b1', '0.4')}, 6) AS p_above FROM tries JOIN ci USING (ad_id, tag)""")
def _(spark, d):
    rows = bayes.prior_sensitivity(_trials(spark, d), above=0.4)
    return _rounded(rows, "post_mean", "post_lower", "post_upper", "p_above").select(
        "ad_id", "prior", "effective_n", "post_mean", "post_lower", "post_upper", "p_above")


@add("click_prior_by_moments", f"""WITH {TRIALS}, m AS (SELECT avg(clicks / impressions) AS mu, stddev_samp(clicks / impressions) AS sigma FROM trials)
  SELECT round(mu, 6) AS mu, round(sigma, 6) AS sigma, round(mu * (1 - mu) / (sigma * sigma) - 1, 3) AS strength,
  round(mu * (mu * (1 - mu) / (sigma * sigma) - 1), 3) AS alpha,
  round((1 - mu) * (mu * (1 - mu) / (sigma * sigma) - 1), 3) AS beta FROM m""")
def _(spark, d):
    return _rounded(_rounded(bayes.prior_from_past(_trials(spark, d)), "mu", "sigma"), "strength", "alpha", "beta", places=3)


@add("click_width_projection", f"""WITH RECURSIVE {TRIALS}, {intervals('post', 'ad_id')}
  SELECT ad_id, CAST(m AS BIGINT) AS extra_impressions,
  round((upper_end - lower_end) * sqrt((a1 + b1) / (a1 + b1 + m)), 6) AS projected_width
  FROM ci JOIN post USING (ad_id), (SELECT unnest([0, 400, 1000, 2000]) AS m)""")
def _(spark, d):
    rows = bayes.width_projection(bayes.with_interval(_posterior(spark, d)))
    return _rounded(rows, "projected_width").select("ad_id", "extra_impressions", "projected_width")


@add("click_gate", f"""WITH {TRIALS}, g AS (SELECT ad_id, 1 - {cdf('a1', 'b1', str(GATE))} AS p FROM post)
  SELECT ad_id, round(p, 6) AS p_above, CASE WHEN p >= 0.9 THEN 'roll_out' ELSE 'hold' END AS decision FROM g""")
def _(spark, d):
    return _rounded(bayes.gated(_posterior(spark, d), above=GATE).select("ad_id", "p_above", "decision"), "p_above")


GRID = f"""{TRIALS}, grid AS (SELECT *, 0.001 + k * (0.998 / 499) AS theta FROM post, (SELECT unnest(range(500)) AS k)),
dens AS (SELECT ad_id, k, theta,
  exp(lgamma(210) - lgamma(10) - lgamma(200) + 9 * ln(theta) + 199 * ln(1 - theta)) AS prior_density,
  exp(lgamma(impressions + 1) - lgamma(clicks + 1) - lgamma(impressions - clicks + 1) + clicks * ln(theta)
      + (impressions - clicks) * ln(1 - theta)) AS likelihood,
  exp(lgamma(a1 + b1) - lgamma(a1) - lgamma(b1) + (a1 - 1) * ln(theta) + (b1 - 1) * ln(1 - theta)) AS post_density FROM grid),
{intervals('post', 'ad_id')},
curve AS (SELECT *, sum(post_density) OVER (PARTITION BY ad_id ORDER BY k) / sum(post_density) OVER (PARTITION BY ad_id) AS share,
  theta BETWEEN lower_end AND upper_end AS inside FROM dens JOIN (SELECT ad_id, lower_end, upper_end FROM ci) USING (ad_id))"""


@add("figure_click_curves", f"""WITH RECURSIVE {GRID} SELECT ad_id, k AS point, round(theta, 6) AS theta, round(prior_density, 6) AS prior_density,
  round(likelihood, 8) AS likelihood, round(post_density, 6) AS post_density, round(share, 6) AS cumulative,
  inside AS in_interval FROM curve""")
def _(spark, d):
    rows = bayes.curves(_posterior(spark, d), high=0.999)
    return _rounded(rows, "theta", "prior_density", "post_density", "cumulative").withColumn("likelihood", F.round("likelihood", 8))


@add("click_grid_summary", f"""WITH RECURSIVE {GRID} SELECT ad_id, round(min(theta) FILTER (inside), 6) AS grid_lower,
  round(max(theta) FILTER (inside), 6) AS grid_upper, round(first(theta ORDER BY round(likelihood, 12) DESC, theta), 6) AS mle
  FROM curve GROUP BY 1""")
def _(spark, d):
    return _rounded(bayes.grid_summary(bayes.curves(_posterior(spark, d), high=0.999)), "grid_lower", "grid_upper", "mle")


@add("click_log_likelihood", f"""WITH {TRIALS}, l AS (SELECT ad_id, lgamma(impressions + 1) - lgamma(clicks + 1) - lgamma(impressions - clicks + 1)
  + CASE WHEN clicks = 0 THEN 0 ELSE clicks * ln(clicks / impressions) END
  + CASE WHEN clicks = impressions THEN 0 ELSE (impressions - clicks) * ln(1 - clicks / impressions) END AS ll FROM trials)
  SELECT ad_id, round(ll, 6) AS log_likelihood, round(exp(ll), 8) AS likelihood FROM l""")
def _(spark, d):
    args = F.col("sample_ctr"), F.col("impressions"), F.col("clicks")
    return _trials(spark, d).select("ad_id", F.round(bayes.log_likelihood(*args), 6).alias("log_likelihood"),
                                    F.round(bayes.likelihood(*args), 8).alias("likelihood"))


ORACLE_SEQUENTIAL = f"""WITH {TRIALS}, o AS (SELECT *, row_number() OVER (PARTITION BY ad_id ORDER BY ts, event_id) - 1 AS k FROM ev),
  b AS (SELECT ad_id, k // 200 AS block, count(*) AS impressions, count(*) FILTER (event_type = 'click') AS clicks FROM o GROUP BY 1, 2),
  c AS (SELECT *, sum(impressions) OVER w AS n, sum(clicks) OVER w AS z FROM b WINDOW w AS (PARTITION BY ad_id ORDER BY block))
  SELECT ad_id, block, impressions, clicks, CAST(n AS BIGINT) AS impressions_so_far, CAST(z AS BIGINT) AS clicks_so_far,
  CAST(10 + z - clicks AS DOUBLE) AS alpha_prior, CAST(200 + n - impressions - z + clicks AS DOUBLE) AS beta_prior,
  CAST(10 + z AS DOUBLE) AS alpha_post, CAST(200 + n - z AS DOUBLE) AS beta_post, round((10 + z) / (210 + n), 6) AS post_mean FROM c"""


@add("click_sequential", ORACLE_SEQUENTIAL)
def _(spark, d):
    return _rounded(bayes.sequential(tables.events(spark, d)), "post_mean")


STREAMED = f"""WITH {TRIALS} SELECT ad_id, impressions, clicks, CAST(a1 AS DOUBLE) AS alpha_post,
  CAST(b1 AS DOUBLE) AS beta_post, round(a1 / (a1 + b1), 6) AS post_mean,
  CASE WHEN 1 - {cdf('a1', 'b1', str(GATE))} >= 0.9 THEN 'roll_out' ELSE 'hold' END AS decision FROM post"""


def _decisions(spark, counts, run):
    stream.start(counts, f"{run}/out", f"{run}/state", available_now=True, above=GATE).awaitTermination()
    return _rounded(stream.latest(spark, f"{run}/out"), "post_mean").drop("post_sd", "p_above")


@add("click_stream", STREAMED)
def _(spark, d):
    """The events read as a stream to its end, then the newest decision per ad.

    The path is a pattern because a stream of files takes a folder or a
    pattern, and the table may be one file. Events are unique here, so there
    is no watermark that could turn away old files of a backfill.
    """
    run = f"{shared_folder(spark)}/click_stream-{uuid.uuid4().hex}"
    schema = tables.parquet(spark, d, "events").schema
    events = stream.event_stream(spark, f"{d}/events.parque[t]", schema).filter(F.col("event_type").isin("view", "click"))
    events = events.withColumn("ad_id", (F.col("user_id") % 10).cast("string"))
    counts = stream.running_trials(events)
    return _decisions(spark, counts, run)


@add("click_stream_redelivered", STREAMED)
def _(spark, d):
    """All events delivered twice and out of order, a slot apart; the watermark covers the delay, so each counts once and none is turned away."""
    run = f"{shared_folder(spark)}/click_stream-{uuid.uuid4().hex}"
    rows = tables.events(spark, d)
    delay = stream.deliver(rows, f"{run}/in", slots=4, again=True)
    events = stream.event_stream(spark, f"{run}/in", rows.schema, files_per_batch=4)
    return _decisions(spark, stream.running_trials(events, duplicates_within=delay), run)


@add("click_sequential_stream", ORACLE_SEQUENTIAL)
def _(spark, d):
    """Half of the events, then the other half after a restart from the checkpoint."""
    run = f"{shared_folder(spark)}/click_blocks-{uuid.uuid4().hex}"
    rows = tables.events(spark, d)
    for first, last in ((0, 2), (2, 4)):
        stream.deliver(rows, f"{run}/in", slots=4, first=first, last=last)
        blocks = stream.posterior_blocks(stream.event_stream(spark, f"{run}/in", rows.schema, files_per_batch=4))
        stream.run_blocks(blocks, f"{run}/out", f"{run}/state")
    return _rounded(stream.block_posteriors(spark, f"{run}/out"), "post_mean")
