"""Click-rate decisions by Beta-Binomial updating.

Events are reduced to one row per ad first; everything after is arithmetic on
those rows. Priors, thresholds and grids are short literal lists and are
attached by ``explode``, so there is no join at all.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tillwright.functions.beta import beta_cdf, beta_quantile
from tillwright.functions.beta_tails import mass_above, mass_below
from tillwright.functions.scalars import ln_binomial, rate
from tillwright.operators.ordered import running_totals

# The main prior, the alternatives, the click-rate thresholds and the rollout rule.
PRIOR = (10.0, 200.0)
PRIORS = [("main", 10.0, 200.0), ("weak", 2.0, 38.0), ("flat", 1.0, 1.0), ("strong", 25.0, 475.0)]
THRESHOLDS = [0.02, 0.05, 0.06, 0.08]
GATE_RATE, GATE_PROBABILITY = 0.05, 0.90
EXTRA_IMPRESSIONS = [0, 400, 1000, 2000]
BLOCK = 200


def trials(events: DataFrame) -> DataFrame:
    """Impressions, clicks and sample rate per ad.

    A click implies an impression, so both event types count as one.
    """
    clicked = F.col("event_type") == "click"
    counts = events.groupBy("ad_id").agg(
        F.count_if(clicked | (F.col("event_type") == "view")).alias("impressions"),
        F.count_if(clicked).alias("clicks"),
    )
    return counts.withColumn("sample_ctr", rate(F.col("clicks"), F.col("impressions")))


def beta_mean(a: Column, b: Column) -> Column:
    return a / (a + b)


def beta_sd(a: Column, b: Column) -> Column:
    return F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))


def updated(df: DataFrame, alpha: Column, beta: Column) -> DataFrame:
    """Adds prior and posterior parameters for a prior Beta(alpha, beta)."""
    return df.withColumns({"alpha_prior": alpha.cast("double"), "beta_prior": beta.cast("double")}).withColumns({
        "alpha_post": F.col("alpha_prior") + F.col("clicks"),
        "beta_post": F.col("beta_prior") + F.col("impressions") - F.col("clicks"),
    })


def posterior(df: DataFrame, prior: tuple[float, float] = PRIOR) -> DataFrame:
    """Posterior per trial: moments, shrinkage weights and what the data added."""
    out = updated(df, F.lit(prior[0]), F.lit(prior[1]))
    a0, b0, a1, b1 = (F.col(c) for c in ("alpha_prior", "beta_prior", "alpha_post", "beta_post"))
    out = out.withColumns({
        "prior_mean": beta_mean(a0, b0), "prior_sd": beta_sd(a0, b0),
        "post_mean": beta_mean(a1, b1), "post_sd": beta_sd(a1, b1),
        "weight_prior": (a0 + b0) / (a0 + b0 + F.col("impressions")),
        "weight_data": F.col("impressions") / (a0 + b0 + F.col("impressions")),
    })
    sample = F.coalesce(rate(F.col("clicks"), F.col("impressions")), F.lit(0.0))
    return out.withColumns({
        "weighted_mean": F.col("weight_prior") * F.col("prior_mean") + F.col("weight_data") * sample,
        "sd_reduction": 1 - F.col("post_sd") / F.col("prior_sd"),
    })


def with_interval(df: DataFrame, level: float = 0.95, which: str = "post") -> DataFrame:
    """Adds the equal-tail interval of the prior or posterior and its width."""
    a, b, tail = F.col(f"alpha_{which}"), F.col(f"beta_{which}"), (1 - level) / 2
    return df.withColumns({
        f"{which}_lower": beta_quantile(a, b, F.lit(tail)),
        f"{which}_upper": beta_quantile(a, b, F.lit(1 - tail)),
    }).withColumn(f"{which}_width", F.col(f"{which}_upper") - F.col(f"{which}_lower"))


def mass_between(df: DataFrame, low: float, high: float, which: str = "post") -> DataFrame:
    """Adds the probability that the rate lies in [low, high]."""
    a, b = F.col(f"alpha_{which}"), F.col(f"beta_{which}")
    return df.withColumn("mass", mass_below(a, b, F.lit(high)) - mass_below(a, b, F.lit(low)))


def exceedance(df: DataFrame, thresholds: Sequence[float] = THRESHOLDS) -> DataFrame:
    """One row per trial and threshold with P(θ > threshold)."""
    each = F.explode(F.array(*[F.lit(float(t)) for t in thresholds]))
    out = df.withColumn("threshold", each)
    return out.withColumn("p_above", mass_above(F.col("alpha_post"), F.col("beta_post"), F.col("threshold")))


def below_lower_bound(interval: DataFrame) -> DataFrame:
    """Adds P(θ < lower interval bound), which is the tail the interval left out."""
    return interval.withColumn(
        "p_below_lower", beta_cdf(F.col("alpha_post"), F.col("beta_post"), F.col("post_lower"))
    )


def gated(df: DataFrame, above: float = GATE_RATE, at_least: float = GATE_PROBABILITY) -> DataFrame:
    """Adds P(θ > above) and the rollout decision."""
    p = mass_above(F.col("alpha_post"), F.col("beta_post"), F.lit(above))
    return df.withColumn("p_above", p).withColumn(
        "decision", F.when(F.col("p_above") >= at_least, "roll_out").otherwise("hold")
    )


def prior_sensitivity(df: DataFrame, priors: Sequence[tuple[str, float, float]] = PRIORS,
                      above: float = GATE_RATE) -> DataFrame:
    """Posterior mean, interval and P(θ > above) of each trial under each prior."""
    each = F.explode(F.array(*[
        F.struct(F.lit(tag).alias("tag"), F.lit(a).alias("a"), F.lit(b).alias("b")) for tag, a, b in priors
    ]))
    crossed = df.withColumn("_p", each)
    out = updated(crossed, F.col("_p.a"), F.col("_p.b")).withColumns({
        "prior": F.col("_p.tag"), "effective_n": F.col("_p.a") + F.col("_p.b"),
    }).drop("_p")
    out = with_interval(out.withColumn("post_mean", beta_mean(F.col("alpha_post"), F.col("beta_post"))))
    return out.withColumn("p_above", mass_above(F.col("alpha_post"), F.col("beta_post"), F.lit(above)))


def prior_from_past(df: DataFrame) -> DataFrame:
    """A prior by moments from the sample rates of past trials: one row."""
    moments = df.agg(F.avg("sample_ctr").alias("mu"), F.stddev_samp("sample_ctr").alias("sigma"))
    n = F.try_divide(F.col("mu") * (1 - F.col("mu")), F.col("sigma") * F.col("sigma")) - 1  # NULL if all rates are equal
    return moments.withColumn("strength", n).withColumns({
        "alpha": F.col("mu") * F.col("strength"), "beta": (1 - F.col("mu")) * F.col("strength"),
    })


def width_projection(interval: DataFrame, extra: Sequence[int] = EXTRA_IMPRESSIONS) -> DataFrame:
    """Expected interval width after more impressions, shrinking with √N."""
    n = F.col("alpha_post") + F.col("beta_post")
    each = F.explode(F.array(*[F.lit(m) for m in extra]))
    out = interval.withColumn("extra_impressions", each)
    return out.withColumn("projected_width", F.col("post_width") * F.sqrt(n / (n + F.col("extra_impressions"))))


def log_likelihood(theta: Column, n: Column, z: Column) -> Column:
    """ln P(z clicks in n impressions | θ), in log space throughout; 0 · ln 0 counts as 0."""
    return ln_binomial(theta, n, z)


def likelihood(theta: Column, n: Column, z: Column) -> Column:
    return F.exp(log_likelihood(theta, n, z))


def ln_beta_density(theta: Column, a: Column, b: Column) -> Column:
    return ln_binomial(theta, a + b, a) + F.ln(a * b / (a + b)) - F.ln(theta) - F.log1p(-theta)


def beta_density(theta: Column, a: Column, b: Column) -> Column:
    return F.exp(ln_beta_density(theta, a, b))


def curves(post: DataFrame, low: float = 0.001, high: float = 0.20, points: int = 500, spread: float | None = None) -> DataFrame:
    """Prior, likelihood and posterior on an even grid of rates, per ad.

    ``spread`` centres an ad's grid on its posterior mean, that many standard
    deviations to each side (inside 0 and 1): a narrow posterior falls between
    the points of a fixed grid. ``cumulative`` is the normalised running sum of
    the posterior; ``in_interval`` marks its central 95 % by the quantiles.
    """
    a, b = F.col("alpha_post"), F.col("beta_post")
    first, last = F.lit(low), F.lit(high)
    if spread is not None:
        first = F.greatest(beta_mean(a, b) - spread * beta_sd(a, b), beta_mean(a, b) * 1e-3)
        last = F.least(beta_mean(a, b) + spread * beta_sd(a, b), 1 - beta_mean(b, a) * 1e-3)
    bounds = with_interval(post).withColumns({"_first": first, "_last": last})
    grid = bounds.withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
    grid = grid.withColumn("theta", F.col("_first") + F.col("point") * ((F.col("_last") - F.col("_first")) / (points - 1)))
    x = F.col("theta")
    grid = grid.withColumns({
        "prior_density": beta_density(x, F.col("alpha_prior"), F.col("beta_prior")),
        "likelihood": likelihood(x, F.col("impressions"), F.col("clicks")),
        "_ln_post": ln_beta_density(x, a, b),
    })
    ad = Window.partitionBy("ad_id").orderBy("point")
    running = ad.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = ad.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # Against the highest point, so that a sum of densities is never 0.
    grid = grid.withColumn("_part", F.exp(F.col("_ln_post") - F.max("_ln_post").over(whole)))
    share = F.try_divide(F.sum("_part").over(running), F.sum("_part").over(whole))
    return grid.withColumn("cumulative", share).select(
        "ad_id", "point", "theta", "prior_density", "likelihood", F.exp("_ln_post").alias("post_density"), "cumulative",
        F.col("theta").between(F.col("post_lower"), F.col("post_upper")).alias("in_interval"),
    )


def grid_summary(grid: DataFrame) -> DataFrame:
    """Grid interval and the rate of highest likelihood per ad, the smaller one on a tie."""
    height = F.struct(F.round("likelihood", 12), -F.col("theta"))
    return grid.groupBy("ad_id").agg(
        F.min(F.when(F.col("in_interval"), F.col("theta"))).alias("grid_lower"),
        F.max(F.when(F.col("in_interval"), F.col("theta"))).alias("grid_upper"),
        F.max_by(F.col("theta"), height).alias("mle"),
    )


def sequential(events: DataFrame, block: int = BLOCK, prior: tuple[float, float] = PRIOR,
               slot: str = "HOUR") -> DataFrame:
    """The posterior after every ``block`` impressions of an ad, in event order.

    Each block starts from the posterior of the block before. An ad's events
    are numbered through time slots, so a hot ad is not one task's work; longer
    slots mean fewer slot totals where most ads are cold.
    """
    rows = events.select(
        "ad_id", "ts", "event_id", F.date_trunc(slot, "ts").alias("slot"),
        F.lit(1).alias("impression"), (F.col("event_type") == "click").cast("int").alias("click"),
    )
    numbered = running_totals(rows, ["ad_id"], "slot", ["ts", "event_id"], ["impression", "click"])
    blocks = numbered.groupBy("ad_id", F.floor(F.col("impression_before") / block).alias("block")).agg(
        F.count("*").alias("impressions"),
        F.sum("click").alias("clicks"),
        F.max(F.col("impression_before") + 1).alias("impressions_so_far"),
        F.max(F.col("click_before") + F.col("click")).alias("clicks_so_far"),
    )
    return block_posteriors(blocks, prior)


def block_posteriors(blocks: DataFrame, prior: tuple[float, float] = PRIOR) -> DataFrame:
    """Blocks with the posterior of the block before as prior, and their own."""
    a = prior[0] + F.col("clicks_so_far") - F.col("clicks")
    n = F.col("impressions_so_far") - F.col("impressions")
    b = prior[1] + n - (F.col("clicks_so_far") - F.col("clicks"))
    return updated(blocks, a, b).withColumn("post_mean", beta_mean(F.col("alpha_post"), F.col("beta_post")))
