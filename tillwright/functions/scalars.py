"""Column expressions shared by the reports."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Weekday labels, Monday first.
WEEKDAYS = ["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"]


def rate(numerator: Column, denominator: Column) -> Column:
    """Quotient as a double, NULL when the denominator is 0."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def rate_or_zero(numerator: Column, denominator: Column) -> Column:
    return F.coalesce(rate(numerator, denominator), F.lit(0.0))


def gross_profit(amount: Column, unit_cost: Column, units: Column) -> Column:
    return amount - unit_cost * units


def weekday_label(day: Column) -> Column:
    return F.element_at(F.array(*[F.lit(d) for d in WEEKDAYS]), F.weekday(day) + 1)


def two_decimals(value: Column) -> Column:
    """Fixed two-place text, for display only."""
    return F.format_string("%.2f", value.cast("double"))


def percent_of(value: Column, base: Column) -> Column:
    return rate(value, base) * 100


def floor_at_zero(value: Column) -> Column:
    return F.greatest(value, F.lit(0.0))


def ln_gamma(x: Column) -> Column:
    """Log-gamma for x > 0: Stirling's series after shifting x up by eight."""
    z = x + 8.0
    shift = x
    for k in range(1, 8):
        shift = shift * (x + float(k))
    tail = 1 / (12 * z) - 1 / (360 * F.pow(z, 3)) + 1 / (1260 * F.pow(z, 5)) - 1 / (1680 * F.pow(z, 7))
    return (z - 0.5) * F.ln(z) - z + 0.5 * F.ln(2 * F.pi()) + tail - F.ln(shift)


def _stirling_rest(x: Column) -> Column:
    """ln Γ(x + 1) less Stirling's formula for it, for x > 0."""
    z = F.greatest(x, F.lit(16.0))
    series = (1 / 12 - (1 / 360 - (1 / 1260 - 1 / (1680 * z * z)) / (z * z)) / (z * z)) / z
    return F.when(x >= 16, series).otherwise(ln_gamma(x + 1) - (x + 0.5) * F.ln(x) + x - 0.5 * F.ln(2 * F.pi()))


def _deviance(x: Column, expected: Column) -> Column:
    """x · ln(x / expected) + expected - x, without cancellation where x is near ``expected``."""
    e = F.try_divide(x - expected, expected)
    near = F.lit(1 / 56)
    for k in range(7, 1, -1):
        near = F.lit(1.0 / (k * (k - 1))) - e * near
    return F.when(F.abs(e) < 0.01, expected * e * e * near).otherwise(x * F.ln(F.try_divide(x, expected)) + expected - x)


def ln_binomial(theta: Column, n: Column, k: Column) -> Column:
    """ln of C(n, k) · θ^k · (1 - θ)^(n - k), also for n and k that are no whole numbers; 0 · ln 0 counts as 0."""
    n, k = n.cast("double"), k.cast("double")
    inner = (
        _stirling_rest(n) - _stirling_rest(k) - _stirling_rest(n - k) - _deviance(k, n * theta) - _deviance(n - k, n * (1 - theta))
        + 0.5 * (F.ln(F.try_divide(n, k * (n - k))) - F.ln(2 * F.pi()))
    )
    none, every = F.when(n == 0, 0.0).otherwise(n * F.log1p(-theta)), F.when(n == 0, 0.0).otherwise(n * F.ln(theta))
    return F.when(k == 0, none).when(k == n, every).otherwise(inner)


def ln_choose(n: Column, k: Column) -> Column:
    """ln C(n, k): the binomial probability at θ = k / n without its powers."""
    n, k = n.cast("double"), k.cast("double")
    share = F.try_divide(k, n)
    powers = k * F.ln(share) + (n - k) * F.log1p(-share)
    return F.when((k == 0) | (k == n), 0.0).otherwise(ln_binomial(share, n, k) - powers)


def normal_cdf(x: Column) -> Column:
    """Standard normal distribution function (rational approximation, |error| < 8e-8)."""
    # Coefficients of the published approximation.
    c = [0.319381530, -0.356563782, 1.781477937, -1.821255978, 1.330274429]
    t = 1 / (1 + 0.2316419 * F.abs(x))
    poly = t * (c[0] + t * (c[1] + t * (c[2] + t * (c[3] + t * c[4]))))
    upper = F.exp(-x * x / 2) / F.sqrt(2 * F.pi()) * poly
    return F.when(x >= 0, 1 - upper).otherwise(upper)
