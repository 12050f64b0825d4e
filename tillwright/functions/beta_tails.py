"""Both tails of the Beta distribution as plain column expressions, evaluated on the JVM.

The tail beyond x on its own side of the mean is computed and the other is its complement, so
that a small probability keeps its digits. Where both parameters are large, the density is
summed over Gauss-Legendre nodes; elsewhere a fold takes a fixed number of terms of the
continued fraction, more than any pair of parameters below ``LARGE`` needs. A fraction that hasn't
settled after them gives NULL, as do NULL arguments.

``functions.beta`` has the same functions and the quantile as vectorised UDFs.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, functions as F

from tillwright.functions.scalars import ln_binomial

LARGE = 1000.0  # from here on for both parameters, the density is summed
TERMS = 200
REACH = 14.0  # standard deviations beyond which a tail's density is nothing
TINY = 1e-300
SETTLED = 1e-13


def bound(body: Callable[[Column], Column], **values: Column) -> Column:
    """``body`` of a struct of the values, which are evaluated once a row however often it uses them."""
    return F.transform(F.array(F.struct(*[v.alias(name) for name, v in values.items()])), body)[0]


def ln_kernel(a: Column, b: Column, x: Column) -> Column:
    """ln(x^a · (1 - x)^b / B(a, b)), through the binomial probability with a + b for its number."""
    return ln_binomial(x, a + b, a) + F.ln(a / (a + b) * b)


def log1p_less(x: Column) -> Column:
    """ln(1 + x) - x, without cancellation near 0."""
    series = F.lit(1 / 9)
    for k in range(8, 1, -1):
        series = F.lit((-1) ** (k + 1) / k) + x * series
    return F.when(F.abs(x) < 0.01, x * x * series).otherwise(F.log1p(x) - x)


def by_nodes(a: Column, b: Column, x: Column, above: Column) -> Column:
    """The mass between x and ``REACH`` deviations further out, up or down."""
    mean = a / (a + b)
    reach = REACH * F.sqrt(mean * (b / (a + b)) / (a + b + 1))
    half = F.when(above, F.least(reach, 1 - x) / 2).otherwise(-F.least(reach, x) / 2)
    nodes = F.array(*[F.struct(F.lit(float(n)).alias("at"), F.lit(float(w)).alias("weight")) for n, w in zip(*np.polynomial.legendre.leggauss(128))])

    def total(v: Column) -> Column:
        def weighed(node: Column) -> Column:
            at = v["x"] + v["half"] * (1 + node["at"])
            off = (v["x"] - v["mean"]) + v["half"] * (1 + node["at"])
            spread = v["a"] * log1p_less(off / v["mean"]) + v["b"] * log1p_less(-off * v["n"] / v["b"])
            return node["weight"] * F.exp(v["top"] + spread - F.ln(at) - F.log1p(-at))

        return F.abs(v["half"]) * F.aggregate(F.transform(nodes, weighed), F.lit(0.0), lambda sum_, part: sum_ + part)

    return bound(total, a=a, b=b, n=a + b, x=x, mean=mean, half=half, top=ln_kernel(a, b, mean))


def by_fraction(a: Column, b: Column, x: Column, above: Column) -> Column:
    """The tail's continued fraction (the contracted one, whose terms don't cancel), folded over its terms."""

    def unzero(v: Column) -> Column:
        return F.when(F.abs(v) < TINY, F.lit(TINY)).otherwise(v)

    def folded(v: Column) -> Column:
        p, q, z = v["p"], v["q"], v["z"]

        def under(m: Column) -> Column:
            return m + m * (q - m) * z / (p + 2 * m - 1) + (p + m) * (v["lean"] + m * (2 - z)) / (p + 2 * m + 1)

        def term(i: Column) -> Column:
            m = i.cast("double")
            over = (p + m - 1) / (p + 2 * m - 1) * ((p + q + m - 1) / (p + 2 * m - 1)) * m * (q - m) * z * z
            return F.struct(over.alias("over"), under(m).alias("under"))

        def step(s: Column, t: Column) -> Column:
            parts = F.struct((1 / unzero(t["under"] + t["over"] * s["ratio"])).alias("ratio"), unzero(t["under"] + t["over"] / s["product"]).alias("product"))
            return bound(lambda c: F.struct(
                (s["value"] * c["parts"]["ratio"] * c["parts"]["product"]).alias("value"), c["parts"]["product"].alias("product"),
                c["parts"]["ratio"].alias("ratio"), (c["parts"]["ratio"] * c["parts"]["product"]).alias("change")), parts=parts)

        first = unzero(p * v["lean"] / (p + 1))
        start = F.struct(first.alias("value"), first.alias("product"), F.lit(0.0).alias("ratio"), F.lit(0.0).alias("change"))
        return F.aggregate(F.transform(F.sequence(F.lit(1), F.lit(TERMS)), term), start, step,
                           lambda s: F.when(F.abs(s["change"] - 1) < SETTLED, s["value"]))

    p, q, z, w = F.when(above, b).otherwise(a), F.when(above, a).otherwise(b), F.when(above, 1 - x).otherwise(x), F.when(above, x).otherwise(1 - x)
    return F.exp(ln_kernel(a, b, x)) / bound(folded, p=p, q=q, z=z, lean=p * w - q * z + 1)


def _tail(alpha: Column, beta: Column, x: Column, upper: bool) -> Column:
    a, b, x = alpha.cast("double"), beta.cast("double"), x.cast("double")
    above = x > (a + 1) / (a + b + 2)
    area = F.when((a >= LARGE) & (b >= LARGE), by_nodes(a, b, x, above)).otherwise(by_fraction(a, b, x, above))
    return (
        F.when(a.isNull() | b.isNull() | x.isNull(), F.lit(None).cast("double"))
        .when(x <= 0, float(upper)).when(x >= 1, float(not upper))
        .when(above == F.lit(upper), area).otherwise(1 - area)
    )


def mass_below(alpha: Column, beta: Column, x: Column) -> Column:
    """P(θ ≤ x) for θ ~ Beta(alpha, beta)."""
    return _tail(alpha, beta, x, upper=False)


def mass_above(alpha: Column, beta: Column, x: Column) -> Column:
    """P(θ > x) for θ ~ Beta(alpha, beta), with all digits where it is small."""
    return _tail(alpha, beta, x, upper=True)
