"""Mixing sources to target weights by Poisson replication.

A source's mean repetition rate is its target share of the mix over its own share.
A document's number of copies inverts the Poisson distribution of that mean at a
uniform number hashed from seed and doc_id, so it needs no state, is the same on
every run, and a source may hold any share of the rows. A rate over ``STEP`` is
split into equal parts with a number each, since sums of Poisson numbers are Poisson.
Copies are then ordered by a hash over the whole corpus.

Shares are measured in code points plus one per document. A null text is empty, a
null source is a source of its own, a null doc_id hashes as the empty id, and rows
that repeat an id get equally many copies. Other columns pass through, but for those named like
the two that are added. No rows, no mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwright.llm.common import passing
from tillwright.session import durable

STEP = 32.0
TERMS = 128  # beyond these, a Poisson number of mean STEP has a probability below 1e-30


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) hashed from the parts."""
    text = F.concat_ws(":", *(p.cast("string") for p in parts))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def rates(docs: DataFrame, weights: dict[str, float] | None = None, temper: float = 0.5, total: float = 1.0) -> DataFrame:
    """source, parts, cdf (of a part's Poisson number).

    weights: targets of sources, those unnamed get none. Without it a source's
    target is its share to the power ``temper``. total: size of the mix over the corpus.
    """
    size = F.char_length(F.coalesce("text", F.lit(""))) + 1
    held = durable(docs.groupBy("source").agg(F.sum(size).alias("held")))
    if weights is None:
        wanted = F.pow(F.col("held").cast("double"), F.lit(temper))
    else:
        named = F.create_map(*(x for k, v in weights.items() for x in (F.lit(k), F.lit(float(v)))))
        wanted = F.coalesce(F.try_element_at(named, "source"), F.lit(0.0))
    held = held.withColumn("wanted", wanted)
    everything, targets = held.agg(F.sum("held"), F.sum("wanted")).first()
    rate = F.col("wanted") / F.lit(float(targets or 1)) * F.lit(float(everything or 0) * total) / F.col("held")
    parts = F.greatest(F.ceil(rate / STEP), F.lit(1)).cast("int")
    start = F.exp(-F.col("mean"))
    walk = F.aggregate(
        F.sequence(F.lit(1), F.lit(TERMS - 1)), F.struct(start.alias("p"), F.array(start).alias("cdf")),
        lambda s, k: F.struct((s["p"] * F.col("mean") / k).alias("p"),
                              F.concat(s["cdf"], F.array(F.element_at(s["cdf"], -1) + s["p"] * F.col("mean") / k)).alias("cdf")))
    return held.select("source", parts.alias("parts"), (rate / parts).alias("mean")).select("source", "parts", walk["cdf"].alias("cdf"))


def mix(docs: DataFrame, by_source: DataFrame, seed: int = 42) -> DataFrame:
    """Every column of ``docs`` and ``copy`` from 1, one row per copy, in the order of ``mix_key`` over the whole corpus."""
    kept = passing(docs, "copy", "mix_key")
    named = by_source.select(F.col("source").alias("_tw_source"), F.col("parts").alias("_tw_parts"), F.col("cdf").alias("_tw_cdf"))
    doc = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    numbers = F.transform(F.sequence(F.lit(1), F.col("_tw_parts")), lambda j: uniform(F.lit(seed), doc, j))
    copies = F.aggregate(numbers, F.lit(0), lambda n, u: n + F.size(F.filter("_tw_cdf", lambda c: c < u)))
    joined = docs.select(*kept).join(named, F.col("source").eqNullSafe(F.col("_tw_source")))
    each = joined.withColumn("copy", F.explode(F.when(copies > 0, F.sequence(F.lit(1), copies))))
    keyed = each.withColumn("mix_key", uniform(F.lit(seed), F.lit("order"), doc, F.col("copy")))
    return keyed.select(*kept, "copy", "mix_key").orderBy("mix_key", "doc_id", "copy")
