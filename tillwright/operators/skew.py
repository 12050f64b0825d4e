"""Joins whose hot keys are split over several tasks by the plan itself.

Adaptive execution splits a hot key when it sees one; these joins do so where it is
switched off, or where a stream or a bucketed layout leaves it no choice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

SALT = "_salt"


def hot_keys(df: DataFrame, key: str, share: float) -> list:
    """The keys with more than ``share`` of all rows: below 1 / ``share`` in number, however many rows there are.

    Counted with map-side sums, so that a hot key is one row per task in the shuffle.
    """
    counts = df.groupBy(key).agg(F.count("*").alias("n"))
    total = df.count()
    found = counts.filter(F.col(key).isNotNull() & (F.col("n") > share * total)).select(key).collect()
    return sorted(r[0] for r in found)


def spread_join(left: DataFrame, right: DataFrame, key: str, how: str = "left", spread: int = 32, share: float = 0.01) -> DataFrame:
    """``left`` joined with ``right`` on ``key``; rows of a hot key are dealt to ``spread`` salts, for which its right row is repeated.

    The salt comes from the row's values, so a task that is run again deals as before. Rows that are
    alike in every column share a salt. Rows without a key match nothing and are dealt as well, or a
    large group of them would be one task's. Only a hot key's rows on the right are repeated.
    ``how`` is ``left`` or ``inner``.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"a {how} join can't repeat rows of the right side")
    hot = hot_keys(left, key, share)
    dealt = F.pmod(F.xxhash64(*left.columns), F.lit(spread)).cast("int")
    salts = F.sequence(F.lit(0), F.lit(spread - 1))
    return (
        left.withColumn(SALT, F.when(F.col(key).isNull() | is_one_of(F.col(key), hot), dealt).otherwise(0))
        .join(right.withColumn(SALT, F.explode(F.when(is_one_of(F.col(key), hot), salts).otherwise(F.array(F.lit(0))))), [key, SALT], how)
        .drop(SALT)
    )


def is_one_of(column: Column, values: list) -> Column:
    return column.isin(values) if values else F.lit(False)
