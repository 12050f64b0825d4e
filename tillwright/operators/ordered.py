"""Running counts that stay parallel inside a hot key.

A window over (key) sorts all rows of the key in one task. Here a key's rows
are cut into time slots: slot totals (summed map-side) give each slot its
offset, and rows are counted only inside their own slot.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F


def running_totals(df: DataFrame, keys: Sequence[str], slot: str, order: Sequence[str],
                   measures: Sequence[str]) -> DataFrame:
    """Adds ``<m>_before`` (sum over earlier rows of the key) and ``<m>_total``.

    ``slot`` must rise with ``order`` and not be NULL, for instance the hour of
    an event time. A key has at most as many slots as the calendar has hours,
    whatever the number of its rows.

    The key travels as one struct, in which NULLs are equal, so the join needs
    no null-safe form and finds the rows where the window left them: rows are
    shuffled once, by (key, slot).
    """
    rows = df.withColumn("_key", F.struct(*keys))
    by_slot = Window.partitionBy("_key").orderBy(slot)
    earlier = by_slot.rowsBetween(Window.unboundedPreceding, -1)
    whole = by_slot.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    slots = rows.groupBy("_key", slot).agg(*[F.sum(m).alias(m) for m in measures])
    offsets = slots.select(
        "_key", slot,
        *[F.coalesce(F.sum(m).over(earlier), F.lit(0)).alias(f"_{m}_offset") for m in measures],
        *[F.sum(m).over(whole).alias(f"{m}_total") for m in measures],
    )
    inside = Window.partitionBy("_key", slot).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    counted = rows.withColumns({f"_{m}_inside": F.coalesce(F.sum(m).over(inside), F.lit(0)) for m in measures})
    return counted.join(offsets, ["_key", slot]).select(
        *df.columns,
        *[(F.col(f"_{m}_inside") + F.col(f"_{m}_offset")).alias(f"{m}_before") for m in measures],
        *[f"{m}_total" for m in measures],
    )
