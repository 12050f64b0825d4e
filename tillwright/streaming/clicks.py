"""Click trials as a stream: running counts, posterior and rollout decision."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tillwright.operators import bayes


def event_stream(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None) -> DataFrame:
    """Parquet files of events as they land in ``path``.

    Times without a zone are read as UTC instants, as watermarks need.
    """
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path).withColumn("ts", F.col("ts").cast("timestamp"))


def running_trials(events: DataFrame, duplicates_within: str | None = None) -> DataFrame:
    """Impressions and clicks per ad so far.

    Sums do not depend on arrival order, so late events need no watermark.
    With ``duplicates_within`` an event that is delivered again within that
    time is counted once, and only then is a watermark set.
    """
    if duplicates_within:
        events = events.withWatermark("ts", duplicates_within).dropDuplicatesWithinWatermark(["event_id"])
    return bayes.trials(events)


def decided(counts: DataFrame, prior: tuple[float, float] = bayes.PRIOR,
            above: float = bayes.GATE_RATE, at_least: float = bayes.GATE_PROBABILITY) -> DataFrame:
    """Posterior and rollout decision for running counts."""
    return bayes.gated(bayes.posterior(counts, prior), above, at_least).select(
        "ad_id", "impressions", "clicks", "alpha_post", "beta_post", "post_mean", "post_sd", "p_above", "decision"
    )


def start(counts: DataFrame, output: str, checkpoint: str, *, available_now: bool = False, every: str = "1 minute",
          prior: tuple[float, float] = bayes.PRIOR, above: float = bayes.GATE_RATE,
          at_least: float = bayes.GATE_PROBABILITY) -> StreamingQuery:
    """Keeps a snapshot of the newest decision per ad under ``output``.

    A micro-batch adds its changed ads to the snapshot before it and writes the
    whole as one of two folders in turn. So the output holds two rows per ad at
    most, however long the stream runs, and a batch that is run again after a
    failure still finds the snapshot before it untouched.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        changed = decided(batch, prior, above, at_least).withColumn("batch_id", F.lit(batch_id).cast("long"))
        if batch_id:
            changed = changed.unionByName(batch.sparkSession.read.schema(changed.schema).parquet(_half(output, batch_id - 1)))
        _newest(changed, ["ad_id"]).write.mode("overwrite").parquet(_half(output, batch_id))

    writer = counts.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if available_now else {"processingTime": every}
    return writer.trigger(**trigger).start()


def _half(output: str, batch_id: int) -> str:
    return f"{output}/half={batch_id % 2}"


def _newest(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Per key the row of the highest batch_id, which is kept."""
    row = F.struct(*[c for c in rows.columns if c not in keys])
    return rows.groupBy(*keys).agg(F.max_by(row, "batch_id").alias("r")).select(*keys, "r.*")


def latest(spark: SparkSession, output: str) -> DataFrame:
    """The newest decision per ad; reads the two snapshots only."""
    return _newest(spark.read.parquet(output).drop("half"), ["ad_id"]).drop("batch_id")


def deliver(events: DataFrame, folder: str, slots: int, again: bool = False, first: int = 0, last: int | None = None) -> str:
    """Writes events as one delivery per time slot, the rows of a slot in no order; with ``again`` each comes once more with the slot after its own.

    Slots cut the span of all event times evenly; ``first`` and ``last`` choose a part of them.
    Returns an interval that covers how far apart two deliveries of an event, or
    two events of one delivery, can be in event time.
    """
    low, high = events.agg(F.min(F.unix_micros("ts")), F.max(F.unix_micros("ts"))).first()
    width = ((high or 0) - (low or 0)) // slots + 1
    slot = F.floor((F.unix_micros("ts") - F.lit(low)) / width)
    for k in range(first, slots + again if last is None else last):
        own = events.filter((slot == k) | ((slot == k - 1) & F.lit(again)))
        own.repartition(4, F.xxhash64("event_id", F.lit(k))).sortWithinPartitions(F.xxhash64("event_id")).write.mode("append").parquet(folder)
    return f"{2 * width // 1_000_000 + 1} seconds"


def posterior_blocks(events: DataFrame, block: int = bayes.BLOCK) -> DataFrame:
    """Counts of every touched block of ``block`` impressions per ad, as the stream goes on.

    An ad's state is three numbers: impressions and clicks so far, and the
    clicks before its open block, which is its posterior between blocks. An ad's
    events of a micro-batch are put in order of time and taken up from there; a
    later micro-batch gives a block that was still open again, with more in it.
    An event older than those of an earlier micro-batch counts when it comes. A
    task holds one ad's events of one micro-batch, whose size the source's limit
    of files sets.
    """
    def taken_up(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        seen, clicked, opened = state.get if state.exists else (0, 0, 0)
        rows = pd.concat(parts).sort_values(["ts", "event_id"])
        so_far = clicked + rows["click"].cumsum().to_numpy()
        number = seen + np.arange(len(rows))
        last = np.flatnonzero(np.diff(number // block, append=-1))
        before = np.concatenate([[opened], so_far[last][:-1]])
        out = pd.DataFrame({
            "ad_id": key[0], "block": number[last] // block, "impressions": number[last] % block + 1, "clicks": so_far[last] - before,
            "impressions_so_far": number[last] + 1, "clicks_so_far": so_far[last]})
        closed = (number[-1] + 1) % block == 0
        state.update((int(number[-1]) + 1, int(so_far[-1]), int(so_far[-1] if closed else before[-1])))
        yield out

    clicks = events.select("ad_id", "ts", "event_id", (F.col("event_type") == "click").cast("long").alias("click"))
    return clicks.groupBy("ad_id").applyInPandasWithState(
        taken_up, "ad_id string, block long, impressions long, clicks long, impressions_so_far long, clicks_so_far long",
        "seen long, clicked long, opened long", "update", GroupStateTimeout.NoTimeout)


def run_blocks(blocks: DataFrame, output: str, checkpoint: str) -> None:
    """Takes up what has landed since the checkpoint; each micro-batch writes its touched blocks to a folder of its own, again if run again."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{output}/batch_id={batch_id}")

    writer = blocks.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)
    writer.trigger(availableNow=True).start().awaitTermination()


def block_posteriors(spark: SparkSession, output: str, prior: tuple[float, float] = bayes.PRIOR) -> DataFrame:
    """The blocks written so far, each as its last micro-batch left it, with prior and posterior."""
    return bayes.block_posteriors(_newest(spark.read.parquet(output), ["ad_id", "block"]).drop("batch_id"), prior)
