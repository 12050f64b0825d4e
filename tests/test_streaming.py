import pytest
from pyspark.sql import functions as F, types as T

from tillwright.operators import bayes
from tillwright.streaming import clicks

SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("ad_id", T.StringType()), T.StructField("event_type", T.StringType()),
])


def events(spark, n=1200):
    return spark.range(n).select(
        F.col("id").alias("event_id"),
        F.timestamp_seconds(1_700_000_000 + F.col("id")).cast("timestamp_ntz").alias("ts"),
        (F.col("id") % 3).cast("string").alias("ad_id"),
        F.when(F.col("id") % 7 == 0, "click").when(F.col("id") % 11 == 0, "error").otherwise("view").alias("event_type"),
    )


@pytest.mark.parametrize("duplicates", [False, True])
def test_streamed_totals_equal_batch_totals(spark, tmp_path, duplicates):
    rows = events(spark).orderBy(F.hash("event_id"))  # out of order
    source = str(tmp_path / "in")
    landed = rows.unionByName(rows.filter("event_id % 5 = 0")) if duplicates else rows
    landed.repartition(6).write.parquet(source)
    stream = clicks.event_stream(spark, source, SCHEMA, files_per_batch=2)
    counts = clicks.running_trials(stream, duplicates_within="1 hour" if duplicates else None)
    clicks.start(counts, str(tmp_path / "out"), str(tmp_path / "state"), available_now=True).awaitTermination()
    expected = {r.ad_id: (r.impressions, r.clicks) for r in bayes.trials(events(spark)).collect()}
    got = clicks.latest(spark, str(tmp_path / "out")).collect()
    assert {r.ad_id: (r.impressions, r.clicks) for r in got} == expected
    for r in got:
        assert (r.alpha_post, r.beta_post) == (10 + r.clicks, 200 + r.impressions - r.clicks)
        assert r.decision == ("roll_out" if r.p_above >= 0.9 else "hold")
    batches = spark.read.parquet(str(tmp_path / "out")).select("batch_id").distinct().count()
    assert batches > 1


def test_snapshot_does_not_grow_with_batches(spark, tmp_path):
    events(spark).repartition(12).write.parquet(str(tmp_path / "in"))
    counts = clicks.running_trials(clicks.event_stream(spark, str(tmp_path / "in"), SCHEMA, files_per_batch=1))
    clicks.start(counts, str(tmp_path / "out"), str(tmp_path / "state"), available_now=True).awaitTermination()
    kept = spark.read.parquet(str(tmp_path / "out"))
    assert kept.agg(F.max("batch_id")).first()[0] == 11 and kept.count() == 6  # three ads, two snapshots
    assert clicks.latest(spark, str(tmp_path / "out")).count() == 3


def test_redelivered_events_count_once_and_none_is_turned_away(spark, tmp_path):
    rows = events(spark).withColumn("ts", F.col("ts").cast("timestamp"))
    delay = clicks.deliver(rows, str(tmp_path / "in"), slots=5, again=True)
    assert spark.read.parquet(str(tmp_path / "in")).count() == 2400
    stream = clicks.event_stream(spark, str(tmp_path / "in"), rows.schema, files_per_batch=3)
    query = clicks.start(clicks.running_trials(stream, duplicates_within=delay), str(tmp_path / "out"), str(tmp_path / "state"), available_now=True)
    query.awaitTermination()
    dropped = [o.numRowsDroppedByWatermark for p in query.recentProgress for o in p.stateOperators]
    assert dropped and sum(dropped) == 0
    expected = {r.ad_id: (r.impressions, r.clicks) for r in bayes.trials(rows).collect()}
    assert {r.ad_id: (r.impressions, r.clicks) for r in clicks.latest(spark, str(tmp_path / "out")).collect()} == expected


def test_streamed_blocks_equal_the_batch_after_a_restart(spark, tmp_path):
    rows = events(spark).withColumn("ts", F.col("ts").cast("timestamp"))
    for first, last in ((0, 3), (3, 7)):
        clicks.deliver(rows, str(tmp_path / "in"), slots=7, first=first, last=last)
        stream = clicks.event_stream(spark, str(tmp_path / "in"), rows.schema, files_per_batch=4)
        clicks.run_blocks(clicks.posterior_blocks(stream, block=64), str(tmp_path / "out"), str(tmp_path / "state"))
    assert spark.read.parquet(str(tmp_path / "out")).select("batch_id").distinct().count() >= 4
    want = bayes.sequential(rows, block=64)
    got = clicks.block_posteriors(spark, str(tmp_path / "out")).select(want.columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
