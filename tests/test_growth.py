"""Work and memory that must not grow faster than the tables."""

import pytest
from pyspark.sql import functions as F

from compare import spark_rows
from snapline.functions.tracking import seconds_between
from snapline.operators import features, ordered, quality, tracking
from snapline.plans import derived
from snapline.plans.queries import Inputs, rounded
from snapline.schemas import PLAY_SCHEMA
from snapline.sources import log
from snapline.streaming.keyed import derive_tracking_keyed
from test_ordered import COLUMNS, plain, skewed
from test_streaming import CLOSING_FRAME, FRAME, frame, in_files, run

HDFS = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_messages_are_decoded_once_before_dead_letters(spark, inputs):
    checked = quality.check_tracking(quality.stamp(quality.parse_tracking(derived.as_messages(inputs.tracking))))
    assert plan(quality.dead_letters(checked)).count("from_json") == 1
    texts = [('{"game_id": "G", "down": 3}',), ('{"game_id": "G", "down": "x"}',), ("no json",), ("",), (None,), ("[]",)]
    df = quality.parse_plays(spark.createDataFrame(texts, "value string"))
    assert df.columns == [*PLAY_SCHEMA.fieldNames(), quality.MALFORMED, quality.RAW]
    found = {r["raw_data"]: (r["game_id"], r["down"], r["malformed_text"]) for r in df.collect()}
    assert len(found) == len(texts) == df.count()
    assert found['{"game_id": "G", "down": 3}'] == ("G", 3, None) and found[None] == (None, None, None)
    assert found["no json"] == (None, None, "no json")
    assert found['{"game_id": "G", "down": "x"}'][1:] == (None, '{"game_id": "G", "down": "x"}')


def test_roles_are_joined_without_broadcasts(inputs):
    """Neither frames nor teams go to the driver, however small their files are."""
    df = tracking.with_roles(inputs.tracking, inputs.plays)
    df.collect()
    physical = df._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in physical and "Broadcast" not in physical


def test_keys_are_counted_by_slots_first(spark):
    df = skewed(spark)
    total, slots = ordered.crowded_slots(df, ["k"], 900)
    assert total == 3000 and len(slots) == 1
    assert ordered.crowded_slots(df, ["k"], 3000) == (3000, [])
    assert ordered.crowded_slots(df.filter("false"), ["k"], 10) == (0, [])


@pytest.mark.parametrize("group_rows", [10**6, 60])
def test_large_tables_get_more_window_tasks(spark, monkeypatch, group_rows):
    monkeypatch.setattr(ordered, "TASK_ROWS", 100)
    df = skewed(spark)
    cut = ordered.over_parts(df, ["k"], ["t", "id"], COLUMNS, before=20, after=2, group_rows=group_rows)
    assert "RepartitionByExpression [k" in plan(cut) and ", 30" in plan(cut)
    assert spark_rows(cut) == spark_rows(plain(df, ["k"], ["t", "id"], COLUMNS))


@pytest.mark.parametrize("group_rows", [10**6, 60])
def test_groups_dealt_by_some_of_their_keys(spark, monkeypatch, group_rows):
    """The same columns, whether the rows that come to one task are few or many."""
    monkeypatch.setattr(ordered, "TASK_ROWS", 100)
    df = skewed(spark).withColumn("m", F.pmod(F.hash("id"), F.lit(3)))
    cut = ordered.over_parts(df, ["k", "m"], ["t", "id"], COLUMNS, before=20, after=2, group_rows=group_rows, together=["k"])
    assert spark_rows(cut) == spark_rows(plain(df, ["k", "m"], ["t", "id"], COLUMNS))


def test_frames_are_shuffled_once_for_silver(inputs):
    """Motion and the sums per play share one shuffle, and neither sums nor teams are broadcast."""
    sums = tracking.team_partials(inputs.bronze_tracking)._jdf.queryExecution().executedPlan().toString()
    assert sums.count("Exchange hashpartitioning(game_id") == 1
    measures = tracking.aggregate_play_tracking(inputs.bronze_tracking, inputs.plays)
    assert "Broadcast" not in measures._jdf.queryExecution().executedPlan().toString()


def test_frames_are_derived_from_what_their_play_shares(spark):
    events = spark.sql("SELECT * FROM VALUES (7L, 3L, TIMESTAMP_NTZ'2024-01-01 00:00:00'), (8L, NULL, NULL) AS e(event_id, user_id, ts)")
    frames = derived.tracking_from_events(events)
    assert "make_dt_interval" not in plan(frames)
    rows = {(r["play_id"], r["player_id"], r["frame_id"]): r for r in frames.collect()}
    assert len(rows) == frames.count() == 48
    last = rows["P7", "P7_4", 2]
    assert (last["game_id"], last["team"], last["position"], last["event"], str(last["timestamp"])) == ("G3", "T3", "DE", "pass_arrived", "2024-01-01 00:00:00.200000")
    assert rows["P7", "P7_3", 0]["team"] == "T7" and rows["P7", "P7_3", 0]["event"] == "snap"
    bare = rows["P8", "P8_0", 1]
    assert (bare["game_id"], bare["team"], bare["timestamp"]) == (None, None, None)


def test_tasks_that_unfold_frames_follow_the_number_of_events(spark, inputs, monkeypatch):
    rows = spark_rows(inputs.tracking)
    monkeypatch.setattr(derived, "TASK_EVENTS", inputs.table("events").count() // 40)
    assert inputs.tracking.rdd.getNumPartitions() >= 40
    assert spark_rows(inputs.tracking) == rows


def test_plays_are_sized_by_the_counted_frames(spark, inputs):
    broken = inputs.tracking.withColumn("play_id", F.raise_error(F.lit("was run")).cast("string"))
    tracking.derive_tracking(quality.flag_tracking(broken), counted=inputs.tracking)


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_seconds_between_are_exact_without_a_cast_to_the_zone(spark, zone, kind):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        pairs = [("2024-01-01 00:00:00", "2024-01-01 00:00:00.1"), ("2024-11-02 23:00:00", "2024-11-03 04:00:00.000001"), ("9999-12-31 00:00:00", "0001-01-01 00:00:00"), (None, "2024-01-01 00:00:00")]
        df = spark.createDataFrame(pairs, "a string, b string").select(F.col("a").cast(kind), F.col("b").cast(kind))
        seconds = df.select(seconds_between(F.col("a"), F.col("b")).alias("s"))
        assert "timestampdiff" not in plan(seconds)
        assert [r["s"] for r in seconds.collect()] == [0.1, 18000.000001, -315537811200.0, None]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_sizes_come_from_the_counted_plays(spark, inputs):
    """The teams are sized without running what leads to the silver rows."""
    broken = inputs.valid_plays.withColumn("defensive_pressure_rate", F.lit(0.5)).withColumn("play_id", F.raise_error(F.lit("was run")).cast("string"))
    added = features.add_opponent_features(features.add_rolling_features(broken, counted=inputs.valid_plays), counted=inputs.valid_plays)
    assert "opp_pressure_rate" in added.columns
    given = Inputs(spark, inputs.sf_dir).valid_plays.withColumn("defensive_pressure_rate", F.lit(0.5))
    assert spark_rows(rounded(features.add_rolling_features(given, counted=given))) == spark_rows(rounded(features.add_rolling_features(given, partitions=3)))


def test_keyed_streams_bring_their_state_store(spark, tmp_path):
    """A session without this package's settings, as a job gets it that does not build its own."""
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, HDFS)
    try:
        rows = [frame("P", "a", i / 10, i, float(i)) for i in range(5)]
        found = run(derive_tracking_keyed(in_files(spark, tmp_path / "in", [rows, CLOSING_FRAME], FRAME)), tmp_path, "timestamp").filter("play_id = 'P'")
        assert [r[0] for r in found.orderBy("frame_id").select("prev_x").collect()] == [None, 0.0, 1.0, 2.0, 3.0]
        assert spark.conf.get(key) == HDFS
    finally:
        spark.conf.set(key, before)


def test_partitions_follow_the_rows(spark):
    df = spark.range(1000).withColumnRenamed("id", "event_id")
    cores = spark.sparkContext.defaultParallelism
    assert derived.spread(df, rows=10).rdd.getNumPartitions() == 100
    assert derived.spread(df, rows=1000).rdd.getNumPartitions() == cores


def test_segments_follow_the_messages(spark, tmp_path, monkeypatch):
    """A segment's messages are sorted in one worker's memory; all of them come back, by their offsets."""
    monkeypatch.setattr(log, "PER_TASK", 50)
    messages = spark.range(1000).select(F.col("id").alias("offset"), F.concat(F.lit("m"), F.col("id").cast("string")).alias("value"))
    log.write_segments(messages, f"{tmp_path}/log", 2)
    held = log.segments(f"{tmp_path}/log")
    assert len(held) > 10 and max(last - first for first, last, _ in held) < 150
    read = log.log_messages(spark, f"{tmp_path}/log", stream=False).collect()
    assert sorted(tuple(r) for r in read) == [(i, f"m{i}") for i in range(1000)]
