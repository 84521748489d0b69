"""Keyed state, session windows and replays on streams, against their batch twins."""

import random

import pytest
from pyspark.sql import functions as F

from compare import spark_rows
from snapline.operators import quality, tracking
from snapline.plans import derived
from snapline.plans.queries import rounded
from snapline.sources.messages import table_stream
from snapline.sources.tables import with_event_date
from snapline.streaming import bronze
from snapline.streaming.keyed import derive_tracking_keyed
from snapline.streaming.sessions import frame_sessions, play_sessions
from test_streaming import CLOSING_FRAME, FRAME, at, frame, in_files, run


def test_keyed_motion_over_files_out_of_order(spark, tmp_path):
    """Gaps, missing speeds, copies of a time, frames that arrive late but within the watermark."""
    rng = random.Random(4)
    rows = []
    for player in "abc":
        second = 0.0
        for i in range(120):
            second += rng.choice([0.1, 0.1, 0.1, 7, 29.9, 30, 30.1])
            rows.append(frame("P", player, round(second, 3), i, rng.random() * 50, rng.choice([None, 1.0, 4.5])))
    shuffled = rows[:]
    for i in range(0, len(shuffled), 40):
        part = shuffled[i : i + 40]
        rng.shuffle(part)
        shuffled[i : i + 40] = part
    batches = [shuffled[i : i + 60] for i in range(0, len(shuffled), 60)]
    stream = in_files(spark, tmp_path / "in", [*batches, CLOSING_FRAME], FRAME)
    found = run(derive_tracking_keyed(stream, delay="10 hours"), tmp_path, "timestamp").filter("play_id = 'P'")
    expected = tracking.derive_tracking(spark.createDataFrame(rows, FRAME), gap_seconds=30).select(*found.columns)
    assert found.count() == len(rows)
    assert spark_rows(rounded(found)) == spark_rows(rounded(expected))


def test_keyed_state_is_one_row_per_waiting_frame(spark, tmp_path):
    """What has been given out leaves two rows of state at most: the last two frames and a timer, whatever the frame rate."""
    batches = [[frame("P", "a", i / 50, i, 1.0) for i in range(500)], [frame("END", "end", 20_000, 0, 0.0)], [frame("END", "end", 20_001, 1, 0.0)]]
    df = derive_tracking_keyed(in_files(spark, tmp_path / "in", batches, FRAME))
    query = bronze.start_append(df, f"{tmp_path}/out", f"{tmp_path}/checkpoint", None, "timestamp")
    query.awaitTermination()
    progress = [p for p in query.recentProgress if p["stateOperators"]]
    rows = [p["stateOperators"][0]["numRowsTotal"] for p in progress]
    assert max(rows) >= 500 and rows[-1] <= 10
    assert spark.read.parquet(f"{tmp_path}/out").filter("play_id = 'P'").count() == 500


def test_sessions_merge_over_files_and_at_the_gap(spark, tmp_path):
    batches = [
        [frame("P", "a", 0, 0, 0.0), frame("P", "a", 59, 2, 0.0), frame("P", "b", 0, 0, 0.0)],
        [frame("P", "a", 29.5, 1, 0.0, 9.0), frame("P", "a", 89, 3, 0.0), frame("P", "a", 119.1, 4, 0.0), frame("P", "b", 300, 1, 0.0)],
        CLOSING_FRAME,
    ]
    stream = in_files(spark, tmp_path / "in", batches, FRAME)
    found = run(frame_sessions(stream, delay="10 minutes").withColumn("timestamp", F.col("first_frame")), tmp_path, "timestamp").drop("timestamp")
    whole = spark.createDataFrame(batches[0] + batches[1], FRAME)
    assert spark_rows(rounded(found)) == spark_rows(rounded(frame_sessions(whole)))
    told = {(r["player_id"], r["first_frame"]): (r["last_frame"], r["frames"], r["top_speed"]) for r in found.collect()}
    assert told == {("a", at(0)): (at(89), 4, 9.0), ("a", at(119.1)): (at(119.1), 1, 1.0), ("b", at(0)): (at(0), 1, 1.0), ("b", at(300)): (at(300), 1, 1.0)}


def test_play_sessions_of_a_table(spark, inputs):
    found = play_sessions(inputs.plays, "1 hour")
    assert found.agg(F.sum("plays")).first()[0] == inputs.plays.count()
    assert found.filter("last_play - first_play < INTERVAL 0 SECOND").isEmpty()


def test_a_replayed_batch_leaves_readers_undisturbed(spark, inputs, tmp_path):
    """Batch 0 written, read by a stream, and written again as after a crash before its commit."""
    rows = with_event_date(derived.with_zone(inputs.bronze)).limit(50).persist()
    path = f"{tmp_path}/t"

    def read():
        out = table_stream(spark, path, rows.withColumn("batch_id", F.lit(0)).schema).writeStream.format("parquet").option("path", f"{tmp_path}/out")
        out.option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start().awaitTermination()
        return spark.read.parquet(f"{tmp_path}/out").count()

    bronze._write_batch(rows, path, 0)
    assert read() == 50
    bronze._write_batch(rows, path, 0)
    assert read() == 50
    bronze._write_batch(rows, path, 1)
    assert read() == 100 == spark.read.parquet(path).count()
    # A crash while a batch is written leaves what no reader sees, and the replay takes its place.
    rows.write.partitionBy("event_date").parquet(f"{path}/_staged/2")
    assert spark.read.parquet(path).count() == 100
    bronze._write_batch(rows, path, 2)
    assert read() == 150
    rows.unpersist()


@pytest.mark.parametrize("times", [1, 2])
def test_tracking_frames_of_a_replay_are_read_once(spark, inputs, tmp_path, times):
    """The first query is started again from nothing, as if none of its batches had been committed: bronze does not change."""
    frames = inputs.tracking.filter(F.col("game_id") == "G3")
    derived.as_messages(frames).coalesce(2).write.text(f"{tmp_path}/messages")
    from snapline.sources.messages import text_messages
    from snapline.sources.tables import remove_folder

    for _ in range(times):
        started = bronze.start_bronze_tracking(text_messages(spark, f"{tmp_path}/messages"), f"{tmp_path}/root", f"{tmp_path}/checkpoint", None)
        bronze.wait_all(spark, started)
        remove_folder(spark, f"{tmp_path}/checkpoint/tracking_frames")
    kept = spark.read.parquet(f"{tmp_path}/root/tracking_frames")
    assert kept.count() == frames.count()
    late = spark.read.parquet(f"{tmp_path}/root/bronze_tracking")
    assert late.count() == late.dropDuplicates(["player_id", "frame_id", "play_id"]).count() > 0
    assert quality.flag_tracking(frames).filter("is_valid").count() >= late.count()
