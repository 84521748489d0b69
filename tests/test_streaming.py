"""Streams against their batch twins: order, late rows, copies, malformed messages, replays."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from compare import spark_rows
from snapline.operators import plays, quality, silver, tracking
from snapline.plans import derived
from snapline.plans.queries import rounded
from snapline.schemas import BRONZE_PLAY_SCHEMA
from snapline.sources.messages import table_stream, text_messages
from snapline.streaming import bronze
from snapline.streaming.silver import dedup_stream, far_frames, silver_stream
from snapline.streaming.tracking import derive_tracking_stream

T0 = dt.datetime(2024, 1, 1, 12, 0, 0)


def at(seconds):
    return T0 + dt.timedelta(seconds=seconds)


def in_files(spark, folder, batches, schema):
    """One file per batch, read one file per trigger in the order written."""
    for batch in batches:
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(str(folder))
    return table_stream(spark, str(folder), spark.createDataFrame([], schema).schema, max_files=1)


def run(df, folder, column="event_timestamp"):
    out = f"{folder}/out"
    bronze.start_append(df, out, f"{folder}/checkpoint", None, column).awaitTermination()
    return df.sparkSession.read.parquet(out).drop("event_date")


FRAME = "game_id string, play_id string, player_id string, timestamp timestamp, frame_id int, team string, position string, x_coord double, y_coord double, speed double, event string"


def frame(play, player, second, number, x, speed=1.0, team="A", position="QB", event="pass"):
    return ("G", play, player, at(second), number, team, position, x, 0.0, speed, event)


CLOSING_FRAME = [frame("END", "end", 90_000, 0, 0.0)]


def test_motion_over_files_out_of_order(spark, tmp_path):
    batches = [
        [frame("P", "a", 0.2, 2, 3.0), frame("P", "a", 0.0, 0, 0.0, None), frame("P", "b", 0.1, 1, 5.0)],
        [frame("P", "a", 0.1, 1, 1.0, None), frame("P", "b", 0.0, 0, 4.0), frame("P", "a", 0.2, 2, 3.0)],
        [frame("P", "a", i / 10, i, i * 1.5, None if i % 3 else 2.0) for i in range(3, 1500)],
        CLOSING_FRAME,
    ]
    stream = in_files(spark, tmp_path / "in", batches, FRAME)
    found = run(derive_tracking_stream(stream), tmp_path, "timestamp")
    whole = spark.createDataFrame(sum(batches[:3], []), FRAME)
    expected = tracking.derive_tracking(whole).select(*found.columns)
    assert spark_rows(rounded(found)) == spark_rows(rounded(expected))


def test_motion_starts_afresh_after_a_gap(spark, tmp_path):
    batches = [[frame("P", "a", 0, 0, 0.0), frame("P", "a", 20, 1, 1.0), frame("P", "a", 51, 2, 2.0)], CLOSING_FRAME]
    found = run(derive_tracking_stream(in_files(spark, tmp_path / "in", batches, FRAME)), tmp_path, "timestamp")
    assert {r["frame_id"]: r["prev_x"] for r in found.collect()} == {0: None, 1: 0.0, 2: None}
    batch = tracking.derive_tracking(spark.createDataFrame(batches[0], FRAME), gap_seconds=30)
    assert spark_rows(rounded(found)) == spark_rows(rounded(batch.select(*found.columns)))


def test_late_frames_are_dropped(spark, tmp_path):
    # A row is late by the watermark of the batch before, hence two closing files ahead of it.
    closing = [[frame("END", "end", second, 0, 0.0)] for second in (90_000, 90_001, 180_000)]
    batches = [[frame("P", "a", 0, 0, 0.0)], closing[0], closing[1], [frame("P", "a", 0.1, 1, 1.0)], closing[2]]
    found = run(derive_tracking_stream(in_files(spark, tmp_path / "in", batches, FRAME)), tmp_path, "timestamp")
    assert [r["frame_id"] for r in found.filter("play_id = 'P'").collect()] == [0]


def test_dedup_within_the_watermark(spark, inputs, tmp_path):
    schema = "game_id string, play_id string, event_timestamp timestamp, n int"
    batches = [[("G", "P", at(0), 1)], [("G", "P", at(5), 2), ("G", "Q", at(6), 3)], [("G", "P", at(60), 4)]]
    found = run(dedup_stream(in_files(spark, tmp_path / "in", batches, schema)), tmp_path)
    assert sorted(r["n"] for r in found.collect()) == [1, 3]


def one_play(play, second, **values):
    row = dict.fromkeys(BRONZE_PLAY_SCHEMA.fieldNames())
    row |= dict(
        game_id="G", play_id=play, event_timestamp=at(second), possession_team="A", defensive_team="B", down=1, yards_to_go=10,
        yard_line=30, quarter=1, time_remaining=500, yards_gained=5, score_home=7, score_away=3, score_differential=4,
        processing_timestamp=at(second), is_valid=True,
    )
    return tuple((row | values)[n] for n in BRONZE_PLAY_SCHEMA.fieldNames())


def test_silver_matched_unmatched_and_split_over_files(spark, tmp_path):
    bronze_frame = "game_id string, play_id string, player_id string, timestamp timestamp, frame_id int, team string, position string, final_speed double, calculated_acceleration double, distance_traveled double, event string"

    def seen(play, player, second, team, position, speed, event="pass"):
        return ("G", play, player, at(second), int(second * 10), team, position, speed, speed / 2, speed / 4, event)

    tracks = [
        [seen("P1", "q", 1, "A", "QB", 4.0), seen("P1", "d", 1, "B", "DE", 6.0)],
        [seen("P1", "q", 100, "A", "QB", 8.0), seen("P1", "w", 100, "A", "WR", 2.0, "pass_arrived"), seen("LONE", "q", 3, "A", "QB", 1.0)],
        [seen("END", "q", 90_000, "A", "QB", 1.0)],
    ]
    rows = [[one_play("P1", 0), one_play("P2", 2)], [one_play("P3", 30, possession_team="B", defensive_team="A")], [one_play("END", 90_000)]]
    play_schema = spark.createDataFrame([], BRONZE_PLAY_SCHEMA).schema
    stream = silver_stream(
        in_files(spark, tmp_path / "plays", rows, play_schema), in_files(spark, tmp_path / "tracks", tracks, bronze_frame)
    )
    found = run(stream, tmp_path)
    batch = silver.silver_plays(
        spark.createDataFrame(sum(rows[:2], []), play_schema), spark.createDataFrame(sum(tracks[:2], []), bronze_frame)
    )
    assert spark_rows(rounded(found)) == spark_rows(rounded(batch.select(*found.columns)))
    by_play = {r["play_id"]: r for r in found.collect()}
    assert set(by_play) == {"P1", "P2", "P3"}
    assert by_play["P2"]["offense_avg_speed"] is None and by_play["P2"]["defensive_pressure_rate"] is None
    assert by_play["P1"]["qb_max_speed"] == 8.0


def test_frames_around_the_start_of_a_play(spark, tmp_path):
    """A play at 12:00:30; frames before it, after it, at the reach and beyond it."""
    columns = "game_id string, play_id string, player_id string, timestamp timestamp, frame_id int, team string, position string, final_speed double, calculated_acceleration double, distance_traveled double, event string"
    seconds = [-31, -29, 1, -30 * 60, 30 * 60, -40 * 60, 40 * 60]
    tracks = [("G", "P", "q", at(30 + s), i, "A", "QB", 1.0, 0.0, 2.0**i, "pass") for i, s in enumerate(seconds)]
    closing = ("G", "END", "q", at(200_000), 0, "A", "QB", 1.0, 0.0, 1.0, "pass")
    rows = [[one_play("P", 30)], [one_play("END", 200_000)]]
    schema = spark.createDataFrame([], BRONZE_PLAY_SCHEMA).schema

    def streams(name):
        return in_files(spark, tmp_path / f"{name}-plays", rows, schema), in_files(spark, tmp_path / f"{name}-tracks", [tracks, [closing]], columns)

    (tmp_path / "a").mkdir()
    (tmp_path / "b").mkdir()
    found = run(silver_stream(*streams("a")), tmp_path / "a").filter("play_id = 'P'").first()
    assert found["offense_total_distance"] == 1 + 2 + 4 + 8 + 16
    apart = run(far_frames(*streams("b")), tmp_path / "b", "tracked_at").filter("play_id = 'P'")
    assert apart.agg(F.sum("distance_sum")).first()[0] == 32 + 64


@pytest.fixture
def messages(spark, inputs, tmp_path):
    """Some hundred plays as text files, with a malformed line, a row without a key and a copy."""
    lines = [r["value"] for r in derived.as_messages(inputs.plays).limit(300).collect()]
    bad = ["{bad", json.dumps({"play_id": "X", "quarter": 1, "yards_to_go": 1}), lines[0]]
    folder = tmp_path / "messages"
    folder.mkdir()
    for i, part in enumerate((lines[:150], lines[150:] + bad)):
        (folder / f"{i}.json").write_text("\n".join(part) + "\n")
    return str(folder), lines


def test_bronze_plays_and_dead_letters(spark, messages, tmp_path):
    folder, lines = messages
    root = f"{tmp_path}/root"
    for _ in range(2):  # the second run finds nothing new
        query = bronze.start_bronze_plays(text_messages(spark, folder, 1), root, f"{tmp_path}/checkpoint", None)
        bronze.wait_all(spark, [query])
    good, letters = spark.read.parquet(f"{root}/bronze_plays"), spark.read.parquet(f"{root}/bronze_plays_dlq")
    assert good.count() + letters.count() == len(lines) + 3
    errors = [r["error_message"] for r in letters.collect()]
    assert sum("malformed_message" in e for e in errors) == 1 and sum("missing_game_id" in e for e in errors) == 2
    decoded = quality.parse_plays(spark.createDataFrame([(x,) for x in [*lines, lines[0]]], "value string"))
    expected = plays.bronze_plays(decoded).filter("is_valid").select(*[c for c in good.columns if c in BRONZE_PLAY_SCHEMA.fieldNames() and c != "processing_timestamp"])
    assert spark_rows(good.select(*expected.columns)) == spark_rows(expected)


def test_a_replayed_batch_overwrites_itself(spark, inputs, tmp_path):
    from snapline.sources.tables import with_event_date

    rows = with_event_date(inputs.bronze)
    for _ in range(2):
        bronze._write_batch(rows, f"{tmp_path}/t", 7)
    bronze._write_batch(rows, f"{tmp_path}/t", 8)
    assert spark.read.parquet(f"{tmp_path}/t").count() == 2 * inputs.plays.count()


def test_bronze_tracking_and_dead_letters(spark, inputs, tmp_path):
    folder = tmp_path / "messages"
    frames = inputs.tracking.filter(F.col("game_id") == "G3")
    good = quality.flag_tracking(frames).filter("is_valid").limit(1).drop(*[c for c in quality.flag_tracking(frames).columns if c not in frames.columns]).persist()
    odd = [good.withColumn("team", F.lit(None).cast("string")), good.withColumn("player_id", F.lit(None).cast("string")), good, good]
    sent = frames
    for rows in odd:  # without a team, without a player, and two copies
        sent = sent.unionByName(rows)
    derived.as_messages(sent).coalesce(2).write.text(str(folder))
    root = f"{tmp_path}/root"
    started = bronze.start_bronze_tracking(text_messages(spark, str(folder)), root, f"{tmp_path}/checkpoint", None)
    bronze.wait_all(spark, started)
    letters = spark.read.parquet(f"{root}/bronze_tracking_dlq")
    kept = spark.read.parquet(f"{root}/tracking_frames")
    invalid = quality.flag_tracking(frames).filter("NOT is_valid").count()
    assert letters.count() == invalid + 2 > 2
    assert kept.filter("is_accepted").count() + letters.count() == frames.count() + 4
    assert spark.read.parquet(f"{root}/bronze_tracking").filter("team IS NULL OR player_id IS NULL").isEmpty()
    assert {p["query"] for p in bronze.progress(started)} == {"tracking_frames", "bronze_tracking"}


def test_a_failing_query_is_raised(spark, tmp_path):
    stream = in_files(spark, tmp_path / "in", [[("a",)]], "v string")
    broken = stream.select(F.raise_error(F.col("v")).alias("v")).writeStream.format("noop").option("checkpointLocation", f"{tmp_path}/c").start()
    with pytest.raises(Exception, match="USER_RAISED_EXCEPTION|a"):
        bronze.wait_all(spark, [broken])
