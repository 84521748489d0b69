"""Compaction under a running stream, a log with offsets, repair of late frames, and keyed snapshots that expire."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from compare import spark_rows
from snapline.operators import quality, tracking
from snapline.plans import derived
from snapline.plans.queries import rounded
from snapline.schemas import BRONZE_TRACKING_COLUMNS
from snapline.sources import compaction, log, tables
from snapline.sources.messages import table_stream, text_messages
from snapline.streaming import bronze, repair

DAY = dt.date(2024, 1, 5)


def files(path):
    return sorted(f"{at}/{name}" for at, _, names in os.walk(path) for name in names if name.endswith(".parquet"))


def test_many_batches_become_few_files_under_a_running_stream(spark, tmp_path):
    path, out, checkpoint = f"{tmp_path}/t", f"{tmp_path}/out", f"{tmp_path}/c"

    def batch(number, day=DAY):
        rows = spark.range(5 * number, 5 * number + 5).select(F.col("id").alias("n"), F.lit(f"g{number % 3}").alias("game_id"), F.lit(day).alias("event_date"))
        bronze._write_batch(rows.coalesce(1), path, number)

    def seen():
        stream = table_stream(spark, path, spark.read.parquet(path).schema).writeStream.format("parquet").option("path", out)
        stream.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
        return sorted(r["n"] for r in spark.read.parquet(out).collect())

    def table():
        return sorted(r["n"] for r in compaction.read_compacted(spark, path).collect())

    for i in range(30):
        batch(i)
    batch(30, dt.date(2024, 1, 6))
    assert seen() == table() == list(range(155))
    for i in range(31, 34):
        batch(i)  # the stream has not read these yet
    assert compaction.compact_day(spark, path, DAY, ["game_id"], files=2) == 33
    assert table() == list(range(170))
    assert len(files(compaction.compact_path(path))) == 2 and len(files(path)) == 34
    with pytest.raises(ValueError, match="has not read"):
        compaction.remove_batches(spark, path, DAY, [checkpoint])
    assert seen() == list(range(170))
    assert compaction.remove_batches(spark, path, DAY, [checkpoint]) == 33
    assert len(files(path)) == 1 and table() == seen() == list(range(170))
    # Late batches of the closed day, and a second compaction with them.
    batch(34)
    assert table() == seen() == list(range(175))
    assert compaction.compact_day(spark, path, DAY, ["game_id"], files=2) == 34
    assert compaction.compact_day(spark, path, DAY, ["game_id"], files=2) is None
    assert table() == list(range(175)) and len(files(compaction.compact_path(path))) == 2
    # A crash before the rename leaves only what no reader sees.
    spark.range(3).write.parquet(f"{compaction.compact_path(path)}/_staged/{DAY}-x")
    assert table() == list(range(175))


def test_compact_days_are_skipped_in_the_table(spark, tmp_path):
    path = f"{tmp_path}/t"
    for i in range(4):
        rows = spark.range(3).select(F.col("id").alias("n"), F.lit(DAY + dt.timedelta(days=i % 2)).alias("event_date"))
        bronze._write_batch(rows, path, i)
    compaction.compact_day(spark, path, DAY, ["n"], files=1)
    rows = compaction.read_compacted(spark, path)
    assert rows.count() == 12 and "PartitionFilters: [" in rows._jdf.queryExecution().executedPlan().toString()
    assert rows.filter(F.col("event_date") == F.lit(DAY)).select("n").count() == 6


@pytest.fixture
def segments(spark, tmp_path):
    path = f"{tmp_path}/log"
    log.write_segments(spark.range(1000).select(F.col("id").alias("offset"), F.concat(F.lit('{"n":'), "id", F.lit("}")).alias("value")).repartition(3), path, 5)
    return path


def drain(df, folder):
    df.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/c").trigger(availableNow=True).start().awaitTermination()
    return sorted((r["offset"], r["value"]) for r in df.sparkSession.read.parquet(f"{folder}/out").collect())


def test_a_log_is_read_from_an_offset_on(spark, segments, tmp_path):
    everything = [(i, f'{{"n":{i}}}') for i in range(1000)]
    assert len(log.segments(segments)) > 1
    assert sorted(map(tuple, log.log_messages(spark, segments, stream=False).collect())) == everything
    assert drain(log.log_messages(spark, segments), f"{tmp_path}/a") == everything
    assert drain(log.log_messages(spark, segments, 640), f"{tmp_path}/b") == everything[640:]
    # A restart goes on after its checkpoint.
    with open(f"{segments}/{1000:020d}-{1001:020d}.jsonl", "w") as out:
        out.write('{"n":1000}\n{"n":1001}\n')
    assert drain(log.log_messages(spark, segments), f"{tmp_path}/a") == everything + [(1000, '{"n":1000}'), (1001, '{"n":1001}')]


def test_a_removed_range_fails_or_is_left_out(spark, segments, tmp_path):
    first, last, file = log.segments(segments)[0]
    os.remove(file)
    assert drain(log.log_messages(spark, segments), f"{tmp_path}/a")[0][0] == last + 1  # the earliest there is
    with pytest.raises(Exception, match="no longer in the log"):
        drain(log.log_messages(spark, segments, 0), f"{tmp_path}/b")
    found = drain(log.log_messages(spark, segments, 0, fail_on_data_loss=False), f"{tmp_path}/c")
    assert [n for n, _ in found] == list(range(last + 1, 1000))
    _, _, middle = log.segments(segments)[1]
    os.remove(middle)
    with pytest.raises(ValueError, match="no longer"):
        log.ranges(segments, last + 1, 1000, True)


def test_late_frames_are_repaired(spark, inputs, tmp_path):
    """Some frames come after the watermark has passed them; the repaired table equals the batch form."""
    frames = inputs.tracking.filter(F.col("game_id").isin("G3", "G4", "G5")).withColumn("late", F.expr("crc32(player_id) % 7 = 0 AND frame_id = 1"))
    root, folder = f"{tmp_path}/root", f"{tmp_path}/messages"
    closing = frames.limit(1).withColumns({"game_id": F.lit("END"), "timestamp": F.expr("timestamp'2031-01-01 00:00:00'").cast("timestamp_ntz")})
    for part in (frames.filter("NOT late"), closing, closing, frames.filter("late")):
        derived.as_messages(part.drop("late")).coalesce(1).write.mode("append").text(folder)
        bronze.wait_all(spark, bronze.start_bronze_tracking(text_messages(spark, folder), root, f"{tmp_path}/c", None))
    whole = frames.drop("late").filter("game_id <> 'END'")
    expected = tracking.derive_tracking(quality.flag_tracking(derived.with_zone(whole)), gap_seconds=30).filter("is_valid")
    columns = [c for c in BRONZE_TRACKING_COLUMNS if c != "processing_timestamp"]

    def found():
        return repair.read_tracking(spark, root).filter("game_id <> 'END'").select(*columns)

    lacking = expected.count() - found().count()
    assert lacking > 0
    touched = frames.filter("late").count()
    written = repair.repair_late_frames(spark, root)
    assert touched <= written < expected.count()
    assert spark_rows(rounded(found())) == spark_rows(rounded(expected.select(*columns)))
    repaired = files(repair.repaired_path(root))
    # Only the closing rows, still in the stream's state, are left; nothing else is touched again.
    repair.repair_late_frames(spark, root)
    assert spark_rows(rounded(found())) == spark_rows(rounded(expected.select(*columns)))
    assert len(set(repaired) & set(files(repair.repaired_path(root)))) >= len(repaired) - 2


def test_a_snapshot_is_merged_and_expires(spark, tmp_path):
    path = f"{tmp_path}/snapshot"
    noon = dt.datetime(2024, 1, 5, 12)

    def day(number, keys):
        rows = [(f"team_stats:{k}", f'{{"day":{number}}}', noon + dt.timedelta(days=number + 1)) for k in keys]
        return spark.createDataFrame(rows, "cache_key string, value_json string, expires_at timestamp_ntz")

    def held():
        return {r["cache_key"].split(":")[1]: r["value_json"] for r in spark.read.parquet(path).collect()}

    keys = [f"T{i}" for i in range(40)]
    assert tables.upsert_snapshot(day(0, keys), path, noon)["entries"] == 40
    before = files(path)
    first = tables.upsert_snapshot(day(1, keys[:2]), path, noon + dt.timedelta(hours=6))
    assert first["parts"] <= 2 and len(held()) == 40
    assert {k for k, v in held().items() if v == '{"day":1}'} == set(keys[:2])
    kept = set(before) & set(files(path))
    assert len(kept) == len(before) - first["parts"]  # unchanged parts keep their files
    # The same updates again, in a replayed batch, change nothing but the files.
    tables.upsert_snapshot(day(1, keys[:2]), path, noon + dt.timedelta(hours=6))
    assert len(held()) == 40
    tables.upsert_snapshot(day(1, keys[2:3]), path, noon + dt.timedelta(days=1))
    assert set(held()) == set(keys[:3])
    tables.upsert_snapshot(day(1, []), path, noon + dt.timedelta(days=3))
    assert files(path) == []
