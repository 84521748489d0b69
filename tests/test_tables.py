"""Scans and sinks."""

import datetime as dt
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from snapline.operators import gold
from snapline.session import work_dir
from snapline.sources import tables

DAY = dt.date(2024, 1, 10)


@pytest.fixture(scope="module")
def effectiveness(inputs):
    plain = inputs.bronze
    for name in ("offense_avg_speed", "defense_avg_speed", "defensive_pressure_rate", "avg_receiver_separation"):
        plain = plain.withColumn(name, F.lit(1.0))
    return gold.play_effectiveness(plain)


def test_scans_cut_at_midnight(inputs):
    plays = inputs.plays
    day = F.to_date("event_timestamp")
    inside = plays.filter(day.between(dt.date(2024, 1, 8), DAY)).count()
    assert tables.scan_date_range(plays, dt.date(2024, 1, 8), DAY).count() == inside
    assert tables.scan_yesterday(plays, DAY).count() == plays.filter(day == dt.date(2024, 1, 9)).count()
    assert tables.scan_lookback(plays, DAY, 5).count() == plays.filter(day >= dt.date(2024, 1, 5)).count()


def test_write_table_reports_rows(spark, inputs, tmp_path):
    path = str(tmp_path / "t")
    assert tables.write_table(inputs.plays, path) == inputs.plays.count()
    assert tables.write_table(inputs.plays.limit(7), path) == 7
    assert spark.read.parquet(path).count() == 7


def test_write_days_replaces_only_its_days(spark, effectiveness, tmp_path):
    path = str(tmp_path / "gold")
    tables.write_days(effectiveness, path, "game_date", ["possession_team", "play_type"])
    before = spark.read.parquet(path).groupBy("game_date").count().collect()
    one = effectiveness.filter(F.col("game_date") == DAY).limit(3)
    assert tables.write_days(one, path, "game_date", ["possession_team", "play_type"]) == 3
    after = {r["game_date"]: r["count"] for r in spark.read.parquet(path).groupBy("game_date").count().collect()}
    assert after == {r["game_date"]: r["count"] for r in before} | {DAY: 3}


def test_partition_filter_prunes_days(spark, inputs, tmp_path):
    path = str(tmp_path / "bronze")
    tables.write_days(tables.with_event_date(inputs.bronze), path, "event_date", ["game_id", "possession_team"])
    scan = tables.scan_yesterday(spark.read.parquet(path), DAY)
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan and "GreaterThanOrEqual(event_timestamp" in plan
    assert scan.count() == tables.scan_yesterday(inputs.bronze, DAY).count()


def test_files_are_sorted_by_the_cluster_columns(spark, effectiveness, tmp_path):
    path = str(tmp_path / "gold")
    tables.write_days(effectiveness, path, "game_date", ["possession_team", "play_type"])
    for file in list(tmp_path.rglob("*.parquet"))[:5]:
        rows = [(r["possession_team"], r["play_type"]) for r in spark.read.parquet(str(file)).collect()]
        assert rows == sorted(rows)


def test_snapshot_keeps_the_latest_day(spark):
    stats = spark.createDataFrame(
        [(dt.date(2024, 1, 1), "A", 5), (dt.date(2024, 1, 2), "A", 6), (dt.date(2024, 1, 1), "B", 7)], "stat_date date, team string, total_plays int"
    )
    found = {r["cache_key"]: r for r in tables.kv_snapshot(stats, dt.datetime(2024, 1, 3)).collect()}
    assert set(found) == {"team_stats:A", "team_stats:B"}
    assert '"total_plays":6' in found["team_stats:A"]["value_json"]
    assert found["team_stats:A"]["expires_at"] == dt.datetime(2024, 1, 4)


def test_table_exists(spark, inputs, tmp_path):
    path = str(tmp_path / "t")
    assert not tables.table_exists(spark, path)
    tables.write_table(inputs.plays.limit(1), path)
    assert tables.table_exists(spark, path)


def test_work_dir_lies_in_the_shared_folder():
    """The setting is fixed when a session starts, so stand-ins play the session here."""
    shared = SimpleNamespace(conf={"spark.checkpoint.dir": "/shared/ckpt/"})
    first, second = work_dir(shared, "a"), work_dir(shared, "a")
    assert first.startswith("/shared/ckpt/a-") and first != second
    cluster = SimpleNamespace(conf={}, sparkContext=SimpleNamespace(master="yarn"))
    with pytest.raises(ValueError):
        work_dir(cluster, "a")
