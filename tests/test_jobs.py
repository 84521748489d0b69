"""Messages in, gold out: the jobs in their order over one layout."""

import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from compare import spark_rows
from conftest import SMALL
from snapline.operators import features, history
from snapline.plans import derived, jobs
from snapline.plans.queries import rounded
from snapline.sources.messages import text_messages
from snapline.streaming import bronze
from snapline.streaming.replay import CLOSING_GAME, closing_row

AS_OF = dt.date(2024, 1, 31)


@pytest.fixture(scope="module")
def layout(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("jobs")
    layout = jobs.Layout(f"{folder}/tables", f"{folder}/checkpoints")
    events = derived.read_table(spark, SMALL, "events")
    events = events.unionByName(closing_row(events))
    derived.as_messages(derived.plays_from_events(events)).coalesce(2).write.text(f"{folder}/plays")
    derived.as_messages(derived.tracking_from_events(events)).coalesce(2).write.text(f"{folder}/tracking")
    with pytest.raises(FileNotFoundError):
        jobs.run_silver(spark, layout, None)
    plays = jobs.run_bronze_plays(text_messages(spark, f"{folder}/plays"), layout, None)
    tracking = jobs.run_bronze_tracking(text_messages(spark, f"{folder}/tracking"), layout, None)
    bronze.wait_all(spark, plays + tracking)
    # The closing row leaves the tracking state only behind a later one, so it ends up in plays alone.
    bronze.wait_all(spark, jobs.run_silver(spark, layout, None))
    return layout


def test_silver_equals_batch(spark, layout, inputs):
    from snapline.operators.silver import silver_plays

    found = jobs.read_silver(spark, layout).filter(F.col("game_id") != CLOSING_GAME)
    batch = silver_plays(inputs.bronze.filter("is_valid"), inputs.bronze_tracking)
    # The tracking watermark stands at the last real frame, which holds back the last minutes of plays.
    assert found.count() > 0.98 * batch.count()
    batch = batch.join(found.select("game_id", "play_id"), ["game_id", "play_id"], "left_semi")
    assert spark_rows(rounded(found.select(*batch.columns))) == spark_rows(rounded(batch))


def test_history(spark, layout):
    written = jobs.run_history(spark, layout, dt.date(2024, 1, 8), dt.date(2024, 1, 21))
    silver = jobs.read_silver(spark, layout).filter(F.col("event_date").between("2024-01-08", "2024-01-21"))
    expected = history.team_rankings(history.game_aggregates(silver))
    other = jobs.run_history(spark, layout, dt.date(2024, 1, 22), dt.date(2024, 1, 28))
    stored = spark.read.parquet(layout.path("gold_game_aggregates"))
    assert stored.count() == written["gold_game_aggregates"] + other["gold_game_aggregates"]
    assert spark.read.parquet(layout.path("gold_weekly_aggregates")).count() == written["gold_weekly_aggregates"] + other["gold_weekly_aggregates"]
    found = stored.filter("event_date <= '2024-01-21'").drop("event_date")
    assert written["gold_game_aggregates"] == found.count()
    assert spark_rows(rounded(found)) == spark_rows(rounded(expected))


def test_features(spark, layout):
    rows = jobs.run_features(spark, layout, AS_OF - dt.timedelta(days=1), 10)
    stored = layout.path("gold_ml_features")
    found = spark.read.parquet(stored)
    silver = jobs.read_silver(spark, layout).filter(F.col("event_date").between("2024-01-20", "2024-01-29"))
    assert rows == found.count() > 0 and len(found.columns) == 36
    expected = features.ml_features(silver).filter(F.to_date("event_timestamp") == "2024-01-29")
    columns = [c for c in found.columns if c != "event_date"]
    before = spark_rows(rounded(found.select(*columns)))
    assert before == spark_rows(rounded(expected.select(*columns)))
    # The next day's run leaves the day as it is.
    jobs.run_features(spark, layout, AS_OF, 10)
    found = spark.read.parquet(stored)
    assert found.select("event_date").distinct().count() == 2
    assert spark_rows(rounded(found.filter("event_date = '2024-01-29'").select(*columns))) == before


def test_gold_keeps_other_days(spark, layout):
    first = jobs.run_gold(spark, layout, dt.date(2024, 1, 20), min_plays=0)
    second = jobs.run_gold(spark, layout, dt.date(2024, 1, 21), min_plays=0)
    for name in ("gold_play_effectiveness", "gold_win_probability", "gold_team_daily_stats"):
        assert spark.read.parquet(layout.path(name)).count() == first[name] + second[name]
    assert spark.read.parquet(layout.path("team_stats_snapshot")).count() == second["team_stats_snapshot"]
    with pytest.raises(ValueError):
        jobs.run_gold(spark, layout, dt.date(2024, 1, 21), min_plays=10**6)


def test_jobs_leave_no_work_folders(spark, layout, tmp_path, monkeypatch):
    import tempfile

    from snapline.session import scratch, work_dir

    monkeypatch.setattr(tempfile, "tempdir", str(tmp_path))
    shared = (spark.conf.get("spark.checkpoint.dir", None) or "").removeprefix("file://")
    places = [tmp_path, *([Path(shared)] if shared else [])]
    names = lambda: {f.name for at in places if at.exists() for f in at.iterdir()}
    before = names()
    held = lambda: [n for n in names() - before if n.startswith(("snapline-", "ranges-", "ranked-", "numbered-", "kept-"))]
    assert jobs.run_features(spark, layout, dt.date(2024, 1, 15), 10) > 0
    jobs.run_history_days(spark, layout, dt.date(2024, 1, 8), dt.date(2024, 1, 9))
    assert held() == []
    with pytest.raises(ZeroDivisionError), scratch(spark):
        spark.range(1).write.mode("overwrite").parquet(work_dir(spark, "kept"))
        raise ZeroDivisionError
    assert len(held()) == 1  # what a failed job stored can be looked at
