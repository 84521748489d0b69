"""Bucketed tables, levels of expected yards, partial sums per day, and the progress of every batch."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from compare import spark_rows
from snapline.operators import gold, history
from snapline.plans import derived, jobs
from snapline.plans.queries import rounded
from snapline.schemas import PLAY_KEY
from snapline.session import work_dir
from snapline.sources.bucketed import ensure_bucketed, write_bucketed_days
from snapline.sources.messages import text_messages
from snapline.sources.tables import with_event_date
from snapline.streaming import bronze
from snapline.streaming.listener import BatchProgress, stop_between_batches


@pytest.fixture(scope="module")
def silver(spark, inputs):
    path = work_dir(spark, "test-silver")
    with_event_date(inputs.silver).write.parquet(path)
    return spark.read.parquet(path)


def exchanges(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("Initial Plan")[0].count("Exchange ")


def test_bucketed_tables_join_without_an_exchange(spark, silver, tmp_path):
    made = {"eff": gold.play_effectiveness(silver), "wp": gold.win_probability(silver)}
    for name, df in made.items():
        assert write_bucketed_days(df, f"t_{name}", f"{tmp_path}/{name}", "game_date", 4) == df.count()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.table("t_eff").join(spark.table("t_wp").select(*PLAY_KEY, "win_prob_added"), PLAY_KEY)
        assert exchanges(joined) == 0 and joined.count() == silver.count()
        # Team statistics: folds and join stay in their buckets; only the sums per team travel.
        stats = gold.team_daily_stats(spark.table("t_eff"), spark.table("t_wp"))
        assert exchanges(stats) == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert spark_rows(rounded(stats)) == spark_rows(rounded(gold.team_daily_stats(made["eff"], made["wp"])))
    # Another session finds the files; a day written again is replaced, the others stay.
    spark.sql("DROP TABLE t_eff")
    ensure_bucketed(spark, "t_eff", f"{tmp_path}/eff", made["eff"].schema, "game_date", 4)
    day = made["eff"].agg(F.min("game_date")).first()[0]
    write_bucketed_days(made["eff"].filter(F.col("game_date") == F.lit(day)).limit(3), "t_eff", f"{tmp_path}/eff", "game_date", 4)
    counts = {r["game_date"]: r["count"] for r in spark.table("t_eff").groupBy("game_date").count().collect()}
    whole = {r["game_date"]: r["count"] for r in made["eff"].groupBy("game_date").count().collect()}
    assert counts == whole | {day: 3}
    for name in made:
        spark.sql(f"DROP TABLE t_{name}")


def test_unseen_situations_get_the_next_level(spark, inputs):
    levels = gold.historical_levels(inputs.plays.filter("play_type = 'run' AND down = 1"))
    assert levels.filter("level = 0").count() == 1 and levels.count() <= 531
    found = gold.add_backed_off_expected_yards(inputs.plays, levels, min_plays=1)
    assert found.count() == inputs.plays.count()
    assert found.filter("expected_yards_gained IS NULL").isEmpty()
    assert {r["level"] for r in found.filter("play_type = 'pass'").select("level").distinct().collect()} == {0}
    assert {r["level"] for r in found.filter("play_type = 'run' AND down = 2").select("level").distinct().collect()} == {1}
    assert 4 in {r["level"] for r in found.filter("play_type = 'run' AND down = 1").select("level").distinct().collect()}
    empty = gold.add_backed_off_expected_yards(inputs.plays, gold.historical_levels(inputs.plays.limit(0)))
    assert empty.count() == inputs.plays.count()


def test_two_ranges_that_cut_a_week_equal_one_run(spark, silver, tmp_path):
    def layout(name):
        at = jobs.Layout(f"{tmp_path}/{name}", f"{tmp_path}/{name}-c")
        silver.write.partitionBy("event_date").parquet(at.path("silver_plays_enriched"))
        return at

    one, cut = layout("one"), layout("cut")
    jobs.run_history_days(spark, one, dt.date(2024, 1, 3), dt.date(2024, 1, 26))
    jobs.run_history_days(spark, cut, dt.date(2024, 1, 12), dt.date(2024, 1, 26))  # a Friday; the earlier range comes late
    jobs.run_history_days(spark, cut, dt.date(2024, 1, 3), dt.date(2024, 1, 11))
    days = spark.read.parquet(one.path("gold_day_partials")).count()
    again = jobs.run_history_days(spark, cut, dt.date(2024, 1, 11), dt.date(2024, 1, 12))  # once more: nothing counts twice
    assert 0 < again["gold_day_partials"] < days == spark.read.parquet(cut.path("gold_day_partials")).count()
    for name in ("gold_games", "gold_weeks"):
        assert spark_rows(rounded(spark.read.parquet(cut.path(name)))) == spark_rows(rounded(spark.read.parquet(one.path(name))))
    part = silver.filter(F.col("event_date").between("2024-01-03", "2024-01-26"))
    expected = history.team_rankings(rounded(history.game_aggregates(part)))
    found = history.team_rankings(rounded(history.games_from_partials(spark.read.parquet(cut.path("gold_day_partials")))))
    assert spark_rows(rounded(found)) == spark_rows(rounded(expected))
    weeks = history.moving_averages(history.weekly_aggregates(part))
    assert spark_rows(rounded(spark.read.parquet(cut.path("gold_weeks")))) == spark_rows(rounded(weeks))


def test_bucketed_gold_job(spark, silver, tmp_path):
    layout = jobs.Layout(f"{tmp_path}/t", f"{tmp_path}/c")
    silver.write.partitionBy("event_date").parquet(layout.path("silver_plays_enriched"))
    for day in (20, 21):
        written = jobs.run_gold_bucketed(spark, layout, dt.date(2024, 1, day), 4)
        assert written["gold_play_effectiveness_bucketed"] == written["gold_win_probability_bucketed"] > 0
    assert spark.read.parquet(layout.path("gold_team_daily_stats")).select("stat_date").distinct().count() == 2
    for name in ("gold_play_effectiveness_bucketed", "gold_win_probability_bucketed"):
        spark.sql(f"DROP TABLE {name}")


def test_every_batch_has_a_row_of_progress(spark, inputs, tmp_path):
    lines = [r["value"] for r in derived.as_messages(inputs.plays).limit(120).collect()]
    (tmp_path / "in").mkdir()
    for i in range(12):
        (tmp_path / "in" / f"{i}.json").write_text("\n".join(lines[i * 10 : i * 10 + 10]) + "\n")
    listener = BatchProgress()
    spark.streams.addListener(listener)
    try:
        query = bronze.start_bronze_plays(text_messages(spark, str(tmp_path / "in"), 1), f"{tmp_path}/root", f"{tmp_path}/c", None)
        bronze.wait_all(spark, [query])
        listener.wait_ended([query])
    finally:
        spark.streams.removeListener(listener)
    assert listener.write(spark, f"{tmp_path}/progress") >= 12 and listener.write(spark, f"{tmp_path}/progress") == 0
    rows = spark.read.parquet(f"{tmp_path}/progress").filter(F.col("query") == "bronze_plays").collect()
    assert sorted(r["batch"] for r in rows if r["rows_read"]) == list(range(12))
    assert all(r["rows_read"] in (0, 10) and r["duration_ms"] >= 0 for r in rows)


def test_queries_stop_between_batches(spark, tmp_path):
    """What a stopped query has written is whole batches, and the next start goes on after them."""
    stream = spark.readStream.format("rate").option("rowsPerSecond", 200).load()
    query = stream.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/c").trigger(processingTime="100 milliseconds").start()
    while query.lastProgress is None or query.lastProgress["batchId"] < 2:
        query.processAllAvailable()
    stop_between_batches([query])
    assert not query.isActive and query.exception() is None
    import os

    assert {f for f in os.listdir(f"{tmp_path}/c/offsets") if f.isdigit()} == {f for f in os.listdir(f"{tmp_path}/c/commits") if f.isdigit()}
