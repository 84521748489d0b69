"""Whole jobs over one table layout: bronze, silver and gold.

Each job is a plain function of its inputs; dates are parameters, never the clock.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from snapline.operators import features, gold, history, quality
from snapline.schemas import BRONZE_PLAY_SCHEMA, BRONZE_TRACKING_SCHEMA, CLUSTER_BY
from snapline.session import scratch
from snapline.sources import tables
from snapline.sources.bucketed import write_bucketed_days
from snapline.sources.messages import table_stream
from snapline.streaming import bronze
from snapline.streaming.silver import far_frames, silver_stream


def in_scratch(job: Callable) -> Callable:
    """A job that has written its tables when it returns: what it stored on the way is removed then."""

    @wraps(job)
    def run(spark: SparkSession, *args, **settings):
        with scratch(spark):
            return job(spark, *args, **settings)

    return run


@dataclass(frozen=True)
class Layout:
    """Where tables and stream checkpoints live, on storage that all executors share."""

    root: str
    checkpoints: str

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"


def preflight(spark: SparkSession, layout: Layout, names: list[str]) -> None:
    """Fail early if a table a job reads is not there."""
    missing = [n for n in names if not tables.table_exists(spark, layout.path(n))]
    if missing:
        raise FileNotFoundError(f"missing tables: {', '.join(missing)}")


def run_bronze_plays(messages: DataFrame, layout: Layout, interval: str | None = "5 seconds") -> list[StreamingQuery]:
    return [bronze.start_bronze_plays(messages, layout.root, layout.checkpoints, interval)]


def run_bronze_tracking(messages: DataFrame, layout: Layout, interval: str | None = "2 seconds", **settings) -> list[StreamingQuery]:
    return bronze.start_bronze_tracking(messages, layout.root, layout.checkpoints, interval, **settings)


def run_silver(spark: SparkSession, layout: Layout, interval: str | None = "10 seconds", delay: str = "10 minutes") -> list[StreamingQuery]:
    """Deduplicated plays joined to tracking, from the bronze tables as they grow; frames far from any play go apart."""
    preflight(spark, layout, ["bronze_plays", "bronze_tracking"])
    day = T.StructField(tables.PARTITION, T.DateType())
    plays_schema = T.StructType([*BRONZE_PLAY_SCHEMA.fields, day, T.StructField(bronze.BATCH, T.LongType())])
    tracking_schema = T.StructType([*BRONZE_TRACKING_SCHEMA.fields, day])
    plays = table_stream(spark, layout.path("bronze_plays"), plays_schema).drop(tables.PARTITION, bronze.BATCH)
    frames = table_stream(spark, layout.path("bronze_tracking"), tracking_schema).drop(tables.PARTITION)
    rows = silver_stream(plays, frames, delay)
    far = far_frames(plays, frames, delay)
    return [
        bronze.start_append(rows, layout.path("silver_plays_enriched"), layout.checkpoints, interval),
        bronze.start_append(far, layout.path("silver_frames_apart"), layout.checkpoints, interval, "tracked_at"),
    ]


def read_silver(spark: SparkSession, layout: Layout) -> DataFrame:
    preflight(spark, layout, ["silver_plays_enriched"])
    return tables.read_table(spark, layout.path("silver_plays_enriched"))


@in_scratch
def run_history(spark: SparkSession, layout: Layout, start: dt.date, end: dt.date) -> dict[str, int]:
    """Game and week aggregates of a date range; returns rows written.

    Silver is read twice rather than cached: each reading takes only its own few columns. Games lie in folders by their first
    day in the range and weeks by their Monday; folders of other days keep what they hold. Give whole games and weeks.
    """
    silver = tables.scan_date_range(read_silver(spark, layout), start, end)
    games = history.team_rankings(history.game_aggregates(silver))
    days = silver.groupBy("game_id").agg(F.min(F.to_date("event_timestamp")).alias(tables.PARTITION))
    games = games.join(days, "game_id")
    weeks = history.moving_averages(history.weekly_aggregates(silver))
    return {
        "gold_game_aggregates": tables.write_days(games, layout.path("gold_game_aggregates"), tables.PARTITION, ["game_id"]),
        "gold_weekly_aggregates": tables.write_days(weeks, layout.path("gold_weekly_aggregates"), "week_start", ["possession_team"]),
    }


@in_scratch
def run_history_days(spark: SparkSession, layout: Layout, start: dt.date, end: dt.date) -> dict[str, int]:
    """Partial sums of the days of a range, then games and weeks merged from the partials of all days; returns rows written.

    Silver is read for these days only. A late day replaces its own partials, and games and weeks that lie in several ranges are merged
    whole. Partials are one row per day, game and team, so merging them all stays far below reading silver again; ranks compare all games
    in any case. Days of the range that have no rows any more keep their partials.
    """
    silver = tables.scan_date_range(read_silver(spark, layout), start, end)
    path = layout.path("gold_day_partials")
    written = {"gold_day_partials": tables.write_days(history.day_partials(silver), path, tables.PARTITION, ["game_id"])}
    partials = tables.read_table(spark, path)
    games = history.team_rankings(history.games_from_partials(partials))
    weeks = history.moving_averages(history.weeks_from_partials(partials))
    return written | {
        "gold_games": tables.write_table(games, layout.path("gold_games")),
        "gold_weeks": tables.write_table(weeks, layout.path("gold_weeks")),
    }


@in_scratch
def run_features(spark: SparkSession, layout: Layout, as_of: dt.date, lookback: int = 30, days: int = 1) -> int:
    """Features of the ``days`` days before ``as_of``; the days before these, back to ``lookback``, only fill their windows.

    A day is written by the run that has its windows whole, so later runs leave it as it is.
    """
    silver = tables.scan_lookback(read_silver(spark, layout), as_of, lookback)
    silver = tables.scan_date_range(silver, as_of - dt.timedelta(days=lookback), as_of - dt.timedelta(days=1))
    rows = tables.with_event_date(features.ml_features(silver)).filter(F.col(tables.PARTITION) >= F.lit(as_of - dt.timedelta(days=days)))
    return tables.write_days(rows, layout.path("gold_ml_features"), tables.PARTITION, ["game_id"])


@in_scratch
def run_gold_bucketed(spark: SparkSession, layout: Layout, as_of: dt.date, buckets: int = 64) -> dict[str, int]:
    """Effectiveness and win probability of the day before ``as_of`` in tables bucketed by play, and team statistics joined without an exchange.

    The tables are named in the session's catalog; give the same number of buckets in every run.
    """
    silver = tables.scan_yesterday(read_silver(spark, layout), as_of)
    made = {"gold_play_effectiveness_bucketed": gold.play_effectiveness(silver), "gold_win_probability_bucketed": gold.win_probability(silver)}
    written = {name: write_bucketed_days(df, name, layout.path(name), "game_date", buckets) for name, df in made.items()}
    stats = gold.team_daily_stats(*[spark.table(name) for name in made], as_of)
    written["gold_team_daily_stats"] = tables.write_days(stats, layout.path("gold_team_daily_stats"), "stat_date", CLUSTER_BY["gold_team_daily_stats"])
    return written


@in_scratch
def run_gold(spark: SparkSession, layout: Layout, as_of: dt.date, min_plays: float = 50) -> dict[str, int]:
    """Effectiveness, win probability, team statistics and snapshot of the day before ``as_of``.

    Each table keeps its other days. Raises if the day's statistics fail their check.
    """
    silver = tables.scan_yesterday(read_silver(spark, layout), as_of)

    def write(df: DataFrame, name: str, day: str = "game_date") -> int:
        return tables.write_days(df, layout.path(name), day, CLUSTER_BY[name])

    def read(name: str, day: str) -> DataFrame:
        return tables.scan_yesterday(tables.read_table(spark, layout.path(name)), as_of, day)

    written = {
        "gold_play_effectiveness": write(gold.play_effectiveness(silver), "gold_play_effectiveness"),
        "gold_win_probability": write(gold.win_probability(silver), "gold_win_probability"),
    }
    stats = gold.team_daily_stats(read("gold_play_effectiveness", "game_date"), read("gold_win_probability", "game_date"))
    written["gold_team_daily_stats"] = write(stats, "gold_team_daily_stats", "stat_date")
    stats = read("gold_team_daily_stats", "stat_date")
    snapshot = tables.kv_snapshot(stats, dt.datetime.combine(as_of, dt.time()))
    written["team_stats_snapshot"] = tables.write_table(snapshot, layout.path("team_stats_snapshot"))
    verdict = quality.check_gold(stats, min_plays).first()
    if not verdict["passed"]:
        raise ValueError(f"team statistics of the day before {as_of} failed their check: {verdict.asDict()}")
    return written
