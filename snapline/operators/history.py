"""Game and week aggregates, rankings and moving averages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from snapline.functions.plays import flag, share
from snapline.operators.ranks import dense_ranks_desc


def game_aggregates(silver: DataFrame) -> DataFrame:
    """13 measures per game and team. ``third_down_attempts`` is a share of plays, as published."""
    return silver.groupBy("game_id", "possession_team").agg(
        F.count("*").alias("total_plays"),
        F.sum("yards_gained").alias("total_yards"),
        F.avg("yards_gained").alias("avg_yards_per_play"),
        F.sum(flag(F.col("play_type") == "run")).alias("run_plays"),
        F.sum(flag(F.col("play_type") == "pass")).alias("pass_plays"),
        F.sum(flag(F.col("is_touchdown"))).alias("touchdowns"),
        F.sum(flag(F.col("is_turnover"))).alias("turnovers"),
        share(F.col("play_success")).alias("success_rate"),
        F.avg("offense_avg_speed").alias("avg_offense_speed"),
        F.avg("defensive_pressure_rate").alias("avg_pressure_faced"),
        F.avg("avg_receiver_separation").alias("avg_separation"),
        share(F.col("is_red_zone")).alias("red_zone_pct"),
        share(F.col("down") == 3).alias("third_down_attempts"),
    )


def _summands() -> dict[str, Column]:
    """What the means of games and weeks are made of; shares are means of 0 and 1 over all plays."""
    return {
        "yards": F.col("yards_gained"),
        "success": F.when(F.col("play_success"), 1.0).otherwise(0.0),
        "speed": F.col("offense_avg_speed"),
        "pressure": F.col("defensive_pressure_rate"),
        "separation": F.col("avg_receiver_separation"),
        "red_zone": F.when(F.col("is_red_zone"), 1.0).otherwise(0.0),
        "third_down": F.when(F.col("down") == 3, 1.0).otherwise(0.0),
    }


def day_partials(silver: DataFrame) -> DataFrame:
    """Sums and counts per day, game and team, from which games and weeks of any range are merged."""
    means = [x for name, c in _summands().items() for x in (F.sum(c.cast("double")).alias(f"{name}_sum"), F.count(c).alias(f"{name}_n"))]
    return silver.groupBy(F.to_date("event_timestamp").alias("event_date"), "game_id", "possession_team").agg(
        F.count("*").alias("plays"),
        F.sum("yards_gained").alias("yards"),
        F.sum(flag(F.col("play_type") == "run")).alias("runs"),
        F.sum(flag(F.col("play_type") == "pass")).alias("passes"),
        F.sum(flag(F.col("is_touchdown"))).alias("touchdowns"),
        F.sum(flag(F.col("is_turnover"))).alias("turnovers"),
        *means,
    )


def _mean(name: str) -> Column:
    return F.try_divide(F.sum(f"{name}_sum"), F.sum(f"{name}_n"))


def games_from_partials(partials: DataFrame) -> DataFrame:
    """``game_aggregates`` of all days that the partials cover."""
    return partials.groupBy("game_id", "possession_team").agg(
        F.sum("plays").alias("total_plays"),
        F.sum("yards").alias("total_yards"),
        _mean("yards").alias("avg_yards_per_play"),
        F.sum("runs").alias("run_plays"),
        F.sum("passes").alias("pass_plays"),
        F.sum("touchdowns").alias("touchdowns"),
        F.sum("turnovers").alias("turnovers"),
        _mean("success").alias("success_rate"),
        _mean("speed").alias("avg_offense_speed"),
        _mean("pressure").alias("avg_pressure_faced"),
        _mean("separation").alias("avg_separation"),
        _mean("red_zone").alias("red_zone_pct"),
        _mean("third_down").alias("third_down_attempts"),
    )


def weeks_from_partials(partials: DataFrame) -> DataFrame:
    """``weekly_aggregates`` of all days that the partials cover."""
    return partials.groupBy(F.to_date(F.date_trunc("week", "event_date")).alias("week_start"), "possession_team").agg(
        F.sum("plays").alias("total_plays"),
        _mean("yards").alias("avg_yards_per_play"),
        _mean("success").alias("success_rate"),
        _mean("speed").alias("avg_offense_speed"),
    )


def team_rankings(games: DataFrame) -> DataFrame:
    return dense_ranks_desc(
        games, {"avg_yards_per_play": "yards_per_play_rank", "success_rate": "success_rate_rank"}
    )


def weekly_aggregates(silver: DataFrame) -> DataFrame:
    """Per team and week; a week is named by its Monday."""
    return silver.groupBy(
        F.to_date(F.date_trunc("week", "event_timestamp")).alias("week_start"), "possession_team"
    ).agg(
        F.count("*").alias("total_plays"),
        F.avg("yards_gained").alias("avg_yards_per_play"),
        share(F.col("play_success")).alias("success_rate"),
        F.avg("offense_avg_speed").alias("avg_offense_speed"),
    )


def moving_averages(weekly: DataFrame, n: int = 3) -> DataFrame:
    """Mean of the last ``n`` weeks. The input has one row per team and week, so groups stay small."""
    window = W.partitionBy("possession_team").orderBy("week_start").rowsBetween(1 - n, 0)
    return weekly.withColumns(
        {
            f"ma{n}_yards_per_play": F.avg("avg_yards_per_play").over(window),
            f"ma{n}_success_rate": F.avg("success_rate").over(window),
        }
    )
