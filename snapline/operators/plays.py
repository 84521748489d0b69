"""Play enrichment: bronze columns and the row-level feature groups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapline.functions import plays as p
from snapline.operators.quality import flag_plays


def enrich_plays(df: DataFrame) -> DataFrame:
    """Flagged plays -> bronze plays."""
    return (
        df.withColumn("play_success", p.success())
        .withColumn("score_differential", F.col("score_home") - F.col("score_away"))
        .withColumn("game_situation", p.situation())
    )


def bronze_plays(df: DataFrame) -> DataFrame:
    """Decoded plays -> all rows with flags and derived columns."""
    return enrich_plays(flag_plays(df))


def add_wp_features(df: DataFrame) -> DataFrame:
    """Inputs of the win-probability model kept on silver.

    ``seconds_elapsed`` keeps its published name and formula, which gives the seconds *left*;
    ``seconds_remaining`` is the same with overtime counted by its own clock.
    """
    ratio = F.when(F.col("yards_to_go") > 0, F.col("down") / F.col("yards_to_go")).otherwise(0.0)
    return df.withColumns(
        {
            "seconds_elapsed": p.game_clock(),
            "seconds_remaining": p.game_clock_with_overtime(),
            "is_offense_leading": p.flag(F.col("score_differential") > 0),
            "field_position_value": 100 - F.col("yard_line"),
            "down_distance_ratio": ratio,
        }
    )


def add_game_context_features(df: DataFrame) -> DataFrame:
    close = F.col("score_differential").between(-7, 7)
    return df.withColumns(
        {
            "time_remaining_total": p.game_clock(),
            "is_winning": p.flag(F.col("score_differential") > 0),
            "is_close_game": p.flag(close),
            "is_clutch_time": p.flag((p.game_clock() < 300) & close),
            "field_position_category": p.field_zone(),
        }
    )


def add_down_distance_features(df: DataFrame) -> DataFrame:
    down, need = F.col("down"), F.col("yards_to_go")
    return df.withColumns(
        {
            "is_passing_down": p.flag(((down == 2) & (need >= 7)) | ((down == 3) & (need >= 5))),
            "is_short_yardage": p.flag(down.isin(3, 4) & (need <= 2)),
            "down_distance_ratio": F.try_divide(down, need + 1),
        }
    )


def add_tracking_derived_features(df: DataFrame) -> DataFrame:
    separation = F.col("avg_receiver_separation")
    return df.withColumns(
        {
            "speed_advantage": F.col("offense_avg_speed") - F.col("defense_avg_speed"),
            "separation_quality": F.when(separation >= 3.0, "open")
            .when(separation >= 1.5, "contested")
            .otherwise("covered"),
            "is_high_pressure": p.flag(F.col("defensive_pressure_rate") > 0.3),
        }
    )


def add_interaction_features(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "redzone_pressure": F.col("is_red_zone").cast("int") * F.col("is_high_pressure"),
            "clutch_pressure": F.col("is_clutch_time") * F.col("is_high_pressure"),
            "winning_conservative": F.col("is_winning") * p.flag(F.col("play_type") == "run"),
        }
    )
