"""Message schemas, table layouts and column lists."""

from __future__ import annotations

from pyspark.sql import types as T

PLAY_KEY = ["game_id", "play_id"]
PLAYER_KEY = PLAY_KEY + ["player_id"]

PLAY_SCHEMA = T.StructType(
    [
        T.StructField("game_id", T.StringType(), False),
        T.StructField("play_id", T.StringType(), False),
        T.StructField("event_timestamp", T.TimestampType(), False),
        T.StructField("possession_team", T.StringType()),
        T.StructField("defensive_team", T.StringType()),
        T.StructField("down", T.IntegerType()),
        T.StructField("yards_to_go", T.IntegerType()),
        T.StructField("yard_line", T.IntegerType()),
        T.StructField("quarter", T.IntegerType(), False),
        T.StructField("time_remaining", T.IntegerType()),
        T.StructField("play_type", T.StringType()),
        T.StructField("play_result", T.StringType()),
        T.StructField("yards_gained", T.IntegerType()),
        T.StructField("is_touchdown", T.BooleanType()),
        T.StructField("is_turnover", T.BooleanType()),
        T.StructField("is_penalty", T.BooleanType()),
        T.StructField("penalty_yards", T.IntegerType()),
        T.StructField("score_home", T.IntegerType()),
        T.StructField("score_away", T.IntegerType()),
        T.StructField("formation", T.StringType()),
        T.StructField("personnel_offense", T.StringType()),
        T.StructField("personnel_defense", T.StringType()),
    ]
)

# Coordinates and rates are doubles, so that batch, stream and SQL results agree to the last digit kept.
TRACKING_SCHEMA = T.StructType(
    [
        T.StructField("game_id", T.StringType(), False),
        T.StructField("play_id", T.StringType(), False),
        T.StructField("timestamp", T.TimestampType(), False),
        T.StructField("frame_id", T.IntegerType(), False),
        T.StructField("player_id", T.StringType(), False),
        T.StructField("team", T.StringType(), False),
        T.StructField("jersey_number", T.IntegerType()),
        T.StructField("position", T.StringType()),
        T.StructField("x_coord", T.DoubleType(), False),
        T.StructField("y_coord", T.DoubleType(), False),
        T.StructField("speed", T.DoubleType()),
        T.StructField("acceleration", T.DoubleType()),
        T.StructField("direction", T.DoubleType()),
        T.StructField("orientation", T.DoubleType()),
        T.StructField("event", T.StringType()),
    ]
)

DEAD_LETTER_SCHEMA = T.StructType(
    [
        T.StructField("game_id", T.StringType()),
        T.StructField("play_id", T.StringType()),
        T.StructField("raw_data", T.StringType()),
        T.StructField("error_message", T.StringType()),
        T.StructField("processing_timestamp", T.TimestampType(), False),
    ]
)

PLAY_DERIVED = [
    "processing_timestamp",
    "is_valid",
    "is_red_zone",
    "is_two_minute_drill",
    "play_success",
    "score_differential",
    "game_situation",
]

BRONZE_PLAY_SCHEMA = T.StructType(
    PLAY_SCHEMA.fields
    + [
        T.StructField("processing_timestamp", T.TimestampType(), False),
        T.StructField("is_valid", T.BooleanType(), False),
        T.StructField("is_red_zone", T.BooleanType()),
        T.StructField("is_two_minute_drill", T.BooleanType()),
        T.StructField("play_success", T.BooleanType()),
        T.StructField("score_differential", T.IntegerType()),
        T.StructField("game_situation", T.StringType()),
    ]
)

# The published table, in its order.
BRONZE_TRACKING_SCHEMA = T.StructType(
    [
        T.StructField("game_id", T.StringType(), False),
        T.StructField("play_id", T.StringType(), False),
        T.StructField("timestamp", T.TimestampType(), False),
        T.StructField("frame_id", T.IntegerType(), False),
        T.StructField("player_id", T.StringType(), False),
        T.StructField("team", T.StringType(), False),
        T.StructField("jersey_number", T.IntegerType()),
        T.StructField("position", T.StringType()),
        T.StructField("x_coord", T.DoubleType(), False),
        T.StructField("y_coord", T.DoubleType(), False),
        T.StructField("final_speed", T.DoubleType()),
        T.StructField("calculated_acceleration", T.DoubleType()),
        T.StructField("direction", T.DoubleType()),
        T.StructField("orientation", T.DoubleType()),
        T.StructField("event", T.StringType()),
        T.StructField("distance_traveled", T.DoubleType()),
        T.StructField("processing_timestamp", T.TimestampType(), False),
    ]
)
BRONZE_TRACKING_COLUMNS = BRONZE_TRACKING_SCHEMA.fieldNames()

REQUIRED_PLAY_COLUMNS = [
    "game_id",
    "play_id",
    "event_timestamp",
    "possession_team",
    "defensive_team",
    "quarter",
]
REQUIRED_TRACKING_COLUMNS = [
    "game_id",
    "play_id",
    "timestamp",
    "frame_id",
    "player_id",
    "team",
    "x_coord",
    "y_coord",
]

# Sort order inside each day partition; Parquet min/max statistics then skip row groups.
CLUSTER_BY = {
    "bronze_plays": ["game_id", "possession_team"],
    "bronze_tracking": ["game_id", "play_id", "player_id"],
    "silver_plays_enriched": ["game_id", "possession_team", "play_type"],
    "gold_play_effectiveness": ["possession_team", "play_type"],
    "gold_win_probability": ["game_id"],
    "gold_team_daily_stats": ["team"],
}

FEATURE_COLUMNS = [
    "game_id",
    "play_id",
    "event_timestamp",
    "play_success",
    "yards_gained",
    "down",
    "yards_to_go",
    "yard_line",
    "quarter",
    "time_remaining_total",
    "score_differential",
    "is_winning",
    "is_close_game",
    "is_red_zone",
    "is_two_minute_drill",
    "is_clutch_time",
    "field_position_category",
    "game_situation",
    "is_passing_down",
    "is_short_yardage",
    "down_distance_ratio",
    "rolling_avg_yards",
    "rolling_success_rate",
    "rolling_pressure",
    "plays_since_turnover",
    "speed_advantage",
    "separation_quality",
    "is_high_pressure",
    "defensive_pressure_rate",
    "opp_avg_yards_allowed",
    "opp_success_rate_allowed",
    "opp_pressure_rate",
    "redzone_pressure",
    "clutch_pressure",
    "winning_conservative",
]
