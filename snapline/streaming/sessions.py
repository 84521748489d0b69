"""Sessions: stretches of a game, or of a player's frames, without a gap; the same function for tables and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapline.schemas import PLAYER_KEY

DELAY = "10 minutes"


def play_sessions(plays: DataFrame, gap: str = "6 hours", delay: str | None = None) -> DataFrame:
    """Per game and stretch of plays not more than ``gap`` apart: first and last play, plays, yards and touchdowns.

    With ``delay`` (streams) a session comes out once the watermark has passed its end. Sessions merge as plays arrive in any order; their
    state is one row of sums per session, not per play.
    """
    rows = plays if delay is None else plays.withWatermark("event_timestamp", delay)
    sessions = rows.groupBy("game_id", F.session_window("event_timestamp", gap).alias("w")).agg(
        F.min("event_timestamp").alias("first_play"),
        F.max("event_timestamp").alias("last_play"),
        F.count("*").alias("plays"),
        F.sum("yards_gained").alias("yards"),
        F.count_if("is_touchdown").alias("touchdowns"),
    )
    return sessions.select("game_id", F.col("w.start").alias("session_start"), "first_play", "last_play", "plays", "yards", "touchdowns")


def frame_sessions(frames: DataFrame, gap: str = "30 seconds", delay: str | None = None) -> DataFrame:
    """Per player and stretch of frames not more than ``gap`` apart: first and last frame, frames and top speed."""
    rows = frames if delay is None else frames.withWatermark("timestamp", delay)
    sessions = rows.groupBy(*PLAYER_KEY, F.session_window("timestamp", gap).alias("w")).agg(
        F.min("timestamp").alias("first_frame"), F.max("timestamp").alias("last_frame"), F.count("*").alias("frames"), F.max("speed").alias("top_speed")
    )
    return sessions.select(*PLAYER_KEY, F.col("w.start").alias("session_start"), "first_frame", "last_frame", "frames", "top_speed")
