"""Silver: plays with their tracking measures."""

from __future__ import annotations

from pyspark.sql import DataFrame

from snapline.operators.plays import add_wp_features
from snapline.operators.tracking import aggregate_play_tracking
from snapline.schemas import PLAY_KEY

TRACKING_MEASURES = [
    *[f"{side}_{m}" for side in ("offense", "defense") for m in ("avg_speed", "max_speed", "avg_acceleration", "total_distance")],
    "qb_avg_speed",
    "qb_max_speed",
    "qb_pressure_indicator",
    "avg_receiver_separation",
    "pressure_count",
    "total_defenders",
    "defensive_pressure_rate",
]


def silver_plays(plays: DataFrame, tracking: DataFrame) -> DataFrame:
    """Every play, with tracking measures where frames exist.

    One left join on the play key: the measures come from a single aggregate, not from five.
    """
    return add_wp_features(plays.join(aggregate_play_tracking(tracking, plays), PLAY_KEY, "left"))
