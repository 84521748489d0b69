"""Model features: rolling and opponent windows, and the final projection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapline.functions.plays import flag, share
from snapline.operators import plays as p
from snapline.operators.ordered import over_parts, rows_since
from snapline.schemas import FEATURE_COLUMNS

PLAY_ORDER = ["event_timestamp", "play_id"]


def add_rolling_features(
    df: DataFrame, n: int = 5, *, partitions: int | None = None, counted: DataFrame | None = None
) -> DataFrame:
    """Means over the possession team's previous ``n`` plays; NULL on its first play.

    ``counted``: plays that ``df`` has one row for each of, to size the teams without running ``df``.
    """

    def last(w):
        return w.rowsBetween(-n, -1)

    return over_parts(
        df,
        ["possession_team"],
        PLAY_ORDER,
        {
            "rolling_avg_yards": lambda w: F.avg("yards_gained").over(last(w)),
            "rolling_success_rate": lambda w: share(F.col("play_success")).over(last(w)),
            "rolling_pressure": lambda w: F.avg("defensive_pressure_rate").over(last(w)),
            f"turnovers_last_{n}": lambda w: F.sum(flag(F.col("is_turnover"))).over(last(w)),
        },
        before=n,
        partitions=partitions,
        counted=counted,
    )


def add_plays_since_turnover(
    df: DataFrame, *, partitions: int | None = None
) -> DataFrame:
    """Plays of the team since its last turnover; NULL before the first one."""
    return rows_since(
        df,
        ["possession_team"],
        PLAY_ORDER,
        "is_turnover",
        "plays_since_turnover",
        partitions=partitions,
    )


def add_opponent_features(
    df: DataFrame, n: int = 20, *, partitions: int | None = None, counted: DataFrame | None = None
) -> DataFrame:
    """What the defensive team allowed over its previous ``n`` plays; ``counted`` as in ``add_rolling_features``."""

    def last(w):
        return w.rowsBetween(-n, -1)

    return over_parts(
        df,
        ["defensive_team"],
        PLAY_ORDER,
        {
            "opp_avg_yards_allowed": lambda w: F.avg("yards_gained").over(last(w)),
            "opp_success_rate_allowed": lambda w: share(F.col("play_success")).over(last(w)),
            "opp_pressure_rate": lambda w: F.avg("defensive_pressure_rate").over(last(w)),
        },
        before=n,
        partitions=partitions,
        counted=counted,
    )


def select_final_features(df: DataFrame) -> DataFrame:
    """The 35 published columns; ``plays_since_turnover`` there counts turnovers in the last 5 plays."""
    named = df.withColumn("plays_since_turnover", F.col("turnovers_last_5"))
    return named.select(*FEATURE_COLUMNS)


def ml_features(
    silver: DataFrame, *, partitions: int | None = None, counted: DataFrame | None = None
) -> DataFrame:
    """The whole feature table. Two shuffles: by possession team and by defensive team."""
    windows = {"partitions": partitions, "counted": counted}
    return (
        silver.transform(lambda df: add_rolling_features(df, **windows))
        .transform(p.add_game_context_features)
        .transform(p.add_down_distance_features)
        .transform(p.add_tracking_derived_features)
        .transform(lambda df: add_opponent_features(df, **windows))
        .transform(p.add_interaction_features)
        .transform(select_final_features)
    )
