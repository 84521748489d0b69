"""Tracking derivations and per-play aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapline.functions.tracking import gap, is_defender, is_receiver, per_second, seconds_between
from snapline.operators.ordered import over_parts
from snapline.operators.quality import flag_tracking
from snapline.schemas import BRONZE_TRACKING_COLUMNS, PLAY_KEY, PLAYER_KEY


def motion_columns() -> dict[str, Column]:
    """Distance, time step and speed against the previous frame (``prev_*`` columns)."""
    distance = gap(F.col("x_coord"), F.col("y_coord"), F.col("prev_x"), F.col("prev_y"))
    return {
        "distance_traveled": distance,
        "time_delta": seconds_between(F.col("prev_timestamp"), F.col("timestamp")),
    }


def add_motion(df: DataFrame) -> DataFrame:
    """Given ``prev_x``, ``prev_y`` and ``prev_timestamp``, add distance, time step and speeds."""
    return (
        df.withColumns(motion_columns())
        .withColumn("calculated_speed", per_second(F.col("distance_traveled"), F.col("time_delta")))
        .withColumn("final_speed", F.coalesce("speed", "calculated_speed"))
    )


def add_acceleration(df: DataFrame) -> DataFrame:
    change = F.col("final_speed") - F.col("prev_speed")
    return df.withColumn("calculated_acceleration", per_second(change, F.col("time_delta")))


def derive_tracking(
    df: DataFrame, partitions: int | None = None, gap_seconds: float | None = None, *, counted: DataFrame | None = None
) -> DataFrame:
    """Per-player motion from the previous frame; after more than ``gap_seconds`` (off by default) it starts afresh.

    ``counted``: as many frames of each play as ``df`` has, to size the plays without running ``df``.

    ``prev_speed`` is the previous *final* speed, so a missing measured speed does not void the next
    acceleration. It needs the frame before the previous one, hence two rows of reach; both window steps
    share one shuffle and one sort. The frames of a play come to one task, so sums per play need no second shuffle.
    """

    def lagged(name: str):
        return lambda w: F.lag(name, 1).over(w)

    prev_distance = gap(F.col("prev_x"), F.col("prev_y"), F.col("__x2"), F.col("__y2"))
    prev_step = seconds_between(F.col("__t2"), F.col("prev_timestamp"))
    prev_final = F.coalesce("__s1", F.when(F.col("prev_timestamp").isNotNull(), per_second(prev_distance, prev_step)))
    lags = over_parts(
        df,
        PLAYER_KEY,
        ["timestamp", "frame_id"],
        {
            "prev_x": lagged("x_coord"),
            "prev_y": lagged("y_coord"),
            "prev_timestamp": lagged("timestamp"),
            "__s1": lagged("speed"),
            "__x2": lambda w: F.lag("x_coord", 2).over(w),
            "__y2": lambda w: F.lag("y_coord", 2).over(w),
            "__t2": lambda w: F.lag("timestamp", 2).over(w),
        },
        before=2,
        partitions=partitions,
        counted=counted,
        together=PLAY_KEY,
    )
    if gap_seconds is not None:
        prev_final = F.coalesce("__s1", F.when(prev_step <= gap_seconds, per_second(prev_distance, prev_step)).otherwise(0.0))
    lags = lags.withColumn("prev_speed", prev_final)
    if gap_seconds is not None:
        near = seconds_between(F.col("prev_timestamp"), F.col("timestamp")) <= gap_seconds
        lags = lags.withColumns({c: F.when(near, F.col(c)) for c in ("prev_x", "prev_y", "prev_speed", "prev_timestamp")})
    return add_acceleration(add_motion(lags)).drop("__s1", "__x2", "__y2", "__t2")


def bronze_tracking(df: DataFrame, strict_speed: bool = False, partitions: int | None = None) -> DataFrame:
    """Decoded, stamped tracking -> the valid frames of the bronze table (17 columns)."""
    derived = derive_tracking(flag_tracking(df, strict_speed), partitions)
    return derived.filter("is_valid").select(*BRONZE_TRACKING_COLUMNS)


def aggregate_player_play(df: DataFrame) -> DataFrame:
    """Per play and player: mean speed and its spread, mean acceleration, distance covered."""
    return df.groupBy(*PLAYER_KEY, "team", "position").agg(
        F.avg("final_speed").alias("avg_speed"),
        F.stddev_pop("final_speed").alias("speed_stddev"),
        F.avg("calculated_acceleration").alias("avg_acceleration"),
        F.sum("distance_traveled").alias("total_distance"),
    )


def play_teams(plays: DataFrame) -> DataFrame:
    """(key, possession_team, defensive_team) of each play, from its earliest copy.

    Partial aggregation folds the copies. The key is a struct on purpose: Spark does not take the result
    for one partitioned by the play columns, so a later join on those shuffles both sides, which is what
    lets the adaptive plan split a hot play.
    """
    earliest = F.min(F.struct("event_timestamp", "possession_team", "defensive_team"))
    return plays.groupBy(F.struct(*PLAY_KEY).alias("key")).agg(earliest.alias("p")).select(
        "key", "p.possession_team", "p.defensive_team"
    )


def with_roles(tracking: DataFrame, plays: DataFrame) -> DataFrame:
    """Attach the play's two teams to each frame.

    Copies of a play are folded first, so they cannot multiply frames; frames of a hot play are split by
    the adaptive skew join. Not by a broadcast: sizes of shuffles are those of compressed rows, and the teams of
    some 100,000 plays that seem to fit are a multiple of it in the driver.
    """
    side = F.when(F.col("team") == F.col("possession_team"), "offense").when(
        F.col("team") == F.col("defensive_team"), "defense"
    )
    teams = play_teams(plays).select("key.*", "possession_team", "defensive_team")
    return tracking.join(teams.hint("merge"), PLAY_KEY).withColumn("side", side)


def team_partials(tracking: DataFrame, *slices: Column) -> DataFrame:
    """Sums per (play, team), before anything is joined; ``slices`` adds group keys (a stream's window).

    Partial aggregation runs on the map side: raw frames never cross the network for silver and a hot
    play costs no more than any other.
    """
    passing = F.col("event") == "pass"
    qb = F.col("position") == "QB"
    arrived = is_receiver() & (F.col("event") == "pass_arrived")
    speed, acceleration, distance = F.col("final_speed"), F.col("calculated_acceleration"), F.col("distance_traveled")
    return tracking.groupBy(*PLAY_KEY, "team", *slices).agg(
        F.sum(speed).alias("speed_sum"),
        F.count(speed).alias("speed_n"),
        F.max(speed).alias("speed_max"),
        F.sum(acceleration).alias("accel_sum"),
        F.count(acceleration).alias("accel_n"),
        F.sum(distance).alias("distance_sum"),
        F.sum(F.when(qb, speed)).alias("qb_speed_sum"),
        F.count(F.when(qb, speed)).alias("qb_speed_n"),
        F.max(F.when(qb, speed)).alias("qb_speed_max"),
        F.sum(F.when(qb & passing, acceleration)).alias("qb_accel_sum"),
        F.count(F.when(qb & passing, acceleration)).alias("qb_accel_n"),
        F.sum(F.when(arrived, distance)).alias("arrived_sum"),
        F.count(F.when(arrived, distance)).alias("arrived_n"),
        F.count_if(passing & is_defender() & (distance < 2)).alias("pressing_n"),
        F.count_if(passing & F.col("player_id").isNotNull()).alias("pass_n"),
    )


def _mean(total: Column, number: Column) -> Column:
    return F.try_divide(F.sum(total), F.sum(number))


def play_metrics(partials: DataFrame, keys: list[str] = PLAY_KEY, **carried: Column) -> DataFrame:
    """(play, team) sums with the play's teams -> one row per play; ``carried`` adds aggregates.

    Pressure as published counts players that moved less than 2 yards, over all players at the pass;
    a play without pass frames has no pressure (NULL, not 0).
    """

    def side(name: str, team: str) -> dict[str, Column]:
        def mine(c: str) -> Column:
            return F.when(F.col("team") == F.col(team), F.col(c))

        return {
            f"{name}_avg_speed": _mean(mine("speed_sum"), mine("speed_n")),
            f"{name}_max_speed": F.max(mine("speed_max")),
            f"{name}_avg_acceleration": _mean(mine("accel_sum"), mine("accel_n")),
            f"{name}_total_distance": F.sum(mine("distance_sum")),
        }

    seen = F.sum("pass_n") > 0
    measures = {
        **side("offense", "possession_team"),
        **side("defense", "defensive_team"),
        "qb_avg_speed": _mean(F.col("qb_speed_sum"), F.col("qb_speed_n")),
        "qb_max_speed": F.max("qb_speed_max"),
        "qb_pressure_indicator": _mean(F.col("qb_accel_sum"), F.col("qb_accel_n")),
        "avg_receiver_separation": _mean(F.col("arrived_sum"), F.col("arrived_n")),
        "pressure_count": F.when(seen, F.sum("pressing_n")),
        "total_defenders": F.when(seen, F.sum("pass_n")),
    }
    return (
        partials.groupBy(*keys)
        .agg(*[column.alias(name) for name, column in {**carried, **measures}.items()])
        .withColumn("defensive_pressure_rate", F.try_divide("pressure_count", "total_defenders"))
    )


def aggregate_play_tracking(tracking: DataFrame, plays: DataFrame) -> DataFrame:
    """Offense, defense, QB, receiver and pressure measures per play, in one pass.

    Sums and teams meet on the struct key of ``play_teams``; the measures are grouped by it without
    another shuffle. Not by a broadcast: the sums are many times the size that Spark derives for them from the files.
    """
    partials = team_partials(tracking).withColumn("key", F.struct(*PLAY_KEY)).drop(*PLAY_KEY)
    metrics = play_metrics(partials.join(play_teams(plays).hint("merge"), "key"), ["key"])
    return metrics.select("key.*", *metrics.columns[1:])
