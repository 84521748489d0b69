"""Plays and tracking derived from the ``events`` table, for tests, bench and registered queries.

Row-wise rules only: one play per event and 8 players x 3 frames (10 Hz) per play, so the work grows
with the table. Both are plain projections; a filter on time still reaches the Parquet scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PLAYERS = 8
FRAMES = 3
#: Events of one task that unfolds frames on average at most: the frames that it deals by play are sorted without a spill.
TASK_EVENTS = 50_000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _team(side: str) -> str:
    """The game's own team for even sides, its opponent for odd ones."""
    return f"concat('T', string(CASE WHEN ({side}) % 2 = 0 THEN user_id ELSE user_id + 1 + user_id % 7 END % 16))"


def _pick(value: str, *names: str) -> str:
    quoted = ", ".join(f"'{n}'" for n in names)
    return f"element_at(array({quoted}), int({value}) + 1)"


def plays_from_events(events: DataFrame) -> DataFrame:
    """Text expressions: one call each, where a column object takes dozens between Python and the JVM."""
    columns = {
        "game_id": "concat('G', string(user_id))",
        "play_id": "concat('P', string(event_id))",
        "event_timestamp": "ts",
        "possession_team": _team("event_id"),
        "defensive_team": _team("event_id + 1"),
        "down": "int(if(event_id % 23 = 0, NULL, if(event_id % 29 = 0, 5, 1 + (event_id * 11) % 4)))",
        "yards_to_go": "int(if(event_id % 31 = 0, NULL, (event_id * 7) % 15))",
        "yard_line": "int(if(event_id % 41 = 0, NULL, 1 + (event_id * 13) % 100))",
        "quarter": "int(1 + (event_id * 3) % 5)",
        "time_remaining": "int(if(event_id % 37 = 0, NULL, (event_id * 41) % 901))",
        "play_type": "CASE WHEN event_type = 'view' THEN 'run' WHEN event_type IN ('click', 'purchase') THEN 'pass' "
        "WHEN event_type = 'signup' THEN 'punt' ELSE 'field_goal' END",
        "play_result": "if(floor(value) % 40 > 8, 'complete', 'incomplete')",
        "yards_gained": "int(floor(value) % 40 - 8)",
        "is_touchdown": "event_id % 27 = 0",
        "is_turnover": "event_id % 33 = 0",
        "is_penalty": "event_id % 20 = 0",
        "penalty_yards": "int(if(event_id % 20 = 0, -5 * (1 + event_id % 3), 0))",
        "score_home": "int(event_id % 36)",
        "score_away": "int((event_id * 5) % 29)",
        "formation": _pick("event_id % 3", "shotgun", "under_center", "pistol"),
        "personnel_offense": _pick("event_id % 3", "11_personnel", "12_personnel", "21_personnel"),
        "personnel_defense": _pick("event_id % 4", "4-3", "3-4", "nickel", "dime"),
    }
    return events.selectExpr(*[f"{text} AS {name}" for name, text in columns.items()])


def _structs(*rows: dict[str, str]) -> str:
    """A constant array of structs: folded once, where an expression over the number would be evaluated per row."""
    structs = [", ".join(f"{value} AS {name}" for name, value in row.items()) for row in rows]
    return f"inline(array({', '.join(f'struct({s})' for s in structs)}))"


def tracking_from_events(events: DataFrame) -> DataFrame:
    """What all frames of a play or of a player share is derived before they are unfolded."""
    positions = ["QB", "WR", "TE", "RB", "DE", "DT", "LB", "DB"]
    players = [{"k": str(k), "position": f"'{name}'"} for k, name in enumerate(positions[:PLAYERS])]
    frames = [{"f": str(f), "event": f"'{name}'"} for f, name in enumerate(["snap", "pass", "pass_arrived"][:FRAMES])]
    times = [f"ts + make_dt_interval(0, 0, 0, {f} * 0.1) AS ts{f}" for f in range(FRAMES)]
    plays = events.selectExpr(
        "event_id AS e", "concat('G', string(user_id)) AS game_id", "concat('P', string(event_id)) AS play_id",
        f"{_team('event_id')} AS own", f"{_team('event_id + 1')} AS other", *times,
    )
    unfolded = plays.selectExpr("*", _structs(*players)).selectExpr(
        "*", "concat(play_id, '_', string(k)) AS player_id", "if(k < 4, own, other) AS team"
    ).selectExpr("*", _structs(*frames))
    columns = {
        "game_id": "game_id",
        "play_id": "play_id",
        "timestamp": f"CASE f {' '.join(f'WHEN {f} THEN ts{f}' for f in range(FRAMES))} END",
        "frame_id": "f",
        "player_id": "player_id",
        "team": "team",
        "jersey_number": "int(1 + (e + k * 11) % 99)",
        "position": "position",
        "x_coord": "double((e * 17 + k * (e % 30) + f * ((e + k * 3) % 40)) % 540) / 10",
        "y_coord": "double((e * 19 + k * (e % 13) + f * 5) % 1201) / 10",
        "speed": "if((e + k + f) % 43 = 0, NULL, double((e * 7 + k * 31 + f * 3) % 258) / 10)",
        "acceleration": "double((e * 3 + k) % 80 - 40) / 10",
        "direction": "double((e * 23 + k * 45) % 361)",
        "orientation": "double((e * 29 + k * 30) % 361)",
        "event": "event",
    }
    return unfolded.selectExpr(*[f"{text} AS {name}" for name, text in columns.items()])


def spread(df: DataFrame, table: DataFrame | None = None, rows: int | None = None) -> DataFrame:
    """Use all cores on a table of fewer files than cores; larger tables are left as they are.

    ``table`` is the batch form of ``df`` where that is a stream. With ``rows`` a partition has about as many rows at most, so
    that what a task stores of it does not grow with the table.
    """
    table = df if table is None else table
    wanted = df.sparkSession.sparkContext.defaultParallelism
    if rows is not None:
        wanted = max(wanted, -(-table.count() // rows))
    return df if table.rdd.getNumPartitions() >= wanted else df.repartition(wanted, "event_id")


def plays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plays_from_events(read_table(spark, sf_dir, "events"))


def tracking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tracking_from_events(spread(read_table(spark, sf_dir, "events"), rows=TASK_EVENTS))


def counted_tracking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same frames for counting, which stores nothing: the table is left as its files lie."""
    return tracking_from_events(read_table(spark, sf_dir, "events"))


def with_zone(df: DataFrame) -> DataFrame:
    """TIMESTAMP_NTZ columns as TIMESTAMP: messages and watermarks need a zone."""
    plain = [f.name for f in df.schema.fields if f.dataType.typeName() == "timestamp_ntz"]
    return df.withColumns({name: F.col(name).cast("timestamp") for name in plain})


def message(columns: list[str]) -> Column:
    """A row as a JSON message with ISO-8601 times to the microsecond."""
    options = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}
    return F.to_json(F.struct(*columns), options).alias("value")


def as_messages(df: DataFrame) -> DataFrame:
    return with_zone(df).select(message(df.columns))
