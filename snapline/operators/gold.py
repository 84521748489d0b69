"""Play effectiveness, win probability and team statistics."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapline.functions import plays as p
from snapline.operators.ordered import over_parts
from snapline.schemas import PLAY_KEY

EFFECTIVENESS_PASSED = [
    "possession_team",
    "defensive_team",
    "play_type",
    "down",
    "yards_to_go",
    "yard_line",
    "yards_gained",
    "play_success",
]
EFFECTIVENESS_CONTEXT = [
    "offense_avg_speed",
    "defense_avg_speed",
    "defensive_pressure_rate",
    "avg_receiver_separation",
    "game_situation",
    "is_red_zone",
    "is_two_minute_drill",
    "score_differential",
]


def play_effectiveness(silver: DataFrame) -> DataFrame:
    """Expected yards, yards over expected and success per play (22 columns)."""
    expected = p.expected_yards()
    return silver.select(
        *PLAY_KEY,
        F.to_date("event_timestamp").alias("game_date"),
        *EFFECTIVENESS_PASSED,
        expected.alias("expected_yards_gained"),
        (F.col("yards_gained") - expected).alias("yards_over_expected"),
        p.success().cast("int").alias("is_successful_play"),
        *EFFECTIVENESS_CONTEXT,
    )


def play_sequences(
    silver: DataFrame, *, partitions: int | None = None
) -> DataFrame:
    """Score and field position of the neighbouring plays of the game."""
    return over_parts(
        silver,
        ["game_id"],
        ["event_timestamp", "play_id"],
        {
            "prev_score_diff": lambda w: F.lag("score_differential").over(w),
            "prev_yard_line": lambda w: F.lag("yard_line").over(w),
            "next_score_diff": lambda w: F.lead("score_differential").over(w),
        },
        before=1,
        after=1,
        partitions=partitions,
    )


def win_probability(
    silver: DataFrame, *, quarter: bool = False, partitions: int | None = None
) -> DataFrame:
    """Win probability before and after each play, and what the play added; on request with the quarter."""
    rows = play_sequences(silver, partitions=partitions)
    return (
        rows.withColumn("win_probability_before", p.win_probability_before())
        .withColumn("win_probability_after", p.win_probability_after())
        .select(
            *PLAY_KEY,
            F.to_date("event_timestamp").alias("game_date"),
            "possession_team",
            "play_type",
            "win_probability_before",
            "win_probability_after",
            (F.col("win_probability_after") - F.col("win_probability_before")).alias("win_prob_added"),
            "play_success",
            "yards_gained",
            "game_situation",
            *(["quarter"] if quarter else []),
        )
    )


def team_daily_stats(effectiveness: DataFrame, wp: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    """Per team and day, effectiveness joined to win probability by play.

    ``as_of`` keeps the day before it only. Both sides are folded to sums per play before the join, so
    copies of a play count as a join would count them, but no pair of copies is ever produced.
    """
    if as_of is not None:
        effectiveness = effectiveness.filter(F.col("game_date") == as_of - dt.timedelta(days=1))
        wp = wp.filter(F.col("game_date") == as_of - dt.timedelta(days=1))

    def sums(**columns: Column) -> list[Column]:
        pairs = []
        for name, column in columns.items():
            pairs += [F.sum(column).alias(f"{name}_sum"), F.count(column).alias(f"{name}_n")]
        return pairs

    success = F.col("is_successful_play")
    left = effectiveness.groupBy(
        *PLAY_KEY, F.col("game_date").alias("stat_date"), F.col("possession_team").alias("team")
    ).agg(
        F.count("*").alias("plays"),
        F.sum(p.flag(F.col("play_type") == "run")).alias("runs"),
        F.sum(p.flag(F.col("play_type") == "pass")).alias("passes"),
        F.sum(p.flag(F.col("is_red_zone"))).alias("red_zone"),
        *sums(
            yards=F.col("yards_gained"),
            over=F.col("yards_over_expected"),
            success=success,
            speed=F.col("offense_avg_speed"),
            pressure=F.col("defensive_pressure_rate"),
            red_success=F.when(F.col("is_red_zone"), success),
        ),
    )
    right = wp.groupBy(*PLAY_KEY).agg(F.count("*").alias("copies"), F.sum("win_prob_added").alias("wpa"))
    copies = F.col("copies")

    def total(name: str) -> Column:
        return F.sum(F.col(name) * copies)

    def mean(name: str) -> Column:
        return F.try_divide(total(f"{name}_sum"), total(f"{name}_n"))

    return (
        left.join(right, PLAY_KEY)
        .groupBy("stat_date", "team")
        .agg(
            total("plays").alias("total_plays"),
            total("runs").alias("run_plays"),
            total("passes").alias("pass_plays"),
            mean("yards").alias("avg_yards_per_play"),
            mean("over").alias("avg_yards_over_expected"),
            mean("success").alias("success_rate"),
            F.sum(F.col("wpa") * F.col("plays")).alias("total_wpa"),
            mean("speed").alias("avg_offense_speed"),
            mean("pressure").alias("avg_pressure_rate_faced"),
            total("red_zone").alias("red_zone_plays"),
            mean("red_success").alias("red_zone_success_rate"),
        )
    )


def wpa_by_play_type(wp: DataFrame, start: dt.date | None = None, end: dt.date | None = None, last_quarter: int = 4) -> DataFrame:
    """Mean win probability added per play type, best first: regular time of the days from ``start`` to ``end``.

    ``wp`` carries ``quarter``.
    """
    plays = wp.filter(F.col("quarter") <= last_quarter)
    if start is not None:
        plays = plays.filter(F.col("game_date") >= F.lit(start))
    if end is not None:
        plays = plays.filter(F.col("game_date") <= F.lit(end))
    return (
        plays.groupBy("play_type")
        .agg(F.avg("win_prob_added").alias("avg_wpa"), F.count("*").alias("play_count"))
        .orderBy(F.desc("avg_wpa"), "play_type")
    )


def top_pressure(
    plays: DataFrame, rate: str = "defensive_pressure_rate", threshold: float = 0.6, n: int = 100
) -> DataFrame:
    """The ``n`` plays with the highest pressure rate above the threshold."""
    return (
        plays.filter(F.col(rate) > threshold)
        .orderBy(F.desc(rate), *PLAY_KEY)
        .limit(n)
        .select(*PLAY_KEY, rate, "play_result")
    )


PLAY_CLASSES = ["run", "pass", "punt", "field_goal", "other"]


def _situation_class() -> dict[str, Column]:
    """Coarse situation; 5 x 5 x 4 x 4 = 400 combinations at most."""
    need, zone = F.col("yards_to_go"), p.field_zone()
    known = F.col("play_type").isin(PLAY_CLASSES[:-1])
    return {
        "play_class": F.when(known, F.col("play_type")).otherwise(PLAY_CLASSES[-1]),
        "down_class": F.when(F.col("down").between(1, 4), F.col("down")).otherwise(0),
        "distance_class": F.when(need <= 3, "short").when(need <= 7, "medium").when(need > 7, "long").otherwise("none"),
        "zone_class": F.when(F.col("yard_line").isNull(), "none").otherwise(zone),
    }


def historical_expected_yards(silver: DataFrame) -> DataFrame:
    """Mean yards gained per play class, down, distance class and field zone: at most 400 rows."""
    classes = _situation_class()
    return silver.groupBy(*[c.alias(name) for name, c in classes.items()]).agg(
        F.avg("yards_gained").alias("expected_yards_gained"), F.count("yards_gained").alias("history_plays")
    )


def add_historical_expected_yards(plays: DataFrame, history: DataFrame) -> DataFrame:
    """Expected yards learnt from history instead of the fixed model.

    ``history`` comes from ``historical_expected_yards``; its size is bounded by its classes, which makes
    the broadcast safe at any scale.
    """
    classes = _situation_class()
    return (
        plays.withColumns(classes)
        .join(F.broadcast(history), list(classes), "left")
        .withColumn("yards_over_expected", F.col("yards_gained") - F.col("expected_yards_gained"))
    )


#: Situations from the finest to none; each level groups by the first so many classes.
LEVELS = ["play_class", "down_class", "distance_class", "zone_class"]


def historical_levels(silver: DataFrame) -> DataFrame:
    """Mean yards gained at every level of detail, in one pass by grouping sets: ``level`` classes are given, the others are NULL.

    At most 400 + 100 + 25 + 5 + 1 rows.
    """
    sets = [[F.col(c) for c in LEVELS[:n]] for n in range(len(LEVELS), -1, -1)]
    rows = silver.select(*[c.alias(name) for name, c in _situation_class().items()], "yards_gained")
    level = sum((F.lit(1) - F.grouping(c) for c in LEVELS), F.lit(0))
    return rows.groupingSets(sets, *LEVELS).agg(
        level.cast("int").alias("level"), F.avg("yards_gained").alias("expected_yards_gained"), F.count("yards_gained").alias("history_plays")
    )


def add_backed_off_expected_yards(plays: DataFrame, levels: DataFrame, min_plays: int = 20) -> DataFrame:
    """Expected yards from the finest level that knows at least ``min_plays`` plays; the mean of all where none does.

    A class that history has never seen still gets a value. ``levels`` comes from ``historical_levels``, whose size is bounded by its classes, so
    its five parts are broadcast.
    """
    rows = plays.withColumns(_situation_class())
    for n in range(len(LEVELS) + 1):
        part = levels.filter((F.col("level") == n) & ((F.col("history_plays") >= min_plays) | (F.lit(n) == 0)))
        found = F.struct("expected_yards_gained", "history_plays", F.lit(n).alias("level")).alias(f"_level{n}")
        # The mean of all is given to each class, so that it comes by a key as the others do.
        part = part.select(*LEVELS[:n], found) if n else part.select(F.explode(F.array(*map(F.lit, PLAY_CLASSES))).alias(LEVELS[0]), found)
        rows = rows.join(F.broadcast(part), LEVELS[: max(n, 1)], "left")
    best = F.coalesce(*[f"_level{n}" for n in range(len(LEVELS), -1, -1)])
    rows = rows.withColumn("_best", best).drop(*[f"_level{n}" for n in range(len(LEVELS) + 1)])
    expected = F.col("_best.expected_yards_gained")
    return rows.select(
        *plays.columns, *LEVELS, expected.alias("expected_yards_gained"), F.col("_best.history_plays").alias("history_plays"),
        F.col("_best.level").alias("level"), (F.col("yards_gained") - expected).alias("yards_over_expected"),
    )


def join_game_context(plays: DataFrame, context: DataFrame) -> DataFrame:
    """Left join of per-game context. No broadcast hint: Spark broadcasts it below its size threshold and
    otherwise splits hot games by the adaptive skew join."""
    return plays.join(context, "game_id", "left")
