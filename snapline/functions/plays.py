"""Column expressions over one play row.

Flags follow SQL CASE semantics: an unknown (NULL) condition takes the ELSE value.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def holds(condition: Column) -> Column:
    """True only where the condition is known to be true."""
    return F.coalesce(condition, F.lit(False))


def flag(condition: Column) -> Column:
    """1 where the condition is known to be true, else 0."""
    return F.when(condition, 1).otherwise(0)


def share(condition: Column) -> Column:
    """Fraction of all rows for which the condition is known to be true."""
    return F.avg(F.when(condition, 1.0).otherwise(0.0))


def play_rules() -> dict[str, Column]:
    """Value rules of a play by name; each is true when the row passes."""
    return {
        "down_out_of_range": F.col("down").isNull() | F.col("down").between(1, 4),
        "quarter_out_of_range": F.col("quarter").between(1, 5),
        "yard_line_out_of_range": F.col("yard_line").isNull() | F.col("yard_line").between(1, 100),
        # An unknown distance fails here although the column is optional: the rule is kept as stated.
        "yards_to_go_negative_or_missing": F.col("yards_to_go") >= 0,
    }


def tracking_rules(strict_speed: bool = False) -> dict[str, Column]:
    """Value rules of a tracking frame. A missing speed passes unless ``strict_speed``:
    it is recomputed from the distance later."""
    speed = F.col("speed").between(0, 25)
    return {
        "x_out_of_field": F.col("x_coord").between(0, 53.3),
        "y_out_of_field": F.col("y_coord").between(0, 120),
        "speed_out_of_range": speed if strict_speed else F.col("speed").isNull() | speed,
        "direction_out_of_range": F.col("direction").between(0, 360),
        "orientation_out_of_range": F.col("orientation").between(0, 360),
    }


def all_hold(rules: dict[str, Column]) -> Column:
    verdict = F.lit(True)
    for condition in rules.values():
        verdict = verdict & condition
    return holds(verdict)


def needed_share() -> Column:
    """Share of the needed yards that makes a play successful on its down; NULL on any other down."""
    down = F.col("down")
    return F.when(down == 1, 0.4).when(down == 2, 0.6).when(down.isin(3, 4), 1.0)


def success() -> Column:
    return holds(F.col("yards_gained") >= F.col("yards_to_go") * needed_share())


def situation() -> Column:
    return (
        F.when(F.col("is_red_zone"), "red_zone")
        .when(F.col("is_two_minute_drill"), "two_minute_drill")
        .when(F.abs("score_differential") > 21, "garbage_time")
        .otherwise("normal")
    )


def game_clock() -> Column:
    """Seconds left in regulation; overtime (quarter 5) goes below zero as the formula is stated."""
    return (4 - F.col("quarter")) * 900 + F.col("time_remaining")


def game_clock_with_overtime() -> Column:
    """Seconds left, where overtime counts its own clock only."""
    return F.when(F.col("quarter") > 4, F.col("time_remaining")).otherwise(game_clock())


def field_zone() -> Column:
    yard_line = F.col("yard_line")
    return (
        F.when(yard_line < 40, "own_territory")
        .when(yard_line <= 60, "midfield")
        .otherwise("opp_territory")
    )


def expected_yards() -> Column:
    """Fixed model: yards a play of this type gains on this down."""
    is_pass = F.col("play_type") == "pass"
    down = F.col("down")
    return (
        F.when(F.col("play_type") == "run", 4.2)
        .when(is_pass & (down == 1), 7.5)
        .when(is_pass & (down == 2), 6.8)
        .when(is_pass & down.isin(3, 4), 8.2)
        .otherwise(5.0)
    )


def sigmoid(score: Column) -> Column:
    return 1 / (1 + F.exp(-score))


def clock_penalty() -> Column:
    return 0.001 * (F.col("quarter") * 900 - F.coalesce("time_remaining", F.lit(0)))


def win_probability_before() -> Column:
    return sigmoid(
        0.02 * F.col("score_differential")
        + 0.01 * (100 - F.col("yard_line"))
        - clock_penalty()
        + 0.3 * flag(F.col("down") == 1)
    )


def win_probability_after() -> Column:
    """No first-down term here: the model is stated asymmetrically."""
    return sigmoid(
        0.02 * F.coalesce("next_score_diff", "score_differential")
        + 0.01 * (100 - F.col("yard_line") - F.col("yards_gained"))
        - clock_penalty()
    )
